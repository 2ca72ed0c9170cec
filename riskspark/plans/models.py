"""Model classes with the reference's constructor surface, fitted on
DataFrames (layout + assembled features), and the G5 scoring projection.

A fitted model is literals only (weights, scaler, threshold), so ``transform``
is a narrow projection: codegen'd, no shuffle, valid on streaming frames."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.columns import balanced_sum, sigmoid, softplus
from riskspark.operators.clean import FeatureLayout
from riskspark.operators.persistence import SavedAsJson
from riskspark.plans.cv import ModelConfig


def _literals(weights) -> tuple | None:
    return None if weights is None else tuple(float(v) for v in weights)


class LinearScorer(Model, SavedAsJson):
    """Weights over a layout, with the per-column scaler used in training; a
    ``pyspark.ml`` model whose transform adds ``score`` and ``prediction``."""

    def __init__(self, layout: FeatureLayout, weights: np.ndarray, mean: np.ndarray, std: np.ndarray,
                 logistic: bool, threshold: float = 0.0, score_col: str = "score", pred_col: str = "prediction"):
        super().__init__()
        self.layout, self.weights, self.mean, self.std = layout, weights, mean, std
        self.logistic, self.threshold = logistic, threshold
        self.score_col, self.pred_col = score_col, pred_col

    def state(self) -> dict:
        numbers = {n: [float(v) for v in getattr(self, n)] for n in ("weights", "mean", "std")}
        return {"layout": self.layout.to_json(), **numbers, "logistic": self.logistic, "threshold": float(self.threshold),
                "score_col": self.score_col, "pred_col": self.pred_col}

    @classmethod
    def from_state(cls, state: dict) -> "LinearScorer":
        numbers = {n: np.array(state[n], float) for n in ("weights", "mean", "std")}
        return cls(**{**state, **numbers, "layout": FeatureLayout.from_json(state["layout"])})

    def linear_term(self) -> Column:
        cont = self.layout.continuous_positions()
        stats = {p: (self.mean[j], self.std[j]) for j, p in enumerate(cont)}
        terms = []
        for p, (fc, w) in enumerate(zip(self.layout.columns, self.weights)):
            if fc.kind == "intercept":
                x = F.lit(1.0)
            elif p in stats:
                mu, sd = stats[p]
                x = (F.col(fc.name) - F.lit(float(mu))) / F.lit(float(sd)) if sd > 0 else F.lit(0.0)
            else:
                x = F.col(fc.name)
            terms.append(x * F.lit(float(w)))
        return balanced_sum(terms)

    def coded_term(self) -> Column:
        """``linear_term`` of rows with ``codes`` instead of one-hot columns: weights are looked up by position."""
        dense = FeatureLayout([fc for fc in self.layout.columns if fc.kind != "onehot"])
        values = LinearScorer(dense, [w for fc, w in zip(self.layout.columns, self.weights) if fc.kind != "onehot"],
                              self.mean, self.std, self.logistic).linear_term()
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        return values + F.aggregate("codes", F.lit(0.0), lambda s, p: s + F.when(p < 0, F.lit(0.0)).otherwise(F.get(weights, p)))

    def score(self, coded: bool = False) -> Column:
        t = self.coded_term() if coded else self.linear_term()
        return sigmoid(t) if self.logistic else t

    def _transform(self, df: DataFrame) -> DataFrame:
        score, pred = self.score_col, self.pred_col
        return df.withColumn(score, self.score("codes" in df.columns)).withColumn(
            pred, F.when(F.col(score) <= F.lit(float(self.threshold)), F.lit(-1)).otherwise(F.lit(1)).cast("int"))


class ModelBase:
    """subclasses set ``config``; ``fit`` trains on all given rows
    (a one-fold cross-validation without a validation part)."""

    config: ModelConfig

    def __init__(self):
        self.w = None
        self.loss = None
        self.scorer: LinearScorer | None = None

    def get_params(self) -> dict:
        return {k: v for k, v in self.config.__dict__.items()}

    def fit(self, data: DataFrame, layout: FeatureLayout, threshold: float = 0.0):
        """``data`` as produced by ``plans.cv.prepare`` (rows with fold >= 0 are used)."""
        from riskspark.plans.cv import cross_validate
        import warnings
        one = data.withColumn("fold", F.when(F.col("fold") >= 0, F.lit(0)).otherwise(F.lit(-1)))
        with warnings.catch_warnings():      # no validation rows here, so no threshold to warn about
            warnings.simplefilter("ignore")
            res = cross_validate(one, layout, [self.config], k=1, threshold=threshold, folds=[-1])
        r = res.folds[0]
        self.w, self.loss = r.weights, r.train_loss
        self.scorer = LinearScorer(layout, r.weights, r.mean, r.std, self.config.loss == "logistic", threshold)
        return self.w, self.loss

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        if self.scorer is None:
            raise RuntimeError("predict needs weights: this model has not been trained on any rows yet")
        if threshold is not None:
            self.scorer.threshold = threshold
        return self.scorer.transform(df)

    def f(self) -> Column:
        """The fitted function of a row: linear term, or its sigmoid for logistic models."""
        if self.scorer is None:
            raise RuntimeError("f needs weights: this model has not been trained on any rows yet")
        return self.scorer.score()

    def score(self, df: DataFrame, label: str = "label") -> float:
        """unbalanced loss over all rows of ``df`` (one aggregate, JVM only); ridge and L2 models add
        lambda * ||w||^2. Labels are -1 and 1; an empty frame gives NaN."""
        if self.scorer is None:
            raise RuntimeError("score needs weights: this model has not been trained on any rows yet")
        t, y = self.scorer.linear_term(), F.col(label).cast("double")
        if self.config.loss == "logistic":
            loss = softplus(t) - F.when(y == -1, F.lit(0.0)).otherwise(F.lit(1.0)) * t
        else:
            loss = (y - t) * (y - t) / 2.0
        mean = df.agg(F.avg(loss)).first()[0]
        penalty = self.config.lam * float(np.sum(self.w ** 2)) if self.config.penalty_in_score else 0.0
        return float("nan") if mean is None else float(mean) + penalty

    def get_metrics(self, df: DataFrame, label: str = "label", threshold: float | None = None) -> dict:
        """Accuracy, recall, false positive ratio, precision and F1 of the predictions for ``df``."""
        from riskspark.operators.evaluate import confusion_metrics
        row = confusion_metrics(self.predict(df, threshold), label, "prediction").first()
        return {k: float(row[k]) for k in ("accuracy", "recall", "fpr", "precision", "f1")}


class LeastSquares(ModelBase):
    """``solver``: "gram" for normal equations, "qr" for features that are nearly dependent (high powers)."""

    def __init__(self, solver: str = "gram"):
        super().__init__()
        self.config = ModelConfig({"gram": "least_squares", "qr": "least_squares_qr"}[solver])


class MSEGradientDescent(ModelBase):
    def __init__(self, max_iters: int = 200, gamma: float = 0.1, initial_w=None, balance_loss: bool = False):
        super().__init__()
        self.config = ModelConfig("mse_gd", max_iters, gamma, 0.0, "residual_sign" if balance_loss else None,
                                  initial_w=_literals(initial_w))


class RidgeRegression(ModelBase):
    def __init__(self, lambda_: float = 0.1, **_ignored):
        super().__init__()
        self.config = ModelConfig("ridge", lam=lambda_)


class LogisticRegressionGD(ModelBase):
    def __init__(self, max_iters: int = 200, gamma: float = 0.7, initial_w=None, balance_loss: bool = False,
                 balance: str = "label"):
        super().__init__()
        self.config = ModelConfig("logistic", max_iters, gamma, 0.0, balance if balance_loss else None,
                                  initial_w=_literals(initial_w))

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """without a threshold the logistic default 0.18 applies."""
        return super().predict(df, 0.18 if threshold is None else threshold)


class RegularizedLogisticRegressionGD(LogisticRegressionGD):
    def __init__(self, lambda_: float = 0.1, max_iters: int = 200, gamma: float = 0.7, initial_w=None, **_ignored):
        super().__init__(max_iters, gamma)
        self.config = ModelConfig("reg_logistic", max_iters, gamma, lambda_, initial_w=_literals(initial_w))
