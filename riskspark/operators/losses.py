"""D1-D12 as DataFrame aggregates for a given weight vector.

These are the "score a fixed model" forms: one aggregate job, JVM side,
no Python. Training uses the batched NumPy kernel in ``gd.py`` instead,
which evaluates many weight vectors per pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskspark.functions.columns import dot, sigmoid, softplus
from riskspark.operators.gd import negative_positive_ratio


def ratio_of(df: DataFrame, y: str = "y") -> float:
    """D12 over a table (one aggregate)."""
    r = df.agg(F.count_if(F.col(y) == -1).alias("neg"), F.count_if(F.col(y) == 1).alias("pos")).first()
    return negative_positive_ratio(r["neg"], r["pos"])


def balanced_errors(y: Column, t: Column, r: float) -> Column:
    """e = y - t; if r > 1 errors >= 0 are multiplied by r, else errors <= 0."""
    e = y - t
    if r > 1:
        return F.when(e >= 0, e * F.lit(r)).otherwise(e)
    return F.when(e <= 0, e * F.lit(r)).otherwise(e)


def label_weight(y01: Column, r: float) -> Column:
    """Weight r on the minority label's terms (r > 1: positives, else negatives)."""
    if r > 1:
        return F.when(y01 == 1, F.lit(r)).otherwise(F.lit(1.0))
    return F.when(y01 == 0, F.lit(r)).otherwise(F.lit(1.0))


def pm_weight(y: Column, r: float) -> Column:
    """The same rule on +/-1 labels (reference D9 / D11)."""
    if r > 1:
        return F.when(y == 1, F.lit(r)).otherwise(F.lit(1.0))
    return F.when(y == -1, F.lit(r)).otherwise(F.lit(1.0))


def row_terms(kind: str, xs: Sequence[str], w: Sequence[float], y: str = "y", r: float = 1.0):
    """(per-row loss, per-row d loss / d t) for a loss kind:
    mse (D3/D5), mse_balanced (D4/D7), logistic (D8/D10, 0/1 labels from +/-1),
    logistic_balanced (D9/D11 as coded, +/-1 labels, sigmoid scaled)."""
    t = dot(xs, w)
    yc = F.col(y).cast("double")
    if kind == "mse":
        e = yc - t
        return e * e / F.lit(2.0), -e
    if kind == "mse_balanced":
        e = balanced_errors(yc, t, r)
        return e * e / F.lit(2.0), -e
    if kind == "logistic":
        y01 = F.when(yc == 1, F.lit(1.0)).otherwise(F.lit(0.0))
        return -y01 * t + softplus(t), sigmoid(t) - y01
    if kind == "logistic_balanced":
        wgt = pm_weight(yc, r)
        return (-yc * t + softplus(t)) * wgt, sigmoid(t) * wgt - yc
    raise ValueError(kind)


def loss(df: DataFrame, kind: str, xs: Sequence[str], w: Sequence[float], y: str = "y",
         r: float | None = None) -> DataFrame:
    if r is None:
        r = ratio_of(df, y) if "balanced" in kind else 1.0
    lv, _ = row_terms(kind, xs, w, y, r)
    return df.agg(F.avg(lv).alias("loss"))


def gradient(df: DataFrame, kind: str, xs: Sequence[str], w: Sequence[float], y: str = "y",
             r: float | None = None) -> DataFrame:
    """(1/N) X^T R as rows (j, grad) from one aggregate."""
    if r is None:
        r = ratio_of(df, y) if "balanced" in kind else 1.0
    _, R = row_terms(kind, xs, w, y, r)
    agg = df.agg(*[F.avg(R * F.col(x)).alias(f"g{j}") for j, x in enumerate(xs)])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(j).cast("bigint").alias("j"),
                                                   F.col(f"g{j}").alias("grad"))
                                          for j in range(len(xs))])).alias("s")).select("s.*")


def fold_class_ratios(df: DataFrame, fold_col: str = "fold", label_col: str = "label") -> DataFrame:
    """D12 for the training part of each fold -> (fold, n_neg, n_pos, ratio): totals minus the fold's own counts.

    One grouped count, then a window over its k rows. 1.0 without negatives; null without positives."""
    per_fold = df.groupBy(fold_col).agg(F.count_if(F.col(label_col) == -1).alias("neg"), F.count_if(F.col(label_col) == 1).alias("pos"))
    folds = Window.partitionBy()  # one row per fold, not data rows
    neg, pos = (F.sum(c).over(folds) - F.col(c) for c in ("neg", "pos"))
    ratio = F.when(neg == 0, F.lit(1.0)).when(pos > 0, neg.cast("double") / pos.cast("double"))
    return per_fold.select(fold_col, neg.cast("bigint").alias("n_neg"), pos.cast("bigint").alias("n_pos"), ratio.alias("ratio"))
