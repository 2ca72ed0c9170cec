"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
whole tables. Float outputs are rounded to 6 places, ids and counts are
BIGINT, so results compare exactly with the SQL oracle in ``oracle.py``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.columns import r6
from riskspark.operators import conform, encode, profile, split
from riskspark.operators.recode import apply_rules
from riskspark.sources.spec import read_spec
from riskspark.sources.tables import line_num, order_risk
from riskspark.specs import spec_path

K = 5
SEED = 1
LINE_FEATURES = ["quantity", "price", "discount", "tax", "qty_low", "linestatus"]
ORDER_FEATURES = ["totalprice", "acctbal", "ordermonth", "regionkey", "orderstatus", "mktsegment"]
ORDER_CATEGORIES = ["ordermonth", "regionkey", "orderstatus", "mktsegment"]
# Vocabularies of the conformance query (one value of each left out on purpose).
VOCAB_CHECK = {
    "orderstatus": ["F", "O"],
    "mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"],
}


def _spec(spark: SparkSession, name: str):
    return read_spec(spark, spec_path(name))


def _bool_int(c) -> F.Column:
    return F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")


# ------------------------------------------------------------------ B1, B2

def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.missing_ratio(line_num(spark, sf), LINE_FEATURES)
    return out.select("split", "feature", r6("missing_ratio").alias("missing_ratio"))


def drop_sparse_columns(spark: SparkSession, sf: str) -> DataFrame:
    rep = profile.sparse_column_report(line_num(spark, sf), LINE_FEATURES, 0.1)
    return rep.select("feature", r6("train_ratio").alias("train_ratio"), r6("test_ratio").alias("test_ratio"),
                      _bool_int("kept").alias("kept"))


# ------------------------------------------------------------------ B18, B12

def spec_conformance(spark: SparkSession, sf: str) -> DataFrame:
    return conform.spec_conformance(line_num(spark, sf), LINE_FEATURES, _spec(spark, "line_num"))


def observed_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """B18 counted by the action that writes the recoded table: no scan of its own."""
    import uuid

    from riskspark.session import scratch_path
    watched = conform.ObservedConformance(LINE_FEATURES, _spec(spark, "line_num"))
    specs = {s.id: s for s in _spec(spark, "line_num")}
    rules = {c: specs[c].mapping for c in ("quantity", "discount", "tax")}
    df = line_num(spark, sf)
    means = apply_rules(df, rules)[1]
    out, _ = apply_rules(watched.watch(df), rules, means=means)
    out.write.parquet(scratch_path(spark, f"observed-{uuid.uuid4().hex}"))
    return watched.report(spark)


def vocab_conformance(spark: SparkSession, sf: str) -> DataFrame:
    df = order_risk(spark, sf)
    parts = [conform.vocab_violations(df, c, v) for c, v in VOCAB_CHECK.items()]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------ B4-B8, B11

def recode_chain(spark: SparkSession, sf: str) -> DataFrame:
    specs = {s.id: s for s in _spec(spark, "line_num")}
    df = line_num(spark, sf).select("key", "split", "label", "quantity", "discount", "tax")
    rules = {c: specs[c].mapping for c in ("quantity", "discount", "tax")}
    out, _ = apply_rules(df, rules, "split")
    return out.select("key", "split", "label", *[r6(c).alias(c) for c in ("quantity", "discount", "tax")])


def range_bin(spark: SparkSession, sf: str) -> DataFrame:
    from riskspark.sources.spec import spec_from_list
    spec = spec_from_list([{"id": "totalprice", "description": "price band", "type": "continuous",
                            "mapping": [["0-100000", "1"], ["100000.01-200000", "2"],
                                        ["200000.01-1000000", "3"]]}])[0]
    out, _ = apply_rules(order_risk(spark, sf).select("id", "split", "totalprice"), {"totalprice": spec.mapping})
    return out.select("id", "split", r6("totalprice").alias("totalprice"))


def impute_mean_per_split(spark: SparkSession, sf: str) -> DataFrame:
    specs = {s.id: s for s in _spec(spark, "order_risk")}
    out, _ = apply_rules(order_risk(spark, sf).select("id", "split", "acctbal"), {"acctbal": specs["acctbal"].mapping})
    return out.select("id", "split", r6("acctbal").alias("acctbal"))


# ------------------------------------------------------------------ B9, B10

def auto_type(spark: SparkSession, sf: str) -> DataFrame:
    df = order_risk(spark, sf)
    return profile.auto_kinds(df, ORDER_FEATURES, 10, F.col("split") == "train")


def auto_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_sets(order_risk(spark, sf), ORDER_CATEGORIES).select("feature", "value")


def wide_profile(spark: SparkSession, sf: str) -> DataFrame:
    """B2, B9, B10 of 321 columns from one scan: missing shares, decision, kind, and for columns of ten
    training values at most their number and the values of all splits."""
    from riskspark.operators import wide_profile as wide
    from riskspark.sources.tables import wide_columns, wide_risk
    found = wide.decide(wide.wide_profile(wide_risk(spark, sf), wide_columns()))
    rows = []
    for d in found.values():
        few = d.kind == "categorical"
        values = ",".join("-" if v is None else str(int(v)) for v in d.values) if few else None
        rows.append((d.name, d.missing["train"], d.missing["test"], int(d.kept(0.1, ("train", "test"))), d.kind,
                     d.n_distinct if few else None, values))
    out = spark.createDataFrame(rows, "feature string, train_ratio double, test_ratio double, kept bigint, kind string, "
                                      "n_distinct bigint, vocabulary string")
    return out.select("feature", r6("train_ratio").alias("train_ratio"), r6("test_ratio").alias("test_ratio"), "kept", "kind",
                      "n_distinct", "vocabulary")


# ------------------------------------------------------------------ B13-B17, B19

def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = order_risk(spark, sf)
    specs = {s.id: s for s in _spec(spark, "order_risk")}
    region_vocab = profile.vocabulary(df, "regionkey")              # auto column: vocabulary from data
    exprs = (encode.onehot_exprs("orderstatus", specs["orderstatus"].vocabulary)
             + encode.onehot_exprs("mktsegment", specs["mktsegment"].vocabulary)
             + encode.onehot_exprs("regionkey", region_vocab))
    return df.select("id", "split", *exprs)


def drop_constant(spark: SparkSession, sf: str) -> DataFrame:
    df = line_num(spark, sf).withColumn("pos_qty", (F.col("quantity") > 0).cast("double"))
    cols = ["quantity", "price", "discount", "tax", "qty_low", "pos_qty"]
    rep = profile.constant_report(df, cols, F.col("split") == "train")
    return rep.select("feature", r6("min_value").alias("min_value"), r6("max_value").alias("max_value"),
                      "n_missing", _bool_int("kept").alias("kept"))


def poly_expand(spark: SparkSession, sf: str) -> DataFrame:
    df = line_num(spark, sf)
    exprs = encode.poly_exprs(["discount", "tax"], 3)
    return df.select("key", "split", *exprs).select("key", "split", *[r6(c).alias(c) for c in
                                                                     ["discount", "discount_p2", "discount_p3",
                                                                      "tax", "tax_p2", "tax_p3"]])


def _order_cleaning(spark: SparkSession, sf: str):
    from riskspark.operators.clean import CleaningEstimator
    df = order_risk(spark, sf)
    model = CleaningEstimator(_spec(spark, "order_risk")).fit(df)
    return model


def add_intercept(spark: SparkSession, sf: str) -> DataFrame:
    """B19 + B15: clean with the spec, put the intercept first, assemble, one
    row per (id, position)."""
    model = _order_cleaning(spark, sf)
    layout = model.layout.with_intercept()
    clean = model.transform(order_risk(spark, sf))
    cols = [F.lit(1.0) if fc.kind == "intercept" else F.col(fc.name) for fc in layout.columns]
    return (clean.select("id", "split", F.posexplode(F.array(*[c.cast("double") for c in cols])))
            .select("id", "split", F.col("pos").cast("bigint").alias("pos"), r6("col").alias("value")))


# ------------------------------------------------------------------ A3, C1-C3, C9

def _train_rows(spark, sf) -> DataFrame:
    return order_risk(spark, sf).filter(F.col("split") == "train")


def stride_sample(spark: SparkSession, sf: str) -> DataFrame:
    return split.stride_sample(_train_rows(spark, sf), 50, "sample", "id").select("id", "label")


def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    return _train_rows(spark, sf).select("id", split.holdout_column(0.8, SEED).cast("bigint").alias("holdout"))


def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    df = _train_rows(spark, sf)
    fold = F.when(split.holdout_column(0.8, SEED), F.lit(-1)).otherwise(split.fold_column(K, SEED))
    return df.select("id", fold.cast("bigint").alias("fold"))


def exact_holdout(spark: SparkSession, sf: str) -> DataFrame:
    out = split.exact_holdout(_train_rows(spark, sf).select("id"), 0.8, SEED)
    return out.select("id", F.col("holdout").cast("bigint").alias("holdout"))


def kfold_exact(spark: SparkSession, sf: str) -> DataFrame:
    """C3 exact: folds of int(N / 7) rows; the rows left over (fold 7) are never validated on."""
    return split.exact_folds(_train_rows(spark, sf).select("id"), 7, SEED).select("id", F.col("fold").cast("bigint").alias("fold"))


def undersample(spark: SparkSession, sf: str) -> DataFrame:
    return split.undersample(_train_rows(spark, sf).select("id", "label"), "label", "balance", "id")


# ------------------------------------------------------------------ C4, C5, D12, G10

def _fold_rows(spark, sf) -> DataFrame:
    df = _train_rows(spark, sf)
    return df.filter(~split.holdout_column(0.8, SEED)).withColumn("fold", split.fold_column(K, SEED))


def _scalers(df, cols):
    from riskspark.operators.moments import fold_moments, training_scalers
    return training_scalers(fold_moments(df, cols, "fold"), range(K))


def scale_fit(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["totalprice", "acctbal"]
    sc = _scalers(_fold_rows(spark, sf), cols)
    rows = [(int(i), c, float(sc[i][0][j]), float(sc[i][1][j])) for i in range(K) for j, c in enumerate(cols)]
    out = spark.createDataFrame(rows, "fold bigint, feature string, mean double, std double")
    return out.select("fold", "feature", r6("mean").alias("mean"), r6("std").alias("std"))


def scale_apply_kfold(spark: SparkSession, sf: str) -> DataFrame:
    """Every row once per fold, scaled with that fold's training statistics."""
    from riskspark.operators.scale import scale_by_fold
    cols = ["totalprice", "acctbal"]
    df = _fold_rows(spark, sf)
    rep = scale_by_fold(df.select("id", "fold", *cols), cols, _scalers(df, cols))
    return rep.select(F.col("for_fold").cast("bigint").alias("fold"), "id", _bool_int("is_val").alias("is_val"),
                      *[r6(c).alias(c) for c in cols])


def class_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """D12 for the training part of each fold."""
    from riskspark.operators.losses import fold_class_ratios
    out = fold_class_ratios(_fold_rows(spark, sf))
    return out.select(F.col("fold").cast("bigint").alias("fold"), "n_neg", "n_pos", r6("ratio").alias("ratio"))


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = order_risk(spark, sf)
    return df.groupBy("split", "label").agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        "split", F.col("label").cast("bigint").alias("label"), "n")



# ------------------------------------------------------------------ D1-D12 with fixed weights

# The literal model the loss / gradient queries score.
LINE_W = [0.1, -0.2, 0.3, 0.05]
LINE_X = ["x0", "x1", "x2", "x3"]
GD_X = ["x0", "x1", "x2"]
GD_STEPS = 200


def _line_design(spark, sf) -> DataFrame:
    """Intercept, quantity / 50, discount * 10, price / 100000 and y = label."""
    df = line_num(spark, sf)
    return df.select("key", F.lit(1.0).alias("x0"), (F.col("quantity") / 50.0).alias("x1"),
                     (F.col("discount") * 10.0).alias("x2"), (F.col("price") / 100000.0).alias("x3"),
                     F.col("label").cast("double").alias("y"))


def _loss_query(kind):
    def run(spark, sf):
        from riskspark.operators import losses
        return losses.loss(_line_design(spark, sf), kind, LINE_X, LINE_W).select(r6("loss").alias("loss"))
    return run


def _grad_query(kind):
    def run(spark, sf):
        from riskspark.operators import losses
        out = losses.gradient(_line_design(spark, sf), kind, LINE_X, LINE_W)
        return out.select("j", r6("grad").alias("grad"))
    return run


mse_loss = _loss_query("mse")
mse_balanced_loss = _loss_query("mse_balanced")
logistic_loss = _loss_query("logistic")
logistic_balanced_loss = _loss_query("logistic_balanced")
mse_gradient = _grad_query("mse")
mse_balanced_gradient = _grad_query("mse_balanced")
logistic_gradient = _grad_query("logistic")
logistic_balanced_gradient = _grad_query("logistic_balanced")


# ------------------------------------------------------------------ E1-E8, Gram

def _terms(spark, w, loss) -> DataFrame:
    rows = [(f"w{j}", float(v)) for j, v in enumerate(w)] + [("loss", float(loss))]
    return spark.createDataFrame(rows, "term string, value double").select("term", r6("value").alias("value"))


def gram_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """X^T X of the embedding dimensions over all rows: (i, j, value)."""
    from riskspark.operators.moments import gram_by_key
    from riskspark.sources.tables import emb
    wide = emb(spark, sf)
    dims = [c for c in wide.columns if c not in ("id", "split", "label")]
    df = wide.select(encode.assemble(dims), F.col("label").cast("double").alias("y"))
    Z = gram_by_key(df, "x", "y", len(dims))[0]
    rows = [(i, j, float(Z[i, j])) for i in range(len(dims)) for j in range(len(dims))]
    out = spark.createDataFrame(rows, "i bigint, j bigint, value double")
    return out.select("i", "j", r6("value").alias("value"))


def _line_gram(spark, sf, cols):
    from riskspark.operators.moments import gram_by_key
    df = _line_design(spark, sf).select(encode.assemble(cols), "y")
    Z = gram_by_key(df, "x", "y", len(cols))[0]
    d = len(cols)
    return Z[:d, :d], Z[:d, d], Z[d, d], Z[0, 0]


def least_squares(spark: SparkSession, sf: str) -> DataFrame:
    from riskspark.operators import linear
    G, b, yy, n = _line_gram(spark, sf, ["x0", "x1"])
    w = linear.least_squares(G, b)
    return _terms(spark, w, linear.mse_from_gram(G, b, yy, n, w))


def least_squares_qr(spark: SparkSession, sf: str) -> DataFrame:
    """E4 without normal equations: triangular factors of the tasks' rows, merged in a tree."""
    from riskspark.operators import linear
    df = _line_design(spark, sf).select(encode.assemble(["x0", "x1"]), "y", F.lit(0).alias("fold"))
    R = linear.fold_factors(df, 2)[0]
    w, rss = linear.least_squares_qr(R)
    return _terms(spark, w, rss / (2.0 * float(R[:, 0] @ R[:, 0])))


def ridge(spark: SparkSession, sf: str) -> DataFrame:
    from riskspark.operators import linear
    G, b, yy, n = _line_gram(spark, sf, ["x0", "x1"])
    w = linear.ridge(G, b, n, 0.1)
    return _terms(spark, w, linear.mse_from_gram(G, b, yy, n, w))


def mse_gd(spark: SparkSession, sf: str) -> DataFrame:
    """200 steps, gamma 0.1, from one Gram pass."""
    from riskspark.operators import linear
    G, b, yy, n = _line_gram(spark, sf, GD_X)
    w = linear.gd_from_gram(G, b, n, 0.1, GD_STEPS)
    return _terms(spark, w, linear.mse_from_gram(G, b, yy, n, w))


def _gd_query(loss, gamma, lam=0.0, balance=None):
    def run(spark, sf):
        from riskspark.operators.gd import Task, fit_gd
        df = _line_design(spark, sf).select(encode.assemble(GD_X), "y", F.lit(0).alias("fold"))
        W, ls = fit_gd(df, len(GD_X), [Task(loss, gamma, lam, -1, balance)], GD_STEPS)
        return _terms(spark, W[:, 0], ls[0])
    return run


mse_gd_balanced = _gd_query("mse", 0.1, balance="residual_sign")
logistic_gd = _gd_query("logistic", 0.7)
logistic_gd_balanced = _gd_query("logistic", 0.7, balance="label")
logistic_gd_sigmoid_scale = _gd_query("logistic", 0.7, balance="sigmoid_scale")
logistic_l2 = _gd_query("logistic", 0.7, lam=0.1)

MINIBATCH_SIZE = 10000


def minibatch_gd(spark: SparkSession, sf: str) -> DataFrame:
    """E3 re-aimed: batches are hash buckets of about MINIBATCH_SIZE rows; step t
    uses batch t mod B."""
    from riskspark.operators.gd import batch_column, batch_schedule, fit_minibatch
    base = _line_design(spark, sf)
    n_rows = base.count()
    bcol, n_batches = batch_column(MINIBATCH_SIZE, n_rows, "batch", "key")
    df = base.select(encode.assemble(GD_X), "y", bcol.alias("batch"))
    return _terms(spark, *fit_minibatch(df, len(GD_X), batch_schedule(GD_STEPS, n_batches), 0.1))


# ------------------------------------------------------------------ F2, G1, G2

def _order_score(spark, sf) -> DataFrame:
    """A fixed linear score on raw order columns (NULL where the balance is unknown)."""
    df = order_risk(spark, sf)
    score = F.lit(-1.0) + F.col("totalprice") / 150000.0 + F.col("acctbal") / 10000.0
    return df.select("id", "split", "label", score.alias("score"))


def predict_threshold(spark: SparkSession, sf: str) -> DataFrame:
    from riskspark.operators.evaluate import predict
    return _order_score(spark, sf).select("id", "split", predict(F.col("score"), 0.0).alias("pred"))


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    from riskspark.operators import evaluate
    scored = _order_score(spark, sf).withColumn("pred", evaluate.predict(F.col("score"), 0.0))
    out = evaluate.confusion_metrics(scored, "label", "pred", ["split"])
    return out.select("split", "tp", "fn", "tn", "fp",
                      *[r6(c).alias(c) for c in ("accuracy", "recall", "fpr", "precision", "f1")])


def threshold_search(spark: SparkSession, sf: str) -> DataFrame:
    from riskspark.operators import evaluate
    out = evaluate.threshold_search(_order_score(spark, sf), "score", "label", 100, ["split"])
    return out.select("split", r6("threshold").alias("threshold"), r6("f1").alias("f1"))



# ------------------------------------------------------------------ G3-G9, A6

FULL_STEPS = 400
CV_SEARCH = 100
# The published grids of degrees and step sizes.
SWEEP_DEGREES = [1, 2, 3, 5, 7]
SWEEP_GAMMAS = [0.01, 0.016681005372000592, 0.027825594022071243, 0.046415888336127774, 0.0774263682681127,
                0.1291549665014884, 0.21544346900318834, 0.3593813663804626, 0.48, 0.5994842503189409, 0.7, 1.0]


def ablation_configs():
    from riskspark.plans.cv import ModelConfig as MC
    lr = dict(kind="mse_gd", max_iters=300, gamma=0.01)
    lg = dict(kind="logistic", max_iters=300, gamma=0.7)
    return [MC(**lr, name="LR", search=0, threshold=0.0),
            MC(**lr, balance="residual_sign", name="LR_balanced", search=0, threshold=0.0),
            MC(**lr, name="LR_th", search=100),
            MC(**lr, balance="residual_sign", name="LR_balanced_th", search=100),
            MC(**lg, balance="label", name="LogR", search=0, threshold=0.5),
            MC(**lg, balance="label", name="LogR_balanced", search=0, threshold=0.5),
            MC(**lg, name="LogR_th", search=1000),
            MC(**lg, balance="label", name="LogR_balanced_th", search=1000)]


def _cv_inputs(spark, sf, degree=1):
    from riskspark.plans import cv
    model = _order_cleaning(spark, sf)
    layout = model.layout.with_intercept()
    clean = model.transform(order_risk(spark, sf))
    if degree > 1:
        cont = layout.continuous
        clean = clean.select(*[c for c in clean.columns if c not in cont], *encode.poly_exprs(cont, degree))
        layout = layout.expanded(degree)
    return clean, layout, cv.prepare(clean, layout, K, SEED)


def _cv_run(spark: SparkSession, sf: str, which: str, degree: int = 1):
    from riskspark.plans import cv
    clean, layout, data = _cv_inputs(spark, sf, degree)
    if which == "flagship":
        configs, search = [cv.ModelConfig("logistic", FULL_STEPS, 0.7)], CV_SEARCH
    elif which == "degree":
        configs = [cv.ModelConfig("mse_gd", 200, 0.001, positions=degree_positions(layout, deg), name=f"degree{deg}")
                   for deg in SWEEP_DEGREES]
        search = 100
    elif which == "rate":
        configs, search = [cv.ModelConfig("logistic", 300, g) for g in SWEEP_GAMMAS], 100
    else:
        configs, search = ablation_configs(), 0
    res = cv.cross_validate(data, layout, configs, K, search_thresholds=search)
    return res, clean, layout, data


METRICS = ("accuracy", "recall", "fpr", "precision", "f1")


def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    """G3 flagship: spec cleaning, intercept, 20 % holdout, 5 folds with per-fold
    scaling, 400 steps of logistic GD (gamma 0.7), F1 threshold search over 100 points."""
    res = _cv_run(spark, sf, "flagship")[0]
    out = res.to_df(spark)
    return out.select("fold", *[r6(c).alias(c) for c in ("train_loss", "val_loss", "threshold") + METRICS])


def cross_validate_full(spark: SparkSession, sf: str) -> DataFrame:
    """G3 as a run that is stopped and goes on: 100 steps with a folder for its state, then all 400 in the same
    folder, which start at step 100; the same rows as ``cross_validate``."""
    import uuid
    from riskspark.plans import cv
    from riskspark.session import scratch_path
    _, layout, data = _cv_inputs(spark, sf)
    folder = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    for steps in (100, FULL_STEPS):
        res = cv.cross_validate(data, layout, [cv.ModelConfig("logistic", steps, 0.7)], K, CV_SEARCH, resume=folder, save_every=50)
    out = res.to_df(spark)
    return out.select("fold", *[r6(c).alias(c) for c in ("train_loss", "val_loss", "threshold") + METRICS])


def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """G6 at full length: clean, 80/20 holdout, 5 folds of 400 steps, threshold search, averaged
    model, test predictions written as CSV; the file's rows."""
    from riskspark.plans import end_to_end as plan
    return plan.run(spark, sf, steps=FULL_STEPS, gamma=0.7, search=CV_SEARCH, k=K, seed=SEED).predictions


def _averaged_scorer(spark, sf, which="flagship"):
    from riskspark.plans.models import LinearScorer
    res, clean, layout, data = _cv_run(spark, sf, which)
    w, thr, mu, sd = res.average(0)
    return LinearScorer(layout, w, mu, sd, logistic=True, threshold=thr), res, clean, layout, data


def fold_average(spark: SparkSession, sf: str) -> DataFrame:
    """Fold-averaged weights, threshold, means and stds."""
    res, _, layout, _ = _cv_run(spark, sf, "flagship")
    w, thr, mu, sd = res.average(0)
    rows = [(f"w{j}", float(v)) for j, v in enumerate(w)] + [("threshold", thr)]
    rows += [(f"mean_{c}", float(v)) for c, v in zip(layout.continuous, mu)]
    rows += [(f"std_{c}", float(v)) for c, v in zip(layout.continuous, sd)]
    return spark.createDataFrame(rows, "term string, value double").select("term", r6("value").alias("value"))


def holdout_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The averaged model on the held-out 20 % of the training split."""
    from riskspark.operators import evaluate
    scorer, _, _, _, data = _averaged_scorer(spark, sf)
    scored = scorer.transform(data.filter(F.col("holdout")).withColumn("label", F.col("y").cast("int")))
    out = evaluate.confusion_metrics(scored, "label", "prediction")
    return out.select("tp", "fn", "tn", "fp", *[r6(c).alias(c) for c in METRICS])


def submission(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of the averaged model for the test split, written by
    the submission sink (validated, timestamped CSV folder in the shared scratch
    area) and read back as (Id, Prediction)."""
    import uuid
    from riskspark.session import scratch_path
    from riskspark.sources.sink import write_submission
    scorer, _, clean, _, _ = _averaged_scorer(spark, sf)
    scored = scorer.transform(clean.filter(F.col("split") == "test"))
    preds = scored.select(F.col("id").alias("Id"), F.col("prediction").alias("Prediction"))
    path = write_submission(preds, scratch_path(spark, f"submissions-{uuid.uuid4().hex}"))
    return spark.read.option("header", True).schema("Id BIGINT, Prediction INT").csv(path)


def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """G5 on a stream: half of the test rows arrive as files and are scored, the others arrive later and are scored
    into the same folder by a second query with the same checkpoint; model: MSE descent, averaged over folds."""
    import uuid

    from riskspark.plans import cv
    from riskspark.plans.models import LinearScorer
    from riskspark.session import scratch_path
    from riskspark.streaming.scoring import parquet_stream, score_available
    cleaning = _order_cleaning(spark, sf)
    df = order_risk(spark, sf)
    layout = cleaning.layout.with_intercept()
    data = cv.prepare(cleaning.transform(df), layout, K, SEED)
    res = cv.cross_validate(data, layout, [cv.ModelConfig("mse_gd", FULL_STEPS, 0.1)], K, CV_SEARCH)
    w, thr, mu, sd = res.average(0)
    # intercept column: a literal of the scorer, so the cleaning model's own columns are enough
    scorer = LinearScorer(layout, w, mu, sd, logistic=False, threshold=thr)
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    test = df.filter(F.col("split") == "test")
    test.filter(F.col("id") % 2 == 0).repartition(3).write.parquet(f"{base}/in")
    stream = parquet_stream(spark, f"{base}/in", df.schema)
    score_available(stream, cleaning, scorer, f"{base}/out", f"{base}/checkpoint")
    test.filter(F.col("id") % 2 != 0).repartition(2).write.mode("append").parquet(f"{base}/in")
    score_available(stream, cleaning, scorer, f"{base}/out", f"{base}/checkpoint")
    scored = spark.read.schema("id bigint, score double, prediction int").parquet(f"{base}/out")
    return scored.select("id", r6("score").alias("score"), F.col("prediction").cast("bigint").alias("prediction"))


def _means(res, config=0):
    rs = [r for r in res.folds if r.config == config]
    return {k: float(np.mean([r.metrics[k] for r in rs])) for k in METRICS} | {
        "train_loss": float(np.mean([r.train_loss for r in rs])),
        "val_loss": float(np.mean([r.val_loss for r in rs])),
        "threshold": float(np.mean([r.threshold for r in rs]))}


def degree_positions(layout, degree: int) -> tuple:
    """Positions of the degree-``degree`` layout inside a higher-degree layout."""
    return tuple(p for p, fc in enumerate(layout.columns)
                 if fc.kind != "continuous" or (fc.value or 1) <= degree)


def degree_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Polynomial degree x 5-fold CV of MSE GD (200 steps, gamma 0.001).
    One Gram pass at the highest degree serves every degree (sub-matrices) and
    one evaluation pass scores all degrees and folds."""
    res, _, layout, _ = _cv_run(spark, sf, "degree", max(SWEEP_DEGREES))
    rows = []
    for ci, deg in enumerate(SWEEP_DEGREES):
        m = _means(res, ci)
        w = res.average(ci)[0]
        rows.append((deg, m["train_loss"], m["val_loss"], m["f1"], m["accuracy"], m["threshold"],
                     float(np.linalg.norm(w))))
    cols = ["train_loss", "val_loss", "f1", "accuracy", "threshold", "weights_norm"]
    out = spark.createDataFrame(rows, "degree bigint, " + ", ".join(f"{c} double" for c in cols))
    return out.select("degree", *[r6(c).alias(c) for c in cols])


def rate_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Step-size grid x 5 folds, all trained in the same passes."""
    res = _cv_run(spark, sf, "rate")[0]
    rows = [(g, *[_means(res, ci)[k] for k in ("f1", "accuracy", "threshold")]) for ci, g in enumerate(SWEEP_GAMMAS)]
    out = spark.createDataFrame(rows, "gamma double, f1 double, accuracy double, threshold double")
    return out.select(r6("gamma").alias("gamma"), *[r6(c).alias(c) for c in ("f1", "accuracy", "threshold")])


def ablation(spark: SparkSession, sf: str) -> DataFrame:
    """{linear, logistic} x {none, balanced, threshold, both}, 5-fold means."""
    res = _cv_run(spark, sf, "ablation")[0]
    rows = [(c.name, *[_means(res, ci)[k] for k in ("f1", "accuracy", "threshold")])
            for ci, c in enumerate(res.configs)]
    out = spark.createDataFrame(rows, "config string, f1 double, accuracy double, threshold double")
    return out.select("config", *[r6(c).alias(c) for c in ("f1", "accuracy", "threshold")])



# ------------------------------------------------------------------ G11, C6, A4/A5, F9

MODEL_STEPS = 50
CORR_FEATURES = ["totalprice", "acctbal", "ordermonth", "regionkey"]


def label_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson correlation of each numeric column with the label, on the
    training part only (holdout and test rows excluded, so nothing leaks)."""
    df = _fold_rows(spark, sf)
    agg = df.agg(*[F.corr(F.col(c), F.col("label").cast("double")).alias(c) for c in CORR_FEATURES])
    return agg.unpivot([], CORR_FEATURES, "feature", "corr").select("feature", r6("corr").alias("corr"))


def split_scale(spark: SparkSession, sf: str) -> DataFrame:
    """One seeded 80/20 split of the training part, continuous columns
    scaled with the training side's mean and population std."""
    cols = ["totalprice", "acctbal"]
    train, val, _ = _two_column_dataset(spark, sf, cols).split_data(0.8)
    both = train.withColumn("part", F.lit("train")).unionByName(val.withColumn("part", F.lit("val")))
    return both.select("id", "part", *[r6(c).alias(c) for c in cols])


def _two_column_dataset(spark: SparkSession, sf: str, cols):
    from riskspark.operators.clean import FeatureColumn, FeatureLayout
    from riskspark.plans.dataset import Dataset
    layout = FeatureLayout([FeatureColumn(c, "continuous", c) for c in cols])
    return Dataset(order_risk(spark, sf).select("id", "split", "label", *cols), layout, SEED, K, SEED)


def test_set(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out rows of the training split, unscaled."""
    cols = ["totalprice", "acctbal"]
    rows = _two_column_dataset(spark, sf, cols).get_test_set()
    return rows.select("id", F.col("y").cast("bigint").alias("label"), *[r6(c).alias(c) for c in cols])


def dataset_len(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the training part."""
    return spark.createDataFrame([(len(_two_column_dataset(spark, sf, ["totalprice"])),)], "n bigint")


def auto_impute(spark: SparkSession, sf: str) -> DataFrame:
    """An automatic column that turns out continuous has its missing cells filled with the mean of their split."""
    from riskspark.operators.clean import CleaningEstimator
    from riskspark.sources.spec import spec_from_list
    df = line_num(spark, sf).select("key", "split", "label", "price", "qty_low")
    specs = spec_from_list([{"id": c, "description": c, "type": "auto"} for c in ("price", "qty_low")])
    model = CleaningEstimator(specs, threshold=0.5, id_col="key").fit(df)
    return model.transform(df).select("key", "split", r6("price").alias("price"), r6("qty_low").alias("qty_low"))


def saved_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """A4, A5, F1: cleaning and scorer as a pipeline model, saved, loaded and applied to the test split."""
    import uuid

    from pyspark.ml import PipelineModel

    from riskspark.plans.models import LinearScorer
    from riskspark.session import scratch_path
    model = _order_cleaning(spark, sf)
    layout = model.layout
    cont = layout.continuous
    # a fixed model: every weight a tenth of its position, columns scaled by a power of ten (six decimals in all)
    scorer = LinearScorer(layout, np.arange(len(layout.names)) / 10.0, np.zeros(len(cont)), np.full(len(cont), 1e3), logistic=False, threshold=0.5)
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    PipelineModel([model, scorer]).save(path)
    scored = PipelineModel.load(path).transform(order_risk(spark, sf).filter(F.col("split") == "test"))
    return scored.select("id", r6("score").alias("score"), F.col("prediction").cast("bigint").alias("prediction"))


def degree_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The degree sweep as a table of grid points that is run twice: three degrees first, then all
    five, of which three are there already; the table is written as CSV and read back."""
    import uuid

    from riskspark.plans import cv
    from riskspark.plans.grid import GridTable, run_grid
    from riskspark.session import scratch_path
    from riskspark.sources.sink import write_results
    _, layout, data = _cv_inputs(spark, sf, max(SWEEP_DEGREES))
    configs = [cv.ModelConfig("mse_gd", 200, 0.001, positions=degree_positions(layout, deg), name=str(deg)) for deg in SWEEP_DEGREES]
    folder = scratch_path(spark, f"grid-{uuid.uuid4().hex}")
    table = GridTable(spark, f"{folder}/points")
    run_grid(data, layout, configs[:3], table, K, 100)
    points = run_grid(data, layout, configs, table, K, 100)
    cols = ["train_loss", "val_loss", "f1", "accuracy", "threshold", "weights_norm"]
    write_results(points.select(F.col("name").cast("bigint").alias("degree"), *cols), f"{folder}/results.csv")
    out = spark.read.option("header", True).schema("degree bigint, " + ", ".join(f"{c} double" for c in cols)).csv(f"{folder}/results.csv")
    return out.select("degree", *[r6(c).alias(c) for c in cols])


def clean_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A4 / A5: write the cleaned table and its layout to the shared checkpoint
    folder, read it back, and summarise every layout column."""
    import uuid
    from riskspark.session import scratch_path
    from riskspark.sources.snapshot import load_snapshot, save_snapshot
    model = _order_cleaning(spark, sf)
    path = scratch_path(spark, f"snapshot-{uuid.uuid4().hex}")
    save_snapshot(model.transform(order_risk(spark, sf)), model.layout, path)
    rows, layout = load_snapshot(spark, path)
    agg = rows.agg(*[F.avg(c).alias(c) for c in layout.names])
    return (agg.unpivot([], layout.names, "feature", "mean")
            .select("feature", r6("mean").alias("mean")))


def ridge_score(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge (lambda 0.1) fitted on the train split, ``score`` on the test
    split = MSE + lambda * ||w||^2."""
    from riskspark.operators import linear
    from riskspark.operators.moments import gram_by_key
    base = line_num(spark, sf).select(
        "split", F.lit(1.0).alias("x0"), (F.col("quantity") / 50.0).alias("x1"), F.col("label").cast("double").alias("y"))
    df = base.select(encode.assemble(["x0", "x1"]), "y", F.when(F.col("split") == "train", 0).otherwise(1).alias("part"))
    grams = gram_by_key(df, "x", "y", 2, "part")
    Zt, Zs = grams[0], grams[1]
    w = linear.ridge(Zt[:2, :2], Zt[:2, 2], Zt[0, 0], 0.1)
    mse = linear.mse_from_gram(Zs[:2, :2], Zs[:2, 2], Zs[2, 2], Zs[0, 0], w)
    return _terms(spark, w, mse + 0.1 * float(w @ w))



def model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every model class fitted on the training rows (intercept and scaled totalprice, gradient
    descent from given weights) and scored on the holdout."""
    from riskspark.operators.clean import FeatureColumn, FeatureLayout
    from riskspark.plans import cv, models
    layout = FeatureLayout([FeatureColumn("totalprice", "continuous", "totalprice")]).with_intercept()
    data = cv.prepare(order_risk(spark, sf).select("id", "split", "label", "totalprice"), layout, K, SEED)
    start = dict(max_iters=MODEL_STEPS, initial_w=[0.5, -0.5])
    rows = []
    for name, model in (("least_squares", models.LeastSquares()), ("ridge", models.RidgeRegression(0.1)),
                        ("mse_gd", models.MSEGradientDescent(gamma=0.1, **start)),
                        ("logistic", models.LogisticRegressionGD(gamma=0.7, **start)),
                        ("reg_logistic", models.RegularizedLogisticRegressionGD(0.1, gamma=0.7, **start))):
        w, loss = model.fit(data, layout)
        rows.append((name, float(w[0]), float(w[1]), float(loss), model.score(data.filter("holdout"), "y")))
    cols = ["w0", "w1", "train_loss", "score"]
    out = spark.createDataFrame(rows, "model string, " + ", ".join(f"{c} double" for c in cols))
    return out.select("model", *[r6(c).alias(c) for c in cols])


def _doc_cv(spark: SparkSession, sf: str):
    from riskspark.operators.clean import CleaningEstimator
    from riskspark.plans import cv
    from riskspark.sources.tables import doc_risk
    df = doc_risk(spark, sf)
    model = CleaningEstimator(_spec(spark, "doc_risk")).fit(df)
    layout = model.layout.with_intercept()
    data = cv.prepare(model.transform(df), layout, K, SEED)
    return cv.cross_validate(data, layout, [cv.ModelConfig("mse_gd", FULL_STEPS, 0.1)], K,
                             search_thresholds=CV_SEARCH)


def doc_cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    """G3 on documents x labels: auto-typed language, 20 sources one-hot, per-fold
    scaled length, MSE gradient descent from one Gram pass, F1 threshold search."""
    out = _doc_cv(spark, sf).to_df(spark)
    return out.select("fold", *[r6(c).alias(c) for c in ("train_loss", "val_loss", "threshold") + METRICS])



EVENT_FEATURES = ["value", "k", "hour"]


def event_scale_fit(spark: SparkSession, sf: str) -> DataFrame:
    """C4 on events (value, the JSON field k, hour): per-fold training mean and
    population std from one grouped job, complements merged on the driver."""
    from riskspark.sources.tables import event_num
    df = event_num(spark, sf).filter(F.col("split") == "train").filter(~split.holdout_column(0.8, SEED))
    sc = _scalers(df.withColumn("fold", split.fold_column(K, SEED)), EVENT_FEATURES)
    rows = [(int(i), c, float(sc[i][0][j]), float(sc[i][1][j])) for i in range(K) for j, c in enumerate(EVENT_FEATURES)]
    out = spark.createDataFrame(rows, "fold bigint, feature string, mean double, std double")
    return out.select("fold", "feature", r6("mean").alias("mean"), r6("std").alias("std"))



CSV_FEATURES = ["totalprice", "acctbal", "ordermonth", "regionkey"]


def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """A1: write the orders table in the three-file CSV layout (x_train, y_train,
    x_test; missing balances as empty cells) to the shared scratch folder, read
    it back with ``load_csv_data`` (text + try_cast, labels joined on id) and
    summarise each split."""
    import uuid
    from riskspark.session import scratch_path
    from riskspark.sources.csv_source import load_csv_data
    df = order_risk(spark, sf)
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    feats = [F.col("id").alias("Id"), *CSV_FEATURES]
    train, test = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    train.select(*feats).write.option("header", True).csv(f"{base}/x_train.csv")
    train.select(F.col("id").alias("Id"), F.col("label").alias("Prediction")).write.option("header", True) \
        .csv(f"{base}/y_train.csv")
    test.select(*feats).write.option("header", True).csv(f"{base}/x_test.csv")
    loaded = load_csv_data(spark, base)
    return loaded.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count("label").cast("bigint").alias("n_labels"),
        F.count_if(F.col("label") == 1).cast("bigint").alias("n_pos"),
        F.count_if(F.col("acctbal").isNull()).cast("bigint").alias("n_missing_acctbal"),
        *[r6(F.avg(c)).alias(f"mean_{c}") for c in CSV_FEATURES])



def exact_stride_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A3 exact mode: rows at positions 0, 50, 100, ... of the permutation of the
    training split ordered by md5 key (exact rank, no global window)."""
    return split.exact_stride_sample(_train_rows(spark, sf).select("id", "label"), 50, "sample", "id")



EXACT_BATCH = 1000
SHUFFLED_BATCH, SHUFFLED_STEPS = 300, 20


def _batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _train_rows(spark, sf).select(
        "id", F.lit(1.0).alias("x0"), (F.col("totalprice") / 500000.0).alias("x1"),
        (F.col("ordermonth") / 12.0).alias("x2"), F.col("label").cast("double").alias("y"))


def minibatch_gd_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """E3 / D13 with shuffle: 20 steps over batches of 300 ranks of the seeded permutation that
    start anywhere (a drawn batch moved on by a drawn part of the remainder) and may overlap."""
    from riskspark.operators.gd import batch_starts, fit_minibatch_windows
    ranked = split.exact_rank(_batch_rows(spark, sf), "batch", "id")
    n = ranked.count()
    size = max(1, min(SHUFFLED_BATCH, n))
    design = ranked.select(encode.assemble(["x0", "x1", "x2"]), "y", "rank")
    return _terms(spark, *fit_minibatch_windows(design, 3, batch_starts(SHUFFLED_STEPS, n, size), size, 0.1))


def minibatch_gd_exact(spark: SparkSession, sf: str) -> DataFrame:
    """E3 / D13 exact: mini-batch MSE GD over contiguous batches of 1,000 rows of
    the seeded permutation (step t uses batch t mod B, remainder never used);
    features: intercept, totalprice / 500000, ordermonth / 12."""
    from riskspark.operators.gd import batch_schedule, exact_batches, fit_minibatch
    batched, n_batches = exact_batches(_batch_rows(spark, sf), EXACT_BATCH, "batch", "id")
    cols = ["x0", "x1", "x2"]
    design = batched.select(encode.assemble(cols), "y", "batch")
    return _terms(spark, *fit_minibatch(design, 3, batch_schedule(GD_STEPS, n_batches), 0.1))


BATCH_EPOCH_STEPS = 60


def minibatch_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """E3 / D13 with logistic loss: 60 steps over a store of exact batches of 1,000 rows; a step reads its batch alone."""
    from riskspark.operators.batches import fit_batches, loss_of, write_batches
    from riskspark.operators.gd import Task, batch_schedule, exact_batches
    batched, n_batches = exact_batches(_batch_rows(spark, sf), EXACT_BATCH, "batch", "id")
    store = write_batches(batched.select(encode.assemble(["x0", "x1", "x2"]), "y", "batch"), 3, n_batches)
    task = Task("logistic", 0.5)
    w = fit_batches(store, task, batch_schedule(BATCH_EPOCH_STEPS, n_batches))
    return _terms(spark, w, loss_of(store, task, w))


QUERIES = {
    "null_profile": null_profile, "drop_sparse_columns": drop_sparse_columns,
    "spec_conformance": spec_conformance, "observed_conformance": observed_conformance, "vocab_conformance": vocab_conformance,
    "recode_chain": recode_chain, "range_bin": range_bin, "impute_mean_per_split": impute_mean_per_split,
    "auto_type": auto_type, "auto_vocab": auto_vocab, "wide_profile": wide_profile, "one_hot": one_hot, "drop_constant": drop_constant,
    "poly_expand": poly_expand, "add_intercept": add_intercept, "stride_sample": stride_sample,
    "holdout_split": holdout_split, "kfold_assign": kfold_assign, "exact_holdout": exact_holdout,
    "undersample": undersample, "scale_fit": scale_fit, "scale_apply_kfold": scale_apply_kfold,
    "class_ratio": class_ratio, "label_counts": label_counts,
    "mse_loss": mse_loss, "mse_balanced_loss": mse_balanced_loss, "logistic_loss": logistic_loss,
    "logistic_balanced_loss": logistic_balanced_loss, "mse_gradient": mse_gradient,
    "mse_balanced_gradient": mse_balanced_gradient, "logistic_gradient": logistic_gradient,
    "logistic_balanced_gradient": logistic_balanced_gradient, "gram_matrix": gram_matrix,
    "least_squares": least_squares, "least_squares_qr": least_squares_qr, "ridge": ridge, "mse_gd": mse_gd, "mse_gd_balanced": mse_gd_balanced,
    "logistic_gd": logistic_gd, "logistic_gd_balanced": logistic_gd_balanced,
    "logistic_gd_sigmoid_scale": logistic_gd_sigmoid_scale, "logistic_l2": logistic_l2,
    "minibatch_gd": minibatch_gd, "predict_threshold": predict_threshold,
    "confusion_metrics": confusion_metrics, "threshold_search": threshold_search,
    "cross_validate": cross_validate, "fold_average": fold_average, "holdout_metrics": holdout_metrics,
    "submission": submission, "degree_sweep": degree_sweep, "rate_sweep": rate_sweep, "ablation": ablation,
    "label_correlation": label_correlation, "split_scale": split_scale, "test_set": test_set, "dataset_len": dataset_len,
    "auto_impute": auto_impute, "stream_scores": stream_scores, "saved_pipeline": saved_pipeline, "degree_grid": degree_grid, "clean_snapshot": clean_snapshot,
    "ridge_score": ridge_score, "doc_cross_validate": doc_cross_validate, "event_scale_fit": event_scale_fit,
    "csv_load": csv_load, "exact_stride_sample": exact_stride_sample, "minibatch_gd_exact": minibatch_gd_exact,
    "cross_validate_full": cross_validate_full, "end_to_end": end_to_end, "kfold_exact": kfold_exact, "minibatch_gd_shuffled": minibatch_gd_shuffled, "minibatch_logistic": minibatch_logistic, "model_scores": model_scores,
}
