"""Prediction, confusion metrics and the F1 threshold search.

The threshold search never re-predicts per threshold: a score's bucket is the
number of grid thresholds strictly below it, so one grouped count of
(bucket, label) gives every threshold's confusion matrix through suffix sums
over at most n + 1 rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.columns import bucket_of_score, threshold_grid


def predict(score: Column, threshold: float = 0.0) -> Column:
    """F2: -1 where score <= threshold, else 1 (a NULL/NaN score gives 1)."""
    return F.when(score <= F.lit(float(threshold)), F.lit(-1)).otherwise(F.lit(1)).cast("int")


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def metrics_from_counts(tp: Column, fn: Column, tn: Column, fp: Column) -> list[Column]:
    n = tp + fn + tn + fp
    recall = _ratio(tp, tp + fn)
    precision = _ratio(tp, tp + fp)
    f1 = F.when(precision + recall > 0,
                F.lit(2.0) * (precision * recall) / (precision + recall)).otherwise(F.lit(0.0))
    return [_ratio(tp + tn, n).alias("accuracy"), recall.alias("recall"),
            _ratio(fp, fp + tn).alias("fpr"), precision.alias("precision"), f1.alias("f1")]


def confusion_metrics(df: DataFrame, label: str = "label", pred: str = "pred",
                      by: Sequence[str] = ()) -> DataFrame:
    """G1: counts and Accuracy, Recall, FPR, Precision, F1 (0 where undefined);
    any label other than -1 counts as positive."""
    y, p = F.col(label), F.col(pred)
    counts = df.groupBy(*by).agg(
        F.count_if((y != -1) & (p == 1)).cast("bigint").alias("tp"),
        F.count_if((y != -1) & (p == -1)).cast("bigint").alias("fn"),
        F.count_if((y == -1) & (p == -1)).cast("bigint").alias("tn"),
        F.count_if((y == -1) & (p == 1)).cast("bigint").alias("fp"))
    return counts.select(*by, "tp", "fn", "tn", "fp",
                         *metrics_from_counts(F.col("tp"), F.col("fn"), F.col("tn"), F.col("fp")))


def threshold_search(scored: DataFrame, score: str = "score", label: str = "label", n: int = 100,
                     by: Sequence[str] = (), lo: float = -1.0, hi: float = 1.0) -> DataFrame:
    """G2 as one job: per group, the first grid threshold with the best F1
    (0.0 when no threshold gives F1 > 0) -> (by..., threshold, f1)."""
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    y = F.col(label)
    hist = (scored.withColumn("b", bucket_of_score(F.col(score), n, lo, hi))
            .groupBy(*by, "b").agg(F.count_if(y != -1).alias("pos"), F.count_if(y == -1).alias("neg")))
    # thresholds only change the confusion counts at present buckets; threshold 0 always competes
    starts = hist.select(*by).distinct().select(*by, F.lit(0).alias("b"), F.lit(0).cast("bigint").alias("pos"),
                                                F.lit(0).cast("bigint").alias("neg"))
    cand = hist.unionByName(starts).groupBy(*by, "b").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    above = Window.partitionBy(*by).orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    tp = F.coalesce(F.sum("pos").over(above), F.lit(0))
    fp = F.coalesce(F.sum("neg").over(above), F.lit(0))
    ranked = (cand.withColumn("tp", tp).withColumn("fp", fp)
              .withColumn("fn", F.sum("pos").over(whole) - F.col("tp"))
              .withColumn("tn", F.sum("neg").over(whole) - F.col("fp"))
              .filter(F.col("b") <= n - 1)
              .select(*by, "b", *metrics_from_counts(F.col("tp"), F.col("fn"), F.col("tn"), F.col("fp"))))
    first_best = Window.partitionBy(*by).orderBy(F.col("f1").desc(), F.col("b").asc())
    best = ranked.withColumn("rk", F.row_number().over(first_best)).filter("rk = 1")
    thr = F.when(F.col("f1") > 0, F.col("b").cast("double") * F.lit(step) + F.lit(lo)).otherwise(F.lit(0.0))
    return best.select(*by, thr.alias("threshold"), "f1")


# ---------------------------------------------------------------- NumPy side

def _guarded(part, whole):
    """part / whole, element by element; 0 where whole is not positive."""
    part, whole = np.broadcast_arrays(np.asarray(part, float), np.asarray(whole, float))
    return np.divide(part, whole, out=np.zeros(part.shape), where=whole > 0)


def metrics_np(tp, fn, tn, fp) -> dict:
    """G1 from confusion counts: numbers, or arrays with one entry per threshold."""
    shares = {"accuracy": (tp + tn, tp + fn + tn + fp), "recall": (tp, tp + fn), "fpr": (fp, fp + tn),
              "precision": (tp, tp + fp), "f1": (2.0 * tp, 2.0 * tp + fn + fp)}
    found = {name: _guarded(*parts) for name, parts in shares.items()}
    return {name: float(v) if v.ndim == 0 else v for name, v in found.items()}


def best_threshold_from_hist(pos: np.ndarray, neg: np.ndarray, n: int, lo: float = -1.0, hi: float = 1.0):
    """G2 from bucket counts (len n + 1): (threshold, f1, counts at it); the first best one,
    or (0.0, 0.0, None) if no threshold gives a positive F1."""
    tp, fp = (np.append(np.cumsum(c[::-1])[::-1][1:], 0.0)[:n] for c in (pos, neg))  # above each threshold
    fn, tn = pos.sum() - tp, neg.sum() - fp
    f1 = metrics_np(tp, fn, tn, fp)["f1"] if n > 0 else np.zeros(1)
    at = int(np.argmax(f1))
    if f1[at] <= 0:
        return 0.0, 0.0, None
    return threshold_grid(n, lo, hi)[at], float(f1[at]), (tp[at], fn[at], tn[at], fp[at])
