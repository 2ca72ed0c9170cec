"""Prediction sink and experiment result tables."""

from __future__ import annotations

import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def submission_name(prefix: str = "", now: datetime.datetime | None = None) -> str:
    """``[prefix_]submission_YYYYmmdd_HHMMSS`` (the reference's naming rule)."""
    stamp = (now or datetime.datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"{prefix + '_' if prefix else ''}submission_{stamp}"


def check_predictions(df: DataFrame, col: str = "Prediction") -> None:
    """Reject anything outside {-1, 1} (one bounded probe, no collect of rows)."""
    bad = df.filter(~F.col(col).isin(-1, 1) | F.col(col).isNull()).limit(1).count()
    if bad:
        raise ValueError(f"column {col!r} holds labels other than -1 and 1")


def write_submission(df: DataFrame, folder: str, prefix: str = "", id_col: str = "Id",
                     pred_col: str = "Prediction") -> str:
    """Validate and write ``Id,Prediction`` CSV (header, integers) to a new,
    timestamped directory under ``folder``; an existing target is an error."""
    # rows are checked as they are written: the scoring plan runs once
    label = F.when(F.col(pred_col).isin(-1, 1), F.col(pred_col)).otherwise(
        F.raise_error(F.lit(f"column {pred_col!r} holds labels other than -1 and 1")))
    path = f"{folder.rstrip('/')}/{submission_name(prefix)}"
    rows = df.select(F.col(id_col).cast("bigint").alias("Id"), label.cast("int").alias("Prediction"))
    try:
        rows.write.mode("errorifexists").option("header", True).csv(path)
    except PySparkException as error:
        if "holds labels other than -1 and 1" in str(error):
            raise ValueError(f"column {pred_col!r} holds labels other than -1 and 1") from error
        raise
    return path


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One row per hyper-parameter point (small), written as CSV or Parquet."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
