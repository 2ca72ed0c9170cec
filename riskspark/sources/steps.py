"""Weights of iterative runs by step, in a small table of a shared folder.

A row is (run, step, rows, columns, weights). Rows are only ever appended, each in its own
committed write, so a driver that dies in the middle of one leaves the earlier steps whole."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "run string, step int, n_rows int, n_columns int, weights array<double>"


def run_name(*parts) -> str:
    """Name of a run by everything that its steps depend on besides the data: equal settings, equal name."""
    def text(x) -> str:
        if isinstance(x, np.ndarray):
            return f"{x.shape}{x.astype(float).tobytes().hex()}"
        if isinstance(x, (list, tuple)):
            return "[" + ",".join(text(v) for v in x) + "]"
        return text([f"{k}={text(v)}" for k, v in sorted(vars(x).items())]) if hasattr(x, "__dict__") else repr(x)

    return hashlib.sha256(text(parts).encode()).hexdigest()


class StepTable:
    """``every``: steps between two stored ones."""

    def __init__(self, spark: SparkSession, path: str, every: int = 25):
        if every < 1:
            raise ValueError("every must be 1 or more")
        self.spark, self.path, self.every = spark, path, every

    def save(self, run: str, step: int, weights: np.ndarray) -> None:
        rows, columns = weights.shape
        values = [float(v) for v in weights.ravel()]
        frame = self.spark.createDataFrame([(run, step, rows, columns, values)], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def last(self, run: str, limit: int) -> tuple[int, np.ndarray] | None:
        """(step, weights) of the last stored step of ``run`` up to ``limit``; None if there is none."""
        try:
            rows = self.spark.read.schema(SCHEMA).parquet(self.path)
            row = rows.where((F.col("run") == run) & (F.col("step") <= limit)).orderBy(F.desc("step")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else (row.step, np.array(row.weights).reshape(row.n_rows, row.n_columns))
