"""Results of a grid of model settings, kept point by point.

A table in a shared folder holds one row per finished point and its key. A grid that is
run again, after a lost driver or with more points, skips what the table has; points are
trained together in groups, because they share their passes over the data."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import asdict

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from riskspark.operators.clean import FeatureLayout
from riskspark.plans import cv

METRICS = ("accuracy", "recall", "fpr", "precision", "f1")
SCHEMA = ("key string, name string, kind string, gamma double, lam double, max_iters int, balance string, train_loss double, "
          "val_loss double, threshold double, weights_norm double, " + ", ".join(f"{m} double" for m in METRICS))


def point_key(config: cv.ModelConfig, *context) -> str:
    """Key of a grid point: its settings and whatever else the caller says its result depends on."""
    return hashlib.sha256(repr((sorted(asdict(config).items(), key=lambda kv: kv[0]), context)).encode()).hexdigest()


class GridTable:
    """Rows of finished points, appended in committed writes of their own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """One row per finished point (a point that two drivers finished at once counts once)."""
        try:
            found = self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], SCHEMA)
        return found.dropDuplicates(["key"])

    def finished(self) -> set[str]:
        return {r.key for r in self.rows().select("key").collect()}

    def append(self, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def _point(res: cv.CVResult, i: int, key: str) -> tuple:
    own = [r for r in res.folds if r.config == i]
    c = res.configs[i]
    mean = lambda values: float(np.mean(list(values)))
    return (key, c.name, c.kind, float(c.gamma), float(c.lam), int(c.max_iters), c.balance, mean(r.train_loss for r in own),
            mean(r.val_loss for r in own), mean(r.threshold for r in own), float(np.linalg.norm(res.average(i)[0])),
            *[mean(r.metrics[m] for r in own) for m in METRICS])


def run_grid(data: DataFrame, layout: FeatureLayout, configs: Sequence[cv.ModelConfig], table: GridTable, k: int = 5,
             search_thresholds: int = 0, together: int = 12, context: Sequence = ()) -> DataFrame:
    """Means over folds of every point of the grid, by key; only points that ``table`` lacks are trained.

    ``together`` points are trained in the same passes and stored when they are done. ``context``: what a
    result depends on besides its settings (name of the data, seed, degree)."""
    keys = {point_key(c, k, search_thresholds, layout.names, *context): c for c in configs}
    done = table.finished()
    todo = [(key, c) for key, c in keys.items() if key not in done]
    for a in range(0, len(todo), together):
        group = todo[a:a + together]
        res = cv.cross_validate(data, layout, [c for _, c in group], k, search_thresholds)
        table.append([_point(res, i, key) for i, (key, _) in enumerate(group)])
    wanted = data.sparkSession.createDataFrame([(key,) for key in keys], "key string")
    return table.rows().join(wanted, "key", "left_semi")
