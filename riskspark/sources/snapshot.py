"""A4, A5: save / load the cleaned state (rows + layout) as Parquet plus a
small JSON layout file in the same folder. Writing the snapshot also cuts the
lineage: training reads the files, not the cleaning plan."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskspark.operators.clean import FeatureLayout
from riskspark.session import scratch_path


def save_snapshot(df: DataFrame, layout: FeatureLayout, path: str, mode: str = "overwrite") -> None:
    spark = df.sparkSession
    df.write.mode(mode).parquet(f"{path.rstrip('/')}/rows")
    meta = spark.createDataFrame([(layout.to_json(), len(layout.names))], "layout string, n_features int")
    meta.coalesce(1).write.mode(mode).json(f"{path.rstrip('/')}/layout")


def load_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, FeatureLayout]:
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    meta = spark.read.json(f"{path.rstrip('/')}/layout").first()
    return rows, FeatureLayout.from_json(meta["layout"])


def stored_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh folder of the shared scratch area and read from there."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
