"""Helpers shared by the document operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import scratch_path, ship_package

# ASCII white space, the word separators of every word-based operator
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and text (null text: empty). Other columns, whatever their names, stay behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def ready(spark: SparkSession) -> None:
    """Make this package importable in Python workers."""
    ship_package(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    Cuts the lineage with replicated-storage files rather than executor memory,
    so a lost executor costs nothing that is already written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_train(doc_id: Column, modulus: int, held: int) -> Column:
    """Rows whose crc32(doc_id as text) mod ``modulus`` is not ``held`` (null doc_id: never)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus != held, F.lit(False))


def held_out(doc_id: Column, modulus: int, held: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == held, F.lit(False))


def bounded_sample(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows at most, picked by a hash of ``key`` (all rows while there are fewer).

    The share is taken from an exact count, so the sample does not depend on partitioning."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * bound / n))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) by alternating large-star and small-star steps.

    Returns (node, component) for every node that is not its component's smallest.
    Every round is a grouped minimum and a join on the same key, written to the
    shared folder; nothing but two checksums per round reaches the driver. Links
    are contracted towards the minimum each round, so the number of edges never
    grows beyond its start.
    """
    spark = edges.sparkSession
    pair = (edges.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = written(pair, "edges")
    before = None
    for _ in range(max_rounds):
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if row.n == 0 or (row.n, row.h) == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = (row.n, row.h)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v"))
                 .where("u != v").distinct())
        e = written(small, "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
