"""Modelling tables derived from the driver's Parquet tables.

Every builder returns the library's standard row shape::

    id BIGINT (or a key), split STRING ('train' | 'test'), label INT (+1 / -1), <features>

``split`` plays the role of the reference's separate train / test files: a
deterministic 20 % of keys (md5 key below 0.2 * 2^32) form the test part.
Missing values are made with plain expressions (negative balance, zero tax)
so that missing-value operators have something to do; the same expressions
exist as SQL in ``riskspark.queries.tables_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.hashing import fraction_cut, hash32

SPLIT_SEED = "split"
TEST_SHARE = 0.2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_column(*keys) -> Column:
    return (F.when(hash32(SPLIT_SEED, *keys) < F.lit(fraction_cut(TEST_SHARE)), F.lit("test"))
            .otherwise(F.lit("train")).alias("split"))


def label_column(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(-1)).cast("int").alias("label")


def order_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer x nation; label: urgent priority."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.select(
        F.col("o_orderkey").cast("bigint").alias("id"),
        split_column("o_orderkey"),
        label_column(F.col("o_orderpriority") == "1-URGENT"),
        F.col("o_totalprice").cast("double").alias("totalprice"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).cast("double").alias("acctbal"),
        F.month("o_orderdate").cast("double").alias("ordermonth"),
        F.col("o_orderstatus").alias("orderstatus"),
        F.col("c_mktsegment").alias("mktsegment"),
        F.col("n_regionkey").cast("double").alias("regionkey"),
    )


def line_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem; label: returned. ``(l_orderkey, l_linenumber)`` is not unique,
    so queries over this table are order-free aggregates or whole-row outputs."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        split_column("l_orderkey", "l_linenumber"),
        label_column(F.col("l_returnflag") == "R"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_extendedprice").cast("double").alias("price"),
        F.col("l_discount").cast("double").alias("discount"),
        F.when(F.col("l_tax") != 0.0, F.col("l_tax")).cast("double").alias("tax"),
        F.when(F.col("l_quantity") <= 40, F.col("l_quantity")).cast("double").alias("qty_low"),
        F.col("l_linestatus").alias("linestatus"),
    )


def doc_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents x labels; label: toxic."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").cast("bigint").alias("id"),
        split_column("doc_id"),
        label_column(F.col("toxic") == 1),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.col("lang"),
        F.col("source"),
    )


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as double columns e0, e1, ...; label: class 0. The length is the table's own."""
    e = read_table(spark, sf_dir, "embeddings")
    sizes = e.agg(F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")).first()
    if sizes["low"] != sizes["high"]:
        raise ValueError(f"embeddings have between {sizes['low']} and {sizes['high']} components")
    return e.select(
        F.col("vec_id").cast("bigint").alias("id"),
        split_column("vec_id"),
        label_column(F.col("label") == 0),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(sizes["high"] or 0)],
    )


def event_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events; label: purchase."""
    ev = read_table(spark, sf_dir, "events")
    k = F.regexp_extract(F.col("props"), r'"k":\s*(-?[0-9.]+)', 1)
    return ev.select(
        F.col("event_id").cast("bigint").alias("id"),
        split_column("event_id"),
        label_column(F.col("event_type") == "purchase"),
        F.col("value").cast("double").alias("value"),
        F.when(k != "", k).cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
    )


# Shape of the published run: 321 columns, of which 182 miss more than 10 % of their cells, 95 of the
# others have 10 values at most and 44 are continuous; one label in ten is positive.
WIDE_SPARSE, WIDE_CATEGORICAL, WIDE_COLUMNS = 182, 95, 321


def wide_columns() -> list[str]:
    return [f"f{j}" for j in range(WIDE_COLUMNS)]


def wide_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem widened to 321 feature columns by integer arithmetic on its keys; label: quantity above 45.

    Column j misses a cell where (7 * orderkey + 13 * linenumber + partkey * (j % 11 + 1) + 29 * j) % 1000 lies
    below its share; u_j = ((2j + 1) * orderkey + 31 * linenumber + (j + 3) * partkey) % 1000 gives
    a categorical column u_j % (2 + j % 8), a continuous one quantity + u_j / 100. The
    id is not unique where lineitem repeats (orderkey, linenumber)."""
    li = read_table(spark, sf_dir, "lineitem")
    o, n, p = (F.col(c).cast("bigint") for c in ("l_orderkey", "l_linenumber", "l_partkey"))
    out = []
    for j, name in enumerate(wide_columns()):
        share = 150 + j * 17 % 700 if j < WIDE_SPARSE else j * 7 % 90
        gone = (7 * o + 13 * n + p * (j % 11 + 1) + 29 * j) % 1000 < share
        u = ((2 * j + 1) * o + 31 * n + (j + 3) * p) % 1000
        coded = WIDE_SPARSE <= j < WIDE_SPARSE + WIDE_CATEGORICAL or (j < WIDE_SPARSE and j % 2 == 0)
        value = (u % (2 + j % 8)).cast("double") if coded else F.col("l_quantity") + u / F.lit(100.0)
        out.append(F.when(~gone, value).alias(name))
    return li.select((o * 8 + n).alias("id"), split_column("l_orderkey", "l_linenumber"),
                     label_column(F.col("l_quantity") > 45), *out)


TABLE_BUILDERS = {
    "wide_risk": wide_risk,
    "order_risk": order_risk,
    "line_num": line_num,
    "doc_risk": doc_risk,
    "emb": emb,
    "event_num": event_num,
}
