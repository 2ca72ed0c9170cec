"""Column profiles computed as one grouped aggregate per job.

All statistics here are O(columns x splits) in size; rows never reach the
driver. Wide tables are profiled in chunks of columns so a single aggregate
stays well inside whole-stage-codegen limits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 150  # columns per aggregate job


def _chunks(cols: Sequence[str], size: int = CHUNK):
    for i in range(0, len(cols), size):
        yield list(cols[i:i + size])


def _floating(df: DataFrame) -> set:
    return {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}


def _missing(c: str, floating: set):
    # NaN is normalised to NULL at the source; a stray NaN still counts as missing.
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if c in floating else col.isNull()


def missing_ratio(df: DataFrame, columns: Sequence[str], by: str = "split") -> DataFrame:
    """B1: share of missing cells per column and split -> (split, column, missing_ratio)."""
    floating = _floating(df)
    parts = []
    for chunk in _chunks(columns):
        agg = df.groupBy(by).agg(*[
            F.avg(_missing(c, floating).cast("double")).alias(c) for c in chunk])
        parts.append(agg.unpivot([by], chunk, "feature", "missing_ratio"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sparse_column_report(df: DataFrame, columns: Sequence[str], threshold: float = 0.1,
                         by: str = "split", splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """B2 decision table: a column is kept iff its missing ratio is <= threshold
    in every split. -> (column, train_ratio, test_ratio, kept)."""
    prof = missing_ratio(df, columns, by)
    wide = prof.groupBy("feature").pivot(by, list(splits)).agg(F.first("missing_ratio"))
    kept = F.lit(True)
    for s in splits:
        kept = kept & F.coalesce(F.col(s) <= F.lit(threshold), F.lit(True))
    return wide.select("feature", *[F.col(s).alias(f"{s}_ratio") for s in splits],
                       kept.alias("kept"))


def kept_columns(report: DataFrame, columns: Sequence[str]) -> list[str]:
    """Collect the (column-count sized) decision and keep the table's column order."""
    keep = {r["feature"] for r in report.filter("kept").select("feature").collect()}
    return [c for c in columns if c in keep]


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value): every cell as text, missing (NaN too) as NULL.

    A generated array, not an unpivot: the plan stays a narrow projection of the scan and
    whatever groups the result combines on the map side."""
    floating = _floating(df)
    # 0.0 is added so that -0.0 is the same value
    cells = [F.struct(F.lit(c).alias("feature"), F.when(~_missing(c, floating), F.col(c) + 0.0 if c in floating else F.col(c))
                      .cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.feature", "c.value")


def distinct_counts(df: DataFrame, columns: Sequence[str], train_filter=None) -> DataFrame:
    """B9 statistic: distinct values over the training rows, missing counted as
    one value -> (feature, n_distinct). Exact: one distinct of (feature, value) in long
    form, deduplicated on the map side, then a count per feature; rows are never
    multiplied by distinct sets, and no column gathers in one task before its values are distinct."""
    rows = df if train_filter is None else df.filter(train_filter)
    return (long_values(rows, columns).distinct().groupBy("feature")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct")))


def auto_kinds(df: DataFrame, columns: Sequence[str], max_categories: int = 10,
               train_filter=None) -> DataFrame:
    """``categorical`` if at most ``max_categories`` distinct training values
    (missing included), else ``continuous`` -> (feature, n_distinct, kind)."""
    counts = distinct_counts(df, columns, train_filter)
    kind = F.when(F.col("n_distinct") <= max_categories, "categorical").otherwise("continuous")
    return counts.select("feature", "n_distinct", kind.alias("kind"))


def value_sets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values over all splits, missing included, one row per
    (feature, value). Long form and ONE distinct (map-side
    dedup, then a single shuffle) for all columns; values are rendered as
    strings so numeric and text columns share one output, NULL is missing."""
    return long_values(df, columns).distinct()


def vocabulary(df: DataFrame, column: str, bound: int = 100_000) -> list:
    """Sorted distinct values of one column over all rows (None last).

    The list becomes one column per value, so ``bound`` (as ``CleaningEstimator.max_vocabulary``) is the
    width that an encoded column may have; a larger value set is an error, never a silent cut."""
    vals = [r[0] for r in df.select(column).distinct().limit(bound + 1).collect()]
    if len(vals) > bound:
        raise ValueError(f"column {column!r} has more than {bound} distinct values; not categorical")
    present = [v for v in vals if v is not None]
    return sorted(present) + ([None] if len(present) != len(vals) else [])


def constant_report(df: DataFrame, columns: Sequence[str], train_filter=None) -> DataFrame:
    """B14 decision, judged on training rows: a column is dropped iff it has no
    missing value and min == max -> (feature, min_value, max_value, n_missing,
    n_missing_all, kept). ``n_missing_all`` counts missing cells over every row
    (for the assembly check) in the same job."""
    train = F.lit(True) if train_filter is None else train_filter
    parts = []
    for chunk in _chunks(columns, 100):
        aggs = []
        for c in chunk:
            tc = F.when(train, F.col(c))
            aggs += [F.min(tc).cast("double").alias(f"{c}__min"), F.max(tc).cast("double").alias(f"{c}__max"),
                     F.count_if(train & F.col(c).isNull()).cast("bigint").alias(f"{c}__nm"),
                     F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}__na")]
        agg = df.agg(*aggs)
        stacked = agg.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min_value"),
                     F.col(f"{c}__max").alias("max_value"), F.col(f"{c}__nm").alias("n_missing"),
                     F.col(f"{c}__na").alias("n_missing_all"))
            for c in chunk])).alias("s")).select("s.*")
        parts.append(stacked)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    kept = ~((F.col("n_missing") == 0) & (F.col("min_value") == F.col("max_value")))
    return out.withColumn("kept", F.coalesce(kept, F.lit(True)))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def sparse_rows(spark, decisions: dict, threshold: float, splits: Sequence[str]) -> DataFrame:
    """The B2 table (feature, <split>_ratio, kept) of ``wide_profile.decide``'s decisions."""
    rows = [(d.name, *[d.missing.get(s) for s in splits], d.kept(threshold, splits)) for d in decisions.values()]
    return spark.createDataFrame(rows, "feature string, " + ", ".join(f"{s}_ratio double" for s in splits) + ", kept boolean")
