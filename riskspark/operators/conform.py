"""Table-vs-spec conformance as grouped counts (never row collects)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.sources.spec import FeatureSpec


def outside_vocab(col: Column, vocab: Sequence) -> Column:
    """TRUE where a value is not in the vocabulary (missing allowed only if listed)."""
    present = [v for v in vocab if v is not None]
    allow_missing = any(v is None for v in vocab)
    inside = col.isin(*present) if present else F.lit(False)
    return F.when(col.isNull(), F.lit(not allow_missing)).otherwise(~inside)


def vocab_violations(df: DataFrame, column: str, vocab: Sequence, by: str = "split") -> DataFrame:
    """Values outside the vocabulary -> (column, split, value, n)."""
    col = F.col(column)
    return (df.filter(outside_vocab(col, vocab))
            .groupBy(by, col.alias("v")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .select(F.lit(column).alias("feature"), F.col(by).alias("split"),
                    F.col("v").cast("string").alias("value"), "n"))


def vocabulary_report(df: DataFrame, vocabs: dict, by: str = "split") -> DataFrame:
    """B12 for several columns from one scan: (feature, split, n_rows, n_values, low, high) of the
    values outside each vocabulary. A row's offending cells are exploded and grouped by value
    first (map-side combined), then counted per column, so the result has a row per column and split."""
    cells = F.filter(F.array(*[
        F.when(outside_vocab(F.col(c), v), F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")))
        for c, v in vocabs.items()]), lambda x: x.isNotNull())
    values = (df.select(F.col(by).alias("split"), F.explode(cells).alias("cell"))
              .groupBy("cell.feature", "split", "cell.value").agg(F.count("*").alias("n")))
    return values.groupBy("feature", "split").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_values"),
        F.min("value").alias("low"), F.max("value").alias("high"))


def check_vocabularies(df: DataFrame, vocabs: dict, by: str = "split") -> None:
    """B12 for several columns in one job: raise naming every column with values outside its
    vocabulary, with the exact number of rows and of different values and the value range."""
    if not vocabs:
        return
    rows = vocabulary_report(df, vocabs, by).collect()
    if rows:
        listing = "; ".join(f"{r['feature']} ({r['split']}): {r['n_rows']} rows, {r['n_values']} values "
                            f"from {r['low']!r} to {r['high']!r}" for r in sorted(rows, key=lambda r: (r["feature"], str(r["split"]))))
        raise ValueError(f"values outside the vocabulary: {listing}")


def check_vocabulary(df: DataFrame, column: str, vocab: Sequence, by: str = "split") -> None:
    """``check_vocabularies`` for one column."""
    check_vocabularies(df, {column: vocab}, by)


def spec_conformance(df: DataFrame, columns: Sequence[str], specs: Sequence[FeatureSpec],
                     by: str = "split") -> DataFrame:
    """B18 report per (column, split): covered by the spec, rows, missing cells,
    non-numeric cells, cells outside the vocabulary. One aggregate, then unpivot."""
    by_id = {s.id: s for s in specs}
    aggs = [F.count(F.lit(1)).cast("bigint").alias("__rows")]
    for c in columns:
        tests = _cell_tests(df, c, by_id.get(c))
        aggs += [F.count_if(t).cast("bigint").alias(f"{c}__{name}") for name, t in zip("mno", tests)]
    agg = df.groupBy(by).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(1 if c in by_id else 0).cast("bigint").alias("covered"),
                 F.col(f"{c}__m").alias("n_missing"), F.col(f"{c}__n").alias("n_non_numeric"),
                 F.col(f"{c}__o").alias("n_outside_vocab"))
        for c in columns]))
    return (agg.select(F.col(by).alias("split"), F.col("__rows").alias("n_rows"), rows.alias("s"))
            .select("s.feature", "split", "s.covered", "n_rows", "s.n_missing", "s.n_non_numeric",
                    "s.n_outside_vocab"))


def _cell_tests(df: DataFrame, column: str, spec: FeatureSpec | None) -> tuple[Column, Column, Column]:
    """(missing, not a number, outside the vocabulary) of one column's cells."""
    col = F.col(column)
    non_num = col.isNotNull() & col.try_cast("double").isNull() if dict(df.dtypes)[column] == "string" else F.lit(False)
    listed = spec is not None and spec.type == "categorical" and spec.vocabulary is not None
    return col.isNull(), non_num, outside_vocab(col, spec.vocabulary) if listed else F.lit(False)


class ObservedConformance:
    """B12, B18 counted while other work reads the rows: no scan of their own.

    ``watch(df)`` returns ``df`` with observed metrics; ``report()`` waits for the action that consumes
    it and gives the rows of ``spec_conformance``. Counts are per partition of the stage that the frame is
    used in and are taken from tasks that succeed, once each, so failed and speculative attempts do not count. A
    stage whose finished output is lost later and computed again would be counted again: watch a
    frame whose action writes it without a shuffle in between (as the cleaning projection does), where
    the job ends with the tasks that were counted. Groups are the given ``splits``; rows of any
    other split are counted under null."""

    def __init__(self, columns: Sequence[str], specs: Sequence[FeatureSpec], splits: Sequence[str] = ("train", "test"), by: str = "split"):
        from pyspark.sql import Observation
        self.columns, self.splits, self.by = list(columns), list(splits), by
        self.specs = {s.id: s for s in specs}
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        groups = [F.coalesce(F.col(self.by) == F.lit(s), F.lit(False)) for s in self.splits]
        rest = F.lit(True)
        for g in groups:
            rest = rest & ~g
        metrics = []
        for i, group in enumerate([*groups, rest]):
            metrics.append(F.count_if(group).alias(f"{i}_rows"))
            for j, c in enumerate(self.columns):
                metrics += [F.count_if(group & t).alias(f"{i}_{j}_{name}") for name, t in zip("mno", _cell_tests(df, c, self.specs.get(c)))]
        return df.observe(self.observation, *metrics)

    def report(self, spark) -> DataFrame:
        got = self.observation.get
        rows = [(c, s, int(c in self.specs), got[f"{i}_rows"], *[got[f"{i}_{j}_{name}"] for name in "mno"])
                for i, s in enumerate([*self.splits, None]) if got[f"{i}_rows"] for j, c in enumerate(self.columns)]
        return spark.createDataFrame(rows, "feature string, split string, covered bigint, n_rows bigint, n_missing bigint, "
                                           "n_non_numeric bigint, n_outside_vocab bigint")


def uncovered_columns(columns: Sequence[str], specs: Sequence[FeatureSpec]) -> list[str]:
    ids = {s.id for s in specs}
    return [c for c in columns if c not in ids]
