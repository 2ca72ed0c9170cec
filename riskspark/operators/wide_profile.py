"""B2, B9 and B10 of wide tables from one scan.

A sketch per (split, column) holds the row count, the missing count and the ``k``
distinct values of least hash (a theta sketch that carries its values). Up to k distinct values it
is exact and complete, so it is the value set itself; beyond, the k-th hash gives an
estimate. Two sketches merge into the sketch of both row sets, in any order.

Each task folds its Arrow batches column by column and sends one row per (split,
column); rows are merged by key in two steps (first in groups of tasks), so no task sees
more than a bounded sketch per source row and the plan multiplies no input row
by the number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values that a sketch holds, and groups of tasks that are merged first.
K = 64
FAN = 64
_SCHEMA = "split string, feature string, task int, n long, n_missing long, more boolean, hashes array<long>, nums array<double>, ints array<long>, texts array<string>"
_KINDS = {"double": "nums", "float": "nums", "byte": "ints", "short": "ints", "integer": "ints", "long": "ints"}


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser with shifts and odd multipliers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(33))


def hash_values(values: np.ndarray) -> np.ndarray:
    """63-bit hashes of numbers or texts, the same in every task (0.0 and -0.0 are one value)."""
    if values.dtype == object:
        raw = pd.util.hash_array(values, categorize=False)
    elif values.dtype.kind == "f":
        raw = (values.astype(np.float64) + 0.0).view(np.uint64)
    else:
        raw = values.astype(np.int64).view(np.uint64)
    return _mix(raw) >> np.uint64(1)


class Sketch:
    """Counts and the ``k`` distinct values of least hash; ``more``: there are further ones."""

    __slots__ = ("k", "n", "n_missing", "more", "hashes", "values")

    def __init__(self, k: int, n: int = 0, n_missing: int = 0, more: bool = False, hashes=None, values=None):
        self.k, self.n, self.n_missing, self.more = k, n, n_missing, more
        self.hashes = np.zeros(0, np.uint64) if hashes is None else np.asarray(hashes).astype(np.uint64)
        self.values = np.zeros(0, object) if values is None else np.asarray(values)

    def add(self, values: np.ndarray, n_missing: int) -> None:
        """Fold in present values (repeats allowed) and a number of missing ones."""
        self.n += len(values) + n_missing
        self.n_missing += n_missing
        if not len(values):
            return
        if not self.more:
            values = pd.unique(values)
        hashes = hash_values(values)
        if self.more:  # only what is below the k-th hash can still change the sketch
            low = hashes < self.hashes[-1]
            hashes, values = hashes[low], values[low]
        self._hold(hashes, values)

    def _hold(self, hashes: np.ndarray, values: np.ndarray) -> None:
        if not len(hashes):
            return
        if not len(self.hashes):
            self.values = self.values.astype(values.dtype)
        hashes, first = np.unique(np.concatenate([self.hashes, hashes]), return_index=True)
        values = np.concatenate([self.values, values])[first]
        self.more |= len(hashes) > self.k
        self.hashes, self.values = hashes[:self.k], values[:self.k]

    def merge(self, other: "Sketch") -> None:
        self.n += other.n
        self.n_missing += other.n_missing
        self._hold(other.hashes, other.values)
        self.more |= other.more

    def distinct(self) -> int:
        """Distinct present values: exact unless ``more``, then estimated from the k-th hash."""
        if not self.more:
            return len(self.hashes)
        return int(round((self.k - 1) / (float(self.hashes[-1]) / 2.0 ** 63)))


def _row(split, feature: str, task: int, kind: str, s: Sketch) -> dict:
    # of an incomplete sketch, only the hashes matter from here on
    values = None if s.more else s.values.tolist()
    return {"split": split, "feature": feature, "task": task, "n": s.n, "n_missing": s.n_missing, "more": s.more,
            "hashes": s.hashes.astype(np.int64).tolist(), "nums": values if kind == "nums" else None,
            "ints": values if kind == "ints" else None, "texts": values if kind == "texts" else None}


def _present(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values with any filler for missing ones, mask of present ones); NaN is missing."""
    if kind == "texts":
        present = pc.is_valid(column).to_numpy(zero_copy_only=False)
        return column.to_numpy(zero_copy_only=False), present
    if kind == "nums":
        values = column.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
        return values + 0.0, ~np.isnan(values)
    present = pc.is_valid(column).to_numpy(zero_copy_only=False)
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64), present


def _kind_of(dtype) -> str:
    return _KINDS.get(dtype.typeName(), "texts")


def wide_profile(df: DataFrame, columns: Sequence[str], by: str = "split", k: int = K) -> DataFrame:
    """(split, feature, n, n_missing, n_distinct, exact, nums | ints | texts), one row per split value and column.

    n_distinct counts present values; it is exact, and the values are given, up to ``k`` of
    them, else it is an estimate (exact is false, no values). NaN is missing. Columns that are neither
    numbers nor texts are profiled by their text. A null split is a split of its own; an
    empty table gives no rows."""
    kinds = {f.name: _kind_of(f.dataType) for f in df.schema.fields if f.name in set(columns)}
    picked = [F.col(c).cast("string").alias(c) if kinds[c] == "texts" else F.col(c) for c in columns]
    # names of their own, so that a feature may be called like the split or the task column
    source = df.select(F.col(by).cast("string").alias("0"), *[p.alias(str(i + 1)) for i, p in enumerate(picked)],
                       F.spark_partition_id().alias("task"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Sketch] = {}
        task = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column(len(columns) + 1)[0].as_py()
            splits = batch.column(0).dictionary_encode()
            codes = pc.fill_null(splits.indices, -1).to_numpy(zero_copy_only=False)
            named = {-1: None, **dict(enumerate(splits.dictionary.to_pylist()))}
            groups = [(named[int(c)], codes == c) for c in np.unique(codes)]
            for i, name in enumerate(columns):
                values, present = _present(batch.column(i + 1), kinds[name])
                for split, rows in groups:
                    here = rows & present if len(groups) > 1 else present
                    found = values[here]
                    total = int(rows.sum()) if len(groups) > 1 else len(values)
                    held.setdefault((split, name), Sketch(k)).add(found, total - len(found))
        if held:
            yield pa.RecordBatch.from_pylist([_row(s, c, task, kinds[c], x) for (s, c), x in held.items()], schema=arrow)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Sketch] = {}
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["split"], r["feature"], r["task"] % FAN)
                kind = kinds[r["feature"]]
                values = r[kind] if r[kind] is not None else [0] * len(r["hashes"])
                dtype = {"nums": np.float64, "ints": np.int64, "texts": object}[kind]
                one = Sketch(k, r["n"], r["n_missing"], r["more"], r["hashes"], np.array(values, dtype=dtype))
                if key in held:
                    held[key].merge(one)
                else:
                    held[key] = one
        if held:
            yield pa.RecordBatch.from_pylist([_row(s, c, -FAN, kinds[c], x) for (s, c, _), x in held.items()], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(_SCHEMA))
    parts = source.mapInArrow(scan, _SCHEMA)
    near = parts.repartition("split", "feature", F.pmod("task", F.lit(FAN))).mapInArrow(merge, _SCHEMA)
    merged = near.repartition("split", "feature").mapInArrow(merge, _SCHEMA)
    theta = F.element_at("hashes", -1).cast("double") / F.lit(2.0 ** 63)
    distinct = F.when(F.col("more"), F.round(F.lit(float(k - 1)) / theta)).otherwise(F.size("hashes")).cast("long")
    return merged.select("split", "feature", "n", "n_missing", distinct.alias("n_distinct"), (~F.col("more")).alias("exact"),
                         "nums", "ints", "texts")


@dataclass
class ColumnDecision:
    """What the profile says about one column; ``values`` (all splits, missing last) only where they are complete."""

    name: str
    missing: dict[str, float | None]
    n_distinct: int
    kind: str
    values: list | None
    train_values: list | None = None  # those of the training rows, where they are complete

    def kept(self, threshold: float, splits: Sequence[str]) -> bool:
        """B2: no split's missing share lies above the threshold; a split without rows does not count."""
        return all(self.missing.get(s) is None or self.missing[s] <= threshold for s in splits)


def _values(rows: list) -> list | None:
    """Values of all given sketches in order, missing last; None if one of them is not complete."""
    if not all(r["exact"] for r in rows):
        return None
    found = sorted({v for r in rows for kind in ("nums", "ints", "texts") for v in (r[kind] or [])})
    return found + ([None] if any(r["n_missing"] for r in rows) else [])


def decide(profile: DataFrame, max_categories: int = 10, train_value: str = "train") -> dict[str, ColumnDecision]:
    """B2, B9, B10 per column from a ``wide_profile`` with k > max_categories.

    Collects a bounded sketch per split and column, whatever the number of rows. A column is categorical
    if its training rows have at most ``max_categories`` values, missing counted as one."""
    found: dict[str, list] = {}
    for r in profile.collect():
        found.setdefault(r["feature"], []).append(r)
    out = {}
    for name, rows in found.items():
        train = [r for r in rows if r["split"] == train_value]
        n = sum(r["n_distinct"] + (r["n_missing"] > 0) for r in train)
        kind = "categorical" if all(r["exact"] for r in train) and n <= max_categories else "continuous"
        values, train_values = _values(rows), _values(train)
        missing = {r["split"]: r["n_missing"] / r["n"] if r["n"] else None for r in rows}
        out[name] = ColumnDecision(name, missing, n, kind, values, train_values)
    return out
