"""The means of a chain of mapping rules from one pass.

All keys and range ends of a column's rules cut its values into regions (missing, each end
point, each gap between two): whatever the chain does, it does to a whole region alike. One
grouped aggregate takes the sum and count of every region per split. The chain then runs over
the regions on the driver: a region holds its own values, a constant or nothing, and a mean
rule's mean is the total over the regions as they are at that step. Later levels need no further look
at the data, because a mean, once known, is a constant."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.sources.spec import Rule

#: Aggregates of one job; more columns than fit take further jobs.
AGGREGATES = 600
_FLOATS, _INTEGERS = ("double", "float"), ("int", "bigint", "smallint", "tinyint")


def _number(value) -> float | None:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


def cut_points(rules: Sequence[Rule]) -> list[float]:
    """Keys and range ends, ascending."""
    found = {_number(r.key) for r in rules if r.kind == "equal"} | {_number(v) for r in rules if r.kind == "range" for v in (r.lo, r.hi)}
    return sorted(p for p in found if p is not None)


def region_of(col: Column, points: Sequence[float]) -> Column:
    """Null if missing, else 0 .. 2 * len(points): odd numbers are the points, even ones the gaps around them."""
    region = F.lit(0)
    for p in points:
        region = region + (col > F.lit(p)).cast("int") + (col >= F.lit(p)).cast("int")
    return F.when(col.isNotNull(), region)


@dataclass
class Region:
    """Cells of one region in one split, at some step of the chain."""

    low: float          # of the values it started with: a point (low == high) or the open gap between
    high: float
    missing: bool
    count: int
    total: float
    own: bool           # still holds its own values
    value: float | None = None

    def hit(self, rule: Rule) -> bool:
        """Whether a rule's mask covers the region (wholly or not at all: its ends are cut points)."""
        if self.own and not self.missing:
            if rule.kind == "range":
                return rule.lo <= self.low and self.high <= rule.hi
            return rule.kind == "equal" and self.low == self.high == _number(rule.key)
        if self.value is None:
            return rule.kind == "missing"
        if rule.kind == "range":
            return rule.lo <= self.value <= rule.hi
        return rule.kind == "equal" and self.value == _number(rule.key)

    def part(self) -> tuple[int, float]:
        """(present cells, their sum) as the region is now."""
        if self.own and not self.missing:
            return self.count, self.total
        return (0, 0.0) if self.value is None else (self.count, self.count * self.value)


def _cast(value: float | None, dtype: str) -> float | None:
    """A number as the column's type stores it."""
    if value is None:
        return None
    if dtype in _INTEGERS:
        return float(int(value))
    return float(np.float32(value)) if dtype == "float" else float(value)


def solve(rules: Sequence[Rule], splits: Mapping[object, list[Region]], dtype: str, only: object = None) -> dict[int, dict]:
    """{rule position: {split: mean}} of the mean rules. ``only``: the split whose means count for all."""
    means: dict[int, dict] = {}
    for i, rule in enumerate(rules):
        if rule.is_mean:
            found = {}
            for split, regions in splits.items():
                parts = [r.part() for r in regions]
                n = sum(p[0] for p in parts)
                found[split] = sum(p[1] for p in parts) / n if n else None
            means[i] = {s: found.get(only) for s in found} if only is not None else found
        for split, regions in splits.items():
            for r in regions:
                if r.hit(rule):
                    new = means[i][split] if rule.is_mean else _number(rule.value)
                    r.own, r.missing, r.value = False, False, _cast(new, dtype)
    return means


def chain_means(df: DataFrame, column_rules: Mapping[str, Sequence[Rule]], by: str = "split", only: object = None) -> dict:
    """{(column, rule position): {split: mean}} of every mean rule, all levels of all columns from one job.

    (A job holds AGGREGATES sums and counts; wider tables take one job per so many.)"""
    dtypes = dict(df.dtypes)
    wanted = {c: rules for c, rules in column_rules.items() if any(r.is_mean for r in rules)}
    for c in wanted:
        if dtypes[c] not in _FLOATS + _INTEGERS:
            raise ValueError(f"'mean' mapping on non-numeric column {c!r}")
    out: dict = {}
    for group in _groups({c: cut_points(r) for c, r in wanted.items()}):
        aggs = []
        for c, points in group.items():
            region = region_of(F.col(c), points)
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__gone"))
            for k in range(2 * len(points) + 1):
                here = F.when(region == k, F.col(c).cast("double"))
                aggs += [F.count(here).alias(f"{c}__n{k}"), F.sum(here).alias(f"{c}__s{k}")]
        rows = df.groupBy(by).agg(*aggs).collect()
        for c, points in group.items():
            ends = [-np.inf, *points, np.inf]
            splits = {}
            for row in rows:
                regions = [Region(0.0, 0.0, True, row[f"{c}__gone"], 0.0, False)]
                for k in range(2 * len(points) + 1):
                    low, high = (points[k // 2],) * 2 if k % 2 else (ends[k // 2], ends[k // 2 + 1])
                    regions.append(Region(low, high, False, row[f"{c}__n{k}"], row[f"{c}__s{k}"] or 0.0, True))
                splits[row[by]] = regions
            for i, per_split in solve(wanted[c], splits, dtypes[c], only).items():
                out[c, i] = per_split
    return out


def _groups(points: Mapping[str, list[float]]) -> Iterator[dict]:
    group, size = {}, 0
    for c, p in points.items():
        width = 4 * len(p) + 3
        if group and size + width > AGGREGATES:
            yield group
            group, size = {}, 0
        group[c] = p
        size += width
    if group:
        yield group
