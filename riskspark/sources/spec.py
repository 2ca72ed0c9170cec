"""The feature spec (a JSON list of feature entries).

Entry shape, every leaf a string::

    {"id": "age", "description": "...", "type": "continuous" | "categorical" | "auto" | "delete",
     "vocabulary": ["1", "2", "NaN"],            # categorical only
     "mapping": [["NaN", "mean"], ["50-100", "2"]]}

Keys: ``"NaN"`` (missing), ``"lo-hi"`` (inclusive range, signs allowed), or a
value. Values: ``"mean"`` (mean of the split at that step), ``"NaN"``, or a
value. Numbers are parsed as DOUBLE; other strings stay text so string
categories are supported as well.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The feature kinds a spec may name.
KINDS = ("continuous", "categorical", "auto", "delete")
MISSING_TOKEN = "NaN"
MEAN_TOKEN = "mean"

_NUM = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_RANGE = re.compile(rf"^\s*({_NUM})\s*-\s*({_NUM})\s*$")

SPEC_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("vocabulary", T.ArrayType(T.StringType())),
    T.StructField("mapping", T.ArrayType(T.ArrayType(T.StringType()))),
])


class Mean:
    """Marker for a ``"mean"`` mapping value."""

    def __repr__(self) -> str:
        return "MEAN"


MEAN = Mean()


@dataclass(frozen=True)
class Rule:
    kind: str                 # "missing" | "equal" | "range"
    key: object = None        # value for "equal"
    lo: float | None = None
    hi: float | None = None
    value: object = None      # MEAN, None (missing) or a value

    @property
    def is_mean(self) -> bool:
        return isinstance(self.value, Mean)


@dataclass
class FeatureSpec:
    id: str
    type: str
    description: str = ""
    vocabulary: list | None = None
    mapping: list[Rule] = field(default_factory=list)


def parse_scalar(text: str):
    if text == MISSING_TOKEN:
        return None
    try:
        return float(text)
    except ValueError:
        return text


def parse_key(text: str) -> Rule:
    if text == MISSING_TOKEN:
        return Rule("missing")
    if text == MEAN_TOKEN:
        raise ValueError("'mean' is not allowed as a mapping key")
    m = _RANGE.match(text)
    if m:
        lo, hi = float(m.group(1)), float(m.group(2))
        return Rule("range", lo=lo, hi=hi)
    return Rule("equal", key=parse_scalar(text))


def parse_value(text: str):
    if text == MEAN_TOKEN:
        return MEAN
    return parse_scalar(text)


def parse_entry(entry: dict) -> FeatureSpec:
    for req in ("id", "description", "type"):
        if entry.get(req) is None:
            raise ValueError(f"feature entry misses {req!r}: {entry}")
    kind = entry["type"]
    if kind not in KINDS:
        raise ValueError(f"feature {entry['id']!r} has invalid type {kind!r}")
    vocab = None
    if kind == "categorical":
        raw = entry.get("vocabulary")
        if not isinstance(raw, list):
            raise ValueError(f"feature {entry['id']!r} of type 'categorical' needs a vocabulary list")
        parsed = [parse_scalar(v) for v in raw]
        present = [v for v in parsed if v is not None]
        if len(set(present)) != len(present) or parsed.count(None) > 1:
            raise ValueError(f"vocabulary of {entry['id']!r} has duplicate values: {raw}")
        vocab = sorted(present, key=lambda v: (isinstance(v, str), v)) + ([None] if None in parsed else [])
    rules = []
    for pair in entry.get("mapping") or []:
        if not (isinstance(pair, (list, tuple)) and len(pair) == 2):
            raise ValueError(f"mapping entry {pair} of {entry['id']!r} is not a pair")
        key = parse_key(pair[0])
        rules.append(Rule(key.kind, key.key, key.lo, key.hi, parse_value(pair[1])))
    return FeatureSpec(entry["id"], kind, entry.get("description") or "", vocab, rules)


def spec_from_list(entries: list[dict]) -> list[FeatureSpec]:
    specs = [parse_entry(e) for e in entries]
    ids = [s.id for s in specs]
    dup = {i for i in ids if ids.count(i) > 1}
    if dup:
        raise ValueError(f"duplicate feature ids: {sorted(dup)}")
    return specs


def read_spec(spark: SparkSession, path: str) -> list[FeatureSpec]:
    """Read a spec file with Spark (any Hadoop path: local, HDFS, object store).
    The spec is configuration of one entry per column, so it is collected."""
    rows = spark.read.schema(SPEC_SCHEMA).json(path, multiLine=True).collect()
    return spec_from_list([r.asDict(recursive=True) for r in rows])


def spec_to_json(entries: list[dict]) -> str:
    return json.dumps(entries, indent=1)
