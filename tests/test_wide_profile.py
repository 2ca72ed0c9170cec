"""Wide profiles: sketches, one scan without Expand, edge cases."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from riskspark.operators import profile
from riskspark.operators.wide_profile import Sketch, decide, wide_profile


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40)), min_size=1, max_size=6), st.integers(2, 20), st.randoms())
def test_sketches_merge_in_any_order(parts, k, random):
    def folded(lists):
        out = []
        for values in lists:
            s = Sketch(k)
            for i in range(0, len(values), 3):
                s.add(np.array(values[i:i + 3], float), 1)
            out.append(s)
        return out

    sketches = folded(parts)
    random.shuffle(sketches)
    total = Sketch(k)
    for s in sketches:
        total.merge(s)
    distinct = set(v for p in parts for v in p)
    assert total.more == (len(distinct) > k)
    assert total.n_missing == sum(-(-len(p) // 3) for p in parts) and total.n == total.n_missing + sum(map(len, parts))
    if not total.more:
        assert set(total.values) == distinct and total.distinct() == len(distinct)
    whole = Sketch(k)
    whole.add(np.array([v for p in parts for v in p], float), 0)
    assert whole.hashes.tolist() == total.hashes.tolist()


def test_estimate_of_many_values():
    s = Sketch(1024)
    for part in np.array_split(np.arange(200_000, dtype=float), 50):
        s.add(part, 0)
    assert s.more and abs(s.distinct() / 200_000 - 1) < 0.1


def test_profile_equals_exact_counts(spark):
    rows = [(i, "train" if i % 3 else "test", float(i % 7) if i % 5 else None, float("nan") if i % 4 == 0 else i / 3, i % 6,
             None if i % 11 == 0 else f"v{i % 9}", i % 2 == 0, -0.0 if i % 2 else 0.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, split string, a double, b double, c int, d string, e boolean, task double").repartition(7)
    columns = ["a", "b", "c", "d", "e", "task"]
    got = {(r.split, r.feature): r for r in wide_profile(df, columns).collect()}
    assert len(got) == 12
    for s in ("train", "test"):
        part = df.where(F.col("split") == s)
        n = part.count()
        exact = {r.feature: r.n_distinct for r in profile.distinct_counts(part, columns).collect()}
        for c in columns:
            r = got[s, c]
            assert r.n == n and r.n_missing == part.where(profile._missing(c, profile._floating(df))).count()
            assert r.exact == (c != "b")
            if r.exact:
                assert r.n_distinct + (r.n_missing > 0) == exact[c]
    found = decide(wide_profile(df, columns))
    assert {c: found[c].kind for c in columns} == dict(a="categorical", b="continuous", c="categorical", d="categorical", e="categorical",
                                                       task="categorical")
    assert found["a"].values == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None] and found["task"].values == [0.0]
    assert found["c"].values == [0, 1, 2, 3, 4, 5] and found["e"].values == ["false", "true"]
    assert not found["a"].kept(0.1, ["train", "test"]) and found["a"].kept(0.5, ["train", "test", "none"])


def test_profile_edges(spark):
    df = spark.createDataFrame([(None, None, ""), ("train", None, "x" * 100_000)], "split string, a double, b string")
    got = {(r.split, r.feature): r for r in wide_profile(df, ["a", "b"]).collect()}
    assert got[None, "a"].n_missing == 1 and got["train", "a"].n_distinct == 0 and got["train", "b"].texts == ["x" * 100_000]
    assert wide_profile(df.limit(0), ["a", "b"]).count() == 0 and decide(wide_profile(df.limit(0), ["a"])) == {}


def test_wide_table_is_profiled_in_one_scan_without_expand(spark):
    from riskspark.sources.tables import wide_columns, wide_risk
    plan = wide_profile(wide_risk(spark, SF_SMALL), wide_columns())._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Expand" not in plan and physical.count("FileScan") == 1 and len(wide_columns()) == 321
    counts = profile.distinct_counts(wide_risk(spark, SF_SMALL), wide_columns())._jdf.queryExecution().toString()
    assert "Expand" not in counts


def test_vocabulary_beyond_the_sketch(spark):
    """Few training values, many test values: the exact list is read, none is cut."""
    from riskspark.operators.clean import CleaningEstimator
    from riskspark.sources.spec import spec_from_list
    rows = [(i, "train", 1 if i % 2 else -1, float(i % 3)) for i in range(60)] + [(100 + i, "test", 1, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, split string, label int, a double")
    spec = spec_from_list([{"id": "a", "description": "a", "type": "auto"}])
    model = CleaningEstimator(spec, check_vocab=False).fit(df)
    assert model.vocabularies["a"] == [float(i) for i in range(200)]
    with pytest.raises(ValueError, match="more than 50"):
        CleaningEstimator(spec, max_vocabulary=50).fit(df)
