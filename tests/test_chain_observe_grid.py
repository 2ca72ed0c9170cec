"""One-pass mean chains, observed conformance, streaming restarts, saved models, grid tables."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskspark.operators import conform
from riskspark.operators.clean import CleaningEstimator, CleaningModel, FeatureColumn, FeatureLayout
from riskspark.operators.mean_chain import Region, chain_means, cut_points, solve
from riskspark.operators.recode import apply_rules
from riskspark.plans import cv
from riskspark.plans.grid import GridTable, run_grid
from riskspark.plans.models import LinearScorer
from riskspark.sources.spec import MEAN, Rule, spec_from_list

VALUES = [None, -3.0, 0.0, 1.0, 1.5, 2.0, 4.0, 7.0]
RULES = st.one_of(
    st.builds(lambda v: Rule("missing", value=v), st.sampled_from([MEAN, 0.0, 2.0])),
    st.builds(lambda k, v: Rule("equal", key=k, value=v), st.sampled_from(VALUES[1:]), st.sampled_from([MEAN, None, 1.5, 9.0])),
    st.builds(lambda a, b, v: Rule("range", lo=min(a, b), hi=max(a, b), value=v), st.sampled_from([-4.0, 0.0, 1.0, 2.5, 7.0]),
              st.sampled_from([-1.0, 0.5, 2.0, 9.0]), st.sampled_from([MEAN, None, 3.0, 1.0])))


def plain_means(values, rules):
    """Mean of every mean rule by running the chain over the values."""
    now, out = list(values), {}
    for i, r in enumerate(rules):
        present = [v for v in now if v is not None]
        new = (sum(present) / len(present) if present else None) if r.is_mean else r.value
        if r.is_mean:
            out[i] = new

        def hit(v):
            if r.kind == "missing":
                return v is None
            return v is not None and (r.lo <= v <= r.hi if r.kind == "range" else v == r.key)

        now = [new if hit(v) else v for v in now]
    return out


def regions_of(values, points):
    ends = [-np.inf, *points, np.inf]
    out = [Region(0.0, 0.0, True, sum(v is None for v in values), 0.0, False)]
    for k in range(2 * len(points) + 1):
        low, high = (points[k // 2],) * 2 if k % 2 else (ends[k // 2], ends[k // 2 + 1])
        held = [v for v in values if v is not None and (v == low if k % 2 else low < v < high)]
        out.append(Region(low, high, False, len(held), sum(held), True))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(VALUES), max_size=25), st.lists(RULES, min_size=1, max_size=6))
def test_a_chain_over_regions_is_the_chain_over_values(values, rules):
    got = solve(rules, {"s": regions_of(values, cut_points(rules))}, "double")
    want = plain_means(values, rules)
    assert got.keys() == want.keys()
    for i, v in want.items():
        assert (got[i]["s"] is None) == (v is None) and (v is None or np.isclose(got[i]["s"], v, atol=1e-9))


def test_three_levels_of_means_take_one_job(spark):
    rows = [(s, None if i % 4 == 0 else float(i % 9), i % 6 if i % 5 else None) for i in range(300) for s in ("train", "test")]
    df = spark.createDataFrame(rows, "split string, a double, b int")
    rules = {"a": [Rule("missing", value=MEAN), Rule("range", lo=2.0, hi=3.0, value=None), Rule("missing", value=MEAN),
                   Rule("equal", key=8.0, value=1.0), Rule("range", lo=0.0, hi=1.0, value=MEAN)],
             "b": [Rule("equal", key=3.0, value=None), Rule("missing", value=MEAN)]}
    jobs = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    means = chain_means(df, rules)
    jobs = tracker.getJobIdsForGroup("chain")
    spark.sparkContext.setJobGroup("rest", "rest")
    executions = {tuple(tracker.getJobInfo(j).stageIds) for j in jobs}
    assert 1 <= len(executions) <= 2  # one grouped aggregate: a job, or one per stage where plans adapt
    for s in ("train", "test"):
        want = plain_means([r[1] for r in rows if r[0] == s], rules["a"])
        assert {i: round(means["a", i][s], 9) for i in want} == {i: round(v, 9) for i, v in want.items()}
    out, same = apply_rules(df, rules)
    assert same == means
    want = plain_means([r[1] for r in rows if r[0] == "train"], rules["a"])
    assert out.where("a is null or b is null").count() == 0 and dict(out.dtypes)["b"] == "int"
    fixed, one = apply_rules(df, rules, impute="fit_on_train")
    assert all(len(set(m.values())) == 1 for m in one.values())


def test_means_of_an_empty_table(spark):
    df = spark.createDataFrame([], "split string, a double")
    out, means = apply_rules(df, {"a": [Rule("missing", value=MEAN)]})
    assert out.count() == 0 and means["a", 0] == {}
    with pytest.raises(ValueError, match="non-numeric"):
        apply_rules(spark.createDataFrame([("x", "y")], "split string, a string"), {"a": [Rule("missing", value=MEAN)]})


def test_observed_counts_need_no_scan_and_survive_retries(spark, tmp_path):
    rows = [("train" if i % 3 else "test" if i % 2 else "odd", None if i % 7 == 0 else str(i % 4), "x" if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "split string, a string, b string").repartition(6)
    specs = spec_from_list([{"id": "a", "description": "a", "type": "categorical", "vocabulary": ["0", "1"]}])
    watched = conform.ObservedConformance(["a", "b"], specs)
    watched.watch(df).withColumn("c", F.lit(1)).write.parquet(str(tmp_path / "out"))
    got = sorted(map(tuple, watched.report(spark).where("split is not null").collect()))
    want = sorted(map(tuple, conform.spec_conformance(df, ["a", "b"], specs).where("split != 'odd'").collect()))
    assert got == want
    assert watched.report(spark).where("split is null").first().n_rows == sum(r[0] == "odd" for r in rows)


def test_a_stream_that_failed_goes_on_without_doubles(spark, tmp_path):
    from riskspark.streaming.scoring import parquet_stream, score_available
    rows = [(i, "test", 1, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, split string, label int, v double")
    for part in range(6):
        df.where(F.col("id") % 6 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    cleaning = CleaningModel("id", "label", "split", ["v"], {"v": "continuous"}, {}, {}, {}, FeatureLayout([FeatureColumn("v", "continuous", "v")]))
    scorer = LinearScorer(cleaning.layout, np.array([2.0]), np.zeros(1), np.ones(1), False, 50.0)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = parquet_stream(spark, str(tmp_path / "in"), df.schema)
    broken = stream.withColumn("v", F.when(F.col("id") % 6 == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        score_available(broken, cleaning, scorer, out, checkpoint)
    done = spark.read.parquet(out).count()
    assert done == 30
    score_available(stream, cleaning, scorer, out, checkpoint)
    score_available(stream, cleaning, scorer, out, checkpoint)
    got = sorted(map(tuple, spark.read.schema("id long, score double, prediction int").parquet(out).collect()))
    assert got == [(i, 2.0 * i, 1 if 2.0 * i > 50 else -1) for i in range(60)]


def test_saved_models_predict_alike(spark, tmp_path):
    rows = [(i, "train" if i % 4 else "test", 1 if i % 3 else -1, None if i % 9 == 0 else float(i % 13), "k" if i % 2 else None, float(i % 5))
            for i in range(200)]
    df = spark.createDataFrame(rows, "id long, split string, label int, a double, b string, c double")
    specs = spec_from_list([{"id": "a", "description": "", "type": "continuous", "mapping": [["3-5", "NaN"], ["NaN", "mean"], ["7", "mean"]]},
                            {"id": "b", "description": "", "type": "categorical", "vocabulary": ["k", "NaN"]},
                            {"id": "c", "description": "", "type": "auto"}])
    model = CleaningEstimator(specs, threshold=0.5).fit(df)
    model.save(str(tmp_path / "cleaning"))
    loaded = CleaningModel.load(str(tmp_path / "cleaning"))
    assert loaded.uid == model.uid and loaded.means == model.means and loaded.rules == model.rules and loaded.vocabularies == model.vocabularies
    assert sorted(map(tuple, loaded.transform(df).collect())) == sorted(map(tuple, model.transform(df).collect()))
    scorer = LinearScorer(model.layout, np.linspace(-1, 1, len(model.layout.names)), np.array([2.0]), np.array([0.5]), True, 0.4)
    whole = Pipeline(stages=[model, scorer]).fit(df)
    whole.write().overwrite().save(str(tmp_path / "pipeline"))
    again = PipelineModel.load(str(tmp_path / "pipeline"))
    first, second = ({r.id: (r.score, r.prediction) for r in m.transform(df).collect()} for m in (whole, again))
    assert first == second and again.stages[1].threshold == 0.4
    with pytest.raises(ValueError):
        LinearScorer.load(str(tmp_path / "cleaning"))


def test_a_grid_that_was_stopped_goes_on(spark, tmp_path, monkeypatch):
    from riskspark.sources.sink import write_results
    rng = np.random.default_rng(3)
    v, y = rng.standard_normal(300), np.where(rng.random(300) < 0.4, 1, -1)
    df = spark.createDataFrame([(i, "train", int(y[i]), float(v[i])) for i in range(300)], "id long, split string, label int, v double")
    layout = FeatureLayout([FeatureColumn("v", "continuous", "v")]).with_intercept()
    data = cv.prepare(df, layout, 3)
    configs = [cv.ModelConfig("mse_gd", 20, g, name=f"g{g}") for g in (0.01, 0.1, 0.5, 0.7, 0.9)]
    straight = run_grid(data, layout, configs, GridTable(spark, str(tmp_path / "a")), 3, 20)
    table, plain, calls = GridTable(spark, str(tmp_path / "b")), cv.cross_validate, []

    def lost(data, layout, group, *rest):
        calls.append(len(group))
        if len(calls) == 2:
            raise RuntimeError("lost")
        return plain(data, layout, group, *rest)

    monkeypatch.setattr(cv, "cross_validate", lost)
    with pytest.raises(RuntimeError):
        run_grid(data, layout, configs, table, 3, 20, together=2)
    assert len(table.finished()) == 2
    resumed = run_grid(data, layout, configs, table, 3, 20, together=2)
    assert calls == [2, 2, 2, 1]
    key = lambda r: r["name"]
    for a, b in zip(sorted(straight.collect(), key=key), sorted(resumed.collect(), key=key)):
        assert a.key == b.key and np.allclose([a.f1, a.val_loss, a.threshold], [b.f1, b.val_loss, b.threshold])
    write_results(resumed.select("name", "f1"), str(tmp_path / "results"))
    assert spark.read.option("header", True).csv(str(tmp_path / "results")).count() == 5
