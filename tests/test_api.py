"""Model classes, Dataset surface, streaming scoring and property checks."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.operators import encode, evaluate
from riskspark.operators.clean import CleaningEstimator
from riskspark.plans.dataset import Dataset
from riskspark.plans.models import LogisticRegressionGD, RidgeRegression
from riskspark.sources.spec import read_spec
from riskspark.sources.tables import order_risk
from riskspark.specs import spec_path
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cleaned(spark):
    df = order_risk(spark, SF_SMALL)
    model = CleaningEstimator(read_spec(spark, spec_path("order_risk"))).fit(df)
    return model, model.transform(df)


def test_dataset_folds_partition_rows(spark, cleaned):
    model, clean = cleaned
    ds = Dataset(clean, model.layout, seed=1, k=5)
    n = len(ds)
    sizes = [ds.fold(i)[1].count() for i in range(5)]
    assert sum(sizes) == n and all(s > 0 for s in sizes)
    tr, va, (mean, std) = ds.split_data(0.8)
    assert tr.count() + va.count() == n and len(mean) == len(model.layout.continuous)


def test_model_classes_fit_and_predict(spark, cleaned):
    model, clean = cleaned
    ds = Dataset(clean, model.layout)
    m = LogisticRegressionGD(max_iters=3, gamma=0.7)
    w, loss = m.fit(ds.data, ds.layout)
    assert w.shape == (len(ds.layout.names),) and np.isfinite(loss)
    preds = m.predict(ds.get_test_set())
    assert set(r[0] for r in preds.select("prediction").distinct().collect()) <= {-1, 1}
    r = RidgeRegression(lambda_=0.1)
    r.fit(ds.data, ds.layout)
    assert np.all(np.isfinite(r.w))


def test_streaming_scoring(spark, cleaned, tmp_path):
    from riskspark.plans.models import LinearScorer
    from riskspark.streaming.scoring import score_stream
    model, clean = cleaned
    layout = model.layout.with_intercept()
    scorer = LinearScorer(layout, np.full(len(layout.names), 0.01), np.zeros(2), np.ones(2), True, 0.5)
    src = tmp_path / "in"
    raw = order_risk(spark, SF_SMALL)
    raw.write.parquet(str(src))
    stream = spark.readStream.schema(raw.schema).parquet(str(src))
    q = (score_stream(stream, model, scorer).writeStream.format("memory").queryName("scored_orders")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    out = spark.sql("SELECT * FROM scored_orders")
    assert out.count() == raw.count()
    batch = scorer.transform(model.transform(raw)).select("id", "prediction")
    assert out.select("id", "prediction").exceptAll(batch).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(-1.5, 1.5, allow_nan=False), st.sampled_from([-1, 1])), min_size=1, max_size=40),
       st.integers(1, 30))
def test_threshold_search_equals_brute_force(spark, rows, n):
    df = spark.createDataFrame([(float(s), int(y)) for s, y in rows], "score double, label int")
    got = evaluate.threshold_search(df, "score", "label", n).first()
    from riskspark.functions.columns import threshold_grid
    best_t, best_f1 = 0.0, 0.0
    for t in threshold_grid(n):
        tp = sum(1 for s, y in rows if y == 1 and s > t)
        fp = sum(1 for s, y in rows if y == -1 and s > t)
        fn = sum(1 for s, y in rows if y == 1 and not s > t)
        tn = sum(1 for s, y in rows if y == -1 and not s > t)
        f1 = evaluate.metrics_np(tp, fn, tn, fp)["f1"]
        if f1 > best_f1:
            best_t, best_f1 = t, f1
    assert got["threshold"] == best_t and abs(got["f1"] - best_f1) < 1e-15


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from([1.0, 2.0, 3.0, None]), min_size=1, max_size=30))
def test_one_hot_rows_sum_to_one(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c double")
    out = df.select(*encode.onehot_exprs("c", [1.0, 2.0, 3.0, None])).collect()
    assert all(sum(r) == 1.0 for r in out)


def test_cleaning_and_scorer_as_pipeline_stages(spark):
    from pyspark.ml import Pipeline
    from riskspark.plans.models import LinearScorer
    df = order_risk(spark, SF_SMALL)
    fitted = Pipeline(stages=[CleaningEstimator(read_spec(spark, spec_path("order_risk")))]).fit(df)
    cleaning = fitted.stages[0]
    layout = cleaning.layout.with_intercept()
    scorer = LinearScorer(layout, np.full(len(layout.names), 0.01), np.zeros(2), np.ones(2), True, 0.5)
    from pyspark.ml import PipelineModel
    out = PipelineModel(stages=[cleaning, scorer]).transform(df)
    assert out.count() == df.count() and {"score", "prediction"} <= set(out.columns)


def test_scaled_training_part_has_mean_zero_std_one(spark, cleaned):
    model, clean = cleaned
    ds = Dataset(clean, model.layout, k=5)
    scalers = ds.fold_scalers()
    cont = ds.layout.continuous
    for i in range(5):
        tr, _ = ds.fold(i)
        mu, sd = scalers[i]
        exprs = [((F.col(c) - float(m)) / float(s)).alias(c) for c, m, s in zip(cont, mu, sd)]
        stats = tr.select(*exprs).agg(*[F.avg(c).alias(f"m_{c}") for c in cont],
                                      *[F.stddev_pop(c).alias(f"s_{c}") for c in cont]).first()
        for c in cont:
            assert abs(stats[f"m_{c}"]) < 1e-9 and abs(stats[f"s_{c}"] - 1.0) < 1e-9


def test_predict_before_fit_raises(spark, cleaned):
    _, clean = cleaned
    with pytest.raises(RuntimeError):
        LogisticRegressionGD().predict(clean)


def test_reference_style_cross_validate(spark, cleaned):
    from riskspark.plans.methods import average_model, cross_validate
    model, clean = cleaned
    ds = Dataset(clean, model.layout, k=5)
    m = cross_validate(LogisticRegressionGD(max_iters=3, gamma=0.7), ds, search_threshold_iterations=20)
    assert len(m["F1 Score"]) == 5 and len(m["Weights"]) == 5
    w, thr, mu, sd = average_model(m)
    assert w.shape == (len(ds.layout.names),) and -1.0 <= thr <= 1.0 and len(mu) == 2
