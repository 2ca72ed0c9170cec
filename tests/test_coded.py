"""Coded one-hot blocks against the dense ones."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.operators.clean import CleaningEstimator, CleaningModel, FeatureColumn, FeatureLayout
from riskspark.operators.coded import CodedMatrix, pack_coded
from riskspark.operators.mean_chain import chain_means
from riskspark.operators.moments import gram_by_key
from riskspark.operators.wide_profile import decide, wide_profile
from riskspark.plans import cv
from riskspark.plans.models import LinearScorer
from riskspark.sources.spec import MEAN, Rule, read_spec
from riskspark.sources.tables import order_risk, wide_columns, wide_risk
from riskspark.specs import spec_path
from tests.conftest import SF_SMALL


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 30), st.integers(0, 4), st.integers(0, 4), st.integers(0, 10_000))
def test_products_equal_the_dense_ones(n, p, q, seed):
    rng = np.random.default_rng(seed)
    d = p + 3 * q + 1
    positions = rng.permutation(p + 1).astype(np.int32)
    codes = np.stack([rng.choice([-1, *range(p + 1 + 3 * c, p + 4 + 3 * c)], n) for c in range(q)], axis=1) if q else np.zeros((n, 0), int)
    x = CodedMatrix(rng.standard_normal((n, p + 1)), positions, codes.astype(np.int32), d)
    dense = x.dense()
    assert dense.shape == (n, d) and dense[:, p + 1:].sum() == (codes >= 0).sum()
    V, R, y = rng.standard_normal((d, 3)), rng.standard_normal((n, 3)), rng.standard_normal(n)
    assert np.allclose(x @ V, dense @ V) and np.allclose(x.T @ R, dense.T @ R)
    shift, scale = np.zeros(d), np.ones(d)
    shift[positions], scale[positions] = 0.3, 2.0
    Z = np.column_stack([(dense - shift) / scale, y])
    assert np.allclose(x.gram(y, shift, scale), Z.T @ Z)
    if q and n:
        with pytest.raises(ValueError):
            x.gram(y, np.ones(d), scale)


@pytest.fixture(scope="module")
def wide(spark):
    """The published shape: 95 categorical and 44 continuous columns of 321."""
    df = wide_risk(spark, SF_SMALL)
    found = decide(wide_profile(df, wide_columns()))
    kept = [c for c in wide_columns() if found[c].kept(0.1, ("train", "test"))]
    kinds = {c: found[c].kind for c in kept}
    rules = {c: [Rule("missing", value=MEAN)] for c in kept if kinds[c] == "continuous"}
    means = chain_means(df.select("split", *rules), rules)
    layout = FeatureLayout([FeatureColumn(c, "continuous", c) for c in rules]
                           + [FeatureColumn(f"{c}={v}", "onehot", c, v) for c in kept if c not in rules for v in found[c].values])
    return df, CleaningModel("id", "label", "split", kept, kinds, {c: found[c].values for c in kept if c not in rules}, rules, means, layout)


def test_published_shape_without_a_dense_array(spark, wide):
    df, model = wide
    layout = model.layout.with_intercept()
    kinds = list(model.kinds.values())
    # one column of the 44 misses just over a tenth of the few test cells of this small table
    assert kinds.count("categorical") == 95 and kinds.count("continuous") in (43, 44)
    coded = cv.prepare(model.transform_coded(df), layout, 3).filter("fold >= 0").select("x", "codes", "y", "fold")
    d = len(layout.names)
    blocks = pack_coded(coded, layout, block_rows=1000)
    got = gram_by_key(blocks, "x", "y", d, "fold")
    rows = coded.toPandas()
    positions = np.array([p for p, fc in enumerate(layout.columns) if fc.kind != "onehot"])
    dense = CodedMatrix(np.stack(rows["x"]), positions, np.stack(rows["codes"]), d).dense()
    assert sorted(got) == [0, 1, 2] and d > 500
    for f in got:
        Z = np.column_stack([dense, rows["y"]])[rows["fold"] == f]
        assert np.allclose(got[f], Z.T @ Z, rtol=1e-12, atol=1e-7)
    bytes_of = blocks.agg(F.sum(F.length("xb") + F.length("cb"))).first()[0]
    assert bytes_of < 8 * d * len(rows) / 5


def test_cross_validation_and_scores_are_the_same(spark):
    """Codes from the cleaning model against its one-hot columns, through training and scoring."""
    df = order_risk(spark, SF_SMALL)
    model = CleaningEstimator(read_spec(spark, spec_path("order_risk"))).fit(df)
    layout = model.layout.with_intercept()
    configs = [cv.ModelConfig("logistic", 4, 0.5), cv.ModelConfig("mse_gd", 20, 0.01), cv.ModelConfig("ridge", lam=0.1), cv.ModelConfig("ridge_qr", lam=0.1)]
    res = [cv.cross_validate(cv.prepare(frame, layout, 3), layout, configs, 3, 50) for frame in (model.transform_coded(df), model.transform(df))]
    for a, b in zip(res[0].folds, res[1].folds):
        assert np.allclose(a.weights, b.weights, atol=1e-9) and np.isclose(a.val_loss, b.val_loss) and np.isclose(a.train_loss, b.train_loss)
    w, t, mu, sd = res[0].average(0)
    scorer = LinearScorer(layout, w, mu, sd, logistic=True, threshold=t)
    one, two = ({r.id: r.score for r in scorer.transform(frame).select("id", "score").collect()}
                for frame in (model.transform_coded(df), model.transform(df)))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in two)
