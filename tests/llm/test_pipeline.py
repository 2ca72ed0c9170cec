"""The pipeline's stages, each judged on its own input."""

import pytest

from tests.llm.test_operators import plain_dedup, plain_spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in pipeline.STAGES:
        result = pipeline.written(stage(spark, docs, SF), "test-stage")
        out.append((docs, result))
        docs = result
    return out


def test_stages_keep_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.count() > 0.8 * before.count()


def test_quality_stage_drops_bad_and_keeps_good(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    kept = {r.doc_id for r in steps[0][1].select("doc_id").collect()}
    assert labels[[i not in kept for i in labels.index]].mean() < 0.05
    assert labels[[i in kept for i in labels.index]].mean() > 0.98


def test_later_stages_do_their_work(steps):
    before, after = steps[2]
    want = plain_dedup([(r.doc_id, r.text) for r in before.collect()], 100)
    for r in after.collect():
        size, gone = want[r.doc_id][:2]
        assert size - gone - 6 * want[r.doc_id][2] <= len(r.text.encode()) <= size - gone and r.n_chars == len(r.text)
    assert not any(plain_spans(r.text) for r in steps[3][1].collect())
    words = steps[3][1].selectExpr("sum(size(filter(split(text, '[ \t-\r]+'), w -> w != '')) + 1) AS n").first().n
    assert steps[4][1].agg({"piece_words": "sum"}).first()[0] == words


def test_whole_run_on_edge_rows_and_empty_tables(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(None, None, "x"), (None, "p q r s t", "x"), (1, "", "x"), (1, "", "x"), (2, "word " * 30000, "x"),
            (3, "un deux trois " * 9, "x"), (4, "un deux trois " * 9, "x"), (5, "12 34 !!", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS int) AS n_chars", "fp", "1 AS x", "2 AS whole", "3 AS id")
    for name, part, want in (("some", docs, {None, 1, 2, 3, 5}), ("none", docs.limit(0), set())):
        folder = str(tmp_path / name)
        part.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got = pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in got} == want
        assert len({(r.doc_id, r.piece) for r in got}) == len(got)
