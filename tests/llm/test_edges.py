"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from riskspark.llm import bpe, embed, langid, packing, quality, queries, rules, secrets, simhash, suffix, toxicity

ROWS = [(None, None, None), (None, "x y z", "en"), (1, "", "en"), (1, "", "en"), (2, "word " * 30000, "en"), (3, None, None),
        (4, "un deux trois " * 9, "fr"), (5, "un deux trois " * 9, "fr"), (6, "12 34 !!", "de"), (7, "a\x00b \U0001f600", "en")]
SCHEMA = "doc_id long, text string, lang string"
CLASHING = ("fp", "block", "range", "words", "score", "kept", "component_id", "h1", "x", "shard", "n_chars", "spans", "u", "v")


@pytest.fixture(scope="module")
def docs(spark):
    out = spark.createDataFrame(ROWS, SCHEMA)
    return out.withColumns({c: F.lit(1).cast("long") for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2, 0, 1), (4, 1, 0), (5, 1, 0), (5, 1, 0), (None, 1, 1), (7, None, None)],
                                 "doc_id long, quality int, toxic int")


def operators(labels):
    def vocabulary():
        return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")

    return {
        "quality": lambda d: quality.score_documents(d, labels), "toxicity": lambda d: toxicity.score_documents(d, labels),
        "secrets": secrets.scan_documents, "suffix": suffix.deduplicate,
        "rules": lambda d: rules.apply_rules(d, rules.trusted_documents(labels)), "simhash": simhash.near_duplicates,
        "langid": langid.predict_documents, "bpe": lambda d: bpe.round_trip_digest(d, vocabulary()),
    }


NAMES = ["quality", "toxicity", "secrets", "suffix", "rules", "simhash", "langid", "bpe"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(docs, labels, name):
    got = operators(labels)[name](docs).toPandas()
    assert sorted(got["doc_id"].fillna(-1).astype(int)) == sorted(-1 if r[0] is None else r[0] for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(docs, labels, name):
    assert operators(labels.limit(0))[name](docs.limit(0)).count() == 0
    assert operators(labels.limit(0))[name](docs).count() == len(ROWS)


def test_defined_results(docs, labels):
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in toxicity.score_documents(docs, labels.limit(0)).collect()} == {0.0}
    found = {(r.doc_id, r.lang_pred) for r in langid.predict_documents(docs).collect()}
    assert {(3, "und"), (6, "und"), (1, "und")} <= found and (2, "und") not in found
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert groups[5] == 4 and groups[3] == groups[1] == 1 and groups[2] == 2
    removed = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix.deduplicate(docs).collect()}
    assert removed[5] == (126, 126) and removed[4][1] < 126 and removed[1] == (0, 0)


def test_quality_stage_edges(docs, labels):
    assert quality.keep_documents(docs.limit(0), labels).count() == 0
    every = quality.keep_documents(docs, labels.limit(0))
    assert every.columns == docs.columns and every.count() == len(ROWS) and every.where("text is null").count() == 2
    scores = {(r.doc_id, r.score) for r in quality.score_documents(docs, labels).collect()}
    kept = [r.doc_id for r in quality.keep_documents(docs, labels).collect()]
    assert set(kept) == {i for i, s in scores if s >= 0.5} and kept.count(1) in (0, 2)


def test_packing_edges(docs):
    got = packing.pack_documents(docs).toPandas()
    assert got["piece_words"].sum() == sum(len((r[1] or "").split()) + 1 for r in ROWS)
    assert got[got["doc_id"] == 2]["piece"].tolist().__len__() == 8
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_embedding_edges(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1, 5), (1, [1.0, 0.0], 1, 5), (None, [1.0, 0.0], 1, 5), (2, [1.0, 0.0], None, 5)],
                                  "vec_id long, embedding array<float>, label int, pid int")
    got = embed.near_duplicates(frame).toPandas()
    assert sorted(got["n_links"]) == [0, 2, 2, 2] and got["component_id"].notna().all()
    assert embed.near_duplicates(frame.limit(0)).count() == 0


def test_rewriting_stages_keep_rows_and_columns(docs):
    for stage in (suffix.without_repeats, secrets.redact):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() == len(ROWS)
        assert out.where("text is null").count() == 2
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (False, 4), (False, 6), (False, 7), (True, 0)]


def test_one_row_stays_of_each_group(spark):
    rows = [(1, "a b c d e", 1), (1, "a b c d e", 1), (2, "a b c d e", 2), (None, "a b c d e", 3), (None, "a b c d e", 4),
            (None, "p q r s t", 5), (None, "p q r s t", 5), (None, "p q r s t", 6), (9, "k l m n o", 7), (9, "v w x y z", 8)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, hash int"))
    found = [tuple(r) for r in kept.collect()]
    assert len(found) == 4 and (1, "a b c d e", 1) in found and (9, "k l m n o", 7) in found and (9, "v w x y z", 8) in found
    assert kept.columns == ["doc_id", "text", "hash"] and sum(t == "p q r s t" for _, t, _ in found) == 1


def test_registered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
