"""Ranked lexical search over a length-stratified index.

A document's length enters its scores only through the integer normaliser
m = 75 + (25 * n * N) div L, so documents of equal m form a *stratum* in which a term's
impact depends on tf alone.

Index. Documents are dealt into segments as they are read (no exchange; at most
``SEGMENT_TERMS`` terms each). A segment holds, for every term, its postings
ordered by stratum and within it by tf. Strata need N and L, which one earlier scan
sums. No document and no term is left out.

Search. For a block of queries, only postings of the queries' terms are read and
brought together by segment. There

* an impact is computed once for every (term, stratum, tf) and shared by its postings;
* a stratum's bound for a query is the sum of its terms' impacts at their largest tf there;
* strata are visited in descending order of bound, in growing steps. A query is
  finished when the next bound is below its k-th best score, so what is left out can
  neither beat nor tie it.

A segment gives its k best documents per query, and the best k of these are the
result. All scores are 64-bit integers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskspark.llm.common import ready, written

#: Terms (with repeats) and documents of a segment; a longer text is a segment of its own.
SEGMENT_TERMS = 2_000_000
SEGMENT_DOCS = 65_536
#: Distinct (query, term) pairs that one round over the index takes to the tasks.
BLOCK_TERMS = 200_000
#: Strata that the first step visits; each further step visits four times as many.
FIRST_STRATA = 8

# A term is a run of ASCII digits, letters and of characters beyond ASCII; only A-Z are lower-cased. In UTF-8,
# the bytes of all other characters are below 0x80 and stand for themselves, so bytes can be mapped one by one.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8 (null: none)."""
    return text.encode().translate(_KEEP).split() if text else []


@dataclass(frozen=True)
class Index:
    """``postings`` (segment, term, m, tf, at: equally long lists by m, tf, at), ``documents``
    (segment, at, doc_id, m), n_docs (N) and n_terms (L). ``at`` numbers a segment's documents by doc_id, null last."""

    postings: DataFrame
    documents: DataFrame
    n_docs: int
    n_terms: int


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = total = 0
        for batch in batches:
            for text in batch["text"]:
                size = len(terms_of(text))
                n += size > 0
                total += size
        yield pd.DataFrame({"n": [n], "total": [total]})

    ready(docs.sparkSession)
    row = _texts(docs).select("text").mapInPandas(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return int(row[0] or 0), int(row[1] or 0)


_INDEX_SCHEMA = "segment long, at int, doc_id long, m long, term binary, ms array<int>, tf array<int>, ats array<int>"


def _segment(segment: int, ids: list, sizes: list[int], words: list[np.ndarray], vocabulary: list[bytes], n_docs: int,
             n_terms: int) -> Iterator[pa.RecordBatch]:
    """Rows of one segment (_INDEX_SCHEMA): its documents, then its postings by term.

    ``words``: numbers of each document's terms in ``vocabulary``. Lists are cut out of whole arrays by offsets."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    # Python integers: 25 * n * N may pass 64 bits
    m = np.array([75 + 25 * sizes[i] * n_docs // n_terms for i in order], np.int64)
    width = len(ids)
    keys = np.concatenate([words[i].astype(np.int64) * width + at for at, i in enumerate(order)])
    keys, tf = np.unique(keys, return_counts=True)
    term, at = keys // width, keys % width
    strata, stratum = np.unique(m, return_inverse=True)
    placed = np.lexsort((tf, term * len(strata) + stratum[at]))  # stable: equal ones stay in order of at
    term, at, tf = term[placed], at[placed], tf[placed]
    cuts = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term))

    def batch(n: int, **columns) -> pa.RecordBatch:
        columns["segment"] = pa.array(np.full(n, segment))
        kinds = {"segment": pa.int64(), "at": pa.int32(), "doc_id": pa.int64(), "m": pa.int64(), "term": pa.binary(),
                 "ms": pa.list_(pa.int32()), "tf": pa.list_(pa.int32()), "ats": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, kind) for c, kind in kinds.items()], list(kinds))

    yield batch(width, at=pa.array(np.arange(width, dtype=np.int32)), doc_id=pa.array([ids[i] for i in order], pa.int64()), m=pa.array(m))
    for k in range(0, len(cuts) - 1, 20_000):
        here = cuts[k:k + 20_001]
        offsets, part = pa.array((here - here[0]).astype(np.int32)), slice(here[0], here[-1])
        lists = {c: pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32)))
                 for c, x in (("ms", m[at[part]]), ("tf", tf[part]), ("ats", at[part]))}
        yield batch(len(here) - 1, term=pa.array([vocabulary[t] for t in term[here[:-1]].tolist()], pa.binary()), **lists)


def build_index(docs: DataFrame) -> Index:
    """Index every row of ``docs`` (doc_id, text) with a term. Repeated rows are documents of their own."""
    spark = docs.sparkSession
    ready(spark)
    n_docs, n_terms = corpus_size(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def start() -> None:
            nonlocal ids, sizes, words, total, number
            ids, sizes, words, total = [], [], [], 0
            number = defaultdict()
            number.default_factory = number.__len__  # a new term gets the next number

        ids = sizes = words = total = number = None
        done, part = 0, 0
        start()
        for batch in batches:
            for part, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))):
                found = terms_of(text)
                if not found:
                    continue
                if ids and (total + len(found) > SEGMENT_TERMS or len(ids) >= SEGMENT_DOCS):
                    yield from _segment((part << 32) + done, ids, sizes, words, list(number), n_docs, n_terms)
                    done += 1
                    start()
                ids.append(doc_id)
                sizes.append(len(found))
                words.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                total += len(found)
        if ids:
            yield from _segment((part << 32) + done, ids, sizes, words, list(number), n_docs, n_terms)

    rows = written(_texts(docs).select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, _INDEX_SCHEMA), "search-index")
    postings = rows.where("term is not null").select("segment", F.col("term").cast("string").alias("term"), F.col("ms").alias("m"),
                                                     "tf", F.col("ats").alias("at"))
    return Index(postings, rows.where("term is null").select("segment", "at", "doc_id", "m"), n_docs, n_terms)


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, query, term, times): the terms of every query with their repeats.

    ``queries``: item_id, text; equal rows are one query. query names (item_id, text) by a hash."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, query, text in zip(batch["item_id"].astype("Int64"), batch["query"], batch["text"]):
                times: dict[bytes, int] = defaultdict(int)
                for t in terms_of(text):
                    times[t] += 1
                rows += [(item, query, t.decode(), k) for t, k in times.items()]
            yield pd.DataFrame(rows, columns=["item_id", "query", "term", "times"]).astype({"item_id": "Int64"})

    ready(queries.sparkSession)
    named = (queries.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .distinct().withColumn("query", F.md5(F.concat(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.lit(":"), "text"))))
    return named.mapInPandas(run, "item_id long, query string, term string, times long")


def term_weight(df: Column, n_docs: int) -> Column:
    """floor(1000 * ln((2N + 2) / (2 df + 1)))"""
    return F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double"))).cast("long")


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _spans(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All numbers of all ranges [start, stop)."""
    sizes = stops - starts
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Postings:
    """A segment's postings of a block's terms: runs of equal (term, stratum, tf), and per (term, stratum) its posting range."""

    def __init__(self, pdf: pd.DataFrame):
        self.row = {t: i for i, t in enumerate(pdf["term"])}
        sizes = pdf["at"].map(len).to_numpy()
        term = np.repeat(np.arange(len(pdf)), sizes)
        m, tf = (np.concatenate(pdf[c].tolist()).astype(np.int64) for c in ("m", "tf"))
        self.at = np.concatenate(pdf["at"].tolist()).astype(np.int64)
        new_cell = (np.diff(term, prepend=-1) != 0) | (np.diff(m, prepend=-1) != 0)
        run = np.flatnonzero(new_cell | (np.diff(tf, prepend=-1) != 0))
        impact = _impacts(tf[run], m[run])  # once per (term, stratum, tf)
        self.impact = np.repeat(impact, np.diff(np.append(run, len(tf))))
        self.strata, stratum = np.unique(m, return_inverse=True)
        first = np.flatnonzero(new_cell)
        self.cell_term, self.cell_stratum = term[first], stratum[first]
        self.start, self.stop = first, np.append(first[1:], len(term))
        self.top = self.impact[self.stop - 1]  # tf ascends within a stratum, and impacts with tf
        self.cells = np.searchsorted(self.cell_term, np.arange(len(pdf) + 1))

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, strata visited): the k best, equal scores by ascending document."""
        cells = _spans(self.cells[rows], self.cells[rows + 1])
        weight = np.repeat(weights, self.cells[rows + 1] - self.cells[rows])
        bound = np.zeros(len(self.strata), np.int64)
        np.add.at(bound, self.cell_stratum[cells], weight * self.top[cells])
        order = np.argsort(-bound, kind="stable")
        order = order[:np.count_nonzero(bound)]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen, step = 0, FIRST_STRATA
        rank = np.empty(len(bound), np.int64)
        rank[order] = np.arange(len(order))
        rank[bound == 0] = len(bound)
        cell_rank = rank[self.cell_stratum[cells]]
        while seen < len(order):
            if len(docs) == k and bound[order[seen]] < scores[-1]:
                break
            stop = min(seen + step, len(order))
            if len(docs) == k:  # strata that can still matter are a prefix
                stop = min(stop, int(np.searchsorted(-bound[order], -scores[-1], side="right")))
            now = (cell_rank >= seen) & (cell_rank < stop)
            a, b = self.start[cells[now]], self.stop[cells[now]]
            place = _spans(a, b)
            gain = self.impact[place] * np.repeat(weight[now], b - a)
            found, where = np.unique(self.at[place], return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, where, gain)
            found, total = found[total > 0], total[total > 0]
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, total])
            top = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[top], scores[top]
            seen, step = stop, step * 4
        return docs, scores, seen


def _scorer(sent, k: int):
    """Function of one segment's postings: (segment, query, at, score) of its k best documents per query."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        postings = _Postings(pdf)
        out = []
        for query, (terms, weights) in sent.value.items():
            rows = np.array([postings.row.get(t, -1) for t in terms])
            there = rows >= 0
            if there.any():
                docs, scores, _ = postings.best(rows[there], weights[there], k)
                out.append(pd.DataFrame({"query": query, "at": docs.astype(np.int32), "score": scores}))
        if not out:
            return pd.DataFrame({"segment": [], "query": [], "at": [], "score": []})
        return pd.concat(out, ignore_index=True).assign(segment=pdf["segment"].iloc[0])[["segment", "query", "at", "score"]]

    return run


def _blocks(terms: DataFrame) -> Iterator[pd.DataFrame]:
    """(item_id, query, term, weight) in blocks of whole queries of about BLOCK_TERMS rows."""
    n = terms.count()
    blocks = max(1, -(-n // BLOCK_TERMS))
    for b in range(blocks):
        yield terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).select("query", "term", "weight").toPandas()


def search(index: Index, queries: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every query, equal scores by ascending doc_id.

    Only scores above 0 are listed, so a query without terms, or none that occurs, gives no
    rows. Equal query rows are one query; rows that share an item_id but not the text are
    queries of their own. Documents of null id come last among equals. An empty table
    on either side gives no rows; further columns are ignored.
    """
    spark = queries.sparkSession
    ready(spark)
    wanted = written(query_terms(queries), "query-terms")
    vocabulary = wanted.select("term").distinct()
    # join, not a literal list: the postings of other terms are not read beyond the scan
    used = index.postings.join(vocabulary, "term", "left_semi")
    df = used.groupBy("term").agg(F.sum(F.size("at")).alias("df"))
    weighted = written(wanted.join(df, "term").select("item_id", "query", "term", (
        F.col("times") * term_weight(F.col("df"), index.n_docs)).alias("weight")), "query-weights")
    found = None
    for block in _blocks(weighted):
        # sorted by query; BLOCK_TERMS bounds what travels to the tasks (one longer query goes alone)
        texts = {q: (g["term"].to_numpy(), g["weight"].to_numpy()) for q, g in block.groupby("query")}
        sent = spark.sparkContext.broadcast(texts)

        rows = used if found is None and len(block) == 0 else used.join(
            spark.createDataFrame(pd.DataFrame({"term": sorted(set(block["term"]))}), "term string"), "term", "left_semi")
        part = rows.groupBy("segment").applyInPandas(_scorer(sent, k), "segment long, query string, at int, score long")
        part = written(part, "search-hits")
        found = part if found is None else found.unionByName(part)
    named = found.join(index.documents, ["segment", "at"]).select("query", "doc_id", "score")
    ranked = named.withColumn("rank", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
    items = weighted.select("query", "item_id").distinct()
    return ranked.join(items, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
