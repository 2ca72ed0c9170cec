"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector of ``DIMENSIONS`` components, drawn from
its code point, so the alphabet is open. A run of non-letters counts as one space.
An n-gram's vector binds (multiplies) its letters' vectors, each permuted (rotated)
by its place; a text's vector bundles (adds) its n-grams' vectors, and a language's
prototype bundles the unit vectors of its training texts. A text is given the
language whose prototype has the largest cosine with its vector.

Texts are counted by distinct n-gram first, and a block of texts is bundled by one
matrix product of counts and n-gram vectors. Prototypes are DIMENSIONS numbers per
language and are summed per partition, then over partitions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import doc_texts, held_out, is_train, ready

DIMENSIONS = 1024
NGRAM = 3
#: Bound on the labelled rows that prototypes are learned from (picked by a hash).
TRAIN_ROWS = 20_000
_BLOCK_CHARS = 300_000

_LETTER: dict[int, bool] = {}


def _codes(text: str) -> np.ndarray:
    """Lower-case letters of ``text`` as code points, runs of anything else as one 32; padded by spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    distinct = np.unique(points) if len(points) < 64 else np.flatnonzero(np.bincount(points, minlength=1))
    for p in distinct.tolist():
        if p not in _LETTER:
            _LETTER[p] = unicodedata.category(chr(p)).startswith("L")
    other = [p for p in distinct.tolist() if not _LETTER[p]]
    if other:
        points = np.where(np.isin(points, other), np.uint32(32), points)
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]])
    return points[1:][(points[1:] != 32) | (points[:-1] != 32)]


def _ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter n-grams of ``text`` (21 bits a place) and their counts."""
    points = _codes(text).astype(np.uint64)
    if not len(points) or (points == 32).all():
        return np.zeros(0, np.uint64), np.zeros(0)
    points = np.concatenate([[np.uint64(32)], points])
    grams = np.zeros(max(1, len(points) - NGRAM + 1), np.uint64)
    for place in range(NGRAM):
        grams = (grams << np.uint64(21)) | points[place:place + len(grams)][:len(grams)]
    return np.unique(grams, return_counts=True)


class Space:
    """Letter and n-gram vectors; they follow from the seed alone."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 17):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            bits = np.random.default_rng([self.seed, point]).integers(0, 2, self.dimensions)
            self.letters[point] = (2 * bits - 1).astype(np.float32)
        return self.letters[point]

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """One row for each n-gram: the product of its letters' vectors, rotated by place."""
        out = np.ones((len(grams), self.dimensions), np.float32)
        for place in range(NGRAM):
            points = ((grams >> np.uint64(21 * (NGRAM - 1 - place))) & np.uint64(2 ** 21 - 1)).astype(np.int64)
            known, inverse = np.unique(points, return_inverse=True)
            rolled = np.stack([np.roll(self.letter(int(p)), NGRAM - 1 - place) for p in known])
            out *= rolled[inverse]
        return out

    def bundle(self, texts: list[str]) -> np.ndarray:
        """Unit vectors of ``texts``; a text without letters has the zero vector."""
        counted = [_ngrams(t) for t in texts]
        every, inverse = np.unique(np.concatenate([g for g, _ in counted] or [np.zeros(0, np.uint64)]), return_inverse=True)
        total = np.zeros((len(texts), self.dimensions), np.float32)
        if not len(every):
            return total
        rows = np.repeat(np.arange(len(texts)), [len(g) for g, _ in counted])
        counts = np.concatenate([c for _, c in counted]).astype(np.float32)
        for start in range(0, len(every), 4096):  # bounded memory however many n-grams there are
            inside = (inverse >= start) & (inverse < start + 4096)
            dense = np.zeros((len(texts), min(4096, len(every) - start)), np.float32)
            dense[rows[inside], inverse[inside] - start] = counts[inside]
            total += dense @ self.vectors(every[start:start + 4096])
        length = np.sqrt((total.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
        return np.divide(total, length, out=np.zeros_like(total), where=length > 0).astype(np.float32)


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in order, in lists of at most 256 texts and about ``_BLOCK_CHARS`` characters."""
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if len(block) == 256 or size > _BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def fit(docs: DataFrame, train: DataFrame, rows: int = TRAIN_ROWS, space: Space | None = None) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit rows), from ``train`` (doc_id, text, lang)."""
    space = space or Space()
    ready(docs.sparkSession)

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                for block in _blocks(part["text"].tolist()):
                    v = space.bundle(block).sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + v
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": list(sums.values())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0)]})

    # about ``rows`` rows of every language, all of a rarer one; the counts are one row a language, like the prototypes
    counts = train.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.lit(1 << 40) * F.least(F.lit(1.0), F.lit(float(rows)) / F.col("n"))
    chosen = (train.join(F.broadcast(counts), "lang")
              .where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) < share).select("doc_id", "text", "lang"))
    schema = "lang string, v array<double>"
    sums = chosen.mapInPandas(bundle, schema).groupBy("lang").applyInPandas(add, schema).toPandas().sort_values("lang")
    if not len(sums):
        return [], np.zeros((0, space.dimensions))
    v = np.stack(sums["v"].to_numpy())
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return sums["lang"].tolist(), np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def predict_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Learns from rows with a language whose crc32(doc_id) mod 5 is not 0. score is the
    cosine with the language's prototype, not below 0. A text that is null or has no
    letter gets ``und`` and score 0, and so does every text if nothing was learned; ties
    go to the language first in order. Repeated rows are returned as often as they
    occur; a null doc_id is not held out and not learned from. An empty table gives no rows;
    further columns are ignored.
    """
    space = Space()
    train = (docs.where(is_train(F.col("doc_id").cast("long"), 5, 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"))
    names, prototypes = fit(docs, train, space=space)
    prototypes = prototypes.astype(np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pred, score = [], []
            for block in _blocks(batch["text"].tolist()):
                v = space.bundle(block)
                some = (v != 0).any(axis=1)
                if not names:
                    pred += ["und"] * len(block)
                    score += [0.0] * len(block)
                    continue
                cosine = (v @ prototypes.T).astype(np.float64)
                best = cosine.argmax(axis=1)
                pred += [names[b] if s else "und" for b, s in zip(best, some)]
                score += [min(1.0, max(0.0, c)) if s else 0.0 for c, s in zip(cosine[np.arange(len(block)), best], some)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": pred, "score": score})

    found = doc_texts(docs).mapInPandas(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
