"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are the runs between ASCII white space, lower-cased and stripped of
punctuation at both ends. Features of a text are its distinct words, their stems
(the first ``STEM`` letters of longer words), pairs of neighbouring words and
pairs with one word between, each hashed into ``2 ** BITS`` slots and present or
absent. Every coordinate has its own learning
rate (from its sum of squared gradients) and an L1 proximal step, so only slots
with repeated evidence get a weight.

Fitting. A labelled sample of at most about ``TRAIN_ROWS`` rows (a documented
bound, picked by a hash) is learned by one learner in ``EPOCHS`` passes of FTRL, in
one task: learners of parts would each miss the rarer words. Only its non-zero
weights travel: they are what is broadcast to score the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import bounded_sample, doc_texts, held_out, ready, written
from riskspark.llm.quality import training_labels

BITS = 22
TRAIN_ROWS = 40_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 1.0
STEM = 5
_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|#*$%&@^~`+=-_/\\"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _slots(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[3]
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every word, stem, pair and skip-pair of ``texts``, repeats included."""
    split = pc.ascii_split_whitespace(pa.array(texts, pa.string()).cast(pa.large_string()))
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    flat = pc.list_flatten(split)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    xxh = xxhash.xxh64_intdigest
    names = [w.lower().strip(_EDGE) for w in coded.dictionary.to_pylist()]
    code = np.array([xxh(w.encode("utf-8", "replace")) if w else 0 for w in names] or [0], np.uint64)
    stem = np.array([xxh(w[:STEM].encode("utf-8", "replace")) if len(w) > STEM else 0 for w in names] or [0], np.uint64)
    index = coded.indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int64)
    word, stem = code[index], stem[index]
    row = np.repeat(np.arange(len(texts)), sizes)
    real = word != 0  # nothing but punctuation
    word, stem, row = word[real], stem[real], row[real]
    long = stem != 0
    rows, slots = [row, row[long]], [_slots(word * _MIX[0]), _slots(stem[long] * _MIX[0] + np.uint64(1))]
    for gap in (1, 2):
        same = row[gap:] == row[:-gap]
        rows.append(row[gap:][same])
        slots.append(_slots((word[:-gap] * _MIX[1] + word[gap:] * _MIX[2] + np.uint64(gap))[same]))
    return np.concatenate(rows), np.concatenate(slots) + 1  # slot 0 is the constant


class Ftrl:
    """FTRL-proximal logistic regression on present/absent features."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(2 ** BITS + 1), np.zeros(2 ** BITS + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == 0, 0.0, self.l1)  # the constant is not shrunk
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.alpha * w


@dataclass
class ToxicityModel:
    """Non-zero weights by slot, ascending; slot 0 is the constant. ``fitted`` is False without labels."""

    slots: np.ndarray
    weights: np.ndarray
    fitted: bool

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.fitted or not texts:
            return np.zeros(len(texts))
        total = np.full(len(texts), self.weights[self.slots == 0].sum())
        row, slot = features(texts)
        where = np.searchsorted(self.slots, slot)
        where[where == len(self.slots)] = 0
        hit = self.slots[where] == slot
        pairs = np.unique(np.stack([row[hit], where[hit]], axis=1), axis=0)
        np.add.at(total, pairs[:, 0], self.weights[pairs[:, 1]])
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

    def column(self, text: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def scored(batch: pd.Series) -> pd.Series:
            texts = ["" if t is None else t for t in batch]
            parts, start, size = [], 0, 0
            for k, t in enumerate(texts):  # a few MB at a time
                size += len(t)
                if size > 2_000_000 or k == len(texts) - 1:
                    parts.append(model.score(texts[start:k + 1]))
                    start, size = k + 1, 0
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        return scored(text)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS,
        epochs: int = EPOCHS) -> ToxicityModel:
    """Fit on ``labels`` (doc_id, y in 0/1) joined to ``docs``. Without labels the model scores 0 everywhere."""
    ready(docs.sparkSession)
    chosen = bounded_sample(labels, F.col("doc_id"), train_rows)
    # at most about train_rows pairs of numbers: sent to the texts, which stay where they are
    train = written(doc_texts(docs).join(F.broadcast(chosen), "doc_id"), "toxicity-train")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(at=[xxhash.xxh64_intdigest(str(d), 1) for d in pdf["doc_id"]]).sort_values(["at", "text"])
        texts, y = pdf["text"].tolist(), pdf["y"].to_numpy(float)
        examples: list[np.ndarray] = []
        for start in range(0, len(texts), 100):
            row, slot = features(texts[start:start + 100])
            for k in range(len(texts[start:start + 100])):
                examples.append(np.append(np.unique(slot[row == k]), 0).astype(np.int32))
        model = Ftrl()
        order = np.random.default_rng(3)
        for _ in range(epochs):
            for k in order.permutation(len(examples)):
                model.learn(examples[k], y[k])
        w = model.weights(np.arange(2 ** BITS + 1))
        at = np.flatnonzero(w)
        return pd.DataFrame({"slot": at.astype(np.int64), "w": w[at]})

    # a few hundred weights, already in order of slot; a sort in Spark would sample its input first and so fit twice
    learned = train.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "slot long, w double").toPandas()
    return ToxicityModel(learned["slot"].to_numpy(np.int64), learned["w"].to_numpy(float), len(learned) > 0)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; predicted is 1 from 0.7 on.

    A null or empty text has the score of the constant alone. Repeated rows are returned
    as often as they occur; a null doc_id is not held out. An empty table gives no rows;
    without labels every score is 0. Further columns are ignored.
    """
    model = fit(docs, training_labels(labels, "toxic"))
    score = doc_texts(docs).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"),
                                   model.column(F.col("text")).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
