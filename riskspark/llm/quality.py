"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A text becomes ``len(STATISTICS)`` numbers (word and line repetition, letter case,
symbol shares, compressibility). Standardised, they are mapped to ``features``
random Fourier features z(x) = sqrt(2/D) cos(Wx + b), whose inner products
approximate a Gaussian kernel. Each partition sums the normal equations of its
labelled rows per fold; the sums of all partitions, D x D numbers whatever the
input, are solved for ridge weights. Scores of rows that the weights did not see
(two folds) are pooled in ``GRID`` steps and made monotone by pool-adjacent
violators, which turns a score into the share of label 1.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import doc_texts, held_out, is_train, ready, written

STATISTICS = ("log_chars", "log_words", "mean_word", "sd_word", "unique_words", "top_word", "adjacent_repeats",
              "unique_trigrams", "repeated_lines", "upper", "digits", "spaces", "symbols", "end_marks", "other_punct",
              "non_ascii", "alphabetic_words", "symbol_words", "upper_words", "compressed", "log_lines")
FEATURES = 256
RIDGE = 1e-2
GAMMA = 0.35  # scale of the random frequencies, per standardised statistic
GRID = 512
FOLDS = 2


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode())] = 1
    return out


_UPPER, _DIGIT, _SPACE = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class(" \t\n\r\x0b\x0c")
_SYMBOL, _MARK, _PUNCT = _class("#*$%&|<>{}[]\\^~=+@_/"), _class("!?"), _class(".,;:'\"()-")
_LEAD = np.zeros(256)
_LEAD[192:] = 1
_BYTES = np.stack([_UPPER, _DIGIT, _SPACE, _SYMBOL, _MARK, _PUNCT, _LEAD], axis=1)


def statistics(text: str) -> list[float]:
    """The numbers of ``STATISTICS`` for one whole text; an empty text gives zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n, lines = max(1, len(words)), text.split("\n")
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    full = [line for line in lines if line and not line.isspace()]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = counts @ _BYTES / len(raw)
    triples = max(1, len(words) - 2)
    return [
        np.log1p(len(text)), np.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        len(set(words)) / n, (max(Counter(words).values()) if words else 0) / n,
        sum(map(eq, words, words[1:])) / n, len(set(zip(words, words[1:], words[2:]))) / triples,
        1 - len(set(full)) / max(1, len(full)), *(float(x) for x in shares),
        sum(map(str.isalpha, words)) / n, sum(not w[-1].isalnum() and w[-1] not in ".,;:" for w in words) / n,
        sum(map(str.isupper, words)) / n, len(zlib.compress(raw, 1)) / len(raw), np.log1p(len(lines)),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["text"]]})

    return doc_texts(docs).mapInPandas(run, "doc_id long, x array<double>")


@dataclass
class QualityModel:
    """Weights of the fitted classifier; a few hundred numbers, whatever it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.frequencies + self.phases
        return np.concatenate([np.sqrt(2 / len(self.phases)) * np.cos(z), np.ones((len(x), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1."""
        if not len(x):
            return np.zeros(0)
        return np.clip(np.interp(self.features(x) @ self.weights, self.knots, self.values), 0.0, 1.0)

    def column(self, x: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def scored(batch: pd.Series) -> pd.Series:
            return pd.Series(model.score(np.stack(batch.to_numpy())) if len(batch) else np.zeros(0))

        return scored(x)


def isotonic(score: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of ones/total, non-decreasing in ``score`` (sorted)."""
    blocks: list[list[float]] = []  # ones, total, sum of score * total
    for s, t, o in zip(score, total, ones):
        blocks.append([o, t, s * t])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE, gamma: float = GAMMA,
        seed: int = 5) -> QualityModel:
    """Fit on ``labels`` (doc_id, y in 0/1) joined to ``stats`` (doc_id, x). All labelled rows are used.

    Without labelled rows every score is 0.5; with one class only, that class's value.
    """
    train = written(stats.join(labels.where("y in (0, 1)").select("doc_id", "y"), "doc_id")
                    .select("x", F.col("y").cast("double").alias("y"),
                            F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")), "quality-train")
    d = len(STATISTICS)
    moments = train.agg(F.count("*").alias("n"), F.avg("y").alias("p"),
                        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)],
                        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    rng = np.random.default_rng(seed)
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(d)])
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), gamma * rng.standard_normal((d, features)),
                         rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    if not moments.n:
        return model
    if moments.p in (0.0, 1.0):
        model.values = np.array([moments.p])
        return model
    width = features + 1

    def normal_equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right = np.zeros((FOLDS, width, width)), np.zeros((FOLDS, width))
        seen = False
        for batch in batches:
            for fold in range(FOLDS):
                part = batch[batch["fold"] == fold]
                if len(part):
                    seen = True
                    z = model.features(np.stack(part["x"].to_numpy()))
                    gram[fold] += z.T @ z
                    right[fold] += z.T @ part["y"].to_numpy()
        if seen:  # one row per fold and matrix row, so that partitions are summed row by row
            for fold in range(FOLDS):
                yield pd.DataFrame({"fold": fold, "i": np.arange(width),
                                    "row": list(np.concatenate([gram[fold], right[fold][:, None]], axis=1))})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "i": pdf["i"].iloc[:1],
                             "row": [np.sum(np.stack(pdf["row"].to_numpy()), axis=0)]})

    schema = "fold int, i int, row array<double>"
    sums = np.zeros((FOLDS, width, width + 1))
    for r in train.mapInPandas(normal_equations, schema).groupBy("fold", "i").applyInPandas(add, schema).collect():
        sums[r.fold, r.i] = r.row

    def solve(total: np.ndarray) -> np.ndarray:
        penalty = ridge * max(1.0, total[-1, width - 1] / width) * np.eye(width)
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(total[:, :width] + penalty, total[:, width])

    model.weights = solve(sums.sum(axis=0))
    unseen = [solve(sums.sum(axis=0) - sums[f]) if sums[1 - f][-1, width - 1] else model.weights for f in range(FOLDS)]

    def out_of_fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = model.features(np.stack(batch["x"].to_numpy()))
            raw = np.choose(batch["fold"].to_numpy(), [z @ w for w in unseen])
            yield pd.DataFrame({"step": np.clip(np.floor(raw * GRID), -GRID, 2 * GRID).astype(int), "y": batch["y"]})

    steps = (train.mapInPandas(out_of_fold, "step int, y double").groupBy("step")
             .agg(F.count("*").alias("n"), F.sum("y").alias("ones")).orderBy("step").collect())
    model.knots, model.values = isotonic(np.array([(r.step + 0.5) / GRID for r in steps]),
                                         np.array([r.n for r in steps], float), np.array([r.ones for r in steps]))
    return model


def training_labels(labels: DataFrame, column: str, modulus: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, y) of the rows that may be learned from; an id with several labels counts as 1 if any is."""
    ids = F.col("doc_id").cast("long")
    return (labels.where(is_train(ids, modulus, held) & F.col(column).isin(0, 1))
            .groupBy(ids.alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("y")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts are scored like any text (all statistics zero). Repeated rows
    are returned as often as they occur; a null doc_id is not held out. An empty table
    gives no rows; no labels give 0.5 everywhere. Further columns are ignored.
    """
    stats = written(with_statistics(docs), "statistics")
    model = fit(stats, training_labels(labels, "quality"))
    score = stats.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), model.column(F.col("x")).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with their columns as they are.

    Rows are stored once with their statistics; fitting reads the statistics alone. Null
    and empty texts are scored like any text (all statistics zero). Repeated rows stay or
    go together; a row without doc_id is judged but not learned from. Without labels
    every score is 0.5, so every row stays. An empty table gives no rows. Further
    columns, whatever their names, are kept.
    """
    ready(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t or "") for t in texts], dtype=object)

    rows = written(docs.select(F.struct(*docs.columns).alias("whole"), measured(F.col("text")).alias("x")), "measured")
    model = fit(rows.select(F.col("whole.doc_id").cast("long").alias("doc_id"), "x"), training_labels(labels, "quality"))
    return rows.where(model.column(F.col("x")) >= 0.5).select("whole.*")
