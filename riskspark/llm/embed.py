"""Embedding near-duplicates with a random-projection tree forest.

Vectors are compared within (label, dimension). Equal vectors are merged first
and keep their multiplicity, so a vector that holds a third of all rows is one
point. Every tree splits by a random direction at the median of a bounded
sample's projections; a point within ``spill`` of the threshold goes to both
sides. The sample only places thresholds: every vector is indexed.

Two unit vectors at cosine c are sqrt(2 - 2c) apart, so their projections on a
random direction in ``dim`` dimensions differ by about that / sqrt(dim). The
spill covers ``SPILL_SIGMAS`` of it on either side; a pair parts only if it
differs by over twice the spill and straddles the threshold, and it must part in
every tree to be missed.

A leaf compares all its points by one blocked matrix product in double
precision. A pair that shares several leaves counts in the smallest of them
only, which each leaf decides from its members' leaf lists; so a leaf returns
link counts and the edges of its spanning stars, never its pairs. A leaf with
more than ``leaf_rows`` points (a dense cluster no direction parts) is dealt out
as blocks against blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import components, ready, written

TREES = 4
SAMPLE_ROWS = 20_000
LEAF_ROWS = 256
BLOCK_ROWS = 2048
SPILL_SIGMAS = 1.5
MAX_DEPTH = 14


def _valid(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, label, v) of the rows that may link; v is the vector in its own element type, -0.0 as 0.0."""
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    v = F.transform(F.col(vector), lambda x: x.cast(kind))
    good = (F.col("label").isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)
            & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("v", lambda x: x != 0))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.alias("v"), F.col(vector))
            .where(good).select("vec_id", "label", F.transform("v", lambda x: x + F.lit(0.0).cast(kind)).alias("v")))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first so that squares stay finite."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Forest:
    """Random-projection trees over one dimension, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, dim: int, depth: int, threshold: float, trees: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.spill = SPILL_SIGMAS * np.sqrt(max(0.0, 2 - 2 * threshold)) / np.sqrt(dim)
        self.trees = []
        for _ in range(trees):
            directions = rng.standard_normal((depth, dim))
            directions /= np.linalg.norm(directions, axis=1, keepdims=True)
            cuts: dict[int, float] = {}
            groups = {1: np.arange(len(sample))}  # node -> sample rows
            for level in range(depth):
                deeper = {}
                for node, rows in groups.items():
                    if len(rows) < 16:  # too few sample rows to place a threshold: the node is a leaf
                        continue
                    p = sample[rows] @ directions[level]
                    cuts[node] = cut = float(np.median(p))
                    deeper[2 * node], deeper[2 * node + 1] = rows[p <= cut + self.spill], rows[p > cut - self.spill]
                groups = deeper
            self.trees.append((directions, cuts))

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf of every tree that each row of ``unit`` belongs to."""
        rows_out, leaves_out = [], []
        for t, (directions, cuts) in enumerate(self.trees):
            todo = [(1, 0, np.arange(len(unit)))]
            while todo:
                node, level, rows = todo.pop()
                if not len(rows):
                    continue
                if node not in cuts:
                    rows_out.append(rows)
                    leaves_out.append(np.full(len(rows), (t << 40) | node, np.int64))
                    continue
                p = unit[rows] @ directions[level]
                todo.append((2 * node, level + 1, rows[p <= cuts[node] + self.spill]))
                todo.append((2 * node + 1, level + 1, rows[p > cuts[node] - self.spill]))
        if not rows_out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def _pairs_in(left: pd.DataFrame, right: pd.DataFrame, same: bool, leaf: int, threshold: float):
    """Counts per point of left and right and a star edge list, for the pairs this leaf owns."""
    a, b = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
    a, b = _unit(a), _unit(b)
    smaller = sorted({x for ls in (left["leaves"], right["leaves"]) for row in ls for x in row if x < leaf})
    at = {x: k for k, x in enumerate(smaller)}

    def member(frame):
        out = np.zeros((len(frame), max(1, len(smaller))), np.float32)
        for r, row in enumerate(frame["leaves"]):
            for x in row:
                if x < leaf:
                    out[r, at[x]] = 1
        return out

    ma, mb = member(left), member(right)
    wl, wr = left["copies"].to_numpy(np.int64), right["copies"].to_numpy(np.int64)
    nl, nr = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    low = np.arange(len(left) + (0 if same else len(right)))
    edges_a, edges_b = [], []
    for part in range(0, len(a), 512):
        hit = a[part:part + 512] @ b.T >= threshold
        if same:
            hit &= np.arange(part, min(part + 512, len(a)))[:, None] < np.arange(len(b))[None, :]
        new = hit & ~((ma[part:part + 512] @ mb.T) > 0)
        nl[part:part + 512] += new @ wr
        nr += new.T @ wl[part:part + 512]
        i, j = np.nonzero(new)
        edges_a.append(i + part)
        edges_b.append(j + (0 if same else len(left)))
    i, j = np.concatenate(edges_a), np.concatenate(edges_b)
    while len(i):  # smallest index that links reach
        m = np.minimum(low[i], low[j])
        nxt = low.copy()
        np.minimum.at(nxt, i, m)
        np.minimum.at(nxt, j, m)
        nxt = nxt[nxt]
        if (nxt == low).all():
            break
        low = nxt
    ids = left["pid"].to_numpy(np.int64) if same else np.concatenate([left["pid"], right["pid"]]).astype(np.int64)
    return nl, nr, np.stack([ids[low != np.arange(len(low))], ids[low[low != np.arange(len(low))]]], axis=1)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, vector: str = "embedding", trees: int = TREES,
                    leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Rows link when their labels are equal and not null, their vectors have one
    length and their cosine is ``threshold`` or more. A null label, or a vector
    that is null, empty, zero or holds null or non-finite components, links with
    nothing. A null vec_id keeps its row with a null component_id unless it links.
    vec_id names a vector: repeated rows of an id count as vectors of their own. An
    empty table gives no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    ready(spark)
    if "label" not in vectors.columns:
        raise ValueError("vectors need a label column")
    points = written(
        _valid(vectors, vector).groupBy("label", "v").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("v")).withColumn("pid", F.monotonically_increasing_id()), "points")
    fits = {}
    for row in points.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n"), F.sum("count").alias("total")).collect():
        share = min(1.0, sample_rows / row.total)
        picked = points.where((F.col("dim") == row.dim) & (F.pmod(F.xxhash64("v"), F.lit(1_000_000)) < int(1e6 * share)))
        sample = np.array([r.v for r in picked.select("v").collect()], np.float64).reshape(-1, row.dim)
        depth = int(min(MAX_DEPTH, max(0, np.ceil(np.log2(row.n / leaf_rows)))))
        fits[row.dim] = Forest(_unit(sample) if len(sample) else sample, row.dim, depth, threshold, trees, seed)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                r, leaf = fits[dim].leaves(_unit(np.stack(part["v"].to_numpy())))
                order = np.lexsort((leaf, r))
                r, leaf = r[order], leaf[order]
                lists = np.split(leaf, np.flatnonzero(np.diff(r)) + 1)
                yield part.assign(leaves=[x.tolist() for x in lists])

    label_type = points.schema["label"].dataType
    schema = T.StructType([*points.schema.fields, T.StructField("leaves", T.ArrayType(T.LongType()))])
    indexed = written(points.mapInPandas(index, schema), "indexed")
    placed = indexed.select("pid", "label", "dim", "v", "copies", "leaves", F.explode("leaves").alias("leaf"))
    # a table of the few large leaves: small enough to broadcast (Spark checks its size), no leaf gathers in the join
    sizes = written(placed.groupBy("label", "dim", "leaf").count().where(F.col("count") > BLOCK_ROWS)
                    .select("label", "dim", "leaf", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")), "large")
    cells = (placed.join(sizes, ["label", "dim", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("pid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j, leaf = int(pdf["i"].iat[0]), int(pdf["j"].iat[0]), int(pdf["leaf"].iat[0])
        left = pdf[pdf["own"] == i]
        right = left if i == j else pdf[pdf["own"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        nl, nr, edges = _pairs_in(left, right, i == j, leaf, threshold)
        counts = pd.DataFrame({"a": np.concatenate([left["pid"], right["pid"]]).astype(np.int64), "b": -1,
                               "n": np.concatenate([nl, nr])})
        stars = pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1], "n": 0})
        return pd.concat([counts[counts["n"] > 0], stars], ignore_index=True)

    cell = ("label", "dim", "leaf", "i", "j")  # dealt by all of it: the blocks of a leaf go to different tasks
    found = written(cells.repartition(*cell).groupBy(*cell).applyInPandas(compare, "a long, b long, n long"), "links")
    counts = found.where("b < 0").groupBy(F.col("a").alias("pid")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b >= 0").select("a", "b")).withColumnRenamed("node", "pid")
    named = (indexed.select("pid", "label", "v", "low", "copies").join(counts, "pid", "left").join(roots, "pid", "left")
             .withColumn("root", F.coalesce("component", "pid")))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    result = (named.join(lows, "root")
              .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    valid = _valid(vectors, vector).join(result, ["label", "v"]).select("vec_id", "n_links", "component_id")
    seen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col(vector))
    odd = (seen.withColumn("v", F.transform(vector, lambda x: x.cast("double")))
           .where(F.col("label").isNull() | F.col(vector).isNull() | (F.size(vector) == 0)
                  | F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                  | ~F.exists("v", lambda x: x != 0))
           .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return valid.unionByName(odd).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
