"""K-fold cross-validation with leak-free per-fold scaling.

Shape of the work for k folds and M model configurations:
  1 job   per-fold moments of the continuous columns (grouped by fold)
  1 job   Gram per fold (closed-form / plain-MSE models: all folds, all grid points)
  T jobs  one gradient pass per GD step for every iterative model and fold at once
  1 job   evaluation: training loss, validation loss, validation score histogram
          (threshold search) and confusion counts for every (model, fold)
Only O(k * M * D^2) numbers ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.columns import threshold_grid
from riskspark.operators import linear
from riskspark.operators.clean import FeatureLayout
from riskspark.operators.coded import pack_coded
from riskspark.operators.encode import assemble
from riskspark.operators.evaluate import best_threshold_from_hist, metrics_np
from riskspark.operators.gd import Task, _codes, _row_terms, _affine, class_ratios, effective_weights, fit_gd
from riskspark.operators.grouped import pack_grouped
from riskspark.operators.moments import (BLOCK_BYTES, PARTIAL_SCHEMA, batches_for, chunked, is_blocks, iter_xyk, unchunk,
                                         fold_moments,
                                         global_scaler, partial_batch, reduce_partials, training_scalers)
from riskspark.operators.split import fold_column, holdout_column
from riskspark.sources.snapshot import stored_rows
from riskspark.sources.steps import StepTable, run_name

GRAM_KINDS = ("least_squares", "ridge")
QR_KINDS = ("least_squares_qr", "ridge_qr")


@dataclass
class ModelConfig:
    """One model family + hyper-parameters (the reference's model classes, F3-F7)."""
    kind: str = "logistic"        # least_squares | mse_gd | ridge | logistic | reg_logistic, and
    #                               least_squares_qr | ridge_qr: the same models by QR, for ill-conditioned features
    max_iters: int = 200
    gamma: float = 0.7
    lam: float = 0.0
    balance: str | None = None    # mse: residual_sign; logistic: label | sigmoid_scale
    name: str = ""
    search: int | None = None     # thresholds to search (None: the cross_validate argument)
    threshold: float | None = None  # fixed threshold (None: the cross_validate argument)
    positions: tuple | None = None  # layout positions the model uses (None: all); others stay 0
    initial_w: tuple | None = None  # start of gradient descent, one number per layout position (None: zeros)

    @property
    def loss(self) -> str:
        return "logistic" if self.kind in ("logistic", "reg_logistic") else "mse"

    @property
    def uses_gram(self) -> bool:
        return self.kind in GRAM_KINDS or (self.kind == "mse_gd" and not self.balance)

    @property
    def uses_qr(self) -> bool:
        return self.kind in QR_KINDS

    @property
    def penalty_in_score(self) -> bool:
        return self.kind in ("ridge", "ridge_qr", "reg_logistic")


def scaler_affine(d: int, cont_pos: Sequence[int], mean: np.ndarray, std: np.ndarray):
    """a, c with x~_j = a_j x_j + c_j: (x - mu) / sigma on continuous positions,
    0.0 where sigma is 0 (instead of inf / NaN)."""
    a, c = np.ones(d), np.zeros(d)
    for j, p in enumerate(cont_pos):
        s = std[j]
        if s > 0 and np.isfinite(s):
            a[p], c[p] = 1.0 / s, -mean[j] / s
        else:
            a[p], c[p] = 0.0, 0.0
    return a, c


def prepare(df: DataFrame, layout: FeatureLayout, k: int = 5, seed=1, holdout_ratio: float = 0.8,
            holdout_seed=1, id_col: str = "id", label_col: str = "label", split_col: str | None = "split",
            train_value: str = "train") -> DataFrame:
    """Training rows with (id, y, fold, holdout, <layout columns>, x).

    A frame of ``CleaningModel.transform_coded`` keeps its codes; x then holds the continuous positions alone.
    Rows of the test split are excluded; ``holdout`` marks the constructor's
    20 % local test part (seed fixed at 1 as in the reference, SURVEY Q9)."""
    rows = df if split_col is None else df.filter(F.col(split_col) == F.lit(train_value))
    columns = [fc for fc in layout.columns if fc.kind != "onehot"] if "codes" in df.columns else layout.columns
    names = [fc.name for fc in columns]
    base = [F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")]
    feats = [F.lit(1.0).alias(n) if fc.kind == "intercept" else F.col(n).cast("double").alias(n)
             for n, fc in zip(names, columns)] + ([F.col("codes")] if "codes" in df.columns else [])
    out = rows.select(*base, *feats)
    out = out.withColumn("holdout", holdout_column(holdout_ratio, holdout_seed, "id"))
    out = out.withColumn("fold", F.when(F.col("holdout"), F.lit(-1)).otherwise(fold_column(k, seed, "id")))
    return out.withColumn("x", assemble(names))


def _start(cfg: ModelConfig, d: int) -> np.ndarray:
    """First weights of gradient descent."""
    if cfg.initial_w is None:
        return np.zeros(d)
    if len(cfg.initial_w) != d:
        raise ValueError(f"initial_w has {len(cfg.initial_w)} numbers, the layout {d} positions")
    return np.array(cfg.initial_w, dtype=float)


@dataclass
class FoldResult:
    config: int
    fold: int
    train_loss: float
    val_loss: float
    threshold: float
    metrics: dict
    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray


@dataclass
class CVResult:
    configs: list
    folds: list = field(default_factory=list)
    layout: FeatureLayout | None = None

    def rows(self):
        for r in self.folds:
            yield {"config": r.config, "fold": r.fold, "train_loss": r.train_loss, "val_loss": r.val_loss,
                   "threshold": r.threshold, **r.metrics}

    def to_df(self, spark: SparkSession) -> DataFrame:
        cols = ["config", "fold", "train_loss", "val_loss", "threshold", "accuracy", "recall", "fpr",
                "precision", "f1"]
        data = [tuple(int(r[c]) if c in ("config", "fold") else float(r[c]) for c in cols) for r in self.rows()]
        schema = ", ".join(f"{c} {'bigint' if c in ('config', 'fold') else 'double'}" for c in cols)
        return spark.createDataFrame(data, schema)

    def average(self, config: int = 0):
        """Element-wise means over folds of weights, thresholds, means, stds."""
        rs = [r for r in self.folds if r.config == config]
        return (np.mean([r.weights for r in rs], axis=0), float(np.mean([r.threshold for r in rs])),
                np.mean([r.mean for r in rs], axis=0), np.mean([r.std for r in rs], axis=0))


def _eval_pass(data: DataFrame, d: int, tasks: Sequence[Task], W: np.ndarray, ratios: np.ndarray,
               fixed: Sequence[float], n_thr: int, n_parts: int | None = None):
    """Per task: training loss (as trained), plain validation loss, validation
    histogram over the threshold grid, confusion counts at a fixed threshold."""
    A, C = _affine(tasks, d)
    V, b = effective_weights(W, A, C)
    val = np.array([t.val_fold for t in tasks])
    loss_codes, bal_codes = _codes(tasks)
    plain = np.zeros_like(bal_codes)
    grid = np.array(threshold_grid(max(n_thr, 1)))
    nb = len(grid) + 1
    fixed = np.asarray(fixed, dtype=float)
    M = len(tasks)
    width = 4 + 2 * nb + 4

    def kernel(batches):
        acc = np.zeros((M, width))
        for X, y, fold in iter_xyk(batches, d, "x", "y", "fold"):
            tr = (fold[:, None] != val[None, :]).astype(float)
            va = (fold[:, None] == val[None, :]).astype(float)
            T = X @ V + b
            _, Ltr = _row_terms(T, y, tr, loss_codes, bal_codes, ratios)
            _, Lva = _row_terms(T, y, va, loss_codes, plain, ratios)
            with np.errstate(over="ignore"):
                Fs = np.where(loss_codes[None, :] == 1, 1.0 / (1.0 + np.exp(-T)), T)
            pos = y != -1
            for m in range(M):
                vm = va[:, m] > 0
                f = Fs[vm, m]
                bk = np.searchsorted(grid, f, side="left")
                bk[np.isnan(f)] = nb - 1
                p = pos[vm]
                hp = np.bincount(bk[p], minlength=nb)
                hn = np.bincount(bk[~p], minlength=nb)
                pred = f > fixed[m]
                conf = [np.sum(p & pred), np.sum(p & ~pred), np.sum(~p & ~pred), np.sum(~p & pred)]
                acc[m] += np.concatenate([[Ltr[:, m].sum(), tr[:, m].sum(), Lva[:, m].sum(), vm.sum()],
                                          hp, hn, conf])
        yield partial_batch(chunked(acc.ravel()))

    from riskspark.session import ship_package
    ship_package(data.sparkSession)
    src = data if is_blocks(data) else data.select("x", "y", "fold")
    with batches_for(src):
        return unchunk(reduce_partials(src.mapInArrow(kernel, PARTIAL_SCHEMA), n_parts)).reshape(M, width), nb


def _kept_rows(rows: DataFrame, path: str, state: StepTable) -> DataFrame:
    """``rows`` written to ``path`` once; a mark in the step table says that they are all there."""
    spark = rows.sparkSession
    if state.last("train rows", 0) is None:
        rows.write.mode("overwrite").parquet(path)
        state.save("train rows", 0, np.zeros((1, 1)))
    return spark.read.schema(rows.schema).parquet(path)


def _kept_moments(values: DataFrame, cont: Sequence[str], state: StepTable) -> dict:
    """``fold_moments`` computed once in a run's folder. Spark adds partial sums in the order in which they arrive, so a
    second computation may differ in the last bits, and the scalers would be those of another run."""
    name, width = run_name("moments", list(cont)), len(cont)
    found = state.last(name, 0)
    if found is None:
        mom = fold_moments(values, cont, "fold")
        if mom:
            state.save(name, 0, np.array([np.concatenate([[fold], *parts]) for fold, parts in mom.items()]))
        return mom
    return {int(r[0]): (r[1:1 + width], r[1 + width:1 + 2 * width], r[1 + 2 * width:]) for r in found[1]}


def cross_validate(data: DataFrame, layout: FeatureLayout, configs: Sequence[ModelConfig], k: int = 5,
                   search_thresholds: int = 0, threshold: float = 0.0,
                   folds: Sequence[int] | None = None, resume: str | None = None, save_every: int = 25) -> CVResult:
    """G3 for several model configurations at once on ``prepare``d data
    (rows with fold == -1 -- the holdout -- are never used). ``folds`` lists
    the validation folds to run (default 0..k-1; ``[-1]`` trains on all rows).
    The training rows are written once, as (y, fold, x) in the shared checkpoint folder,
    and read from there: joins and cleaning run in their own tasks and only once, whatever
    is lost later; asking the snapshot for its partitions starts no job. ``pack_grouped``
    deals the packed blocks out over the cores.

    ``resume`` names a folder of this run: its training rows, their moments and, every ``save_every``
    steps, its weights are kept there, and a call with the same arguments and folder goes on from
    the last stored step (the same rows in the same partitions, so the same result to the last bit)."""
    d = len(layout.names)
    if layout.columns[0].kind != "intercept":
        raise ValueError("cross_validate needs the intercept at position 0 (add_intercept)")
    cont_pos = layout.continuous_positions()
    cont = [layout.names[p] for p in cont_pos]
    coded = "codes" in data.columns
    rows = data.filter(F.col("fold") >= 0).select("y", "fold", "x", *(["codes"] if coded else []))
    state = None
    if resume is None:
        train = stored_rows(rows, "train")
    else:
        state = StepTable(data.sparkSession, f"{resume.rstrip('/')}/steps", save_every)
        train = _kept_rows(rows, f"{resume.rstrip('/')}/train", state)
    blocks = None
    fold_ids = list(range(k)) if folds is None else list(folds)
    try:
        # in coded rows, x holds the positions that are not one-hot
        place = {p: i for i, p in enumerate(p for p, fc in enumerate(layout.columns) if not coded or fc.kind != "onehot")}
        values = train.select("fold", *[F.col("x")[place[p]].alias(n) for p, n in zip(cont_pos, cont)])
        mom = {} if not cont else fold_moments(values, cont, "fold") if state is None else _kept_moments(values, cont, state)
        scalers = (training_scalers(mom, fold_ids) if cont
                   else {i: (np.zeros(0), np.zeros(0)) for i in fold_ids})
        tasks, where = [], []
        for ci, cfg in enumerate(configs):
            for i in fold_ids:
                a, c = scaler_affine(d, cont_pos, *scalers[i])
                tasks.append(Task(cfg.loss, cfg.gamma, cfg.lam if cfg.kind == "reg_logistic" else 0.0, i,
                                  cfg.balance, a, c))
                where.append((ci, i))
        M = len(tasks)
        W = np.zeros((d, M))
        train_loss = np.full(M, np.nan)
        ratios = class_ratios(train, tasks, "fold", "y") if any(t.balance for t in tasks) else np.ones(M)
        # every later pass (Gram, GD steps, evaluation) streams instance blocks. Few large partitions are dealt
        # out over the cores, whole blocks each (lost rows are dealt alike again: Spark sorts them first)
        if coded:
            cores = max(1, train.sparkSession.sparkContext.defaultParallelism)
            n_rows = int(sum(v[0].max() for v in mom.values())) if mom else train.count()
            target = min(cores, -(-8 * d * n_rows // BLOCK_BYTES) or 1)
            src = train.repartition(target) if train.rdd.getNumPartitions() < target else train
            blocks = pack_coded(src, layout)
        else:
            blocks = pack_grouped(train, "x", d, "y", "fold")
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()              # lost blocks are packed again from the snapshot
        n_parts = blocks.rdd.getNumPartitions()

        gram_idx = [m for m, (ci, _) in enumerate(where) if configs[ci].uses_gram]
        qr_idx = [m for m, (ci, _) in enumerate(where) if configs[ci].uses_qr]
        shift, scale = np.zeros(d), np.ones(d)
        if gram_idx or qr_idx:
            gmu, gsd = global_scaler(mom) if cont else (np.zeros(0), np.zeros(0))
            for j, p in enumerate(cont_pos):
                if gsd[j] > 0 and np.isfinite(gsd[j]):
                    shift[p], scale[p] = gmu[j], gsd[j]
        if qr_idx:
            factors = linear.fold_factors(blocks, d, "x", "y", "fold", shift, scale)
            for m in qr_idx:
                ci, i = where[m]
                t = tasks[m]
                A = linear.affine_matrix(t.a * scale, t.a * shift + t.c)
                R = linear.map_factor(linear.combine_factors(factors, i), A)
                n = float(R[:, 0] @ R[:, 0])                      # intercept column: sum of 1 * 1
                idx = list(configs[ci].positions) if configs[ci].positions is not None else list(range(d))
                R = linear.fold_in(np.zeros((0, len(idx) + 1)), R[:, [*idx, d]])
                w, rss = linear.least_squares_qr(R, n, configs[ci].lam if configs[ci].kind == "ridge_qr" else 0.0)
                W[idx, m] = w
                train_loss[m] = rss / (2.0 * n)
        if gram_idx:
            grams = linear.fold_grams(blocks, d, "x", "y", "fold", shift, scale)
            for m in gram_idx:
                ci, i = where[m]
                cfg = configs[ci]
                t = tasks[m]
                # x~ = a x + c with x = x' * scale + shift  =>  x~ = (a*scale) x' + (a*shift + c)
                A = linear.affine_matrix(t.a * scale, t.a * shift + t.c)
                G, bvec, yy, n = linear.map_gram(linear.combine(grams, i), A)
                idx = list(cfg.positions) if cfg.positions is not None else list(range(d))
                G, bvec = G[np.ix_(idx, idx)], bvec[idx]          # lower degrees: sub-matrices
                if cfg.kind == "least_squares":
                    w = linear.least_squares(G, bvec)
                elif cfg.kind == "ridge":
                    w = linear.ridge(G, bvec, n, cfg.lam)
                else:
                    w = linear.gd_from_gram(G, bvec, n, cfg.gamma, cfg.max_iters, _start(cfg, d)[idx])
                W[idx, m] = w
                train_loss[m] = linear.mse_from_gram(G, bvec, yy, n, w)

        by_steps: dict = {}
        for m, (ci, _) in enumerate(where):
            if not configs[ci].uses_gram and not configs[ci].uses_qr:
                by_steps.setdefault(configs[ci].max_iters, []).append(m)
        for steps, idx in by_steps.items():
            sub = [tasks[m] for m in idx]
            mask = np.ones((d, len(idx)))
            for col, m in enumerate(idx):
                pos = configs[where[m][0]].positions
                if pos is not None:
                    mask[:, col] = 0.0
                    mask[list(pos), col] = 1.0
            initial = mask * np.column_stack([_start(configs[where[m][0]], d) for m in idx])
            Wsub, lsub = fit_gd(blocks, d, sub, steps, ratios=ratios[idx], initial=initial, mask=mask, state=state)
            W[:, idx] = Wsub
            train_loss[idx] = lsub

        result = CVResult(list(configs), layout=layout)
        per_task = []
        for ci, _ in where:
            cfg = configs[ci]
            n = cfg.search if cfg.search is not None else search_thresholds
            fixed_t = cfg.threshold if cfg.threshold is not None else threshold
            if cfg.loss == "logistic" and n == 0 and fixed_t <= 0.0:
                import warnings
                warnings.warn(f"{cfg.kind}: sigmoid scores are > 0, so a fixed threshold of {fixed_t} "
                              "predicts every row positive", stacklevel=2)
            per_task.append((n, 0.0 if n > 0 else fixed_t))   # a search falls back to 0.0
        stats = {}
        for n in sorted({n for n, _ in per_task}):
            idx = [m for m in range(M) if per_task[m][0] == n]
            acc, nb = _eval_pass(blocks, d, [tasks[m] for m in idx], W[:, idx], ratios[idx],
                                 [per_task[m][1] for m in idx], n if n > 0 else 1, n_parts)
            for row, m in zip(acc, idx):
                stats[m] = (row, nb)
        for m, (ci, i) in enumerate(where):
            cfg = configs[ci]
            row, nb = stats[m]
            n, fixed = per_task[m]
            val_loss = row[2] / row[3] if row[3] > 0 else float("nan")
            if cfg.penalty_in_score:
                val_loss += cfg.lam * float(np.sum(W[:, m] ** 2))
            hp, hn = row[4:4 + nb], row[4 + nb:4 + 2 * nb]
            thr, counts = fixed, tuple(row[4 + 2 * nb:])
            if n > 0:
                best_t, _, best_counts = best_threshold_from_hist(hp, hn, n)
                if best_counts is not None:
                    thr, counts = best_t, best_counts
            result.folds.append(FoldResult(ci, i, float(train_loss[m]), float(val_loss), float(thr),
                                           metrics_np(*counts), scalers[i][0], scalers[i][1], W[:, m].copy()))
        return result
    finally:
        if blocks is not None:
            blocks.unpersist()
