"""The reference's ``Dataset`` surface over a cleaned DataFrame.

No copies: the 80/20 holdout and the folds are columns of one frame; a fold's
training / validation parts are filters; scaling statistics are aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.hashing import fraction_cut, hash32
from riskspark.operators.clean import FeatureLayout
from riskspark.operators.moments import fold_moments, training_scalers
from riskspark.operators.scale import scale_by_fold, scale_with
from riskspark.plans import cv


class Dataset:
    def __init__(self, clean: DataFrame, layout: FeatureLayout, seed=1, k: int = 5, holdout_seed=1,
                 ratio: float = 0.8):
        self.layout = layout.with_intercept()
        self.seed = seed
        self.k = k
        self.data = cv.prepare(clean, self.layout, k, seed, ratio, holdout_seed)

    def __len__(self) -> int:
        """Rows of the training part (holdout excluded)."""
        return self.data.filter(F.col("fold") >= 0).count()

    def get_test_set(self) -> DataFrame:
        """The raw (unscaled) holdout rows."""
        return self.data.filter(F.col("holdout"))

    def fold(self, i: int) -> tuple[DataFrame, DataFrame]:
        """(training rows, validation rows) of fold i."""
        rows = self.data.filter(F.col("fold") >= 0)
        return rows.filter(F.col("fold") != i), rows.filter(F.col("fold") == i)

    def fold_scalers(self) -> dict:
        """C4: {fold: (mean, pop std)} of the continuous columns, all folds in one job."""
        cont = self.layout.continuous
        return training_scalers(fold_moments(self.data.filter(F.col("fold") >= 0), cont, "fold"), range(self.k))

    def scaled_folds(self) -> DataFrame:
        """(id, y, fold, for_fold, is_val, <continuous columns>, other layout columns): every training row once per
        fold, scaled with that fold's training statistics."""
        rows = self.data.filter(F.col("fold") >= 0).drop("x", "holdout")
        return scale_by_fold(rows, self.layout.continuous, self.fold_scalers())

    def split_data(self, ratio: float = 0.8) -> tuple[DataFrame, DataFrame, tuple]:
        """One seeded split of the training part, both sides scaled with the training side's statistics, which
        are returned too."""
        rows = self.data.filter(F.col("fold") >= 0)
        part = hash32(f"valsplit:{self.seed}", "id") < F.lit(fraction_cut(ratio))
        train, val = rows.filter(part), rows.filter(~part)
        cont = self.layout.continuous
        mom = fold_moments(train.withColumn("fold", F.lit(0)), cont, "fold")
        mean, std = training_scalers(mom, [-1])[-1]
        return scale_with(train, cont, (mean, std)), scale_with(val, cont, (mean, std)), (mean, std)

    def cross_validate(self, configs, search_thresholds: int = 0, threshold: float = 0.0) -> cv.CVResult:
        return cv.cross_validate(self.data, self.layout, configs, self.k, search_thresholds, threshold)
