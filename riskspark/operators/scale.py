"""Standardisation as projections, from statistics that are already known."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scaled(column: str, mean: float, std: float) -> Column:
    """(x - mean) / std; 0.0 where std is 0 or unknown (missing values stay missing where it is not)."""
    if not np.isfinite(std) or std <= 0:
        return F.lit(0.0)
    return (F.col(column) - F.lit(float(mean))) / F.lit(float(std))


def scale_with(df: DataFrame, columns: Sequence[str], scaler: tuple) -> DataFrame:
    """``columns`` replaced by their scaled values; ``scaler``: (means, population stds) in their order."""
    mean, std = scaler
    return df.withColumns({c: scaled(c, mean[j], std[j]) for j, c in enumerate(columns)})


def scale_by_fold(df: DataFrame, columns: Sequence[str], scalers: Mapping[int, tuple], fold_col: str = "fold",
                  into: str = "for_fold") -> DataFrame:
    """Every row once per validation fold, scaled with the training statistics of that fold.

    Adds INT ``into`` (the validation fold) and BOOLEAN is_val (the row belongs to it). A projection with one
    generated row per fold: no shuffle, and a filter on ``into`` reads the scan once for that fold alone."""
    folds = sorted(scalers)
    rows = df.withColumn(into, F.explode(F.array(*[F.lit(int(i)) for i in folds])))
    out = {"is_val": F.col(fold_col) == F.col(into)}
    for j, c in enumerate(columns):
        value = F.lit(None).cast("double")
        for i in folds:
            value = F.when(F.col(into) == i, scaled(c, scalers[i][0][j], scalers[i][1][j])).otherwise(value)
        out[c] = value
    return rows.withColumns(out)
