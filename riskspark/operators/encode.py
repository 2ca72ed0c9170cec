"""One-hot, intercept, polynomial powers and assembly."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def token(value) -> str:
    """Column-name-safe rendering of a category value."""
    if value is None:
        return "null"
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    text = str(value).replace("-", "m").replace(".", "p")
    return re.sub(r"[^0-9A-Za-z_]", "_", text)


def onehot_names(column: str, vocab: Sequence) -> list[str]:
    return [f"{column}_{token(v)}" for v in vocab]


def onehot_exprs(column: str, vocab: Sequence) -> list[Column]:
    """One 0/1 DOUBLE column per vocabulary value, no level dropped."""
    col = F.col(column)
    out = []
    for v, name in zip(vocab, onehot_names(column, vocab)):
        hit = col.isNull() if v is None else col.eqNullSafe(F.lit(v))
        out.append(hit.cast("double").alias(name))
    return out


def power_names(column: str, degree: int) -> list[str]:
    return [column if j == 1 else f"{column}_p{j}" for j in range(1, degree + 1)]


def poly_exprs(columns: Sequence[str], degree: int) -> list[Column]:
    """Powers 1..degree of each column, interleaved x1, x1^2, x2, x2^2.
    No cross terms (unlike ml.feature.PolynomialExpansion)."""
    out = []
    for c in columns:
        for j, name in zip(range(1, degree + 1), power_names(c, degree)):
            e = F.col(c) if j == 1 else F.pow(F.col(c), F.lit(float(j)))
            out.append(e.cast("double").alias(name))
    return out


def intercept_expr(name: str = "intercept") -> Column:
    return F.lit(1.0).alias(name)


def assemble(columns: Sequence[str], name: str = "x") -> Column:
    """Dense ARRAY<DOUBLE> in layout order; the training kernels read this."""
    return F.array(*[F.col(c).cast("double") for c in columns]).alias(name)
