"""Mapping rules applied in order (a left fold).

Rules are plain CASE projections. A ``mean`` rule needs the mean of the column *at
that step* per split; all such means, of all levels and columns, come from one
grouped aggregate (see ``mean_chain``), and the projection holds them as literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.mean_chain import chain_means
from riskspark.sources.spec import Rule


def rule_mask(col: Column, rule: Rule) -> Column:
    if rule.kind == "missing":
        return col.isNull()
    if rule.kind == "range":
        return col.between(F.lit(rule.lo), F.lit(rule.hi))
    return col == F.lit(rule.key)


def _typed_value(value, dtype: str) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    return F.lit(value).cast(dtype)


def split_literal(by: str, per_split: Mapping[str, float | None]) -> Column:
    out = None
    for split, v in per_split.items():
        lit = F.lit(v).cast("double")
        out = F.when(F.col(by) == F.lit(split), lit) if out is None else out.when(F.col(by) == F.lit(split), lit)
    return out if out is not None else F.lit(None).cast("double")


def apply_rules(df: DataFrame, column_rules: Mapping[str, Sequence[Rule]], by: str = "split",
                means: dict | None = None, impute: str = "per_split",
                train_value: str = "train") -> tuple[DataFrame, dict]:
    """Apply each column's rules in order.

    ``means`` maps (column, rule position) -> {split: mean}. Missing entries are
    computed from ``df`` (one job for all levels) and returned, so a
    fitted model can replay the projection without touching data again.
    ``impute='fit_on_train'`` uses the training split's mean for every split.
    """
    means = dict(means or {})
    dtypes = dict(df.dtypes)
    unknown = {c: rules for c, rules in column_rules.items() if any(r.is_mean and (c, i) not in means for i, r in enumerate(rules))}
    if unknown:
        means.update(chain_means(df, unknown, by, train_value if impute == "fit_on_train" else None))
    pos = {c: 0 for c in column_rules}
    while True:
        # non-mean rules, one projection per rule position
        while True:
            step = {}
            for c, rules in column_rules.items():
                if pos[c] < len(rules) and not rules[pos[c]].is_mean:
                    r = rules[pos[c]]
                    col = F.col(c)
                    step[c] = F.when(rule_mask(col, r), _typed_value(r.value, dtypes[c])).otherwise(col)
                    pos[c] += 1
            if not step:
                break
            df = df.withColumns(step)
        pending = [c for c, rules in column_rules.items() if pos[c] < len(rules)]
        if not pending:
            return df, means
        step = {}
        for c in pending:
            r = column_rules[c][pos[c]]
            col = F.col(c)
            step[c] = F.when(rule_mask(col, r), split_literal(by, means[(c, pos[c])]).cast(dtypes[c])).otherwise(col)
            pos[c] += 1
        df = df.withColumns(step)
