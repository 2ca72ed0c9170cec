"""The whole cleaning pass as a fit / transform pair.

``CleaningEstimator.fit`` runs the data-dependent decisions as a handful of
aggregate jobs (sparse columns, auto typing, vocabularies, per-split means,
constant columns) and returns a ``CleaningModel`` holding only literals. Its
``transform`` is a single projection, so it also works on a streaming frame.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators import encode, profile, wide_profile
from riskspark.operators.conform import check_vocabularies, uncovered_columns
from riskspark.operators.persistence import SavedAsJson
from riskspark.operators.recode import apply_rules
from riskspark.sources.spec import MEAN, FeatureSpec, Rule


@dataclass
class FeatureColumn:
    name: str
    kind: str            # intercept | continuous | onehot
    source: str
    value: object = None


@dataclass
class FeatureLayout:
    """Ordered feature columns: continuous (table order) then one-hot blocks (spec order)."""
    columns: list[FeatureColumn] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def continuous(self) -> list[str]:
        return [c.name for c in self.columns if c.kind == "continuous"]

    def continuous_positions(self) -> list[int]:
        return [i for i, c in enumerate(self.columns) if c.kind == "continuous"]

    def with_intercept(self) -> "FeatureLayout":
        if self.columns and self.columns[0].kind == "intercept":
            return self
        return FeatureLayout([FeatureColumn("intercept", "intercept", "")] + list(self.columns))

    def expanded(self, degree: int) -> "FeatureLayout":
        """Layout after B16: every continuous column replaced by its powers."""
        out = []
        for c in self.columns:
            if c.kind == "continuous":
                out += [FeatureColumn(n, "continuous", c.source, j)
                        for j, n in zip(range(1, degree + 1), encode.power_names(c.name, degree))]
            else:
                out.append(c)
        return FeatureLayout(out)

    def to_json(self) -> str:
        return json.dumps([asdict(c) for c in self.columns])

    @staticmethod
    def from_json(text: str) -> "FeatureLayout":
        return FeatureLayout([FeatureColumn(**d) for d in json.loads(text)])


class CleaningModel(Model, SavedAsJson):
    """Fitted cleaning: literals only (kept columns, kinds, vocabularies, rules,
    per-split means, layout); ``transform`` is one projection. ``save`` and ``load`` keep all
    of it but the fit's report tables."""

    def __init__(self, id_col: str, label_col: str, split_col: str, kept: list, kinds: dict, vocabularies: dict,
                 rules: dict, means: dict, layout: FeatureLayout, reports: dict | None = None):
        super().__init__()
        self.id_col, self.label_col, self.split_col = id_col, label_col, split_col
        self.kept, self.kinds, self.vocabularies = kept, kinds, vocabularies
        self.rules, self.means, self.layout = rules, means, layout
        self.reports = reports or {}

    def state(self) -> dict:
        rules = {c: [dict(asdict(r), value="mean") if r.is_mean else asdict(r) for r in rs] for c, rs in self.rules.items()}
        means = [[c, i, per_split] for (c, i), per_split in self.means.items()]
        mean_rules = [[c, i] for c, rs in self.rules.items() for i, r in enumerate(rs) if r.is_mean]
        return {"columns": [self.id_col, self.label_col, self.split_col], "kept": self.kept, "kinds": self.kinds,
                "vocabularies": self.vocabularies, "rules": rules, "mean_rules": mean_rules, "means": means, "layout": self.layout.to_json()}

    @classmethod
    def from_state(cls, state: dict) -> "CleaningModel":
        of_mean = {(c, i) for c, i in state["mean_rules"]}
        rules = {c: [Rule(**dict(r, value=MEAN) if (c, i) in of_mean else r) for i, r in enumerate(rs)] for c, rs in state["rules"].items()}
        means = {(c, i): per_split for c, i, per_split in state["means"]}
        return cls(*state["columns"], state["kept"], state["kinds"], state["vocabularies"], rules, means, FeatureLayout.from_json(state["layout"]))

    def _transform(self, df: DataFrame) -> DataFrame:
        keys = [c for c in (self.id_col, self.split_col, self.label_col) if c in df.columns]
        mapped, _ = apply_rules(df.select(*keys, *self.kept), self.rules, self.split_col, self.means)
        exprs = []
        for fc in self.layout.columns:
            if fc.kind == "intercept":
                exprs.append(encode.intercept_expr(fc.name))
            elif fc.kind == "continuous":
                exprs.append(F.col(fc.source).cast("double").alias(fc.name))
            else:
                exprs += [e for e, n in zip(encode.onehot_exprs(fc.source, [fc.value]), [fc.name])]
        return mapped.select(*keys, *exprs)


    def transform_coded(self, df: DataFrame) -> DataFrame:
        """The cleaned rows with continuous columns and ``codes`` (one INT per categorical column: the position of the
        row's value in ``layout.with_intercept()``, -1 for none) instead of one-hot columns."""
        from riskspark.operators.coded import code_columns
        keys = [c for c in (self.id_col, self.split_col, self.label_col) if c in df.columns]
        mapped, _ = apply_rules(df.select(*keys, *self.kept), self.rules, self.split_col, self.means)
        values = [F.col(fc.source).cast("double").alias(fc.name) for fc in self.layout.columns if fc.kind == "continuous"]
        codes = code_columns(self.layout.with_intercept())
        return mapped.select(*keys, *values, (F.array(*codes) if codes else F.array().cast("array<int>")).alias("codes"))


class CleaningEstimator(Estimator):
    """B19 as a ``pyspark.ml`` estimator (usable as a Pipeline stage)."""

    def __init__(self, specs: list[FeatureSpec], threshold: float = 0.1, max_categories: int = 10,
                 impute: str = "per_split", id_col: str = "id", label_col: str = "label",
                 split_col: str = "split", train_value: str = "train", check_vocab: bool = True,
                 persist: bool = False, on_missing: str = "error", test_value: str = "test",
                 max_vocabulary: int = 100_000):
        super().__init__()
        self.persist = persist                # cache the input between the jobs of ``fit``; only for inputs that fit
        self.on_missing = on_missing          # "error" | "keep" for missing values left in continuous columns
        self.specs = specs
        self.threshold = threshold
        self.max_categories = max_categories
        self.impute = impute
        self.id_col, self.label_col, self.split_col = id_col, label_col, split_col
        self.train_value, self.test_value = train_value, test_value
        self.max_vocabulary = max_vocabulary  # one-hot columns that one auto column may become
        self.check_vocab = check_vocab

    def _fit(self, df: DataFrame) -> CleaningModel:
        """Data-dependent decisions in a few jobs over the input: (1) one scan of all columns into
        mergeable sketches: missing shares, automatic kinds and vocabularies, (2) one grouped
        mean per level of chained mean rules, (3) vocabulary conformance, (4) min / max
        for the constant-column test. Jobs 2 to 4 read only the columns that are kept."""
        from pyspark import StorageLevel
        keys = [k for k in (self.id_col, self.split_col, self.label_col) if k in df.columns]
        features = [c for c in df.columns if c not in keys]
        spec_ids = {s.id for s in self.specs}
        base = df.select(*keys, *features)
        if self.persist:
            base = base.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._decide(base, keys, features, spec_ids)
        finally:
            if self.persist:
                base.unpersist()

    @staticmethod
    def _constants(df: DataFrame, model: CleaningModel, known: dict, train) -> DataFrame:
        """B14 report of every layout column. The one-hot columns of an automatic column have no rules, so its
        training values (``known``) say whether they are constant; only the others are looked up in the data."""
        rows, rest = [], []
        for fc in model.layout.columns:
            values = known.get(fc.source) if fc.kind == "onehot" else None
            if not values:
                rest.append(fc.name)
                continue
            low, high = float(values == [fc.value]), float(fc.value in values)
            rows.append((fc.name, low, high, 0, 0, low != high))
        schema = "feature string, min_value double, max_value double, n_missing bigint, n_missing_all bigint, kept boolean"
        told = df.sparkSession.createDataFrame(rows, schema)
        return profile.constant_report(model.transform(df), rest, train).unionByName(told) if rest else told

    def _decide(self, df: DataFrame, keys, features, spec_ids) -> CleaningModel:
        by_id = {s.id: s for s in self.specs}
        train = F.col(self.split_col) == F.lit(self.train_value)
        splits = [self.train_value, self.test_value]
        found = wide_profile.decide(
            wide_profile.wide_profile(df, features, self.split_col, max(wide_profile.K, 2 * self.max_categories)),
            self.max_categories, self.train_value)
        sparse = profile.sparse_rows(df.sparkSession, found, self.threshold, splits)
        kept = [c for c in features if c not in found or found[c].kept(self.threshold, splits)]
        missing_spec = uncovered_columns(kept, self.specs)
        if missing_spec:
            raise ValueError(f"columns without a spec entry: {missing_spec}")

        kinds, vocabs, rules = {}, {}, {}
        order = [s.id for s in self.specs if s.id in kept]
        auto = {c: found[c].kind if c in found else "categorical" for c in order if by_id[c].type == "auto"}
        for c in (c for c in auto if auto[c] == "categorical"):
            # few training values but more than a sketch holds over all splits: the exact list
            complete = c not in found or found[c].values is not None
            vocabs[c] = (found[c].values if c in found else []) if complete else profile.vocabulary(df, c, self.max_vocabulary)
        for c in order:
            s = by_id[c]
            kind = auto.get(c, s.type)
            if kind == "delete":
                continue
            kinds[c] = kind
            if s.type == "auto":
                if kind == "continuous":
                    rules[c] = [Rule("missing", value=MEAN)]
            else:
                if s.mapping:
                    rules[c] = list(s.mapping)
                if kind == "categorical":
                    vocabs[c] = list(s.vocabulary)
        used = [c for c in kept if c in kinds]
        base = df.select(*keys, *used)
        mapped, means = apply_rules(base, rules, self.split_col, impute=self.impute,
                                    train_value=self.train_value)
        if self.check_vocab:
            check_vocabularies(mapped, {c: vocabs[c] for c in order if c in vocabs}, self.split_col)

        cols = []
        for c in used:                      # continuous: table order
            if kinds[c] == "continuous":
                cols.append(FeatureColumn(c, "continuous", c))
        for c in order:                     # one-hot blocks: spec order
            if kinds.get(c) == "categorical":
                cols += [FeatureColumn(n, "onehot", c, v)
                         for n, v in zip(encode.onehot_names(c, vocabs[c]), vocabs[c])]
        layout = FeatureLayout(cols)
        model = CleaningModel(self.id_col, self.label_col, self.split_col, used, kinds, vocabs,
                              rules, means, layout, {"sparse": sparse})
        const = self._constants(df, model, {c: found[c].train_values for c in auto if auto[c] == "categorical" and c in found}, train)
        stats = const.select("feature", "kept", "n_missing_all").collect()
        keep = {r["feature"] for r in stats if r["kept"]}
        left = sorted(r["feature"] for r in stats if r["feature"] in model.layout.continuous
                      and r["n_missing_all"] and r["feature"] in keep)
        if left and self.on_missing == "error":
            raise ValueError(f"continuous columns still have missing values after their mapping rules "
                             f"(add a ['NaN', 'mean'] rule or use on_missing='keep'): {left}")
        model.layout = FeatureLayout([c for c in layout.columns if c.name in keep])
        model.reports["constant"] = const
        return model
