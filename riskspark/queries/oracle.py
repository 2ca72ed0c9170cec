"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: splits, folds and samples use the
same md5 key formula; floats are rounded to 6 places and ids / counts are
BIGINT on both sides."""

from __future__ import annotations

from riskspark.queries.tables_sql import TABLES_SQL, fraction_cut, hash32_sql

K = 5
HOLD_CUT = fraction_cut(0.8)


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def sql(body: str, tables: tuple[str, ...], ctes: tuple[tuple[str, str], ...] = (), recursive: bool = False) -> str:
    parts = [f"{n} AS ({TABLES_SQL[n]})" for n in tables] + [f"{n} AS ({q})" for n, q in ctes]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body


LINE_FEATURES = ["quantity", "price", "discount", "tax", "qty_low", "linestatus"]
ORDER_FEATURES = ["totalprice", "acctbal", "ordermonth", "regionkey", "orderstatus", "mktsegment"]
ORDER_CATEGORIES = ["ordermonth", "regionkey", "orderstatus", "mktsegment"]
# The same vocabularies as the Spark side's conformance queries.
ORDER_STATUS = ["F", "O", "P"]
MKT_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
VOCAB_CHECK = {
    "orderstatus": ["F", "O"],
    "mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"],
}
HOLDOUT = f"{hash32_sql('holdout:1', 'id')} >= {HOLD_CUT}"
FOLD = f"({hash32_sql('fold:1', 'id')} % {K})"


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def null_profile() -> str:
    body = "\nUNION ALL\n".join(
        f"SELECT split, '{c}' AS feature, {r6(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing_ratio "
        f"FROM line_num GROUP BY split" for c in LINE_FEATURES)
    return sql(body, ("line_num",))


def drop_sparse_columns() -> str:
    parts = []
    for c in LINE_FEATURES:
        tr = f"avg(CASE WHEN split = 'train' THEN (CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) END)"
        te = f"avg(CASE WHEN split = 'test' THEN (CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) END)"
        parts.append(f"SELECT '{c}' AS feature, {r6(tr)} AS train_ratio, {r6(te)} AS test_ratio, "
                     f"CAST(CASE WHEN coalesce({tr} <= 0.1, TRUE) AND coalesce({te} <= 0.1, TRUE) THEN 1 ELSE 0 END AS BIGINT) AS kept "
                     f"FROM line_num")
    return sql("\nUNION ALL\n".join(parts), ("line_num",))


def spec_conformance() -> str:
    covered = {"quantity", "price", "discount", "tax", "linestatus"}
    parts = []
    for c in LINE_FEATURES:
        non_num = (f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL)"
                   if c == "linestatus" else "0")
        outside = f"count(*) FILTER (WHERE {c} IS NULL OR {c} NOT IN ('F'))" if c == "linestatus" else "0"
        parts.append(f"SELECT '{c}' AS feature, split, CAST({1 if c in covered else 0} AS BIGINT) AS covered, "
                     f"CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing, "
                     f"CAST({non_num} AS BIGINT) AS n_non_numeric, CAST({outside} AS BIGINT) AS n_outside_vocab "
                     f"FROM line_num GROUP BY split")
    return sql("\nUNION ALL\n".join(parts), ("line_num",))


def vocab_conformance() -> str:
    parts = []
    for c, vocab in VOCAB_CHECK.items():
        inlist = ", ".join(_q(v) for v in vocab)
        parts.append(f"SELECT '{c}' AS feature, split, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n "
                     f"FROM order_risk WHERE {c} IS NULL OR {c} NOT IN ({inlist}) GROUP BY split, {c}")
    return sql("\nUNION ALL\n".join(parts), ("order_risk",))


def recode_chain() -> str:
    a = ("SELECT key, split, label, "
         "CASE WHEN (CASE WHEN quantity = 1.0 THEN 0.0 ELSE quantity END) BETWEEN 45.0 AND 50.0 THEN 45.0 "
         "ELSE (CASE WHEN quantity = 1.0 THEN 0.0 ELSE quantity END) END AS quantity, "
         "CASE WHEN discount = 0.1 THEN NULL ELSE discount END AS discount, tax FROM line_num")
    b = ("SELECT key, split, label, quantity, "
         "CASE WHEN discount IS NULL THEN avg(discount) OVER (PARTITION BY split) ELSE discount END AS discount, "
         "CASE WHEN tax IS NULL THEN avg(tax) OVER (PARTITION BY split) ELSE tax END AS tax FROM a")
    c = ("SELECT key, split, label, quantity, "
         "CASE WHEN discount BETWEEN 0.0 AND 0.02 THEN 0.0 ELSE discount END AS discount, "
         "CASE WHEN tax BETWEEN 0.02 AND 0.04 THEN 0.03 ELSE tax END AS tax FROM b")
    body = f"SELECT key, split, label, {r6('quantity')} AS quantity, {r6('discount')} AS discount, {r6('tax')} AS tax FROM c"
    return sql(body, ("line_num",), (("a", a), ("b", b), ("c", c)))


def range_bin() -> str:
    x = "totalprice"
    s1 = f"CASE WHEN {x} BETWEEN 0.0 AND 100000.0 THEN 1.0 ELSE {x} END"
    s2 = f"CASE WHEN ({s1}) BETWEEN 100000.01 AND 200000.0 THEN 2.0 ELSE ({s1}) END"
    s3 = f"CASE WHEN ({s2}) BETWEEN 200000.01 AND 1000000.0 THEN 3.0 ELSE ({s2}) END"
    return sql(f"SELECT id, split, {r6(s3)} AS totalprice FROM order_risk", ("order_risk",))


def impute_mean_per_split() -> str:
    e = "CASE WHEN acctbal IS NULL THEN avg(acctbal) OVER (PARTITION BY split) ELSE acctbal END"
    return sql(f"SELECT id, split, {r6(e)} AS acctbal FROM order_risk", ("order_risk",))


def auto_type() -> str:
    parts = []
    for c in ORDER_FEATURES:
        n = f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"
        parts.append(f"SELECT '{c}' AS feature, CAST({n} AS BIGINT) AS n_distinct, "
                     f"CASE WHEN {n} <= 10 THEN 'categorical' ELSE 'continuous' END AS kind "
                     f"FROM order_risk WHERE split = 'train'")
    return sql("\nUNION ALL\n".join(parts), ("order_risk",))


def auto_vocab() -> str:
    body = "\nUNION ALL\n".join(f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM order_risk"
                                for c in ORDER_CATEGORIES)
    return sql(body, ("order_risk",))


def wide_profile() -> str:
    """All 321 columns in long form: the cell of column j is a formula in j."""
    split = f"CASE WHEN {hash32_sql('split', 'l_orderkey', 'l_linenumber')} < {fraction_cut(0.2)} THEN 'test' ELSE 'train' END"
    return f"""
WITH li AS (SELECT {split} AS split, l_orderkey AS o, CAST(l_linenumber AS BIGINT) AS n, l_partkey AS p, l_quantity AS q FROM lineitem),
cells AS (
  SELECT split, j, CASE WHEN (7 * o + 13 * n + p * (j % 11 + 1) + 29 * j) % 1000
                             < CASE WHEN j < 182 THEN 150 + j * 17 % 700 ELSE j * 7 % 90 END THEN NULL
                        WHEN (j >= 182 AND j < 277) OR (j < 182 AND j % 2 = 0)
                             THEN CAST(((2 * j + 1) * o + 31 * n + (j + 3) * p) % 1000 % (2 + j % 8) AS DOUBLE)
                        ELSE q + (((2 * j + 1) * o + 31 * n + (j + 3) * p) % 1000) / 100.0::DOUBLE END AS v
  FROM li, range(321) AS r(j)),
uniq AS (SELECT j, split, v, count(*) AS c FROM cells GROUP BY ALL),
per AS (
  SELECT j, sum(c) FILTER (split = 'train' AND v IS NULL) AS gone_train, sum(c) FILTER (split = 'train') AS n_train,
         sum(c) FILTER (split = 'test' AND v IS NULL) AS gone_test, sum(c) FILTER (split = 'test') AS n_test,
         count(*) FILTER (split = 'train') AS n_distinct,
         string_agg(DISTINCT CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY CAST(CAST(v AS BIGINT) AS VARCHAR)) AS present,
         bool_or(v IS NULL) AS any_gone
  FROM uniq GROUP BY j),
shares AS (SELECT *, coalesce(gone_train, 0) / n_train AS a, coalesce(gone_test, 0) / n_test AS b FROM per)
SELECT 'f' || j AS feature, {r6('a')} AS train_ratio, {r6('b')} AS test_ratio,
       CAST(CASE WHEN a <= 0.1 AND b <= 0.1 THEN 1 ELSE 0 END AS BIGINT) AS kept,
       CASE WHEN n_distinct <= 10 THEN 'categorical' ELSE 'continuous' END AS kind,
       CAST(CASE WHEN n_distinct <= 10 THEN n_distinct END AS BIGINT) AS n_distinct,
       CASE WHEN n_distinct <= 10 THEN present || CASE WHEN any_gone THEN ',-' ELSE '' END END AS vocabulary
FROM shares
"""


def _onehot_sql(col: str, vocab, names) -> list[str]:
    out = []
    for v, n in zip(vocab, names):
        lit = _q(v) if isinstance(v, str) else repr(float(v))
        out.append(f"CAST(CASE WHEN {col} IS NOT DISTINCT FROM {lit} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS {n}")
    return out


def _order_onehot() -> list[str]:
    return (_onehot_sql("orderstatus", ORDER_STATUS, [f"orderstatus_{v}" for v in ORDER_STATUS])
            + _onehot_sql("mktsegment", MKT_SEGMENTS, [f"mktsegment_{v}" for v in MKT_SEGMENTS])
            + _onehot_sql("regionkey", [0.0, 1.0, 2.0, 3.0, 4.0], [f"regionkey_{i}" for i in range(5)]))


def one_hot() -> str:
    return sql(f"SELECT id, split, {', '.join(_order_onehot())} FROM order_risk", ("order_risk",))


def drop_constant() -> str:
    cols = ["quantity", "price", "discount", "tax", "qty_low", "pos_qty"]
    base = "SELECT *, CAST(quantity > 0 AS DOUBLE) AS pos_qty FROM line_num WHERE split = 'train'"
    parts = []
    for c in cols:
        nm = f"count(*) FILTER (WHERE {c} IS NULL)"
        parts.append(f"SELECT '{c}' AS feature, {r6(f'min({c})')} AS min_value, {r6(f'max({c})')} AS max_value, "
                     f"CAST({nm} AS BIGINT) AS n_missing, "
                     f"CAST(CASE WHEN {nm} = 0 AND min({c}) = max({c}) THEN 0 ELSE 1 END AS BIGINT) AS kept FROM t")
    return sql("\nUNION ALL\n".join(parts), ("line_num",), (("t", base),))


def poly_expand() -> str:
    cols = []
    for c in ("discount", "tax"):
        cols += [f"{r6(c)} AS {c}", f"{r6(f'pow({c}, 2.0)')} AS {c}_p2", f"{r6(f'pow({c}, 3.0)')} AS {c}_p3"]
    return sql(f"SELECT key, split, {', '.join(cols)} FROM line_num", ("line_num",))


def _order_clean_cte() -> tuple[str, str]:
    q = ("SELECT id, split, label, totalprice, "
         "CASE WHEN acctbal IS NULL THEN avg(acctbal) OVER (PARTITION BY split) ELSE acctbal END AS acctbal, "
         + ", ".join(_order_onehot()) + " FROM order_risk")
    return ("clean", q)


ORDER_LAYOUT = (["totalprice", "acctbal"] + [f"orderstatus_{v}" for v in ORDER_STATUS]
                + [f"mktsegment_{v}" for v in MKT_SEGMENTS] + [f"regionkey_{i}" for i in range(5)])


def add_intercept() -> str:
    arr = "[1.0, " + ", ".join(f"CAST({c} AS DOUBLE)" for c in ORDER_LAYOUT) + "]"
    body = (f"SELECT id, split, CAST(pos - 1 AS BIGINT) AS pos, {r6('value')} AS value FROM "
            f"(SELECT id, split, unnest(range(1, {len(ORDER_LAYOUT) + 2})) AS pos, unnest({arr}) AS value FROM clean)")
    return sql(body, ("order_risk",), (_order_clean_cte(),))


def stride_sample() -> str:
    return sql(f"SELECT id, CAST(label AS INTEGER) AS label FROM order_risk WHERE split = 'train' AND "
               f"{hash32_sql('sample', 'id')} % 50 = 0", ("order_risk",))


def holdout_split() -> str:
    return sql(f"SELECT id, CAST(CASE WHEN {HOLDOUT} THEN 1 ELSE 0 END AS BIGINT) AS holdout "
               f"FROM order_risk WHERE split = 'train'", ("order_risk",))


def kfold_assign() -> str:
    return sql(f"SELECT id, CAST(CASE WHEN {HOLDOUT} THEN -1 ELSE {FOLD} END AS BIGINT) AS fold "
               f"FROM order_risk WHERE split = 'train'", ("order_risk",))


def kfold_exact() -> str:
    h = hash32_sql('fold:1', 'id')
    body = ("SELECT id, CAST(CASE WHEN rk < 7 * (n // 7) THEN rk // (n // 7) ELSE 7 END AS BIGINT) AS fold FROM "
            f"(SELECT id, row_number() OVER (ORDER BY {h}, id) - 1 AS rk, count(*) OVER () AS n "
            "FROM order_risk WHERE split = 'train')")
    return sql(body, ("order_risk",))


def exact_holdout() -> str:
    h = hash32_sql('holdout:1', 'id')
    body = ("SELECT id, CAST(CASE WHEN rn <= floor(n * 0.8) THEN 0 ELSE 1 END AS BIGINT) AS holdout FROM "
            f"(SELECT id, row_number() OVER (ORDER BY {h}, id) AS rn, count(*) OVER () AS n "
            "FROM order_risk WHERE split = 'train')")
    return sql(body, ("order_risk",))


def undersample() -> str:
    h = hash32_sql('balance', 'id')
    body = ("SELECT id, label FROM (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY "
            f"{h}, id) AS rn FROM order_risk WHERE split = 'train') "
            "WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM order_risk WHERE split = 'train' GROUP BY label))")
    return sql(body, ("order_risk",))


FOLD_ROWS = ("fr", f"SELECT *, {FOLD} AS fold FROM order_risk WHERE split = 'train' AND NOT ({HOLDOUT})")
FOLDS = ("folds", f"SELECT CAST(range AS BIGINT) AS f FROM range({K})")


def scale_fit() -> str:
    parts = [f"SELECT f AS fold, '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'stddev_pop({c})')} AS std "
             f"FROM folds JOIN fr ON fr.fold <> folds.f GROUP BY f" for c in ("totalprice", "acctbal")]
    return sql("\nUNION ALL\n".join(parts), ("order_risk",), (FOLD_ROWS, FOLDS))


def scale_apply_kfold() -> str:
    stats = ("st", "SELECT f, avg(totalprice) AS m1, stddev_pop(totalprice) AS s1, avg(acctbal) AS m2, "
                   "stddev_pop(acctbal) AS s2 FROM folds JOIN fr ON fr.fold <> folds.f GROUP BY f")
    body = ("SELECT st.f AS fold, fr.id, CAST(fr.fold = st.f AS BIGINT) AS is_val, "
            f"{r6('CASE WHEN s1 > 0 THEN (totalprice - m1) / s1 ELSE 0.0 END')} AS totalprice, "
            f"{r6('CASE WHEN s2 > 0 THEN (acctbal - m2) / s2 ELSE 0.0 END')} AS acctbal "
            "FROM fr, st")
    return sql(body, ("order_risk",), (FOLD_ROWS, FOLDS, stats))


def class_ratio() -> str:
    body = ("SELECT f AS fold, CAST(count(*) FILTER (WHERE label = -1) AS BIGINT) AS n_neg, "
            "CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS n_pos, "
            f"{r6('CASE WHEN count(*) FILTER (WHERE label = -1) = 0 THEN 1.0 ELSE count(*) FILTER (WHERE label = -1) / count(*) FILTER (WHERE label = 1) END')} AS ratio "
            "FROM folds JOIN fr ON fr.fold <> folds.f GROUP BY f")
    return sql(body, ("order_risk",), (FOLD_ROWS, FOLDS))


def label_counts() -> str:
    return sql("SELECT split, CAST(label AS BIGINT) AS label, CAST(count(*) AS BIGINT) AS n FROM order_risk GROUP BY 1, 2",
               ("order_risk",))



# ------------------------------------------------------------------ D*, E*

# The same literal model as the Spark side.
LINE_W = [0.1, -0.2, 0.3, 0.05]
GD_STEPS = 200


def dl(v) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


DESIGN = ("d", "SELECT key, CAST(1.0 AS DOUBLE) AS x0, quantity / 50.0 AS x1, discount * 10.0 AS x2, "
               "price / 100000.0 AS x3, CAST(label AS DOUBLE) AS y FROM line_num")
RATIO = ("r", "SELECT CASE WHEN count(*) FILTER (WHERE y = -1) = 0 THEN 1.0 ELSE "
              "CAST(count(*) FILTER (WHERE y = -1) AS DOUBLE) / count(*) FILTER (WHERE y = 1) END AS r FROM d")


def _t(xs, ws) -> str:
    return " + ".join(f"{x} * {w}" for x, w in zip(xs, ws))


def _row_sql(kind: str, t: str):
    """(loss, residual) per row as SQL; ``r`` is the class ratio column."""
    sp = f"(greatest({t}, 0.0) + ln(1 + exp(-abs({t}))))"
    sig = f"(1.0 / (1.0 + exp(-({t}))))"
    y01 = "(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END)"
    if kind == "mse":
        e = f"(y - ({t}))"
        return f"({e} * {e} / 2.0)", f"(-{e})"
    if kind == "mse_balanced":
        e = f"(y - ({t}))"
        eb = (f"(CASE WHEN r > 1 THEN (CASE WHEN {e} >= 0 THEN {e} * r ELSE {e} END) "
              f"ELSE (CASE WHEN {e} <= 0 THEN {e} * r ELSE {e} END) END)")
        return f"({eb} * {eb} / 2.0)", f"(-{eb})"
    if kind == "logistic":
        return f"(-{y01} * ({t}) + {sp})", f"({sig} - {y01})"
    if kind == "logistic_label":
        wg = f"(CASE WHEN r > 1 THEN (CASE WHEN {y01} = 1 THEN r ELSE 1.0 END) ELSE (CASE WHEN {y01} = 0 THEN r ELSE 1.0 END) END)"
        return f"({wg} * (-{y01} * ({t}) + {sp}))", f"({wg} * ({sig} - {y01}))"
    if kind == "logistic_balanced":
        wg = "(CASE WHEN r > 1 THEN (CASE WHEN y = 1 THEN r ELSE 1.0 END) ELSE (CASE WHEN y = -1 THEN r ELSE 1.0 END) END)"
        return f"((-y * ({t}) + {sp}) * {wg})", f"({sig} * {wg} - y)"
    raise ValueError(kind)


def _loss_sql(kind):
    def build():
        lv, _ = _row_sql(kind, _t(["x0", "x1", "x2", "x3"], [dl(w) for w in LINE_W]))
        return sql(f"SELECT {r6(f'avg({lv})')} AS loss FROM d, r", ("line_num",), (DESIGN, RATIO))
    return build


def _grad_sql(kind):
    def build():
        _, R = _row_sql(kind, _t(["x0", "x1", "x2", "x3"], [dl(w) for w in LINE_W]))
        body = "\nUNION ALL\n".join(f"SELECT CAST({j} AS BIGINT) AS j, {r6(f'avg({R} * x{j})')} AS grad FROM d, r"
                                     for j in range(4))
        return sql(body, ("line_num",), (DESIGN, RATIO))
    return build


def gram_matrix() -> str:
    u = ("u", "SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings")
    body = ("SELECT CAST(a.i AS BIGINT) AS i, CAST(b.i AS BIGINT) AS j, "
            f"{r6('sum(a.v * b.v)')} AS value FROM u a JOIN u b ON a.vec_id = b.vec_id GROUP BY a.i, b.i")
    return "WITH " + f"{u[0]} AS ({u[1]})\n" + body


def _closed_form(lam: float) -> str:
    stats = ("s", "SELECT count(*) AS n, sum(x1) AS sx, sum(x1 * x1) AS sxx, sum(y) AS sy, sum(x1 * y) AS sxy FROM d")
    a00 = f"(n + 2 * {dl(lam)} * n)"
    a11 = f"(sxx + 2 * {dl(lam)} * n)"
    det = f"({a00} * {a11} - sx * sx)"
    w = ("w", f"SELECT (sy * {a11} - sx * sxy) / {det} AS w0, ({a00} * sxy - sx * sy) / {det} AS w1 FROM s")
    body = ("SELECT 'w0' AS term, " + r6("w0") + " AS value FROM w UNION ALL "
            "SELECT 'w1', " + r6("w1") + " FROM w UNION ALL "
            "SELECT 'loss', " + r6("avg((y - (x0 * w0 + x1 * w1)) * (y - (x0 * w0 + x1 * w1))) / 2.0") + " FROM d, w")
    return sql(body, ("line_num",), (DESIGN, stats, w))


def least_squares() -> str:
    return _closed_form(0.0)


def ridge() -> str:
    return _closed_form(0.1)


def _gd_sql(kind: str, gamma: float, lam: float = 0.0, batch: int | None = None):
    xs = ["x0", "x1", "x2"]

    def build():
        ws = [f"w{j}" for j in range(len(xs))]
        t = _t(xs, ws)
        _, R = _row_sql(kind, t)
        upd = ", ".join(f"w{j} - {dl(gamma)} * (avg({R} * x{j}) + 2 * {dl(lam)} * w{j})" for j in range(len(xs)))
        init = ", ".join(f"CAST(0.0 AS DOUBLE) AS w{j}" for j in range(len(xs)))
        src = "d, r"
        ctes = [DESIGN, RATIO]
        if batch:
            ctes.append(("nb", f"SELECT greatest(1, count(*) // {batch}) AS nb FROM d"))
            ctes.append(("db", f"SELECT d.*, {hash32_sql('batch', 'key')} % nb AS batch FROM d, nb"))
            src = "db JOIN nb ON TRUE JOIN r ON TRUE"
            where = f"step < {GD_STEPS} AND batch = step % nb"
        else:
            where = f"step < {GD_STEPS}"
        g = ("g(step, " + ", ".join(ws) + ")",
             f"SELECT 0, {init} UNION ALL SELECT step + 1, {upd} FROM g, {src} WHERE {where} "
             f"GROUP BY step, {', '.join(ws)}")
        fw = ("fw", f"SELECT * FROM g WHERE step = {GD_STEPS}")
        final_kind = "mse" if batch else kind
        lv, _ = _row_sql(final_kind, t)
        body = " UNION ALL ".join(f"SELECT 'w{j}' AS term, {r6(f'w{j}')} AS value FROM fw" for j in range(len(xs)))
        body += f" UNION ALL SELECT 'loss', {r6(f'avg({lv})')} FROM d, fw, r"
        return sql(body, ("line_num",), tuple(ctes) + (g, fw), recursive=True)
    return build


# ------------------------------------------------------------------ F2, G1, G2

SCORE = ("sc", "SELECT id, split, label, -1.0 + totalprice / 150000.0 + acctbal / 10000.0 AS score FROM order_risk")


def predict_threshold() -> str:
    return sql("SELECT id, split, CAST(CASE WHEN score <= 0.0 THEN -1 ELSE 1 END AS INTEGER) AS pred FROM sc",
               ("order_risk",), (SCORE,))


def _metric_cols(tp, fn, tn, fp) -> str:
    rec = f"(CASE WHEN {tp} + {fn} > 0 THEN CAST({tp} AS DOUBLE) / ({tp} + {fn}) ELSE 0.0 END)"
    pre = f"(CASE WHEN {tp} + {fp} > 0 THEN CAST({tp} AS DOUBLE) / ({tp} + {fp}) ELSE 0.0 END)"
    fpr = f"(CASE WHEN {fp} + {tn} > 0 THEN CAST({fp} AS DOUBLE) / ({fp} + {tn}) ELSE 0.0 END)"
    acc = f"(CASE WHEN {tp} + {fn} + {tn} + {fp} > 0 THEN CAST({tp} + {tn} AS DOUBLE) / ({tp} + {fn} + {tn} + {fp}) ELSE 0.0 END)"
    f1 = f"(CASE WHEN {pre} + {rec} > 0 THEN 2.0 * ({pre} * {rec}) / ({pre} + {rec}) ELSE 0.0 END)"
    return (f"{r6(acc)} AS accuracy, {r6(rec)} AS recall, {r6(fpr)} AS fpr, {r6(pre)} AS precision, {r6(f1)} AS f1")


def confusion_metrics() -> str:
    pred = "(CASE WHEN score <= 0.0 THEN -1 ELSE 1 END)"
    cnt = ("c", f"SELECT split, CAST(count(*) FILTER (WHERE label <> -1 AND {pred} = 1) AS BIGINT) AS tp, "
                f"CAST(count(*) FILTER (WHERE label <> -1 AND {pred} = -1) AS BIGINT) AS fn, "
                f"CAST(count(*) FILTER (WHERE label = -1 AND {pred} = -1) AS BIGINT) AS tn, "
                f"CAST(count(*) FILTER (WHERE label = -1 AND {pred} = 1) AS BIGINT) AS fp FROM sc GROUP BY split")
    return sql(f"SELECT split, tp, fn, tn, fp, {_metric_cols('tp', 'fn', 'tn', 'fp')} FROM c",
               ("order_risk",), (SCORE, cnt))


def _grid(n: int) -> tuple[str, str]:
    return ("th", f"SELECT range AS i, range * (CAST(2.0 AS DOUBLE) / {n - 1}) - 1.0 AS t FROM range({n})")


def threshold_search() -> str:
    pos = "(CASE WHEN score <= t THEN -1 ELSE 1 END) = 1"
    cnt = ("c", f"SELECT split, i, t, count(*) FILTER (WHERE label <> -1 AND {pos}) AS tp, "
                f"count(*) FILTER (WHERE label <> -1 AND NOT ({pos})) AS fn, "
                f"count(*) FILTER (WHERE label = -1 AND NOT ({pos})) AS tn, "
                f"count(*) FILTER (WHERE label = -1 AND {pos}) AS fp FROM sc, th GROUP BY split, i, t")
    rec = "(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END)"
    pre = "(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END)"
    f1 = ("f", f"SELECT split, i, t, (CASE WHEN {pre} + {rec} > 0 THEN 2.0 * ({pre} * {rec}) / ({pre} + {rec}) "
               "ELSE 0.0 END) AS f1 FROM c")
    body = ("SELECT split, " + r6("CASE WHEN f1 > 0 THEN t ELSE 0.0 END") + " AS threshold, " + r6("f1") + " AS f1 "
            "FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY f1 DESC, i) AS rk FROM f) WHERE rk = 1")
    return sql(body, ("order_risk",), (SCORE, _grid(100), cnt, f1))



# ------------------------------------------------------------------ G11, C6, A4/A5, F9

def label_correlation() -> str:
    body = " UNION ALL ".join(f"SELECT '{c}' AS feature, {r6(f'corr({c}, CAST(label AS DOUBLE))')} AS corr FROM fr"
                              for c in ("totalprice", "acctbal", "ordermonth", "regionkey"))
    return sql(body, ("order_risk",), (FOLD_ROWS,))


def split_scale() -> str:
    part = f"CASE WHEN {hash32_sql('valsplit:1', 'id')} < {fraction_cut(0.8)} THEN 'train' ELSE 'val' END"
    p = ("p", f"SELECT id, totalprice, acctbal, {part} AS part FROM order_risk WHERE split = 'train' AND NOT ({HOLDOUT})")
    st = ("st", "SELECT avg(totalprice) AS m1, stddev_pop(totalprice) AS s1, avg(acctbal) AS m2, stddev_pop(acctbal) AS s2 "
                "FROM p WHERE part = 'train'")
    body = (f"SELECT id, part, {r6('CASE WHEN s1 > 0 THEN (totalprice - m1) / s1 ELSE 0.0 END')} AS totalprice, "
            f"{r6('CASE WHEN s2 > 0 THEN (acctbal - m2) / s2 ELSE 0.0 END')} AS acctbal FROM p, st")
    return sql(body, ("order_risk",), (p, st))


def test_set() -> str:
    return sql(f"SELECT id, CAST(label AS BIGINT) AS label, {r6('totalprice')} AS totalprice, {r6('acctbal')} AS acctbal "
               f"FROM order_risk WHERE split = 'train' AND {HOLDOUT}", ("order_risk",))


def dataset_len() -> str:
    return sql(f"SELECT CAST(count(*) AS BIGINT) AS n FROM order_risk WHERE split = 'train' AND NOT ({HOLDOUT})", ("order_risk",))


def auto_impute() -> str:
    return sql(f"SELECT key, split, {r6('price')} AS price, {r6('coalesce(qty_low, avg(qty_low) OVER (PARTITION BY split))')} AS qty_low "
               "FROM line_num", ("line_num",))


def saved_pipeline() -> str:
    cont = 2  # totalprice and acctbal come first and are divided by 1,000
    terms = [f"({c} / 1000.0) * {j / 10!r}::DOUBLE" if j < cont else f"{c} * {j / 10!r}::DOUBLE" for j, c in enumerate(ORDER_LAYOUT)]
    score = " + ".join(terms)
    return sql(f"SELECT id, {r6(score)} AS score, CAST(CASE WHEN {score} <= 0.5 THEN -1 ELSE 1 END AS BIGINT) AS prediction "
               "FROM clean WHERE split = 'test'", ("order_risk",), (_order_clean_cte(),))


def clean_snapshot() -> str:
    body = " UNION ALL ".join(f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean FROM clean" for c in ORDER_LAYOUT)
    return sql(body, ("order_risk",), (_order_clean_cte(),))


def ridge_score() -> str:
    base = ("d", "SELECT split, CAST(1.0 AS DOUBLE) AS x0, quantity / 50.0 AS x1, CAST(label AS DOUBLE) AS y FROM line_num")
    stats = ("s", "SELECT count(*) AS n, sum(x1) AS sx, sum(x1 * x1) AS sxx, sum(y) AS sy, sum(x1 * y) AS sxy "
                  "FROM d WHERE split = 'train'")
    lam = "CAST(0.1 AS DOUBLE)"
    a00, a11 = f"(n + 2 * {lam} * n)", f"(sxx + 2 * {lam} * n)"
    det = f"({a00} * {a11} - sx * sx)"
    w = ("w", f"SELECT (sy * {a11} - sx * sxy) / {det} AS w0, ({a00} * sxy - sx * sy) / {det} AS w1 FROM s")
    e = "(y - (x0 * w0 + x1 * w1))"
    body = ("SELECT 'w0' AS term, " + r6("w0") + " AS value FROM w UNION ALL SELECT 'w1', " + r6("w1") + " FROM w "
            f"UNION ALL SELECT 'loss', {r6(f'avg({e} * {e}) / 2.0 + {lam} * (w0 * w0 + w1 * w1)')} "
            "FROM d, w WHERE split = 'test' GROUP BY w0, w1")
    return sql(body, ("line_num",), (base, stats, w))



def event_scale_fit() -> str:
    er = ("er", f"SELECT *, {FOLD} AS fold FROM event_num WHERE split = 'train' AND NOT ({HOLDOUT})")
    parts = [f"SELECT f AS fold, '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'stddev_pop({c})')} AS std "
             f"FROM folds JOIN er ON er.fold <> folds.f GROUP BY f" for c in ("value", "k", "hour")]
    return sql("\nUNION ALL\n".join(parts), ("event_num",), (er, FOLDS))



def csv_load() -> str:
    means = ", ".join(f"{r6(f'avg({c})')} AS mean_{c}" for c in ("totalprice", "acctbal", "ordermonth", "regionkey"))
    body = ("SELECT split, CAST(count(*) AS BIGINT) AS n, "
            "CAST(count(CASE WHEN split = 'train' THEN label END) AS BIGINT) AS n_labels, "
            "CAST(count(*) FILTER (WHERE split = 'train' AND label = 1) AS BIGINT) AS n_pos, "
            f"CAST(count(*) FILTER (WHERE acctbal IS NULL) AS BIGINT) AS n_missing_acctbal, {means} "
            "FROM order_risk GROUP BY split")
    return sql(body, ("order_risk",))



def exact_stride_sample() -> str:
    h = hash32_sql('sample', 'id')
    body = ("SELECT id, CAST(label AS INTEGER) AS label FROM (SELECT id, label, "
            f"row_number() OVER (ORDER BY {h}, id) - 1 AS rk FROM order_risk WHERE split = 'train') "
            "WHERE rk % 50 = 0")
    return sql(body, ("order_risk",))



BATCH_ROWS = ("d", "SELECT id, CAST(1.0 AS DOUBLE) AS x0, totalprice / 500000.0 AS x1, ordermonth / 12.0 AS x2, "
                   "CAST(label AS DOUBLE) AS y FROM order_risk WHERE split = 'train'")


def minibatch_gd_shuffled() -> str:
    sz = ("sz", "SELECT count(*) AS n, least(300, count(*)) AS size FROM d")
    rk = ("rk", f"SELECT d.*, row_number() OVER (ORDER BY {hash32_sql('batch', 'id')}, id) - 1 AS rk FROM d")
    starts = ("starts", f"SELECT t, size, {hash32_sql('batch-start', 't')} % (n // size) * size "
                        f"+ {hash32_sql('batch-offset', 't')} % (n % size + 1) AS first FROM sz, (SELECT range AS t FROM range(20))")
    t = "x0 * w0 + x1 * w1 + x2 * w2"
    upd = ", ".join(f"w{j} - CAST(0.1 AS DOUBLE) * avg(-(y - ({t})) * x{j})" for j in range(3))
    g = ("g(step, w0, w1, w2)",
         "SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) UNION ALL "
         f"SELECT step + 1, {upd} FROM g JOIN starts ON starts.t = g.step JOIN rk ON rk >= first AND rk < first + size "
         "GROUP BY step, w0, w1, w2")
    fw = ("fw", "SELECT * FROM g WHERE step = 20")
    body = " UNION ALL ".join(f"SELECT 'w{j}' AS term, {r6(f'w{j}')} AS value FROM fw" for j in range(3))
    body += f" UNION ALL SELECT 'loss', {r6(f'avg((y - ({t})) * (y - ({t}))) / 2.0')} FROM rk, fw GROUP BY w0, w1, w2"
    return sql(body, ("order_risk",), (BATCH_ROWS, sz, rk, starts, g, fw), recursive=True)


def model_scores() -> str:
    rows = "SELECT totalprice AS v, CAST(label AS DOUBLE) AS y FROM order_risk WHERE split = 'train' AND "
    tr, hd = ("tr", f"{rows} NOT ({HOLDOUT})"), ("hd", f"{rows} ({HOLDOUT})")
    st = ("st", "SELECT avg(v) AS m, stddev_pop(v) AS s FROM tr")
    sd = ("sd", "SELECT 0 AS held, (v - m) / s AS x, y FROM tr, st UNION ALL SELECT 1, (v - m) / s, y FROM hd, st")
    su = ("su", "SELECT count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM sd WHERE held = 0")
    closed = []
    for name, lam in (("least_squares", "0.0"), ("ridge", "0.1")):
        a, b = f"(n + 2 * CAST({lam} AS DOUBLE) * n)", f"(sxx + 2 * CAST({lam} AS DOUBLE) * n)"
        det = f"({a} * {b} - sx * sx)"
        closed.append(f"SELECT '{name}' AS model, 0 AS lc, CAST({lam} AS DOUBLE) AS lam, "
                      f"(sy * {b} - sx * sxy) / {det} AS w0, ({a} * sxy - sx * sy) / {det} AS w1 FROM su")
    cfg = ("cfg", "SELECT * FROM (VALUES ('mse_gd', 0, CAST(0.1 AS DOUBLE), CAST(0.0 AS DOUBLE)), "
                  "('logistic', 1, CAST(0.7 AS DOUBLE), CAST(0.0 AS DOUBLE)), "
                  "('reg_logistic', 1, CAST(0.7 AS DOUBLE), CAST(0.1 AS DOUBLE))) v(model, lc, gamma, lam)")
    t = "(w0 + w1 * x)"
    res = f"(CASE WHEN lc = 0 THEN {t} - y ELSE 1.0 / (1.0 + exp(-{t})) - CASE WHEN y = -1 THEN 0.0 ELSE 1.0 END END)"
    g = ("g(step, model, lc, gamma, lam, w0, w1)",
         "SELECT 0, model, lc, gamma, lam, CAST(0.5 AS DOUBLE), CAST(-0.5 AS DOUBLE) FROM cfg UNION ALL "
         f"SELECT step + 1, model, lc, gamma, lam, w0 - gamma * (avg({res}) + 2 * lam * w0), "
         f"w1 - gamma * (avg({res} * x) + 2 * lam * w1) FROM g, sd WHERE held = 0 AND step < 50 "
         "GROUP BY step, model, lc, gamma, lam, w0, w1")
    w = ("w", " UNION ALL ".join(closed) + " UNION ALL SELECT model, lc, lam, w0, w1 FROM g WHERE step = 50")
    loss = (f"(CASE WHEN lc = 0 THEN (y - {t}) * (y - {t}) / 2.0 ELSE ln(1.0 + exp({t})) "
            f"- CASE WHEN y = -1 THEN 0.0 ELSE 1.0 END * {t} END)")
    body = (f"SELECT model, {r6('w0')} AS w0, {r6('w1')} AS w1, {r6(f'avg({loss}) FILTER (WHERE held = 0)')} AS train_loss, "
            f"{r6(f'avg({loss}) FILTER (WHERE held = 1) + lam * (w0 * w0 + w1 * w1)')} AS score "
            "FROM w, sd GROUP BY model, lam, w0, w1")
    return sql(body, ("order_risk",), (tr, hd, st, sd, su, cfg, g, w), recursive=True)


def minibatch_gd_exact() -> str:
    h = hash32_sql('batch', 'id')
    nb = ("nb", "SELECT greatest(1, count(*) // 1000) AS nb FROM d")
    rk = ("rk", f"SELECT d.*, row_number() OVER (ORDER BY {h}, id) - 1 AS rk FROM d")
    db = ("db", "SELECT rk.*, CASE WHEN rk < nb * 1000 THEN rk // 1000 ELSE -1 END AS batch FROM rk, nb")
    t = "x0 * w0 + x1 * w1 + x2 * w2"
    upd = ", ".join(f"w{j} - CAST(0.1 AS DOUBLE) * avg(-(y - ({t})) * x{j})" for j in range(3))
    g = ("g(step, w0, w1, w2)",
         "SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) UNION ALL "
         f"SELECT step + 1, {upd} FROM g, db, nb WHERE step < {GD_STEPS} AND batch = step % nb "
         "GROUP BY step, w0, w1, w2")
    fw = ("fw", f"SELECT * FROM g WHERE step = {GD_STEPS}")
    body = " UNION ALL ".join(f"SELECT 'w{j}' AS term, {r6(f'w{j}')} AS value FROM fw" for j in range(3))
    body += f" UNION ALL SELECT 'loss', {r6(f'avg((y - ({t})) * (y - ({t}))) / 2.0')} FROM db, fw GROUP BY w0, w1, w2"
    return sql(body, ("order_risk",), (BATCH_ROWS, nb, rk, db, g, fw), recursive=True)


def minibatch_logistic() -> str:
    h = hash32_sql('batch', 'id')
    nb = ("nb", "SELECT greatest(1, count(*) // 1000) AS nb FROM d")
    rk = ("rk", f"SELECT d.*, row_number() OVER (ORDER BY {h}, id) - 1 AS rk FROM d")
    db = ("db", "SELECT rk.*, CASE WHEN rk < nb * 1000 THEN rk // 1000 ELSE -1 END AS batch FROM rk, nb")
    t = "x0 * w0 + x1 * w1 + x2 * w2"
    zero_one = "(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END)"
    upd = ", ".join(f"w{j} - CAST(0.5 AS DOUBLE) * avg((1.0 / (1.0 + exp(-({t}))) - {zero_one}) * x{j})" for j in range(3))
    g = ("g(step, w0, w1, w2)",
         "SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) UNION ALL "
         f"SELECT step + 1, {upd} FROM g, db, nb WHERE step < 60 AND batch = step % nb GROUP BY step, w0, w1, w2")
    fw = ("fw", "SELECT * FROM g WHERE step = 60")
    body = " UNION ALL ".join(f"SELECT 'w{j}' AS term, {r6(f'w{j}')} AS value FROM fw" for j in range(3))
    body += f" UNION ALL SELECT 'loss', {r6(f'avg(ln(1.0 + exp({t})) - {zero_one} * ({t}))')} FROM db, fw GROUP BY w0, w1, w2"
    return sql(body, ("order_risk",), (BATCH_ROWS, nb, rk, db, g, fw), recursive=True)


ORACLES = {
    "null_profile": null_profile, "drop_sparse_columns": drop_sparse_columns,
    "spec_conformance": spec_conformance, "observed_conformance": spec_conformance, "vocab_conformance": vocab_conformance,
    "recode_chain": recode_chain, "range_bin": range_bin, "impute_mean_per_split": impute_mean_per_split,
    "auto_type": auto_type, "auto_vocab": auto_vocab, "wide_profile": wide_profile, "one_hot": one_hot, "drop_constant": drop_constant,
    "poly_expand": poly_expand, "add_intercept": add_intercept, "stride_sample": stride_sample,
    "holdout_split": holdout_split, "kfold_assign": kfold_assign, "exact_holdout": exact_holdout,
    "undersample": undersample, "scale_fit": scale_fit, "scale_apply_kfold": scale_apply_kfold,
    "class_ratio": class_ratio, "label_counts": label_counts,
    "mse_loss": _loss_sql("mse"), "mse_balanced_loss": _loss_sql("mse_balanced"),
    "logistic_loss": _loss_sql("logistic"), "logistic_balanced_loss": _loss_sql("logistic_balanced"),
    "mse_gradient": _grad_sql("mse"), "mse_balanced_gradient": _grad_sql("mse_balanced"),
    "logistic_gradient": _grad_sql("logistic"), "logistic_balanced_gradient": _grad_sql("logistic_balanced"),
    "gram_matrix": gram_matrix, "least_squares": least_squares, "least_squares_qr": least_squares, "ridge": ridge,
    "mse_gd": _gd_sql("mse", 0.1), "mse_gd_balanced": _gd_sql("mse_balanced", 0.1),
    "logistic_gd": _gd_sql("logistic", 0.7), "logistic_gd_balanced": _gd_sql("logistic_label", 0.7),
    "logistic_gd_sigmoid_scale": _gd_sql("logistic_balanced", 0.7), "logistic_l2": _gd_sql("logistic", 0.7, 0.1),
    "minibatch_gd": _gd_sql("mse", 0.1, batch=10000),
    "predict_threshold": predict_threshold, "confusion_metrics": confusion_metrics,
    "threshold_search": threshold_search,
    "label_correlation": label_correlation, "split_scale": split_scale, "test_set": test_set, "dataset_len": dataset_len,
    "auto_impute": auto_impute, "saved_pipeline": saved_pipeline, "clean_snapshot": clean_snapshot,
    "ridge_score": ridge_score, "event_scale_fit": event_scale_fit, "csv_load": csv_load,
    "exact_stride_sample": exact_stride_sample, "minibatch_gd_exact": minibatch_gd_exact,
    "kfold_exact": kfold_exact, "minibatch_gd_shuffled": minibatch_gd_shuffled, "minibatch_logistic": minibatch_logistic, "model_scores": model_scores,
}


def oracle_sql() -> dict[str, str]:
    from riskspark.queries import oracle_cv
    out = {name: fn() for name, fn in ORACLES.items()}
    out.update(oracle_cv.cv_oracles())
    return out
