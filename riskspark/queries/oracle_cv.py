"""SQL oracle for cross-validation queries: the whole CV as DuckDB SQL.

One recursive CTE runs gradient descent for every (config, fold) pair, with
per-fold standardisation computed by plain aggregates over the other folds;
the threshold search is a brute-force cross join with the grid."""

from __future__ import annotations

from riskspark.queries.oracle import (FOLD, HOLDOUT, K, MKT_SEGMENTS, ORDER_STATUS, _order_clean_cte, r6, sql)

ONEHOT = ([f"orderstatus_{v}" for v in ORDER_STATUS] + [f"mktsegment_{v}" for v in MKT_SEGMENTS]
          + [f"regionkey_{i}" for i in range(5)])
CONT = ["totalprice", "acctbal"]


class Table:
    """What the CV oracle needs to know about a cleaned modelling table."""

    def __init__(self, name, clean_cte, cont, onehot):
        self.name, self.clean_cte, self.cont, self.onehot = name, clean_cte, cont, onehot


ORDER = Table("order_risk", _order_clean_cte(), CONT, ONEHOT)

# The doc_risk spec's vocabularies (languages found by auto typing).
DOC_LANGS = ["de", "en", "es", "fr"]
DOC_SOURCES = [f"src{i}" for i in range(20)]
_DOC_ONEHOT_SQL = ([f"CAST(CASE WHEN lang IS NOT DISTINCT FROM '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS lang_{v}"
                    for v in DOC_LANGS]
                   + [f"CAST(CASE WHEN source IS NOT DISTINCT FROM '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS source_{v}"
                      for v in DOC_SOURCES])
DOC = Table("doc_risk",
            ("clean", "SELECT id, split, label, CASE WHEN n_chars IS NULL THEN avg(n_chars) OVER (PARTITION BY split) "
                      "ELSE n_chars END AS n_chars, " + ", ".join(_DOC_ONEHOT_SQL) + " FROM doc_risk"),
            ["n_chars"], [f"lang_{v}" for v in DOC_LANGS] + [f"source_{v}" for v in DOC_SOURCES])


def cont_columns(degree: int, table: Table = ORDER) -> list[tuple[str, str]]:
    """(name, SQL expression) of the continuous layout columns, powers interleaved."""
    out = []
    for c in table.cont:
        for j in range(1, degree + 1):
            out.append((c if j == 1 else f"{c}_p{j}", c if j == 1 else f"pow({c}, {float(j)})"))
    return out


def _residual(t: str) -> tuple[str, str, str]:
    """(residual, training loss, plain loss) per row; needs cfg.lc, cfg.bc, rr.r, y."""
    y01 = "(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END)"
    sig = f"(1.0 / (1.0 + exp(-({t}))))"
    sp = f"(greatest({t}, 0.0) + ln(1 + exp(-abs({t}))))"
    e = f"(y - ({t}))"
    eb = (f"(CASE WHEN bc = 1 THEN (CASE WHEN r > 1 THEN (CASE WHEN {e} >= 0 THEN {e} * r ELSE {e} END) "
          f"ELSE (CASE WHEN {e} <= 0 THEN {e} * r ELSE {e} END) END) ELSE {e} END)")
    om = (f"(CASE WHEN bc = 2 THEN (CASE WHEN r > 1 THEN (CASE WHEN {y01} = 1 THEN r ELSE 1.0 END) "
          f"ELSE (CASE WHEN {y01} = 0 THEN r ELSE 1.0 END) END) ELSE 1.0 END)")
    res = f"(CASE WHEN lc = 0 THEN -{eb} ELSE {om} * ({sig} - {y01}) END)"
    trl = f"(CASE WHEN lc = 0 THEN {eb} * {eb} / 2.0 ELSE {om} * (-{y01} * ({t}) + {sp}) END)"
    pl = f"(CASE WHEN lc = 0 THEN {e} * {e} / 2.0 ELSE -{y01} * ({t}) + {sp} END)"
    return res, trl, pl


def cv_sql(configs: list[dict], degree: int, body: str, table: Table = ORDER) -> str:
    """configs: dicts with name, loss ('mse'|'logistic'), balance (None|'residual_sign'|'label'),
    gamma, lam, steps, search (0 = fixed threshold), threshold."""
    cont = cont_columns(degree, table)
    onehot = table.onehot
    names = [n for n, _ in cont] + onehot
    D = 1 + len(names)
    xs = [f"x{j}" for j in range(D)]
    ws = [f"w{j}" for j in range(D)]
    max_steps = max(c["steps"] for c in configs)
    fr = ("fr", f"SELECT id, CAST(label AS DOUBLE) AS y, {FOLD} AS fold, "
                + ", ".join(f"{e} AS {n}" for n, e in cont) + ", " + ", ".join(onehot)
                + f" FROM clean WHERE split = 'train' AND NOT ({HOLDOUT})")
    folds = ("folds", f"SELECT CAST(range AS BIGINT) AS f FROM range({K})")
    st = ("st", "SELECT f, " + ", ".join(f"avg({n}) AS m{k}, stddev_pop({n}) AS s{k}" for k, (n, _) in enumerate(cont))
                + " FROM folds JOIN fr ON fr.fold <> folds.f GROUP BY f")
    scaled = [f"CASE WHEN s{k} > 0 THEN ({n} - m{k}) / s{k} ELSE 0.0 END AS x{k + 1}" for k, (n, _) in enumerate(cont)]
    onehot_x = [f"{n} AS x{1 + len(cont) + j}" for j, n in enumerate(onehot)]
    sd = ("sd", "SELECT st.f, fr.fold = st.f AS is_val, fr.y, CAST(1.0 AS DOUBLE) AS x0, "
                + ", ".join(scaled + onehot_x) + " FROM fr JOIN st ON TRUE")
    rr = ("rr", "SELECT f, CASE WHEN count(*) FILTER (WHERE y = -1) = 0 THEN 1.0 ELSE "
                "CAST(count(*) FILTER (WHERE y = -1) AS DOUBLE) / count(*) FILTER (WHERE y = 1) END AS r "
                "FROM folds JOIN fr ON fr.fold <> folds.f GROUP BY f")
    rows = []
    for i, c in enumerate(configs):
        lc = 0 if c["loss"] == "mse" else 1
        bc = {None: 0, "residual_sign": 1, "label": 2}[c.get("balance")]
        rows.append(f"({i}, '{c['name']}', {lc}, {bc}, CAST({float(c['gamma'])!r} AS DOUBLE), "
                    f"CAST({float(c.get('lam', 0.0))!r} AS DOUBLE), {int(c['steps'])}, {int(c.get('search', 0))}, "
                    f"CAST({float(c.get('threshold', 0.0))!r} AS DOUBLE), {1 if c.get('penalty') else 0})")
    cfg = ("cfg", "SELECT * FROM (VALUES " + ", ".join(rows) + ") v(c, name, lc, bc, gamma, lam, steps, nthr, thr, pen)")
    t = " + ".join(f"{x} * {w}" for x, w in zip(xs, ws))
    res, trl, pl = _residual(t)
    upd = ", ".join(f"CASE WHEN step < steps THEN {w} - gamma * (avg({res} * {x}) + 2 * lam * {w}) ELSE {w} END"
                    for x, w in zip(xs, ws))
    g = (f"g(step, c, f, {', '.join(ws)})",
         f"SELECT 0, cfg.c, folds.f, {', '.join('CAST(0.0 AS DOUBLE)' for _ in ws)} FROM cfg, folds "
         f"UNION ALL SELECT step + 1, g.c, g.f, {upd} FROM g JOIN cfg ON cfg.c = g.c "
         f"JOIN sd ON sd.f = g.f AND NOT sd.is_val JOIN rr ON rr.f = g.f "
         f"WHERE step < {max_steps} GROUP BY step, g.c, g.f, {', '.join(ws)}, steps, gamma, lam")
    fw = ("fw", f"SELECT * FROM g WHERE step = {max_steps}")
    score = f"(CASE WHEN lc = 0 THEN {t} ELSE 1.0 / (1.0 + exp(-({t}))) END)"
    ev = ("ev", f"SELECT fw.c, fw.f, sd.is_val, sd.y, {score} AS score, {trl} AS trl, {pl} AS pl "
                "FROM fw JOIN cfg ON cfg.c = fw.c JOIN sd ON sd.f = fw.f JOIN rr ON rr.f = fw.f")
    pen = " + ".join(f"{w} * {w}" for w in ws)
    ls = ("ls", f"SELECT ev.c, ev.f, avg(trl) FILTER (WHERE NOT is_val) AS train_loss, "
                f"avg(pl) FILTER (WHERE is_val) + max(CASE WHEN pen = 1 THEN lam * ({pen}) ELSE 0.0 END) AS val_loss "
                "FROM ev JOIN cfg ON cfg.c = ev.c JOIN fw ON fw.c = ev.c AND fw.f = ev.f GROUP BY ev.c, ev.f")
    th = ("th", "SELECT n, i, i * (CAST(2.0 AS DOUBLE) / (n - 1)) - 1.0 AS t FROM "
                "(SELECT n, unnest(range(n)) AS i FROM (SELECT DISTINCT nthr AS n FROM cfg WHERE nthr > 1))")
    pos = "(CASE WHEN score <= t THEN -1 ELSE 1 END) = 1"
    cnt = ("cnt", f"SELECT ev.c, ev.f, th.i, th.t, count(*) FILTER (WHERE y <> -1 AND {pos}) AS tp, "
                  f"count(*) FILTER (WHERE y <> -1 AND NOT ({pos})) AS fn, "
                  f"count(*) FILTER (WHERE y = -1 AND NOT ({pos})) AS tn, "
                  f"count(*) FILTER (WHERE y = -1 AND {pos}) AS fp "
                  "FROM ev JOIN cfg ON cfg.c = ev.c JOIN th ON th.n = cfg.nthr WHERE ev.is_val GROUP BY ev.c, ev.f, th.i, th.t")
    rec = "(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END)"
    pre = "(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END)"
    f1 = f"(CASE WHEN {pre} + {rec} > 0 THEN 2.0 * ({pre} * {rec}) / ({pre} + {rec}) ELSE 0.0 END)"
    best = ("best", f"SELECT c, f, CASE WHEN f1 > 0 THEN t ELSE 0.0 END AS thr FROM (SELECT c, f, i, t, {f1} AS f1, "
                    f"row_number() OVER (PARTITION BY c, f ORDER BY {f1} DESC, i) AS rk FROM cnt) WHERE rk = 1")
    ch = ("ch", "SELECT cfg.c, folds.f, CASE WHEN cfg.nthr > 0 THEN coalesce(best.thr, 0.0) ELSE cfg.thr END AS thr "
                "FROM cfg CROSS JOIN folds LEFT JOIN best ON best.c = cfg.c AND best.f = folds.f")
    pv = "(CASE WHEN score <= ch.thr THEN -1 ELSE 1 END)"
    mt = ("mt", f"SELECT ev.c, ev.f, ch.thr, count(*) FILTER (WHERE y <> -1 AND {pv} = 1) AS tp, "
                f"count(*) FILTER (WHERE y <> -1 AND {pv} = -1) AS fn, "
                f"count(*) FILTER (WHERE y = -1 AND {pv} = -1) AS tn, "
                f"count(*) FILTER (WHERE y = -1 AND {pv} = 1) AS fp "
                "FROM ev JOIN ch ON ch.c = ev.c AND ch.f = ev.f WHERE ev.is_val GROUP BY ev.c, ev.f, ch.thr")
    acc = "(CASE WHEN tp + fn + tn + fp > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + fn + tn + fp) ELSE 0.0 END)"
    fpr = "(CASE WHEN fp + tn > 0 THEN CAST(fp AS DOUBLE) / (fp + tn) ELSE 0.0 END)"
    res_cte = ("res", f"SELECT mt.c, mt.f, ls.train_loss, ls.val_loss, mt.thr AS threshold, {acc} AS accuracy, "
                      f"{rec} AS recall, {fpr} AS fpr, {pre} AS precision, {f1} AS f1, tp, fn, tn, fp "
                      "FROM mt JOIN ls ON ls.c = mt.c AND ls.f = mt.f")
    ctes = (table.clean_cte, fr, folds, st, sd, rr, cfg, g, fw, ev, ls, th, cnt, best, ch, mt, res_cte)
    return sql(body, (table.name,), ctes, recursive=True)


def _avg_model_ctes(degree: int, c: int = 0):
    cont = cont_columns(degree)
    D = 1 + len(cont) + len(ONEHOT)
    wa = ("wa", "SELECT " + ", ".join(f"avg(w{j}) AS a{j}" for j in range(D))
                + f" FROM fw WHERE c = {c}")
    sa = ("sa", "SELECT " + ", ".join(f"avg(m{k}) AS am{k}, avg(s{k}) AS as{k}" for k in range(len(cont)))
                + " FROM st")
    ta = ("ta", f"SELECT avg(thr) AS athr FROM ch WHERE c = {c}")
    xs = ["1.0"] + [f"(CASE WHEN as{k} > 0 THEN ({e} - am{k}) / as{k} ELSE 0.0 END)" for k, (_, e) in enumerate(cont)] + ONEHOT
    t = " + ".join(f"{x} * a{j}" for j, x in enumerate(xs))
    return (wa, sa, ta), t


def averaged(body_fn, configs, degree=1):
    """SQL whose final SELECT can use wa / sa / ta (fold-averaged model of config 0)."""
    (wa, sa, ta), t = _avg_model_ctes(degree)
    inner = cv_sql(configs, degree, "SELECT 1")
    # splice the averaging CTEs before the final select
    head, _ = inner.rsplit("\nSELECT 1", 1)
    return (head + f",\n{wa[0]} AS ({wa[1]}),\n{sa[0]} AS ({sa[1]}),\n{ta[0]} AS ({ta[1]})\n" + body_fn(t))


FLAGSHIP = [dict(name="flagship", loss="logistic", gamma=0.7, steps=400, search=100)]
FULL = [dict(FLAGSHIP[0], steps=400)]
METRICS = ("accuracy", "recall", "fpr", "precision", "f1")
# The published grids of degrees and step sizes.
SWEEP_DEGREES = [1, 2, 3, 5, 7]
SWEEP_GAMMAS = [0.01, 0.016681005372000592, 0.027825594022071243, 0.046415888336127774, 0.0774263682681127,
                0.1291549665014884, 0.21544346900318834, 0.3593813663804626, 0.48, 0.5994842503189409, 0.7, 1.0]
# The ablation settings, as on the Spark side.
ABLATION = [
    dict(name="LR", loss="mse", gamma=0.01, steps=300, search=0, threshold=0.0),
    dict(name="LR_balanced", loss="mse", balance="residual_sign", gamma=0.01, steps=300, search=0, threshold=0.0),
    dict(name="LR_th", loss="mse", gamma=0.01, steps=300, search=100),
    dict(name="LR_balanced_th", loss="mse", balance="residual_sign", gamma=0.01, steps=300, search=100),
    dict(name="LogR", loss="logistic", balance="label", gamma=0.7, steps=300, search=0, threshold=0.5),
    dict(name="LogR_balanced", loss="logistic", balance="label", gamma=0.7, steps=300, search=0, threshold=0.5),
    dict(name="LogR_th", loss="logistic", gamma=0.7, steps=300, search=1000),
    dict(name="LogR_balanced_th", loss="logistic", balance="label", gamma=0.7, steps=300, search=1000),
]


def cross_validate(configs=FLAGSHIP) -> str:
    cols = ", ".join(r6(c) + f" AS {c}" for c in ("train_loss", "val_loss", "threshold") + METRICS)
    return cv_sql(configs, 1, f"SELECT CAST(f AS BIGINT) AS fold, {cols} FROM res")


def fold_average() -> str:
    cont = cont_columns(1)
    D = 1 + len(cont) + len(ONEHOT)

    def body(_t):
        parts = [f"SELECT 'w{j}' AS term, {r6(f'a{j}')} AS value FROM wa" for j in range(D)]
        parts.append(f"SELECT 'threshold', {r6('athr')} FROM ta")
        parts += [f"SELECT 'mean_{n}', {r6(f'am{k}')} FROM sa" for k, (n, _) in enumerate(cont)]
        parts += [f"SELECT 'std_{n}', {r6(f'as{k}')} FROM sa" for k, (n, _) in enumerate(cont)]
        return " UNION ALL ".join(parts)
    return averaged(body, FLAGSHIP)


def _scored(where: str, t: str) -> str:
    return (f"SELECT id, label, CASE WHEN 1.0 / (1.0 + exp(-({t}))) <= athr THEN -1 ELSE 1 END AS pred "
            f"FROM clean, wa, sa, ta WHERE {where}")


def holdout_metrics() -> str:
    def body(t):
        sc = _scored(f"split = 'train' AND {HOLDOUT}", t)
        cnt = (f"SELECT CAST(count(*) FILTER (WHERE label <> -1 AND pred = 1) AS BIGINT) AS tp, "
               f"CAST(count(*) FILTER (WHERE label <> -1 AND pred = -1) AS BIGINT) AS fn, "
               f"CAST(count(*) FILTER (WHERE label = -1 AND pred = -1) AS BIGINT) AS tn, "
               f"CAST(count(*) FILTER (WHERE label = -1 AND pred = 1) AS BIGINT) AS fp FROM ({sc})")
        rec = "(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END)"
        pre = "(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END)"
        f1 = f"(CASE WHEN {pre} + {rec} > 0 THEN 2.0 * ({pre} * {rec}) / ({pre} + {rec}) ELSE 0.0 END)"
        acc = "(CASE WHEN tp + fn + tn + fp > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + fn + tn + fp) ELSE 0.0 END)"
        fpr = "(CASE WHEN fp + tn > 0 THEN CAST(fp AS DOUBLE) / (fp + tn) ELSE 0.0 END)"
        return (f"SELECT tp, fn, tn, fp, {r6(acc)} AS accuracy, {r6(rec)} AS recall, {r6(fpr)} AS fpr, "
                f"{r6(pre)} AS precision, {r6(f1)} AS f1 FROM ({cnt})")
    return averaged(body, FLAGSHIP)


def submission(configs=FLAGSHIP) -> str:
    def body(t):
        return ("SELECT CAST(id AS BIGINT) AS Id, CAST(pred AS INTEGER) AS Prediction FROM ("
                + _scored("split = 'test'", t) + ")")
    return averaged(body, configs)


def stream_scores() -> str:
    def body(t):
        return (f"SELECT CAST(id AS BIGINT) AS id, {r6(t)} AS score, CAST(CASE WHEN {t} <= athr THEN -1 ELSE 1 END AS BIGINT) AS prediction "
                "FROM clean, wa, sa, ta WHERE split = 'test'")
    return averaged(body, [dict(name="stream", loss="mse", gamma=0.1, steps=400, search=100)])


def degree_sweep() -> str:
    parts = []
    for deg in SWEEP_DEGREES:
        cfg = [dict(name="deg", loss="mse", gamma=0.001, steps=200, search=100)]
        D = 1 + len(cont_columns(deg)) + len(ONEHOT)
        norm = "sqrt(" + " + ".join(f"avg(w{j}) * avg(w{j})" for j in range(D)) + ")"
        body = (f"SELECT CAST({deg} AS BIGINT) AS degree, {r6('m.tl')} AS train_loss, {r6('m.vl')} AS val_loss, "
                f"{r6('m.f1')} AS f1, {r6('m.acc')} AS accuracy, {r6('m.thr')} AS threshold, {r6('n.nrm')} AS weights_norm "
                "FROM (SELECT avg(train_loss) AS tl, avg(val_loss) AS vl, avg(f1) AS f1, avg(accuracy) AS acc, "
                f"avg(threshold) AS thr FROM res) m, (SELECT {norm} AS nrm FROM fw) n")
        parts.append(cv_sql(cfg, deg, body))
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def rate_sweep() -> str:
    cfgs = [dict(name=f"g{i}", loss="logistic", gamma=g, steps=300, search=100) for i, g in enumerate(SWEEP_GAMMAS)]
    return cv_sql(cfgs, 1, "SELECT " + r6("cfg.gamma") + " AS gamma, " + r6("avg(f1)") + " AS f1, "
                  + r6("avg(accuracy)") + " AS accuracy, " + r6("avg(threshold)") + " AS threshold "
                  "FROM res JOIN cfg ON cfg.c = res.c GROUP BY cfg.c, cfg.gamma")


def ablation() -> str:
    return cv_sql(ABLATION, 1, "SELECT cfg.name AS config, " + r6("avg(f1)") + " AS f1, "
                  + r6("avg(accuracy)") + " AS accuracy, " + r6("avg(threshold)") + " AS threshold "
                  "FROM res JOIN cfg ON cfg.c = res.c GROUP BY cfg.c, cfg.name")


def doc_cross_validate() -> str:
    cols = ", ".join(r6(c) + f" AS {c}" for c in ("train_loss", "val_loss", "threshold") + METRICS)
    cfg = [dict(name="doc", loss="mse", gamma=0.1, steps=400, search=100)]
    return cv_sql(cfg, 1, f"SELECT CAST(f AS BIGINT) AS fold, {cols} FROM res", DOC)


def cv_oracles() -> dict[str, str]:
    return {"doc_cross_validate": doc_cross_validate(), "cross_validate": cross_validate(), "fold_average": fold_average(),
            "holdout_metrics": holdout_metrics(), "submission": submission(),
            "cross_validate_full": cross_validate(FULL), "end_to_end": submission(FULL),
            "degree_sweep": degree_sweep(), "degree_grid": degree_sweep(), "stream_scores": stream_scores(), "rate_sweep": rate_sweep(), "ablation": ablation()}
