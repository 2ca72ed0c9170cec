"""The modelling tables of ``riskspark.sources.tables`` as DuckDB SQL, for oracles."""

# The row key is the first 8 hex digits of md5('<seed>:<key>:...'), one of 4294967296.
# Written here on its own, so that an error in the library's key does not pass on both sides.
KEYS = 4294967296


def hash32_sql(seed, *key_sql: str) -> str:
    joined = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in key_sql)
    return f"('0x' || substr(md5('{seed}:' || {joined}), 1, 8))::BIGINT"


def fraction_cut(ratio: float) -> int:
    """Keys below this number are the first ``ratio`` share."""
    return int(ratio * KEYS)


_CUT = fraction_cut(0.2)


def _split(*keys: str) -> str:
    return f"CASE WHEN {hash32_sql('split', *keys)} < {_CUT} THEN 'test' ELSE 'train' END"


ORDER_RISK = f"""
SELECT CAST(o_orderkey AS BIGINT) AS id,
       {_split('o_orderkey')} AS split,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE -1 END AS INTEGER) AS label,
       CAST(o_totalprice AS DOUBLE) AS totalprice,
       CAST(CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS DOUBLE) AS acctbal,
       CAST(month(o_orderdate) AS DOUBLE) AS ordermonth,
       o_orderstatus AS orderstatus,
       c_mktsegment AS mktsegment,
       CAST(n_regionkey AS DOUBLE) AS regionkey
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

LINE_NUM = f"""
SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS key,
       {_split('l_orderkey', 'l_linenumber')} AS split,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END AS INTEGER) AS label,
       CAST(l_quantity AS DOUBLE) AS quantity,
       CAST(l_extendedprice AS DOUBLE) AS price,
       CAST(l_discount AS DOUBLE) AS discount,
       CAST(CASE WHEN l_tax <> 0.0 THEN l_tax END AS DOUBLE) AS tax,
       CAST(CASE WHEN l_quantity <= 40 THEN l_quantity END AS DOUBLE) AS qty_low,
       l_linestatus AS linestatus
FROM lineitem
"""

DOC_RISK = f"""
SELECT CAST(d.doc_id AS BIGINT) AS id,
       {_split('d.doc_id')} AS split,
       CAST(CASE WHEN l.toxic = 1 THEN 1 ELSE -1 END AS INTEGER) AS label,
       CAST(d.n_chars AS DOUBLE) AS n_chars,
       d.lang AS lang,
       d.source AS source
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

EMB_DIM = 64
EMB = f"""
SELECT CAST(vec_id AS BIGINT) AS id,
       {_split('vec_id')} AS split,
       CAST(CASE WHEN label = 0 THEN 1 ELSE -1 END AS INTEGER) AS label,
       {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}' for i in range(EMB_DIM))}
FROM embeddings
"""

EVENT_NUM = f"""
SELECT CAST(event_id AS BIGINT) AS id,
       {_split('event_id')} AS split,
       CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE -1 END AS INTEGER) AS label,
       CAST(value AS DOUBLE) AS value,
       CAST(NULLIF(regexp_extract(props, '"k":\\s*(-?[0-9.]+)', 1), '') AS DOUBLE) AS k,
       CAST(hour(ts) AS DOUBLE) AS hour
FROM events
"""

TABLES_SQL = {
    "order_risk": ORDER_RISK,
    "line_num": LINE_NUM,
    "doc_risk": DOC_RISK,
    "emb": EMB,
    "event_num": EVENT_NUM,
}


def with_tables(body: str, *names: str) -> str:
    """Prefix ``body`` with CTEs for the named modelling tables."""
    ctes = ",\n".join(f"{n} AS ({TABLES_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{body}"
