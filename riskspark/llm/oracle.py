"""DuckDB SQL of the queries that SQL can express, written without the operators' code."""

from __future__ import annotations

# One row per kind: name, pattern (RE2), group whose length counts, least length. Fixed patterns.
_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 4, 6),
    ("access", "AKIA[A-Z0-9]+", 2, 20),
    ("hex", "[0-9a-f]+", 2, 24),
    ("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 2, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 2, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 2, 1),
    ("google", "AIza[A-Za-z0-9_-]{35}", 2, 1),
    ("stripe", "sk_live_[A-Za-z0-9]{24,}", 2, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 2, 1),
]


def _matches(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    whole = rf"([\s\S]*?)({pattern})"
    return f"""
SELECT row_id, {rank} AS rank, '{kind}' AS kind, start, start + length(m) AS stop FROM (
  SELECT row_id, m, v, sum(length(g) + length(m)) OVER (PARTITION BY row_id ORDER BY k) - length(m) AS start FROM (
    SELECT row_id, unnest(regexp_extract_all(text, '{whole}', 1)) AS g, unnest(regexp_extract_all(text, '{whole}', 2)) AS m,
           unnest(regexp_extract_all(text, '{whole}', {group})) AS v,
           generate_subscripts(regexp_extract_all(text, '{whole}', 2), 1) AS k
    FROM docs WHERE regexp_matches(text, '{pattern}')))
WHERE length(v) >= {least}"""


_SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_matches(i, *k) for i, k in enumerate(_KINDS))}),
per_row AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) AS n_spans,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank) AS spans,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank)
           FILTER (rank < 3) AS base
  FROM found GROUP BY row_id)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM docs LEFT JOIN per_row USING (row_id)
"""

_EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT links.a, reach.root FROM reach JOIN links ON links.b = reach.vec_id)
SELECT r.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, min(r.root) AS component_id, r.vec_id = min(r.root) AS kept
FROM reach r LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = r.vec_id
GROUP BY r.vec_id, n.n
"""

# CRC-32 of a decimal number's digits, bit by bit; 3988292384 is the reversed polynomial
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.role, t.text, t.pos FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.role, t.text, t.pos FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
placed AS (
  SELECT conv_id, length(text) AS chars, md5(length(role) || ':' || role || text) AS mark,
         row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, chars, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT conv_id, max(depth) AS last FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT path, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM prefixes JOIN ends USING (conv_id) GROUP BY path),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
known AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path)),
sums AS (
  SELECT a.path, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.chars) AS saved_tokens
  FROM known a JOIN known d ON starts_with(d.path, a.path) GROUP BY a.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(n.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM known n JOIN sums s USING (path) LEFT JOIN known p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)
"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents),
d_terms AS (
  SELECT row_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERMS}')) AS term FROM docs),
q_terms AS (
  SELECT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERMS}')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
tf AS (SELECT row_id, term, count(*) AS tf FROM d_terms GROUP BY ALL),
len AS (SELECT row_id, count(*) AS n FROM d_terms GROUP BY ALL),
size AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
norm AS (SELECT row_id, 75 + (25 * n * docs) // terms AS m FROM len, size),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term, docs),
q AS (SELECT item_id, text, term, count(*) AS times FROM q_terms GROUP BY ALL),
scores AS (
  SELECT q.item_id, q.text, tf.row_id, CAST(sum(q.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * norm.m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN norm USING (row_id) GROUP BY ALL),
ranked AS (
  SELECT s.item_id, row_number() OVER (PARTITION BY s.item_id, s.text ORDER BY s.score DESC, d.doc_id NULLS LAST) AS rank, d.doc_id, s.score
  FROM scores s JOIN docs d USING (row_id) WHERE s.score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

# The strings that the template breaks up by one character each; a backslash is doubled
_CONTROLS = ("<turn>", "</turn>", "### System:", "### User:", "### Assistant:", "### Instruction:", "### Response:",
             "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]")


def _escaped(x: str) -> str:
    """Length of ``x`` after escaping."""
    found = " + ".join(f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in (*_CONTROLS, "\\"))
    return f"(length({x}) + {found})"


_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn>') + {_escaped('role')} + length(role) - length(replace(role, chr(10), '')) + 1
                + {_escaped('text')} + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE_SQL = {"op4_secret_scan": _SECRETS, "op9_embedding_near_dedup": _EMBEDDINGS, "op11_conversation_trie": _TRIE,
              "op12_lexical_search": _SEARCH, "op13_chat_format": _CHAT}
