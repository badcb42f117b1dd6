"""Registered queries of the operators and their DuckDB SQL, where SQL can state them."""

from __future__ import annotations

from .credentials import op9_secret_scans
from .decontaminate import op1_decontamination
from .importance import op11_importance_resampling
from .jaccard import op8_jaccard_join
from .language_model import op7_language_model
from .lines import op3_line_dedup
from .mixing import op5_mixing
from .packing import op12_packing
from .quality import op2_quality
from .sharding import op6_sharding
from .tools import op10_tool_calls
from .topk import op4_topk_search
from .vector_codes import op13_vector_codes

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_topk_search": op4_topk_search,
    "op5_mixing": op5_mixing,
    "op6_sharding": op6_sharding,
    "op7_language_model": op7_language_model,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_secret_scans": op9_secret_scans,
    "op10_tool_calls": op10_tool_calls,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_packing": op12_packing,
    "op13_vector_codes": op13_vector_codes,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
item_window AS (
    SELECT DISTINCT item_id, n, list_aggregate(w[s:s + n - 1], 'string_agg', ' ') AS words
    FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM item WHERE len(w) > 0)),
doc_window AS (
    SELECT doc_id, s, n, list_aggregate(w[s:s + n - 1], 'string_agg', ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, d.n, item_id FROM doc_window d JOIN item_window i ON d.n = i.n AND d.words = i.words),
place AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN place ON doc.doc_id = place.doc_id LEFT JOIN found ON doc.doc_id = found.doc_id
"""

_OP4 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

_OP8 = rf"""
WITH RECURSIVE word AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (
    SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, w[s:s + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM word WHERE len(w) >= 3)
        UNION ALL SELECT doc_id, w FROM word WHERE len(w) IN (1, 2))),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
link AS (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN size sa ON sa.doc_id = a JOIN size sb ON sb.doc_id = b WHERE 100 * k >= 90 * (sa.n + sb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM word UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT word.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM word LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _match(kind: str, rank: int, pattern: str, keep: str) -> str:
    """Spans of one kind: the gaps between matches and the matches before give each place."""
    return f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind, role, s AS start, s + len(m) AS "end" FROM (
        SELECT doc_id, m, CASE '{kind}' WHEN 'access' THEN 'ident' WHEN 'ident' THEN 'ident' WHEN 'endpoint' THEN 'endpoint' ELSE 'secret' END AS role,
            list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0) AS s
        FROM (SELECT doc_id, gaps, hits, unnest(hits) AS m, unnest(range(1, len(hits) + 1)) AS i FROM (
            SELECT doc_id, string_split_regex(body, '{pattern}') AS gaps, regexp_extract_all(body, '{pattern}') AS hits FROM body WHERE regexp_matches(body, '{pattern}')))
        WHERE {keep})"""


_MIXED = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"
_OP9 = f"""
WITH body AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
base AS ({_match('assign', 0, _ASSIGN, f"len(regexp_extract(m, '{_ASSIGN}', 2)) >= 12")} UNION ALL {_match('access', 1, 'AKIA[A-Z0-9]+', 'len(m) >= 18')}
    UNION ALL {_match('hex', 2, '[0-9a-f]+', 'len(m) >= 16')}),
candidate AS ({_match('ident', 3, '[A-Z0-9]{16,}', _MIXED)} UNION ALL {_match('random', 4, '[A-Za-z0-9+/_-]{20,}', _MIXED)}
    UNION ALL {_match('endpoint', 5, '[a-z][a-z0-9+.-]{{0,31}}://[^' + chr(92) + 'x00-' + chr(92) + 'x20]+', 'true')}),
weak AS (SELECT * FROM candidate c WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start < c."end" AND c.start < b."end")),
part AS (SELECT * FROM base UNION ALL SELECT * FROM candidate),
linked AS (
    SELECT w.doc_id, w.rank, w.kind, w.role, w.start, w."end", bool_or(p.role = 'ident') AS ident, bool_or(p.role = 'secret') AS secret
    FROM weak w JOIN part p ON p.doc_id = w.doc_id AND p.role <> w.role AND p.start <= w."end" + 256 AND p."end" >= w.start - 256
        AND (p."end" <= w.start OR p.start >= w."end") GROUP BY ALL),
span AS (
    SELECT doc_id, rank, kind, start, "end" FROM base UNION ALL
    SELECT doc_id, rank, kind, start, "end" FROM linked
    WHERE (role = 'ident' AND secret) OR (role = 'secret' AND ident) OR (role = 'endpoint' AND ident AND secret)),
told AS (
    SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
        string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
        string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans
    FROM span GROUP BY doc_id)
SELECT body.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM body LEFT JOIN told USING (doc_id)
"""

_OP10 = """
WITH RECURSIVE ask AS (
    SELECT conv_id, 'c' || turn AS id, turn, role AS name, coalesce(text, '') AS text,
        CASE WHEN text IS NULL THEN -1 ELSE len(list_filter(string_split(text, ' '), lambda w: w <> '')) END AS words
    FROM conversations WHERE role IS DISTINCT FROM 'assistant'),
answer AS (SELECT conv_id, 'c' || (turn - 1) AS id, turn, text FROM conversations WHERE role = 'assistant'),
after AS (SELECT ask.conv_id, ask.id, p.id AS dep, p.turn AS above FROM ask LEFT JOIN ask p ON ask.turn > 0 AND p.conv_id = ask.conv_id AND p.turn = ask.turn // 2),
level AS (SELECT conv_id, id, 0 AS level FROM after WHERE dep IS NULL UNION ALL SELECT a.conv_id, a.id, l.level + 1 FROM after a JOIN level l ON a.conv_id = l.conv_id AND a.dep = l.id),
call AS (
    SELECT ask.*, level.level, list_sort(list_filter([
            CASE WHEN name = 'system' THEN 'unknown:words' END,
            CASE WHEN turn > 0 AND after.dep IS NULL THEN 'after:c' || (turn // 2) END], lambda e: e IS NOT NULL)) AS errors,
        '{"text":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '}' AS args
    FROM ask JOIN after USING (conv_id, id) LEFT JOIN level USING (conv_id, id))
SELECT coalesce(call.conv_id, answer.conv_id) AS conv_id, coalesce(call.id, answer.id) AS id, call.name, call.turn, answer.turn AS result_turn, level,
    CASE WHEN call.id IS NOT NULL AND answer.id IS NOT NULL THEN 'linked' WHEN call.id IS NOT NULL THEN 'no_result' ELSE 'no_call' END AS status,
    CAST(call.id IS NOT NULL AS BIGINT) AS n_calls, CAST(answer.id IS NOT NULL AS BIGINT) AS n_results, coalesce(array_to_string(errors, ','), '') AS errors,
    CASE WHEN args IS NOT NULL THEN '{"arguments":' || args || ',"id":' || to_json(call.id) || ',"name":' || to_json(name) || CASE WHEN answer.text IS NULL THEN '' ELSE ',"result":' || to_json(answer.text) END || '}' END AS line
FROM call FULL JOIN answer ON call.conv_id = answer.conv_id AND call.id = answer.id
"""

# The CRC of each distinct word byte by byte, by the table of the reflected polynomial.
_OP11 = rf"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, CAST(i AS BIGINT) AS r, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT byte, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, k + 1 FROM bits WHERE k < 8),
step AS MATERIALIZED (SELECT list(r ORDER BY byte) AS t FROM bits WHERE k = 8),
said AS MATERIALIZED (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS row, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL SELECT 'b', NULL, row_number() OVER (), regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
word AS MATERIALIZED (SELECT side, row, word, count(*) AS c FROM (SELECT side, row, unnest(w) AS word FROM said) GROUP BY ALL),
spelt AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM word)),
bucket AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
        lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) % 10000 AS b FROM spelt, step),
share AS (SELECT b, sum(c) FILTER (side = 'd') AS s, sum(c) FILTER (side = 'b') AS t FROM word JOIN bucket USING (word) GROUP BY b),
total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM share),
gain AS (SELECT b, CAST(floor(1000 * ln(CAST(coalesce(share.t, 0) + 1 AS DOUBLE) * CAST(total.s + 10000 AS DOUBLE) / (CAST(coalesce(share.s, 0) + 1 AS DOUBLE) * CAST(total.t + 10000 AS DOUBLE)))) AS BIGINT) AS g FROM share, total),
mean AS (SELECT row, CAST(floor(CAST(sum(c * g) AS DOUBLE) / sum(c)) AS BIGINT) AS weight FROM word JOIN bucket USING (word) JOIN gain USING (b) WHERE side = 'd' GROUP BY row),
scored AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM said LEFT JOIN mean USING (row) WHERE side = 'd'),
placed AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) END AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank FROM placed
"""


def _op13() -> str:
    """The rounds one after another, each a table of assignments and one of entries."""
    steps = ["""cells AS MATERIALIZED (
    SELECT vec_id, label, row, part, list_transform(v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8], lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM (SELECT vec_id, label, embedding AS v, row_number() OVER (ORDER BY vec_id) AS row FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0), range(8) p(part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, c FROM cells WHERE row <= 16)"""]
    for i in range(7):
        steps.append(f"""code{i} AS MATERIALIZED (
    SELECT row, part, arg_min(entry, d * 100 + entry) AS entry, min(d) AS d FROM (
        SELECT x.row, x.part, e.entry, CAST(list_sum(list_transform(list_zip(x.c, e.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM cells x JOIN book{i} e ON x.part = e.part)
    GROUP BY row, part)""")
        if i < 6:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(new.c, old.c) AS c FROM book{i} old LEFT JOIN (
        SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM (
            SELECT part, entry, j, sum(v) AS s, count(*) AS n FROM (SELECT part, entry, unnest(c) AS v, unnest(range(len(c))) AS j FROM cells JOIN code{i} USING (row, part)) GROUP BY ALL)
        GROUP BY part, entry) new USING (part, entry))""")
    return "WITH " + ",\n".join(steps) + """,
found AS (SELECT vec_id, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM cells JOIN code6 USING (row, part) GROUP BY row, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book6) AS codebooks_sha256
FROM found
"""


ORACLE = {"op1_decontamination": _OP1, "op4_topk_search": _OP4, "op8_jaccard_join": _OP8, "op9_secret_scans": _OP9, "op10_tool_calls": _OP10, "op11_importance_resampling": _OP11, "op13_vector_codes": _op13()}
