"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .quality import BASE, RULES, STOP_WORDS

W = r"[^\x20\x09-\x0D]+"
_U = "((('0x' || substr(md5({}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE)"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS.split()))
    bad = {r.name: f"(n_words >= {r.min_words} AND (" + " OR ".join(
        [f"({r.metric})::DOUBLE < {r.low}::DOUBLE"] * (r.low is not None)
        + [f"({r.metric})::DOUBLE > {r.high}::DOUBLE"] * (r.high is not None)) + "))" for r in RULES}
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{W}') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
cov AS (SELECT rid, count(DISTINCT i + o) AS n FROM dup, range(8) r(o) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(t, '[\p{{L}}\p{{M}}\p{{N}}\x20\x09-\x0D]', '', 'g'))::BIGINT AS n_marks,
        len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_letter_words,
        len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words
      FROM w LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({" OR ".join(bad[b] for b in BASE)}) AS base_failed, NOT ({" OR ".join(bad.values())}) AS kept
FROM m
"""


def _mix() -> str:
    # few sources, so the water levels are found by trying every prefix of the
    # sources (documents) in the order in which they reach their bound
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{W}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
o AS (SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(3 * source_size) OVER p, 0) AS full_before,
        sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS w_left
      FROM s WINDOW p AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT any_value(level) AS level, any_value(num) AS num, any_value(den) AS den FROM (
        SELECT (total - full_before) / w_left::DOUBLE AS level, total - full_before AS num, w_left AS den
        FROM o WHERE (total - full_before) * w < 3 * source_size * w_left ORDER BY 3.0 * source_size / w, source NULLS LAST LIMIT 1)),
g AS (SELECT source, source_size, CASE WHEN num * w >= 3 * source_size * den THEN 3.0::DOUBLE * source_size
             ELSE (num * w)::DOUBLE / den::DOUBLE END AS target FROM o, lvl),
p AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS whole FROM g),
x AS (SELECT d.doc_id, d.size, d.source, p.source_size, p.target, p.whole,
        round_even(p.target - p.whole * p.source_size, 0)::BIGINT AS rest,
        greatest(floor(1024 * sqrt(d.size)), 1)::BIGINT AS x, {_U.format("'7:' || coalesce(d.doc_id::VARCHAR, '')")} AS u
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
c AS (SELECT *, coalesce(sum(size) OVER b, 0) AS fixed, sum(x::HUGEINT * size) OVER a AS xs FROM x WHERE size > 0
      WINDOW b AS (PARTITION BY source ORDER BY x DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             a AS (PARTITION BY source ORDER BY x DESC, doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k AS (SELECT source, arg_max((rest - fixed)::DOUBLE / xs::DOUBLE, x) AS scale, arg_max(fixed, x) AS fixed
      FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY x DESC, doc_id) AS rn FROM c
            WHERE rest > 0 AND (rest - fixed)::DOUBLE / xs::DOUBLE * x < 1
            QUALIFY row_number() OVER (PARTITION BY source ORDER BY x DESC, doc_id) = 1) GROUP BY source),
q AS (SELECT x.*, k.scale, k.fixed, k.scale * x.x AS p,
        CASE WHEN k.scale * x.x < 1 THEN (u / (1.0 - u)) / ((k.scale * x.x) / (1.0 - k.scale * x.x)) END AS q
      FROM x LEFT JOIN k ON x.source IS NOT DISTINCT FROM k.source),
r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, size > 0 AND p < 1 ORDER BY q, doc_id::VARCHAR, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM q),
t AS (SELECT *, whole + CASE WHEN size > 0 AND scale IS NOT NULL AND (p >= 1 OR bef + size / 2.0 <= rest - fixed)
                             THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::INT AS copies FROM t
"""


_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
SELECT q.vec_id AS query_id,
       (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id))::INT AS rank,
       c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
WHERE q.vec_id % 100 = 0 QUALIFY rank <= 10
"""

_LINES = r"""
WITH l AS (SELECT doc_id, i - 1 AS line_no, list_sort(list_distinct(regexp_extract_all(lower(l), '[^\x20\x09-\x0D]+'))) AS ws
           FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
                 FROM (SELECT DISTINCT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL))),
c AS (SELECT row_number() OVER (ORDER BY min((doc_id, line_no))) AS ord, min((doc_id, line_no)) AS first, ws, len(ws) AS n
      FROM l WHERE len(ws) >= 1 GROUP BY ws),
t AS (SELECT ord, n, unnest(ws) AS w FROM c),
f AS (SELECT w, count(*) AS k FROM t GROUP BY w),
e AS (SELECT ord, n, w FROM t JOIN f USING (w)
      QUALIFY row_number() OVER (PARTITION BY ord ORDER BY k, w) <= n - (80 * n + 99) // 100 + 1),
p AS (SELECT DISTINCT x.ord AS a, y.ord AS b FROM e x JOIN e y ON x.w = y.w AND x.ord > y.ord
      AND 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n),
h AS (SELECT DISTINCT a FROM p JOIN c x ON x.ord = a JOIN c y ON y.ord = b
      WHERE 100 * len(list_intersect(x.ws, y.ws)) >= 80 * (x.n + y.n - len(list_intersect(x.ws, y.ws))))
SELECT DISTINCT l.doc_id, l.line_no::INT AS line_no, c.n::INT AS n_tokens
FROM l JOIN c ON l.ws = c.ws LEFT JOIN h ON h.a = c.ord
WHERE h.a IS NOT NULL OR (l.doc_id, l.line_no) <> c.first
"""

_NEAR = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM d),
x AS (SELECT rid, doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
p AS (SELECT a.rid AS r, b.rid AS q, any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, count(*) AS common,
        any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.h = b.h AND a.rid <> b.rid GROUP BY a.rid, b.rid),
e AS (SELECT DISTINCT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
reach AS (SELECT doc_id AS id, doc_id AS m FROM s UNION SELECT e.b, reach.m FROM reach JOIN e ON e.a = reach.id),
c AS (SELECT id, min(m) AS component_id FROM reach GROUP BY id)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, CASE WHEN len(sh) = 0 THEN doc_id ELSE component_id END AS component_id,
       len(sh) = 0 OR doc_id = component_id AS kept FROM s JOIN c ON c.id = s.doc_id
""".replace("WITH d AS", "WITH RECURSIVE d AS", 1)

# CRC-32 byte by byte: the table by its rule, then one fold over the bytes
_SHARDS = rf"""
WITH k AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda a, b:
        CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))),
d AS (SELECT doc_id, source, coalesce(text, '') AS x, hex(encode(coalesce(text, ''))) AS hx FROM documents),
f AS (SELECT doc_id, source, octet_length(encode(x)) + 1 AS size, xor(list_reduce(list_transform(range(octet_length(encode(x))),
        lambda j: ('0x' || substr(hx, 2 * j + 1, 2))::BIGINT), lambda a, b: xor(a >> 8, k.t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT),
        4294967295) AS crc FROM d, k),
u AS (SELECT *, concat_ws('|', doc_id, crc, size) AS key, coalesce('v' || source, 'n') AS g FROM f),
r AS (SELECT *, {_U.format("'11:' || key")} AS u FROM u),
q AS (SELECT *, (row_number() OVER (PARTITION BY g ORDER BY u, key) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY g) AS f,
        row_number() OVER (PARTITION BY g ORDER BY u, key) AS rk FROM r),
p AS (SELECT *, row_number() OVER (ORDER BY f, g, rk) - 1 AS pos, count(*) OVER () AS n FROM q),
z AS (SELECT *, pos * 8 // n AS sh FROM p)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, sh::INT AS shard,
       (pos - (sh * n + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard FROM z
"""

# the join of every pair that shares a shingle, for another shingle length and threshold
_SIMILAR = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS sh FROM d),
x AS (SELECT rid, doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
p AS (SELECT a.rid AS r, b.rid AS q, any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, count(*) AS common,
        any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.h = b.h AND a.rid <> b.rid GROUP BY a.rid, b.rid),
e AS (SELECT DISTINCT a, b FROM p WHERE 100 * common >= 90 * (na + nb - common)),
reach AS (SELECT doc_id AS id, doc_id AS m FROM s UNION SELECT e.b, reach.m FROM reach JOIN e ON e.a = reach.id),
c AS (SELECT id, min(m) AS component_id FROM reach GROUP BY id)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, CASE WHEN len(sh) = 0 THEN doc_id ELSE component_id END AS component_id
FROM s LEFT JOIN c ON c.id = s.doc_id
"""

_FIM = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
x AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
s AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM s
"""

_SEARCH = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS total FROM t WHERE len(ws) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, len(ws)::BIGINT AS n, unnest(ws) AS term FROM t)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term),
s AS (SELECT item_id, rid, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term), g GROUP BY item_id, rid)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""

ORACLES: dict = {"op11_partenum_join": _SIMILAR, "op12_compressed_frames_fim": _FIM, "op13_mask_group_search": _SEARCH, "op4_lsh_forest": _NEAR, "op9_interleave_shards": _SHARDS, "op5_line_dedup": _LINES, "op1_pareto_mix": _mix(), "op3_ball_tree_top_k": _TOP_K, "op7_quality_rules": _quality()}
