"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tabstrata.llm import host_rules as H

_WORD = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, source, text, regexp_extract_all(text, '{_WORD}') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM t
), pos AS (
  SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 3
), gram AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, w[p], w[p + 1], w[p + 2]) AS c FROM pos
), rep AS (
  SELECT rid, count(DISTINCT p + k) AS n_repeat_words
  FROM gram, (VALUES (0), (1), (2)) AS s(k) WHERE c > 1 GROUP BY rid
), f AS (
  SELECT w.rid, doc_id, source, len(w.w) AS n_words, coalesce(length(array_to_string(w.w, '')), 0) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), r AS (
  SELECT *, n_words < {H.MIN_WORDS} OR 100 * n_repeat_words > {H.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         n_words > 0 AND (n_symbols > {H.MAX_SYMBOLS} * n_words OR n_dup_lines > {H.MAX_DUP_LINES} * n_lines
           OR word_chars < {H.MIN_WORD} * n_words OR word_chars > {H.MAX_WORD} * n_words) AS soft_failed
  FROM f
), h AS (
  SELECT source AS host, count(*) AS n, sum((base_failed OR soft_failed)::BIGINT)::BIGINT AS failed FROM r GROUP BY source
), prior AS (
  SELECT m, least(greatest(m * (1 - m) / greatest(v, 1e-12) - 1, 1.0), 1e6) AS w
  FROM (SELECT sum(failed) / sum(n) AS m, var_pop(failed / n) AS v FROM h)
), verdict AS (
  SELECT host, rate - {H.SURE} * sqrt(rate * (1 - rate) / (n + w + 1)) > {H.EXCESS} * m AS host_rejected
  FROM (SELECT *, (failed + m * w) / (n + w) AS rate FROM h, prior)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (soft_failed AND host_rejected) AS kept
FROM r JOIN verdict ON r.source IS NOT DISTINCT FROM verdict.host
"""

OP3 = r"""
WITH l AS (
  SELECT rid, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), often AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(often.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (often.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often USING (key) GROUP BY rid
"""

OP5 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), bits AS (
  SELECT sha, any_value(payload_bytes) AS n, max(page_id) AS response,
         string_agg(list_extract(['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'],
                                 position(substr(sha, k::INT, 1) IN '0123456789abcdef')), '' ORDER BY k) AS b
  FROM (SELECT DISTINCT ON (sha) sha, payload_bytes, max(page_id) OVER (PARTITION BY sha) AS page_id FROM p), range(1, 41) AS r(k)
  GROUP BY sha
), digest AS (
  SELECT sha, any_value(response) AS response,
         string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(b, (5 * j + 1)::INT, 1)::INT + 8 * substr(b, (5 * j + 2)::INT, 1)::INT
                           + 4 * substr(b, (5 * j + 3)::INT, 1)::INT + 2 * substr(b, (5 * j + 4)::INT, 1)::INT + substr(b, (5 * j + 5)::INT, 1)::INT, 1), '' ORDER BY j) AS payload_digest
  FROM bits, range(0, 32) AS q(j) GROUP BY sha
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM p JOIN digest USING (sha)
"""

OP12 = rf"""
WITH c(i, c) AS (  -- crc32 of a byte at a time
  SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FROM range(256) AS r(i)
), byte AS (SELECT list(c ORDER BY i) AS c FROM c
), t AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT) AS codes
  FROM documents
), h AS (
  SELECT t.*, len(w) AS n, xor(list_reduce(list_concat([4294967295::BIGINT], codes), lambda x, y: xor(byte.c[(xor(x, y) & 255) + 1], x >> 8)), 4294967295) AS h FROM t, byte
), tail AS (
  SELECT rid, doc_id, w, n, CASE WHEN n > 0 AND h % 10 = 0 THEN (h // 10) % n END AS a, h // 10 AS g FROM h
), made AS (
  SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
           list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i + 1 ELSE 1 + a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
  FROM tail
), word AS (
  SELECT rid, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM made
), pair AS (
  SELECT a.rid, a.i, b.i - a.i AS q FROM word a JOIN word b ON a.rid = b.rid AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), island AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM pair) GROUP BY rid, q, k HAVING count(*) + q >= greatest(6, 4 * q)
), run AS (
  SELECT rid, start, length, min(q) AS period FROM island GROUP BY ALL
), gone AS (
  SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS s FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid
), told AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s,
         list({{'l': length, 's': -start, 'q': -period}} ORDER BY length DESC, start, period)[1] AS best
  FROM run GROUP BY rid
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-best.s)::BIGINT AS start, best.l::BIGINT AS length, (-best.q)::BIGINT AS period,
       (1000 * best.l // -best.q)::BIGINT AS exponent_milli, sha256(coalesce(told.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM made LEFT JOIN told USING (rid) LEFT JOIN kept USING (rid)
"""

_FIELDS = ["doc_id", "source", "lang", "n_chars"]
_LEAF = "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END" for c in [*_FIELDS, "{text}"]) + ")"
#: Levels that the SQL unrolls: trees of up to 16 ** 6 leaves.
_LEVELS = range(6)


def _up(name: str) -> str:
    """Levels of the trees (tree, i, n, d) of table name0, each node with the digests beside it."""
    return "".join(f""", {name}{k + 1} AS (
  SELECT tree, i // 16 AS i, any_value((n + 15) // 16) AS n, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY tree, i // 16
), {name}p{k} AS (
  SELECT x.tree, x.i, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS before, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS after, any_value(x.n) AS n
  FROM {name}{k} x JOIN {name}{k} y ON x.tree = y.tree AND x.i // 16 = y.i // 16 GROUP BY x.tree, x.i
)""" for k in _LEVELS)


def _fold() -> tuple[str, str]:
    """Joins to the digests beside each level's node, and all of them in a row."""
    joins, beside = "", []
    for name, tree, at in (("s", "o.src", "o.i"), ("t", "0", "o.src")):
        for k in _LEVELS:
            joins += f" JOIN {name}p{k} ON {name}p{k}.tree = {tree} AND {name}p{k}.i = {at} // {16 ** k}"
            beside.append(f"{name}p{k}.before || {name}p{k}.after")
    return joins, " || ".join(beside)


def _op13() -> str:
    joins, beside = _fold()
    steps, last = "", "opened"
    for k, name in enumerate([f"{x}p{j}" for x in "st" for j in _LEVELS]):
        steps += f""", f{k} AS (SELECT * REPLACE (CASE WHEN {name}_n = 1 THEN given ELSE sha256({name}_b || given || {name}_a) END AS given) FROM {last})"""
        last = f"f{k}"
    named = ", ".join(f"{x}p{j}.before AS {x}p{j}_b, {x}p{j}.after AS {x}p{j}_a, {x}p{j}.n AS {x}p{j}_n" for x in "st" for j in _LEVELS)
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH c(i, c) AS (
  SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FROM range(256) AS r(i)
), byte AS (SELECT list(c ORDER BY i) AS c FROM c
), t AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src, {_LEAF.replace("{text}", "text")} AS leaf, {_LEAF.replace("{text}", lowered)} AS changed,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda x, y: xor(byte.c[(xor(x, y) & 255) + 1], x >> 8)), 4294967295) AS h
  FROM documents, byte
), o AS (
  SELECT doc_id, src, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, CASE WHEN h % 5 = 0 THEN changed ELSE leaf END AS given, count(*) OVER (PARTITION BY src) AS n FROM t
), s0 AS (SELECT src AS tree, i, n, leaf AS d FROM o){_up("s")}, t0 AS (
  SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, d FROM s{len(_LEVELS)}
){_up("t")}, opened AS (
  SELECT o.doc_id, o.leaf, sub.d AS subroot, root.d AS root, o.given, sha256({beside}) AS proof_sha256, {named}
  FROM o JOIN s{len(_LEVELS)} sub ON sub.tree = o.src JOIN t{len(_LEVELS)} root ON true{joins}
){steps}
SELECT doc_id, leaf, subroot, root, proof_sha256, given AS folded_root, given = root AS verified FROM {last}
"""


ORACLE_SQL = {"op5_warc": OP5, "op3_line_dedup": OP3, "op8_host_rules": OP8, "op12_periodic_runs": OP12, "op13_merkle_manifest": _op13()}
