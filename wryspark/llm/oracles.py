"""DuckDB SQL for the queries that plain SQL can express on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_GROUPS = [f"CAST('0x' || substr(h, {10 * g + 1}, 10) AS BIGINT)" for g in range(4)]
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({v} >> {35 - 5 * i}) & 31) + 1 AS BIGINT), 1)"
                      for v in _GROUPS for i in range(8))

WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p),
d AS (SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM s)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM d"""

_WORDS = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
  FROM bw WHERE len(w) > 0)),
e AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM dw),
r AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM e),
ds AS (SELECT doc_id, i, n, array_to_string(list_slice(l, 1, n), ' ') AS s FROM r JOIN (SELECT DISTINCT n FROM bs) ON len(l) >= n),
m AS (SELECT doc_id, i, n, item_id FROM ds JOIN bs USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

#: Smallest node reachable over the pairs (a, b) of ``links``.
_REACH = """both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON x.a = r.b),
least_of AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)"""

VECTORS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id
  AND len(p.e) = len(q.e) WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
{_REACH},
n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(c, vec_id) AS component_id,
  coalesce(c, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least_of l ON l.a = vec_id"""

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOW}, '[\\x20\\x09-\\x0D]+'),
  lambda x: x <> '') AS w FROM documents),
e AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM w),
r AS (SELECT doc_id, n, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS l FROM e),
s AS (SELECT doc_id, array_to_string(l, ' ') AS s, count(*) AS k FROM r WHERE i <= greatest(1, n - 4) GROUP BY ALL),
z AS (SELECT doc_id, sum(k) AS z FROM s GROUP BY doc_id),
c AS (SELECT p.doc_id AS a, q.doc_id AS b, sum(least(p.k, q.k)) AS common FROM s p JOIN s q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE common >= 0.8 * (x.z + y.z - common) - 1e-9),
{_REACH}
SELECT doc_id, coalesce(c, doc_id) AS class_id, coalesce(c, doc_id) = doc_id AS kept FROM documents LEFT JOIN least_of ON a = doc_id"""

_ROUNDS, _ENTRIES, _PARTS = 4, 256, 4


def _vector_codes() -> str:
    """The rounds of k-means unrolled, one table each."""
    steps = [f"""k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * len(v) // {_PARTS} + 1, (p + 1) * len(v) // {_PARTS}) AS x
  FROM k, range({_PARTS}) r(p)),
b0 AS MATERIALIZED (SELECT p, e, x AS y FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) USING (vec_id)
  WHERE e < {_ENTRIES})"""]
    near = """n{r} AS MATERIALIZED (SELECT vec_id, label, p, x, m % {n} AS e, m // {n} AS d FROM (SELECT vec_id, label, x.p, any_value(x) AS x,
  min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y) AS BIGINT) * {n} + e) AS m
  FROM x JOIN b{r} b ON b.p = x.p GROUP BY ALL))"""
    for r in range(_ROUNDS):
        steps += [near.format(r=r, n=_ENTRIES), f"""m{r} AS MATERIALIZED (SELECT p, e, list(CAST(q AS DOUBLE) ORDER BY i) AS y FROM (
  SELECT p, e, i, (s - ((s % c) + c) % c) // c AS q FROM (SELECT p, e, i, sum(CAST(v AS BIGINT)) AS s, count(*) AS c FROM (
    SELECT p, e, unnest(x) AS v, unnest(generate_series(1, len(x))) AS i FROM n{r}) GROUP BY ALL)) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.y, b.y) AS y FROM b{r} b LEFT JOIN m{r} m USING (p, e))"""]
    steps.append(near.format(r=_ROUNDS, n=_ENTRIES))
    return "WITH " + ",\n".join(steps) + f""",
c AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM n{_ROUNDS} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS h
  FROM b{_ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM c, h"""


VECTOR_CODES = _vector_codes()


def _crc32(number: str) -> str:
    """crc32 of a whole number's decimal digits, a bit at a time."""
    bit = "CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, d), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda k, z: {bit})"
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, d: {byte}), 4294967295)"


# A run of at least four periods and six words holds equal words three in a
# row, a period apart; stretches of such places are the runs.
REPEATED_RUNS = f"""WITH w0 AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  {_crc32('doc_id')} AS h FROM documents),
w1 AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % len(w) AS a,
  1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM w0),
t AS MATERIALIZED (SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM w1, unnest(range(n)) u(i)),
g AS MATERIALIZED (SELECT * FROM (SELECT doc_id, n, i, hash(word, lead(word, 1) OVER d, lead(word, 2) OVER d) AS s FROM t
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)) WHERE i + 2 < n),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.s = y.s AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q + 2 AS length FROM (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM e) GROUP BY doc_id, q, grp),
r AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
f AS (SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(start := start, length := length, period := period), (length, -start, -period)) AS top,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(top.start AS BIGINT) AS start, CAST(top.length AS BIGINT) AS length,
  CAST(top.period AS BIGINT) AS period, CAST(1000 * top.length // top.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN f USING (doc_id) LEFT JOIN kept USING (doc_id)"""

CONTENT_SORT = """WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size, row_number() OVER w = 1 AS kept,
  sha256(s) AS text_sha256 FROM d WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id NULLS LAST)"""

ORACLES = {"op2_warc_normaliser": WARC, "op4_winnowing": DECONTAMINATION, "op6_cap_filters": VECTORS,
           "op8_dart_minhash": NEAR_DUPLICATES, "op11_grid_cells": VECTOR_CODES, "op12_dyadic_squares": REPEATED_RUNS,
           "op13_content_sort": CONTENT_SORT}
