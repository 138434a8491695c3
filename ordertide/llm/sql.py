"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_TOKENS = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_WORDS}) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWERED}, {_WORDS}) AS w FROM benchmark),
iw AS (
  SELECT item, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS pos, w FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, size, array_to_string(w[pos:pos + size - 1], ' ') AS win FROM iw),
sizes AS (SELECT DISTINCT size FROM windows),
dw AS (
  SELECT doc_id, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, size, pos, item FROM dw JOIN windows USING (size, win)),
covered AS (
  SELECT doc_id, COUNT(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS place FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_TOKENS}) AS w FROM documents),
win AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50)),
first AS (SELECT h, MIN(doc_id) AS first_id FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS place
  FROM win JOIN first USING (h) WHERE first_id < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS place FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY place) AS kept, COUNT(*) AS n_kept
  FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_TOKENS}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[pos:pos + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS common FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 75 * (na.n + nb.n - common)),
ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
least AS (SELECT a, MIN(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id"""


def _strength(children: str) -> str:
    spread = "(SUM(bad * bad / n) - SUM(bad) * SUM(bad) / SUM(n))"
    chance = "((SUM(bad) / SUM(n)) * (1 - SUM(bad) / SUM(n)))"
    between = f"(({spread} - (COUNT(*) - 1) * {chance}) / (SUM(n) - SUM(n * n) / SUM(n)))"
    return f"""(SELECT coalesce(CASE WHEN SUM(n) * SUM(n) > SUM(n * n) AND {chance} > 0 THEN
      CASE WHEN {between} > 0 THEN greatest(1.0, least(1000.0, {chance} / {between} - 1)) END END, 1000.0) AS s
    FROM {children} WHERE n > 0)"""


def hosts(rules: list[tuple[str, str]], z: float, threshold: float) -> str:
    cases = []
    for verdict, rule in sorted(rules, key=lambda x: -len(x[1])):
        own, slash, start = rule.partition("/")
        cases.append((f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{slash + start}')", rule, verdict))
    name = " ".join(f"WHEN {test} THEN '{rule}'" for test, rule, _ in cases)
    verdict = " ".join(f"WHEN rule = '{rule}' THEN '{made}'" for _, rule, made in cases)
    return f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE {name} END AS rule FROM u),
j AS (SELECT *, CASE {verdict} END AS ruled FROM r),
h AS (
  SELECT host, regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain,
         list_extract(string_split(host, '.'), -1) AS suffix,
         CAST(COUNT(ruled) AS DOUBLE) AS n, CAST(COUNT(*) FILTER (WHERE ruled = 'block') AS DOUBLE) AS bad
  FROM j GROUP BY host),
dm AS (SELECT domain, suffix, SUM(n) AS n, SUM(bad) AS bad FROM h GROUP BY domain, suffix),
sx AS (SELECT suffix, SUM(n) AS n, SUM(bad) AS bad FROM dm GROUP BY suffix),
rt AS (SELECT (SUM(bad) + 1) / (SUM(n) + 2) AS above FROM sx),
s1 AS {_strength("sx")}, s2 AS {_strength("dm")}, s3 AS {_strength("h")},
ps AS (SELECT suffix, (bad + s * above) / (n + s) AS above FROM sx, rt, s1),
pd AS (SELECT domain, (bad + s * above) / (n + s) AS above FROM dm JOIN ps USING (suffix), s2),
ph AS (SELECT host, (bad + s * above) / (n + s) AS mean, n + s AS total FROM h JOIN pd USING (domain), s3)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN mean - {z} * sqrt(mean * (1 - mean) / (total + 1)) > {threshold}
                       THEN 'block' ELSE 'allow' END) AS verdict
FROM j JOIN ph USING (host)"""


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


INTERACTIONS = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_TOKENS}) AS w
  FROM documents),
l AS (SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > MIN(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
g AS (SELECT *, contains(fails, filter) AS own, before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone FROM s, c),
r AS (
  SELECT part, filter_order, step, filter,
         SUM(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END) AS kept, SUM(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed,
         SUM(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant, SUM(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
         SUM(CASE WHEN own AND NOT gone THEN good ELSE 0 END) AS good_lost, SUM(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM g GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(SUM(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r"""

#: The 256 remainders of CRC-32, bit by bit, and the checksum of a text's bytes as ``crc``.
_CRC = """
bit(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tt FROM bit WHERE k = 8),
crcs AS (
  SELECT doc_id, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)),
                     lambda c, x: xor(c >> 8, tt[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, tab)"""


def _filled(begin: str, capacity: str) -> str:
    """The last group end that a shard from ``begin`` on holds."""
    return f"coalesce(list_max(list_filter(ends, lambda e: e <= {begin} + {capacity})), 0)"


SHARDS = f"""
WITH RECURSIVE {_CRC},
d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size FROM documents),
grp AS (SELECT t, MIN(doc_id) AS first, SUM(size) AS size FROM d GROUP BY t),
placed AS (SELECT t, first, CAST(SUM(size) OVER (ORDER BY first) AS BIGINT) AS e, CAST(size AS BIGINT) AS size FROM grp),
e AS (SELECT list(e ORDER BY e) AS ends, MAX(e) AS total FROM placed),
bs(lo, hi) AS (
  SELECT (total + 15) // 16 - 1, total FROM e
  UNION ALL
  SELECT CASE WHEN fits THEN lo ELSE m END, CASE WHEN fits THEN m ELSE hi END
  FROM (SELECT lo, hi, (lo + hi) // 2 AS m,
               list_reduce(range(16), lambda p, i: {_filled("p", "((lo + hi) // 2)")}, CAST(0 AS BIGINT)) >= total AS fits
        FROM bs, e WHERE hi - lo > 1)),
capacity AS (SELECT MIN(hi) AS c FROM bs),
cut(k, pos) AS (
  SELECT 0, CAST(0 AS BIGINT)
  UNION ALL SELECT k + 1, {_filled("pos", "c")} FROM cut, e, capacity WHERE k < 16),
cuts AS (SELECT list(DISTINCT pos) AS cuts FROM cut, e WHERE k > 0 AND pos < total),
s AS (
  SELECT doc_id, d.size, first, CAST(len(list_filter(coalesce(cuts, []), lambda c: c <= p.e - p.size)) AS INTEGER) AS shard
  FROM d JOIN placed p USING (t), cuts)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY first, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s JOIN crcs USING (doc_id)"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Codebooks by as many rounds, each spelled out."""
    steps = []
    for k in range(rounds + 1):
        distance = "list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x)"
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, label, part, p.x, MIN({{d: {distance}, e: b.entry}}) AS near FROM p JOIN b{k} b USING (part) GROUP BY vec_id, label, part, p.x)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
  SELECT part, entry, list(v ORDER BY i) AS x
  FROM (SELECT part, near.e AS entry, i, floor(SUM(x[i]) / COUNT(*)) AS v FROM a{k}, (SELECT unnest(range(1, len(x) + 1)) AS i FROM (SELECT x FROM p LIMIT 1)) GROUP BY ALL)
  GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry))""")
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, label, part, e[part * (len(e) // {parts}) + 1 : (part + 1) * (len(e) // {parts})] AS x
  FROM v, (SELECT unnest(range({parts})) AS part)),
b0 AS MATERIALIZED (
  SELECT part, entry, x FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < {entries}),
{",".join(steps)},
books AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM b{rounds})),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', near.e), '' ORDER BY part) AS code, CAST(SUM(near.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, books"""
