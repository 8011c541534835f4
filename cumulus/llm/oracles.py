"""DuckDB SQL for the queries of resampling, decontamination and the filter audit."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), "
          "lambda x: x <> '')")

# DuckDB has no crc32: its table of 256 numbers is computed, and folded over the bytes of
# every different word.
RESAMPLING = rf"""
WITH tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c
    FROM range(256) AS r(i))),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
dw AS (SELECT r, unnest(ws) AS w FROM d),
bw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
u AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
b AS (
  SELECT w, xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(
             range(0, len(h) // 2), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM u, tab),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM dw JOIN b USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM bw JOIN b USING (w) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000)
           / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
x AS (
  SELECT r, sum(gain)::BIGINT AS weight
  FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY r),
y AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN x USING (r)),
z AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place,
         10 * count(*) OVER () // 100 AS n
  FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n THEN place END AS rank
FROM y LEFT JOIN z USING (r)"""

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
i AS (
  SELECT item_id, ws, least(10, len(ws)) AS w
  FROM (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS ws FROM benchmark)
  WHERE len(ws) > 0),
iw AS (
  SELECT DISTINCT item_id, w, array_to_string(list_slice(ws, p, p + w - 1), ' ') AS g
  FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS p FROM i)),
dw AS (
  SELECT r, w, p, array_to_string(list_slice(ws, p, p + w - 1), ' ') AS g
  FROM (SELECT r, ws, w, unnest(range(1, len(ws) - w + 2)) AS p
        FROM d, (SELECT DISTINCT w FROM iw) WHERE len(ws) >= w)),
f AS (SELECT r, p, w, item_id FROM dw JOIN iw USING (w, g)),
h AS (
  SELECT r, count(*) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(p, p + w)) AS p FROM f) GROUP BY r),
o AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM f) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN o USING (r)"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         min(doc_id) OVER (PARTITION BY t) AS least
  FROM d),
l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM (
    SELECT part, doc_id, (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END)
        || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t)
            THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS mask
    FROM w) LEFT JOIN l USING (doc_id)
  GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
p AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
g AS (
  SELECT m.*, o, CASE WHEN contains(mask, o[1]) THEN 1 WHEN contains(mask, o[2]) THEN 2
                      WHEN contains(mask, o[3]) THEN 3 WHEN contains(mask, o[4]) THEN 4
                      WHEN contains(mask, o[5]) THEN 5 ELSE 6 END AS gone
  FROM m, p),
x AS (
  SELECT part, o, s, sum(CASE WHEN gone > s THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN gone = s THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone < s AND contains(mask, o[s]) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = o[s] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN gone = s THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN gone = s THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM g, range(1, 6) AS r(s) GROUP BY part, o, s)
SELECT part, o AS filter_order, s::INT AS step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, sum(removed) OVER (PARTITION BY part, o[s])::BIGINT AS shapley
FROM x"""
