"""SQL that restates the registered queries from their contracts, for a check by another engine."""

# Windows as hex; a run of removed bytes ends where the next window starts beyond it.
OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT r, doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS k
      FROM (SELECT r, doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM d)),
f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
hit AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q
        FROM w JOIN f USING (k) WHERE m < doc_id),
isl AS (SELECT r, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS g FROM hit),
spans AS (SELECT r, min(p) AS s, max(p) + 50 AS e FROM isl GROUP BY r, g),
gaps AS (SELECT r, s, lag(e, 1, 0) OVER (PARTITION BY r ORDER BY s) AS prev FROM spans),
cut AS (SELECT r, count(*) AS n, sum(e - s) AS removed, max(e) AS last FROM spans GROUP BY r),
kept AS (SELECT g.r, string_agg(substr(d.h, 2 * g.prev + 1, 2 * (g.s - g.prev)), '' ORDER BY g.s) AS k
         FROM gaps g JOIN d USING (r) GROUP BY g.r)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept.k || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)
"""

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format('text')} AS w FROM documents),
s AS (SELECT r, p, hash(array_to_string(w[p:p + 34], ' ')) AS k
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 33, 1))) AS p FROM d)),
f AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM s JOIN f USING (k)),
one AS (SELECT r, i, word FROM (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS k, count(*) AS n FROM one ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Equal sets are paired once each with their smallest document.
OP7_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + 4], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 3, 2) END)) AS p FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT DISTINCT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, link.b FROM reach JOIN link ON reach.y = link.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""

LATIN_WORDS = "regexp_extract_all(" + LOWER.format("coalesce({0}, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {LATIN_WORDS.format('text')} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {LATIN_WORDS.format('text')} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT r, p, size, array_to_string(w[p:p + size - 1], ' ') AS k
       FROM (SELECT r, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) AS p
             FROM d, (SELECT DISTINCT size FROM iw) s)),
hit AS (SELECT r, p, dw.size, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.size = iw.size),
words AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + size)) AS x FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

# Sums in the order of the components, as doubles.
OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT r, vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS m FROM v
      WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
        list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) / (q.m * c.m) AS score
      FROM n q JOIN n c ON q.vec_id % 50 = 0 AND c.r <> q.r AND len(c.e) = len(q.e))
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM p) WHERE k <= 5
"""

# Every row of a part, for every order and step.
OP13_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, {WORDS.format('text')} AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
        100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
        first IS NOT NULL AND (w.doc_id IS NULL OR w.doc_id > first) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
m AS (SELECT part, (a::INT) + 2 * (b::INT) + 4 * (c::INT) + 8 * (d::INT) + 16 * (e::INT) AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
      FROM f GROUP BY ALL),
i AS (SELECT unnest(range(5)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x + 1, 1)), '') AS filter_order, step,
            CAST(power(2, o[step]) AS INT) AS bit, CAST(coalesce(list_sum(list_transform(o[1:step - 1], lambda x: power(2, x))), 0) AS INT) AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step)),
s AS (SELECT part, filter_order, step, bit, n, good, toxic, mask, mask & bit <> 0 AS fails, mask & earlier <> 0 AS gone FROM m, steps),
one AS (SELECT part, filter_order, step, any_value(bit) AS bit,
  coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
  coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
  coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
  FROM s GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM one
"""
