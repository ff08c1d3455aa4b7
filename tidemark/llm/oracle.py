r"""DuckDB twins of the queries that SQL can express, over the whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    length(coalesce(text, ''))::DOUBLE AS chars FROM documents),
k AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / (1::DOUBLE / (1::DOUBLE + abs(chars / greatest(size, 1) - 5::DOUBLE) / 5::DOUBLE)) AS key FROM d),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, (3 * source_size)::DOUBLE AS cap FROM t),
o AS (
  SELECT *, row_number() OVER by_cap AS pos,
    (sum(source_size) OVER ()::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / (sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w WINDOW by_cap AS (ORDER BY cap / w, source NULLS LAST)),
f AS (SELECT min(pos) AS first, arg_min(level, pos) AS level FROM o WHERE cap > level * w),
g AS (SELECT source, source_size, CASE WHEN o.pos >= f.first THEN least(cap, f.level * w) ELSE cap END AS target FROM o, f),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9::DOUBLE)::BIGINT ELSE 0 END AS epochs FROM g),
c AS (
  SELECT k.*, e.source_size, e.target, e.epochs, greatest(0::DOUBLE, e.target - e.epochs * e.source_size) AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING)::DOUBLE AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target, epochs,
  (epochs * size + CASE WHEN upto - size / 2::DOUBLE <= rest THEN size ELSE 0 END)::BIGINT AS taken FROM c
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u AS a JOIN u AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN m ON m.a = n.doc_id
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (
  SELECT item_id, least(13, len(w)) AS k, unnest(list_transform(range(1, greatest(1, len(w) - 12) + 1), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM b WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM q),
p AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k),
h AS (SELECT p.doc_id, p.i, p.k, q.item_id FROM p JOIN q ON q.k = p.k AND q.g = array_to_string(p.w[p.i:p.i + p.k - 1], ' ')),
x AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY 1),
y AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN m ON m.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
q AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, d, array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(d, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest
  FROM p),
m AS (SELECT d, max(page_id) AS top FROM q GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM q JOIN m USING (d)
"""

SEARCH = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM b GROUP BY 1, 2),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
u AS (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM u GROUP BY 1, 2, 3),
f AS (SELECT term, count(*) AS df FROM t GROUP BY 1),
v AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, s),
m AS (SELECT doc_id, term, tf, 25 + (75 * n * n_docs) // n_terms AS m FROM t, s),
x AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN v USING (term) JOIN m USING (term) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1),
x AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    concat(CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
      CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN first < doc_id THEN 'E' END) AS fails
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM x GROUP BY 1, 2),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f AS a, f AS b, f AS c, f AS d, f AS e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
p AS (SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS here, substr(filter_order, 1, step - 1) AS earlier FROM s),
y AS (
  SELECT *, contains(fails, here) AS failing, length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM c, p),
z AS (
  SELECT part, filter_order, step, any_value(here) AS here,
    coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (failing AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failing AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = here), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (failing AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (failing AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM y GROUP BY 1, 2, 3)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, here))::BIGINT AS shapley
FROM z
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": MIXING,
    "op3_ngram_join": NGRAM_JOIN,
    "op4_decontamination": DECONTAMINATION,
    "op6_embeddings": EMBEDDINGS,
    "op8_warc": WARC,
    "op11_search": SEARCH,
    "op12_filter_audit": FILTER_AUDIT,
}
