"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP4 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_SIZE} AS size, coalesce('0' || source, '1') AS src,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle_key
  FROM documents),
s AS (
  SELECT src, sum(size) AS source_size,
         CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END :: DOUBLE AS weight
  FROM d GROUP BY src),
-- the excess over a full source goes round again until no target is above twice its source
rounds AS (
  SELECT 0 AS r, src, source_size, weight, CAST(0 AS DOUBLE) AS target, false AS done,
         1.5 * (SELECT sum(source_size) FROM s) :: DOUBLE AS spare FROM s
  UNION ALL
  SELECT r + 1, src, source_size, weight, least(2.0 * source_size, want) AS target, done OR want >= 2.0 * source_size AS done,
         sum(greatest(want - 2.0 * source_size, 0.0)) OVER () AS spare
  FROM (SELECT *, target + CASE WHEN done THEN 0.0 ELSE spare * weight / sum(CASE WHEN done THEN 0.0 ELSE weight END) OVER () END AS want
        FROM rounds) WHERE spare > 1e-9 AND r < 100),
t AS (
  SELECT src, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // CAST(source_size AS BIGINT) ELSE 0 END AS passes,
         CAST(round(target) AS BIGINT) AS words
  FROM rounds WHERE r = (SELECT max(r) FROM rounds)),
t2 AS (SELECT *, words - passes * CAST(source_size AS BIGINT) AS rest FROM t),
-- documents in permuted order; the rest of a target takes from the front
p AS (
  SELECT d.*, t2.source_size, t2.target, t2.passes, t2.rest, substr(shuffle_key, 1, 2) AS block, substr(shuffle_key, 1, 3) AS cell,
         coalesce(sum(size) OVER (PARTITION BY d.src ORDER BY shuffle_key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM d JOIN t2 USING (src)),
x AS (SELECT *, greatest(0, least(size, rest - pos)) AS part,
             min(pos) OVER (PARTITION BY src, cell) AS cell_first FROM p),
b AS (SELECT src, block, max(passes) + max(CAST(cell_first < rest AS INT)) AS n FROM x GROUP BY src, block),
tok AS (SELECT src, block, unnest(range(1, n + 1)) AS pass FROM b),
l0 AS (SELECT *, (4 * (row_number() OVER (ORDER BY md5('mix-tree-0|' || src || '|' || pass || '|' || block), src, pass, block) - 1)) // count(*) OVER () AS node FROM tok),
l1 AS (SELECT * REPLACE (4 * node + (4 * (row_number() OVER (PARTITION BY node ORDER BY md5('mix-tree-1|' || src || '|' || pass || '|' || block), src, pass, block) - 1)) // count(*) OVER (PARTITION BY node) AS node) FROM l0),
l2 AS (SELECT * REPLACE (4 * node + (4 * (row_number() OVER (PARTITION BY node ORDER BY md5('mix-tree-2|' || src || '|' || pass || '|' || block), src, pass, block) - 1)) // count(*) OVER (PARTITION BY node) AS node) FROM l1),
slots AS (SELECT src, node, row_number() OVER (PARTITION BY src ORDER BY node) AS n FROM l2),
drawn AS (SELECT src, pass, block, row_number() OVER (PARTITION BY src ORDER BY md5('mix-draw|' || src || '|' || pass || '|' || block), pass, block) AS n FROM tok),
dealt AS (SELECT drawn.src, drawn.block, list(node ORDER BY pass) AS shards FROM drawn JOIN slots USING (src, n) GROUP BY drawn.src, drawn.block)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(passes * size + part AS BIGINT) AS taken,
       CASE WHEN size > 0 THEN coalesce(array_to_string(shards[1 : passes + CAST(part > 0 AS INT)], ','), '') ELSE '' END AS shards,
       shuffle_key
FROM x LEFT JOIN dealt USING (src, block)
"""

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT item, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram FROM bw),
dw AS (SELECT row, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
       FROM (SELECT row, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT row, dw.n, i, item FROM dw JOIN g USING (n, gram)),
hit AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT row, i, n FROM h)) GROUP BY row),
it AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM h) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN it USING (row)
"""


def _centroids_sql(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """The rounds written out one after the other."""
    out = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
x AS MATERIALIZED (SELECT row, unnest(range(1, {dim + 1})) AS i, unnest(q) AS a FROM v),
c0 AS MATERIALIZED (
  SELECT n - 1 AS cluster, q FROM (SELECT q, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), q) AS n FROM v WHERE vec_id IS NOT NULL)
  WHERE n <= {k})"""]
    for r in range(rounds + 1):
        out.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, cluster, distance FROM (
    SELECT row, cluster, distance, row_number() OVER (PARTITION BY row ORDER BY distance, cluster) AS n FROM (
      SELECT row, cluster, CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
      FROM v, c{r} AS c)) WHERE n = 1)""")
        if r < rounds:
            # s - ((s mod n + n) mod n) is a multiple of n: the division is exact and floors
            out.append(f"""
m{r} AS (SELECT cluster, i, CAST(sum(a) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN x USING (row) GROUP BY cluster, i),
n{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM m{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(n.q, c.q) AS q FROM c{r} AS c LEFT JOIN n{r} AS n USING (cluster))""")
    return "WITH " + ",".join(out) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN c{rounds} AS c USING (cluster)
"""


OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
least_id AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * len(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS dd, coalesce(d.doc_id > first_id, false) AS e
  FROM d JOIN least_id USING (t) LEFT JOIN lab ON lab.doc_id = d.doc_id),
cell AS (
  SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                      CASE WHEN dd THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT l1.x || l2.x || l3.x || l4.x || l5.x AS filter_order FROM l l1, l l2, l l3, l l4, l l5
  WHERE len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
g AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, x, n, n_good, n_toxic, contains(fails, x) AS hit, fails = x AS alone,
         before <> '' AND fails <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone FROM cell, s),
r AS (
  SELECT part, filter_order, step, x,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n_good) FILTER (NOT gone AND hit), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n_toxic) FILTER (NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
  FROM g GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r
"""

# texts as hexadecimal digits, two a byte
OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- blocks of 799 bytes hold 400 strings each
k4 AS (SELECT row, b, substr(h, 800 * b + 1, 1598) AS block FROM (SELECT row, h, unnest(range(0, (len(h) // 2 - 400) // 400 + 1)) AS b FROM d WHERE len(h) >= 800)),
w AS (SELECT row, 400 * b + j AS i, md5(substr(block, 2 * j + 1, 800)) AS g FROM (SELECT row, b, block, unnest(range(0, len(block) // 2 - 399)) AS j FROM k4)),
rep AS (SELECT row, i FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING count(*) > 1)),
b AS (SELECT row, i, CASE WHEN i <= lag(i) OVER (PARTITION BY row ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM rep),
n AS (SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS span FROM b),
s AS (SELECT row, span, min(i) AS s, max(i) + 400 AS e FROM n GROUP BY row, span),
k AS (SELECT row, s, e, lag(e, 1, 0) OVER (PARTITION BY row ORDER BY s) AS before FROM s),
r AS (SELECT row, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last_end,
             string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS kept FROM k JOIN d USING (row) GROUP BY row)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_end, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN r USING (row)
"""

SQL = {"op4_mixing_tree": OP4, "op7_decontamination": OP7, "op11_centroid_expressions": _centroids_sql(), "op12_filter_orders": OP12,
       "op13_suffix_dedup": OP13}
