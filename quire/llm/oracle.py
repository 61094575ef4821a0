"""DuckDB SQL of the operators whose rows are fixed by their definition: repeated
50-byte strings (op1) and the Jaccard join (op9). Both compare everything with
everything that shares a string or a shingle, for tables that one process holds."""

from __future__ import annotations

#: Texts as hex, so that bytes can be cut; cut into segments of 1,000 starts
#: first, so that no string is cut out of a long one.
SUFFIX_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents),
n AS (SELECT *, length(h) // 2 AS n FROM d),
seg AS (
  SELECT r, place, b, least(1000, n - 49 - b) AS m, substr(h, 2 * b + 1, 2098) AS part
  FROM (SELECT *, unnest(range(0, n - 49, 1000)) AS b FROM n WHERE n >= 50)),
s AS (
  SELECT r, place, b + j AS p, unhex(substr(part, 2 * j + 1, 100)) AS str
  FROM (SELECT *, unnest(range(0, m)) AS j FROM seg)),
least_place AS (SELECT str, min(place) AS lowest FROM s GROUP BY str HAVING min(place) < max(place)),
hit AS (SELECT s.r, s.p FROM s JOIN least_place l ON s.str = l.str WHERE s.place > l.lowest),
opened AS (
  SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens FROM hit),
island AS (SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS k FROM opened),
span AS (SELECT r, min(p) AS lo, max(p) + 50 AS hi FROM island GROUP BY r, k),
gap AS (SELECT r, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY r ORDER BY lo) AS prev FROM span),
cut AS (
  SELECT g.r, count(*) AS n_spans, sum(g.hi - g.lo) AS n_removed, max(g.hi) AS last_hi,
         string_agg(substr(d.h, 2 * g.prev + 1, 2 * (g.lo - g.prev)), '' ORDER BY g.lo) AS kept
  FROM gap g JOIN d ON g.r = d.r GROUP BY g.r)
SELECT n.doc_id, n.n::BIGINT AS n_bytes, coalesce(c.n_removed, 0)::BIGINT AS n_removed,
       coalesce(c.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN c.r IS NULL THEN n.h ELSE c.kept || substr(n.h, 2 * c.last_hi + 1) END)) AS kept_sha256
FROM n LEFT JOIN cut c ON n.r = c.r"""

#: Equal sets are compared once; links between different sets are the pairs
#: that share a shingle and reach 0.8; classes by reachability over links.
JACCARD_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(
           CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS sh
  FROM d),
named AS (SELECT r, doc_id, sh, md5(array_to_string(sh, chr(10))) AS rid, len(sh)::BIGINT AS n FROM sets),
rep AS (
  SELECT rid, any_value(n) AS n, any_value(sh) AS sh, count(*) AS copies, min(doc_id) AS first_id
  FROM named WHERE n > 0 GROUP BY rid),
sh AS (SELECT rid, n, unnest(sh) AS x FROM rep),
shared AS (
  SELECT a.rid AS a, b.rid AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM sh a JOIN sh b ON a.x = b.x AND a.rid <> b.rid AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT a, b FROM shared WHERE 5 * common >= 4 * (na + nb - common)),
reach(a, b) AS (
  SELECT rid, rid FROM rep
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT reach.a AS rid, min(rep.first_id) AS class_id FROM reach JOIN rep ON reach.b = rep.rid GROUP BY reach.a),
links AS (SELECT link.a AS rid, sum(rep.copies) AS links FROM link JOIN rep ON link.b = rep.rid GROUP BY link.a)
SELECT named.doc_id, coalesce(class.class_id, named.doc_id) AS class_id,
       (coalesce(rep.copies - 1, 0) + coalesce(links.links, 0))::BIGINT AS n_links, named.n AS n_shingles
FROM named LEFT JOIN rep ON named.rid = rep.rid AND named.n > 0
LEFT JOIN class ON rep.rid = class.rid LEFT JOIN links ON rep.rid = links.rid"""
