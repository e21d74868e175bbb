"""DuckDB twins of the numbered operators that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _set_links(k: int, columns: str) -> str:
    """Distinct shingles of k words, links by exact Jaccard similarity, components by reachability."""
    text = _LOWER.format("coalesce(text, '')")
    return rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {k} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) END AS sh
  FROM w),
t AS MATERIALIZED (SELECT rid, len(sh) AS n, unnest(sh) AS g FROM s),
links AS MATERIALIZED (
  SELECT a.rid AS x, b.rid AS y FROM t a JOIN t b ON a.g = b.g AND a.rid < b.rid GROUP BY a.rid, b.rid, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT rid, rid AS other FROM s UNION SELECT r.rid, e.y FROM reach r JOIN edges e ON e.x = r.other),
named AS (SELECT r.rid, min(o.doc_id) AS component_id FROM reach r JOIN s o ON o.rid = r.other GROUP BY r.rid)
SELECT {columns} FROM s JOIN named USING (rid)"""


SQL = {
    "op10_near_duplicates": _set_links(
        4, "s.doc_id, len(s.sh) AS n_shingles, component_id, s.doc_id = component_id AS kept"),
    "op12_set_join": _set_links(5, "s.doc_id, len(s.sh) AS n_shingles, component_id"),
    "op13_search": rf"""
WITH d AS MATERIALIZED (
  SELECT rid, doc_id, term, count(*) AS tf FROM (
    SELECT row_number() OVER () AS rid, doc_id,
      unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
  GROUP BY rid, doc_id, term),
lens AS (SELECT rid, sum(tf)::BIGINT AS n FROM d GROUP BY rid),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lens),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM d, total GROUP BY term, big_n),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format('text')},
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l)))))::BIGINT AS score
  FROM items JOIN d USING (term) JOIN weights USING (term) JOIN lens USING (rid), total GROUP BY item_id, rid, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
