"""Queries over the node tables of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnflow.operators import axes as A
from tarnflow.operators.graph import stored
from tarnflow.sources import markup

from .registry import Tables, query


def nodes(t: Tables, elements: bool = False):
    """Node tables of pages; of elements alone where no text is asked for."""
    all_nodes = markup.shred(t.pages, "page_id", "html")
    return stored(all_nodes.filter(A.test()).drop("value", "attributes") if elements else all_nodes)


_NODES = r"""h AS (SELECT page_id, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(<(?:script|style)>).*?(</(?:script|style)>)', '\1\2', 'gs') AS h FROM pages),
g AS (SELECT page_id, regexp_extract_all(h, '<(/?[a-zA-Z][a-zA-Z0-9]*)[^>]*>', 1) AS t FROM h),
s(page_id, i, t, o) AS (SELECT page_id, 0::BIGINT, t, []::STRUCT(n VARCHAR, i BIGINT)[] FROM g
  UNION ALL SELECT page_id, i + 1, t, CASE
    WHEN t[i + 1][1] = '/' THEN (CASE WHEN list_contains(list_transform(o, lambda x: x.n), t[i + 1][2:]) THEN o[:len(o) - list_position(list_reverse(list_transform(o, lambda x: x.n)), t[i + 1][2:])] ELSE o END)
    WHEN t[i + 1] IN ('meta', 'br') THEN o
    ELSE list_append(CASE WHEN t[i + 1] IN ('nav', 'ul', 'div', 'article', 'h1', 'p', 'footer') AND list_contains(list_transform(o, lambda x: x.n), 'p') THEN o[:list_position(list_transform(o, lambda x: x.n), 'p') - 1] ELSE o END,
      struct_pack(n := t[i + 1], i := i + 1)) END
  FROM s WHERE i < len(t)),
n AS (SELECT page_id, i, t[i] AS name, list_transform(CASE WHEN t[i] IN ('meta', 'br') THEN o ELSE o[:-2] END, lambda x: x.i) AS up FROM s WHERE i > 0 AND t[i][1] <> '/'),
c AS (SELECT * FROM n WHERE name = 'b'),
x AS (
  SELECT n.page_id, n.i, n.name, unnest([
    CASE WHEN list_contains(c.up, n.i) THEN 'ancestor' END, CASE WHEN list_contains(n.up, c.i) THEN 'descendant' END,
    CASE WHEN n.i > c.i AND NOT list_contains(n.up, c.i) THEN 'following' END, CASE WHEN n.i < c.i AND NOT list_contains(c.up, n.i) THEN 'preceding' END,
    CASE WHEN n.up[-1] = c.i THEN 'child' END, CASE WHEN c.up[-1] = n.i THEN 'parent' END, CASE WHEN n.i = c.i THEN 'self' END,
    CASE WHEN n.up[-1] = c.up[-1] AND n.i > c.i THEN 'following-sibling' END, CASE WHEN n.up[-1] = c.up[-1] AND n.i < c.i THEN 'preceding-sibling' END]) AS axis
  FROM n JOIN c USING (page_id))"""

_SHOWN = ("ancestor", "descendant", "following", "preceding", "child", "parent", "self", "following-sibling", "preceding-sibling")


@query("q_xpath_axes", f"WITH RECURSIVE {_NODES} SELECT page_id, axis, count(DISTINCT i) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM x WHERE axis IS NOT NULL GROUP BY ALL")
def xpath_axes(t):
    """Elements on each axis from a page's bold parts."""
    all_nodes = nodes(t, elements=True)
    every = A.on_axes(all_nodes, A.test("b"), _SHOWN)
    return every.groupBy(F.col("doc").alias("page_id"), "axis").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


@query(
    "q_xpath_path",
    """WITH a AS (SELECT page_id, string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>') AS ps FROM pages)
    SELECT page_id, replace(regexp_replace(regexp_replace(ps[4], '<[^>]*>', '', 'g'), '&amp;?', '&', 'g'), '&quot;', '"') AS text FROM a WHERE len(ps) > 3""",
)
def xpath_path(t):
    """//article/p[2]/following-sibling::p[1] and its text."""
    all_nodes = nodes(t)
    found = A.locate(all_nodes, [("descendant", "article"), ("child", "p", 2), ("following-sibling", "p", 1)])
    return A.string_values(all_nodes, found).select(F.col("doc").alias("page_id"), F.col("value").alias("text"))
