"""Queries over taxonomies, trees and features: the tree in which a document's
parent is half its number, and a user's events as features of a group."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnflow.functions import sequences as Q
from tarnflow.functions import text as X
from tarnflow.operators import features as G
from tarnflow.operators import structures as S
from tarnflow.operators import taxonomy as T

from .q_structure import _PAIRS, _UP, closure, intervals, next_pairs, tree
from .registry import ORACLES, query


@query(
    "q_common_ancestor",
    f"""WITH RECURSIVE {_UP}, {_PAIRS}, m AS (SELECT p.a, p.b, x.ancestor, x.distance + y.distance AS path FROM p JOIN up x ON x.node = p.a JOIN up y ON y.node = p.b AND y.ancestor = x.ancestor)
    SELECT a, b, ancestor, path FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY path, ancestor) AS r FROM m) WHERE r = 1""",
)
def common_ancestor(t):
    return T.common_ancestor(next_pairs(t), closure(t), "a", "b")


@query("q_lineage_build", f"WITH RECURSIVE {_UP} SELECT node, string_agg('n' || ancestor, '; ' ORDER BY distance DESC) AS lineage FROM up WHERE ancestor % 5 <> 0 GROUP BY node")
def lineage_build(t):
    nodes = t.documents.select("doc_id", F.when(F.col("doc_id") > 0, F.floor(F.col("doc_id") / 2)).alias("up"), F.concat(F.lit("n"), "doc_id").alias("name"), F.when(F.col("doc_id") % 5 == 0, "no rank").otherwise("rank").alias("rank"))
    return T.lineage(nodes, "doc_id", "up", "name", "rank")


@query("q_leaf_sets", f"WITH RECURSIVE {_UP}, lv AS (SELECT doc_id AS node FROM documents WHERE doc_id > 0 AND doc_id NOT IN (SELECT doc_id // 2 FROM documents WHERE doc_id > 0)) SELECT ancestor AS node, count(*) AS n, min(up.node) AS least, max(up.node) AS greatest FROM up JOIN lv ON lv.node = up.node GROUP BY ancestor")
def leaf_sets(t):
    from tarnflow.operators.graph import unlinked

    s = T.leaf_sets(closure(t), unlinked(tree(t), "child", "parent", True))
    return s.select("node", F.size("leaves").cast("long").alias("n"), F.array_min("leaves").alias("least"), F.array_max("leaves").alias("greatest"))


@query("q_tree_metrics", "SELECT count(*) AS nodes, count(*) FILTER (doc_id > 0 AND doc_id NOT IN (SELECT doc_id // 2 FROM documents WHERE doc_id > 0)) AS leaves, sum(CASE WHEN doc_id > 0 THEN doc_id % 7 ELSE 0 END) * 1.0 AS total_length FROM documents")
def tree_metrics(t):
    return T.tree_metrics(tree(t).withColumn("len", (F.col("child") % 7).cast("double")), "child", "parent", "len")


@query("q_lineage_nodes", "SELECT DISTINCT r_name AS path, r_name AS name, '' AS parent FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT r_name || '; ' || n_name, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def lineage_nodes(t):
    lin = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat_ws("; ", "r_name", "n_name").alias("lineage"))
    return T.from_lineages(lin, "lineage").select("path", "name", F.coalesce("parent", F.lit("")).alias("parent"))


_IV = "iv AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS s, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + CAST(floor(value * 60) AS BIGINT) AS e FROM events)"


@query("q_feature_aggregate", f"WITH {_IV} SELECT user_id, coalesce(min(s) FILTER (event_type = 'click'), min(s)) AS s, coalesce(max(e) FILTER (event_type = 'click'), max(e)) AS e, count(*) FILTER (event_type <> 'click') AS parts FROM iv GROUP BY user_id")
def feature_aggregate(t):
    f = intervals(t).withColumnRenamed("event_type", "method")
    return G.aggregate(f, ["user_id"], "s", "e", main="click").select("user_id", "s", "e", F.size("parts").cast("long").alias("parts"))


@query("q_database_offsets", "SELECT count(*) AS n, CAST(sum(length(left(p_name, 8)) + 1) AS BIGINT) AS total, 0 AS overlaps FROM part")
def database_offsets(t):
    return offsets(G.split_database(t.part.select("p_partkey", F.col("p_name").alias("seq")), "p_partkey", 8))


def offsets(d):
    return d.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("offset") + F.length("seq") + 1).alias("total"), (F.count(F.lit(1)) - F.count_distinct("offset")).cast("int").alias("overlaps"))


@query("q_database_offsets_all", ORACLES["q_database_offsets"].replace("left(p_name, 8)", "left(p_name, 64000)"))
def database_offsets_all(t):
    return offsets(G.split_database(t.part.select("p_partkey", F.col("p_name").alias("seq")), "p_partkey"))


@query("q_gc_model", "SELECT p_partkey, CAST(least(70, greatest(30, floor(100.0 * length(regexp_replace(upper(p_name), '[^GCAT]', '', 'g')) / length(p_name) + 0.5))) AS INTEGER) AS model FROM part")
def gc_model(t):
    share = 100.0 * F.length(F.regexp_replace(F.upper("p_name"), "[^GCAT]", "")) / F.length("p_name")
    return t.part.select("p_partkey", G.gc_model(share).alias("model"))


@query("q_ambiguous_runs", "SELECT p_partkey, count(*) AS runs, CAST(sum(length(m)) AS BIGINT) AS letters FROM (SELECT p_partkey, unnest(regexp_extract_all(upper(p_name), '[^AEIO]+')) AS m FROM part) WHERE length(m) >= 2 GROUP BY 1")
def ambiguous_runs(t):
    r = G.ambiguous_runs(t.part, "p_partkey", "p_name", 2, plain="AEIO")
    return r.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("runs"), F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("letters"))


@query("q_tag_edit", "SELECT p_partkey, 'kinase' AS product, p_type AS kind, 1 AS tags_left FROM part WHERE p_size > 25")
def tag_edit(t):
    tags = F.create_map(F.lit("product"), F.array("p_name"), F.lit("note"), F.array("p_brand"))
    p = t.part.filter("p_size > 25").withColumn("tags", G.with_tags(tags, {"product": "kinase"}, ("note",)))
    return p.select("p_partkey", F.col("tags")["product"][0].alias("product"), F.col("p_type").alias("kind"), F.size("tags").alias("tags_left"))


@query("q_pair_identity", "SELECT a.p_partkey, len(list_filter(range(1, least(length(a.p_name), length(b.p_name)) + 1), lambda i: a.p_name[i] = b.p_name[i] AND a.p_name[i] <> '-')) AS same FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def pair_identity(t):
    b = t.part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    return t.part.join(b, "p_partkey").select("p_partkey", Q.identity_counts(F.col("p_name"), F.col("other"))["same"].cast("long").alias("same"))


@query("q_percent_safe", "SELECT n_nationkey, round(CASE WHEN n_regionkey = 0 THEN 0 ELSE 100.0 * n_nationkey / n_regionkey END, 6) AS percent FROM nation")
def percent_safe(t):
    return t.nation.select("n_nationkey", F.round(X.safe_percent(F.col("n_nationkey"), F.col("n_regionkey")), 6).alias("percent"))


@query("q_assignment")
def assignment(t):
    few = t.lineitem.groupBy((F.col("l_orderkey") % 50).alias("block"), (F.col("l_suppkey") % 6).alias("r"), (F.col("l_partkey") % 8).alias("c")).agg(F.min("l_extendedprice").alias("cost"))
    return G.assignments(few, "block", "r", "c", "cost")


_LEAF = "doc_id % 3 + 6 AS a, n_chars % 4 + 2 AS d, (doc_id // 3) % 2 + 5 AS c, n_chars % 3 + 1 AS v, (n_chars // 3) % 2 + 4 AS t, doc_id % 5 // 2 AS m, (n_chars // 5) % 12 + 4 AS loop, doc_id % 4 = 0 AS four"


@query(
    "q_cloverleaf",
    f"""WITH l AS (SELECT doc_id, {_LEAF} FROM documents), n AS (SELECT *, 2 * (a + d + c + t) + CASE WHEN four THEN 0 ELSE 2 * v + loop + 2 END + 3 * loop + 8 AS n FROM l)
    SELECT doc_id, CASE WHEN four THEN 4 ELSE 5 END AS stems, CAST(m AS INT) AS mismatches, coalesce(reason, '') AS reason, reason IS NULL AS valid, a = 7 AND m < 2 AS acceptor FROM (SELECT *, CASE
      WHEN m > 1 THEN 'acceptor: ' || m || ' mismatches' WHEN a <> 7 THEN 'acceptor: length ' || a WHEN d < 3 THEN 'darm: length ' || d WHEN c <> 5 THEN 'anticodon: length ' || c
      WHEN NOT four AND v < 2 THEN 'variable: length ' || v WHEN t <> 5 THEN 'tstem: length ' || t WHEN n > CASE WHEN four THEN 80 ELSE 90 END THEN 'length ' || n END AS reason FROM n)""",
)
def cloverleaf(t):
    """Verdicts on structures whose arms' lengths come from documents' numbers."""
    i, n = F.col("doc_id"), F.col("n_chars")
    widths = {"a": i % 3 + 6, "d": n % 4 + 2, "c": F.floor(i / 3) % 2 + 5, "v": n % 3 + 1, "t": F.floor(n / 3) % 2 + 4, "m": F.floor(i % 5 / 2), "loop": F.floor(n / 5) % 12 + 4}
    docs = t.documents.select("doc_id", *[e.cast("int").alias(c) for c, e in widths.items()])
    many = lambda c, width: F.repeat(F.lit(c), F.col(width) if isinstance(width, str) else width)
    arm = lambda w: F.concat(many(">", w), many(".", "loop"), many("<", w))
    outer = lambda c, near, far: F.concat(many(c, near), many(".", "m"), many(c, far))
    rest = F.col("a") - 2 - F.col("m")
    inner = F.concat_ws("..", arm("d"), arm("c"), F.when(i % 4 != 0, arm("v")), arm("t"))
    whole = F.concat(outer(">", F.lit(2), rest), F.lit(".."), inner, F.lit("."), outer("<", rest, F.lit(2)), F.lit("."))
    made = S.validate(docs.select("doc_id", whole.alias("ss")), "ss")
    return made.select("doc_id", "stems", "mismatches", F.coalesce("reason", F.lit("")).alias("reason"), "valid", "acceptor")
