"""Queries of filters, look-ups, matrices, vectors and locations.  The SQL states
its constants itself; none are taken from the code's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnflow.functions import evidence as E
from tarnflow.functions import locations as O
from tarnflow.functions import sequences as Q
from tarnflow.functions import text as X
from tarnflow.functions import vectors as V
from tarnflow.operators import features as G
from tarnflow.operators import graph
from tarnflow.operators import hits as H
from tarnflow.operators import joins as J
from tarnflow.operators import matrices as M
from tarnflow.operators import populations as P
from tarnflow.operators import sets as S
from tarnflow.operators import windows as W

from .q_hits import HITS, SQL_BITS, accepted, by_bits, hits
from .q_text import _SEQ, sequences
from .registry import Tables, query

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_LINE = ", ".join(LINE)


# Filters.


@query("q_query_row", f"WITH q AS (SELECT l_orderkey, max(l_quantity) AS query_length, max(l_returnflag) AS query_flag FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) SELECT {_LINE}, query_length, query_flag FROM lineitem LEFT JOIN q USING (l_orderkey) WHERE l_linenumber <> 1")
def query_row(t):
    return H.with_query(t.lineitem, ["l_orderkey"], F.col("l_linenumber") == 1, {"l_quantity": "query_length", "l_returnflag": "query_flag"}).select(*LINE, "query_length", "query_flag")


@query("q_length_window", f"SELECT {_LINE}, abs(l_quantity - l_linenumber) > 10 AS no_most FROM lineitem WHERE abs(l_quantity - l_linenumber) > 5 AND abs(l_quantity - l_linenumber) < 40")
def length_window(t):
    a, z = F.col("l_linenumber"), F.col("l_quantity")
    return t.lineitem.filter(H.length_window(a, z, 5, 40)).select(*LINE, H.length_window(a, z, least=10).alias("no_most"))


@query("q_accepted_hits", f"SELECT {_LINE}, l_extendedprice >= 30000 AS by_predicate FROM lineitem WHERE l_tax <= 0.05 AND l_quantity >= 10")
def accepted_hits(t):
    ok = lambda **k: H.accepted_hit(F.col("l_tax"), F.col("l_quantity"), F.col("l_extendedprice"), **k)
    return t.lineitem.filter(ok(most_significance=0.05, least_score=10)).select(*LINE, ok(predicate=F.col("l_extendedprice") >= 30000).alias("by_predicate"))


@query("q_outside_taxon", "SELECT s_suppkey, s_nationkey || '.' || s_name AS id FROM supplier WHERE NOT starts_with(s_nationkey || '.' || s_name, '1.')")
def outside_taxon(t):
    s = t.supplier.select("s_suppkey", F.concat_ws(".", F.col("s_nationkey").cast("string"), "s_name").alias("id"))
    return s.filter(H.outside_taxon(F.col("id"), "1"))


@query("q_informative_rows", "SELECT p_partkey FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN 'NA' WHEN 3 THEN NULL ELSE p_name END AS d FROM part) WHERE d IS NOT NULL AND d NOT IN ('', 'N/A', 'NA')")
def informative_rows(t):
    k = F.col("p_size") % 5
    return t.part.withColumn("d", F.when(k == 0, "").when(k == 1, "N/A").when(k == 2, "NA").when(k == 4, F.col("p_name"))).filter(H.informative(F.col("d"))).select("p_partkey")


@query("q_plain_symbols", "SELECT p_partkey, s FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN left(p_brand, 3) || '_' || p_size ELSE p_brand || '_' END AS s FROM part) WHERE NOT regexp_matches(s, '[A-Za-z0-9_]+_[A-Za-z0-9_]+')")
def plain_symbols(t):
    symbol = F.when(F.col("p_size") % 2 == 0, F.concat_ws("_", F.substring("p_brand", 1, 3), F.col("p_size").cast("string"))).otherwise(F.concat("p_brand", F.lit("_")))
    return t.part.select("p_partkey", symbol.alias("s")).filter(H.plain_symbol(F.col("s")))


@query("q_pseudogenes", f"SELECT {_LINE}, 2 * l_quantity < 55 AND (100 * l_tax < 5 OR 200 * l_discount < 10) AS pseudo FROM lineitem")
def pseudogenes(t):
    return t.lineitem.select(*LINE, H.pseudogene(2 * F.col("l_quantity"), 100 * F.col("l_tax"), 200 * F.col("l_discount")).alias("pseudo"))


@query("q_plot_window", f"WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM hits WHERE pide >= 0.93 AND pide <= 0.97 AND qcov >= 0.2 AND qcov <= 0.8 AND scov >= 0.95")
def plot_window(t):
    ok = H.enabled(F.col("pide"), 0.93, 0.97) & H.enabled(F.col("qcov"), 0.2, 0.8) & H.enabled(F.col("scov"), 0.95)
    return hits(t).filter(ok).select(*LINE)


_TAGS = ["CDS", "gene", "tRNA", "rRNA", "misc_feature", "tmRNA", "ncRNA"]


@query("q_reported_tags", "SELECT event_id, tag FROM (SELECT event_id, ['CDS', 'gene', 'tRNA', 'rRNA', 'misc_feature', 'tmRNA', 'ncRNA'][1 + user_id % 7] AS tag FROM events) WHERE tag IN ('CDS', 'ncRNA', 'rRNA', 'tmRNA', 'tRNA')")
def reported_tags(t):
    tag = F.array(*[F.lit(x) for x in _TAGS])[(F.col("user_id") % 7).cast("int")]
    return t.events.select("event_id", tag.alias("tag")).filter(G.reported(F.col("tag")))


# Evidence and terms.

_CODES = "['IDA', 'IEA', 'ISS', 'XXX'][1 + p_size % 4]"


def code():
    return F.array(*[F.lit(x) for x in ("IDA", "IEA", "ISS", "XXX")])[(F.col("p_size") % 4).cast("int")]


@query("q_evidence_weight", f"SELECT p_partkey, CASE {_CODES} WHEN 'IDA' THEN 1.0 WHEN 'IEA' THEN 0.7 WHEN 'ISS' THEN 0.8 ELSE 0.5 END::DOUBLE AS weight FROM part")
def evidence_weight(t):
    return t.part.select("p_partkey", E.weight(code()).alias("weight"))


@query(
    "q_evidence_terms",
    f"""WITH c AS (SELECT p_partkey, [p_brand || '|' || 'IEA', p_type || '|' || {_CODES}, p_brand || '|TAS'] AS l FROM part)
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_transform(list_filter(l, lambda x: string_split(x, '|')[2] IN ('IDA', 'TAS', 'ISS') AND string_split(x, '|')[2] <> 'ISS'), lambda x: string_split(x, '|')[1]))), ';') AS chosen,
    array_to_string(list_sort(list_distinct(list_transform(l, lambda x: string_split(x, '|')[1]))), ';') AS every FROM c""",
)
def evidence_terms(t):
    cell = F.concat(F.lit("F|"), "p_brand", F.lit("|IEA,P|"), "p_type", F.lit("|"), code(), F.lit(",F|"), "p_brand", F.lit("|TAS,bad"))
    p = t.part.withColumn("cell", cell)
    return p.select("p_partkey", F.array_join(E.terms(F.col("cell"), ("IDA", "TAS", "ISS"), ("ISS",)), ";").alias("chosen"), F.array_join(E.terms(F.col("cell")), ";").alias("every"))


@query("q_clean_category", "SELECT p_partkey, p_brand AS category FROM part")
def clean_category(t):
    return t.part.select("p_partkey", E.clean_category(F.concat(F.lit("[u'"), "p_brand", F.lit('\'"]'))).alias("category"))


@query(
    "q_iterative_terms",
    f"""WITH {HITS}, ok AS (SELECT * FROM hits WHERE qcov >= 0.6 AND scov >= 0.6 AND pide >= 0.4 AND pide <= 1.0),
    ty AS (SELECT DISTINCT p_type AS term, left(p_type, 2) AS up FROM part),
    te AS (SELECT p_partkey AS l_partkey, p_type AS term, CASE {_CODES} WHEN 'IDA' THEN 1.0 WHEN 'IEA' THEN 0.7 WHEN 'ISS' THEN 0.8 ELSE 0.5 END AS w FROM part
      UNION ALL SELECT p_partkey, left(p_type, 2), 0.6 FROM part UNION ALL SELECT p_partkey, 'ROOT', 1.0 FROM part UNION ALL SELECT p_partkey, 'OBSOLETE', 1.0 FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {SQL_BITS}, l_orderkey) AS n FROM ok),
    s AS (SELECT l_suppkey, term, max(w * pide * 100) AS best, 5.0 * (count(*) - 1) AS extra, max(bits) AS bits FROM r JOIN te USING (l_partkey) WHERE n <= 4 AND term <> 'OBSOLETE' GROUP BY ALL),
    g AS (SELECT * FROM s WHERE best + extra > 55), c AS (SELECT DISTINCT l_suppkey, up AS term FROM g JOIN ty USING (term) UNION SELECT DISTINCT l_suppkey, 'ROOT' FROM g WHERE term <> 'ROOT')
    SELECT l_suppkey, term, 'TYPE' AS ontology, round(best + extra, 6) AS score, extra, bits FROM g WHERE term <> 'ROOT' AND (l_suppkey, term) NOT IN (SELECT (l_suppkey, term) FROM c)""",
)
def iterative_terms(t):
    part = t.part.withColumnRenamed("p_partkey", "l_partkey")
    first = F.substring("p_type", 1, 2)
    own = part.select("l_partkey", F.col("p_type").alias("term"), E.weight(code()).alias("weight"))
    terms = own.unionByName(part.select("l_partkey", first.alias("term"), F.lit(0.6).alias("weight")))
    for name in ("ROOT", "OBSOLETE"):
        terms = terms.unionByName(part.select("l_partkey", F.lit(name).alias("term"), F.lit(1.0).alias("weight")))
    types = part.select("p_type", first.alias("up")).distinct()
    above = types.select(F.col("p_type").alias("term"), F.col("up").alias("ancestor"))
    names = types.select(F.col("p_type").alias("term")).unionByName(types.select(F.col("up").alias("term"))).distinct()
    above = above.unionByName(names.select("term", F.lit("ROOT").alias("ancestor")))
    back = names.select("term", F.lit(1).alias("count")).unionByName(t.spark.range(1).select(F.lit("ROOT").alias("term"), F.lit(9).alias("count"))).select("term", F.lit("TYPE").alias("ontology"), "count", F.lit(9).alias("root"))
    got = H.iterative_terms(hits(t).filter(accepted()), "l_suppkey", "l_partkey", F.col("pide"), F.col("bits"), [*by_bits(), F.asc("l_orderkey")], terms, above, back, 4)
    return got.withColumn("score", F.round("score", 6))


# Look-ups.


@query("q_member_records", "SELECT o_orderkey, coalesce(c_name, '') AS name, coalesce(c_mktsegment, '') AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey")
def member_records(t):
    d = t.customer.filter("c_custkey % 3 <> 0").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return J.lookup(t.orders.select("o_orderkey", "o_custkey"), F.col("o_custkey"), d, "c_custkey", {"name": "", "segment": ""}).select("o_orderkey", "name", "segment")


@query("q_override", "SELECT p.p_partkey, coalesce(CASE WHEN p.p_size % 3 = 0 THEN upper(p.p_brand) END, p.p_name) AS product FROM part p")
def override(t):
    changes = t.part.filter("p_size % 3 <= 1").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 3 == 0, F.upper("p_brand")).alias("new"))
    return J.override(t.part.select("p_partkey", F.col("p_name").alias("product")), "p_partkey", changes, "id", {"product": "new"})


@query("q_found", "SELECT d.doc_id, l.doc_id IS NOT NULL AS found FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id")
def found(t):
    return J.found(t.documents.select("doc_id"), "doc_id", t.labels, "doc_id")


@query(
    "q_any_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND (l_linenumber % 2 = 0 OR p_size > 10)",
)
def any_key(t):
    d = t.part.select(F.concat(F.lit("id"), F.col("p_partkey").cast("string")).alias("a"), F.when(F.col("p_size") > 10, F.concat(F.lit("acc"), F.col("p_partkey").cast("string"))).alias("b"), "p_name")
    key = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "id").otherwise("acc"), F.col("l_partkey").cast("string"))
    return J.by_any_key(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", key.alias("k")), "k", d, ["a", "b"], ["p_name"]).drop("k")


@query("q_external_order", "SELECT s_suppkey, CASE n_name WHEN 'NATION_3' THEN 1 WHEN 'NATION_7' THEN 2 WHEN 'NATION_11' THEN 3 ELSE 99 END AS order_place FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def external_order(t):
    order = t.spark.createDataFrame([("NATION_3", 1), ("NATION_7", 2), ("NATION_11", 3)], "name string, place int")
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name")
    return J.ranked_by_list(s, "n_name", order, "name", "place").select("s_suppkey", F.coalesce("order_place", F.lit(99)).alias("order_place"))


@query("q_record_index", "SELECT event_id, CAST(row_number() OVER (ORDER BY user_id, event_type, ts, event_id) AS BIGINT) AS place FROM events")
def record_index(t):
    return W.running_numbers(t.events, "user_id", ["event_type", "ts", "event_id"], start=0, name="place").select("event_id", F.col("place").cast("long").alias("place"))


# Counters and best entries.


@query("q_run_counters", "SELECT l_linestatus, count(*) AS sequences, sum(l_quantity) AS bases, count(*) FILTER (l_returnflag <> 'N') AS first_pass, count(*) FILTER (l_returnflag = 'R') AS confirmed, sum(l_quantity) / 60.0 AS bases_per_second FROM lineitem GROUP BY 1")
def run_counters(t):
    return H.counters(t.lineitem, {"first_pass": F.col("l_returnflag") != "N", "confirmed": F.col("l_returnflag") == "R"}, F.col("l_quantity"), 60, ["l_linestatus"])


@query("q_best_per_job", f"SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def best_per_job(t):
    return G.best_per_job(t.lineitem, ["l_orderkey"], "l_extendedprice", [F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]).select(*LINE)


@query("q_log_scores", "SELECT p_partkey, round(-ln(p_size + 0.000000001), 6) + 0.0 AS log_score, round(ln((SELECT max(p_size) FROM part)) - ln(p_size + 0.000000001), 6) + 0.0 AS reference_score FROM part")
def log_scores(t):
    return M.log_scores(t.part.select("p_partkey", "p_size"), "p_size").select("p_partkey", *[(F.round(c, 6) + 0.0).alias(c) for c in ("log_score", "reference_score")])


# Matrices and graphs in long form.

_D = "m AS (SELECT a.n_nationkey AS i, b.n_nationkey AS j, abs(a.n_regionkey - b.n_regionkey) AS d FROM nation a JOIN nation b ON a.n_nationkey <= b.n_nationkey)"


def distances(t: Tables):
    a, b = (t.nation.select(F.col("n_nationkey").alias(n), F.col("n_regionkey").alias(f"r{n}")) for n in "ij")
    triangle = a.join(F.broadcast(b), F.col("i") <= F.col("j")).select("i", "j", F.abs(F.col("ri") - F.col("rj")).alias("d"))  # 25 rows a side
    return M.symmetric(triangle, "i", "j")


@query("q_matrix_parts", f"WITH {_D}, s AS (SELECT * FROM m UNION ALL SELECT j, i, d FROM m WHERE i <> j) SELECT 'row' AS part, i, j, d FROM s WHERE i = 3 UNION ALL SELECT 'column', i, j, d FROM s WHERE j = 4 UNION ALL SELECT 'diagonal', i, j, d FROM s WHERE i = j UNION ALL SELECT 'entry', 7, 2, (SELECT d FROM s WHERE i = 7 AND j = 2)")
def matrix_parts(t):
    m = distances(t)
    named = lambda name, x: x.select(F.lit(name).alias("part"), "i", "j", "d")
    wanted = t.spark.createDataFrame([(7, 2)], "i int, j int")
    out = named("row", M.row(m, "i", 3)).unionByName(named("column", M.row(m, "j", 4)))
    return out.unionByName(named("diagonal", M.diagonal(m, "i", "j"))).unionByName(named("entry", M.entries(m, "i", "j", wanted)))


@query("q_adjacency", "SELECT c_nationkey AS a, s_nationkey AS b, TRUE AS adjacent, min(l_quantity) AS distance FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2")
def adjacency(t):
    return M.adjacency(trade(t), "a", "b", "w")


def trade(t: Tables):
    x = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    return x.select(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b"), F.col("l_quantity").alias("w"), "l_shipdate", "l_returnflag")


_TRADE = "e AS (SELECT c_nationkey AS a, s_nationkey AS b, l_quantity AS w, l_returnflag FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey)"


@query("q_neighbour_rows", f"WITH {_TRADE} SELECT a, array_to_string(list_sort(list(DISTINCT b)), ',') AS members, CAST(count(DISTINCT b) AS INTEGER) AS degree FROM e GROUP BY a")
def neighbour_rows(t):
    return M.neighbour_rows(trade(t), "a", "b").select("a", F.array_join("members", ",").alias("members"), "degree")


@query("q_multi_edges", f"WITH {_TRADE} SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS count, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS ids FROM e GROUP BY 1, 2")
def multi_edges(t):
    return M.multi_edges(trade(t), "a", "b", "l_returnflag", directed=False).withColumn("ids", F.array_join("ids", ","))


@query("q_degrees", "WITH e AS (SELECT doc_id AS c, doc_id // 2 AS p FROM documents WHERE doc_id > 0), v AS (SELECT c AS vertex, 0 AS i, 1 AS o FROM e UNION ALL SELECT p, 1, 0 FROM e) SELECT vertex, CAST(sum(i) AS BIGINT) AS predecessors, CAST(sum(o) AS BIGINT) AS successors, CASE WHEN sum(i) = 0 THEN 'source' WHEN sum(o) = 0 THEN 'sink' ELSE 'inner' END AS kind FROM v GROUP BY 1")
def degrees(t):
    return graph.degrees(related(t), "child", "parent")


def related(t: Tables):
    return t.documents.filter("doc_id > 0").select(F.col("doc_id").alias("child"), F.floor(F.col("doc_id") / 2).alias("parent"), F.when(F.col("doc_id") % 3 == 0, "part_of").otherwise("is_a").alias("relation"))


@query(
    "q_relatives",
    "WITH RECURSIVE e AS (SELECT doc_id AS c, doc_id // 2 AS p FROM documents WHERE doc_id > 0 AND doc_id % 3 <> 0), u AS (SELECT doc_id AS node, doc_id AS relative, 0 AS distance FROM documents UNION ALL SELECT node, p, distance + 1 FROM u JOIN e ON c = relative WHERE distance < 3) SELECT node, relative, distance FROM u WHERE distance > 0",
)
def relatives(t):
    return graph.relatives(related(t), "child", "parent", t.documents.select("doc_id"), "relation", ("is_a",), depth=3)


@query(
    "q_descendants",
    "WITH RECURSIVE e AS (SELECT doc_id AS c, doc_id // 2 AS p FROM documents WHERE doc_id > 0), s AS (SELECT doc_id AS node FROM documents WHERE doc_id BETWEEN 1 AND 9), u AS (SELECT node, node AS relative, 0 AS distance FROM s UNION ALL SELECT node, c, distance + 1 FROM u JOIN e ON p = relative), r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY distance, relative) AS n FROM u WHERE distance > 0) SELECT node, relative, distance FROM r WHERE n <= 20",
)
def descendants(t):
    return graph.relatives(related(t), "child", "parent", t.documents.filter("doc_id BETWEEN 1 AND 9").select("doc_id"), up=False, most=20)


@query("q_coparents", "SELECT doc_id AS child, CASE WHEN doc_id % 3 = 0 THEN 'part_of' ELSE 'is_a' END AS relation, CAST(doc_id // 2 AS VARCHAR) AS parents FROM documents WHERE doc_id > 0")
def coparents(t):
    return graph.coparents(related(t), "child", "parent", "relation").withColumn("parents", F.array_join("parents", ","))


@query("q_find_terms", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 're') OR contains(lower(p_type), 're')")
def find_terms(t):
    return graph.find_terms(t.part, "RE", ["p_name", "p_type"]).select("p_partkey")


# Vectors and sets.


@query(
    "q_vector_algebra",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(round(x * 4) AS BIGINT)) AS v FROM embeddings)
    SELECT a.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] + z[2]))::BIGINT AS added, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] - z[2]))::BIGINT AS subtracted, list_sum(list_transform(a.v, lambda x: 3 * x))::BIGINT AS scaled,
    (CASE WHEN a.v < b.v THEN -1 WHEN a.v > b.v THEN 1 ELSE 0 END)::INTEGER AS lexicographic, len(list_filter(list_zip(a.v, b.v), lambda z: z[1] < z[2])) = 0 AS dominates, list_min(a.v) >= 0 AS positive,
    len(list_filter(list_zip(a.v, b.v), lambda z: z[1] <> z[2]))::INTEGER AS hamming, list_sum(list_transform(list_zip(a.v, b.v), lambda z: abs(z[1] - z[2])))::DOUBLE AS manhattan
    FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""",
)
def vector_algebra(t):
    e = t.embeddings.select("vec_id", F.transform("embedding", lambda x: F.round(x * 4).cast("long")).alias("v"))
    x = e.withColumnRenamed("v", "a").join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("b")), "vec_id")
    a, b = F.col("a"), F.col("b")
    total = lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda s, y: s + y)
    return x.select(
        "vec_id", total(V.add(a, b)).alias("added"), total(V.subtract(a, b)).alias("subtracted"), total(V.scale(a, F.lit(3).cast("long"))).alias("scaled"), V.lexicographic(a, b).alias("lexicographic"),
        V.dominates(a, b).alias("dominates"), V.non_negative(a).alias("positive"), V.hamming(a, b).alias("hamming"), V.manhattan(a, b).alias("manhattan"),
    )


@query("q_sorted_map", "SELECT p_brand, array_to_string(list(p_type || ':' || n ORDER BY n DESC, p_type), ',') AS entries FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) GROUP BY 1")
def sorted_map(t):
    counts = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")).groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", (-F.col("n")).alias("n")))).alias("m"))
    return counts.select("p_brand", F.array_join(F.transform(S.sorted_map(F.col("m"), "value"), lambda e: F.concat_ws(":", e["key"], (-e["value"]).cast("string"))), ",").alias("entries"))


@query("q_common_labels", "SELECT s_nationkey AS label FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 0")
def common_labels(t):
    return t.supplier.select(F.col("s_nationkey").alias("label")).intersect(t.customer.filter("c_acctbal > 0").select("c_nationkey"))


@query("q_array_match", "WITH w AS (SELECT a.p_partkey, string_split(a.p_name, ' ') AS x, string_split(b.p_name, ' ') AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1) SELECT p_partkey, len(x) = len(y) AS length, x = y AS simple, list_sort(x) = list_sort(y) AS permutation, len(list_filter(range(1, greatest(len(x), len(y)) + 1), lambda i: x[i] IS DISTINCT FROM y[i]))::INTEGER AS different FROM w")
def array_match(t):
    b = t.part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.split("p_name", " ").alias("y"))
    return t.part.join(b, "p_partkey").select("p_partkey", S.array_match(F.split("p_name", " "), F.col("y")).alias("m")).select("p_partkey", "m.*")


# Sequences and locations.


@query("q_acceptor_half", f"WITH {_SEQ}, s AS (SELECT p_partkey, seq, CASE WHEN p_partkey % 2 = 0 THEN '>>><...........' ELSE '>>>...<<<....' END AS str FROM sq) SELECT p_partkey, left(seq, 7) AS five, substring(seq, length(seq) - CASE WHEN p_partkey % 2 = 0 THEN 10 ELSE 7 END, 7) AS three FROM s WHERE length(seq) >= 11")
def acceptor_half(t):
    s = sequences(t).filter(F.length("seq") >= 11).withColumn("str", F.when(F.col("p_partkey") % 2 == 0, ">>><...........").otherwise(">>>...<<<...."))
    return s.select("p_partkey", Q.acceptor_half(F.col("seq"), F.col("str"), 5).alias("five"), Q.acceptor_half(F.col("seq"), F.col("str"), 3).alias("three"))


@query(
    "q_isotype",
    f"""WITH {_SEQ}, c AS (SELECT p_partkey, left(seq, 3) AS ac, reverse(translate(left(seq, 3), 'ACGT', 'TGCA')) AS cod FROM sq WHERE length(seq) >= 3)
    SELECT p_partkey, ac, CASE WHEN cod LIKE 'GC_' THEN 'Ala' WHEN cod IN ('TGT', 'TGC') THEN 'Cys' WHEN cod IN ('GAT', 'GAC') THEN 'Asp' WHEN cod IN ('GAA', 'GAG') THEN 'Glu' WHEN cod IN ('TTT', 'TTC') THEN 'Phe'
    WHEN cod LIKE 'GG_' THEN 'Gly' WHEN cod IN ('CAT', 'CAC') THEN 'His' WHEN cod IN ('ATT', 'ATC', 'ATA') THEN 'Ile' WHEN cod IN ('AAA', 'AAG') THEN 'Lys' WHEN cod IN ('TTA', 'TTG') OR cod LIKE 'CT_' THEN 'Leu'
    WHEN cod = 'ATG' THEN 'Met' WHEN cod IN ('AAT', 'AAC') THEN 'Asn' WHEN cod LIKE 'CC_' THEN 'Pro' WHEN cod IN ('CAA', 'CAG') THEN 'Gln' WHEN cod IN ('AGA', 'AGG') OR cod LIKE 'CG_' THEN 'Arg'
    WHEN cod IN ('AGT', 'AGC') OR cod LIKE 'TC_' THEN 'Ser' WHEN cod LIKE 'AC_' THEN 'Thr' WHEN cod LIKE 'GT_' THEN 'Val' WHEN cod = 'TGG' THEN 'Trp' WHEN cod IN ('TAT', 'TAC') THEN 'Tyr' WHEN cod IN ('TAA', 'TAG', 'TGA') THEN 'Sup' END AS isotype FROM c""",
)
def isotype(t):
    s = sequences(t).filter(F.length("seq") >= 3).select("p_partkey", F.substring("seq", 1, 3).alias("ac"))
    return s.withColumn("isotype", Q.isotype(F.col("ac")))


@query(
    "q_alignment_score",
    f"""WITH {_SEQ}, g AS (SELECT p_partkey, replace(left(seq, 6), 'AC', '--') AS x FROM sq WHERE length(seq) >= 6), p AS (SELECT a.p_partkey, a.x, b.x AS y FROM g a JOIN g b ON b.p_partkey = a.p_partkey + 1),
    c AS (SELECT p_partkey, x[i] AS a, y[i] AS b, CASE WHEN i = 1 THEN '-' ELSE x[i - 1] END AS pa, CASE WHEN i = 1 THEN '-' ELSE y[i - 1] END AS pb FROM (SELECT p_partkey, x, y, unnest(range(1, 7)) AS i FROM p))
    SELECT p_partkey, CAST(sum(CASE WHEN a <> '-' AND b <> '-' THEN CASE WHEN a = b THEN 2 ELSE -3 END WHEN a = '-' AND b = '-' THEN CASE WHEN pa = '-' AND pb = '-' THEN -2 ELSE -5 END
      WHEN b = '-' THEN CASE WHEN pb = '-' THEN -2 ELSE -5 END ELSE CASE WHEN pa = '-' THEN -2 ELSE -5 END END) AS INTEGER) AS score FROM c GROUP BY 1""",
)
def alignment_score(t):
    g = sequences(t).filter(F.length("seq") >= 6).select("p_partkey", F.replace(F.substring("seq", 1, 6), F.lit("AC"), F.lit("--")).alias("x"))
    return g.join(g.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("x").alias("y")), "p_partkey").select("p_partkey", Q.alignment_score(F.col("x"), F.col("y")).alias("score"))


@query("q_location", "WITH l AS (SELECT event_id, CAST(user_id AS BIGINT) AS s, user_id + event_id % 5 AS e, CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN -1 END AS strand FROM events) SELECT event_id, e - s + 1 AS length, CAST(-coalesce(strand, 1) AS INTEGER) AS flipped, CASE WHEN strand = -1 THEN 'complement(' ELSE '' END || CASE WHEN s = e THEN s::VARCHAR WHEN e = s + 1 THEN s || '^' || e ELSE s || '..' || e END || CASE WHEN strand = -1 THEN ')' ELSE '' END AS text, CASE WHEN greatest(s, 10) <= least(e, 20) THEN greatest(s, 10) ELSE 0 END AS a, CASE WHEN greatest(s, 10) <= least(e, 20) THEN least(e, 20) ELSE 0 END AS z FROM l")
def location(t):
    k = F.col("event_id") % 3
    x = t.events.select("event_id", F.col("user_id").cast("long").alias("s"), (F.col("user_id") + F.col("event_id") % 5).cast("long").alias("e"), F.when(k == 0, 1).when(k == 1, -1).alias("strand"))
    s, e = F.col("s"), F.col("e")
    a, z = O.truncate(s, e, F.lit(10).cast("long"), F.lit(20).cast("long"))
    return x.select("event_id", O.length(s, e).alias("length"), O.flip(F.col("strand")).alias("flipped"), O.feature_text(s, e, F.col("strand"), O.between_neighbours(s, e)).alias("text"), F.coalesce(a, F.lit(0)).alias("a"), F.coalesce(z, F.lit(0)).alias("z"))


@query("q_relative_position", "SELECT event_id, CASE WHEN value < p THEN 'before' WHEN value > p THEN 'after' WHEN value = p THEN 'equal' END AS place FROM (SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)")
def relative_position(t):
    from pyspark.sql import Window

    before = F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return t.events.select("event_id", O.order(F.col("value"), before).alias("place"))


@query("q_relative_coordinates", "WITH l AS (SELECT event_id, user_id + 100 AS s, user_id + 100 + event_id % 50 AS e, CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS strand FROM events) SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 5000 - e + 1 ELSE s - 50 + 1 END AS a, CASE WHEN event_id % 3 = 0 THEN 5000 - s + 1 ELSE e - 50 + 1 END AS z, CAST(CASE WHEN event_id % 3 = 0 THEN -strand ELSE strand END AS INTEGER) AS strand FROM l")
def relative_coordinates(t):
    x = t.events.select("event_id", (F.col("user_id") + 100).alias("s"), (F.col("user_id") + 100 + F.col("event_id") % 50).alias("e"), F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1).alias("d"))
    a, z, strand = O.relative(F.col("s"), F.col("e"), F.col("d"), F.lit(50), F.lit(5000), F.when(F.col("event_id") % 3 == 0, -1).otherwise(1))
    return x.select("event_id", a.alias("a"), z.alias("z"), strand.alias("strand"))


# Populations, families and enzymes.


@query(
    "q_alignment_sites",
    f"WITH {_SEQ}, c AS (SELECT p.p_brand, s.p_partkey, i AS site, s.seq[i] AS allele FROM (SELECT p_partkey, seq, unnest(range(1, length(seq) + 1)) AS i FROM sq) s JOIN part p USING (p_partkey)), v AS (SELECT p_brand, site FROM c GROUP BY ALL HAVING count(DISTINCT allele) > 1) SELECT p_brand, CAST(site AS INTEGER) AS site, p_partkey, allele FROM c JOIN v USING (p_brand, site)",
)
def alignment_sites(t):
    s = sequences(t, "p_brand").filter("p_partkey is not null")
    return P.sites(s, "p_partkey", "seq", ["p_brand"])


@query("q_families", "SELECT p_brand AS family, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS members, CAST(count(DISTINCT p_type) AS INTEGER) AS size FROM part GROUP BY 1")
def families(t):
    return P.families(t.part.select(F.col("p_brand").alias("family"), "p_type"), "family", "p_type").withColumn("members", F.array_join("members", ","))


@query(
    "q_enzymes",
    f"WITH {_SEQ}, e AS (SELECT p_partkey, left(seq, CAST(4 + p_partkey % 5 AS BIGINT)) AS site, CAST(p_partkey % 4 AS INTEGER) AS cut FROM sq WHERE length(seq) >= 8) SELECT p_partkey, CAST(length(site) AS INTEGER) AS site_length, 2 * cut = length(site) AS blunt, site = reverse(translate(site, 'ACGT', 'TGCA')) AS palindrome, length(site) = (SELECT max(length(site)) FROM e) AS longest FROM e",
)
def enzymes(t):
    e = sequences(t).filter(F.length("seq") >= 8).select("p_partkey", F.substring(F.col("seq"), F.lit(1), (4 + F.col("p_partkey") % 5).cast("int")).alias("site"), (F.col("p_partkey") % 4).cast("int").alias("cut"))
    every = P.enzymes(e, "p_partkey", "site", "cut")
    top = P.longest_cutters(every).select(F.col("p_partkey").alias("k"), F.lit(True).alias("longest"))
    return every.join(top, F.col("p_partkey") == F.col("k"), "left").select("p_partkey", "site_length", "blunt", "palindrome", F.coalesce("longest", F.lit(False)).alias("longest"))


@query("q_common_subsequence")
def common_subsequence(t):
    """Longest common subsequence of each part's name and the next one's."""
    b = t.part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    x = t.part.join(b, "p_partkey").withColumn("common", X.common_subsequence("p_name", "other"))
    return x.select("p_partkey", "p_name", "other", "common", X.changes(F.col("p_name"), F.col("other"), F.col("common")).alias("c")).select("p_partkey", "p_name", "other", "common", "c.removed", "c.added")


@query("q_merged_files")
def merged_files(t):
    """Three files' hits merged at once: the best of overlapping ones."""
    from tarnflow.operators import intervals as I

    from .q_structure import intervals

    iv = intervals(t)
    return I.merge_files([iv.filter(F.col("event_id") % 3 == k) for k in range(3)], ["user_id"], "event_id", "s", "e", "value")
