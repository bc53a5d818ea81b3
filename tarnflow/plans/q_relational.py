"""Queries for joins, sets, aggregates, orders and numbering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnflow.operators import hits as H
from tarnflow.operators import joins as J
from tarnflow.operators import populations as P
from tarnflow.operators import sets as S
from tarnflow.operators import windows as W

from .registry import Tables, query

_SUMS = "a AS (SELECT o_orderkey AS k, floor(o_totalprice / 1000) AS v FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT l_orderkey AS k, floor(sum(l_extendedprice) / 1000) AS v FROM lineitem GROUP BY 1)"
_DIFF = f"""WITH {_SUMS} SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, -1) AS left_value, coalesce(b.v, -1) AS right_value,
CASE WHEN b.k IS NULL THEN '<' WHEN a.k IS NULL THEN '>' WHEN a.v = b.v THEN '=' ELSE '|' END AS flag, coalesce(b.v - a.v, 0) AS difference FROM a FULL JOIN b ON a.k = b.k"""


def compared(t: Tables):
    a = t.orders.filter(F.col("o_orderkey") % 5 != 0).select(F.col("o_orderkey").alias("k"), F.floor(F.col("o_totalprice") / 1000).cast("double").alias("v"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.floor(F.sum("l_extendedprice") / 1000).cast("double").alias("v"))
    return J.diff(a, b, "k", "v")


@query("q_outer_diff", _DIFF)
def outer_diff(t):
    return compared(t).fillna(-1.0, ["left_value", "right_value"]).fillna(0.0, ["difference"])


@query(
    "q_outer_diff_summary",
    f"WITH d AS ({_DIFF}) SELECT count(*) FILTER (flag = '<') AS only_left, count(*) FILTER (flag = '>') AS only_right, count(*) FILTER (flag IN ('=', '|')) AS \"both\", count(*) FILTER (flag = '=') AS exact, "
    "round(100.0 * count(*) FILTER (flag = '=') / count(*) FILTER (flag IN ('=', '|')), 6) AS exact_percent, round(avg(difference) FILTER (flag IN ('=', '|')), 4) AS mean_difference FROM d",
)
def outer_diff_summary(t):
    s = J.diff_summary(compared(t))
    return s.withColumn("exact_percent", F.round("exact_percent", 6)).withColumn("mean_difference", F.round("mean_difference", 4))


@query("q_semi_list", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_list(t):
    return J.in_list(t.customer.select("c_custkey"), "c_custkey", t.orders.filter("o_orderstatus = 'F'"), "o_custkey")


@query("q_anti_missing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_missing(t):
    return J.in_list(t.customer.select("c_custkey"), "c_custkey", t.orders.filter("o_orderpriority = '1-URGENT'"), "o_custkey", keep=False)


@query(
    "q_four_way_left",
    """SELECT p_partkey, coalesce(n, 0) AS n, coalesce(s_name, '') AS s_name, coalesce(n_name, '') AS n_name, coalesce(r_name, '') AS r_name FROM part
    LEFT JOIN (SELECT l_partkey, count(*) AS n, min(l_suppkey) AS sk FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey
    LEFT JOIN supplier ON s_suppkey = sk LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey WHERE p_brand IN ('Brand#2', 'Brand#3')""",
)
def four_way_left(t):
    few = t.lineitem.filter("l_quantity > 45").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_suppkey").alias("sk"))
    out = t.part.filter(F.col("p_brand").isin("Brand#2", "Brand#3")).join(few, F.col("p_partkey") == F.col("l_partkey"), "left")
    out = J.lookup(out, F.col("sk"), t.supplier, "s_suppkey", {"s_name": "", "s_nationkey": None})
    out = J.lookup(out, F.col("s_nationkey"), t.nation, "n_nationkey", {"n_name": "", "n_regionkey": None})
    out = J.lookup(out, F.col("n_regionkey"), t.region, "r_regionkey", {"r_name": ""})
    return out.select("p_partkey", F.coalesce("n", F.lit(0)).alias("n"), "s_name", "n_name", "r_name")


@query("q_set_union_agg", "SELECT l_suppkey, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS brands, count(DISTINCT p_brand) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def set_union_agg(t):
    x = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return x.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("brands"), F.count_distinct("p_brand").alias("n"))


@query("q_best_description", "SELECT p_brand, p_name, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey DESC) AS r FROM part) WHERE r = 1")
def best_description(t):
    best = t.part.groupBy("p_brand").agg(F.min_by(F.struct("p_name", "p_size"), F.struct("p_size", -F.col("p_partkey"))).alias("b"))
    return best.select("p_brand", "b.p_name", "b.p_size")


@query(
    "q_ortholog_classes",
    """WITH m AS (SELECT l_orderkey AS event, l_linenumber % 2 + 1 AS side, l_suppkey % 5 AS species, l_partkey AS gene FROM lineitem),
    s AS (SELECT event, side, species, count(DISTINCT gene) AS n FROM m GROUP BY ALL)
    SELECT a.event, a.species AS species_a, b.species AS species_b, CASE WHEN a.n = 1 THEN 'one' ELSE 'many' END || '2' || CASE WHEN b.n = 1 THEN 'one' ELSE 'many' END AS class
    FROM s a JOIN s b ON a.event = b.event WHERE a.side = 1 AND b.side = 2""",
)
def ortholog_classes(t):
    m = t.lineitem.select(F.col("l_orderkey").alias("event"), (F.col("l_linenumber") % 2 + 1).alias("side"), (F.col("l_suppkey") % 5).alias("species"), F.col("l_partkey").alias("gene"))
    return J.ortholog_classes(m, "event", "side", "species", "gene")


@query(
    "q_cross_frequent",
    "SELECT n_nationkey, p_brand, round(n / CAST(tot AS DOUBLE), 6) AS frequency FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1), (SELECT count(*) AS tot FROM part), nation WHERE n / CAST(tot AS DOUBLE) >= 0.01",
)
def cross_frequent(t):
    total = t.part.agg(F.count(F.lit(1)).alias("tot"))
    common = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total)).withColumn("frequency", F.col("n") / F.col("tot")).filter("frequency >= 0.01")
    return J.every_pair(t.nation.select("n_nationkey"), common.select("p_brand", F.round("frequency", 6).alias("frequency")))


@query("q_external_map", "SELECT p_type AS internal, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS externals FROM part GROUP BY 1")
def external_map(t):
    return J.external_map(t.part, "p_brand", "p_type").select(F.col("p_type").alias("internal"), F.array_join("externals", ",").alias("externals"))


@query("q_inverse_map", "SELECT b AS brand, array_to_string(list_sort(list_distinct(list(p_type))), ',') AS types FROM (SELECT upper(p_brand) AS b, p_type FROM part) GROUP BY 1")
def inverse_map(t):
    x = t.part.select(F.upper("p_brand").alias("brand"), "p_type")
    return J.external_map(x, "p_type", "brand").select("brand", F.array_join("externals", ",").alias("types"))


@query("q_locus_numbering", "SELECT o_orderkey, CAST(5 * row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS number FROM orders")
def locus_numbering(t):
    return W.running_numbers(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"], 5).select("o_orderkey", F.col("number").cast("long").alias("number"))


@query("q_renumber", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS number FROM lineitem")
def renumber(t):
    return W.renumber(t.lineitem, ["l_orderkey"], [F.col(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "number")


@query("q_feature_counts", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 100) AS large FROM events GROUP BY 1")
def feature_counts(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 100).alias("large"))


@query("q_rollup_report", "SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_report(t):
    r = t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return r.select(F.coalesce("l_returnflag", F.lit("all")).alias("flag"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n", "quantity")


@query("q_column_sum", "SELECT round(sum(l_quantity), 2) AS total, round(100.0 * sum(l_quantity) FILTER (l_returnflag = 'R') / sum(l_quantity), 6) AS percent FROM lineitem")
def column_sum(t):
    r = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")))
    return t.lineitem.agg(F.round(F.sum("l_quantity"), 2).alias("total"), F.round(F.coalesce(F.try_divide(100.0 * r, F.sum("l_quantity")), F.lit(0.0)), 6).alias("percent"))


@query(
    "q_sort_strand",
    """SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY strand DESC, CASE WHEN strand = '+' THEN epoch_us(ts) ELSE -epoch_us(ts) END, event_id) AS INTEGER) AS place
    FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM events)""",
)
def sort_strand(t):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    e = t.events.withColumn("strand", F.when(F.col("event_id") % 2 == 0, "+").otherwise("-"))
    order = [F.desc("strand"), F.when(F.col("strand") == "+", micros).otherwise(-micros), F.asc("event_id")]
    return W.renumber(e, ["user_id"], order, "place").select("event_id", "place")


@query("q_topk", "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS r FROM lineitem) WHERE r <= 10")
def topk(t):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return H.top(t.lineitem, ["l_suppkey"], order, 10).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "rank")


@query(
    "q_top_else_group",
    """WITH c AS (SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (ORDER BY n DESC, n_name) AS r FROM c) SELECT CASE WHEN r <= 8 THEN n_name ELSE r_name END AS name, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1""",
)
def top_else_group(t):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("n"))
    best = c.orderBy(F.desc("n"), "n_name").limit(8).select(F.col("n_name").alias("top"))
    named = c.join(F.broadcast(best), F.col("n_name") == F.col("top"), "left").select(F.coalesce("top", "r_name").alias("name"), "n")
    return named.groupBy("name").agg(F.sum("n").alias("n"))


_A, _B = "(SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F')", "(SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT')"


def two_sets(t: Tables):
    return t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"))


@query("q_set_union", f"SELECT k FROM {_A} UNION SELECT k FROM {_B}")
def set_union(t):
    a, b = two_sets(t)
    return a.union(b).distinct()


@query("q_set_intersect", f"SELECT k FROM {_A} INTERSECT SELECT k FROM {_B}")
def set_intersect(t):
    a, b = two_sets(t)
    return a.intersect(b)


@query("q_set_difference", f"SELECT k FROM {_A} EXCEPT SELECT k FROM {_B}")
def set_difference(t):
    a, b = two_sets(t)
    return a.subtract(b)


@query("q_set_symmetric", f"(SELECT k FROM {_A} EXCEPT SELECT k FROM {_B}) UNION (SELECT k FROM {_B} EXCEPT SELECT k FROM {_A})")
def set_symmetric(t):
    return S.symmetric_difference(*two_sets(t))


@query("q_set_complement", f"SELECT c_custkey AS k FROM customer EXCEPT SELECT k FROM {_A}")
def set_complement(t):
    a, _ = two_sets(t)
    return S.complement(a, t.customer.select(F.col("c_custkey").alias("k")))


@query(
    "q_set_compare",
    """WITH s AS (SELECT l_orderkey AS k, list_distinct(list(l_suppkey % 7)) AS a FROM lineitem GROUP BY 1), p AS (SELECT x.k, x.a, y.a AS b FROM s x JOIN s y ON y.k = x.k + 1),
    q AS (SELECT *, len(list_filter(a, lambda v: NOT list_contains(b, v))) AS oa, len(list_filter(b, lambda v: NOT list_contains(a, v))) AS ob FROM p)
    SELECT k, CASE WHEN oa = 0 AND ob = 0 THEN 'equal' WHEN oa = 0 THEN 'subset' WHEN ob = 0 THEN 'superset' WHEN oa = len(a) THEN 'disjoint' ELSE 'overlap' END AS relation FROM q""",
)
def set_compare(t):
    s = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.col("l_suppkey") % 7).alias("a"))
    y = s.select((F.col("k") - 1).alias("k"), F.col("a").alias("b"))
    return s.join(y, "k").select("k", S.compare(F.col("a"), F.col("b")).alias("relation"))


@query("q_power_set", "WITH s AS (SELECT n_nationkey, [n_nationkey, n_regionkey + 100, 7] AS a FROM nation) SELECT n_nationkey, CAST(m AS INTEGER) AS mask, CAST(list_sum(list_transform([1, 2, 3], lambda i: CASE WHEN (m >> (i - 1)) & 1 = 1 THEN a[i] ELSE 0 END)) AS BIGINT) AS total FROM s, (SELECT unnest(range(0, 8)) AS m)")
def power_set(t):
    a = F.array(F.col("n_nationkey"), F.col("n_regionkey") + 100, F.lit(7))
    return t.nation.select("n_nationkey", F.posexplode(S.power_set(a, 3)).alias("mask", "s")).select("n_nationkey", "mask", F.aggregate("s", F.lit(0).cast("long"), lambda x, v: x + v).alias("total"))


@query("q_union_streams", "SELECT event_id AS id, 'event' AS kind, round(value, 2) AS value, -1 AS custkey FROM events UNION ALL SELECT o_orderkey, 'order', round(o_totalprice, 2), o_custkey FROM orders")
def union_streams(t):
    e = t.events.select(F.col("event_id").alias("id"), F.lit("event").alias("kind"), F.round("value", 2).alias("value"))
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"), F.round("o_totalprice", 2).alias("value"), F.col("o_custkey").alias("custkey"))
    return S.union_streams(e, o).fillna(-1, ["custkey"])


@query(
    "q_fst",
    """WITH a AS (SELECT user_id % 3 AS pop, event_type AS marker, CAST(floor(value / 40) AS BIGINT) % 3 AS allele FROM events),
    c AS (SELECT marker, allele, pop, count(*) AS k FROM a GROUP BY ALL), n AS (SELECT marker, pop, count(*) AS n FROM a GROUP BY ALL),
    p AS (SELECT g.marker, g.allele, n.pop, n.n, coalesce(k, 0) / CAST(n.n AS DOUBLE) AS p FROM (SELECT DISTINCT marker, allele FROM c) g JOIN n USING (marker) LEFT JOIN c ON c.marker = g.marker AND c.allele = g.allele AND c.pop = n.pop),
    s AS (SELECT marker, allele, count(*) AS r, sum(n) AS nt, sum(n * n) AS n2, sum(n * p) / sum(n) AS pb, sum(n * p * (1 - p)) AS w, sum(n * p * p) AS np2 FROM p GROUP BY ALL),
    v AS (SELECT *, (np2 - nt * pb * pb) / (r - 1) AS msb, w / (nt - r) AS msw, (nt - n2 / CAST(nt AS DOUBLE)) / (r - 1) AS nc FROM s)
    SELECT marker, round(sum(msb - msw) / sum(msb + (nc - 1) * msw), 8) AS fst FROM v GROUP BY 1""",
)
def fst(t):
    a = t.events.select((F.col("user_id") % 3).alias("pop"), F.col("event_type").alias("marker"), (F.floor(F.col("value") / 40) % 3).alias("allele"))
    return P.fst(a, "pop", "marker", "allele").withColumn("fst", F.round("fst", 8))


@query("q_codon_usage", "WITH c AS (SELECT substring(p_type, 1, 3) AS codon, count(*) AS n FROM part GROUP BY 1) SELECT codon, n, round(1000.0 * n / (SELECT sum(n) FROM c), 6) AS per_thousand FROM c")
def codon_usage(t):
    return P.codon_usage(t.part.select(F.substring("p_type", 1, 3).alias("codon")), "codon").withColumn("per_thousand", F.round("per_thousand", 6))


@query(
    "q_hit_iterations",
    """WITH h AS (SELECT l_partkey AS hit, l_linenumber AS it, max(l_quantity) AS score FROM lineitem GROUP BY ALL)
    SELECT hit, it, CASE WHEN it = min(it) OVER (PARTITION BY hit) THEN 'new' ELSE 'old' END || CASE WHEN score >= 25 THEN ' above' WHEN max(score) OVER (PARTITION BY hit ORDER BY it ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= 25 THEN ' newly below' ELSE ' below' END AS class FROM h""",
)
def hit_iterations(t):
    h = t.lineitem.groupBy(F.col("l_partkey").alias("hit"), F.col("l_linenumber").alias("it")).agg(F.max("l_quantity").alias("score"))
    w = Window.partitionBy("hit")
    before = F.max("score").over(w.orderBy("it").rowsBetween(Window.unboundedPreceding, -1))
    age = F.when(F.col("it") == F.min("it").over(w), "new").otherwise("old")
    level = F.when(F.col("score") >= 25, " above").when(before >= 25, " newly below").otherwise(" below")
    return h.select("hit", "it", F.concat(age, level).alias("class"))
