"""Queries over hit tables.  A block is an order; its hits are its lines, in
order of price; a subject is a part, a species a supplier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnflow.functions import lineage as L
from tarnflow.functions import scores as S
from tarnflow.functions import text as X
from tarnflow.operators import fanout as U
from tarnflow.operators import hits as H

from .registry import Tables, query

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]


def by_bits() -> list[Column]:
    return [F.desc("bits"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]



#: The hit table in SQL.
HITS = """hits AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice AS bits, 1 - l_discount AS pide,
  l_quantity / 50 AS qcov, 1 - l_tax AS scov, l_quantity AS lali FROM lineitem)"""
OK = "(qcov >= 0.6 AND scov >= 0.6 AND pide >= 0.4 AND pide <= 1.0)"
SQL_BITS = "bits DESC, l_linenumber, l_partkey, l_suppkey"


def hits(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_extendedprice").alias("bits"),
        (1 - F.col("l_discount")).alias("pide"), (F.col("l_quantity") / 50).alias("qcov"), (1 - F.col("l_tax")).alias("scov"), F.col("l_quantity").alias("lali"),
    )


def accepted(rule: H.HitRule = H.HitRule()) -> Column:
    return H.accepted(F.col("qcov"), F.col("scov"), F.col("pide"), F.col("lali"), rule)


@query("q_filter_strict", f"WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM hits WHERE {OK}")
def filter_strict(t):
    return hits(t).filter(accepted()).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "q_filter_permissive",
    f"WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM hits WHERE (qcov >= 0.6 OR scov >= 0.96 OR lali > 100) AND pide >= 0.4 AND pide <= 1.0",
)
def filter_permissive(t):
    return hits(t).filter(accepted(H.HitRule(subject_coverage=0.96, strict=False))).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "q_first_n_accepted",
    f"""WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {OK} AND
    sum(CASE WHEN {OK} THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY {SQL_BITS} ROWS UNBOUNDED PRECEDING) <= 2 AS status FROM hits""",
)
def first_n(t):
    return H.first_accepted(hits(t), ["l_orderkey"], by_bits(), accepted(), 2).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "status")


_RM1 = f"CASE WHEN {OK} THEN 0.21 * log10(100 * qcov) + 0.26 * scov * pide + 0.40 * pide * 0.5 ELSE 0 END"


def with_rm1(t: Tables) -> DataFrame:
    return hits(t).withColumn("rm1", S.rm1(F.col("qcov"), F.col("scov"), F.col("pide"), F.lit(0.5), accepted()))


@query("q_rm1_score", f"WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round({_RM1}, 6) AS rm1 FROM hits")
def rm1_score(t):
    return with_rm1(t).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round("rm1", 6).alias("rm1"))


@query(
    "q_rm1_top_hit",
    f"""WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(rm1, 6) AS rm1 FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_BITS}) AS r FROM (SELECT *, {_RM1} AS rm1 FROM hits WHERE {OK})) WHERE r = 1""",
)
def rm1_top(t):
    best = H.top(with_rm1(t).filter(accepted()), ["l_orderkey"], by_bits())
    return best.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round("rm1", 6).alias("rm1"))


@query(
    "q_hit_sample_stats",
    f"WITH {HITS} SELECT l_orderkey, count(*) AS n, round(avg(bits), 4) AS mean, round(var_pop(bits) / 1e6, 4) AS variance FROM hits WHERE {OK} GROUP BY l_orderkey",
)
def sample_stats(t):
    s = H.sample_statistics(hits(t).filter(accepted()), ["l_orderkey"], F.col("bits"))
    return s.select("l_orderkey", "n", F.round("mean", 4).alias("mean"), F.round(F.col("variance") / 1e6, 4).alias("variance"))


def classed(t: Tables) -> DataFrame:
    """Accepted hits with the part's type as class and brand as ontology."""
    return hits(t).filter(accepted()).join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_name"), "l_partkey")


_GSZ = """CASE WHEN b < 2 THEN 0 WHEN n > 1 THEN coalesce((s - m * e) / nullif(sqrt(greatest(v * (e * (n - e) - w) / (n - 1) + m * m * w, 0)), 0), 0) ELSE e * w END"""
_CLASS_SQL = f"""WITH {HITS},
c AS (SELECT h.*, p_type, p_brand, p_name FROM hits h JOIN part ON p_partkey = l_partkey WHERE {OK}),
st AS (SELECT l_suppkey AS q, count(*) AS n, avg(bits) AS m, var_pop(bits) AS v FROM c GROUP BY 1),
cl AS (SELECT l_suppkey AS q, p_type, count(*) AS k, sum(bits) AS s FROM c GROUP BY 1, 2),
bg AS (SELECT p_type, count(*) AS b FROM part GROUP BY 1),
tot AS (SELECT count(*) AS t FROM part),
x AS (SELECT *, greatest(b, 10) * n / CAST(t AS DOUBLE) AS e FROM cl JOIN st USING (q) JOIN bg USING (p_type), tot),
y AS (SELECT *, e * (1 - greatest(b, 10) / CAST(t AS DOUBLE)) * (t - n) / (t - 1.0) AS w FROM x),
g AS (SELECT *, {_GSZ} AS gsz FROM y)
"""


def class_table(t: Tables) -> DataFrame:
    """(q, p_type, k, s, n, m, v, b, t): classes of each supplier's hits."""
    c = classed(t)
    st = H.sample_statistics(c, ["l_suppkey"], F.col("bits")).withColumnsRenamed({"mean": "m", "variance": "v"})
    cl = c.groupBy("l_suppkey", "p_type").agg(F.count(F.lit(1)).alias("k"), F.sum("bits").alias("s"))
    bg = t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("b"))
    total = t.part.agg(F.count(F.lit(1)).alias("t"))
    out = cl.join(st, "l_suppkey").join(bg, "p_type").crossJoin(F.broadcast(total)).withColumnRenamed("l_suppkey", "q")
    return out.withColumn("gsz", S.gsz(F.col("n"), F.col("s"), F.col("m"), F.col("v"), F.col("b"), F.col("t")))


@query("q_gsz_by_class", _CLASS_SQL + "SELECT q, p_type, k, round(gsz, 5) AS gsz FROM g")
def gsz_by_class(t):
    return class_table(t).select("q", "p_type", "k", F.round("gsz", 5).alias("gsz"))


_SCORES = """r AS (SELECT q, p_type, k / CAST(b + n - k AS DOUBLE) AS jsc, s / (tb + 1.0) AS sh, b, t, k, n, gsz FROM g JOIN (SELECT q AS q2, sum(s) AS tb FROM cl GROUP BY 1) ON q = q2),
sc AS (SELECT q, p_type, greatest(0, 0.36 + 0.01 * ln(jsc) + 0.02 * (CASE WHEN gsz > 1 THEN 1 + ln(gsz) WHEN gsz < -1 THEN -1 - ln(-gsz) ELSE gsz END) - 3.67e-5 * sqrt(b) - 0.007 * sqrt(n)) AS rm3,
  sh * log2(t / CAST(b AS DOUBLE)) AS share, sh * jsc AS jac, b / CAST(t AS DOUBLE) AS bg, least(k / CAST(n AS DOUBLE), 0.99) AS voted FROM r)"""


def scored_classes(t: Tables) -> DataFrame:
    g = class_table(t)
    tb = g.groupBy("q").agg((F.sum("s") + 1.0).alias("tb"))
    s = S.class_scores(F.col("k"), F.col("b"), F.col("n"), F.col("s"), F.col("tb"), F.col("t"), F.col("gsz"))
    return g.join(tb, "q").select("q", "p_type", "k", "n", "b", "t", *[c.alias(name) for name, c in s.items()])


@query("q_class_scores", _CLASS_SQL + "," + _SCORES + " SELECT q, p_type, round(rm3, 6) AS rm3, round(share, 6) AS share, round(jac, 6) AS jac, round(bg, 6) AS bg, round(voted, 6) AS voted FROM sc")
def class_scores(t):
    return scored_classes(t).select("q", "p_type", *[F.round(c, 6).alias(c) for c in ("rm3", "share", "jac", "bg", "voted")])


@query(
    "q_class_rank",
    _CLASS_SQL + "," + _SCORES + """ SELECT q, p_type, round(ppv, 5) AS ppv, CAST(row_number() OVER (PARTITION BY q ORDER BY round(ppv, 9) DESC, p_type) AS INTEGER) AS rank FROM (
    SELECT *, CASE WHEN share < 0 THEN 0 WHEN sqrt(share) < 3.709538 THEN 0.3047 + 0.1452 * sqrt(share) ELSE least(1, 0.67302 + 0.04591 * sqrt(share)) END AS ppv FROM sc)""",
)
def class_rank(t):
    p = scored_classes(t).withColumn("ppv", S.ppv_share(F.col("share")))
    w = Window.partitionBy("q").orderBy(F.desc(F.round("ppv", 9)), "p_type")
    return p.select("q", "p_type", F.round("ppv", 5).alias("ppv"), F.row_number().over(w).alias("rank"))


@query("q_hyge")
def hyge(t):
    g = class_table(t)
    return g.select("q", "p_type", "k", F.round(S.hypergeometric_score("k", "t", "n", "b"), 6).alias("score"))


@query(
    "q_best_hit",
    f"WITH {HITS} SELECT l_orderkey, l_partkey, bits FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_BITS}) AS r FROM hits) WHERE r = 1",
)
def best_hit(t):
    return H.top(hits(t), ["l_orderkey"], by_bits()).select("l_orderkey", "l_partkey", "bits")


@query(
    "q_best_informative",
    f"""WITH {HITS}, x AS (SELECT h.*, p_name FROM hits h JOIN part ON p_partkey = l_partkey WHERE length(p_name) > 9)
    SELECT l_orderkey, p_name, bits FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_BITS}) AS r FROM x) WHERE r = 1""",
)
def best_informative(t):
    named = hits(t).join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey").filter(F.length("p_name") > 9)
    return H.top(named, ["l_orderkey"], by_bits()).select("l_orderkey", "p_name", "bits")


@query(
    "q_majority_vote",
    f"""WITH {HITS}, c AS (SELECT l_suppkey, p_brand FROM hits JOIN part ON p_partkey = l_partkey),
    v AS (SELECT l_suppkey, p_brand, count(*) AS votes FROM c GROUP BY ALL),
    r AS (SELECT *, sum(votes) OVER (PARTITION BY l_suppkey) AS total, row_number() OVER (PARTITION BY l_suppkey ORDER BY votes DESC, p_brand) AS k FROM v)
    SELECT l_suppkey, p_brand, votes, CAST(total AS BIGINT) AS total FROM r WHERE k = 1 AND votes > 0.05 * (1 + total)""",
)
def majority_vote(t):
    c = hits(t).join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return H.majority(c, ["l_suppkey"], "p_brand", 0.05).select("l_suppkey", "p_brand", "votes", "total")


@query(
    "q_taxon_vote",
    """WITH c AS (SELECT l_orderkey, n_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
    v AS (SELECT l_orderkey, n_name, count(*) AS count FROM c GROUP BY ALL),
    r AS (SELECT *, CAST(sum(count) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total, row_number() OVER (PARTITION BY l_orderkey ORDER BY count DESC, n_name) AS rank FROM v)
    SELECT l_orderkey, n_name, count, total, round(count / CAST(total AS DOUBLE), 6) AS frequency, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def taxon_vote(t):
    c = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return H.vote(c, ["l_orderkey"], "n_name", 3).withColumn("frequency", F.round("frequency", 6))


_PROFILE = f"""WITH {HITS},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY {SQL_BITS}) AS r FROM hits) WHERE r = 1),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_BITS}) AS k FROM f) WHERE k <= 5),
b AS (SELECT l_suppkey, l_partkey, l_orderkey, pide, CAST(floor((pide + 0.005) * 100 + 1e-9) AS INTEGER) AS bin FROM p)
"""


def profile(t: Tables) -> DataFrame:
    best = H.best_per(hits(t), ["l_orderkey"], "l_suppkey", by_bits(), 5)
    return best.withColumn("bin", H.identity_bin(F.col("pide")))


@query("q_profile_histogram", _PROFILE + "SELECT l_suppkey, bin, count(*) AS n FROM b GROUP BY ALL")
def profile_histogram(t):
    return H.histogram(profile(t), ["l_suppkey"], F.col("bin"))


@query(
    "q_profile_summary",
    _PROFILE + """, h AS (SELECT l_suppkey, bin, count(*) AS n FROM b GROUP BY ALL),
    c AS (SELECT *, sum(CASE WHEN bin > 0 THEN n ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY l_suppkey) AS tot FROM h),
    m AS (SELECT l_suppkey, coalesce(min(CASE WHEN cum >= tot / 2 THEN bin END), 100) AS median_bin FROM c GROUP BY 1),
    q AS (SELECT count(DISTINCT l_orderkey) AS nq FROM hits)
    SELECT l_suppkey, round(wsum, 4) AS wsum, total, targets, round(total / CAST(targets AS DOUBLE), 6) AS multiplicity, round(total / CAST(nq AS DOUBLE), 8) AS matched,
      round(wsum / total, 6) AS average, median_bin
    FROM (SELECT l_suppkey, sum(bin) / 100.0 AS wsum, count(*) AS total, count(DISTINCT l_partkey) AS targets FROM b GROUP BY 1) JOIN m USING (l_suppkey), q""",
)
def profile_summary(t):
    p = profile(t)
    median = H.histogram_median(H.histogram(p, ["l_suppkey"], F.col("bin")), ["l_suppkey"])
    sums = p.groupBy("l_suppkey").agg((F.sum("bin") / 100.0).alias("wsum"), F.count(F.lit(1)).alias("total"), F.count_distinct("l_partkey").alias("targets"))
    queries = hits(t).agg(F.count_distinct("l_orderkey").alias("nq"))
    x = sums.join(median, "l_suppkey").crossJoin(F.broadcast(queries))
    return x.select(
        "l_suppkey", F.round("wsum", 4).alias("wsum"), "total", "targets", F.round(F.col("total") / F.col("targets"), 6).alias("multiplicity"),
        F.round(F.col("total") / F.col("nq"), 8).alias("matched"), F.round(F.col("wsum") / F.col("total"), 6).alias("average"), "median_bin",
    )


@query(
    "q_profile_bidirectional",
    _PROFILE + ", m AS (SELECT l_suppkey, l_partkey, max(pide) AS pide FROM b GROUP BY ALL) SELECT l_suppkey, CAST(floor((pide + 0.005) * 100 + 1e-9) AS INTEGER) AS bin, count(*) AS n FROM m GROUP BY ALL",
)
def profile_bidirectional(t):
    best = profile(t).groupBy("l_suppkey", "l_partkey").agg(F.max("pide").alias("pide"))
    return H.histogram(best, ["l_suppkey"], H.identity_bin(F.col("pide")))


@query(
    "q_profile_weighted_lineage",
    _PROFILE + """SELECT l_suppkey, round(sum(pide + 0.005), 4) AS wsum, r_name || chr(9) || n_name AS path FROM b JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY l_suppkey, r_name, n_name""",
)
def profile_lineage(t):
    sums = profile(t).groupBy("l_suppkey").agg(F.sum(F.col("pide") + 0.005).alias("wsum"))
    return sums.join(lineages(t), "l_suppkey").select("l_suppkey", F.round("wsum", 4).alias("wsum"), F.array_join(L.ranks(F.col("lineage")), "\t").alias("path"))


_LINEAGE = "lin AS (SELECT s_suppkey AS l_suppkey, r_name || '; ' || n_name AS lineage FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"


def lineages(t: Tables) -> DataFrame:
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return s.select(F.col("s_suppkey").alias("l_suppkey"), F.concat_ws("; ", "r_name", "n_name").alias("lineage"))


@query(
    "q_identity_inspector",
    f"""WITH {HITS}, m AS (SELECT l_orderkey, l_suppkey, max(pide) AS pide FROM hits GROUP BY ALL)
    SELECT l_suppkey, CAST(floor(pide * 100 + 1e-9) AS INTEGER) AS bin, count(*) AS n FROM m GROUP BY ALL""",
)
def identity_inspector(t):
    best = hits(t).groupBy("l_orderkey", "l_suppkey").agg(F.max("pide").alias("pide"))
    return H.histogram(best, ["l_suppkey"], H.identity_bin(F.col("pide"), 0.0))


@query(
    "q_cluster_stats",
    f"""WITH {HITS}, c AS (SELECT h.*, p_type, p_name FROM hits h JOIN part ON p_partkey = l_partkey WHERE {OK}),
    bg AS (SELECT p_name, count(*) AS cnt FROM part GROUP BY 1),
    s AS (SELECT l_orderkey, p_type, count(*) AS size, sum(bits) AS bits FROM c GROUP BY ALL),
    f AS (SELECT DISTINCT ON (l_orderkey, p_name) l_orderkey, p_name, p_type FROM c ORDER BY l_orderkey, p_name, {SQL_BITS}),
    d AS (SELECT l_orderkey, p_type, sum(cnt) AS background FROM f JOIN bg USING (p_name) GROUP BY ALL)
    SELECT l_orderkey, p_type, size, round(bits, 4) AS bits, CAST(coalesce(background, 0) AS BIGINT) AS background FROM s LEFT JOIN d USING (l_orderkey, p_type)""",
)
def cluster_stats(t):
    c = classed(t)
    bg = t.part.groupBy("p_name").agg(F.count(F.lit(1)).alias("cnt"))
    sized = c.groupBy("l_orderkey", "p_type").agg(F.count(F.lit(1)).alias("size"), F.round(F.sum("bits"), 4).alias("bits"))
    owners = H.top(c, ["l_orderkey", "p_name"], by_bits())
    back = owners.join(bg, "p_name").groupBy("l_orderkey", "p_type").agg(F.sum("cnt").alias("background"))
    return sized.join(back, ["l_orderkey", "p_type"], "left").withColumn("background", F.coalesce("background", F.lit(0)))


@query(
    "q_blast2go",
    f"""WITH {HITS}, c AS (SELECT l_suppkey, p_brand, max(0.9 * pide * 100) AS top, count(*) AS n, max(bits) AS bits FROM hits JOIN part ON p_partkey = l_partkey WHERE {OK} GROUP BY ALL)
    SELECT l_suppkey, p_brand, round(top + 5 * (n - 1), 6) AS score, bits FROM c WHERE top + 5 * (n - 1) >= 95""",
)
def blast2go(t):
    c = classed(t).groupBy("l_suppkey", "p_brand").agg(F.max(0.9 * F.col("pide") * 100).alias("top"), F.count(F.lit(1)).alias("n"), F.max("bits").alias("bits"))
    score = F.col("top") + 5 * (F.col("n") - 1)
    return c.filter(score >= 95).select("l_suppkey", "p_brand", F.round(score, 6).alias("score"), "bits")


@query("q_unpivot_models", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, model, score FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME model VALUE score)")
def unpivot_models(t):
    return H.unpivot(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_quantity", "l_discount", "l_tax"], "model", "score")


@query(
    "q_max_models",
    f"WITH {HITS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, bits FROM (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY first) AS d FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey, l_suppkey) * 1000000 + l_suppkey AS first FROM hits WHERE bits >= 20000)) WHERE d <= 2",
)
def max_models(t):
    ok = hits(t).filter(F.col("bits") >= 20000)
    first = F.min("l_linenumber").over(Window.partitionBy("l_orderkey", "l_suppkey")) * 1000000 + F.col("l_suppkey")
    ranked = ok.withColumn("first", first).withColumn("d", F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy("first")))
    return ranked.filter("d <= 2").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "bits")


@query(
    "q_describe",
    _CLASS_SQL + ", b1 AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY gsz DESC, p_type) AS r FROM g) SELECT q, 'DE' AS type, p_type AS id, round(0.59 + 0.0004 * gsz, 6) AS score FROM b1 WHERE r = 1 UNION ALL SELECT q, 'original_DE', min(p_type), round(max(gsz), 6) FROM b1 GROUP BY q",
)
def describe(t):
    g = class_table(t)
    best = H.top(g, ["q"], [F.desc("gsz"), F.asc("p_type")])
    first = best.select("q", F.lit("DE").alias("type"), F.col("p_type").alias("id"), F.round(S.rm2(F.lit(0.0), F.lit(0.0), F.col("gsz")), 6).alias("score"))
    return first.unionByName(g.groupBy("q").agg(F.min("p_type").alias("id"), F.round(F.max("gsz"), 6).alias("score")).withColumn("type", F.lit("original_DE")))


@query(
    "q_naive_predictor",
    """WITH c AS (SELECT p_brand, count(*) / CAST((SELECT count(*) FROM part) AS DOUBLE) AS f FROM part GROUP BY 1)
    SELECT c_custkey AS qpid, p_brand AS goid, printf('%.2f', f) AS frequency, 'brand' AS ontology, lower(p_brand) AS description FROM customer, c WHERE f >= 0.01""",
)
def naive_predictor(t):
    """Every customer gets every brand that has a hundredth of the parts; brands are few and go as one argument."""
    total = t.part.count()
    counts = t.part.groupBy("p_brand").agg((F.count(F.lit(1)) / F.lit(float(max(1, total)))).alias("f")).filter("f >= 0.01")
    classes = sorted((r.p_brand, r.f, "brand", r.p_brand.lower()) for r in counts.collect())
    return U.naive(t.customer.select(F.col("c_custkey").alias("qpid")), "qpid", classes)


@query(
    "q_informative_hit_terms",
    f"""WITH {HITS}, x AS (SELECT h.*, CAST(l_suppkey AS VARCHAR) || '/' || l_linenumber AS spid, {OK} AS accepted, p_size / 50.0 AS ff, p_name, p_brand, p_type FROM hits h JOIN part ON p_partkey = l_partkey),
    d AS (SELECT l_orderkey, bits, p_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY bits DESC, spid) AS r FROM x WHERE accepted AND ff >= 0.2),
    a AS (SELECT l_orderkey, bits, p_brand, p_type, row_number() OVER (PARTITION BY l_orderkey ORDER BY bits DESC, spid) AS r FROM x WHERE accepted AND l_partkey % 3 = 0)
    SELECT o.l_orderkey, 'DE' AS kind, coalesce(bits, 0.0) AS bits, '' AS id, coalesce(p_name, 'No informative hits') AS text FROM (SELECT DISTINCT l_orderkey FROM x) o LEFT JOIN (SELECT * FROM d WHERE r = 1) d USING (l_orderkey)
    UNION ALL SELECT l_orderkey, 'brand', bits, p_brand, lower(p_brand) FROM a WHERE r = 1 UNION ALL SELECT l_orderkey, 'type', bits, p_type, lower(p_type) FROM a WHERE r = 1""",
)
def informative_hit_terms(t):
    """A block's first informative description, and the terms of its first annotated hit."""
    named = hits(t).join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_name", "p_brand", "p_type"), "l_partkey")
    term = lambda c, kind: F.struct(F.col(c).alias("id"), F.lit(kind).alias("ontology"), F.lower(c).alias("text"))
    terms = F.when(F.col("l_partkey") % 3 == 0, F.array(term("p_brand", "brand"), term("p_type", "type")))
    rows = named.select("l_orderkey", "bits", F.concat_ws("/", "l_suppkey", "l_linenumber").alias("spid"), accepted().alias("accepted"), (F.col("p_size") / 50.0).alias("ff"), F.col("p_name").alias("desc"), terms.alias("terms"))
    return U.best_informative(rows, "l_orderkey")
