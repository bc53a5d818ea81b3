"""Queries over intervals, ontologies, vectors and evaluation curves.

Intervals are a user's events, from their second on for as many minutes as
their value; an ontology is the tree in which a document's parent is half its
number; truth is quality and a score is the text's length."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnflow.functions import sequences as Q
from tarnflow.operators import clustering as C
from tarnflow.operators import evaluation as E
from tarnflow.operators import graph as G
from tarnflow.operators import intervals as I
from tarnflow.operators import windows as W

from .registry import Tables, query

IV = """iv AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS s, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + CAST(floor(value * 60) AS BIGINT) AS e, value FROM events)"""


def intervals(t: Tables):
    s = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("long") - 1704067200
    return t.events.select("event_id", "user_id", "event_type", s.alias("s"), (s + F.floor(F.col("value") * 60).cast("long")).alias("e"), "value")


def sides(t: Tables):
    iv = intervals(t)
    a = iv.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("a_id"), F.col("s").alias("a_start"), F.col("e").alias("a_end"))
    b = iv.filter("event_type <> 'click'").select("user_id", F.col("event_id").alias("b_id"), F.col("s").alias("b_start"), F.col("e").alias("b_end"))
    return a, b


_AB = f"WITH {IV}, a AS (SELECT user_id, event_id AS a_id, s AS a_start, e AS a_end FROM iv WHERE event_type = 'click'), b AS (SELECT user_id, event_id AS b_id, s AS b_start, e AS b_end FROM iv WHERE event_type <> 'click')"


@query("q_interval_overlap", _AB + " SELECT a_id, b_id FROM a JOIN b USING (user_id) WHERE b_start <= a_end AND b_end >= a_start")
def interval_overlap(t):
    a, b = sides(t)
    return I.overlap_join(a, b, ["user_id"], 7200, F.lit(True)).select("a_id", "b_id")


@query("q_interval_contain", _AB + " SELECT a_id, b_id FROM a JOIN b USING (user_id) WHERE b_start >= a_start AND b_end <= a_end")
def interval_contain(t):
    a, b = sides(t)
    return I.overlap_join(a, b, ["user_id"], 7200, I.contained()).select("a_id", "b_id")


@query("q_interval_proximity", _AB + " SELECT a_id, b_id FROM a JOIN b USING (user_id) WHERE abs(a_start - b_start) <= 1800 OR abs(a_end - b_end) <= 1800")
def interval_proximity(t):
    a, b = sides(t)
    return I.overlap_join(a, b, ["user_id"], 7200, I.near_ends(1800), reach=1800).select("a_id", "b_id")


@query("q_interval_bin_count", f"WITH {IV} SELECT bin, count(*) AS n FROM (SELECT unnest(range(CAST(floor(s / 3600.0) AS BIGINT), CAST(floor(e / 3600.0) AS BIGINT) + 1)) AS bin FROM iv) GROUP BY 1")
def interval_bin_count(t):
    return I.with_bins(intervals(t), F.col("s"), F.col("e"), 3600).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


_ISLANDS = f"""WITH {IV}, m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM iv),
i AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, event_id) AS island FROM m)"""


@query("q_interval_union", _ISLANDS + " SELECT user_id, CAST(island AS BIGINT) AS island, min(s) AS s, max(e) AS e, count(*) AS members, bit_or(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 ELSE 4 END) AS source FROM i GROUP BY user_id, island")
def interval_union(t):
    iv = intervals(t).withColumn("source", F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", 2).otherwise(4))
    return I.merge(iv, ["user_id"], "s", "e", ["event_id"], "source")


@query("q_suppress_chain")
def suppress_chain(t):
    return I.suppress(intervals(t), ["user_id"], "event_id", "s", "e", "value")


@query("q_interval_pairs")
def interval_pairs(t):
    a, b = sides(t)
    return I.pair_one_to_one(a, b, ["user_id"])


@query("q_flank_windows", f"WITH {IV} SELECT event_id, greatest(1, s - 100) AS lo, least(2592000, e + 100) AS hi FROM iv")
def flank_windows(t):
    lo, hi = I.windows_around(F.col("s"), F.col("e"), 100, F.lit(2592000).cast("long"))
    return intervals(t).select("event_id", lo.cast("long").alias("lo"), hi.alias("hi"))


@query("q_upstream", f"WITH {IV}, g AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN s ELSE e END AS a, CASE WHEN event_id % 2 = 0 THEN e ELSE s END AS z FROM iv WHERE e > s) SELECT event_id, CASE WHEN a < z THEN a - 25 ELSE a + 25 END AS u1, CASE WHEN a < z THEN a - 6 ELSE a + 6 END AS u2 FROM g")
def upstream(t):
    g = intervals(t).filter("e > s").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("s")).otherwise(F.col("e")).alias("a"), F.when(F.col("event_id") % 2 == 0, F.col("e")).otherwise(F.col("s")).alias("z"))
    u1, u2 = Q.upstream(F.col("a"), F.col("z"), 5, 20)
    return g.select("event_id", u1.alias("u1"), u2.alias("u2"))


@query("q_coord_lift", f"WITH {IV} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1000000 + s - 1 ELSE 9000000 - e + 1 END AS g1, CASE WHEN event_id % 2 = 0 THEN 1000000 + e - 1 ELSE 9000000 - s + 1 END AS g2 FROM iv")
def coord_lift(t):
    strand = F.when(F.col("event_id") % 2 == 0, "+").otherwise("-")
    g1, g2 = Q.lift(F.col("s"), F.col("e"), F.lit(1000000).cast("long"), F.lit(9000000).cast("long"), strand)
    return intervals(t).select("event_id", g1.alias("g1"), g2.alias("g2"))


@query(
    "q_islands_runs",
    """WITH p AS (SELECT user_id, event_type <> 'click' AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
    r AS (SELECT user_id, p, p - row_number() OVER (PARTITION BY user_id ORDER BY p) AS run FROM p WHERE f)
    SELECT user_id, CAST(min(p) AS INTEGER) AS first, CAST(max(p) AS INTEGER) AS last, count(*) AS length FROM r GROUP BY user_id, run HAVING count(*) >= 5""",
)
def islands_runs(t):
    return I.runs(t.events, ["user_id"], ["ts", "event_id"], F.col("event_type") != "click", 5)


@query(
    "q_derivative",
    f"""WITH {IV}, d AS (SELECT *, lag(s) OVER w AS s0, lead(s) OVER w AS s1, lag(value) OVER w AS v0, lead(value) OVER w AS v1 FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id))
    SELECT event_id, round(coalesce((coalesce(v1, value) - coalesce(v0, value)) / nullif(coalesce(s1, s) - coalesce(s0, s), 0), 0), 6) + 0.0 AS slope FROM d""",
)
def derivative(t):
    return W.derivative(intervals(t), ["user_id"], "s", "value", ["event_id"]).select("event_id", (F.round(F.coalesce("slope", F.lit(0.0)), 6) + 0.0).alias("slope"))


@query(
    "q_smooth_exponential",
    """WITH RECURSIVE p AS (SELECT user_id, ts, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
    r(user_id, event_id, p, s) AS (SELECT user_id, event_id, p, value FROM p WHERE p = 1 UNION ALL SELECT p.user_id, p.event_id, p.p, CAST(0.75 AS DOUBLE) * r.s + CAST(0.25 AS DOUBLE) * p.value FROM r JOIN p ON p.user_id = r.user_id AND p.p = r.p + 1)
    SELECT event_id, CAST(s AS DOUBLE) AS smoothed FROM r""",
)
def smooth_exponential(t):
    return W.smooth(t.events, "user_id", ["ts", "event_id"], "value", 0.75).select("event_id", "smoothed")


def tree(t: Tables):
    return t.documents.filter("doc_id > 0").select(F.col("doc_id").alias("child"), F.floor(F.col("doc_id") / 2).alias("parent"))


_UP = "up AS (SELECT doc_id AS node, doc_id AS ancestor, 0 AS distance FROM documents UNION ALL SELECT node, ancestor // 2, distance + 1 FROM up WHERE ancestor > 0)"


def closure(t: Tables):
    return G.ancestors(tree(t), "child", "parent", t.documents.select("doc_id"))


@query("q_closure", f"WITH RECURSIVE {_UP} SELECT node, ancestor FROM up")
def q_closure(t):
    return closure(t).select("node", "ancestor")


@query("q_closure_depth", f"WITH RECURSIVE {_UP} SELECT node, max(distance) AS depth, count(*) AS n FROM up GROUP BY node")
def closure_depth(t):
    return closure(t).groupBy("node").agg(F.max("distance").alias("depth"), F.count(F.lit(1)).alias("n"))


@query("q_propagate", f"WITH RECURSIVE {_UP}, a AS (SELECT toxic AS acc, doc_id AS term FROM labels WHERE quality = 0) SELECT DISTINCT acc, ancestor AS term FROM a JOIN up ON node = term")
def propagate(t):
    a = t.labels.filter("quality = 0").select(F.col("toxic").alias("acc"), F.col("doc_id").alias("term"))
    return G.propagate(a, closure(t), "acc", "term")


@query("q_propagate_weight", f"WITH RECURSIVE {_UP}, a AS (SELECT quality AS acc, l.doc_id AS term, n_chars AS w FROM labels l JOIN documents d ON d.doc_id = l.doc_id) SELECT acc, ancestor AS term, max(w) AS w FROM a JOIN up ON node = term GROUP BY ALL")
def propagate_weight(t):
    a = t.labels.join(t.documents, "doc_id").select(F.col("quality").alias("acc"), F.col("doc_id").alias("term"), F.col("n_chars").alias("w"))
    return G.propagate_weight(a, closure(t), "acc", "term", "w")


_IC = """c AS (SELECT ancestor AS term, count(*) AS count FROM up GROUP BY 1), pc AS (SELECT term, (SELECT count FROM c p WHERE p.term = c.term // 2) AS parent_count FROM c),
ic AS (SELECT term, count, parent_count, greatest(0, -log2((count + 1) / CAST(parent_count + 1 AS DOUBLE))) AS ic FROM c JOIN pc USING (term))"""


def information(t: Tables, up):
    counts = up.groupBy(F.col("ancestor").alias("term")).agg(F.count(F.lit(1)).alias("count"))
    parents = counts.select(F.col("term").alias("pt"), F.col("count").alias("parent_count"))
    pc = counts.select("term", F.floor(F.col("term") / 2).alias("pt")).join(parents, "pt").select("term", "parent_count")
    return G.information_content(counts, pc, "term")


@query("q_information_content", f"WITH RECURSIVE {_UP}, {_IC} SELECT term, count, parent_count, round(ic, 6) AS ic FROM ic")
def information_content(t):
    return information(t, closure(t)).withColumn("ic", F.round("ic", 6))


_PAIRS = "p AS (SELECT doc_id AS a, doc_id + 1 AS b FROM documents WHERE doc_id + 1 IN (SELECT doc_id FROM documents))"


def next_pairs(t: Tables):
    ids = t.documents.select((F.col("doc_id") - 1).alias("a"))
    return t.documents.select(F.col("doc_id").alias("a")).join(ids, "a", "left_semi").select("a", (F.col("a") + 1).alias("b"))


@query(
    "q_jaccard_terms",
    f"WITH RECURSIVE {_UP}, {_PAIRS}, s AS (SELECT node, list(ancestor) AS l FROM up GROUP BY 1) SELECT a, b, round(len(list_intersect(x.l, y.l)) / CAST(len(x.l) + len(y.l) - len(list_intersect(x.l, y.l)) AS DOUBLE), 6) AS jaccard FROM p JOIN s x ON x.node = a JOIN s y ON y.node = b",
)
def jaccard_terms(t):
    return G.jaccard_terms(next_pairs(t), closure(t), "a", "b").withColumn("jaccard", F.round("jaccard", 6))


@query(
    "q_lin",
    f"""WITH RECURSIVE {_UP}, {_PAIRS}, {_IC}, m AS (SELECT p.a, p.b, max(ic) AS shared FROM p JOIN up x ON x.node = p.a JOIN up y ON y.node = p.b AND y.ancestor = x.ancestor JOIN ic ON term = x.ancestor GROUP BY ALL)
    SELECT p.a, p.b, round(coalesce(2 * shared / nullif(i.ic + j.ic, 0), 0), 6) AS lin FROM p LEFT JOIN m ON m.a = p.a AND m.b = p.b LEFT JOIN ic i ON i.term = p.a LEFT JOIN ic j ON j.term = p.b""",
)
def lin(t):
    up = closure(t)
    return G.lin(next_pairs(t), up, information(t, up).select("term", "ic"), "a", "b").withColumn("lin", F.round("lin", 6))


@query("q_components", "SELECT u AS node, min(u) OVER (PARTITION BY g) AS component FROM (SELECT DISTINCT u, u % 17 AS g FROM (SELECT doc_id AS u FROM documents WHERE doc_id >= 17 UNION SELECT doc_id - 17 FROM documents WHERE doc_id >= 17))")
def components(t):
    e = t.documents.filter("doc_id >= 17").select(F.col("doc_id").alias("a"), (F.col("doc_id") - 17).alias("b"))
    return G.components(e, "a", "b")


@query("q_roots_leaves", "SELECT doc_id AS node, 'leaf' AS kind FROM documents WHERE doc_id > 0 AND doc_id NOT IN (SELECT doc_id // 2 FROM documents WHERE doc_id > 0) UNION ALL SELECT 0, 'root'")
def roots_leaves(t):
    leaves = G.unlinked(tree(t), "child", "parent", True).withColumn("kind", F.lit("leaf"))
    return leaves.unionByName(G.unlinked(tree(t), "child", "parent", False).withColumn("kind", F.lit("root")))


@query("q_greedy_nonredundant")
def greedy_nonredundant(t):
    ranked = t.documents.select((F.col("doc_id") % 7).alias("block"), "doc_id", (-F.col("n_chars")).alias("rank"))
    return G.non_redundant(ranked, closure(t), "block", "doc_id", "rank")


@query(
    "q_cosine",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings) SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 5) AS cosine FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""",
)
def cosine(t):
    a = t.embeddings.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    b = t.embeddings.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, "a").select("a", "b", F.round(C.cosine(F.col("x"), F.col("y")), 5).alias("cosine"))


@query("q_cluster_average")
def cluster_average(t):
    return C.cluster(t.embeddings.withColumn("block", F.floor(F.col("vec_id") / 50)), "block", "vec_id", "embedding", 0.7)


_EVAL = """j AS (SELECT CAST(n_chars // 500 AS BIGINT) AS tau, quality = 1 AS hit, 1.0 + l.doc_id % 3 AS w FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
t AS (SELECT count(*) FILTER (hit) AS t, sum(w) FILTER (hit) AS wt FROM j), g AS (SELECT tau, count(*) FILTER (hit) AS tp, count(*) AS p, coalesce(sum(w) FILTER (hit), 0) AS wtp, sum(w) AS wp FROM j GROUP BY 1),
c AS (SELECT tau, sum(tp) OVER w AS tp, sum(p) OVER w AS p, CAST(sum(wtp) OVER w AS DOUBLE) AS wtp, CAST(sum(wp) OVER w AS DOUBLE) AS wp, t, CAST(wt AS DOUBLE) AS wt FROM g, t WINDOW w AS (ORDER BY tau DESC)),
m AS (SELECT tau, 2.0 * tp / (t + p) AS f, 2 * wtp / (wt + wp) AS wf, 1.0 * tp / (t + p - tp) AS jacc, wtp / (wt + wp - wtp) AS wjacc, sqrt((wt - wtp) * (wt - wtp) + (wp - wtp) * (wp - wtp)) AS s FROM c)"""


def measured(t: Tables):
    j = t.labels.join(t.documents, "doc_id").select(F.floor(F.col("n_chars") / 500).alias("tau"), (F.col("quality") == 1).alias("hit"), (1.0 + F.col("doc_id") % 3).alias("w"))
    truth = j.agg(F.count_if("hit").alias("t"), F.sum(F.when(F.col("hit"), F.col("w"))).alias("wt"))
    return E.measures(E.curve(j, truth, "tau", "hit", "w"))


@query("q_eval_curve", f"WITH {_EVAL} SELECT tau, round(f, 6) AS f, round(wf, 6) AS wf, round(s, 4) AS s FROM m")
def eval_curve(t):
    return measured(t).select("tau", F.round("f", 6).alias("f"), F.round("wf", 6).alias("wf"), F.round("s", 4).alias("s"))


@query("q_eval_fmax", f"WITH {_EVAL} SELECT round(max(f), 6) AS fmax, round(max(wf), 6) AS wfmax, round(max(jacc), 6) AS jaccmax, round(max(wjacc), 6) AS wjaccmax FROM m")
def eval_fmax(t):
    return E.best(measured(t)).select(*[F.round(c, 6).alias(c) for c in ("fmax", "wfmax", "jaccmax", "wjaccmax")])


@query("q_eval_smin", f"WITH {_EVAL} SELECT round(min(s), 4) AS smin FROM m")
def eval_smin(t):
    return E.best(measured(t)).select(F.round("smin", 4).alias("smin"))
