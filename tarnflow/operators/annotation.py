"""Named operators on the sheets of an annotation run.

data: hits (qpid, spid, bits, qcov, scov, pide, lali, desc, species, ...);
dictionaries are sheets too: lineage (species, lineage), terms (spid, goid,
ontology), background (goid, count, ontology, root), words (word, cnt).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnflow.functions import lineage as L
from tarnflow.functions import scores as S
from tarnflow.functions import text as X
from tarnflow.params import Params

from . import clustering as C
from . import graph as G
from . import hits as H
from . import joins as J
from .registry import Sheets, operator


def _order():
    return [F.desc_nulls_last(F.expr("try_cast(bits AS DOUBLE)")), F.asc("spid")]


@operator("identity")
def identity(sheets: Sheets, p: Params) -> Sheets:
    """Changes nothing: for reading one format and writing another."""
    return {}


@operator("filter", needs=("qcov", "scov", "pide", "lali", "bits", "spid"))
def filter_(sheets: Sheets, p: Params) -> Sheets:
    rule = H.HitRule(p.query_coverage, p.subject_coverage, p.least_identity, p.most_identity, p.long_alignment, p.strict)
    ok = H.accepted(F.col("qcov"), F.col("scov"), F.col("pide"), F.col("lali"), rule)
    return {"data": H.first_accepted(sheets["data"], [p.block_column], _order(), F.coalesce(ok, F.lit(False)), p.max_hits)}


@operator("form_factor", needs=("desc",))
def form_factor(sheets: Sheets, p: Params) -> Sheets:
    return {"data": sheets["data"].withColumn("ff", X.form_factor(F.col("desc")))}


@operator("description_status", needs=("status", "ff"))
def description_status(sheets: Sheets, p: Params) -> Sheets:
    return {"data": sheets["data"].withColumn("de_status", F.col("status") & (F.col("ff") >= p.form_factor))}


@operator("clean_description", needs=("desc",))
def clean(sheets: Sheets, p: Params) -> Sheets:
    return {"data": sheets["data"].withColumn("plain", X.clean_description(F.col("desc")))}


@operator("lineage", needs=("species",))
def lineage(sheets: Sheets, p: Params) -> Sheets:
    return {"data": J.lookup(sheets["data"], F.col("species"), sheets["lineage"].select(F.col("species").alias("__s"), "lineage"), "__s", {"lineage": "unclassified"}, upper=True)}


@operator("genus", needs=("lineage",))
def genus(sheets: Sheets, p: Params) -> Sheets:
    return {"data": sheets["data"].withColumns({"taxon": L.genus(F.col("lineage")), "kingdom": L.kingdom(F.col("lineage"))})}


@operator("taxonomic_distance", needs=("lineage", "bits", "spid"))
def taxonomic_distance(sheets: Sheets, p: Params) -> Sheets:
    """From each hit to the block's first classified lineage."""
    w = Window.partitionBy(p.block_column).orderBy(*_order()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.when(F.col("lineage") != "unclassified", F.col("lineage"))
    first = F.first(known, ignorenulls=True).over(w)
    path = F.coalesce(L.path_length(first, F.col("lineage")), F.lit(69))
    return {"data": sheets["data"].withColumn("taxdist", L.corrected_distance(path))}


@operator("rm1", needs=("qcov", "scov", "pide", "taxdist", "status"))
def rm1(sheets: Sheets, p: Params) -> Sheets:
    return {"data": sheets["data"].withColumn("rm1", S.rm1(F.col("qcov"), F.col("scov"), F.col("pide"), F.col("taxdist"), F.col("status")))}


@operator("words", needs=("desc",))
def words(sheets: Sheets, p: Params) -> Sheets:
    split = F.filter(F.split(X.clean_description(F.col("desc")), r"\s+"), lambda w: w != "")
    return {"data": sheets["data"].withColumn("word", F.coalesce(split, F.array().cast("array<string>")))}


@operator("word_scores", needs=("word", "bits", "spid", "de_status"))
def word_scores(sheets: Sheets, p: Params) -> Sheets:
    d = sheets["data"]
    s = H.word_scores(d, p.block_column, "spid", F.col("word"), F.col("bits").cast("double"), F.col("de_status"), sheets["words"], p.least_word_count)
    return {"data": d.join(s, [p.block_column, "spid"])}


@operator("tfidf", needs=("word", "spid"))
def tfidf(sheets: Sheets, p: Params) -> Sheets:
    """A map from a hit's words to their idf; unknown words count once, as in
    word_scores."""
    q, d = p.block_column, sheets["data"]
    total = F.broadcast(sheets["words"].agg(F.sum("cnt").cast("double").alias("total")))
    each = d.select(q, "spid", F.explode(F.array_distinct("word")).alias("w")).join(sheets["words"].select(F.col("word").alias("w"), "cnt"), "w", "left").crossJoin(total)
    idf = F.log(F.col("total") / F.greatest(F.coalesce("cnt", F.lit(1)), F.lit(1)))
    vectors = each.groupBy(q, "spid").agg(F.map_from_entries(F.collect_list(F.struct("w", F.coalesce(idf, F.lit(0.0))))).alias("termidf"))
    return {"data": d.join(vectors, [q, "spid"], "left").withColumn("termidf", F.coalesce("termidf", F.create_map().cast("map<string,double>")))}


@operator("clustering", needs=("termidf", "spid"))
def clustering(sheets: Sheets, p: Params) -> Sheets:
    """Average linkage of all of a block's hits by the cosine of their idf
    vectors, cut at cluster_cut."""
    q, d = p.block_column, sheets["data"]
    ids = C.cluster_maps(d.select(q, "spid", "termidf"), q, "spid", "termidf", p.cluster_cut)
    return {"data": d.join(ids, [q, "spid"])}


@operator("terms", needs=("status", "spid"))
def terms(sheets: Sheets, p: Params) -> Sheets:
    """Terms of accepted hits, one row each."""
    d = sheets["data"].filter("status").withColumn("acc", X.split_accession(F.col("spid")))
    t = sheets["terms"].select(F.col("spid").alias("acc"), "goid")
    return {"hit_terms": d.join(t, "acc")}


@operator("class_scores", sheet="hit_terms", needs=("goid", "bits", "rm1"))
def class_scores(sheets: Sheets, p: Params) -> Sheets:
    """All predictors of each term of a block, with precision and rank within
    the ontology; roots of an ontology are left out."""
    h, q = sheets["hit_terms"], p.block_column
    bits = F.col("bits").cast("double")
    with_terms = h.select(q, "spid", "rm1", bits.alias("bits")).distinct()
    block = with_terms.groupBy(q).agg(F.count(F.lit(1)).alias("n"), F.avg("rm1").alias("m"), F.var_pop("rm1").alias("v"), (F.sum("bits") + 1.0).alias("total_bits"))
    per = h.groupBy(q, "goid").agg(F.count(F.lit(1)).alias("k"), F.sum("rm1").alias("score"), F.sum(bits).alias("bits"))
    back = sheets["background"].select("goid", "ontology", F.greatest("count", F.lit(1)).alias("b"), "root")
    x = per.join(block, q).join(back, "goid").filter(F.col("b") != F.col("root"))
    x = x.withColumn("gsz", S.gsz(F.col("n"), F.col("score"), F.col("m"), F.col("v"), F.col("b"), F.col("root")))
    s = S.class_scores(F.col("k"), F.col("b"), F.col("n"), F.col("bits"), F.col("total_bits"), F.col("root"), F.col("gsz"))
    x = x.withColumns({f"{k}_score": c for k, c in s.items()})
    x = x.withColumn("hyge_score", S.hypergeometric_score("k", "root", "n", "b"))
    ppv = {"rm3": S.ppv_rm3, "share": S.ppv_share, "jac": S.ppv_jaccard, "hyge": S.ppv_hypergeometric}
    x = x.withColumns({f"{k}_ppv": f(F.col(f"{k}_score")) for k, f in ppv.items()} | {"voted_ppv": F.col("voted_score"), "bg_ppv": F.col("bg_score")})
    rank = lambda k: F.row_number().over(Window.partitionBy(q, "ontology").orderBy(F.desc(f"{k}_ppv"), F.asc("goid")))
    return {"term_scores": x.withColumns({f"{k}_rank": rank(k) for k in (*ppv, "voted", "bg")}).drop("m", "v", "total_bits")}


@operator("remove_redundant", sheet="term_scores", needs=("goid", "share_rank"))
def remove_redundant(sheets: Sheets, p: Params) -> Sheets:
    """Of each block's and predictor's terms in order of rank, those that are
    neither above nor below a better one; terms without a parent (roots) go.
    The sheet closure has node, ancestor and distance."""
    g, q = sheets["term_scores"], p.block_column
    up = sheets["closure"]
    inner = g.join(up.filter("distance > 0").select(F.col("node").alias("goid")).distinct(), "goid", "left_semi")
    names = [c.removesuffix("_rank") for c in g.columns if c.endswith("_rank")]
    # Ranks are within an ontology; terms of different ones aren't related.
    long = inner.unpivot([q, "ontology", "goid"], [f"{n}_rank" for n in names], "predictor", "place").withColumn("predictor", F.regexp_replace("predictor", "_rank$", ""))
    own = long.withColumn("run", F.concat_ws("\x1f", q, "ontology", "predictor"))
    chosen = G.non_redundant(own, up, "run", "goid", "place")
    back = own.select("run", q, "predictor").distinct()
    return {"chosen": chosen.join(back, "run").select(q, "predictor", "goid")}


@operator("iterative_terms", needs=("spid", "bits", "pide", "status"))
def iterative_terms(sheets: Sheets, p: Params) -> Sheets:
    """Term scores by weight times identity with a bonus for further hits; the
    sheet terms has a weight here."""
    q = p.block_column
    d = sheets["data"].filter("status").withColumn("acc", X.split_accession(F.col("spid")))
    t = sheets["terms"].select(F.col("spid").alias("acc"), F.col("goid").alias("term"), "weight")
    back = sheets["background"].select(F.col("goid").alias("term"), "ontology", "count", "root")
    above = sheets["closure"].filter("distance > 0").select(F.col("node").alias("term"), "ancestor")
    return {"iterative": H.iterative_terms(d, q, "acc", F.col("pide"), F.col("bits").cast("double"), _order(), t, above, back, p.max_hits)}


@operator("summary", sheet="term_scores", needs=("goid", "share_score"))
def summary(sheets: Sheets, p: Params) -> Sheets:
    """One long table: descriptions, then terms by predictor, with EC and KEGG
    rows where the external map has them; scores above 0 only, and where
    redundant terms were removed, those that are left."""
    q = p.block_column
    g = sheets["term_scores"]
    parts = []
    for k in ("rm3", "share", "jac", "hyge"):
        some = g
        if "chosen" in sheets:
            some = g.join(sheets["chosen"].filter(F.col("predictor") == k).select(q, "goid"), [q, "goid"], "left_semi")
        parts.append(some.filter(F.col(f"{k}_score") > 0).select(q, F.concat_ws("_", "ontology", F.lit(k.upper())).alias("type"), F.col(f"{k}_score").alias("score"), F.col(f"{k}_ppv").alias("ppv"), F.col("goid").alias("id")))
    if "external" in sheets:
        e = sheets["external"].select("goid", "kind", F.col("id").alias("external_id"))
        parts.append(g.filter("share_score > 0").join(e, "goid").select(q, F.concat(F.upper("kind"), F.lit("_SHARE")).alias("type"), F.col("share_score").alias("score"), F.col("share_ppv").alias("ppv"), F.col("external_id").alias("id")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    if "iterative" in sheets:
        it = sheets["iterative"]
        parts_of = it.select(q, F.concat_ws("_", "ontology", F.lit("ITERATIVE")).alias("type"), "score", F.lit(0.5).alias("ppv"), F.col("term").alias("id"))
        out = out.unionByName(parts_of)
    if "cluster" in sheets:
        c = sheets["cluster"]
        out = out.unionByName(c.select(q, F.lit("DE").alias("type"), F.col("rm2").alias("score"), S.ppv_description(F.col("rm2")).alias("ppv"), F.col("desc").alias("id")))
    return {"findings": out}


def _scored_clusters(sheets: Sheets, p: Params):
    """A block's clusters with their sizes, sums, most informative description
    and scores.  A cluster's size in the background is the sum of its different
    descriptions' counts."""
    q, d = p.block_column, sheets["data"].filter("de_status")
    block = H.sample_statistics(d, [q], F.col("rm1"))
    n_all = sheets["descriptions"].agg(F.sum("cnt").alias("all"))
    informs = F.struct("ff", F.col("bits").cast("double"), "desc")
    c = d.groupBy(q, "clusid").agg(
        F.count(F.lit(1)).alias("size"), F.sum("rm1").alias("rm1sum"), F.avg("value").alias("val"), F.avg("jaccard").alias("jac"), F.max_by("desc", informs).alias("desc"), F.max_by("plain", informs).alias("plain")
    )
    kinds = J.lookup(d.select(q, "clusid", "plain").distinct(), F.col("plain"), sheets["descriptions"].select(F.col("plain").alias("__d"), "cnt"), "__d", {"cnt": 1})
    c = c.join(kinds.groupBy(q, "clusid").agg(F.sum("cnt").alias("cnt")), [q, "clusid"]).join(block, q).crossJoin(F.broadcast(n_all))
    c = c.withColumn("gsz", S.gsz(F.col("n"), F.col("rm1sum"), F.col("mean"), F.col("variance"), F.col("cnt"), F.col("all")))
    return c.withColumn("rm2", S.rm2(F.col("val"), F.col("jac"), F.col("gsz"))).drop("all", "mean", "variance")


_CLUSTER_NEEDS = ("de_status", "value", "jaccard", "ff", "plain", "rm1", "clusid")


@operator("best_description", needs=_CLUSTER_NEEDS)
def best_description(sheets: Sheets, p: Params) -> Sheets:
    """Keeps a block's best cluster with its most informative description."""
    c = _scored_clusters(sheets, p)
    return {"cluster": H.top(c, [p.block_column], [F.desc("rm2"), F.asc("plain"), F.asc("clusid")]).drop("rank")}


@operator("query_rows", needs=("isquery", "desc", "qseq"))
def query_rows(sheets: Sheets, p: Params) -> Sheets:
    """Takes the query's own row out of each block: the sheet queries has its
    description and sequence (empty where a block has no such row)."""
    q, d = p.block_column, sheets["data"]
    own = F.coalesce(F.col("isquery").cast("string").isin("1", "true"), F.lit(False))
    kept = d.filter(own).groupBy(q).agg(F.min(F.struct("spid", F.trim("desc").alias("desc"), F.trim("qseq").alias("qseq"))).alias("x")).select(q, "x.desc", "x.qseq")
    blocks = d.select(q).distinct().join(kept, q, "left")
    return {"queries": blocks.select(q, *[F.coalesce(c, F.lit("")).alias(c) for c in ("desc", "qseq")]), "data": d.filter(~own)}


@operator("clusters", needs=(*_CLUSTER_NEEDS, "genename"))
def clusters(sheets: Sheets, p: Params) -> Sheets:
    """All of a block's clusters by rank of rm2.  Clusters that are all of their
    background say nothing and go, as do those without score or hits.  Each has
    the block's gene name: the commonest among its described hits, database ids
    left out, if it has more than half of one plus all names; else empty."""
    q = p.block_column
    c = _scored_clusters(sheets, p).filter((F.col("size") != F.col("cnt")) & (F.col("rm1sum") != 0) & (F.col("size") > 0))
    named = sheets["data"].filter("de_status").filter((F.col("genename") != "") & H.plain_symbol(F.col("genename")))
    gene = H.majority(named, [q], "genename").select(q, "genename")
    ranked = c.join(gene, q, "left").withColumn("genename", F.coalesce("genename", F.lit("")))
    return {"clusters": ranked.withColumn("rank", F.row_number().over(Window.partitionBy(q).orderBy(F.desc("rm2"), F.asc("plain"), F.asc("clusid"))))}


@operator("best_cluster", needs=("clusid", "status"))
def best_cluster(sheets: Sheets, p: Params) -> Sheets:
    """Accepts only the hits of a block's best cluster, for the terms; a block
    without a cluster that scores above 0 keeps none."""
    q = p.block_column
    best = sheets["clusters"].filter("rank = 1 and rm2 > 0").select(q, F.col("clusid").alias("__best"))
    d = sheets["data"].join(best, q, "left")
    return {"data": d.withColumn("status", F.coalesce(F.col("clusid") == F.col("__best"), F.lit(False))).drop("__best")}


@operator("annotation_rows", sheet="queries", needs=("desc", "qseq"))
def annotation_rows(sheets: Sheets, p: Params) -> Sheets:
    """The whole annotation, one finding a row: (block, type, score, ppv, id,
    desc), all text, 'n.d.' where a type has no such value.

    original_DE (kingdom, form factor, the query's description), qseq, DE (rm2, by
    the kingdom's curve, form factor) and GN of the clusters (of the best one
    alone with best_cluster_only), and each predictor's terms that score above 0
    and, where the sheet chosen says so, aren't redundant, with EC and KEGG rows
    from the sheet external.  A block is eukaryote if its lineage, the first
    classified one of its hits, holds Eukaryota.  Blocks without hits have no
    rows.  The sheet term_names (goid, name) gives terms their descriptions."""
    q, none = p.block_column, F.lit("n.d.")
    d = sheets["data"]
    known = F.when(F.col("lineage") != "unclassified", F.col("lineage"))
    first = d.withColumn("__k", known).filter("__k is not null").groupBy(q).agg(F.min_by("__k", F.struct(-F.expr("coalesce(try_cast(bits AS DOUBLE), -1e300)"), "spid")).alias("lin"))
    kingdom = F.when(F.coalesce(F.col("lin").contains("Eukaryota"), F.lit(False)), "euk").otherwise("bac")
    blocks = sheets["queries"].join(d.select(q).distinct(), q, "left_semi").join(first, q, "left").withColumn("kingdom", kingdom)

    def rows(df, kind, score, ppv, id_, desc):
        return df.select(q, kind.alias("type"), score.cast("string").alias("score"), ppv.cast("string").alias("ppv"), id_.cast("string").alias("id"), desc.alias("desc"))

    out = [rows(blocks, F.lit("original_DE"), F.col("kingdom"), none, X.form_factor(F.col("desc")), F.col("desc")), rows(blocks, F.lit("qseq"), none, none, none, F.col("qseq"))]
    c = sheets["clusters"].join(blocks.select(q, "kingdom"), q)
    c = c.filter("rank = 1") if p.best_cluster_only else c
    out.append(rows(c, F.lit("DE"), F.col("rm2"), S.ppv_description(F.col("rm2"), F.col("kingdom") == "euk"), X.form_factor(F.col("desc")), F.col("desc")))
    out.append(rows(c.filter("genename <> ''"), F.lit("GN"), none, none, none, F.col("genename")))

    g = sheets["term_scores"]
    g = g.join(sheets["term_names"].select("goid", "name"), "goid", "left") if "term_names" in sheets else g.withColumn("name", F.col("goid"))
    for k in p.predictors:
        some = g.join(sheets["chosen"].filter(F.col("predictor") == k).select(q, "goid"), [q, "goid"], "left_semi") if "chosen" in sheets else g
        some = some.filter(F.col(f"{k}_score") > 0)
        score, ppv = F.col(f"{k}_score"), F.col(f"{k}_ppv")
        out.append(rows(some, F.concat_ws("_", "ontology", F.lit(k.upper())), score, ppv, F.col("goid"), F.coalesce("name", F.lit(""))))
        if "external" in sheets:
            e = sheets["external"].filter("id <> '.'").select("goid", "kind", F.col("id").alias("external_id"))
            out.append(rows(some.join(e, "goid"), F.concat(F.upper("kind"), F.lit(f"_{k.upper()}")), score, ppv, F.col("external_id"), F.concat(F.lit("GO:"), "goid")))
    anno = out[0]
    for x in out[1:]:
        anno = anno.unionByName(x)
    return {"anno": anno}


#: Plans by name.
DESCRIBE = ["filter", "form_factor", "description_status", "clean_description", "lineage", "taxonomic_distance", "rm1", "words", "word_scores", "tfidf", "clustering", "best_description"]
PREDICT = ["filter", "lineage", "taxonomic_distance", "rm1", "terms", "class_scores"]
EVERYTHING = [*DESCRIBE, "terms", "class_scores", "summary"]
#: With the query's own row, all clusters, terms of the best cluster's hits without redundant ones, and every row type.
ANNOTATE = ["query_rows", *DESCRIBE[:-1], "clusters", "best_cluster", "terms", "class_scores", "remove_redundant", "annotation_rows"]
