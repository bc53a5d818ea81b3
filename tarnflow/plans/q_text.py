"""Queries over descriptions, words, lineages and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnflow.functions import lineage as L
from tarnflow.functions import sequences as Q
from tarnflow.functions import text as X
from tarnflow.operators import hits as H
from tarnflow.operators import joins as J
from tarnflow.operators.graph import written

from .q_hits import _LINEAGE, lineages
from .registry import ORACLES, Tables, query

#: English documents whose text is printable ASCII and line ends: upper-casing
#: and character classes agree there on both sides.
ASCII = "en AS (SELECT doc_id, text FROM documents WHERE lang = 'en' AND regexp_full_match(text, '[\\x20-\\x7E\\n]*'))"


def english(t: Tables):
    return t.documents.filter((F.col("lang") == "en") & F.col("text").rlike(r"^[\x20-\x7E\n]*$")).select("doc_id", "text")


#: All documents; upper-casing is of A-Z alone on both sides.
EVERY = "en AS (SELECT doc_id, text FROM documents)"
_UPPER = "translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def every(t: Tables):
    return t.documents.select("doc_id", "text")


def over_all(name: str) -> str:
    """The SQL of a query over English documents, for all documents."""
    return ORACLES[name].replace(ASCII, EVERY).replace("upper(text)", _UPPER)


_CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(trim({c}), ' \w\w=.*$', '', 'g'), '[()\[\]{{}}]', '', 'g'), '["/=\\:;,|%.#!<>?_''^+-]', ' ', 'g'))"""


@query(
    "q_clean_text",
    f"""WITH {ASCII}, l AS (SELECT doc_id, string_split(text, chr(10))[1] AS line FROM en), c AS (SELECT doc_id, {_CLEAN.format(c="line")} AS t FROM l)
    SELECT doc_id, upper(CASE WHEN len(list_filter(string_split(t, ' '), lambda w: w <> '')) = 1 AND regexp_matches(t, '[0-9]') THEN 'Hypothetical protein' ELSE t END) AS cleaned FROM c""",
)
def clean_text(t):
    return english(t).select("doc_id", X.clean_description(F.split("text", "\n")[0]).alias("cleaned"))


@query("q_clean_text_all")
def clean_text_all(t):
    """Every line of every document as a description of its own; a null text
    has one row without a line."""
    lines = every(t).select("doc_id", F.posexplode_outer(F.split("text", "\r?\n", -1)).alias("line", "text"))
    return lines.select("doc_id", "line", X.clean_description(F.col("text"), upper=X.ascii_upper).alias("cleaned"))


_TERMS = " + ".join(f"CASE WHEN contains(t, '{k}') THEN {v} ELSE 0 END" for k, v in X.PENALTIES.items())


@query(
    "q_form_factor",
    f"""WITH {ASCII}, u AS (SELECT doc_id, upper(text) AS t, list_filter(string_split_regex(upper(text), '\\s+'), lambda w: w <> '') AS ws FROM en)
    SELECT doc_id, round(CASE WHEN length(t) = 0 THEN 0 ELSE 1 - (3 + 2 * length(regexp_replace(t, '[A-Z ''-]', '', 'g')) + 4 * len(list_filter(ws, lambda w: regexp_matches(w, '[A-Z][0-9]')))
      + 4 * len(list_filter(ws, lambda w: regexp_matches(w, '[0-9][A-Z]'))) + CASE WHEN starts_with(t, 'PROTEIN') THEN 12 ELSE 0 END + CASE WHEN ends_with(t, 'PROTEIN') THEN 12 ELSE 0 END
      + {_TERMS}) / CAST(length(t) AS DOUBLE) END, 6) AS ff FROM u""",
)
def form_factor(t):
    return english(t).select("doc_id", F.round(X.form_factor(F.col("text")), 6).alias("ff"))


@query("q_form_factor_all", over_all("q_form_factor").replace("length(t) = 0", "coalesce(length(t), 0) = 0"))
def form_factor_all(t):
    return every(t).select("doc_id", F.round(X.form_factor(F.col("text"), X.ascii_upper), 6).alias("ff"))


_W = "w AS (SELECT doc_id, list_filter(string_split_regex(upper(text), '[^A-Z]+'), lambda w: w <> '') AS ws FROM en)"


def words(t: Tables, docs=english):
    """Runs of letters A-Z, upper-cased; what isn't ASCII parts words, so it goes
    before, and upper-casing what is left takes the short way."""
    plain = F.regexp_replace("text", r"[^\x00-\x7F]+", " ")
    return docs(t).select("doc_id", F.array_remove(F.split(F.upper(plain), "[^A-Z]+"), "").alias("ws"))


@query("q_word_counts", f"WITH {ASCII}, {_W} SELECT word, count(*) AS cnt FROM (SELECT unnest(ws) AS word FROM w) GROUP BY word")
def word_counts(t, docs=english):
    return words(t, docs).select(F.explode("ws").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query("q_word_counts_all", over_all("q_word_counts"))
def word_counts_all(t):
    return word_counts(t, every)


_TFIDF = f"""WITH {ASCII}, {_W}, n AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(ws) AS word FROM w) GROUP BY word), s AS (SELECT sum(cnt) AS total FROM n),
e AS (SELECT DISTINCT doc_id, unnest(ws) AS word FROM w), v AS (SELECT doc_id, word, cnt, ln(total / CAST(cnt AS DOUBLE)) AS idf FROM e JOIN n USING (word), s)
"""


def tfidf(t: Tables, docs=english, hashed: bool = True):
    """Words' counts are the small side by far, so they are hashed and rows aren't
    sorted by word; where rows are read more than once that isn't ``hashed``, as then
    the shuffle would not be shared."""
    counts = word_counts(t, docs)
    total = counts.agg(F.sum("cnt").alias("total"))
    each = words(t, docs).crossJoin(F.broadcast(total))
    return H.tfidf(each.withColumn("doc", F.struct("doc_id", "total")), "doc", F.col("ws"), counts.hint("shuffle_hash") if hashed else counts, F.col("doc.total").cast("double")).select("doc.doc_id", "word", "cnt", "idf")


@query("q_tfidf_words", _TFIDF + "SELECT doc_id, word, cnt, round(idf, 6) AS idf FROM v")
def tfidf_words(t, docs=english):
    return tfidf(t, docs).withColumn("idf", F.round("idf", 6))


@query("q_tfidf_words_all", over_all("q_tfidf_words"))
def tfidf_words_all(t):
    return tfidf_words(t, every)


@query("q_tfidf_norm", _TFIDF + "SELECT doc_id, round(sqrt(sum(idf * idf)), 5) AS norm, count(*) AS n_words FROM v GROUP BY doc_id")
def tfidf_norm(t, docs=english):
    return H.vector_norms(tfidf(t, docs), "doc_id").withColumn("norm", F.round("norm", 5))


@query("q_tfidf_norm_all", over_all("q_tfidf_norm"))
def tfidf_norm_all(t):
    return tfidf_norm(t, every)


@query(
    "q_desc_similarity",
    _TFIDF + """, nm AS (SELECT doc_id, sqrt(sum(idf * idf)) AS norm FROM v GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM w a JOIN w b ON b.doc_id = a.doc_id + 1),
    d AS (SELECT p.a, p.b, sum(x.idf * y.idf) AS dot FROM p JOIN v x ON x.doc_id = p.a JOIN v y ON y.doc_id = p.b AND x.word = y.word GROUP BY ALL)
    SELECT p.a, p.b, round(coalesce(dot / nullif(na.norm * nb.norm, 0), 0), 6) AS similarity FROM p LEFT JOIN d ON d.a = p.a AND d.b = p.b LEFT JOIN nm na ON na.doc_id = p.a LEFT JOIN nm nb ON nb.doc_id = p.b""",
)
def desc_similarity(t, docs=english):
    # Sums that all words need are stored, so texts are read for them alone.
    counts = written(word_counts(t, docs))
    total = counts.agg(F.sum("cnt").cast("double").alias("total"))
    each = words(t, docs).crossJoin(F.broadcast(total))
    return H.neighbour_similarity(each, "doc_id", F.col("ws"), counts, F.col("total")).withColumn("similarity", F.round("similarity", 6))


@query("q_desc_similarity_all", over_all("q_desc_similarity"))
def desc_similarity_all(t):
    return desc_similarity(t, every)


@query(
    "q_wordscores",
    """WITH h AS (SELECT l_orderkey, l_partkey * 100000000 + l_suppkey * 1000 + l_linenumber AS hit, l_extendedprice AS bits, list_filter(string_split(upper(p_name), ' '), lambda w: w <> '') AS ws
      FROM lineitem JOIN part ON p_partkey = l_partkey),
    e AS (SELECT l_orderkey, hit, bits, unnest(ws) AS word FROM h), n AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(upper(p_name), ' ')) AS word FROM part) GROUP BY 1),
    s AS (SELECT l_orderkey, word, sum(bits) AS wb, count(*) AS wc FROM e GROUP BY ALL), t AS (SELECT l_orderkey, 1 + sum(bits) AS total FROM e GROUP BY 1),
    k AS (SELECT l_orderkey, word, wb / total AS v, wc / CAST(greatest(coalesce(cnt, 1), 5) AS DOUBLE) AS j FROM s LEFT JOIN n USING (word) JOIN t USING (l_orderkey)),
    m AS (SELECT l_orderkey, hit, round(avg(v), 6) AS value, round(avg(v * j), 6) AS jaccard FROM e JOIN k USING (l_orderkey, word) GROUP BY ALL)
    SELECT h.l_orderkey, h.hit, coalesce(value, 0) AS value, coalesce(jaccard, 0) AS jaccard FROM h LEFT JOIN m ON m.l_orderkey = h.l_orderkey AND m.hit = h.hit""",
)
def wordscores(t):
    h = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", (F.col("l_partkey") * 100000000 + F.col("l_suppkey") * 1000 + F.col("l_linenumber")).alias("hit"), F.col("l_extendedprice").alias("bits"), F.split(F.upper("p_name"), " ").alias("ws")
    )
    counts = t.part.select(F.explode(F.split(F.upper("p_name"), " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    s = H.word_scores(h, "l_orderkey", "hit", F.col("ws"), F.col("bits"), F.lit(True), counts, 5)
    return s.select("l_orderkey", "hit", F.round("value", 6).alias("value"), F.round("jaccard", 6).alias("jaccard"))


@query(
    "q_lineage_join",
    f"WITH {_LINEAGE} SELECT l_orderkey, l_linenumber, l_partkey, l.l_suppkey, coalesce(lineage, 'unclassified') AS lineage FROM lineitem l LEFT JOIN (SELECT * FROM lin WHERE l_suppkey % 10 <> 0) d ON d.l_suppkey = l.l_suppkey",
)
def lineage_join(t):
    d = lineages(t).filter(F.col("l_suppkey") % 10 != 0)
    return J.lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.col("l_suppkey"), d.withColumnRenamed("l_suppkey", "sk"), "sk", {"lineage": "unclassified"})


@query("q_taxid_join", "SELECT c_custkey, coalesce(n_nationkey, -1) AS taxid FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20")
def taxid_join(t):
    d = t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("nk"), F.col("n_nationkey").alias("taxid"))
    return J.lookup(t.customer.select("c_custkey", "c_nationkey"), F.col("c_nationkey"), d, "nk", {"taxid": -1}).select("c_custkey", "taxid")


@query("q_genus_rule", f"WITH {_LINEAGE} SELECT l_suppkey, string_split(lineage, '; ')[-1] AS genus, string_split(lineage, '; ')[1] AS kingdom FROM lin")
def genus_rule(t):
    return lineages(t).select("l_suppkey", L.genus(F.col("lineage")).alias("genus"), L.kingdom(F.col("lineage")).alias("kingdom"))


@query("q_taxon_prefix", f"WITH {_LINEAGE} SELECT l_suppkey, string_split(lineage, '; ')[1] AS taxon FROM lin")
def taxon_prefix(t):
    return lineages(t).select("l_suppkey", L.prefix(F.col("lineage"), 1).alias("taxon"))


@query(
    "q_path_distance",
    f"""WITH {_LINEAGE}, p AS (SELECT a.l_suppkey AS a, b.l_suppkey AS b, string_split(a.lineage, '; ') AS x, string_split(b.lineage, '; ') AS y FROM lin a JOIN lin b ON b.l_suppkey = a.l_suppkey + 1)
    SELECT a, b, CAST(4 - 2 * (CASE WHEN x[1] <> y[1] THEN 0 WHEN x[2] <> y[2] THEN 1 ELSE 2 END) AS INTEGER) AS path FROM p""",
)
def path_distance(t):
    a = lineages(t)
    b = a.select((F.col("l_suppkey") - 1).alias("l_suppkey"), F.col("l_suppkey").alias("b"), F.col("lineage").alias("other"))
    return a.join(b, "l_suppkey").select(F.col("l_suppkey").alias("a"), "b", L.path_length(F.col("lineage"), F.col("other")).alias("path"))


_SEQ = "sq AS (SELECT p_partkey, translate(regexp_replace(upper(p_name), '[^A-Z]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM part)"


def sequences(t: Tables, *more: str):
    plain = F.regexp_replace(F.upper("p_name"), "[^A-Z]", "")
    return t.part.select("p_partkey", *more, F.translate(plain, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC").alias("seq"))


@query("q_revcomp", f"WITH {_SEQ} SELECT p_partkey, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM sq")
def revcomp(t):
    return sequences(t).select("p_partkey", Q.reverse_complement(F.col("seq")).alias("rc"))


_AA = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in Q.CODONS.items()) + "}"


@query(
    "q_translate",
    f"WITH {_SEQ} SELECT p_partkey, list_reduce(list_concat([''], list_transform(range(0, CAST(length(seq) // 3 AS BIGINT)), lambda i: {_AA}[substring(seq, CAST(i * 3 + 1 AS BIGINT), 3)])), lambda a, b: a || b) AS protein FROM sq",
)
def translate(t):
    return sequences(t).select("p_partkey", Q.translate(F.col("seq")).alias("protein"))


@query(
    "q_translate_reduced",
    # Written out, and not made from the code's tables.
    """WITH s AS (SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') AS s FROM part) SELECT p_partkey,
    translate(s, 'ACGPSTWYRNDQEHKILMFV', 'AAAAAAAAEEEEEEEIIIII') AS structural,
    translate(s, 'DEHKRAFILMPVWCGNQSTY', 'AACCCHHHHHHHHPPPPPPP') AS functional,
    translate(s, 'AFILMPVWCDEGHKNQRSTY', 'IIIIIIIIOOOOOOOOOOOO') AS hydrophobic,
    translate(s, 'CAGPSTDENQHKRILMVFWY', 'ACCCCCDDDDEEEFFFFGGG') AS dayhoff,
    translate(s, 'ILVAGPMNQCSTDEKRFHWY', 'AAACCCDDDEEEFFGGHHHH') AS sneath,
    translate(s, 'ACGILMPSTVDENQFWYHKR', 'AAAAAAAAAACCCCDDDEEE') AS stanfel,
    translate(s, 'DEAGILVNQFWYRHKSTPCM', 'AALLLLLMMRRRCCCHHISS') AS chemical,
    translate(s, 'DEHKRACFGILMNPQSTVWY', 'AACCCNNNNNNNNNNNNNNN') AS charge FROM s""",
)
def translate_reduced(t):
    protein = F.regexp_replace(F.upper("p_name"), "[^A-Z]", "")
    return t.part.select("p_partkey", *[Q.reduce_alphabet(protein, n).alias(n) for n in Q.REDUCED])


@query("q_orf_split", "SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, orf FROM (SELECT doc_id, unnest(f) AS orf, unnest(range(1, len(f) + 1)) AS pos FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ex]+'), lambda s: length(s) >= 20) AS f FROM documents WHERE lang = 'en'))")
def orf_split(t):
    return orfs(t.documents.filter(F.col("lang") == "en"))


def orfs(d):
    return d.select("doc_id", F.posexplode(F.filter(F.split("text", "[ex]+"), lambda s: F.length(s) >= 20)).alias("pos", "orf"))


@query("q_orf_split_all", ORACLES["q_orf_split"].replace(" WHERE lang = 'en'", ""))
def orf_split_all(t):
    return orfs(every(t))


@query("q_wrap60", "SELECT p_partkey, regexp_replace(regexp_replace(p_name || p_type || p_brand || p_name, '(.{10})', '\\1' || chr(10), 'g'), '\\n$', '') AS wrapped FROM part")
def wrap60(t):
    return t.part.select("p_partkey", X.wrap(F.concat("p_name", "p_type", "p_brand", "p_name"), 10).alias("wrapped"))


@query(
    "q_ambiguity_expand",
    "SELECT n_nationkey, a || b || c AS seq FROM (SELECT n_nationkey, unnest(['A', 'C', 'G', 'T']) AS a, n_nationkey % 2 AS o FROM nation), (SELECT unnest(['A', 'G']) AS b), (SELECT unnest(['C', 'T']) AS c) WHERE true",
)
def ambiguity_expand(t):
    return t.nation.select("n_nationkey", F.explode(Q.expand_ambiguous(F.lit("NRY"), 3)).alias("seq"))


@query("q_ec_member", "SELECT p_partkey, p_size % 6 || '.' || p_size % 4 || '.1.1' AS ec, p_size % 6 = 1 AND p_size % 4 = 2 AS member FROM part")
def ec_member(t):
    ec = F.concat_ws(".", (F.col("p_size") % 6).cast("string"), (F.col("p_size") % 4).cast("string"), F.lit("1"), F.lit("1"))
    return t.part.select("p_partkey", ec.alias("ec"), X.ec_member(ec, "1.2.-.-").alias("member"))


@query("q_accession", "SELECT s_suppkey, CASE WHEN contains(k, '|') THEN string_split(k, '|')[2] ELSE k END AS acc FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE 'sp|' || s_name || '|X' END AS k FROM supplier)")
def accession(t):
    k = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).otherwise(F.concat(F.lit("sp|"), "s_name", F.lit("|X")))
    return t.supplier.select("s_suppkey", X.split_accession(k).alias("acc"))


@query("q_json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("q_html_links", """SELECT page_id, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS l FROM pages) GROUP BY page_id""")
def html_links(t):
    return t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("l")).groupBy("page_id").agg(F.count(F.lit(1)).alias("links"))
