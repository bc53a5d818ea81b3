"""Readers of record-structured text as DataFrames.

Records are cut by Spark's text source (a separator of lines or of records),
so files are read in parallel and compressed files are unpacked by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HITS = (
    "nid long, isquery string, qpid string, spid string, qcov double, scov double, bits double, pide double, lali int, "
    "desc string, species string, qseq string, vote int, genename string"
)


def _records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(path).withColumnRenamed("value", "record")


def fasta(spark: SparkSession, path: str, upper: bool = False) -> DataFrame:
    """(id, description, seq, length): one row a record; comments and blank
    lines are left out, gaps and white space are cut from sequences."""
    r = _records(spark, path, "\n>").select(F.regexp_replace("record", "^(?:[ \t]*(?:#[^\n]*)?(?:\n|$))*>?", "").alias("r")).filter(F.trim("r") != "")
    head = F.regexp_extract("r", "^([^\n]*)", 1)
    body = F.filter(F.slice(F.split("r", "\n"), 2, 1 << 30), lambda line: ~line.startswith("#"))
    seq = F.regexp_replace(F.array_join(body, ""), r"[\s.\-]", "")
    seq = F.upper(seq) if upper else seq
    return r.select(F.regexp_extract(head, r"^(\S+)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), seq.alias("seq")).withColumn("length", F.length("seq"))


def table(spark: SparkSession, path: str, schema: str, header: bool = True, comment: str | None = None, sep: str = "\t") -> DataFrame:
    """Delimited text with a fixed schema; the missing-value mark is null."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("nullValue", "n.d.").option("quote", "\u0000")
    return (reader.option("comment", comment) if comment else reader).csv(path)


def hits(spark: SparkSession, path: str) -> DataFrame:
    """A hit table with header."""
    return table(spark, path, HITS)


def blast(spark: SparkSession, path: str, lengths: DataFrame | None = None) -> DataFrame:
    """Twelve-column tabular search output as hits; coverages need query and
    subject ``lengths`` (id, length)."""
    cols = "qpid string, spid string, pident double, lali int, mismatch int, gapopen int, qfrom int, qto int, sfrom int, sto int, evalue double, bits double"
    t = table(spark, path, cols, header=False, comment="#").withColumn("pide", F.col("pident") / 100)
    if lengths is None:
        return t
    q, s = lengths.select(F.col("id").alias("qpid"), F.col("length").alias("qseqlen")), lengths.select(F.col("id").alias("spid"), F.col("length").alias("sseqlen"))
    out = t.join(q, "qpid", "left").join(s, "spid", "left")
    return out.withColumns({"qcov": F.try_divide(F.col("lali"), F.col("qseqlen")), "scov": F.try_divide(F.col("lali"), F.col("sseqlen"))})


def tagged_hits(spark: SparkSession, path: str, plus_one: bool = True, ranges: bool = False) -> DataFrame:
    """Search output of tagged records as hits: <QUERY ...> with <SBJCT ...>
    inside, attributes as NAME= value, then a header and a sequence line.

    Every query has a row of its own (isquery 1) before its hits.  Species and
    gene come from OS= and GN= of the header, whose tags aren't part of desc.
    Coverages divide by length, plus one by default.  rank orders a query's
    hits by bits, or by votes where none has bits; ``ranges`` adds qfrom qto
    qseqlen sfrom sto sseqlen.
    """
    r = _records(spark, path, "</QUERY>").filter(F.col("record").contains("<QUERY")).withColumn("at", F.monotonically_increasing_id())
    text = lambda c, name: F.nullif(F.regexp_extract(c, rf'(?i)\b{name}=\s*"?([^\s">]*)', 1), F.lit(""))
    num = lambda c, name: text(c, name).try_cast("double")
    one = r.select("at", F.regexp_extract("record", r"(?s)<QUERY(.*?)(?:<SBJCT|$)", 1).alias("q"), F.regexp_extract_all("record", F.lit(r"(?s)<SBJCT(.*?)(?:</SBJCT>|(?=<SBJCT)|$)"), F.lit(1)).alias("subjects"))
    body = lambda c: F.regexp_extract(c, r"(?m)>\s*>?([^\s<>][^\n<]*)", 1)
    length = lambda c: F.coalesce(num(c, "LSEQ"), num(c, "len"))
    head = body(F.col("q"))
    one = one.withColumns({"nid": text(F.col("q"), "nid").try_cast("long"), "qvote": text(F.col("q"), "vote"), "qpid": F.regexp_extract(head, r"^(\S+)", 1), "qlen": length(F.col("q"))})
    entry = lambda c, name: F.nullif(F.regexp_extract(c, rf"\b{name}=(.*?)(?= \w{{2}}=|$)", 1), F.lit(""))
    seq = lambda c: F.nullif(F.regexp_extract(c, r"(?m)>\s*>?[^\s<>][^\n<]*\n([A-Za-z*-]+)", 1), F.lit(""))
    both = one.withColumn("rows", F.concat(F.array(F.struct(F.lit("1").alias("isquery"), F.col("q").alias("s"))), F.transform("subjects", lambda s: F.struct(F.lit("0").alias("isquery"), s.alias("s")))))
    x = both.select("at", "nid", "qpid", "qlen", "qvote", F.posexplode("rows").alias("place", "row")).select("at", "nid", "qpid", "qlen", "qvote", "place", "row.isquery", "row.s")
    h = body(F.col("s"))
    own = F.col("isquery") == "1"
    rest = F.trim(F.regexp_replace(h, r"^\S+", ""))
    add = 1 if plus_one else 0
    x = x.withColumns({"spid": F.regexp_extract(h, r"^(\S+)", 1), "slen": length(F.col("s")), "lali": F.when(own, F.col("qlen")).otherwise(num(F.col("s"), "LALI")).cast("int")})
    x = x.withColumns(
        {
            "qcov": F.when(own, 1.0).otherwise(F.col("lali") / (add + F.col("qlen"))),
            "scov": F.when(own, 1.0).otherwise(F.col("lali") / (add + F.col("slen"))),
            "bits": F.when(own, 0.0).otherwise(num(F.col("s"), "BITS")),
            "pide": F.when(own, 1.0).otherwise(num(F.col("s"), "PIDE")),
            "vote": F.when(own, "0").otherwise(F.coalesce(text(F.col("s"), "VOTE"), F.col("qvote"))),
            "desc": F.regexp_replace(rest, r"(^| )\w{2}=.*$", ""),
            "species": F.coalesce(entry(rest, "OS"), F.lit("unknown")),
            "genename": F.when(own, "").otherwise(F.coalesce(entry(rest, "GN"), F.lit(""))),
            "qseq": F.when(own, seq(F.col("s"))),
        }
    )
    w = Window.partitionBy("at").orderBy(F.col("isquery").desc(), F.desc_nulls_last("bits"), F.desc_nulls_last(F.col("vote").try_cast("double")), "place")
    x = x.withColumn("rank", F.when(own, 0).otherwise(F.row_number().over(w) - 1))
    columns = ["nid", "isquery", "qpid", "spid", "qcov", "scov", "bits", "pide", "lali", "desc", "species", "qseq", "vote", "genename", "rank"]
    if not ranges:
        return x.select(*columns, "qlen", "slen")
    ends = {c: F.when(own, F.lit(1) if c.endswith("from") else F.col("qlen")).otherwise(num(F.col("s"), c)).cast("int") for c in ("qfrom", "qto", "sfrom", "sto")}
    return x.withColumns(ends).select(*columns, "qfrom", "qto", F.col("qlen").cast("int").alias("qseqlen"), "sfrom", "sto", F.when(own, F.col("qlen")).otherwise(F.col("slen")).cast("int").alias("sseqlen"))


def dictionary(spark: SparkSession, path: str, key: int = 0, value: int = 1, sep: str = "\t", header: bool = False, upper: bool = False) -> DataFrame:
    """(key, value): the last line of a key wins, a missing value is the key."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    if header:
        lines = lines.join(lines.agg(F.min("at").alias("first")), F.col("at") == F.col("first"), "left_anti")
    parts = F.split("value", f"\\Q{sep}\\E", -1)
    k = F.trim(F.try_element_at(parts, F.lit(key + 1)))
    rows = lines.select((F.upper(k) if upper else k).alias("key"), F.nullif(F.trim(F.try_element_at(parts, F.lit(value + 1))), F.lit("")).alias("v"), "at").filter("key <> ''")
    return rows.groupBy("key").agg(F.max_by(F.coalesce("v", "key"), "at").alias("value"))


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(key, cnt) of lines such as ``  12 some key``; keys upper-cased."""
    t = spark.read.text(path)
    return t.select(F.upper(F.regexp_extract("value", r"^\s*\d+ (.*)$", 1)).alias("key"), F.regexp_extract("value", r"^\s*(\d+) ", 1).try_cast("long").alias("cnt")).filter("cnt is not null")


def header_index(spark: SparkSession, path: str) -> DataFrame:
    """(key, header): two rows, accession and id, for each db|acc|id header."""
    t = spark.read.text(path)
    parts = F.split(F.regexp_extract("value", r"^>?(\S+)", 1), r"\|")
    text = F.regexp_replace(F.regexp_replace("value", r"^>?\S+\s*", ""), r" \w{2}=.*$", "")
    keys = F.array_compact(F.array(F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(3))))
    return t.select(F.explode(F.when(F.size(keys) > 0, keys).otherwise(F.slice(parts, 1, 1))).alias("key"), text.alias("header"))


def term_list(c: Column) -> Column:
    """Ids of a list cell, without their prefix."""
    return F.transform(F.filter(F.split(c, "[ ,;.]+"), lambda x: x != ""), lambda x: F.regexp_replace(x, "^GO:", ""))


def obo(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """terms (id, name, namespace), edges (child, parent, relation) of an
    ontology file; obsolete terms are dropped, alternative ids are terms too."""
    s = _records(spark, path, "\n\n").filter(F.col("record").contains("[Term]") & ~F.col("record").rlike(r"(?m)^is_obsolete:\s*true"))
    tag = lambda name: F.regexp_extract_all("record", F.lit(rf"(?m)^{name}: *(\S+)"), F.lit(1))
    line = lambda name: F.regexp_extract("record", rf"(?m)^{name}: *([^\n]*)", 1)
    t = s.select(F.explode(F.array_union(tag("id"), tag("alt_id"))).alias("id"), tag("id")[0].alias("mapped_to"), line("name").alias("name"), line("namespace").alias("namespace"), tag("is_a").alias("isa"), F.regexp_extract_all("record", F.lit(r"(?m)^relationship: part_of *(\S+)"), F.lit(1)).alias("partof"))
    rel = lambda c, name: t.select(F.col("id").alias("child"), F.explode(c).alias("parent"), F.lit(name).alias("relation"))
    return {"terms": t.select("id", "mapped_to", "name", "namespace"), "edges": rel("isa", "is_a").unionByName(rel("partof", "part_of"))}


def gaf(spark: SparkSession, path: str) -> DataFrame:
    """(acc, goid, evidence) of an annotation file."""
    t = spark.read.text(path).filter(~F.col("value").startswith("!"))
    c = F.split("value", "\t")
    return t.select(F.try_element_at(c, F.lit(2)).alias("acc"), F.try_element_at(c, F.lit(5)).alias("goid"), F.try_element_at(c, F.lit(7)).alias("evidence"))


def flat_entries(spark: SparkSession, path: str) -> DataFrame:
    """(id, acc, feature, position) of entries that end in //: positions of
    non-standard residues; entries without one have nulls."""
    r = _records(spark, path, "\n//\n").filter(F.col("record").rlike(r"(?m)^ID "))
    f = F.regexp_extract_all("record", F.lit(r"(?m)^FT +NON_STD +(\d+)"), F.lit(1))
    return r.select(F.regexp_extract("record", r"(?m)^ID +(\S+)", 1).alias("id"), F.regexp_extract("record", r"(?m)^AC +([^;]+)", 1).alias("acc"), F.explode_outer(f).alias("position")).withColumn("position", F.col("position").cast("int"))


def hmm_domains(spark: SparkSession, path: str) -> DataFrame:
    """Per-domain table of a profile search: 22 columns by white space and the
    rest as description; numbers that can't be read are null."""
    names = "target taccession tlen query qaccession qlen evalue score bias dom ndom cevalue ievalue dscore dbias hmmfrom hmmto alifrom alito envfrom envto acc".split()
    whole = {"tlen", "qlen", "dom", "ndom", "hmmfrom", "hmmto", "alifrom", "alito", "envfrom", "envto"}
    words = {"target", "taccession", "query", "qaccession"}
    t = spark.read.text(path).filter(~F.col("value").startswith("#"))
    c = F.split(F.trim("value"), r"\s+", 23)
    kind = lambda n: "string" if n in words else "int" if n in whole else "double"
    return t.select("*", c.alias("c")).select(*[F.try_element_at("c", F.lit(i + 1)).try_cast(kind(n)).alias(n) for i, n in enumerate(names)], F.try_element_at("c", F.lit(23)).alias("description"))


def hmm_targets(spark: SparkSession, path: str) -> DataFrame:
    """Per-sequence table of a profile search, grouped by query as it is read:
    (target, taccession, query, qaccession, evalue, score, bias, devalue,
    dscore, dbias), the first ten columns."""
    names = "target taccession query qaccession evalue score bias devalue dscore dbias".split()
    c = F.split(F.trim("value"), r"\s+", 19)
    t = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return t.select(*[F.try_element_at(c, F.lit(i + 1)).try_cast("string" if i < 4 else "double").alias(n) for i, n in enumerate(names)])


def hmm_report(spark: SparkSession, path: str) -> DataFrame:
    """(seq, domain, start, end, score, evalue) of the domain lines of a search
    report: a name, k/n, two pairs of places with their end marks, score and
    E-value; the alignments between them are left out."""
    line = r"^(\S+)\s+(\d+)/\d+\s+(\d+)\s+(\d+)\s+[\[.\]]{2}\s+\d+\s+\d+\s+[\[.\]]{2}\s+([0-9.eE+-]+)\s+([0-9.eE+-]+)\s*$"
    t = spark.read.text(path).filter(F.col("value").rlike(line))
    part = lambda i: F.regexp_extract("value", line, i)
    return t.select(part(1).alias("seq"), part(2).cast("int").alias("domain"), part(3).cast("long").alias("start"), part(4).cast("long").alias("end"), part(5).try_cast("double").alias("score"), part(6).try_cast("double").alias("evalue"))


def raw_trnas(spark: SparkSession, path: str) -> DataFrame:
    """First-pass predictor's report, in blocks that begin with ``sequence
    name=`` (several lines each): (seqname, start, end, strand, position,
    isotype, anticodon, score, seq_len).  A hit whose start exceeds its end is
    on the reverse strand; position is then mirrored, so that it grows along
    that strand."""
    r = _records(spark, path, "sequence name=").filter(F.col("record").contains("start position="))
    get = lambda pattern: F.nullif(F.regexp_extract("record", pattern, 1), F.lit(""))
    a, z = get(r"start position=\s*(\d+)").try_cast("long"), get(r"end position=\s*(\d+)").try_cast("long")
    n = get(r"(?:length|seqlen)=\s*(\d+)").try_cast("long")
    strand = F.when(a <= z, "+").otherwise("-")
    return r.select(
        F.regexp_extract("record", r"^\s*(\S+)", 1).alias("seqname"), F.least(a, z).alias("start"), F.greatest(a, z).alias("end"), strand.alias("strand"),
        F.when(a <= z, a).otherwise(n - a + 1).alias("position"), get(r"tRNA predict as a\s+tRNA-\s*(\w+)").alias("isotype"), get(r"anticodon\s+(\w+)").alias("anticodon"),
        get(r"score=\s*([-0-9.]+)").try_cast("double").alias("score"), n.alias("seq_len"),
    )


#: Columns of a final table by the words of its header, in any order.
FINAL_COLUMNS = {
    "Sequence": ("seqname", "string"), "tRNA": ("number", "int"), "Begin": ("start", "long"), "End": ("end", "long"), "Type": ("isotype", "string"), "Codon": ("anticodon", "string"),
    "Anti": ("anticodon", "string"), "Inf": ("score", "double"), "Cove": ("score", "double"), "Score": ("score", "double"), "HMM": ("profile_score", "double"), "2'Str": ("structure_score", "double"),
    "Hit": ("source", "string"), "Note": ("note", "string"),
}


def final_table(spark: SparkSession, path: str) -> DataFrame:
    """A final tab-separated table whose header words say which columns it has;
    two header lines, of which the first or the second may name a column, and a
    line of dashes before the rows.  Only the two header lines are looked at on
    the driver."""
    t = spark.read.text(path)
    heads = [r.value for r in t.limit(2).collect()]
    top = [[w.strip() for w in line.split("\t")] for line in heads]
    named: dict[str, tuple[int, str]] = {}
    for words in reversed(top):  # the first line's names win
        for i, w in enumerate(words):
            name = FINAL_COLUMNS.get(w) or FINAL_COLUMNS.get(w.split(" ")[0])
            if name:
                named[name[0]] = (i, name[1])
    rows = t.filter(~F.col("value").isin(heads) & ~F.col("value").rlike(r"^[-\s]*$"))
    c = F.split("value", "\t")
    return rows.select(*[F.trim(F.try_element_at(c, F.lit(i + 1))).try_cast(kind).alias(n) for n, (i, kind) in named.items()])


def structures(spark: SparkSession, path: str) -> DataFrame:
    """Secondary-structure file: records that a blank line ends, each a name
    line (``name (start-end) Length: n bp``), a ``Type: X Anticodon: NNN at
    a-b`` line, and Seq:, Str: lines: (name, start, end, length, isotype,
    anticodon, score, seq, structure)."""
    r = _records(spark, path, "\n\n").filter(F.col("record").contains("Seq:"))
    get = lambda pattern, kind="string": F.nullif(F.regexp_extract("record", pattern, 1), F.lit("")).try_cast(kind)
    return r.select(
        get(r"(?m)^\s*(\S+)\s+\(").alias("name"), get(r"\((\d+)-\d+\)", "long").alias("start"), get(r"\(\d+-(\d+)\)", "long").alias("end"), get(r"Length:\s*(\d+)", "int").alias("length"),
        get(r"Type:\s*(\S+)").alias("isotype"), get(r"Anticodon:\s*(\S+)").alias("anticodon"), get(r"Score:\s*([-0-9.]+)", "double").alias("score"), get(r"(?m)^Seq:\s*(\S+)").alias("seq"),
        get(r"(?m)^Str:\s*(\S+)").alias("structure"),
    )


def position_map(spark: SparkSession, path: str) -> DataFrame:
    """(name, position, standard): tab-separated lines of a name and its
    position pairs ``p:s``, one row a pair."""
    c = F.split("value", "\t")
    t = spark.read.text(path).filter(~F.col("value").startswith("#")).select(c[0].alias("name"), F.explode(F.slice(c, 2, 1 << 30)).alias("pair"))
    return t.select("name", F.regexp_extract("pair", r"^(\d+):", 1).try_cast("int").alias("position"), F.regexp_extract("pair", r":(.+)$", 1).alias("standard")).filter("position is not null")


def motif_counts(spark: SparkSession, path: str) -> DataFrame:
    """(base, position, count) of the lines ``a: 1 2 3`` behind ``Motif
    counts:``, positions from 1."""
    # One small file a row: what a line means depends on those before it.
    whole = spark.read.text(path, wholetext=True)
    later = F.regexp_extract("value", r"(?s)(?:^|\n)Motif counts:(.*)", 1)
    line = whole.select(F.explode(F.regexp_extract_all(later, F.lit(r"(?m)^([acgt]:[^\n]*)"), F.lit(1))).alias("l"))
    return line.select(F.substring("l", 1, 1).alias("base"), F.posexplode(F.split(F.trim(F.substring("l", 3, 1 << 30)), r"\s+")).alias("p", "v")).select("base", (F.col("p") + 1).alias("position"), F.col("v").try_cast("long").alias("count"))


def key_value_lines(spark: SparkSession, path: str) -> DataFrame:
    """(key, rest): a line's first field and all behind it."""
    t = spark.read.text(path)
    c = F.split("value", "\t", 2)
    return t.select(c[0].alias("key"), F.try_element_at(c, F.lit(2)).alias("rest")).filter("key <> ''")


def term_sets(table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, terms): the union of the id lists in one column or several, over
    all of a key's rows; of a term and its parents alike."""
    lists = F.array_distinct(F.flatten(F.array(*[F.coalesce(term_list(F.col(c)), F.array().cast("array<string>")) for c in columns])))
    return table.select(key, lists.alias("t")).groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("t")))).alias("terms"))


def covariance_hits(spark: SparkSession, path: str) -> DataFrame:
    """(model, seqname, start, end, strand, score, evalue, trunc) of tabular
    covariance-model output; start <= end on both strands, no truncation is ''."""
    t = spark.read.text(path).filter(~F.col("value").startswith("#"))
    c = F.split(F.trim("value"), r"\s+")
    a, z = c[7].try_cast("long"), c[8].try_cast("long")
    return t.select(c[2].alias("model"), c[0].alias("seqname"), F.least(a, z).alias("start"), F.greatest(a, z).alias("end"), c[9].alias("strand"), c[14].try_cast("double").alias("score"), c[15].try_cast("double").alias("evalue"), F.when(c[10] == "no", "").otherwise(c[10]).alias("trunc"))


def predictor(spark: SparkSession, path: str, fields: list[str], sep: str = r"\s+") -> DataFrame:
    """Lines of a predictor's output, cut by a pattern, as named columns; start,
    end and score are numbers."""
    t = spark.read.text(path).filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    c = F.split(F.trim("value"), sep)
    kind = {"start": "long", "end": "long", "score": "double"}
    return t.select(*[F.try_element_at(c, F.lit(i + 1)).try_cast(kind.get(n, "string")).alias(n) for i, n in enumerate(fields)])


def model_scores(spark: SparkSession, path: str) -> DataFrame:
    """(id, model, score, category) of a wide file whose header names models;
    a mito_ prefix is a category."""
    wide = spark.read.option("sep", "\t").option("header", True).csv(path)
    key, *models = wide.columns
    long = wide.unpivot([key], models, "model", "score")
    mito = F.col("model").startswith("mito_")
    return long.select(F.col(key).alias("id"), F.regexp_replace("model", "^mito_", "").alias("model"), F.col("score").try_cast("double").alias("score"), F.when(mito, "mito").otherwise("nuclear").alias("category"))


def newick(spark: SparkSession, path: str) -> DataFrame:
    """(tree, leaf, length): leaves of trees that end in a semicolon."""
    r = _records(spark, path, ";").filter(F.col("record").contains("(")).withColumn("tree", F.monotonically_increasing_id())
    leaf = F.explode(F.regexp_extract_all("record", F.lit(r"[(,]\s*([^(),:;\s]+(?::[-0-9.eE]+)?)"), F.lit(1))).alias("leaf")
    return r.select("tree", leaf).select("tree", F.regexp_extract("leaf", "^([^:]+)", 1).alias("leaf"), F.regexp_extract("leaf", ":(.*)$", 1).try_cast("double").alias("length"))


def database(spark: SparkSession, url: str, query: str, partition: dict | None = None) -> DataFrame:
    """A JDBC query; ``partition`` (column, lower, upper, number) reads in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("query" if partition is None else "dbtable", query if partition is None else f"({query}) q")
    if partition:
        reader = reader.options(partitionColumn=partition["column"], lowerBound=partition["lower"], upperBound=partition["upper"], numPartitions=partition["number"])
    return reader.load()


def subsequences(wanted: DataFrame, sequences: DataFrame) -> DataFrame:
    """(id, start, end, subseq) of 1-based closed ranges."""
    return wanted.join(sequences.select("id", "seq"), "id").select("id", "start", "end", F.substring(F.col("seq"), F.col("start"), F.col("end") - F.col("start") + 1).alias("subseq"))
