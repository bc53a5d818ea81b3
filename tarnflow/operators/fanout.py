"""Row-to-many operators as table functions with schemas of their own.

Each function looks at its input table when a query is analysed: it checks its
columns, takes over the name and the type of the key, and asks Spark to deal rows
by key and, where order counts, to sort them.  A block's rows go through it one
after another, so it holds what it needs of a block, never the block.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import lit, udtf
from pyspark.sql.types import DoubleType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

NOTHING = "No informative hits"


def _key_schema(table: AnalyzeArgument, key: AnalyzeArgument, needed: tuple[str, ...]) -> StructType:
    names = {f.name: f.dataType for f in table.dataType.fields}
    missing = [c for c in (key.value, *needed) if c not in names]
    if missing:
        raise ValueError(f"the table has no column {', '.join(map(str, missing))}")
    return StructType().add(key.value, names[key.value])


class NaivePredictor:
    """Every block gets every class of a list, once: the key, then goid,
    frequency (text of two decimals), ontology and description.

    Arguments: the table, the name of its key column, and the classes as JSON, a
    list of [goid, frequency, ontology, description]."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, classes: AnalyzeArgument) -> AnalyzeResult:
        schema = _key_schema(rows, key, ())
        for c in ("goid", "frequency", "ontology", "description"):
            schema = schema.add(c, StringType())
        json.loads(classes.value)
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(key.value)])

    def __init__(self):
        self.block = None

    def eval(self, rows, key, classes):
        if self.block is None:
            self.block = (rows[key], classes)

    def terminate(self):
        if self.block is not None:
            value, classes = self.block
            for goid, frequency, ontology, description in json.loads(classes):
                yield value, goid, f"{frequency:.2f}", ontology, description


class BestInformativeHit:
    """The first informative hit of a block and the terms of its first annotated
    one: the key, kind ('DE', then an ontology for each term), bits, id, text.

    The table has the key, bits, spid, accepted (boolean), ff, desc and terms (an
    array of structs id, ontology, text).  Hits are taken by falling bits, ties by
    spid; hits of the block's own key don't count.  A block without an informative
    hit has a DE row all the same.  Arguments: the table, the name of the key
    column, the least form factor."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, least: AnalyzeArgument) -> AnalyzeResult:
        schema = _key_schema(rows, key, ("bits", "spid", "accepted", "ff", "desc", "terms"))
        schema = schema.add("kind", StringType()).add("bits", DoubleType()).add("id", StringType()).add("text", StringType())
        order = [OrderingColumn("bits", ascending=False, overrideNullsFirst=False), OrderingColumn("spid")]
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(key.value)], orderBy=order)

    def __init__(self):
        self.key, self.seen, self.best, self.terms = None, False, None, None

    def eval(self, rows, key, least):
        self.key, self.seen = rows[key], True
        if (self.best and self.terms) or not rows["accepted"] or str(rows["spid"]) == str(self.key):
            return
        if not self.best and rows["ff"] is not None and rows["ff"] >= least and rows["desc"]:
            self.best = (float(rows["bits"]), rows["desc"])
        if not self.terms and rows["terms"]:
            self.terms = (float(rows["bits"]), [(t["id"], t["ontology"], t["text"]) for t in rows["terms"]])

    def terminate(self):
        if not self.seen:
            return
        bits, text = self.best or (0.0, NOTHING)
        yield self.key, "DE", bits, "", text
        bits, terms = self.terms or (0.0, [])
        for goid, ontology, text in terms:
            yield self.key, ontology, bits, goid, text


FUNCTIONS = {"naive_predictor": NaivePredictor, "best_informative_hit": BestInformativeHit}


def register(spark: SparkSession) -> None:
    """Makes the functions callable in SQL, as in
    ``SELECT * FROM best_informative_hit(TABLE(hits), 'qpid', 0.2)``."""
    for name, kind in FUNCTIONS.items():
        spark.udtf.register(name, udtf(kind))


def naive(blocks: DataFrame, key: str, classes: list[tuple[str, float, str, str]]) -> DataFrame:
    """NaivePredictor over a table with a key column; rows of a null key are one
    block, an empty table or an empty list gives nothing."""
    return udtf(NaivePredictor)(blocks.select(key).asTable(), lit(key), lit(json.dumps(classes)))


def best_informative(hits: DataFrame, key: str, least: float = 0.2) -> DataFrame:
    """BestInformativeHit over a hit table, as two least rows of each block: rows
    stay in the JVM and are cut down before they are dealt."""
    bits = F.col("bits").cast("double")
    # Falling bits without nulls first, then spid; NaN is the greatest number.
    place = [bits.isNull(), ~F.isnan(bits), -bits, F.col("spid")]
    counts = F.coalesce(F.col("accepted"), F.lit(False)) & ~F.col("spid").cast("string").eqNullSafe(F.col(key).cast("string"))
    first = lambda ok, what: F.min(F.when(counts & ok, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(place)], bits.alias("bits"), what.alias("what"))))
    blocks = hits.groupBy(F.col(key)).agg(first((F.col("ff") >= least) & ~F.isnan("ff") & (F.col("desc") != ""), F.col("desc")).alias("__de"), first(F.size("terms") > 0, F.col("terms")).alias("__terms"))
    row = lambda kind, bits, id_, text: F.struct(kind.alias("kind"), bits.alias("bits"), id_.cast("string").alias("id"), text.cast("string").alias("text"))
    described = F.array(row(F.lit("DE"), F.coalesce("__de.bits", F.lit(0.0)), F.lit(""), F.coalesce("__de.what", F.lit(NOTHING))))
    terms = F.transform("__terms.what", lambda t: row(t["ontology"], F.col("__terms.bits"), t["id"], t["text"]))
    rows = F.when(F.col("__terms").isNull(), described).otherwise(F.concat(described, terms))
    return blocks.select(key, F.inline(rows))
