"""Writers of tabular and record-structured text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnflow.functions.text import wrap


def sheet(df: DataFrame, path: str, hide: tuple[str, ...] = (), status: str | None = None, header: bool = True) -> None:
    """Tab-separated text; hidden columns and rows whose status is false are
    left out, nulls are written as the missing-value mark."""
    rows = df.filter(F.coalesce(F.col(status), F.lit(True))) if status else df
    visible = [c for c in rows.columns if c not in hide and c != status]
    flat = [F.coalesce((F.array_join(c, " ") if rows.schema[c].dataType.typeName() == "array" else F.col(c)).cast("string"), F.lit("n.d.")).alias(c) for c in visible]
    rows.select(*flat).write.mode("overwrite").option("sep", "\t").option("header", header).option("quote", "\u0000").csv(path)


def fasta_records(df: DataFrame, tags: dict[str, Column], width: int = 60) -> DataFrame:
    """(record): header with [key=value] tags, then the wrapped sequence."""
    text = [F.concat(F.lit(f"[{k}="), v.cast("string"), F.lit("]")) for k, v in tags.items()]
    head = F.concat_ws(" ", F.concat(F.lit(">"), F.col("id")), *text)
    return df.select(F.concat(head, F.lit("\n"), wrap(F.col("seq"), width)).alias("record"))


def fasta(df: DataFrame, path: str, tags: dict[str, Column] | None = None, width: int = 60) -> None:
    fasta_records(df, tags or {}, width).write.mode("overwrite").text(path)


def feature_lines(df: DataFrame) -> DataFrame:
    """(seq_id, start, end, lines) of features (primary_tag, seq_id, start, end,
    strand, start_partial, end_partial, tags: map to arrays): the ends are
    swapped on the reverse strand, open ends are marked, tags without a value
    are their name alone and empty ones are left out."""
    lo = F.concat(F.when(F.col("start_partial"), "<").otherwise(""), F.col("start").cast("string"))
    hi = F.concat(F.when(F.col("end_partial"), ">").otherwise(""), F.col("end").cast("string"))
    first = F.when(F.col("strand") == -1, F.concat_ws("\t", hi, lo, "primary_tag")).otherwise(F.concat_ws("\t", lo, hi, "primary_tag"))
    pairs = F.flatten(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.transform(F.filter(e["value"], lambda v: v.isNotNull() & (v != "") & (v != "0")), lambda v: F.when(v == "_no_value", F.concat(F.lit("\t\t\t"), e["key"])).otherwise(F.concat(F.lit("\t\t\t"), e["key"], F.lit("\t"), v)))))
    return df.select("seq_id", "start", "end", F.array_join(F.concat(F.array(first), pairs), "\n").alias("lines"))


def feature_table(df: DataFrame, path: str) -> None:
    """One text file a sequence group, features by start and then longest first."""
    rows = feature_lines(df)
    rows.repartition("seq_id").sortWithinPartitions("seq_id", "start", F.desc("end")).select(F.concat(F.lit(">Feature "), "seq_id", F.lit("\n"), "lines").alias("value")).write.mode("overwrite").text(path)


def structured_comment(df: DataFrame) -> DataFrame:
    """(line): counts of features by kind, tab-separated."""
    return df.groupBy("primary_tag").agg(F.count(F.lit(1)).alias("n")).select(F.concat_ws("\t", "primary_tag", F.col("n").cast("string")).alias("line"))


def xml(df: DataFrame, path: str, row: str = "entry", root: str = "entries") -> None:
    df.write.mode("overwrite").format("xml").option("rowTag", row).option("rootTag", root).save(path)


def intermediate(df: DataFrame, path: str, keys: list[str]) -> None:
    """Parquet in sorted ranges of the keys, so that readers prune by min and max."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def gff_lines(df: DataFrame, source: str, comments: list[str] = []) -> DataFrame:  # noqa: B006
    """(value): lines of a feature file in nine tab-separated columns, of
    entries (seq_id, feature, start, end, score, strand, frame, attribute);
    what is missing is a full stop."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    sign = F.when(F.col("strand").cast("string").isin("1", "+"), "+").when(F.col("strand").cast("string").isin("-1", "-"), "-").otherwise(".")
    return df.select(F.concat_ws("\t", dot("seq_id"), F.lit(source), dot("feature"), F.least("start", "end").cast("string"), F.greatest("start", "end").cast("string"), dot("score"), sign, dot("frame"), dot("attribute")).alias("value"))


def gff(df: DataFrame, path: str, source: str) -> None:
    """gff_lines as files, by sequence and place."""
    ordered = df.repartition("seq_id").sortWithinPartitions("seq_id", "start", "end")
    gff_lines(ordered, source).write.mode("overwrite").text(path)


def suppressed_hits(hits: DataFrame, path: str, columns: list[str]) -> None:
    """Hits that a merge left out, tab-separated, for files of their own."""
    hits.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).write.mode("overwrite").option("sep", "\t").option("header", False).csv(path)


def report_rows(predictions: DataFrame, block: str, kind: str, score: str, most: int = 10) -> DataFrame:
    """What a report shows: each block's best ``most`` predictions of a kind,
    with a colour from 0 to 100 by precision (column ppv); rendering is left to
    others."""
    w = Window.partitionBy(block, kind).orderBy(F.desc(score), "id")
    ranked = predictions.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)
    return ranked.withColumn("colour", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("ppv", F.lit(0.0)))) * 100 + 1e-9).cast("int"))


def ranked_hits(hits: DataFrame, block: str) -> DataFrame:
    """Hits for an exchange format: rank by bits, coverages as percent with one
    place behind the point."""
    w = Window.partitionBy(block).orderBy(F.desc("bits"), "spid")
    return hits.withColumns({"rank": F.row_number().over(w), "qcov": F.round(F.col("qcov") * 100, 1), "scov": F.round(F.col("scov") * 100, 1)})
