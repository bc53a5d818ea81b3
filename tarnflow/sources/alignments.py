"""Alignments whose rows are spread over blocks of lines.

Lines are read by byte ranges, so a large file is split between tasks and each
line still has its place.  A line belongs to the last heading before it, and a
row's chunks are joined in the order of their places; headings that lie in
another part of the file are found through the parts' ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow.operators.splines import nearest

from .indexed import SPLIT, _files, _store

LINES = "path string, place long, line string"


def _lines(uri: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, _ = _store(uri)
    for b in batches:
        for path, low, high in zip(*(b.column(c).to_pylist() for c in ("path", "low", "high"))):
            with store.open_input_file(path) as f:
                # One byte before the range tells whether its first line begins there.
                f.seek(max(0, low - 1))
                data = bytearray(f.read(high - max(0, low - 1)))
                while not data.endswith(b"\n") and (more := f.read(1 << 12)):
                    cut = more.find(b"\n")
                    data += more[: cut + 1] if cut >= 0 else more
            at = 0 if low == 0 else data.find(b"\n") + 1
            places, lines = [], []
            base = max(0, low - 1)
            while (low == 0 or at) and at < len(data) and base + at < high:
                stop = data.find(b"\n", at)
                stop = len(data) if stop < 0 else stop
                places.append(base + at)
                lines.append(data[at:stop].decode("utf-8", "replace").rstrip("\r"))
                at = stop + 1
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(lines, pa.string())], ["path", "place", "line"])


def placed_lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, place, line) of every line; place is its first byte's."""
    parts = [(p, low, min(low + split, size)) for p, size in _files(path) for low in range(0, size, split)]
    ranges = spark.createDataFrame(parts, "path string, low long, high long").repartition(max(1, len(parts)))
    return ranges.mapInArrow(partial(_lines, path), LINES)


def under_headings(lines: DataFrame, heading: Column) -> DataFrame:
    """(path, heading_place, heading, place, line) of lines that come after a
    heading: a line for which the column isn't null.  Headings themselves, and
    lines before the first one, are left out."""
    marked = nearest(lines, "path", ["place"], F.when(heading.isNotNull(), F.struct(F.col("place").alias("at"), heading.alias("heading"))), "above", "below")
    return marked.filter(heading.isNull() & F.col("above").isNotNull()).select("path", F.col("above.at").alias("heading_place"), F.col("above.heading").alias("heading"), "place", "line")


def _stitch_report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Model, match and query rows of each domain: three lines and a blank one a
    block, as wide as the block's model row."""
    import re

    for b in batches:
        rows = []
        for lines, last in zip(b.column("lines").to_pylist(), b.column("end").to_pylist()):
            model, match, query = [], [], []
            for i in range(0, len(lines) - 2, 4):
                first, second, third = lines[i : i + 3]
                found = re.search(r"[ATGC.atgc]+", first)
                if not found:
                    break
                # Rows begin at one column; the first block has a mark in front of it.
                at, width = 19 + 3 * ("*->" in first), len(found[0])
                model.append(found[0])
                match.append(second[at : at + width].ljust(width))
                query.append(third[at : at + width].ljust(width))
                ended = re.search(r"\s(\d+)\s*$", third)
                if ended and int(ended[1]) == last:
                    break
            rows.append(("".join(model), "".join(match), "".join(query)))
        keep = [c for c in b.schema.names if c != "lines"]
        made = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *made], [*keep, "model_string", "match_string", "query_string"])


def hmm_alignments(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, seq, domain, domains, start, end, model_string, match_string,
    query_string): alignments of a search report, a row for each heading
    ``seq: domain k of n, from a to b`` with its blocks stitched together."""
    pattern = r"^(\S+):\s+domain (\d+) of (\d+), from (\d+) to (\d+)"
    lines = placed_lines(spark, path, split)
    heading = F.when(F.col("line").rlike(pattern), F.col("line"))
    part = lambda i: F.regexp_extract("heading", pattern, i)
    own = under_headings(lines, heading).groupBy("path", "heading_place", "heading").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]).alias("lines"))
    base = own.select("path", part(1).alias("seq"), part(2).cast("int").alias("domain"), part(3).cast("int").alias("domains"), part(4).cast("long").alias("start"), part(5).cast("long").alias("end"), "lines")
    return base.mapInArrow(_stitch_report, "path string, seq string, domain int, domains int, start long, end long, model_string string, match_string string, query_string string")


def report_with_alignments(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """hmm_report's hits with their alignments, null where a report has none."""
    from .text_formats import hmm_report

    own = hmm_alignments(spark, path, split).select("seq", "domain", "model_string", "match_string", "query_string")
    return hmm_report(spark, path).join(own, ["seq", "domain"], "left")


def stockholm(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, alignment, kind, name, feature, text): rows of interleaved Stockholm
    alignments.  kind is 'row' for a sequence (text is all its chunks), 'GC' and
    'GR' for a column's and a residue's annotation (chunks joined too), 'GF' and
    'GS' for free text (lines joined by a blank); alignment counts the file's
    alignments from 1 in order."""
    lines = placed_lines(spark, path, split).filter(F.trim("line") != "")
    head = F.when(F.col("line").startswith("# STOCKHOLM"), F.col("line"))
    own = under_headings(lines, head).filter(~F.col("line").startswith("//"))
    mark = F.regexp_extract("line", r"^#=(G[CRFS])", 1)
    named = own.withColumn("kind", F.when(mark != "", mark).when(~F.col("line").startswith("#"), F.lit("row"))).filter("kind is not null")
    get = lambda pattern, i: F.regexp_extract("line", pattern, i)
    one, two = r"^#=G[CF]\s+(\S+)\s+(.*?)\s*$", r"^#=G[RS]\s+(\S+)\s+(\S+)\s+(.*?)\s*$"
    single, double = F.col("kind").isin("GC", "GF"), F.col("kind").isin("GR", "GS")
    chunks = named.select(
        "path", "heading_place", "place", "kind",
        F.when(single, "").when(double, get(two, 1)).otherwise(get(r"^(\S+)", 1)).alias("name"),
        F.when(single, get(one, 1)).when(double, get(two, 2)).otherwise("").alias("feature"),
        F.when(single, get(one, 2)).when(double, get(two, 3)).otherwise(get(r"^\S+\s+(\S+)\s*$", 1)).alias("chunk"),
    )
    joined = chunks.groupBy("path", "heading_place", "kind", "name", "feature").agg(F.array_sort(F.collect_list(F.struct("place", "chunk"))).alias("c"), F.min("place").alias("first"))
    parts = F.transform("c", lambda x: x["chunk"])
    text = F.when(F.col("kind").isin("GF", "GS"), F.array_join(parts, " ")).otherwise(F.array_join(parts, ""))
    # Few rows: one for each alignment of a file.
    from pyspark.sql import Window

    numbered = joined.select("path", "heading_place").distinct().withColumn("alignment", F.row_number().over(Window.partitionBy("path").orderBy("heading_place")))
    return joined.withColumn("text", text).join(numbered, ["path", "heading_place"]).select("path", "alignment", "kind", "name", "feature", "text", "first")


def write_stockholm(rows: DataFrame, path: str, width: int = 60) -> None:
    """Writes alignments (alignment, name, text[, order]) as interleaved Stockholm
    text, one file a task: a row's text in chunks of ``width``, a block for each.
    An alignment's rows have texts of one length and are put together in one task."""
    blocks = F.sequence(F.lit(0), F.ceil(F.greatest(F.length("text"), F.lit(1)) / width).cast("int") - 1)
    order = F.col("order") if "order" in rows.columns else F.col("name")
    each = rows.select("alignment", "name", order.alias("o"), F.posexplode(F.transform(blocks, lambda b: F.substring("text", b * width + 1, F.lit(width)))).alias("block", "chunk"))
    line = F.concat(F.col("name"), F.lit("  "), F.col("chunk"))
    blocked = each.groupBy("alignment", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    whole = blocked.groupBy("alignment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "lines"))), lambda x: x["lines"]), "\n\n").alias("body"))
    whole.select(F.concat(F.lit("# STOCKHOLM 1.0\n"), F.col("body"), F.lit("\n//")).alias("value")).write.mode("overwrite").text(path)
