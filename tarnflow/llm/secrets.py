"""Secret scan with corpus-wide ownership frequency; DataFrame functions only.

Candidates are the matches of three patterns.  Their values' hashes are
counted over the corpus by distinct repositories and distinct owners: a value
that many hold is an example that was copied, one that a single owner holds
and that looks random is likely live.  Live values add a span ``live``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.functions.arrays import running_before

from .common import materialise, text_or_empty

#: The base patterns, in the order of kinds.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
#: The same matches as AKIA[A-Z0-9]+ of 16 or more and [0-9a-f]+ of 32 or
#: more characters: a run that is too short has no part that is long enough.
MIN_ASSIGN = 8


@dataclass(frozen=True)
class Ownership:
    #: A value in so many repositories or with so many owners is an example.
    max_repositories: int = 3
    max_owners: int = 1
    #: A live-looking value has so many different characters, a digit and a letter.
    min_distinct: int = 8


def _places(text: Column, pattern: str) -> tuple[Column, Column]:
    """(matches, text between them), from which places follow."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _spans(kind: str, rank: int, matches: Column, between: Column, values: Column) -> Column:
    """Array of (start, rank, kind, end, value), in code points.  A match
    starts after all matches and gaps before it."""
    long = F.transform(matches, lambda m: F.length(m).cast("long"))
    gap = F.transform(F.slice(between, 1, F.size(matches)), lambda b: F.length(b).cast("long"))
    before = running_before(F.zip_with(long, gap, lambda m, b: m + b))
    starts = F.zip_with(before, gap, lambda a, b: (a + b).cast("int"))
    rows = F.zip_with(starts, F.zip_with(long, values, lambda m, v: F.struct(m.alias("m"), v.alias("v"))), lambda a, r: F.struct(a.alias("a"), r["m"].alias("m"), r["v"].alias("v")))
    span = lambda r: F.struct(r["a"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (r["a"] + r["m"]).cast("int").alias("end"), r["v"].alias("value"))
    return F.transform(rows, span)


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and spans: every candidate of each text, by start and kind."""
    kind = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"
    rows = docs.select(*keep, text_or_empty(text_col).alias("__t"))
    rows = rows.withColumns({f"__m{i}": F.regexp_extract_all("__t", F.lit(p), F.lit(0)) for i, p in enumerate(PATTERNS.values())})
    parts = []
    for i, (name, pattern) in enumerate(PATTERNS.items()):
        m = F.col(f"__m{i}")
        values = F.regexp_extract_all("__t", F.lit(pattern), F.lit(2)) if name == "assign" else m
        spans = _spans(name, i, m, F.split("__t", pattern, -1), values)
        if name == "assign":
            spans = F.filter(spans, lambda s: F.length(s["value"]) >= MIN_ASSIGN)
        parts.append(F.when(F.size(m) > 0, spans).otherwise(F.array().cast(kind)))
    return rows.select(*keep, F.array_sort(F.concat(*parts)).alias("spans"))


def _looks_random(value: Column, rule: Ownership) -> Column:
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (distinct >= rule.min_distinct) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source", rule: Ownership = Ownership()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example) of every row.

    A candidate's value is the password for ``assign`` and the whole match
    for the others; equal values of different kinds count together.  Its
    verdict is ``example`` with more than max_repositories distinct
    repositories or more than max_owners distinct owners, else ``live`` if it
    looks random, else neither.  A live candidate adds a span ``live`` over
    its value, after base spans that start there.

    Null texts are empty and have no candidates; a null owner or repository
    counts as one of its own kind; rows that repeat are counted once for
    ownership and returned each; long texts are read whole; an empty table
    gives an empty result; no other columns are read.
    """
    named = docs.select(F.col("doc_id"), F.col(repository).cast("string").alias("repo"), F.col(owner).cast("string").alias("owner"), F.col("text"))
    found = materialise(candidates(named, ["doc_id", "repo", "owner"]).withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = (
        found.filter(F.size("spans") > 0)
        .select("row", F.coalesce("repo", F.lit("\0")).alias("repo"), F.coalesce("owner", F.lit("\0")).alias("owner"), F.explode("spans").alias("s"))
        .withColumn("h", F.sha2(F.col("s.value").cast("binary"), 256))
    )
    # Distinct (hash, owner) and (hash, repository) first: both are summed in
    # each task before they move, so a value on a third of all rows is spread
    # over its repositories until only counts remain.
    by_repo = each.groupBy("h", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("h", "owner").agg(F.count(F.lit(1)).alias("repos"))
    owned = by_repo.groupBy("h").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))
    copied = (F.col("repos") > rule.max_repositories) | (F.col("owners") > rule.max_owners)
    verdicts = owned.select("h", copied.alias("example"))
    # The left side keeps its rows' partitions when Spark splits a hot hash.
    judged = each.join(verdicts, "h").withColumn("live", ~F.col("example") & _looks_random(F.col("s.value"), rule))
    z = F.col("s.end")
    live = F.struct((z - F.length("s.value")).alias("start"), F.lit(len(PATTERNS)).alias("rank"), F.lit("live").alias("kind"), z.alias("end"), F.lit(None).cast("string").alias("value"))
    by_row = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live"), live)).alias("more"),
        F.count_if("live").alias("n_live"),
        F.count_if("example").alias("n_example"),
    )
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    kinds = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in PATTERNS]
    none = F.array().cast(by_row.schema["more"].dataType)
    return found.join(by_row, "row", "left").select(
        "doc_id",
        *kinds,
        F.sha2(_joined(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("spans", F.coalesce("more", none)))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )
