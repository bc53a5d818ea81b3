"""Semantic scores of terms against lists of terms.

The best score of a term over a list needs few of the list's members: an inverted
index from (list, ancestor) to the members below it answers Lin's score without
any pair, and what it gives bounds the scores that do need pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored

SCORES = ("lin", "path_lin", "weighted_lin", "weighted_path_lin")


def _values(closure: DataFrame, ic: DataFrame, unknown: float | None) -> tuple[DataFrame, float]:
    """(node, ancestor, ic, node_ic) and what stands for a missing value, the
    greatest one if not given."""
    known = ic.select(F.col(ic.columns[0]).alias("ancestor"), F.col(ic.columns[1]).cast("double").alias("ic"))
    if unknown is None:
        unknown = known.agg(F.max("ic")).first()[0] or 0.0
    up = closure.select("node", "ancestor").distinct().join(known, "ancestor", "left").withColumn("ic", F.coalesce("ic", F.lit(float(unknown))))
    own = up.filter("node = ancestor").select("node", F.col("ic").alias("node_ic"))
    return up.join(own, "node"), float(unknown)


def pair_scores(pairs: DataFrame, values: DataFrame, db_size: Column, left: str, right: str) -> DataFrame:
    """(left, right, *SCORES) of distinct pairs that have an ancestor in common.

    shared is the greatest information content of a common ancestor.  lin is
    2 shared over the terms' own; path_lin takes instead what each term's path
    has alone, the terms themselves always included; the weighted ones are times
    1 - exp(-shared) / db_size.  0 where a denominator is 0.
    """
    up = values.select("node", "ancestor", "ic")
    a = pairs.select(left, right).distinct().join(up.select(F.col("node").alias(left), "ancestor", "ic"), left)
    both = a.join(up.select(F.col("node").alias(right), "ancestor"), [right, "ancestor"])
    met = both.groupBy(left, right).agg(
        F.max("ic").alias("shared"), F.sum("ic").alias("common"), F.max(F.col("ancestor") == F.col(left)).alias("has_left"), F.max(F.col("ancestor") == F.col(right)).alias("has_right")
    )
    sums = values.groupBy("node").agg(F.sum("ic").alias("all"), F.max("node_ic").alias("own"))
    x = met.join(sums.select(F.col("node").alias(left), F.col("all").alias("all_l"), F.col("own").alias("own_l")), left)
    x = x.join(sums.select(F.col("node").alias(right), F.col("all").alias("all_r"), F.col("own").alias("own_r")), right)
    alone = [F.col(f"all_{s}") - F.col("common") + F.when(F.col(f"has_{name}"), F.col(f"own_{s}")).otherwise(0) for s, name in (("l", "left"), ("r", "right"))]
    weight = 1 - F.exp(-F.col("shared")) / db_size
    lin = F.coalesce(F.try_divide(2 * F.col("shared"), F.col("own_l") + F.col("own_r")), F.lit(0.0))
    path = F.coalesce(F.try_divide(2 * F.col("shared"), alone[0] + alone[1]), F.lit(0.0))
    return x.select(left, right, lin.alias("lin"), path.alias("path_lin"), (weight * lin).alias("weighted_lin"), (weight * path).alias("weighted_path_lin"))


def list_scores(terms: DataFrame, lists: DataFrame, closure: DataFrame, ic: DataFrame, db_size: int, unknown: float | None = None) -> DataFrame:
    """(key, term, *SCORES): each score's maximum over the members of the term's list.

    terms: (key, term), lists: (key, member); closure: (node, ancestor), each node
    its own ancestor; ic: (term, value), a missing value counting as ``unknown``,
    the greatest if None.  Where a list is empty or its members aren't known all
    are -1; without an ancestor in common they are 0.  Repeated rows count once.

    Values must not fall from an ancestor to its descendant (an error otherwise),
    which is what makes the bounds hold:

    * max lin = max over ancestors a of the term of 2 ic(a) / (ic(term) + least ic
      of a member below a): each a gives at most the score of that member, and
      the best common ancestor of the best member gives its own.  So lists are
      met by (key, ancestor), not by member; weighted_lin likewise.
    * a member that shares s with a term at most has in common with it only
      ancestors of the term of s at most.  Their sum, and the least sum of a member
      below an ancestor, bound path_lin at each (key, ancestor) of a term.  The
      pair behind the greatest bound is worked out; only members whose own bound
      is greater than what it gives can have more.  Where a term's ancestors are a
      chain, as in trees, the bound is the score, and no other pair is looked at.
    """
    values, _ = _values(closure, ic, unknown)
    values = stored(values)
    if not values.filter(F.col("ic") > F.col("node_ic") + 1e-12).isEmpty():
        raise ValueError("information content falls below an ancestor's")
    size = F.lit(float(db_size))
    asked = stored(terms.select(F.col(terms.columns[0]).alias("key"), F.col(terms.columns[1]).alias("term")).distinct())
    members = lists.select(F.col(lists.columns[0]).alias("key"), F.col(lists.columns[1]).alias("member")).distinct()
    sums = values.groupBy("node").agg(F.sum("ic").alias("all"), F.max("node_ic").alias("own"))
    listed = stored(members.join(sums.withColumnRenamed("node", "member"), "member"))
    index = listed.join(values.select(F.col("node").alias("member"), "ancestor"), "member")
    least = index.groupBy("key", "ancestor").agg(F.min("own").alias("own_m"), F.min("all").alias("all_m"), F.min_by("member", F.struct("all", "member")).alias("member"))
    # Sums of a term's ancestors that are worth no more than one of them, with and without itself.
    upto = Window.partitionBy("node").orderBy("ic").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    other = F.when(F.col("ancestor") == F.col("node"), 0.0).otherwise(F.col("ic"))
    reach = values.select(F.col("node").alias("term"), "ancestor", "ic", "node_ic", F.sum("ic").over(upto).alias("up"), F.sum(other).over(upto).alias("up_t"), F.sum("ic").over(Window.partitionBy("node")).alias("all_t"))
    met = stored(asked.join(reach, "term").join(least, ["key", "ancestor"]))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    lin = ratio(2 * F.col("ic"), F.col("node_ic") + F.col("own_m"))
    weight = 1 - F.exp(-F.col("ic")) / size
    bound = lambda own, all_: ratio(2 * F.col("ic"), F.greatest("node_ic", F.col("all_t") - F.col("up_t")) + F.greatest(own, F.col(all_) - F.col("up")))
    path = bound("own_m", "all_m")
    seed = lambda c: F.max_by("member", F.struct(c, "ic", "member"))
    best = stored(met.groupBy("key", "term").agg(F.max(lin).alias("lin"), F.max(weight * lin).alias("weighted_lin"), F.array_distinct(F.array(seed(path), seed(weight * path))).alias("seeds")))

    seeds = stored(best.select("key", "term", F.explode("seeds").alias("member")))
    tops = lambda pairs: pairs.join(pair_scores(pairs, values, size, "term", "member"), ["term", "member"]).groupBy("key", "term").agg(F.max("path_lin").alias("path_lin"), F.max("weighted_path_lin").alias("weighted_path_lin"))
    first = stored(tops(seeds))
    more = lambda b: (b > F.col("path_lin") + 1e-13) | (weight * b > F.col("weighted_path_lin") + 1e-13)
    near = stored(met.drop("member").join(first, ["key", "term"]).filter(more(path)))
    pairs = stored(near.join(index, ["key", "ancestor"]).filter(more(bound("own", "all"))).select("key", "term", "member").distinct())
    top = first.unionByName(tops(pairs)).groupBy("key", "term").agg(F.max("path_lin").alias("path_lin"), F.max("weighted_path_lin").alias("weighted_path_lin"))
    found = best.drop("seeds").join(top, ["key", "term"], "left")
    empty = asked.join(listed.select("key").distinct().withColumn("some", F.lit(True)), "key", "left").join(found, ["key", "term"], "left")
    other = F.when(F.col("some"), 0.0).otherwise(-1.0)
    return empty.select("key", "term", *[F.coalesce(c, other).alias(c) for c in SCORES])


def list_jaccard(terms: DataFrame, lists: DataFrame, closure: DataFrame, penalty: float = 0.0) -> DataFrame:
    """(key, term, jaccard): the greatest Jaccard index of the term's ancestors
    (itself included) and a member's, ``penalty`` added to the denominator (1 at
    least); -1 for an empty list.  A term that the closure lacks is its own only
    ancestor.

    A member has in common with a term, below or at one of the term's ancestors
    of n ancestors, only ancestors of the term of n at most.  That and the fewest
    ancestors of a member there bound the index; as in ``list_scores`` the pair
    behind the greatest bound is worked out, and then members whose bound is
    greater.  In trees no other pair is looked at."""
    asked = stored(terms.select(F.col(terms.columns[0]).alias("key"), F.col(terms.columns[1]).alias("term")).distinct())
    members = lists.select(F.col(lists.columns[0]).alias("key"), F.col(lists.columns[1]).alias("member")).filter("member is not null").distinct()
    names = asked.select(F.col("term").alias("node")).union(members.select("member"))
    up = closure.select("node", "ancestor").union(names.select("node", F.col("node").alias("ancestor"))).filter("node is not null and ancestor is not null").distinct()
    up = stored(up.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("node"))))
    depth = up.select(F.col("node").alias("ancestor"), F.col("n").alias("depth")).distinct()
    index = members.join(up.withColumnRenamed("node", "member"), "member")
    least = index.groupBy("key", "ancestor").agg(F.min("n").alias("n_m"), F.min_by("member", F.struct("n", "member")).alias("member"))
    upto = Window.partitionBy("term").orderBy("depth").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    paths = up.withColumnsRenamed({"node": "term", "n": "n_t"}).join(depth, "ancestor", "left").withColumn("depth", F.coalesce("depth", F.lit(1)))
    paths = paths.withColumn("common", F.count(F.lit(1)).over(upto))
    met = stored(asked.join(paths, "term").join(least, ["key", "ancestor"]))
    index_of = lambda both, b: both / F.greatest(F.col("n_t") + F.col(b) - both + penalty, F.lit(1.0))
    # A member of fewer ancestors than that has no more in common, but others below it may.
    most = index_of(F.col("common"), "n_m")
    seeds = met.groupBy("key", "term").agg(F.max_by("member", F.struct(most, "depth", "member")).alias("member"))

    def tops(pairs: DataFrame) -> DataFrame:
        one = pairs.select("term", "member").distinct().join(up.withColumnsRenamed({"node": "term", "n": "n_t"}), "term")
        both = one.join(up.withColumnsRenamed({"node": "member", "n": "n_m"}), ["member", "ancestor"]).groupBy("term", "member", "n_t", "n_m").agg(F.count(F.lit(1)).alias("both"))
        scored = both.select("term", "member", index_of(F.col("both"), "n_m").alias("jaccard"))
        return pairs.join(scored, ["term", "member"]).groupBy("key", "term").agg(F.max("jaccard").alias("jaccard"))

    first = stored(tops(stored(seeds)))
    near = stored(met.drop("member").join(first, ["key", "term"]).filter(most > F.col("jaccard")))
    pairs = stored(near.join(index, ["key", "ancestor"]).filter(index_of(F.least("common", "n"), "n") > F.col("jaccard")).select("key", "term", "member").distinct())
    best = first.unionByName(tops(pairs)).groupBy("key", "term").agg(F.max("jaccard").alias("jaccard"))
    some = asked.join(members.select("key").distinct().withColumn("some", F.lit(True)), "key", "left").join(best, ["key", "term"], "left")
    other = F.when(F.col("some") & F.col("term").isNotNull(), 0.0).otherwise(-1.0)
    return some.select("key", "term", F.coalesce("jaccard", other).alias("jaccard"))
