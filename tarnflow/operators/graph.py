"""Directed acyclic ontologies and undirected components.

Closures and components are loops of joins whose state is stored at each step,
so a lost executor costs one step; nothing is gathered on the driver.
"""

from __future__ import annotations

import tempfile
from itertools import count
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _shared(spark) -> str:
    """The folder of checkpoints: spark.checkpoint.dir's, or a local one where
    none is set and driver and executors are one machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tarnflow-"))
    return sc._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    _shared(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Columns in files of the shared folder.  Unlike a checkpoint's rows they are
    compressed, only those that are used are read, and Spark knows their size when it
    chooses what to broadcast."""
    spark = df.sparkSession
    path = f"{_shared(spark)}/{uuid4().hex}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ancestors(edges: DataFrame, child: str, parent: str, nodes: DataFrame | None = None, depth: int | None = None) -> DataFrame:
    """(node, ancestor, distance): all pairs with their least distance, self at
    0.  A step joins the newest pairs with the edges; pairs that are known at
    a smaller distance aren't followed again, so it ends for any graph.  Paths
    longer than ``depth``, if that is given, are an error."""
    e = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).filter("node is not null and ancestor is not null").distinct()
    every = nodes.select(F.col(nodes.columns[0]).alias("node")) if nodes is not None else e.select("node").union(e.select("ancestor"))
    known = stored(every.distinct().select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")))
    newest = known
    step = e.withColumnRenamed("node", "via").withColumnRenamed("ancestor", "next")
    for d in count(1):
        reached = newest.join(step, F.col("ancestor") == F.col("via")).select("node", F.col("next").alias("ancestor")).distinct()
        newest = stored(reached.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti").withColumn("distance", F.lit(d)))
        if newest.isEmpty():
            return known
        if d == depth:
            raise ValueError(f"paths of {depth} steps or more: is there a cycle?")
        known = known.unionByName(newest)


def propagate(annotations: DataFrame, closure: DataFrame, key: str, term: str) -> DataFrame:
    """(key, term): each annotation and all its ancestors, once."""
    return annotations.join(closure, F.col(term) == F.col("node")).select(key, F.col("ancestor").alias(term)).distinct()


def propagate_weight(annotations: DataFrame, closure: DataFrame, key: str, term: str, weight: str) -> DataFrame:
    """(key, term, weight): the greatest weight of any annotation below."""
    return annotations.join(closure, F.col(term) == F.col("node")).groupBy(key, F.col("ancestor").alias(term)).agg(F.max(weight).alias(weight))


def information_content(term_counts: DataFrame, parent_counts: DataFrame, term: str) -> DataFrame:
    """(term, count, parent_count, ic): -log2 of a term's count over that of its
    parents, each with one pseudo-count, at least 0."""
    both = term_counts.join(parent_counts, term)
    return both.withColumn("ic", F.greatest(F.lit(0.0), -F.log2((F.col("count") + 1) / (F.col("parent_count") + 1))))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that can be reached.  Every node takes
    its neighbours' least label and then its label's label, so labels cross a
    path in a number of rounds that grows with the path's logarithm at best and
    its length at worst.  Labels only fall, so it ends for any graph."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    both = stored(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component")))
    while True:
        around = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("m"))
        lower = labels.join(around, F.col("node") == F.col("u")).select("node", F.least("component", "m").alias("component"))
        jump = lower.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
        after = stored(lower.join(jump, F.col("component") == F.col("n2"), "left").select("node", F.least("component", F.coalesce("c2", "component")).alias("component")))
        moved = after.join(labels.withColumnRenamed("component", "was"), "node").filter("component <> was")
        if moved.isEmpty():
            return after
        labels = after


def non_redundant(ranked: DataFrame, closure: DataFrame, block: str, term: str, rank: str) -> DataFrame:
    """Greedy choice by rank within a block: a term is taken unless it is an
    ancestor or a descendant of one that was taken.  Rows are sorted by block and
    rank and pass once; a task holds what its present block has taken."""
    up = closure.filter("distance > 0").groupBy("node").agg(F.collect_list("ancestor").alias("ups"))
    rows = ranked.select(block, term, rank).join(up, F.col(term) == F.col("node"), "left").select(block, term, rank, F.coalesce("ups", F.array().cast(up.schema["ups"].dataType)).alias("ups"))

    def choose(frames):
        now, taken, above, started = None, set(), set(), False
        for p in frames:
            keep = []
            for b, t, ups in zip(p[block].tolist(), p[term].tolist(), p["ups"].tolist()):
                if not started or (b != now and not (pd.isna(b) and pd.isna(now))):
                    now, taken, above, started = b, set(), set(), True
                good = t not in above and taken.isdisjoint(ups)
                if good:
                    taken.add(t)
                    above.update(ups)
                keep.append(good)
            yield p.loc[keep, [block, term, rank]]

    return rows.repartition(block).sortWithinPartitions(block, rank, term).mapInPandas(choose, rows.select(block, term, rank).schema)


def jaccard_terms(pairs: DataFrame, closure: DataFrame, left: str, right: str) -> DataFrame:
    """Jaccard similarity of the ancestor sets of each pair of terms."""
    sets = closure.groupBy("node").agg(F.collect_set("ancestor").alias("s"))
    x = pairs.join(sets.withColumnRenamed("s", "sa"), F.col(left) == F.col("node")).drop("node")
    y = x.join(sets.withColumnRenamed("s", "sb"), F.col(right) == F.col("node")).drop("node")
    return y.select(left, right, (F.size(F.array_intersect("sa", "sb")) / F.size(F.array_union("sa", "sb"))).alias("jaccard"))


def lin(pairs: DataFrame, closure: DataFrame, ic: DataFrame, left: str, right: str) -> DataFrame:
    """Lin similarity: twice the greatest information content of a common
    ancestor over the sum of the terms' own; 0 where that sum is 0."""
    a = pairs.join(closure.select(F.col("node").alias(left), F.col("ancestor").alias("anc")), left)
    b = closure.select(F.col("node").alias(right), F.col("ancestor").alias("anc"))
    common = a.join(b, [right, "anc"]).join(ic.select(F.col(ic.columns[0]).alias("anc"), "ic"), "anc").groupBy(left, right).agg(F.max("ic").alias("shared"))
    own = lambda side, name: ic.select(F.col(ic.columns[0]).alias(side), F.col("ic").alias(name))
    out = pairs.join(common, [left, right], "left").join(own(left, "ia"), left, "left").join(own(right, "ib"), right, "left")
    return out.select(left, right, F.coalesce(F.try_divide(2 * F.col("shared"), F.col("ia") + F.col("ib")), F.lit(0.0)).alias("lin"))


def relatives(edges: DataFrame, child: str, parent: str, start: DataFrame, relation: str | None = None, relations: tuple[str, ...] = (), up: bool = True, depth: int | None = None, aliases: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """(node, relative, distance) of the nodes in ``start`` (one column),
    without themselves, nearest first.

    Edges are followed up to parents or down to children, those of the chosen
    ``relations`` alone if any are named, for ``depth`` steps at most; aliases
    (alias, id) stand for other nodes; ``most`` relatives of each node stay, by
    distance and then by name.
    """
    e = edges.filter(F.col(relation).isin(*relations)) if relation and relations else edges
    a, b = (child, parent) if up else (parent, child)
    step = stored(e.select(F.col(a).alias("via"), F.col(b).alias("next")).filter("via is not null and next is not null").distinct())
    first = start.select(F.col(start.columns[0]).alias("node")).distinct()
    if aliases is not None:
        named = aliases.select(F.col(aliases.columns[0]).alias("__alias"), F.col(aliases.columns[1]).alias("__id"))
        first = first.join(named, F.col("node") == F.col("__alias"), "left").select("node", F.coalesce("__id", "node").alias("relative"))
    else:
        first = first.withColumn("relative", F.col("node"))
    known = newest = stored(first.withColumn("distance", F.lit(0)))
    at = 0
    while depth is None or at < depth:
        at += 1
        reached = newest.join(step, F.col("relative") == F.col("via")).select("node", F.col("next").alias("relative")).distinct()
        newest = stored(reached.join(known.select("node", "relative"), ["node", "relative"], "left_anti").withColumn("distance", F.lit(at)))
        if newest.isEmpty():
            break
        known = known.unionByName(newest)
    out = known.filter("distance > 0")
    if most is not None:
        w = Window.partitionBy("node").orderBy("distance", "relative")
        out = out.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= most).drop("__r")
    return out


def degrees(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, predecessors, successors, kind): kind is source, sink or inner."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    each = e.select(F.col("a").alias("vertex"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(e.select(F.col("b").alias("vertex"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    sums = each.groupBy("vertex").agg(F.sum("i").alias("predecessors"), F.sum("o").alias("successors"))
    return sums.withColumn("kind", F.when(F.col("predecessors") == 0, "source").when(F.col("successors") == 0, "sink").otherwise("inner"))


def find_terms(terms: DataFrame, word: str, columns: list[str]) -> DataFrame:
    """Terms that hold a word in one of the columns, in any case."""
    hit = [F.lower(c).contains(word.lower()) for c in columns]
    return terms.filter(F.greatest(*[F.coalesce(h, F.lit(False)) for h in hit], F.lit(False)))


def coparents(edges: DataFrame, child: str, parent: str, relation: str) -> DataFrame:
    """(child, relation, parents): the sets of parents that a term has together."""
    return edges.groupBy(child, relation).agg(F.array_sort(F.collect_set(parent)).alias("parents"))


def resnik(pairs: DataFrame, closure: DataFrame, ic: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, shared): the greatest information content of a common
    ancestor; 0 where there is none."""
    a = pairs.join(closure.select(F.col("node").alias(left), F.col("ancestor").alias("anc")), left)
    b = closure.select(F.col("node").alias(right), F.col("ancestor").alias("anc"))
    common = a.join(b, [right, "anc"]).join(ic.select(F.col(ic.columns[0]).alias("anc"), "ic"), "anc").groupBy(left, right).agg(F.max("ic").alias("shared"))
    return pairs.join(common, [left, right], "left").select(left, right, F.coalesce("shared", F.lit(0.0)).alias("shared"))


def weighted_jaccard(pairs: DataFrame, closure: DataFrame, ic: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, weighted): information content of the common ancestors
    over that of all ancestors of either; 0 where that is 0."""
    valued = closure.select("node", "ancestor").join(ic.select(F.col(ic.columns[0]).alias("ancestor"), "ic"), "ancestor")
    totals = valued.groupBy("node").agg(F.sum("ic").alias("total"))
    a = pairs.join(valued.select(F.col("node").alias(left), F.col("ancestor").alias("anc"), "ic"), left)
    b = valued.select(F.col("node").alias(right), F.col("ancestor").alias("anc"))
    common = a.join(b, [right, "anc"]).groupBy(left, right).agg(F.sum("ic").alias("both"))
    own = lambda side, name: totals.select(F.col("node").alias(side), F.col("total").alias(name))
    out = pairs.join(common, [left, right], "left").join(own(left, "ta"), left, "left").join(own(right, "tb"), right, "left")
    both = F.coalesce("both", F.lit(0.0))
    return out.select(left, right, F.coalesce(F.try_divide(both, F.col("ta") + F.col("tb") - both), F.lit(0.0)).alias("weighted"))


def unlinked(edges: DataFrame, child: str, parent: str, leaves: bool) -> DataFrame:
    """Leaves (no child) or roots (no parent) of a graph."""
    kids, folks = edges.select(F.col(child).alias("node")).distinct(), edges.select(F.col(parent).alias("node")).distinct()
    return kids.join(folks, "node", "left_anti") if leaves else folks.join(kids, "node", "left_anti")
