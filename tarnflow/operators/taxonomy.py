"""Taxonomies as parent tables: lineages, common ancestors, ranks, trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import ancestors


def lineage(nodes: DataFrame, node: str, parent: str, name: str, rank: str | None = None, skip: str = "no rank") -> DataFrame:
    """(node, lineage): names from the root down, without nodes of rank ``skip``."""
    up = ancestors(nodes.filter(F.col(parent).isNotNull()), node, parent, nodes.select(node))
    named = up.join(nodes.select(F.col(node).alias("ancestor"), F.col(name).alias("__name"), (F.col(rank) if rank else F.lit("")).alias("__rank")), "ancestor")
    kept = named.filter(F.col("__rank") != skip) if rank else named
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), F.col("__name").alias("n"))))
    return kept.groupBy("node").agg(F.array_join(F.transform(pairs, lambda p: p["n"]), "; ").alias("lineage"))


def common_ancestor(pairs: DataFrame, closure: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, ancestor, path): the nearest common ancestor (ties: least)
    and the steps between both over it."""
    a = pairs.join(closure.select(F.col("node").alias(left), "ancestor", F.col("distance").alias("da")), left)
    both = a.join(closure.select(F.col("node").alias(right), "ancestor", F.col("distance").alias("db")), [right, "ancestor"])
    return both.groupBy(left, right).agg(F.min(F.struct((F.col("da") + F.col("db")).alias("path"), "ancestor")).alias("m")).select(left, right, "m.ancestor", "m.path")


def depth(closure: DataFrame) -> DataFrame:
    """(node, depth): steps to the farthest root."""
    return closure.groupBy("node").agg(F.max("distance").alias("depth"))


def leaf_sets(closure: DataFrame, leaves: DataFrame) -> DataFrame:
    """(node, leaves): the leaves below each node, sorted."""
    below = closure.join(leaves.select(F.col(leaves.columns[0]).alias("node")), "node", "left_semi")
    return below.groupBy(F.col("ancestor").alias("node")).agg(F.array_sort(F.collect_set("node")).alias("leaves"))


def compatible(a: Column, b: Column) -> Column:
    """Whether two leaf sets are nested or disjoint."""
    shared = F.size(F.array_intersect(a, b))
    return (shared == 0) | (shared == F.size(a)) | (shared == F.size(b))


def tree_metrics(edges: DataFrame, child: str, parent: str, length: str) -> DataFrame:
    """One row: nodes, leaves, total branch length."""
    nodes = edges.select(F.col(child).alias("n")).union(edges.select(parent)).distinct()
    leaves = edges.select(F.col(child).alias("n")).distinct().join(edges.select(F.col(parent).alias("n")), "n", "left_anti")
    counts = nodes.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(F.broadcast(leaves.agg(F.count(F.lit(1)).alias("leaves"))))
    return counts.crossJoin(F.broadcast(edges.agg(F.sum(length).alias("total_length"))))


def from_lineages(df: DataFrame, lineage_column: str) -> DataFrame:
    """(path, name, parent, depth) of the distinct nodes of lineage texts; a
    node is a name under its ancestors, so equal names elsewhere differ."""
    ranks = F.split(lineage_column, "; ")
    each = df.select(F.posexplode(ranks).alias("depth", "name"), ranks.alias("r")).withColumn("path", F.array_join(F.slice("r", 1, F.col("depth") + 1), "; "))
    parent = F.when(F.col("depth") > 0, F.array_join(F.slice("r", 1, F.col("depth")), "; "))
    return each.select("path", "name", parent.alias("parent"), "depth").distinct()
