"""XPath's axes over tables of numbered nodes.

``reach`` gives the set of nodes on an axis from a set of context nodes: one pass
over a document's nodes in order, with running minima and maxima of the context's
numbers, so no pair of nodes is made.  ``on_axes`` does so for several axes at once,
from nodes that a condition chooses.  ``pairs`` gives (context, node) pairs by a
structural join, for positions that count from each context node.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Axes whose positions count backwards in document order.
REVERSE = ("ancestor", "ancestor-or-self", "parent", "preceding", "preceding-sibling")
AXES = (*REVERSE, "child", "descendant", "descendant-or-self", "following", "following-sibling", "self")

#: Nodes of a part, where whole documents are dealt out.
DEALT = 100_000


def _check(axis: str) -> None:
    if axis not in AXES:
        raise ValueError(f"no axis {axis}")


def reach(nodes: DataFrame, context: DataFrame, axis: str) -> DataFrame:
    """Rows of ``nodes`` that lie on the axis from any node of ``context`` (doc,
    pre; each node once).  One document's nodes are ordered in one task."""
    _check(axis)
    chosen = context.select("doc", "pre").distinct()
    if axis == "self":
        return nodes.join(chosen, ["doc", "pre"], "left_semi")
    if axis == "child":
        return nodes.join(chosen.withColumnRenamed("pre", "parent"), ["doc", "parent"], "left_semi").select(*nodes.columns)
    marked = nodes.join(chosen.withColumn("__c", F.lit(True)), ["doc", "pre"], "left").select(*nodes.columns, F.coalesce("__c", F.lit(False)).alias("__c"))
    if axis.endswith("-sibling"):
        first, last = (f(F.when(F.col("__c"), F.col("pre"))).over(Window.partitionBy("doc", "parent")) for f in (F.min, F.max))
        keep = (first < F.col("pre") if axis == "following-sibling" else last > F.col("pre")) & F.col("parent").isNotNull()
        return marked.withColumn("__keep", keep).filter("__keep").select(*nodes.columns)
    if axis == "parent":
        folks = marked.filter("__c and parent is not null").select("doc", F.col("parent").alias("pre")).distinct()
        return nodes.join(folks, ["doc", "pre"], "left_semi")
    return marked.withColumn("__keep", _in_order()[axis]).filter("__keep").select(*nodes.columns)


def _in_order() -> dict[str, Column]:
    """The axes that follow from document order, over nodes of which __c marks the context."""
    # Both look back, one from the end: Spark reads a frame that ends with its
    # part anew for every row.
    whole, before = Window.partitionBy("doc"), (Window.unboundedPreceding, -1)
    pre, last = (F.when(F.col("__c"), F.col(c)) for c in ("pre", "last"))
    below = F.coalesce(F.max(last).over(whole.orderBy("pre").rowsBetween(*before)) >= F.col("pre"), F.lit(False))
    above = F.coalesce(F.min(pre).over(whole.orderBy(F.desc("pre")).rowsBetween(*before)) <= F.col("last"), F.lit(False))
    return {
        "self": F.col("__c"),
        "descendant": below,
        "descendant-or-self": below | F.col("__c"),
        "ancestor": above,
        "ancestor-or-self": above | F.col("__c"),
        "following": F.col("pre") > F.min(last).over(whole),
        "preceding": F.col("last") < F.max(pre).over(whole),
    }


def dealt(nodes: DataFrame) -> DataFrame:
    """Nodes dealt out by document, to a part for each DEALT nodes.  Left to itself
    Spark makes a part for each core, and what a task sorts grows with the input."""
    return nodes.repartition(max(1, ceil(nodes.count() / DEALT)), "doc")


def on_axes(nodes: DataFrame, context: Column, axes: tuple[str, ...] = AXES) -> DataFrame:
    """(*nodes, axis): each node with each of the axes on which it lies from any
    node for which ``context`` holds.  Documents are dealt out once; one document's
    nodes are ordered in one task."""
    for axis in axes:
        _check(axis)
    marked = dealt(nodes).withColumn("__c", F.coalesce(context, F.lit(False)))
    placed = marked.withColumns({f"__{k}": c for k, c in _in_order().items() if k in axes})
    # A family is a node and its children; a node is in its own and in its parent's.
    each = placed.withColumn("__as", F.explode(F.array(F.struct(F.col("pre").alias("of"), F.lit(True).alias("head")), F.struct(F.col("parent").alias("of"), F.lit(False).alias("head")))))
    each = each.filter("__as.of is not null").withColumns({"__of": F.col("__as.of"), "__head": F.col("__as.head")})
    head, family, pre = F.col("__head"), Window.partitionBy("doc", "__of"), F.col("pre")
    chosen = lambda f, who, what: f(F.when(who & F.col("__c"), what)).over(family)
    near = {
        "parent": head & chosen(F.max, ~head, F.lit(True)),
        "child": ~head & chosen(F.max, head, F.lit(True)),
        "following-sibling": ~head & (chosen(F.min, ~head, pre) < pre),
        "preceding-sibling": ~head & (chosen(F.max, ~head, pre) > pre),
    }
    flags = {k: near[k] if k in near else head & F.col(f"__{k}") for k in axes}
    each = each.withColumn("__on", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()])))
    return each.select(*nodes.columns, F.explode("__on").alias("axis"))


def pairs(nodes: DataFrame, context: DataFrame, axis: str) -> DataFrame:
    """(from_pre, *nodes): each context node with each node on its axis.  Pairs
    grow with what they are: a document's following nodes are many."""
    _check(axis)
    mine = context.select("doc", "pre").distinct()
    c = nodes.join(mine, ["doc", "pre"], "left_semi").select("doc", F.col("pre").alias("from_pre"), F.col("last").alias("from_last"), F.col("parent").alias("from_parent"))
    pre, last, parent = F.col("pre"), F.col("last"), F.col("parent")
    a, z, p = F.col("from_pre"), F.col("from_last"), F.col("from_parent")
    same = parent == p
    on: dict[str, Column] = {
        "self": pre == a,
        "child": parent == a,
        "parent": pre == p,
        "descendant": (pre > a) & (pre <= z),
        "descendant-or-self": (pre >= a) & (pre <= z),
        "ancestor": (pre < a) & (last >= a),
        "ancestor-or-self": (pre <= a) & (last >= a),
        "following": pre > z,
        "preceding": last < a,
        "following-sibling": same & (pre > a),
        "preceding-sibling": same & (pre < a),
    }
    return c.join(nodes, "doc").filter(on[axis]).select("from_pre", *nodes.columns)


def test(name: str | None = "*") -> Column:
    """A node test: a name, * for any element, text() or comment(), None for any node."""
    if name is None:
        return F.lit(True)
    if name.endswith("()"):
        return F.col("kind") == name[:-2]
    element = F.col("kind") == "element"
    return element if name == "*" else element & (F.col("name") == name)


def locate(nodes: DataFrame, steps: list[tuple], context: DataFrame | None = None) -> DataFrame:
    """Rows of ``nodes`` at the end of a location path.

    steps: (axis, node test) or (axis, node test, predicate) with a column over
    a node's row, or a position from 1, which counts along the axis from each
    context node.  The path begins at ``context``, or above the documents' top.
    """
    at = context
    for axis, name, *predicate in steps:
        want = predicate[0] if predicate else None
        if at is None:
            # Above the top, children are nodes without a parent and all are descendants.
            found = nodes.filter(test(name) & (F.col("parent").isNull() if axis == "child" else F.lit(True)))
            by = ["doc"]
        elif isinstance(want, int):
            found, by = pairs(nodes, at, axis).filter(test(name)), ["doc", "from_pre"]
        else:
            found, by = reach(nodes, at, axis).filter(test(name)), ["doc"]
        if isinstance(want, int):
            w = Window.partitionBy(*by).orderBy(F.col("pre").desc() if axis in REVERSE else F.col("pre"))
            found = found.withColumn("__at", F.row_number().over(w)).filter(F.col("__at") == want).select(*nodes.columns).dropDuplicates(["doc", "pre"])
        elif want is not None:
            found = found.filter(want)
        at = found
    return at


def attributes(nodes: DataFrame, context: DataFrame) -> DataFrame:
    """(doc, pre, name, value) of the context nodes' attributes."""
    return reach(nodes, context, "self").select("doc", "pre", F.explode("attributes").alias("name", "value"))


def string_values(nodes: DataFrame, context: DataFrame) -> DataFrame:
    """(doc, pre, value): each context node's text with that of all below it, in
    document order; empty if there is none."""
    texts = nodes.filter("kind = 'text'").select("doc", F.col("pre").alias("at"), F.col("value").alias("__v"))
    spans = reach(nodes, context, "self").select("doc", "pre", "last")
    joined = spans.join(texts, (spans["doc"] == texts["doc"]) & (F.col("at") >= F.col("pre")) & (F.col("at") <= F.col("last")), "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "__v"))))
    return joined.groupBy(spans["doc"], "pre").agg(F.array_join(F.transform(parts, lambda x: x["__v"]), "").alias("value"))
