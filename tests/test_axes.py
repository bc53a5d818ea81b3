"""Axes, location paths and node tables against a document object model."""

import random
from xml.dom import minidom

import pytest
from pyspark.sql import functions as F

from tarnflow.operators import axes
from tarnflow.sources import markup


def random_xml(rng, depth=0):
    inner = "".join(random_xml(rng, depth + 1) if rng.random() < 0.6 else rng.choice(["text ", "<!--c-->", "&amp;x"]) for _ in range(rng.randint(0, 4))) if depth < 5 else ""
    name = rng.choice("abc")
    return f"<{name} k='{rng.randint(0, 3)}'>{inner}</{name}>"


def dom_axes(source):
    """{axis: {pre: set of pre}} by walking a DOM."""
    order, number = [], {}

    def visit(n):
        number[n] = len(order)
        order.append(n)
        for c in n.childNodes:
            visit(c)

    minidom.Node.__hash__ = object.__hash__
    visit(minidom.parseString(source).documentElement)

    def up(n):
        out = []
        while n.parentNode in number:
            n = n.parentNode
            out.append(n)
        return out

    def below(n):
        return [x for c in n.childNodes for x in (c, *below(c))]

    def beside(n, step):
        out = []
        while n is not order[0] and (n := getattr(n, step)):
            out.append(n)
        return out

    found = {a: {} for a in axes.AXES}
    for n in order:
        anc, desc = up(n), below(n)
        sets = {"self": [n], "ancestor": anc, "ancestor-or-self": [n, *anc], "parent": anc[:1], "child": list(n.childNodes), "descendant": desc, "descendant-or-self": [n, *desc],
                "following-sibling": beside(n, "nextSibling"), "preceding-sibling": beside(n, "previousSibling"),
                "following": [x for m in (n, *anc) for s in beside(m, "nextSibling") for x in (s, *below(s))],
                "preceding": [x for m in (n, *anc) for s in beside(m, "previousSibling") for x in (s, *below(s))]}
        for a, nodes in sets.items():
            found[a][number[n]] = {number[x] for x in nodes}
    return order, found


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(8)
    docs = []
    while len(docs) < 6:
        source = f"<r>{random_xml(rng)}{random_xml(rng)}</r>"
        if 12 < source.count("<") < 90:
            docs.append((len(docs), source))
    table = spark.createDataFrame([*docs, (90, None), (91, ""), (None, "<a/>")], "id long, source string")
    return docs, markup.shred(table, "id", "source", html=False).cache()


def test_numbers(documents):
    docs, nodes = documents
    got = {(r.doc, r.pre): r for r in nodes.collect()}
    assert {d for d, _ in got} == {d for d, _ in docs}
    for d, source in docs:
        order, found = dom_axes(source)
        for pre, n in enumerate(order):
            r = got[d, pre]
            assert (r.name, r.value) == ((n.tagName, None) if n.nodeType == 1 else (None, n.data))
            assert set(range(pre + 1, r.last + 1)) == found["descendant"][pre] and r.level == len(found["ancestor"][pre])
            assert {r.parent} - {None} == found["parent"][pre]
            if n.nodeType == 1:
                assert r.attributes == dict(n.attributes.items())


@pytest.mark.parametrize("axis", axes.AXES)
def test_axes(documents, axis):
    docs, nodes = documents
    some = nodes.filter("pre % 5 = 2")
    chosen = {(r.doc, r.pre) for r in some.collect()}
    want_pairs = {(d, a, b) for d, s in docs for a, to in dom_axes(s)[1][axis].items() if (d, a) in chosen for b in to}
    got = [(r.doc, r.from_pre, r.pre) for r in axes.pairs(nodes, some, axis).collect()]
    assert len(got) == len(set(got)) and set(got) == want_pairs
    reached = [(r.doc, r.pre) for r in axes.reach(nodes, some, axis).collect()]
    assert len(reached) == len(set(reached)) and set(reached) == {(d, b) for d, _, b in want_pairs}


def test_all_axes_at_once(spark, documents, monkeypatch):
    docs, nodes = documents
    monkeypatch.setattr(axes, "DEALT", 20)
    chosen = F.col("pre") % 5 == 2
    found = axes.on_axes(nodes, chosen)
    assert "unboundedfollowing" not in axes.reach(nodes, nodes.filter(chosen), "ancestor")._jdf.queryExecution().toString().lower()
    # As many parts as nodes ask for, all through.
    n = nodes.count()
    assert n > 100 and found.groupBy("doc", "axis").count().rdd.getNumPartitions() == -(-n // 20)
    got = [(r.axis, r.doc, r.pre) for r in found.collect()]
    want = {(axis, d, b) for d, s in docs for axis, found in dom_axes(s)[1].items() for a, to in found.items() if a % 5 == 2 for b in to}
    assert len(got) == len(set(got)) and set(got) == want
    assert {(r.axis, r.pre) for r in axes.on_axes(nodes, F.lit(None).cast("boolean")).collect()} == set()
    with pytest.raises(ValueError):
        axes.on_axes(nodes, chosen, ("sideways",))


def test_paths(documents):
    docs, nodes = documents
    got = {(r.doc, r.pre) for r in axes.locate(nodes, [("descendant", "a"), ("ancestor", "*", 1), ("child", "b", F.col("attributes")["k"] == "1"), ("following-sibling", None, 2)]).collect()}
    want = set()
    for d, s in docs:
        order, found = dom_axes(s)
        is_a = [i for i, n in enumerate(order) if n.nodeType == 1 and n.tagName == "a"]
        up = {max(found["ancestor"][i]) for i in is_a if found["ancestor"][i]}
        kids = {k for i in up for k in found["child"][i] if order[k].nodeType == 1 and order[k].tagName == "b" and order[k].getAttribute("k") == "1"}
        want |= {(d, sorted(found["following-sibling"][k])[1]) for k in kids if len(found["following-sibling"][k]) > 1}
    assert got == want
    values = {(r.doc, r.pre): r.value for r in axes.string_values(nodes, nodes.filter("kind = 'element'")).collect()}
    for d, s in docs:
        order, found = dom_axes(s)
        for i, n in enumerate(order):
            if n.nodeType == 1:
                assert values[d, i] == "".join(order[k].data for k in sorted(found["descendant"][i]) if order[k].nodeType == 3)
    with pytest.raises(ValueError):
        axes.reach(nodes, nodes, "sideways")


def test_html(spark):
    page = "<!doctype html><p class=x>one<p>two<br><b>bold<ul><li>a<li>b<ul><li>c</ul></ul><!-- d --><script>if (a<b) '</p>'</script><table><tr><td>1<td>2<tr><td>3</table></div>&amp;"
    nodes = markup.shred(spark.createDataFrame([(1, page)], "id long, html string"), "id", "html").collect()
    tree = {}
    for r in nodes:
        tree.setdefault(r.parent, []).append(r.name or (r.kind, r.value))
    names = {r.pre: r.name for r in nodes}
    assert tree[None] == ["p", "p", "ul", ("comment", " d "), "script", "table", ("text", "&")]
    assert [names[p] for p in tree if p is not None and names[p] == "tr"] == ["tr", "tr"]
    assert sorted(str(tree[p]) for p in tree if p is not None and names[p] == "ul") == ["['li', 'li']", "['li']"]
    assert markup.shred(spark.createDataFrame([], "id long, html string"), "id", "html").count() == 0
