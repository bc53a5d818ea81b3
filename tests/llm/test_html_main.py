"""Main text of pages: templates with and without marks, wrappers, tables."""

import html
import random
import re

import pytest

from tarnflow.llm import html_main as H

PROSE = "It was the {} day of the {}, and nobody at the harbour had seen the {} come in since the last storm."
WORDS = "first second third ship ferry lantern winter market baker tide mill orchard keeper letter road".split()


def sentences(rng, n):
    return [" ".join(PROSE.format(*rng.choices(WORDS, k=3)) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def plain_template(rng, paragraphs):
    """No names at all: a row of links, the article, a line that all pages have."""
    links = "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in rng.sample(WORDS, 5))
    body = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
    return f"<html><body><div>{links}</div><div>{body}</div><div>All rights reserved by the harbour gazette</div></body></html>"


def named_template(rng, paragraphs):
    """Class names and odd mark-up: ends left out, comments, forms, hidden parts."""
    body = "".join(f"<p class=lead>{html.escape(p)}" for p in paragraphs)
    extra = '<div class="ad-slot">Buy now</div>' if rng.random() < 0.5 else ""
    replies = "".join(f"<li class='comment'><p>{s}</p>" for s in sentences(rng, rng.randint(0, 3)))
    return (
        f"<!doctype html><body class='has-sidebar'><!-- <p>no</p> --><script>if (a < b) document.write('<p>no</p>')</script><div id=page><div class='site-header'><a href=/>Home</a> News</div>"
        f"<div role=alert>We use cookies</div><ul class=main-menu><li><a href=/a>A</a><li><a href=/b>B</a></ul><div class='post-content'>{body}{extra}<form><label>Name</label><input name=q>"
        f"<button>Go</button></form></div><div class=sidebar><p>{PROSE}</p></div><ol id=comments>{replies}</ol><div style='display: none'>unseen</div></div><footer>End</footer>"
    )


def marked_template(rng, paragraphs):
    body = "".join(f"<p><b>{html.escape(p)}</b>\n<br>" for p in paragraphs[1:])
    aside = "<aside><p>Elsewhere</p></aside>" if rng.random() < 0.5 else ""
    return f"<nav><ul><li><a href=/>Home</a></ul></nav><main><article><header><h1>{html.escape(paragraphs[0])}</h1></header>{body}{aside}</article><section class=comments><article><p>{' '.join(sentences(rng, 3))}</p></article></section></main><footer>x</footer>"


@pytest.mark.parametrize("template", [plain_template, named_template, marked_template])
def test_templates(spark, template):
    rng = random.Random(7)
    want, rows = {}, []
    for i in range(60):
        paragraphs = sentences(rng, rng.randint(2, 9))
        rows.append((i, f"https://Some.example.org:80/{i}", template(rng, paragraphs), "x", "x"))
        want[i] = "\n".join(paragraphs)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string").repartition(7)
    got = {r.page_id: r.text for r in H.main_texts(pages).collect()}
    assert got == want
    # Where decisions are too large to be sent, pages meet them in a join.
    assert {r.page_id: r.text for r in H.main_texts(pages, sent_bytes=-1).collect()} == want


def test_many_wrappers_of_a_host(spark, monkeypatch):
    """Wrappers meet in several steps."""
    monkeypatch.setattr(H, "MERGED", 3)
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(80):
        paragraphs = sentences(rng, 3)
        inner = "".join(f"<{t}>{html.escape(p)}</{t}>" for t, p in zip(rng.choices(["p", "pre", "blockquote", "h2", "h3"], k=3), paragraphs))
        rows.append((i, "http://one.example/", f"<div><a href=/>Home</a></div><div>{inner}</div>"))
        want[i] = "\n".join(paragraphs)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(20)
    assert H.host_wrappers(pages, H.url_host(pages.url)).count() == 1
    assert {r.page_id: r.text for r in H.main_texts(pages).collect()} == want


def test_copies_are_not_taken_for_a_template(spark):
    rows = [(i, "http://a.example/x", "<div><a href=/>Home</a></div><div><h1>Title</h1><p>The same text on every page of this site.</p></div>") for i in range(30)]
    got = H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Title\nThe same text on every page of this site."}


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    rows = [
        (1, None, None), (2, "http://b.example/", ""), (3, "not a url", "just text &amp; more &lt;b&gt; &copy &nbsp; x"), (None, "http://b.example/", "<article><p>a<p>b  c\n d</article>"),
        (5, "http://b.example/", deep), (6, "http://b.example/", "<p>open <b>tags <a href='x>y'>and</a> <!-- never closed"), (7, "http://b.example/", "<article><p>" + "long " * 50000 + "</article>"),
        (8, "http://c.example/", "<table><tr><td>one<td>two<tr><td>three</table>"), (8, "http://c.example/", "<table><tr><td>one<td>two<tr><td>three</table>"),
        (9, "http://d.example/", "<nav>only</nav><script>x</script>"), (10, "http://e.example/", "<p title=it's>one</p><p title='a>b'>two</p><p x=\"y>three</p>"),
    ]
    got = H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {}
    for r in got:
        assert r.n_chars == len(r.text)
        by.setdefault(r.page_id, []).append(r.text)
    assert by[1] == [""] and by[2] == [""] and by[9] == [""] and by[3] == ["just text & more <b> © x"]
    assert by[None] == ["a\nb c d"] and by[5] == ["deep text"] and by[6] == ["open tags and"] and by[7] == [("long " * 50000).strip()]
    assert by[8] == ["one\ntwo\nthree"] * 2 and by[10][0].startswith("one\ntwo")
    assert H.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_alignment():
    """Optional and repeated parts, groups that come again."""

    def wrapper(source):
        return H.page_wrapper(H.page_tree(source))

    def shape(*sources):
        one = wrapper(sources[0])
        for s in sources[1:]:
            one = H._merged(one, wrapper(s), False)
        return H.shape(one)

    assert shape("<p>a</p><p>b</p><p>c</p>") == "body00[p01[#00]]"
    assert shape("<h1>a</h1><p>b</p>", "<h1>a</h1><div>x</div><p>b</p>") == "body00[h100[#00] div10[#00] p00[#00]]"
    assert shape("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "body00[dl00[(dt dd01[dt00[#00] dd00[#00]]]]"
    assert shape("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>e<dd>f</dl>") == "body00[dl00[(dt dd01[dt00[#00] dd00[#00]]]]"
    # A page that has every label takes its way through the optional parts.
    w = H._merged(wrapper("<div>a</div><p>b</p>"), wrapper("<div>a</div><h2>t</h2><p>b</p>"), False)
    assert [p[0] for p in H.match_parts(H.page_tree("<div>a</div><p>b</p>")[1], w[3])] == ["div", "p"]
    many = "".join(f"<{t}>x</{t}>" for t in random.Random(1).choices(["p", "h2", "ul", "pre", "table"], k=400))
    assert shape(many).startswith("body00[(*11[")


def test_equals_plain_reading(spark, sf):
    """The tables' pages mark their article: reading it by patterns gives the same."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in H.main_texts(pages).collect()} == want


def test_equals_sql(spark, sf):
    import duckdb

    import __spark_entry__

    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    got = __spark_entry__.queries()["op13_html_text"](spark, sf).select("page_id", "url", "text", "n_chars").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(__spark_entry__.oracle_sql()["op13_html_text"]).fetchall())
