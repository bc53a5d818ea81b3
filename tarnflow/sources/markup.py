"""Mark-up as a table of numbered nodes.

A node has its place in document order (pre), the place of the last node below it
(last), its parent's pre and its level, so whatever lies before, after, above or
below it is a comparison of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

FIELDS = "pre int, last int, parent int, level int, kind string, name string, value string, attributes map<string,string>"

# HTML's elements without an end tag, and those that end a paragraph.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
_ENDS_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_KEEPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


class _Nodes:
    """Numbers nodes as they begin and end."""

    def __init__(self):
        self.rows: list[list] = []
        self.open: list[int] = []

    def add(self, kind: str, name: str | None, value: str | None, attributes=None) -> int:
        pre = len(self.rows)
        self.rows.append([pre, pre, self.open[-1] if self.open else None, len(self.open), kind, name, value, attributes])
        return pre

    def start(self, name: str, attributes) -> None:
        self.open.append(self.add("element", name, None, attributes))

    def close(self, keep: int) -> None:
        """Ends all open elements but the first ``keep``."""
        for pre in self.open[keep:]:
            self.rows[pre][1] = len(self.rows) - 1
        del self.open[keep:]

    def text(self, value: str) -> None:
        last = self.rows[-1] if self.rows else None
        if last and last[4] == "text" and last[2] == (self.open[-1] if self.open else None):
            last[6] += value
        else:
            self.add("text", None, value)

    def innermost(self, names, stop=()) -> int | None:
        for i in range(len(self.open) - 1, -1, -1):
            name = self.rows[self.open[i]][5]
            if name in names:
                return i
            if name in stop:
                return None
        return None


class _Html(HTMLParser):
    """HTML with the end tags that may be left out; an end tag that fits no open
    element is passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = _Nodes()

    def handle_starttag(self, tag, attrs):
        n = self.nodes
        if tag in _ENDS_P and (at := n.innermost(("p",), ("td", "th", "table"))) is not None:
            n.close(at)
        while tag in _ENDS_LIKE and (at := n.innermost(_ENDS_LIKE[tag], _KEEPS[tag])) is not None:
            n.close(at)
        n.start(tag, {k: v or "" for k, v in attrs})
        if tag in _VOID:
            n.close(len(n.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.nodes.close(len(self.nodes.open) - 1)

    def handle_endtag(self, tag):
        if (at := self.nodes.innermost((tag,))) is not None:
            self.nodes.close(at)

    def handle_data(self, data):
        self.nodes.text(data)

    def handle_comment(self, data):
        self.nodes.add("comment", None, data)


def html_nodes(source: str) -> list[list]:
    p = _Html()
    p.feed(source)
    p.close()
    p.nodes.close(0)
    return p.nodes.rows


def xml_nodes(source: str) -> list[list]:
    """Raises for what isn't well formed; entities of the document's own aren't
    followed to other files."""
    n, p = _Nodes(), expat.ParserCreate()
    p.buffer_text = True
    p.StartElementHandler = n.start
    p.EndElementHandler = lambda _: n.close(len(n.open) - 1)
    p.CharacterDataHandler = n.text
    p.CommentHandler = lambda data: n.add("comment", None, data)
    p.ProcessingInstructionHandler = lambda target, data: n.add("instruction", target, data)
    p.Parse(source, True)
    return n.rows


def _shred(html: bool, id_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32()] * 4 + [pa.string()] * 3 + [pa.map_(pa.string(), pa.string())]
    names = ["doc", *(f.split()[0] for f in FIELDS.split(", "))]
    for b in batches:
        ids, rows = [], []
        for doc, source in zip(b.column("doc"), b.column("source").to_pylist()):
            mine = (html_nodes(source) if html else xml_nodes(source)) if source else []
            ids += [doc.as_py()] * len(mine)
            rows += mine
            if len(rows) > 50_000:
                yield _batch(ids, rows, id_type, kinds, names)
                ids, rows = [], []
        yield _batch(ids, rows, id_type, kinds, names)


def _batch(ids, rows, id_type, kinds, names) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    columns[-1] = [list(a.items()) if a is not None else None for a in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)


def shred(df: DataFrame, doc: str, source: str, html: bool = True) -> DataFrame:
    """(doc, pre, last, parent, level, kind, name, value, attributes) of every
    node; kind is element, text, comment or instruction.

    pre counts from 0 in document order; a node's descendants have pre from
    pre + 1 to last; parent is null at the top.  Documents are read by their
    ids, so these must be unique; rows without an id, null and empty documents
    have no nodes.  HTML that isn't well formed is read as browsers mostly do;
    XML that isn't raises.
    """
    rows = df.filter(F.col(doc).isNotNull()).select(F.col(doc).alias("doc"), F.col(source).cast("string").alias("source"))
    kind = df.schema[doc].dataType
    return rows.mapInArrow(partial(_shred, html, to_arrow_type(kind)), f"doc {kind.simpleString()}, {FIELDS}")
