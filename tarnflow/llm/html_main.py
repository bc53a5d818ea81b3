"""Main text of web pages by wrappers that are inferred for each host.

Pages of a host come from a few templates.  A wrapper is a union-free regular
expression over a host's token streams: block tags, text slots, optional and
repeated parts.  It starts as one page's stream with neighbours of one tag folded
into repeats, and is aligned with the next page's again and again: what one side
lacks becomes optional, what comes again becomes a repeated group, texts become
slots that remember their length, their share of link text and whether all pages
say the same.  From a host's wrapper it is decided, once, which slots are the
article; each page is then matched with the wrapper and its slots written out.

Streams are balanced by the usual rules for end tags that may be left out, so an
expression is kept as a tree: [label, optional, repeated, parts], a slot having
its figures as parts.  Inline tags belong to the text that they stand in.
"""

from __future__ import annotations

import html as entities
import json
import re
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import input_bytes, materialise, on_table, spread, tune

# HTML's own lists of elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_SKIPPED = frozenset("button select datalist svg canvas object audio video template noscript map label".split())
_BLOCK = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS_P = _BLOCK - frozenset("caption dd dt legend li optgroup tbody td tfoot th thead tr summary".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends open elements of these names, up to one of the others.
_ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tr": ("tr td th", "table"), "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tfoot tr td th", "table"), "thead": ("thead tbody tfoot tr td th", "table"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _ENDS.items()}
_CELLS = frozenset("td th caption table".split())

# Names by which pages mark what isn't the article.
_OUT_TAGS = frozenset("nav aside footer form dialog menu fieldset legend search".split())
_OUT_ROLES = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert status menu menubar toolbar form".split())
_OUT_WORDS = re.compile(
    r"(ads?|adv|adbox|adslot|nav|aside|rail|foot|bottombar|topbar|masthead|toc|pager|modal|overlay|gdpr|alert|respond|repl(y|ies)|login|signup|form|skip|tracking|shar(e|es|ing)|social|widgets?)$"
    r"|(advert|sponsor|promo|banner|cookie|consent|notice|notification|disqus|navbar|navig|breadcrumb|paginat|menu|sidebar|footer|related|recommend|subscri|newsletter|popup|copyright"
    r"|sharebar|sharebutton|socialbar|sociallink|searchb|searchf|comments?$|comment(list|form|section|area|thread|box|respond))"
    r"|.*(nav|menu|sidebar|footer|banner|comments|adverts?|cookies)$"
)
_HEAD_WORDS = re.compile(r"header$|header|.*header$")
_IN_WORDS = frozenset("article post entry story content main maincontent articlebody".split())

_ATTRIBUTES = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|(?=[\s>\"'])|[^\s>\"'])|[\"'])*+"
_MARK = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements that lie deeper are taken as parts of this level; nothing is lost.
DEEPEST = 150
#: An expression's list of more parts becomes one repeated group of optional ones.
MOST_PARTS = 48
#: Wrappers that one step merges; a host's wrappers meet in as many steps as it takes.
MERGED = 48
#: Decisions of hosts up to this many bytes go to all tasks; beyond it pages meet
#: their host's in a join.
SENT_BYTES = 16 << 20


@dataclass(frozen=True)
class MainRule:
    """constant_pages: text that so many pages of a host all have at one place is
    the template's; link_share: lists with more link text are menus (outside
    marked articles); descend: a part with this share of the text is the page."""

    constant_pages: int = 8
    link_share: float = 0.6
    descend: float = 0.6


def _label(tag: str, attributes: str) -> str:
    """tag, then - for what a name marks as furniture, ^ for a header, + for
    content, and the first class of elements without a meaning of their own."""
    flag, first = "-" if tag in _OUT_TAGS else "^" if tag == "header" else "", ""
    words: list[str] = []
    for name, *values in _NAMES.findall(attributes) if attributes else ():
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            flag = "-"
        elif name == "role":
            flag = "-" if value.lower() in _OUT_ROLES else flag
            words += ["main"] * (value.lower() in ("main", "article"))
        elif name in ("class", "id", "itemprop"):
            words += [w.lower() for part in value.split() for w in _WORDS.findall(part)] + [re.sub(r"[^a-z]", "", value.lower())] * (" " not in value)
            if name == "class" and value:
                first = re.sub(r"[\d.]+", "", value.split()[0].lower())[:24] if value.split() else ""
    content = any(w in _IN_WORDS for w in words)
    if flag != "-":
        if any(_OUT_WORDS.match(w) for w in words):
            flag = "-"
        elif any(_HEAD_WORDS.match(w) for w in words):
            flag = "" if content or tag in _HEADINGS else "^"
        elif content:
            flag = "+"
    return f"{tag}{flag}" + (f".{first}" if first and tag in ("div", "section", "td", "table", "ul", "ol", "p", "center") else "")


class _Page:
    """Builds a page's tree: [label, parts]; a text part is (text, characters in links)."""

    def __init__(self):
        self.root: list = ["body", []]
        self.open: list[tuple[str, list]] = [("body", self.root)]
        self.text: list[str] = []
        self.linked, self.link = 0, 0  # link: depth of the stack at which a link began, from 1; 0 for none
        self.skip: list = []

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.open[-1][1][1].append((text, min(len(text), self.linked)))
            self.text = []
        self.linked = 0

    def say(self, raw: str) -> None:
        if self.skip or not raw:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if self.link:
            self.linked += len(text.strip())

    def close_to(self, at: int) -> None:
        self.flush()
        del self.open[at:]
        if self.link > len(self.open):
            self.link = 0

    def find(self, names, stop=()) -> int:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in names:
                return i
            if self.open[i][0] in stop:
                return 0
        return 0

    def start(self, tag: str, attributes: str) -> None:
        if self.skip:
            self.skip[1] += tag == self.skip[0]
            return
        if tag in _SKIPPED:
            if not attributes.rstrip().endswith("/"):
                self.skip = [tag, 1]
        elif tag == "a":
            self.link = len(self.open)
        elif tag == "br":
            self.text.append(" ")
        elif tag in _BLOCK:
            self.flush()
            if tag in _ENDS_P and (at := self.find(("p",), _CELLS)):
                self.close_to(at)
            while tag in _ENDS and (at := self.find(*_ENDS[tag])):
                self.close_to(at)
            if tag in _HEADINGS and self.open[-1][0] in _HEADINGS:
                self.close_to(len(self.open) - 1)
            # Beyond the deepest level text goes to the element above.
            if tag not in _VOID and len(self.open) < DEEPEST:
                node = [_label(tag, attributes), []]
                self.open[-1][1][1].append(node)
                self.open.append((tag, node))

    def end(self, tag: str) -> None:
        if self.skip:
            if tag == self.skip[0]:
                self.skip[1] -= 1
                if not self.skip[1]:
                    self.skip = []
                return
            if tag not in _BLOCK or not self.find((tag,)):
                return
            self.skip = []
        if tag == "a":
            self.link = 0
        elif tag in _BLOCK:
            self.flush()
            at = self.find(_HEADINGS if tag in _HEADINGS else (tag,), () if tag in ("td", "th", "tr", "table", "tbody", "thead", "tfoot", "caption") else ("table",))
            if at:
                self.close_to(at)


def page_tree(source: str) -> list:
    """The page's blocks and texts; comments, scripts, styles and controls aside."""
    page, at, n = _Page(), 0, len(source)
    while at < n:
        mark = _MARK.search(source, at)
        if not mark:
            page.say(source[at:])
            break
        page.say(source[at : mark.start()])
        at = mark.end()
        closing, tag, attributes = mark.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            page.end(tag)
        elif tag in _RAW:
            done = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = done.end() if done else n
        else:
            page.start(tag, attributes)
    page.flush()
    return page.root


# Expressions.  A slot's figures: pages, characters, characters in links, least
# and greatest hash of its texts.  Slots of link text are apart from others.

_SLOTS = ("#", "@")
_NAME = re.compile(r"[a-z0-9#@(*]+")


def _tag(label: str) -> str:
    return _NAME.match(label)[0]


def _is_group(node: list) -> bool:
    return node[0][0] == "("


#: Elements that say nothing about what is in them: they count as alike by their parts.
_FRAMES = ("div", "section", "td", "center", "table", "ul", "ol", "dl")


def _slot_label(text: str, linked: int) -> str:
    return "@" if 5 * linked >= 4 * len(text) else "#"


def _slot(text: str, linked: int) -> list:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1
    return [_slot_label(text, linked), 0, 0, [1, len(text), linked, h, h]]


def _part_labels(parts: list) -> set[str]:
    out: set[str] = set()
    for p in parts:
        if isinstance(p, tuple):
            out.add(_slot_label(*p))
        elif len(p) > 2 and _is_group(p):
            out |= _part_labels(p[3])
        else:
            out.add(p[0])
    return out


def _alike(label: str, a: set[str], b: set[str]) -> float:
    """0 to 1: shared labels of what is in two parts of one label."""
    return len(a & b) / len(a | b) if _tag(label) in _FRAMES and a | b else 1.0


def _similar(a: list, b: list) -> float:
    return 0.0 if a[0] != b[0] else 1.0 if a[0] in _SLOTS or _is_group(a) else _alike(a[0], _part_labels(a[3]), _part_labels(b[3]))


def page_wrapper(node: list) -> list:
    return [node[0], 0, 0, fold([_slot(*p) if isinstance(p, tuple) else page_wrapper(p) for p in node[1]])]


def _merged(a: list, b: list, same_pages: bool) -> list:
    """Of two expressions with one label, the one that takes what either takes."""
    if a[0] in _SLOTS:
        x, y = a[3], b[3]
        parts = [max(x[0], y[0]) if same_pages else x[0] + y[0], x[1] + y[1], x[2] + y[2], min(x[3], y[3]), max(x[4], y[4])]
    else:
        parts = merge_parts(a[3], b[3], same_pages)
    return [a[0], a[1] | b[1], a[2] | b[2], parts]


def fold(parts: list) -> list:
    """Neighbours that are alike become a repeat; two or more neighbours that come
    again at once become a repeated group; too many parts become a group of any."""
    out: list = []
    for p in parts:
        if out and _similar(out[-1], p) >= 0.5:
            out[-1] = _merged(out[-1], p, True)
            out[-1][2] = 1
        else:
            out.append(p)
    for size in range(2, 7):
        i = 0
        while i + 2 * size <= len(out):
            labels = [p[0] for p in out[i : i + size]]
            z = i + size
            while [p[0] for p in out[z : z + size]] == labels:
                z += size
            if z > i + size and not any(x.startswith("(") for x in labels):
                group = out[i : i + size]
                for k in range(i + size, z, size):
                    group = [_merged(a, b, True) for a, b in zip(group, out[k : k + size])]
                out[i:z] = [[f"({' '.join(labels)}", 0, 1, group]]
            i += 1
    return _any(out) if len(out) > MOST_PARTS else out


def _any(parts: list) -> list:
    """One repeated group in which each label is optional and in any order."""
    flat: list = []
    for p in parts:
        flat += p[3] if p[0][0] == "(" else [p]
    by_label: dict[str, list] = {}
    for p in flat:
        p = [p[0], 1, 1, p[3]]
        by_label[p[0]] = _merged(by_label[p[0]], p, True) if p[0] in by_label else p
    if len(by_label) > MOST_PARTS:  # then classes don't count
        plain: dict[str, list] = {}
        for p in by_label.values():
            name = p[0].split(".")[0]
            plain[name] = _merged(plain[name], [name, *p[1:]], True) if name in plain else [name, *p[1:]]
        by_label = plain
    return [["(*", 1, 1, list(by_label.values())]]


def _grouped(parts: list, groups: list) -> list:
    """The parts with runs that spell one of the groups put into it."""
    for g in groups:
        size, i = len(g[3]), 0
        inner = [p[0] for p in g[3]]
        while i + size <= len(parts):
            if [p[0] for p in parts[i : i + size]] == inner:
                parts = [*parts[:i], [g[0], 0, 1, parts[i : i + size]], *parts[i + size :]]
            i += 1
    return parts


def merge_parts(a: list, b: list, same_pages: bool = False) -> list:
    """Align two lists of parts by the common subsequence of labels that is the
    most alike; what stands on one side only becomes optional."""
    if [p[0] for p in a] == [p[0] for p in b]:
        return [_merged(x, y, same_pages) for x, y in zip(a, b)]
    if any(p[0] == "(*" for p in (*a, *b)):
        both = (_any(a) if a else [["(*", 1, 1, []]])[0], (_any(b) if b else [["(*", 1, 1, []]])[0]
        by_label = {p[0]: p for p in both[0][3]}
        for p in both[1][3]:
            by_label[p[0]] = _merged(by_label[p[0]], p, same_pages) if p[0] in by_label else p
        return _any(list(by_label.values())) if len(by_label) > MOST_PARTS else [["(*", 1, 1, list(by_label.values())]]
    a, b = _grouped(a, [p for p in b if p[0][0] == "("]), _grouped(b, [p for p in a if p[0][0] == "("])
    n, m = len(a), len(b)
    gain = [[0.0] * m for _ in range(n)]
    inner = [[set() if p[0] in _SLOTS else _part_labels(p[3]) for p in side] for side in (a, b)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if x[0] == y[0]:
                gain[i][j] = 0.5 + _alike(x[0], inner[0][i], inner[1][j])
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], gain[i][j] and best[i + 1][j + 1] + gain[i][j])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and best[i + 1][j] == best[i][j]:
            out.append([a[i][0], 1, a[i][2], a[i][3]])
            i += 1
        elif j < m and best[i][j + 1] == best[i][j]:
            out.append([b[j][0], 1, b[j][2], b[j][3]])
            j += 1
        else:
            out.append(_merged(a[i], b[j], same_pages))
            i, j = i + 1, j + 1
    return fold(out)


def shape(w: list) -> str:
    """The expression without its slots' figures."""
    return f"{w[0]}{w[1]}{w[2]}" + ("" if w[0] in _SLOTS else f"[{' '.join(map(shape, w[3]))}]")


# Which slots are the article.


def _text(node: list, without=frozenset()) -> int:
    """Characters outside links, those of parts in ``without`` left out."""
    if node[0] in _SLOTS:
        return node[3][1] - node[3][2]
    return 0 if id(node) in without else sum(_text(p, without) for p in node[3])


def furniture(root: list) -> set[int]:
    """The parts that their names mark as something else than the article.  A
    frame around half of the text and an article or main element isn't such a
    part, whatever it is called; a header within an article belongs to it."""
    half, found = _text(root) / 2, set()

    def walk(node, inside) -> bool:
        if node[0] in _SLOTS:
            return False
        tag = _tag(node[0])
        mark = node[0][len(tag) :][:1] if not _is_group(node) else ""
        inside = inside or tag in ("article", "main")
        holds = any([walk(p, inside) for p in node[3]])
        if (mark == "-" or (mark == "^" and not inside)) and not (holds and _text(node) >= half):
            found.add(id(node))
        return holds or tag in ("article", "main")

    walk(root, False)
    return found


def _outermost(node: list, wanted, without: set[int]) -> list:
    if node[0] in _SLOTS or id(node) in without:
        return []
    if not _is_group(node) and wanted(node):
        return [node]
    return [x for p in node[3] for x in _outermost(p, wanted, without)]


def containers(root: list, without: set[int], rule: MainRule) -> tuple[list, bool]:
    """(nodes that hold the article, whether article or main elements do)."""
    for tag in ("article", "main"):
        found = [(n, _text(n, without)) for n in _outermost(root, lambda n: _tag(n[0]) == tag, without)]
        most = max((t for _, t in found), default=0)
        if most:
            return [n for n, t in found if 2 * t >= most], True
    found = [(n, _text(n, without)) for n in _outermost(root, lambda n: n[0][len(_tag(n[0])) :][:1] == "+", without)]
    most = max((t for _, t in found), default=0)
    if most and 2 * most >= _text(root, without):
        return [n for n, t in found if 2 * t >= most], False
    node, titles = root, []
    while True:
        parts = [q for p in node[3] for q in (p[3] if _is_group(p) else [p])]
        weights = [_text(p, without) for p in parts]
        most = max(weights, default=0)
        k = weights.index(most) if parts else 0
        # Siblings that are prose of their own belong to the article, not to a frame.
        prose = any(t and _tag(p[0]) in ("p", "blockquote", "pre") for p, t in zip(parts, weights))
        if not most or prose or _tag(parts[k][0]) not in ("div", "section", "center", "table", "tbody", "tr", "td", "dl", "dd", "ul", "li") or most < rule.descend * sum(weights):
            return [*titles, node], False
        titles += [p for p in parts[:k] if _tag(p[0]) == "h1"]
        node = parts[k]


def decide(root: list, rule: MainRule) -> list:
    """The wrapper with a 1 in slots that are written out and a 0 in others."""
    without = furniture(root)
    found, marked = containers(root, without, rule)
    chosen = {id(n) for n in found}

    def slots(node):
        return [node[3]] if node[0] in _SLOTS else [s for p in node[3] for s in slots(p)]

    inner = [s for n in found for s in slots(n)]
    # Where all pages are copies, what they share is the article.
    varying = 2 * sum(s[1] for s in inner if s[3] != s[4]) >= sum(s[1] for s in inner)
    pages = max((s[0] for s in slots(root)), default=0)

    def constant(slot) -> bool:
        return varying and slot[3] == slot[4] and slot[0] >= max(rule.constant_pages, 0.9 * pages)

    def menu(node) -> bool:
        own = slots(node)
        listed = _tag(node[0]) in ("ul", "ol", "dl", "table", "div", "section", "p", "center")
        return not marked and listed and sum(s[2] for s in own) > rule.link_share * max(1, sum(s[1] for s in own))

    def walk(node, on, heading):
        if node[0] in _SLOTS:
            return [*node[:3], int(on and (heading or not constant(node[3])))]
        if not _is_group(node):
            on = id(node) in chosen or (on and id(node) not in without and not menu(node))
            heading = heading or _tag(node[0]) in _HEADINGS
        parts = [walk(p, on, heading) for p in node[3]]
        # Where nothing below counts, only the labels of the parts matter.
        return [*node[:3], parts if _is_group(node) or _counts(parts) else [[p[0], p[1], p[2], 0 if p[0] in _SLOTS else []] for p in parts]]

    return walk(root, False, False)


def _counts(parts: list) -> bool:
    return any(p[3] == 1 if p[0] in _SLOTS else _counts(p[3]) for p in parts)


# Pages against wrappers.


def _states(parts: list, group: int = -1, optional: int = 0) -> list:
    out = []
    for k, p in enumerate(parts):
        if _is_group(p):
            out += _states(p[3], k if group < 0 else group, 1 if p[1] or p[0] == "(*" else optional)
        else:
            out.append((p, group, p[1] | optional))
    return out


def match_parts(page: list, parts: list) -> list:
    """The wrapper's part of each of the page's: the way through the expression
    that leaves out the fewest parts that aren't optional and meets the most
    that is alike."""
    states = _states(parts)
    by_label: dict[str, list[int]] = {}
    for t, (p, _, _) in enumerate(states):
        by_label.setdefault(p[0], []).append(t)
    labels = [_slot_label(*p) if isinstance(p, tuple) else p[0] for p in page]
    other = dict(zip(_SLOTS, reversed(_SLOTS)))
    options = [by_label.get(x) or by_label.get(other.get(x, x.split(".")[0])) or [] for x in labels]
    if all(len(o) < 2 for o in options):
        return [states[o[0]][0] if o else None for o in options]
    needed = [0]
    for _, _, optional in states:
        needed.append(needed[-1] + (not optional))

    def cost(s: int, t: int) -> int:
        if t > s:
            return needed[t] - needed[s + 1]
        if t == s:
            return 0 if states[t][0][2] or states[t][1] >= 0 else 5
        return 0 if states[s][1] >= 0 and states[s][1] == states[t][1] else 20

    ways: dict[int, int] = {-1: 0}
    back: list[dict[int, int]] = []
    inner = [set() if p[0] in _SLOTS else _part_labels(p[3]) for p, _, _ in states]
    for part, label, option in zip(page, labels, options):
        step, came = {}, {}
        for t in option:
            step[t], came[t] = min((c + cost(s, t), s) for s, c in ways.items())
            if len(option) > 1 and not isinstance(part, tuple):
                step[t] += 3 * (1 - _alike(label, _part_labels(part[1]), inner[t]))
        back.append(came)
        ways = step or ways
    out: list = [None] * len(page)
    # What is left at the end counts too.
    t = min((c + (needed[-1] - needed[s + 1]), s) for s, c in ways.items())[1]
    for i in range(len(page) - 1, -1, -1):
        if back[i]:
            out[i], t = states[t][0], back[i][t]
    return out


def write_out(page: list, decision: list) -> list[str]:
    """Texts of the page's blocks in the slots that count, in order."""
    out: list[str] = []
    for part, at in zip(page[1], match_parts(page[1], decision[3])):
        if at is None:
            continue
        if isinstance(part, tuple):
            out += [part[0]] * at[3]
        else:
            out += write_out(part, at)
    return out


def main_text(source: str | None, decision: list | None = None, rule: MainRule = MainRule()) -> str:
    """The main text of one page, by its host's decision; where there is none, or
    where it finds nothing on this page, by the page's own wrapper."""
    tree = page_tree(source or "")
    blocks = write_out(tree, decision) if decision else []
    return "\n".join(blocks or write_out(tree, decide(page_wrapper(tree), rule)))


# Over tables.

_WRAPPER = "host string, salt long, wrapper string"


def _page_wrappers(batches):
    """One wrapper for each host and shape that a task meets."""
    held: dict[tuple[str, str], list] = {}

    def rows():
        keys = list(held)
        salts = [xxhash.xxh3_64_intdigest(s) >> 1 for _, s in keys]
        columns = [pa.array([h for h, _ in keys], pa.string()), pa.array(salts, pa.int64()), pa.array([json.dumps(held[k]) for k in keys], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["host", "salt", "wrapper"])

    size = 0
    for b in batches:
        for host, source in zip(b.column("host").to_pylist(), b.column("html")):
            w = page_wrapper(page_tree(source.as_py() or ""))
            key = (host, shape(w))
            size += 0 if key in held else len(key[1])
            held[key] = _merged(held[key], w, False) if key in held else w
            if size > 4 << 20:
                yield rows()
                held, size = {}, 0
    yield rows()


def _merge_table(table: pa.Table) -> pa.Table:
    """All wrappers of a host's share, aligned one after another."""
    rows = sorted(zip(table.column("salt").to_pylist(), table.column("wrapper").to_pylist()))
    one = None
    for _, text in rows:
        w = json.loads(text)
        one = w if one is None else _merged(one, w, False)
    at = table.column("bucket")[0].as_py()
    return pa.table({"host": table.column("host").slice(0, 1), "salt": pa.array([at], pa.int64()), "wrapper": pa.array([json.dumps(one)], pa.string())})


def host_wrappers(pages: DataFrame, host, html_col: str = "html") -> DataFrame:
    """(host, wrapper) of every host.  Tasks merge pages of one shape themselves;
    wrappers of a host are then merged MERGED at a time, so no task ever has
    more of a host's, however many pages it has."""
    texts = spread(pages.select(host.alias("host"), F.col(html_col).cast("string").alias("html")).filter("host is not null"))
    rows = materialise(texts.mapInArrow(_page_wrappers, _WRAPPER), "wrappers")
    while True:
        counts = materialise(rows.groupBy("host").agg(F.count("*").alias("n")), "wrapper-counts")
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return rows.select("host", "wrapper")
        # Rows are numbered within their host by a hash of shape and place, as
        # many tasks may have seen one shape.
        dealt = rows.withColumn("place", F.xxhash64("salt", F.monotonically_increasing_id())).join(counts, "host")
        dealt = dealt.withColumn("bucket", F.pmod("place", F.ceil(F.col("n") / MERGED).cast("long"))).drop("place", "n")
        rows = materialise(dealt.groupBy("host", "bucket").applyInArrow(on_table(_merge_table), _WRAPPER), "wrappers")


def _decide(rule: MainRule, batches):
    for b in batches:
        made = [json.dumps(decide(json.loads(w), rule), separators=(",", ":")) for w in b.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(made, pa.string())], ["host", "decision"])


def _extract(rule: MainRule, sent, batches):
    known: dict[str, list] = {}
    for b in batches:
        texts = []
        hosts = b.column("host").to_pylist()
        decisions = b.column("decision").to_pylist() if sent is None else [sent.value.get(h) for h in hosts]
        for source, host, decision in zip(b.column("html"), hosts, decisions):
            if decision is not None and host not in known:
                if len(known) >= 2000:
                    known.clear()
                known[host] = json.loads(decision)
            texts.append(main_text(source.as_py(), known[host] if decision is not None else None, rule))
        keep = [c for c in b.schema.names if c not in ("host", "html", "decision")]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*keep, "text", "n_chars"])


def url_host(url):
    """The host of a URL in lower case, without user and port; null without one."""
    name = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(name != "", name)


def main_texts(pages: DataFrame, rule: MainRule = MainRule(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sent_bytes: int = SENT_BYTES) -> DataFrame:
    """(id, url, text, n_chars) of every row: the article's blocks, one a line.

    A null or empty page has an empty text.  A page without a URL, or with one
    that names no host, is a site of its own.  Rows that repeat are pages of
    their own; ids may be null; an empty table gives an empty result; other
    columns aren't looked at, so their names can't clash.  Pages are read whole
    and nothing is cut; character references are decoded as browsers do, those
    without a semicolon too.
    """
    spark = pages.sparkSession
    tune(spark)
    host = url_host(F.col(url_col))
    decisions = materialise(host_wrappers(pages, host, html_col).mapInArrow(partial(_decide, rule), "host string, decision string"), "decisions")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("address"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("id", "address").schema)
    size = decisions.agg(F.sum(F.length("host") + F.length("decision"))).first()[0] or 0
    if size <= sent_bytes:
        sent = spark.sparkContext.broadcast({r.host: r.decision for r in decisions.collect()})
        rows = spread(rows)
    else:
        sent, rows = None, rows.join(decisions, "host", "left")
    out = rows.mapInArrow(partial(_extract, rule, sent), f"{kinds}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("address").alias(url_col), "text", "n_chars")
