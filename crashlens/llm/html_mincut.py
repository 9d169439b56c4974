"""Main text of web pages by minimum-cut labelling (operator 6).

A page is cut into blocks of text at block-level tags. A logistic classifier over a block's
shape (link share, length, sentence ends, signs, heading, list item) gives each block a cost
for either label; what tags and class names say belongs to the elements that carry them. Both
become terminal capacities: a block is tied to the terminals by its shape, a marked element by
its mark, once for each block it holds. Smoothness edges tie a block to the marked element
around it, to the next block of the page by their distance in the document tree, and to the
block before it below the same parent. A maximum flow separates the two sides at the least
total cost; the content side, in page order, is the main text. So an ``article`` keeps its
short lines, an advert of whole sentences goes, and a page without any mark follows the shapes
of neighbouring blocks.

The classifier is fitted on whole pages of the table, at most ``MAX_PAGES`` of up to
``MAX_CHARS`` characters, drawn by a hash of their html. Blocks below ``article`` and ``main``
are examples of text, those below menus, footers, forms and furniture class names of the rest;
the classifier sees their shapes alone. The weights have a Gaussian prior around ``PRIOR``, so
a table without marked pages is labelled by the prior. The capacity of the smoothness edges is
the one of ``SMOOTH`` that labels the sample best with all marks hidden.

Blocks below elements that never hold main text (scripts, styles, forms, menus, ...) are
held on the boilerplate side by a capacity no cut can pay.

Defined cases: null or empty html gives the empty text; unclosed and stray tags are taken
as browsers take them (an end tag closes up to its element or is ignored; ``p`` and ``li``
close their like; a quote opens an attribute value only after ``=``); a page without any tag
is one block. Whole pages, no limits; memory and time are linear in a page's length, however
deep its elements nest. Repeated rows are extracted one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas textarea select title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
NEVER = frozenset("nav footer aside form button menu dialog head".split())
CONTENT = frozenset("article main".split())
CLOSES_LIKE = frozenset("p li dt dd tr td th option".split())
# Words of class, id and role attributes that name page furniture or main text.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advert\w*|banner|breadcrumbs?|comments?|comment-?list|cookies?|consent|disqus|footer|header|login|masthead|"
    r"menu|modal|nav|navbar|navigation|newsletter|notice|notification|pagination|popup|promo|related|replies|respond|share|sharing|sidebar|"
    r"signup|social|sponsor\w*|subscribe|tags|toolbar|widget|contentinfo|complementary|search|skip|alert|gdpr|reader-?comments?)(?=$|[\s_-])", re.I)
BODY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?=$|[\s_-])", re.I)
# A tag's attributes: a quote opens a value only after the equals sign.
VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:" + VALUE + ")?+)*+)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACES = re.compile(r"\s+")
SIGNS = re.compile(r"[©®™|·•»«›‹→←#@/]")

#: The sample the classifier is fitted on.
MAX_PAGES, MAX_CHARS = 400, 50_000
#: A block's shape: log-odds for main text before any page is seen, by feature.
PRIOR = {"bias": 0.4, "links": -4.0, "log_chars": 0.35, "sentence": 0.8, "short": -0.6, "heading": 0.3, "signs": -1.0, "item": 0.0}
#: Marks of elements: log-odds for main text, for each block below. The marks of the elements around add up.
CONTENT_MARK, BODY_MARK, FURNITURE_MARK = 7.0, 2.0, -10.0
#: Blocks of a page without any element marked as its content are likelier text.
UNMARKED = 1.2
#: The most a shape may weigh, the tie to a marked element (dearer than that, and than its neighbours), a tie no cut can pay.
MOST, HOLD, FIXED = 6.0, 14.0, 1e9
SMOOTH = (0.25, 0.5, 1.0, 2.0)
FAR = 8  # steps in the tree beyond which blocks are not tied


class Model(NamedTuple):
    weights: tuple[float, ...]
    smooth: float


DEFAULT = Model(tuple(PRIOR.values()), 0.5)


class Element:
    """An open element: its marks, those of the elements around it included; ``holder`` is the
    outermost element with the same marks, None without any."""

    __slots__ = ("tag", "parent", "depth", "above", "block", "never", "content", "furniture", "body", "heading", "item", "holder")

    def __init__(self, tag: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        inline = tag in INLINE
        if parent is None:
            self.depth = self.above = 0
            self.never = self.content = self.furniture = self.body = self.heading = self.item = False
            self.holder = None
        else:
            self.depth, self.above = parent.depth + (not inline), parent.above + (not inline)
            self.never, self.content = parent.never or tag in NEVER, parent.content or tag in CONTENT
            self.furniture, self.body = parent.furniture, parent.body
            self.heading = parent.heading or (len(tag) == 2 and tag[0] == "h" and tag[1] in "123456")
            self.item = parent.item or tag in ("li", "dt", "dd", "td", "th", "option")
            self.holder = parent.holder
        self.block = self if parent is None or not inline else parent.block

    def marks(self) -> tuple[bool, bool, bool]:
        return self.content, self.furniture, self.body


class Block:
    """One text block: its element, its text, and the characters of it inside links."""

    __slots__ = ("pieces", "linked", "element", "text")

    def __init__(self, element: Element):
        self.pieces, self.linked, self.element = [], 0, element


def read_marks(element: Element, attributes: str) -> None:
    """What an element's attributes say about it."""
    if element.tag == "header" and not element.content:
        element.never = True
    if attributes and not attributes.isspace():
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDDEN.search(value)):
                element.never = True
            elif name in ("class", "id", "role"):
                if element.content:  # an article's own header is its title
                    value = re.sub(r"(?i)\bheader\b", "", value)
                if FURNITURE.search(value) and element.tag not in CONTENT and element.tag != "body":
                    element.furniture = True
                elif BODY.search(value):
                    element.body = True
    if element.marks() != element.parent.marks():
        element.holder = element


def blocks(html: str) -> list[Block]:
    """Blocks with text, in page order."""
    stack = [Element("#root", None)]
    places: dict[str, list[int]] = {}  # where on the stack the open elements of a tag are
    out: list[Block] = []
    block, at, lower = None, 0, None
    length, last = len(html), html.rfind(">")

    def text(piece: str):
        nonlocal block
        if not piece or (block is None and not piece.strip()):
            return
        if block is None:
            block = Block(stack[-1].block)
            out.append(block)
        block.pieces.append(piece)
        if places.get("a"):
            block.linked += len(piece.strip())

    def close(to: int):
        while len(stack) > to:
            gone = stack.pop()
            if gone.tag != "#closed":
                places[gone.tag].pop()

    while at < length:
        m = TOKEN.search(html, at) if at <= last or html.find("<!", at) >= 0 else None
        if m is None:
            text(html[at:])
            break
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):  # an end tag
            if tag == "br" or tag not in INLINE:
                block = None
            if places.get(tag):
                depth = places[tag][-1]
                if tag not in INLINE or stack[-1].above == stack[depth].above:
                    close(depth)
                else:  # an inline end tag does not close blocks opened inside
                    places[tag].pop()
                    stack[depth].tag = "#closed"
            continue
        if tag in RAW:
            lower = lower or html.lower()
            end = lower.find("</" + tag, at)
            if tag not in ("svg", "math") or end >= 0:
                at = length if end < 0 else (html.find(">", end) + 1 or length)
            block = None if tag not in ("svg", "math") else block
            continue
        if tag not in INLINE:
            block = None
            if tag in CLOSES_LIKE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
                    if stack[i].block is stack[i] and stack[i].tag not in CLOSES_LIKE:
                        break
            elif stack[-1].tag == "p":
                close(len(stack) - 1)
        if tag in VOID:
            continue
        element = Element(tag, stack[-1])
        read_marks(element, m.group(3))
        places.setdefault(tag, []).append(len(stack))
        stack.append(element)
    kept = []
    for b in out:
        b.text = SPACES.sub(" ", unescape("".join(b.pieces))).strip()
        if b.text:
            kept.append(b)
    return kept


def shape(b: Block) -> tuple[float, ...]:
    """The features of ``PRIOR``, in its order."""
    n = len(b.text)
    sentence = b.text[-1] in ".!?…:;\"'»”"
    return (1.0, min(1.0, b.linked / n), math.log1p(n / 40.0), float(sentence), float(not sentence and n < 25), float(b.element.heading),
            min(3.0, 20.0 * len(SIGNS.findall(b.text)) / n), float(b.element.item))


def cost(b: Block, model: Model) -> float:
    """Log-odds that a block of this shape is main text."""
    return max(-MOST, min(MOST, sum(w * x for w, x in zip(model.weights, shape(b)))))


def distance(a: Element, b: Element) -> int:
    """Steps between two elements of the tree, ``FAR`` if there are as many or more."""
    steps = 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent.block
        else:
            b = b.parent.block
        steps += 1
    return steps


def graph(found: list[Block], model: Model, marks: bool = True) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Terminal capacities and edges: a node for each block, then one for each marked element.
    Without ``marks`` only the shapes and the tree are seen."""
    scores = [cost(b, model) for b in found]
    edges = []
    if marks:
        # A page without any element marked as its content: plain blocks are likelier text.
        plain = 0.0 if any(b.element.content or b.element.body for b in found) else UNMARKED
        holders: dict[int, int] = {}
        for i, b in enumerate(found):
            e = b.element
            if e.never:
                scores[i] = -FIXED
                continue
            scores[i] += plain
            if e.holder is None:
                continue
            node = holders.setdefault(id(e.holder), len(scores))
            if node == len(scores):
                scores.append(0.0)
            scores[node] += CONTENT_MARK * e.content + BODY_MARK * (e.body and not e.content) + FURNITURE_MARK * e.furniture
            edges.append((i, node, HOLD))
    before: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            far = distance(found[i - 1].element, b.element)
            if far < FAR:
                edges.append((i - 1, i, model.smooth * 2.0 ** -max(0, far - 2)))
        up = id(b.element.parent)
        if before.get(up, i - 1) != i - 1:  # the block before it below the same parent
            edges.append((before[up], i, model.smooth / 2))
        before[up] = i
    return scores, edges


def content_side(found: list[Block], model: Model = DEFAULT, marks: bool = True) -> list[bool]:
    """Label by minimum cut. Content terminal s, boilerplate terminal t."""
    scores, edges = graph(found, model, marks)
    if all(x > 0 for x in scores) or all(x <= 0 for x in scores):
        return [x > 0 for x in scores[:len(found)]]
    return [x > 0 for x in min_cut(scores, edges)[:len(found)]]


def example(b: Block) -> bool | None:
    """What the marks around a block say about it, None without any."""
    e = b.element
    return False if e.never or e.furniture else True if e.content else None


def f1(labels: list[tuple[bool, bool]]) -> float:
    """F1 of main text from (is, said) pairs."""
    hit = sum(a and b for a, b in labels)
    return 2 * hit / max(1, sum(a for a, _ in labels) + sum(b for _, b in labels))


def judged(sample: list[list[Block]], model: Model) -> list[tuple[bool, bool]]:
    """(what the marks say, what the cut says without them) of the marked blocks."""
    return [(example(b), x) for found in sample for b, x in zip(found, content_side(found, model, marks=False)) if example(b) is not None]


def fit(sample: list[list[Block]]) -> Model:
    """Logistic regression by Newton's method, a unit Gaussian prior around ``PRIOR``."""
    seen = [(shape(b), example(b)) for found in sample for b in found if example(b) is not None]
    if not seen:
        return DEFAULT
    x, y = np.array([v for v, _ in seen]), np.array([float(l) for _, l in seen])
    prior = np.array(DEFAULT.weights)
    w = prior.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (y - p) - (w - prior))
        w = w + step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-6:
            break
    models = [Model(tuple(float(v) for v in w), smooth) for smooth in SMOOTH]
    return max(models, key=lambda m: f1(judged(sample, m)))


def trained(pages: DataFrame) -> Model:
    """The model of a table, from at most ``MAX_PAGES`` of its pages: those of the smallest
    hashes, below the hash that closes the sample. Hashes alone are ordered."""
    some = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "url", "html").alias("at")).where(f"length(html) BETWEEN 1 AND {MAX_CHARS}")
    smallest = [r["at"] for r in some.select("at").orderBy("at").limit(MAX_PAGES).collect()]
    if len(smallest) == MAX_PAGES:
        some = some.where(F.col("at") < smallest[-1])
    return fit([blocks(h) for _, h in sorted((r["at"], r["html"]) for r in some.collect())])


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[int]:
    """1 for nodes on the source side. A positive score is the capacity from the source, a
    negative one that to the sink (each the cost of the other label). Dinic's method."""
    n = len(scores)
    s, t = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def link(a, b, there, back):
        graph[a].append(len(to))
        to.append(b)
        room.append(there)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(scores):
        if x > 0:
            link(s, i, x, 0.0)
        elif x < 0:
            link(i, t, -x, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for v in queue:
            for e in graph[v]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [int(level[i] >= 0) for i in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        v = s
        while True:  # depth first without recursion: pages may have very many blocks
            if v == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-12)
                v = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while place[v] < len(graph[v]):
                e = graph[v][place[v]]
                if room[e] > 1e-12 and level[to[e]] == level[v] + 1:
                    break
                place[v] += 1
            else:
                if v == s:
                    break
                level[v] = -1
                v = to[path.pop() ^ 1]
                continue
            path.append(e)
            v = to[e]


def main_text(html: str | None, model: Model = DEFAULT) -> str:
    if not html:
        return ""
    found = blocks(html)
    return " ".join(b.text for b, keep in zip(found, content_side(found, model)) if keep)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text of every page, by the model given or one fitted on the table. One
    narrow pass, page by page: no shuffle."""
    model = model or trained(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(h, model) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
