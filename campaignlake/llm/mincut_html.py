"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks: stretches of text between block-level tags, with the
path of open elements above them. A linear classifier over a block's path, tags,
length, link share and sentence marks gives the cost of calling it content and
the cost of calling it boilerplate. These are the capacities from the source and to
the sink; neighbouring blocks and blocks near each other in the tree are tied by
smoothness edges, the stronger the closer. The minimum cut separates content from
boilerplate at the least total cost, found by augmenting paths. Blocks of elements
that are never content (scripts, styles, navigation, forms, ...) have an infinite
cost on that side, so no tie can draw them in.

Scale: pages are independent; each task handles the pages it reads, one at a time.
A page's graph has a constant number of edges per block, and tags are read in time
linear in the page, however deep or broken it is.

Defined results: null or empty html has empty text; character references are
decoded; white space inside a block becomes one blank, ends are trimmed, empty
blocks vanish; broken markup is read as it stands (an unclosed element ends with
its parent, an unclosed tag at the next one); a class that names a layout (``has-sidebar``)
says nothing, one that names a frame holds until an ``article`` or ``main`` opens in it; a
form around more than half of the text is none; repeated rows are pages of their own; an empty table has no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by their use, fixed values.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " iframe legend li main menu nav noscript object ol option p pre section select summary table"
    " tbody td template textarea tfoot th thead title tr ul video audio canvas svg math".split()
)
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
NEVER = frozenset(
    "script style head title template noscript nav footer aside form button select option textarea"
    " input iframe object embed svg math canvas audio video dialog menu noembed noframes".split()
)
CLOSES = {"p": BLOCK - {"p", "html", "body", "head"} | {"p"}, "li": {"li"}, "dt": {"dt", "dd"},
          "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
          "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"},
          "td": {"table"}, "th": {"table"}, "option": {"select"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>",
    re.DOTALL,
)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS_OUT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|footer|"
    r"header|masthead|side-?bar|widget\w*|comments?|comment-?\w+|disqus|replies|share|sharing|social|"
    r"cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|signup|login|related|"
    r"recommend\w*|pagination|pager|toolbar|copyright|legal|search)(?=$|[\s_-])",
    re.I,
)
# A class that tells what a layout has or what a page is for names no part of the page.
_LAYOUT = re.compile(
    r"^(?:has|with|without|no|is|page|layout|site|theme|template)[-_]"
    r"|[-_](?:page|layout|enabled|disabled|template|theme)$",
    re.I,
)
_WORDS_IN = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|text|body)(?=$|[\s_-])", re.I)
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)")

#: Weights of the classifier, in cost units; a positive sum speaks for content.
WEIGHTS = {"inside": 4.0, "named_in": 1.5, "named_out": -12.0, "header": -3.0, "length": 0.012,
           "sentence": 0.8, "links": -5.0, "paragraph": 1.0, "item": -0.5, "bias": -0.6}
NEIGHBOUR, NEAR, NEVER_COST = 0.6, 0.5, 1e9


_FRAME = re.compile(
    r"(?:^|[\"'\s_=-])(?:nav\w*|menu\w*|side-?bar|header|footer|masthead|banner|search|toolbar|widget\w*|"
    r"breadcrumb\w*|pagination|pager|login|overlay|popup|modal)(?=$|[\"'\s_-])",
    re.I,
)


class Element:
    """An open element: its place in the tree and what it says of the text in it."""

    __slots__ = ("name", "parent", "depth", "never", "form", "marks")

    def __init__(self, name: str, parent: Element | None, never: bool, marks: frozenset):
        self.name, self.parent, self.marks = name, parent, marks
        self.depth = parent.depth + 1 if parent else 1
        self.never = never or parent is not None and parent.never
        self.form = self if name == "form" else parent.form if parent else None


class Block:
    __slots__ = ("element", "never", "marks", "pieces", "linked")

    def __init__(self, element: Element | None):
        self.element = element
        self.never = element is not None and element.never
        self.marks = element.marks if element else frozenset()
        self.pieces: list[str] = []
        self.linked = 0

    def text(self) -> str:
        return _SPACE.sub(" ", entities.unescape("".join(self.pieces))).strip()


class OpenElements:
    """The open elements of a page, and the places of each name among them."""

    def __init__(self):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}

    def top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def last(self, names) -> int:
        """The place of the innermost open element of these names, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, element: Element) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        self.stack.append(element)

    def close(self, place: int) -> None:
        """End the element at a place and all inside it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().name].pop()

    def make_room(self, name: str) -> None:
        """End the elements that an opening one of this name ends."""
        top = self.top()
        if top is not None and top.name == "p" and name in CLOSES["p"]:
            self.close(len(self.stack) - 1)
        if name in SCOPES:
            ended = self.last([x for x, by in CLOSES.items() if x != "p" and name in by])
            if ended > self.last(SCOPES[name]):
                self.close(ended)


def _marks(name: str, attributes: str, above: frozenset) -> frozenset:
    """What an element's name and labels say, with what holds above it."""
    marks = {name}
    for a, b, c in _NAMED.findall(attributes):
        label = a or b or c
        if any(_WORDS_OUT.search(token) and not _LAYOUT.search(token) for token in label.split()):
            marks.add("-out")
        elif _WORDS_IN.search(label):
            marks.add("-in")
    if name in ("article", "main"):
        above = above - {"-frame-out"}
    if "-out" in marks and "-in" not in marks and name not in ("html", "body", "main"):
        # what frames a page may hold its article; what discusses or sells doesn't
        marks.add("-frame-out" if _FRAME.search(attributes) else "-named-out")
    return above | frozenset(marks)


def blocks_of(page: str) -> list[tuple[Block, str]]:
    """The blocks of a page that have text, in order, with their text."""
    found: list[Block] = []
    opened = OpenElements()
    links = 0
    current: Block | None = None
    at, size = 0, len(page)

    def say(piece: str) -> None:
        nonlocal current
        if current is None:
            if not piece.strip():
                return
            current = Block(opened.top())
            found.append(current)
        current.pieces.append(piece)
        if links:
            current.linked += len(piece)

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                say(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = m[2].lower()
        if name in BLOCK or name in VOID:
            if name in ("br", "wbr", "img", "input"):
                if current is not None and name == "br":
                    current.pieces.append(" ")
                if name != "input":
                    continue
            current = None
        if m[1]:
            links -= name == "a" and links > 0
            place = opened.last((name,))
            if place >= 0:
                opened.close(place)
            continue
        if name == "a":
            links += 1
        if name in VOID or name not in BLOCK and name not in NEVER:
            continue
        opened.make_room(name)
        parent = opened.top()
        never = name in NEVER and name != "form" or bool(_HIDDEN.search(m[3]))
        marks = _marks(name, m[3], parent.marks if parent else frozenset())
        opened.push(Element(name, parent, never, marks))
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            inner = page[at : end.start() if end else size]
            say(inner)
            current = None
            at = end.end() if end else size
            opened.close(len(opened.stack) - 1)
    blocks = [(b, t) for b in found if (t := b.text())]
    return _without_forms(blocks)


def _without_forms(blocks: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """Forms are never content, but for one around most of the page's text."""
    sizes: dict[Element | None, int] = {}
    for block, text in blocks:
        if not block.never:
            form = block.element.form if block.element else None
            sizes[form] = sizes.get(form, 0) + len(text)
    half = sum(sizes.values()) / 2
    for block, _ in blocks:
        form = block.element.form if block.element else None
        block.never = block.never or form is not None and sizes[form] <= half
    return blocks


def cost(block: Block, text: str) -> float:
    """The classifier's value: above 0 for content, below for boilerplate."""
    if block.never:
        return -NEVER_COST
    marks, w = block.marks, WEIGHTS
    value = w["bias"] + w["length"] * min(len(text), 400)
    value += w["inside"] * ("article" in marks or "main" in marks)
    value += w["named_in"] * ("-in" in marks) + w["named_out"] * ("-named-out" in marks or "-frame-out" in marks)
    value += w["header"] * ("header" in marks and "article" not in marks)
    value += w["sentence"] * min(3, len(_SENTENCE.findall(text)))
    value += w["links"] * min(1.0, block.linked / max(1, len(text)))
    last = block.element.name if block.element else ""
    value += w["paragraph"] * (last in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"))
    return value + w["item"] * (last in ("li", "td", "th"))


def _nearness(a: Element | None, b: Element | None) -> int:
    """Steps in the tree between two elements."""
    steps = 0
    while a is not b:
        if b is None or a is not None and a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(values: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut.

    A node with value v > 0 is tied to the source by v, else to the sink by -v;
    ``ties`` are two-way edges. Shortest augmenting paths carry the flow.
    """
    n = len(values)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    edges: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        edges[a].append(len(to))
        to.append(b)
        room.append(there)
        edges[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, v in enumerate(values):
        if v > 0:
            add(source, k, v, 0.0)
        elif v < 0:
            add(k, sink, -v, 0.0)
    for a, b, c in ties:
        add(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in edges[x]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if room[e] <= 1e-12)
                x = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while place[x] < len(edges[x]):
                e = edges[x][place[x]]
                if room[e] > 1e-12 and level[to[e]] == level[x] + 1:
                    break
                place[x] += 1
            if place[x] < len(edges[x]):
                e = edges[x][place[x]]
                path.append(e)
                x = to[e]
            elif path:
                e = path.pop()
                x = to[e ^ 1]
                place[x] += 1
            else:
                break


def label(blocks: list[tuple[Block, str]]) -> list[bool]:
    """Content or not, for each block of a page."""
    values = [cost(b, t) for b, t in blocks]
    ties = []
    last: dict[Element | None, int] = {}
    for k, (block, _) in enumerate(blocks):
        if k:
            steps = _nearness(blocks[k - 1][0].element, block.element)
            ties.append((k - 1, k, NEIGHBOUR / max(1, steps)))
        parent = block.element.parent if block.element else None
        if parent in last and last[parent] != k - 1:
            ties.append((last[parent], k, NEAR))
        elif parent in last:
            ties.append((k - 1, k, NEAR))
        last[parent] = k
    return minimum_cut(values, ties)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n".join(t for (_, t), good in zip(blocks, label(blocks), strict=True) if good)


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [main_text(page) for page in frame["html"]]
        yield pd.DataFrame(
            {
                "page_id": frame["page_id"].astype("Int64"),
                "url": frame["url"],
                "text": texts,
                "n_chars": [len(t) for t in texts],
            }
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return source.mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
