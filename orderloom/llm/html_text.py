"""Main text of web pages by a minimum cut.

A page becomes a sequence of text blocks. A logistic classifier, trained on blocks
whose enclosing elements tell what they are, turns each block's features into a cost
of calling it content and one of calling it boilerplate: the capacities of its edges
to the two terminals of a graph. Neighbouring blocks, and blocks under one parent, are
joined by edges that are the stronger the closer the blocks are in the element tree.
The minimum cut between the terminals is the labelling of least total cost, so a short
line between two paragraphs stays and a sentence in a menu goes.

Scripts, styles, comments in the markup and form controls never make a block. Such an
element ends with its own end tag; if that doesn't come before an enclosing element's,
it was never closed and ends with the next block that starts, so what follows is read.
Scripts and styles alone run to their end tag or the page's end, as in HTML.
A marked section of an unknown name ends with the next bracket. Character references are decoded, white space in a block becomes one space, blocks are
joined by a line break. A markup that breaks off is read up to there. Null and empty
pages have the empty text, an empty table gives an empty one. Pages are handled one by
one, so repeated rows agree; each task holds one page's blocks at a time, and the cut of a
very long page takes time in proportion to its blocks as long as flows stay local. A
block that costs the same on either side is boilerplate. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import sampled, ship

#: Pages whose blocks train the classifier, at most, selected by a hash; blocks of each that are used, at most.
TRAINING_PAGES, TRAINING_BLOCKS = 2_000, 200
#: Flow that counts as none.
EPSILON = 1e-12
#: Cost of a cut between two neighbouring blocks of one parent; less for a farther common ancestor.
SMOOTHNESS = 1.5

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_SILENT = frozenset("script style noscript template svg title iframe select option button textarea datalist canvas audio video".split())
#: Silent elements that can't hold themselves: the next one ends an open one.
_SINGLE = frozenset("noscript title iframe select option button textarea".split())
#: Silent elements whose content is no markup, if they are closed.
_RAW = {tag: re.compile(rf"<(/?){tag}\b", re.IGNORECASE) for tag in ("title", "textarea", "iframe")}
_CONTENT = frozenset(("article", "main"))
_BOILERPLATE = frozenset(("nav", "aside", "footer", "form", "menu", "dialog", "search", "header"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: What starting one of these ends, if it is open: paragraphs and items that were never closed.
_ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banners?|breadcrumbs?|comments?|consent|cookies?|copyright|disqus|footer|gdpr|header|login|masthead|menus?|modal|nav\w*|"
    r"newsletter|notices?|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|tags|toolbar|widgets?)(?:$|[\s_-])",
    re.IGNORECASE,
)
_GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.IGNORECASE)

_FEATURES = ("offset", "length", "links", "sentences", "few words", "heading", "item", "paragraph", "copyright", "in content", "in boilerplate")
#: Weights that training starts from and is held to.
_PRIOR = np.array([-0.5, 1.0, -3.0, 1.0, -0.7, 0.5, -0.5, 0.7, -1.5, 3.0, -6.0])
_TOLD = slice(9, 11)


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    tag: str
    path: tuple[int, ...]  # numbers of the open elements, outermost first
    told: int  # 1: the nearest telling element holds content, -1: boilerplate, 0: none


class _Reader(HTMLParser):
    """Records a page's tags and texts with the end of every silent element, and then makes blocks of them."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", *_RAW)

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._events: list[tuple[int, str, list]] = []  # 1: start, -1: end, 0: text
        self._nested: list[tuple[str, int]] = []  # tag, event of its start
        self._ends: dict[int, tuple[int, bool]] = {}  # start of a silent element: event that ends it, whether it is its own end tag
        self._unclosed: set[str] = set()  # of _RAW: no end tag follows
        self._open: list[tuple[str, int, int]] = []  # tag, number, what it tells
        self._text: list[str] = []
        self._links, self._linked, self._made = 0, 0, 0

    def parse_starttag(self, i: int) -> int:
        self._at = i
        return self._whole(super().parse_starttag(i), i)

    def parse_endtag(self, i: int) -> int:
        return self._whole(super().parse_endtag(i), i)

    def parse_pi(self, i: int) -> int:
        return self._whole(super().parse_pi(i), i)

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<![", i) and not _SECTION.match(self.rawdata, i):
            # of a name that no section has, which the library refuses: a comment up to its bracket, as in HTML
            return self._whole(self.parse_bogus_comment(i), i)
        return self._whole(super().parse_html_declaration(i), i)

    def parse_comment(self, i: int, report: int = 1) -> int:
        found = _COMMENT.match(self.rawdata, i)
        return found.end() if found else len(self.rawdata)

    def _whole(self, end: int, i: int) -> int:
        """Markup that breaks off with the page is no text."""
        return len(self.rawdata) if end < 0 and _BROKEN_OFF.match(self.rawdata, i) else end

    def set_cdata_mode(self, elem: str) -> None:
        if elem in _RAW:
            found = None if elem in self._unclosed else _RAW[elem].search(self.rawdata, self._at + 1)
            if found is None:
                self._unclosed.add(elem)
            if found is None or not found[1]:
                return
        super().set_cdata_mode(elem)

    def _leave(self, k: int, closed: bool) -> None:
        """The element at place ``k`` ends here and all in it."""
        for at, (tag, start) in enumerate(self._nested[k:], k):
            if tag in _SILENT:
                self._ends[start] = (len(self._events), closed and at == k)
        del self._nested[k:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SINGLE:
            for k in range(len(self._nested) - 1, -1, -1):
                if self._nested[k][0] == tag:
                    self._leave(k, False)
                    break
        if tag in _SILENT or (tag in _BLOCK and tag != "hr"):
            self._nested.append((tag, len(self._events)))
        self._events.append((1, tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("body", "html"):
            self._leave(0, False)
        elif tag in _SILENT or tag in _BLOCK:
            for k in range(len(self._nested) - 1, -1, -1):
                if self._nested[k][0] == tag:
                    self._leave(k, True)
                    break
                if tag == "p" and self._nested[k][0] in _SILENT:
                    break
        self._events.append((-1, tag, []))

    def handle_data(self, data: str) -> None:
        self._events.append((0, data, []))

    def read(self, html: str) -> list[Block]:
        self.feed(_LONG_NUMBER.sub(_shorter, html))
        self.close()
        self._leave(0, False)
        i, silent = 0, 0  # silent: event at which an element that was never closed ends at the latest
        while i < len(self._events):
            kind, value, attrs = self._events[i]
            if kind > 0 and value in _SILENT:
                end, closed = self._ends[i]
                if closed:
                    i = end
                else:
                    silent = max(silent, end)
            else:
                if kind > 0 and (value in _BLOCK or value == "body"):
                    silent = 0
                if i >= silent:
                    if kind > 0:
                        self._start(value, attrs)
                    elif kind < 0:
                        self._end(value)
                    else:
                        self._add(value)
            i += 1
        self._flush()
        return self.blocks

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                tag, _, told = self._open[-1] if self._open else ("", 0, 0)
                self.blocks.append(Block(text, self._linked, tag, tuple(n for _, n, _ in self._open), told))
            self._text = []
        self._linked = 0

    def _start(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self._links = 1
        elif tag == "br":
            self._text.append(" ")
        elif tag in _BLOCK:
            self._flush()
            self._links = 0
            for k in range(len(self._open) - 1, -1, -1):
                name = self._open[k][0]
                if name in _ENDS.get(tag, ()) or name == "p":
                    del self._open[k:]
                    break
                if name not in _HEADINGS:
                    break
            told = self._open[-1][2] if self._open else 0
            names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
            if tag in _CONTENT or (names and _GOOD_NAME.search(names) and told >= 0):
                told = 1
            if (tag in _BOILERPLATE and not (tag == "header" and told > 0)) or (names and _BAD_NAME.search(names) and tag not in ("html", "body", "article", "main")):
                told = -1
            if tag != "hr":
                self._made += 1
                self._open.append((tag, self._made, told))

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._links = 0
        elif tag in _BLOCK:
            self._flush()
            for k in range(len(self._open) - 1, -1, -1):
                if self._open[k][0] == tag:
                    del self._open[k:]
                    break

    def _add(self, data: str) -> None:
        self._text.append(data)
        if self._links:
            self._linked += len(data)


_BROKEN_OFF = re.compile(r"<[/!?a-zA-Z][^<>]*$")
_COMMENT = re.compile(r"<!--(?:-?>|.*?--!?\s*>)", re.DOTALL)


#: Marked sections that the library reads, or that the page's end cuts off.
_SECTION = re.compile(r"<!\[(?:(?:temp|cdata|ignore|include|rcdata|if|else|endif)(?![\w.-])|[a-z][\w.-]*\s*\Z|\Z)", re.IGNORECASE | re.ASCII)
#: Numbers of characters that are longer than Python reads; none of over seven digits is one.
_LONG_NUMBER = re.compile(r"&#([0-9]{1000,})")


def _shorter(found: re.Match) -> str:
    digits = found[1].lstrip("0") or "0"
    return f"&#{digits if len(digits) < 8 else 9_999_999}"


def blocks(html: str) -> list[Block]:
    """Text blocks of a page in order."""
    return _Reader().read(html)


def features(block: Block) -> list[float]:
    text = block.text
    words = text.count(" ") + 1
    return [
        1.0,
        min(np.log1p(len(text)) / 5, 1.6),
        min(1.0, block.linked / len(text)),
        min(1.0, 6 * sum(text.count(x) for x in ".!?,;") / words),
        float(words < 5),
        float(block.tag in _HEADINGS),
        float(block.tag == "li"),
        float(block.tag == "p"),
        float("©" in text),
        float(block.told > 0),
        float(block.told < 0),
    ]


def separate(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut: which nodes stay with the source. ``gain`` > 0 pulls to the source, < 0 to the sink.

    A node that pulls harder than all its edges together is settled by itself, and its
    edges then pull its neighbours, which may settle these. What is left is cut by
    maximum flow: each phase levels the nodes by their distance from a surplus and sends
    flow along all paths that go up the levels, until no surplus reaches a deficit.
    """
    pull, n = list(gain), len(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    weight = [sum(x.values()) for x in near]
    with_source: list[bool | None] = [None] * n
    waiting = list(range(n))
    while waiting:
        i = waiting.pop()
        if with_source[i] is not None or not (pull[i] > weight[i] + EPSILON or -pull[i] >= weight[i]):
            continue
        with_source[i] = pull[i] > 0
        for j, c in near[i].items():
            pull[j] += c if with_source[i] else -c
            weight[j] -= c
            del near[j][i]
            waiting.append(j)
        near[i] = {}
    left = [i for i in range(n) if with_source[i] is None]
    for i, kept in zip(left, _flow(left, pull, near), strict=True):
        with_source[i] = kept
    return [bool(x) for x in with_source]


def _flow(nodes: list[int], pull: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Which of the nodes a surplus still reaches once the flow is at its maximum."""
    place = {i: k for k, i in enumerate(nodes)}
    n = len(nodes)
    spare, lack = [max(0.0, pull[i]) for i in nodes], [max(0.0, -pull[i]) for i in nodes]
    arcs: list[list[int]] = [[] for _ in range(n)]  # arc e leads to head[e] and has room[e]; e ^ 1 leads back
    head: list[int] = []
    room: list[float] = []
    for k, i in enumerate(nodes):
        for j, c in near[i].items():
            if i < j:
                arcs[k].append(len(head))
                arcs[place[j]].append(len(head) + 1)
                head += [place[j], k]
                room += [c, c]
    while True:
        level = [0 if s > EPSILON else -1 for s in spare]
        reached = [k for k in range(n) if level[k] == 0]
        found = False
        for k in reached:
            found = found or lack[k] > EPSILON
            for e in arcs[k]:
                if room[e] > EPSILON and level[head[e]] < 0:
                    level[head[e]] = level[k] + 1
                    reached.append(head[e])
        if not found:
            return [x >= 0 for x in level]
        tried = [0] * n
        for source in reached:
            if level[source]:
                break
            path: list[int] = []  # arcs from the source on
            at = source
            while spare[source] > EPSILON:
                if lack[at] > EPSILON:
                    flow = min(spare[source], lack[at], min((room[e] for e in path), default=spare[source]))
                    spare[source] -= flow
                    lack[at] -= flow
                    full = len(path)
                    for d, e in enumerate(path):
                        room[e] -= flow
                        room[e ^ 1] += flow
                        if room[e] <= EPSILON:
                            full = min(full, d)
                    if full < len(path):
                        at = head[path[full] ^ 1]
                        del path[full:]
                    continue
                while tried[at] < len(arcs[at]):
                    e = arcs[at][tried[at]]
                    if room[e] > EPSILON and level[head[e]] == level[at] + 1:
                        break
                    tried[at] += 1
                if tried[at] < len(arcs[at]):
                    path.append(arcs[at][tried[at]])
                    at = head[path[-1]]
                elif path:
                    at = head[path.pop() ^ 1]
                    tried[at] += 1
                else:
                    break


def _edges(found: list[Block], smoothness: float) -> list[tuple[int, int, float]]:
    """Between neighbours by how far up their common ancestor is, and between a block and the one before it under its parent."""
    out, under = [], {}
    for i, block in enumerate(found):
        if i:
            a, b = found[i - 1].path[:-1], block.path[:-1]
            shared = 0
            while shared < min(len(a), len(b)) and a[shared] == b[shared]:
                shared += 1
            out.append((i - 1, i, smoothness * 0.25 ** (max(len(a), len(b)) - shared)))
        parent = block.path[:-1]
        if under.get(parent, i - 1) < i - 1:
            out.append((under[parent], i, smoothness / 2))
        under[parent] = i
    return out


def main_text(html: str, weights: np.ndarray, smoothness: float = SMOOTHNESS) -> str:
    found = blocks(html)
    if not found:
        return ""
    gain = (np.array([features(x) for x in found]) @ weights).tolist()
    kept = separate(gain, _edges(found, smoothness))
    return "\n".join(x.text for x, keep in zip(found, kept, strict=True) if keep)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for html in batch.column(0).to_pylist():
            told = [x for x in blocks(html) if x.told]
            step = max(1, -(-len(told) // TRAINING_BLOCKS))
            rows += [(float(x.told > 0), features(x)) for x in told[::step]]
        yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.float64()), pa.array([x for _, x in rows], pa.list_(pa.float64()))], ["content", "features"])


def fit(pages: DataFrame, rows: int = TRAINING_PAGES, hold: float = 0.02, steps: int = 300) -> np.ndarray:
    """Weights of the block classifier, trained on blocks whose elements tell what they are.

    Each such block counts twice, with and without what its elements tell, so that the
    text's own features learn to decide where no element does. At most ``rows`` pages are
    used, chosen by a hash of id and text, and ``TRAINING_BLOCKS`` blocks of each, evenly
    spaced; pages are read in place, only their blocks' numbers come to the driver.
    """
    ship(pages.sparkSession)
    html = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64(F.col("page_id").cast("long"), F.col("html").cast("string")).alias("chosen")).dropna(subset=["html"])
    chosen = sampled(html.select("chosen"), "chosen", rows).distinct()  # at most ``rows`` numbers
    known = html.join(F.broadcast(chosen), "chosen", "left_semi").dropDuplicates(["chosen"]).select("html").mapInArrow(_training_rows, "content double, features array<double>").toArrow()
    if known.num_rows == 0:
        return _PRIOR.copy()
    told = np.array(known.column("features").to_pylist())
    y = known.column("content").to_numpy()
    untold = told.copy()
    untold[:, _TOLD] = 0
    x, y = np.concatenate((told, untold)), np.concatenate((y, y))
    balance = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, speed = _PRIOR.copy(), np.zeros(len(_PRIOR))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = 0.9 * speed + x.T @ (balance * (p - y)) + hold * (w - _PRIOR)
        w = w - 0.1 * speed
    return w


def extracted(pages: DataFrame, weights: np.ndarray, smoothness: float = SMOOTHNESS) -> DataFrame:
    """(page_id, url, text) of each row of ``pages`` (page_id, url, html)."""
    ship(pages.sparkSession)

    @F.udf("string", useArrow=True)
    def text(html):
        return main_text(html, weights, smoothness) if html else ""

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text(F.col("html").cast("string")).alias("text"))
