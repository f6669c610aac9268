"""Main text of web pages by minimum cuts.

A page is a row of text blocks. A classifier's cost of calling a block content or boilerplate becomes the capacity between the
block and the two terminals; blocks that stand next to each other, and blocks of one parent, are tied by
smoothness edges, the weaker the farther apart they lie in the tree. The minimum cut separates content from boilerplate.

The classifier is a logistic regression on how a block reads (length, links, sentences, place), fitted on pages whose
marking tells what their blocks are; marking itself adds a fixed cost, small for what may mean either.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from stagetrace.llm.groups import arrow_schema, map_arrow

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|style|aria-hidden|aria-label)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_CUE = re.compile(r"[a-z]+")
# HTML names, fixed by the standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style noscript template svg math head title textarea select option datalist button iframe object canvas audio video map".split())
RAW = frozenset("script style textarea title iframe noscript xmp".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# Words in class, id and role that tell what a part of a page is.
BOILERPLATE = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot header masthead topbar sidebar side rail aside ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup share sharing social related recommended recommendations trending comment comments commentlist discussion disqus reply replies respond login "
    "search form widget widgets toolbar pagination pager copyright legal disclaimer skip tags taglist complementary contentinfo outbrain taboola paywall".split())
CONTENT = frozenset("article articlebody content entry post story main body text prose".split())
# Those of them that also name sections of an article: inside one they only make a block doubtful.
EITHER = frozenset("side share sharing social related recommended recommendations trending discussion reply replies responds respond search form legal alert skip "
                   "tags promoted promotion rail foot footer menu".split())
# What an ancestor of a kind adds to the score of a block.
TAG_SCORE = {"article": 1.5, "main": 1.5, "nav": -10.0, "footer": -10.0, "aside": -10.0, "form": -10.0, "menu": -10.0, "dialog": -10.0}
CUE_SCORE, EITHER_SCORE, CONTENT_SCORE, HEADER_SCORE = -10.0, -2.0, 1.0, -10.0
# How far the reading of a block moves its score, either way.
READING = 3.0
# A tie of neighbours over the steps between them in the tree and one; that of blocks of one parent with others between.
# Where only one of them is marked as boilerplate, they count as BORDER steps farther apart.
NEXT, SIBLING, BORDER = 6.0, 0.5, 8
# Weights of FEATURES before any page is seen; the fit starts from them and is held near them by RIDGE blocks.
FEATURES = ("bias", "words", "link share", "ends as a sentence", "commas")
START = np.array([-0.8, 0.8, -4.0, 0.8, 0.5])
RIDGE = 8.0


# --- parsing


# Elements that a start tag of a kind ends, and those at which the look for them stops.
KINDS = {"p": (("p",), ("article", "section", "div", "td", "th", "li", "body", "main", "aside", "nav", "table", "form", "button")),
         "li": (("li",), ("ul", "ol", "menu")), "td": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)), "dt": (("dt", "dd"), ("dl",))}
KIND_OF = {**dict.fromkeys(CLOSES_P, "p"), "li": "li", "td": "td", "th": "td", "tr": "tr", "dt": "dt", "dd": "dt"}


class Element:
    """An open or closed element. ``near`` holds per kind the closest of itself and its ancestors that matters to it."""

    __slots__ = ("tag", "parent", "depth", "score", "unseen", "in_article", "strong", "block", "near")

    def __init__(self, tag: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.score, self.unseen, self.in_article, self.strong = (parent.score, parent.unseen, parent.in_article, parent.strong) if parent else (0.0, False, False, False)
        self.block = parent.block if parent and tag in INLINE else self
        self.near = parent.near if parent else dict.fromkeys(KINDS)
        own = {k: self for k, (ends, stops) in KINDS.items() if tag in ends or tag in stops}
        if own:
            self.near = {**self.near, **own}


@dataclass
class Block:
    parent: Element
    text: str
    linked: int = 0


def _element(tag: str, attributes: str, parent: Element) -> Element:
    e = Element(tag, parent)
    inside = e.in_article
    e.in_article |= tag in ("article", "main")
    own = 0.0 if inside and tag in ("article", "main") else TAG_SCORE.get(tag, 0.0)
    e.unseen |= tag in UNSEEN
    if tag == "header" and not e.in_article:
        own += HEADER_SCORE
    if attributes:
        cues: set[str] = set()
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id", "role", "itemprop"):
                cues.update(_CUE.findall(value))
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                e.unseen = True
        if tag not in ("html", "body"):
            negative = cues & BOILERPLATE
            if e.in_article:
                negative -= {"header"}
            if negative:
                own += EITHER_SCORE if e.in_article and negative <= EITHER else CUE_SCORE
            elif cues & CONTENT:
                own += CONTENT_SCORE
    e.score += own
    e.strong |= own <= CUE_SCORE
    return e


def _tag_end(html: str, at: int, unclosed: set[str]) -> int:
    """Where the tag ends whose name ends at ``at``: the first ``>`` outside of quotes, or at all if a quote stays open; -1 for none.

    ``unclosed`` remembers quotes that no later text closes, so that a page of such tags is not searched to its end for each.
    """
    i = at
    while (m := _STOP.search(html, i)) and m[0] != ">":
        i = -1 if m[0] in unclosed else html.find(m[0], m.end()) + 1
        if i <= 0:
            unclosed.add(m[0])
            return html.find(">", at)
    return m.start() if m else -1


def _tokens(html: str) -> Iterator[tuple[str, str, str, int]]:
    """``(kind, name, rest, end)``: ``text``, ``start`` with attributes, ``end``; a value sent back is where to go on."""
    at, said, n = 0, 0, len(html)
    unclosed: set[str] = set()
    while (at := html.find("<", at)) >= 0:
        kind = None
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            kind, name, rest, end = "none", "", "", n if end < 0 else end + 3
        elif html.startswith("<![CDATA[", at):
            end = html.find("]]>", at + 9)
            kind, name, rest, end = "text", "", html[at + 9:n if end < 0 else end].replace("&", "&amp;"), n if end < 0 else end + 3
        elif html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            if end < 0:
                break
            kind, name, rest, end = "none", "", "", end + 1
        else:
            ends = html.startswith("/", at + 1)
            m = _NAME.match(html, at + 1 + ends)
            if m:
                end = _tag_end(html, m.end(), unclosed)
                if end < 0:
                    break  # no tag ends after this
                kind, name, rest, end = "end" if ends else "start", m[0].lower(), html[m.end():end], end + 1
        if kind is None:
            at += 1
            continue
        if said < at:
            yield "text", "", html[said:at], at
        on = yield kind, name, rest, end
        at = said = end if on is None else on
        if on is not None:
            yield "none", "", "", on
    if said < n:
        yield "text", "", html[said:], n


def blocks(html: str) -> list[Block]:
    """Visible text in page order, split where a block element begins or ends."""
    found: list[Block] = []
    here = Element("", None)
    text: list[str] = []
    linked = 0
    in_link = 0
    open_: Counter = Counter()

    def close() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                found.append(Block(here.block, joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    def leave(to: Element) -> None:
        """Close all that is open below ``to``."""
        nonlocal here
        while here is not to:
            open_[here.tag] -= 1
            here = here.parent

    tokens = _tokens(html)
    for kind, tag, rest, end in tokens:
        if kind == "text":
            if not here.unseen:
                said = unescape(rest)
                text.append(said)
                if in_link:
                    linked += len(said.strip())
            continue
        if kind == "none":
            continue
        if tag not in INLINE:
            close()
        if kind == "end":
            if open_[tag]:
                up = here
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
            if tag == "a":
                in_link = 0
            continue
        if tag in VOID:
            continue
        if tag in KIND_OF:
            ended = here.near[KIND_OF[tag]]
            if ended and ended.tag in KINDS[KIND_OF[tag]][0]:
                leave(ended.parent)
        if rest.endswith("/") and tag in UNSEEN:
            continue
        here = _element(tag, rest, here)
        open_[tag] += 1
        if tag == "a":
            in_link = 1
        if tag in RAW:
            over = re.compile(rf"</{tag}[\s/>]", re.I).search(html, end)
            tokens.send(over.start() if over else len(html))
    close()
    return found


# --- costs


def reading(b: Block) -> list[float]:
    """FEATURES of a block: of its text alone, for tags mean on one site what they don't on the next."""
    words = b.text.count(" ") + 1
    return [1.0, min(log1p(words), 5.0) - 1.5, b.linked / len(b.text), float(b.text[-1] in ".!?。…\"'”"), min(1.0, 10 * b.text.count(",") / words)]


def score(b: Block, weights: np.ndarray = START) -> float:
    """Log-odds of content: how the block reads, and what its ancestors are marked as."""
    read = float(np.dot(reading(b), weights))
    return max(-12.0, min(12.0, max(-READING, min(READING, read)) + b.parent.score))


def distance(a: Element, b: Element) -> int:
    """Steps between two elements of the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def labels(found: list[Block], weights: np.ndarray = START) -> list[bool]:
    """Which blocks are content: the source's side of the minimum cut."""
    n = len(found)
    source, sink = n, n + 1
    flow = Flow(n + 2)
    for i, b in enumerate(found):
        s = score(b, weights)
        # the costs of the wrong labels; their common part changes no cut
        content, boilerplate = log1p(exp(s)), log1p(exp(-s))
        if content > boilerplate:
            flow.add(source, i, content - boilerplate, 0.0)
        else:
            flow.add(i, sink, boilerplate - content, 0.0)
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            border = BORDER if found[i - 1].parent.strong != b.parent.strong else 0
            tie = NEXT / (1 + border + distance(found[i - 1].parent, b.parent))
            flow.add(i - 1, i, tie, tie)
        key = id(b.parent.parent)
        if key in last and last[key] != i - 1:
            flow.add(last[key], i, SIBLING, SIBLING)
        last[key] = i
    flow.run(source, sink)
    side = flow.reached(source)
    return [side[i] for i in range(n)]


class Flow:
    """Maximum flow along shortest ways (Dinic)."""

    LEAST = 1e-9

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[float] = []

    def add(self, u: int, v: int, there: float, back: float) -> None:
        for a, b, c in ((u, v, there), (v, u, back)):
            self.out[a].append(len(self.to))
            self.to.append(b)
            self.left.append(c)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = [source]
        for u in queue:
            for e in self.out[u]:
                if self.left[e] > self.LEAST and level[self.to[e]] < 0:
                    level[self.to[e]] = level[u] + 1
                    queue.append(self.to[e])
        return level

    def reached(self, source: int) -> list[bool]:
        return [x >= 0 for x in self._levels(source)]

    def run(self, source: int, sink: int) -> None:
        while (level := self._levels(source))[sink] >= 0:
            at = [0] * len(self.out)
            way: list[int] = []
            u = source
            while True:
                if u == sink:
                    least = min(self.left[e] for e in way)
                    for e in way:
                        self.left[e] -= least
                        self.left[e ^ 1] += least
                    cut = next(i for i, e in enumerate(way) if self.left[e] <= self.LEAST)
                    u = self.to[way[cut] ^ 1]
                    del way[cut:]
                    continue
                while at[u] < len(self.out[u]):
                    e = self.out[u][at[u]]
                    if self.left[e] > self.LEAST and level[self.to[e]] == level[u] + 1:
                        break
                    at[u] += 1
                if at[u] < len(self.out[u]):
                    way.append(e)
                    u = self.to[e]
                elif way:
                    u = self.to[way.pop() ^ 1]
                    at[u] += 1
                else:
                    break


# --- the operator


def marked(found: list[Block]) -> list[tuple[list[float], int]]:
    """How blocks read whose marking tells what they are, and whether that is content: inside an article, or below a strong cue."""
    return [(reading(b), int(not b.parent.strong)) for b in found if b.parent.strong or b.parent.in_article and b.parent.score > 0]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression, both labels weighing the same, held near START; START itself without both labels."""
    w = START.copy()
    if len(y) == 0 or y.min() == y.max():
        return w
    each = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (each * (p - y)) + RIDGE * (w - START)
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), gradient)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(pages: DataFrame, sample_pages: int = 512, sample_blocks: int = 8192) -> np.ndarray:
    """Weights fitted on at most ``sample_blocks`` blocks of about ``sample_pages`` pages (at most that many ``page_id``).

    Pages, then blocks, are dealt into bins by a hash, and each bin gives its smallest: the sample is even, repeatable and combined
    before any shuffle. Pages with a NULL id or text teach nothing; where no page marks its blocks, START is the result.
    """
    h = F.xxhash64(F.lit("page sample"), "page_id")
    rows = pages.filter("page_id IS NOT NULL AND html IS NOT NULL").select(h.alias("h"), "html")
    ids = rows.groupBy(F.pmod("h", F.lit(sample_pages)).alias("bin")).agg(F.min("h").alias("h")).select("h")
    chosen = rows.join(F.broadcast(ids), "h", "left_semi")  # one id a bin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for page, html in zip(b.column("h").to_pylist(), b.column("html").to_pylist(), strict=True):
                known = marked(blocks(html))
                yield pa.RecordBatch.from_arrays([pa.array([page] * len(known), pa.int64()), pa.array(range(len(known)), pa.int64()),
                                                  pa.array([x for x, _ in known], pa.list_(pa.float64())), pa.array([y for _, y in known], pa.int32())],
                                                 names=["h", "i", "x", "y"])

    key = F.xxhash64("h", "i")
    found = (map_arrow(chosen, run, "h long, i long, x array<double>, y int")
             .groupBy(F.pmod(key, F.lit(sample_blocks)).alias("bin")).agg(F.min(F.struct(key.alias("k"), "x", "y")).alias("s"))
             .select("s.*").collect())
    found.sort(key=lambda r: r["k"])
    return fit(np.array([r["x"] for r in found]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in found], float))


def main_text(html: str | None, weights: np.ndarray = START) -> str:
    found = blocks(html or "")
    return " ".join(b.text for b, good in zip(found, labels(found, weights), strict=True) if good)


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its code points; they replace columns by these names.

    ``weights`` are those of ``learn``, of these pages if none are given. NULL and empty pages, and pages without content, give an
    empty text. Whole pages are read, in time linear in their length but for the flow; a malformed tag is text or
    ignored, unclosed elements end with the page.
    """
    weights = learn(pages) if weights is None else weights
    pages = pages.drop("text", "n_chars")
    added = "text string, n_chars long"
    schema = pa.schema([*arrow_schema(pages.schema), *arrow_schema(added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, weights) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return map_arrow(pages, run, StructType([*pages.schema.fields, *_parse_datatype_string(added).fields]))
