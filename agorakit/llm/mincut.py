"""Main text of HTML pages by minimum cut.

A page becomes its text blocks in order. A small linear classifier weighs graded evidence on each block: number of
words, share of links, punctuation, kind of element, and what the elements around it are called. Its log-odds, kept within
a few units, are the block's capacities to the two terminals. Smoothness edges charge for labels that change: between
blocks that follow each other, and between a block and the containers it lies in, which are nodes without
evidence of their own. Edges are as strong as usual evidence, so a heading, a short line or a paragraph under an
ordinary class word goes with what is around it. The minimum cut, found by max-flow, is the labelling of least total cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agorakit.llm.kernels import column, slices

# Element names of HTML.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "title", "textarea", "iframe", "noscript"}  # text up to the closing tag, else to the end
EMBEDDED = {"audio", "canvas", "object", "svg", "template", "video"}  # their inside goes, if they are closed
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
LISTS = ("ul", "ol", "dl", "table", "menu")
BOILER_TAGS = {"nav", "footer", "aside", "menu", "form", "dialog", "select", "button", "fieldset", "search"}
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "dd"}
# Names of elements (class, id, role): evidence against content, strong or ordinary, and for it.
STRONG_WORDS = set(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs comments consent cookie cookies copyright disqus footer gdpr "
    "masthead menu modal nav navbar navigation newsletter overlay pager pagination popup promo sidebar signup sponsored toolbar".split()
)
ORDINARY_WORDS = set(
    "banner byline comment header login notice promoted promotion recommended related replies respond share sharing skip social sponsor "
    "subscribe subscription tags widget widgets".split()
)
CONTENT_WORDS = {"article", "articlebody", "content", "entry", "main", "post", "story"}
VAGUE_WORDS = {"has", "no", "with", "without", "page"}

# The classifier: weights of a block's log-odds of being content.
BIAS, PER_DOUBLING, LINKS, TEXT_TAG, SENTENCE, COMMAS = -1.2, 0.6, -4.0, 0.8, 0.6, 0.2
OWN_LIMIT = 4.0  # of what the block's own text says
TAG, STRONG, NAMED, IN_ARTICLE = -5.0, -5.0, 1.0, 2.0
ORDINARY, MAIN_SHARE = -5.0, 1.4  # ordinary words also name main parts: less, the more of the page's text the element has
CONTEXT_LOW, CONTEXT_HIGH = -6.0, 2.0  # of what the elements around it say
ADJACENT, TREE, BORDER = 2.0, 1.5, 0.15  # blocks side by side, a step to a container, factor where the evidence around changes

_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.S)
_LOOSE = re.compile(r"</?[a-zA-Z][^>]*(?:>|$)|</[^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _named(tag: str, attributes: str) -> tuple[float, float, bool]:
    """(evidence of an element's names, that of ordinary words, whether it says that it is the main part)."""
    words: set[str] = set()
    main, score, ordinary = tag in ("article", "main"), 0.0, 0.0
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role", "itemprop"):
            words |= set(_SPLIT.split(_CAMEL.sub(" ", value).lower()))
            main |= value.lower() in ("main", "articlebody")
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            score = CONTEXT_LOW
    for_it = bool(words & CONTENT_WORDS)
    if not words & VAGUE_WORDS and not main:
        # beside a name for content, a name against it says little
        part = 0.5 if for_it else 1.0
        if words & STRONG_WORDS:
            score += part * STRONG
        elif words & ORDINARY_WORDS:
            ordinary = part * ORDINARY
    return score + (NAMED if for_it else 0.0), ordinary, main


class Element:
    __slots__ = ("tag", "parent", "depth", "score", "ordinary", "size", "context", "article", "link", "block")

    def __init__(self, tag: str, parent: "Element | None", attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.score = self.ordinary = self.context = 0.0
        self.size = 0  # of the text inside that is not in links
        self.article = parent.article if parent else False
        self.link = (parent.link if parent else False) or (tag == "a" and "href" in attributes.lower())
        self.block = self if tag in BLOCK or parent is None else parent.block
        if tag in ("html", "body"):
            return
        score, self.ordinary, main = _named(tag, attributes) if attributes else (0.0, 0.0, tag in ("article", "main"))
        if tag == "header" and self.article and score > STRONG:
            score = self.ordinary = 0.0  # the head of an article
        elif tag in BOILER_TAGS or tag == "header":
            score += TAG
        if main and not self.article:
            score += IN_ARTICLE
            self.article = True
        self.score = score


class Block:
    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: Element, linked: int):
        self.text, self.element, self.linked = text, element, linked


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, with white space made single and character references decoded."""
    root = Element("html", None)
    here, out = root, []
    every = [root]
    parts: list[tuple[str, Element]] = []
    opened: dict[str, list[Element]] = {}  # open elements by name, so that no tag walks up the tree in vain
    last: set[str] = set()  # embedded elements with no further tag of their name

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                linked = sum(len("".join(p.split())) for p, e in parts if e.link)
                owner = next((e for p, e in parts if p.strip()), parts[0][1])
                out.append(Block(text, owner.block, linked))
            parts = []

    def leave(element: Element) -> None:
        """Close ``element`` and all that is open inside it."""
        nonlocal here
        while here is not element.parent:
            opened[here.tag].pop()
            here = here.parent

    at, n = 0, len(page)
    while at < n:
        low = page.find("<", at)
        if low < 0:
            low = n
        if low > at:
            raw = page[at:low]
            parts.append((html.unescape(raw) if "&" in raw else raw, here))
            at = low
            continue
        m = _TAG.match(page, at)
        if not m or m.group(2) is None:
            m = m or _LOOSE.match(page, at)
            if m:
                at = m.end()
            else:
                parts.append(("<", here))
                at += 1
            continue
        at = m.end()
        tag = m.group(2).lower()
        if m.group(1):  # a closing tag
            if tag == "br":
                parts.append((" ", here))
                continue
            stack = opened.get(tag)
            # inline elements do not close across blocks
            if stack and (tag in BLOCK or stack[-1].block is here.block):
                if tag in BLOCK:
                    flush()
                leave(stack[-1])
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            stop = page.find(">", end.start()) if end else -1
            at = stop + 1 if stop >= 0 else n
            continue
        if tag in EMBEDDED:
            # closed if the next tag of its name closes it; else only the tag goes
            if tag not in last and not m.group(3).rstrip().endswith("/"):
                end = re.compile(rf"<(/?){tag}[\s/>]", re.I).search(page, at)
                if end is None:
                    last.add(tag)
                elif end.group(1):
                    stop = page.find(">", end.start())
                    at = stop + 1 if stop >= 0 else n
            continue
        if tag in BLOCK:
            flush()
            close = CLOSES.get(tag)
            if close:
                inner = max((opened[t][-1] for t in close if opened.get(t)), key=lambda e: e.depth, default=None)
                fence = max((opened[t][-1].depth for t in LISTS if opened.get(t)), default=0)
                if inner is not None and inner.depth > fence:
                    leave(inner)
            elif here.block.tag == "p":
                leave(here.block)
        elif tag == "a" and opened.get("a") and opened["a"][-1].block is here.block:
            leave(opened["a"][-1])
        if tag in VOID:
            if tag in ("br", "wbr", "img"):
                parts.append(("" if tag == "wbr" else " ", here))
            continue
        if tag in ("html", "head") or (tag == "body" and here.tag != "html"):
            continue
        here = Element(tag, here, m.group(3))
        every.append(here)
        opened.setdefault(tag, []).append(here)
    flush()
    weigh(every, out)
    return out


def weigh(every: list[Element], found: list[Block]) -> None:
    """Set the context of all elements, which are given with parents before children."""
    for b in found:
        b.element.size += len(b.text) - b.text.count(" ") - b.linked
    for e in reversed(every):
        if e.parent is not None:
            e.parent.size += e.size
    total = max(every[0].size, 1)
    for e in every:
        if e.parent is not None:
            score = e.score + e.ordinary * max(0.0, 1 - MAIN_SHARE * e.size / total)
            # strong evidence against outweighs that the element lies in an article
            before = min(e.parent.context, 0.0) if score <= STRONG / 2 else e.parent.context
            e.context = max(CONTEXT_LOW, min(CONTEXT_HIGH, before + score))


def log_odds(block: Block) -> float:
    words = block.text.count(" ") + 1
    size = max(len(block.text.replace(" ", "")), 1)
    own = BIAS + PER_DOUBLING * math.log2(1 + words) + LINKS * min(block.linked / size, 1.0) + COMMAS * min(block.text.count(","), 4)
    if block.element.tag in TEXT_TAGS:
        own += TEXT_TAG
    if block.text[-1] in ".!?…":
        own += SENTENCE
    return max(-OWN_LIMIT, min(OWN_LIMIT, own)) + block.element.context


def distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: gain[i] > 0 is what label True saves at i, edges charge for labels that differ.

    Nodes whose own gain outweighs all their edges are settled first and become part of a terminal, which
    can settle their neighbours; the rest is solved by max-flow over blocking flows.
    """
    n = len(gain)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    label: list[bool | None] = [None] * n
    pull, open_weight = list(gain), [sum(w for _, w in near[i]) for i in range(n)]
    waiting = list(range(n))
    while waiting:
        i = waiting.pop()
        if label[i] is None and abs(pull[i]) > open_weight[i] + 1e-9:
            label[i] = pull[i] > 0
            for j, w in near[i]:
                if label[j] is None:
                    pull[j] += w if label[i] else -w
                    open_weight[j] -= w
                    waiting.append(j)
    free = [i for i in range(n) if label[i] is None]
    if not free:
        return [bool(x) for x in label]
    at = {i: k for k, i in enumerate(free)}
    source, sink = len(free), len(free) + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(len(free) + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(c)

    for i in free:
        own = gain[i]
        for j, w in near[i]:
            if label[j] is not None:
                own += w if label[j] else -w
            elif i < j:
                join(at[i], at[j], w, w)
        if own > 0:
            join(source, at[i], own, 0.0)
        elif own < 0:
            join(at[i], sink, -own, 0.0)
    tiny = 1e-12
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        tried = [0] * len(out)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if room[e] <= tiny)
                x = to[path[first] ^ 1]
                del path[first:]
                continue
            while tried[x] < len(out[x]):
                e = out[x][tried[x]]
                if room[e] > tiny and level[to[e]] == level[x] + 1:
                    break
                tried[x] += 1
            if tried[x] < len(out[x]):
                path.append(out[x][tried[x]])
                x = to[path[-1]]
            elif path:
                x = to[path.pop() ^ 1]
                tried[x] += 1
            else:
                break
    for i in free:
        label[i] = level[at[i]] >= 0
    return [bool(x) for x in label]


def smoothness(found: list[Block]) -> tuple[int, list[tuple[int, int, float]]]:
    """(number of nodes, edges) of a page: nodes are the blocks and, after them, the containers of several of these."""
    edges: list[tuple[int, int, float]] = []
    weight = lambda w, a, b: w * (1.0 if a.context == b.context else BORDER)
    for i in range(1, len(found)):
        a, b = found[i - 1].element, found[i].element
        edges.append((i - 1, i, weight(2 * ADJACENT / (2 + distance(a, b)), a, b)))
    # every element above a block once; those with one child only are passed over
    children: dict[int, int] = {}
    for b in found:
        e = b.element
        children[id(e)] = children.get(id(e), 0) + 1
        while children[id(e)] == 1 and e.parent is not None:
            e = e.parent
            children[id(e)] = children.get(id(e), 0) + 1
    node: dict[int, int] = {}
    n = len(found)

    def join(i: int, e: Element | None, own: Element) -> None:
        """Edges from node ``i`` up to the containers; a container is joined to its own when it is first met."""
        nonlocal n
        while e is not None:
            while e is not None and children[id(e)] < 2:
                e = e.parent
            if e is None or e.parent is None:
                return  # the page as a whole holds nothing together
            k = node.get(id(e))
            new = k is None
            if new:
                k = node[id(e)] = n
                n += 1
            edges.append((i, k, weight(TREE, own, e)))
            if not new:
                return
            i, own, e = k, e, e.parent

    for i, b in enumerate(found):
        join(i, b.element, b.element)
    return n, edges


def labels(found: list[Block]) -> tuple[list[bool], list[float]]:
    """(whether each block is content, its log-odds by itself)."""
    gain = [log_odds(b) for b in found]
    n, edges = smoothness(found)
    return minimum_cut(gain + [0.0] * (n - len(found)), edges)[: len(found)], gain


def content(page: str | None) -> tuple[str, int, int]:
    """(main text, number of blocks, number of blocks kept) of a page."""
    found = blocks(page or "")
    keep, _ = labels(found)
    kept = [b.text for b, k in zip(found, keep) if k]
    return " ".join(kept), len(found), len(kept)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_kept for every row of ``pages`` (page_id, url, html).

    Whole pages are read; a null or empty html, or one without content, has the empty text. Broken markup is read as
    far as it goes. Repeated rows each get a row; null ids and urls stay null; extra columns are ignored.
    """
    frame = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            found = [content(h) for h in column(part, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "page_id"), column(part, "url"), pa.array([t for t, _, _ in found], pa.string()),
                    pa.array([len(t) for t, _, _ in found], pa.int64()),
                    pa.array([n for _, n, _ in found], pa.int64()), pa.array([k for _, _, k in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
            )

    kind = lambda c: frame.schema[c].dataType.simpleString()
    return frame.mapInArrow(run, f"page_id {kind('page_id')}, url {kind('url')}, text string, n_chars long, n_blocks long, n_kept long")
