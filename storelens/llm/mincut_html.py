"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks, the runs of text between block-level tags. A logistic
classifier gives each block a cost for being called content and one for being
called boilerplate; these are its capacities to the two terminals. Blocks that
follow each other, and blocks that are neighbours under one parent, are joined by
edges whose capacity falls with their distance in the element tree. The maximum
flow finds the labelling of least total cost, so a doubtful block goes with its
neighbours unless a border between containers separates them.

The classifier is trained here, on blocks of a bounded sample of pages whose
containers say what they are (articles; navigation, forms, comments and so on).
Its inputs are the names of the containers and what the text looks like. It learns
from every block a second time without the names, with weights of their own for what
the text looks like and for how much of the page's text is in the same container, so
it also judges blocks whose containers say nothing. A form that holds most of a
page's text is a wrapper, and its names say nothing.

A null or empty page has no text. One row comes out per row, copies and null ids
included; extra columns are ignored; broken markup is read as browsers do for
unclosed elements. Without sample pages an untrained classifier with fixed leanings
for container names decides.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as

# Fixed values of HTML.
SILENT = {"script", "style", "noscript", "template", "title", "head", "textarea", "select", "option", "button",
          "svg", "math", "iframe", "object", "canvas", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "big"}
#: An element that a new one of the listed kinds ends.
ENDS = {"p": {"p", "div", "ul", "ol", "li", "table", "section", "article", "aside", "nav", "footer", "header", "form",
              "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "main", "hr", "dl", "figure"},
        "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
#: What a head may hold; anything else, and text outside these, ends it.
IN_HEAD = {"title", "meta", "link", "base", "script", "style", "noscript", "template"}
# Words in container names that say what a container is.
GOOD = {"article", "main", "content", "post", "entry", "story", "body-text", "articlebody"}
BAD = {"nav", "footer", "aside", "form", "header", "menu", "sidebar", "ad", "ads", "advert", "advertisement", "banner",
       "cookie", "consent", "notice", "notification", "alert", "comment", "comments", "reply", "replies", "promo", "sponsor",
       "sponsored", "social", "share", "related", "widget", "breadcrumb", "breadcrumbs", "navbar", "navigation", "modal",
       "popup", "subscribe", "newsletter", "login", "search", "toolbar", "dialog", "disqus", "reviews", "copyright"}

BUCKETS = 2048
SHAPES = 16
#: Bounds of the training sample.
SAMPLE_PAGES, SAMPLE_BLOCKS = 600, 20_000
ADJACENT, SIBLING = 0.6, 1.2


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # identifiers of the open elements
    elements: tuple[tuple[str, int, tuple[str, ...]], ...]  # tag, identifier and words of names, outermost first
    linked: int  # characters inside links
    names: tuple[str, ...] = ()  # words of tags, classes and ids
    share: float = 0.0  # of the page's text, what is in the same container


class BlockReader(HTMLParser):
    """Collects the blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int, tuple[str, ...]]] = []
        self.made = 0
        self.parts: list[str] = []
        self.linked = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = tuple(i for tag, i, _ in self.open if tag not in INLINE)
            self.blocks.append(Block(text, path, tuple(self.open), self.linked))
        self.parts, self.linked = [], 0

    def _in_head(self) -> bool:
        """Whether the innermost open element is the head."""
        return bool(self.open) and self.open[-1][0] == "head"

    def handle_starttag(self, tag, attrs):
        if self._in_head():
            if tag in ("html", "head"):
                return
            if tag not in IN_HEAD:
                self._close("head")
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self._flush()
            while self.open and self._innermost_block() in ENDS and tag in ENDS[self._innermost_block()]:
                self._close(self._innermost_block())
        if tag in VOID:
            return
        named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
        words = (tag, *re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()))
        self.made += 1
        self.open.append((tag, self.made, words))

    def _innermost_block(self) -> str:
        return next((tag for tag, _, _ in reversed(self.open) if tag not in INLINE), "")

    def _close(self, tag: str) -> None:
        while self.open:
            closed = self.open.pop()[0]
            if closed == tag:
                break

    def handle_endtag(self, tag):
        if tag in VOID or not any(t == tag for t, _, _ in self.open):
            return
        if tag not in INLINE:
            self._flush()
            self._close(tag)
            return
        # an inline end tag closes nothing beyond the block it stands in
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i]
                break
            if self.open[i][0] not in INLINE:
                break

    def handle_data(self, data):
        if data.strip() and self._in_head():
            self._close("head")
        if any(tag in SILENT for tag, _, _ in self.open):
            return
        self.parts.append(data)
        if any(tag == "a" for tag, _, _ in self.open):
            self.linked += len(data.strip())

    def parse_marked_section(self, i, report=1):
        """``<![`` begins a comment up to the next ``>`` or the end of the page, as
        browsers read it."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def close(self):
        super().close()
        self._flush()


def read_blocks(html: str) -> list[Block]:
    reader = BlockReader()
    reader.feed(html)
    reader.close()
    total = sum(len(block.text) for block in reader.blocks)
    inside: Counter[int] = Counter()  # characters by form, and by the element around a block
    for block in reader.blocks:
        forms = {i for tag, i, _ in block.elements if tag == "form"}
        for i in forms | {-_parent(block)}:
            inside[i] += len(block.text)
    for block in reader.blocks:
        kept = [own for tag, i, own in block.elements if tag != "form" or 2 * inside[i] <= total]
        block.names = tuple(n for own in kept for n in own)
        block.share = inside[-_parent(block)] / total
    return reader.blocks


def _parent(block: Block) -> int:
    """The identifier of the element around a block's own; 0 is the page."""
    return block.path[-2] if len(block.path) > 1 else 0


def features(block: Block, place: float) -> tuple[list[int], list[float]]:
    """Buckets of container names, and what the text looks like: in the first half
    if a container says what it is, else in the second."""
    words = block.text.split()
    buckets = sorted({zlib.crc32(n.encode()) % BUCKETS for n in block.names})
    n = len(words)
    shapes = [
        1.0,
        math.log1p(n) / 4,
        min(block.linked / max(len(block.text), 1), 1.0),
        sum(w[-1] in ".!?" for w in words) / n,
        sum(w[-1] in ",;:" for w in words) / n,
        len(block.text) / n / 10,
        abs(place - 0.5),
    ]
    if told(block) is not None:
        return buckets, [*shapes, 0.0] + [0.0] * (SHAPES // 2)
    return buckets, [0.0] * (SHAPES // 2) + [*shapes, block.share]


def unnamed(block: Block) -> Block:
    """The block as if its containers said nothing."""
    tags = (tag for tag, _, _ in block.elements)
    return replace(block, names=tuple(t for t in tags if t not in GOOD and t not in BAD))


def told(block: Block) -> int | None:
    """What the innermost telling container says: 1 content, 0 boilerplate."""
    for name in reversed(block.names):
        if name in BAD:
            return 0
        if name in GOOD:
            return 1
    return None


def _sampled_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for html in batch.column(0).to_pylist():
            blocks = read_blocks(html)
            for i, block in enumerate(blocks):
                label = told(block)
                if label is not None:
                    rows += [(*features(b, i / len(blocks)), label) for b in (block, unnamed(block))]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["buckets", "shapes", "label"])


def prior() -> np.ndarray:
    """Weights before training: fixed leanings for telling names."""
    weights = np.zeros(BUCKETS + SHAPES)
    for names, lean in ((GOOD, 3.0), (BAD, -4.0)):
        for name in names:
            weights[zlib.crc32(name.encode()) % BUCKETS] = lean
    weights[BUCKETS : BUCKETS + SHAPES] = 2 * [-1.0, 1.5, -3.0, 1.0, 1.0, 0.0, 0.0, 0.0]
    return weights


def train(pages: DataFrame, html_col: str = "html") -> np.ndarray:
    """Weights from the blocks of at most SAMPLE_PAGES pages or twice as many,
    by a hash of the page, and SAMPLE_BLOCKS blocks at most; starts from, and is
    drawn towards, the fixed leanings."""
    prepared(pages.sparkSession)
    texts = rows_as(pages, html=html_col).where("html is not null")
    share = max(texts.count() // SAMPLE_PAGES, 1)
    sample = texts.where(F.pmod(F.xxhash64("html"), F.lit(share)) == 0)
    rows = sample.mapInArrow(_sampled_blocks, "buckets array<int>, shapes array<double>, label int")
    rows = rows.orderBy(F.xxhash64("shapes", "buckets"), "shapes", "buckets", "label").limit(SAMPLE_BLOCKS).collect()
    weights = start = prior()
    if not rows:
        return weights
    x = np.zeros((len(rows), BUCKETS + SHAPES), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row["buckets"]] = 1
        x[i, BUCKETS:] = row["shapes"]
    used = np.flatnonzero(x.any(axis=0))
    x, y = x[:, used], np.array([r["label"] for r in rows], dtype=float)
    w = start[used].copy()
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.5 * (x.T @ (p - y) / len(y) + 1e-3 * (w - start[used]))
    weights = start.copy()
    weights[used] = w
    return weights


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source when the cut is least. ``gain`` is what
    content costs less than boilerplate; a node's smaller terminal capacity flows
    straight through it, so the rest on one side is all that is left of the two."""
    n = len(gain)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        near[a].append(len(to))
        to.append(b)
        room.append(there)
        near[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, g in enumerate(gain):
        join(source, i, g, 0.0) if g > 0 else join(i, sink, -g, 0.0)
    for a, b, width in edges:
        join(a, b, width, width)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                width = min(room[e] for e in path)
                for e in path:
                    room[e] -= width
                    room[e ^ 1] += width
                full = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                at = to[path[full] ^ 1]
                del path[full:]
                continue
            while tried[at] < len(near[at]):
                e = near[at][tried[at]]
                if room[e] > 1e-9 and level[to[e]] == level[at] + 1:
                    break
                tried[at] += 1
            if tried[at] < len(near[at]):
                path.append(e)
                at = to[e]
            elif at == source:
                break
            else:
                e = path.pop()
                at = to[e ^ 1]
                tried[at] += 1


def _nearness(a: tuple[int, ...], b: tuple[int, ...]) -> float:
    """1 under one parent, less the more containers lie between."""
    shared = 0
    for x, y in zip(a, b):
        if x != y:
            break
        shared += 1
    apart = max(len(a) - shared, 1) + max(len(b) - shared, 1) - 2
    return 0.25**apart


def main_text(html: str, weights: np.ndarray) -> str:
    blocks = read_blocks(html)
    if not blocks:
        return ""
    gain = []
    for i, block in enumerate(blocks):
        buckets, shapes = features(block, i / len(blocks))
        score = float(weights[buckets].sum() + weights[BUCKETS:] @ shapes)
        # difference of the two costs -log p and -log(1 - p)
        gain.append(max(-12.0, min(12.0, score)))
    edges = []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT * _nearness(blocks[i - 1].path, block.path)))
        parent = _parent(block)
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, SIBLING * _nearness(blocks[last[parent]].path, block.path)))
        last[parent] = i
    return " ".join(b.text for b, kept in zip(blocks, min_cut(gain, edges)) if kept)


def extract(pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    prepared(pages.sparkSession)
    pages = rows_as(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", weights) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
