"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded over the tree.

A page becomes a tree of block elements; inline markup belongs to the block around it. Every node that holds text gets
features of its tag, attribute words, subtree density, depth and siblings. The trees give the probability that a node
holds main text, given that its parent does. Decoding takes the most probable labelling in which nothing below a
dropped node is kept, so an ancestor and a descendant never contradict each other.

The trees are trained by Spark ML on generated pages (``TRAINING_PAGES`` of them); a task parses and scores whole pages,
one Arrow batch at a time.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.pagegen import Writer

TRAINING_PAGES = 500
TREES, DEPTH, STEP_SIZE = 14, 5, 0.4
BATCH_CHARS = 4_000_000

# Elements without content, with raw content, of other vocabularies, and inline elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template svg math noframes xmp head title textarea object".split())
FOREIGN = frozenset("svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split()
)
GROUPS = {
    "p": "p", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl menu", "item": "li dt dd", "main": "article main", "nav": "nav", "header": "header",
    "footer": "footer", "aside": "aside", "form": "form button select option fieldset input label", "table": "table tbody thead tr td th",
    "quote": "blockquote pre figure figcaption", "div": "div section", "page": "body html #document",
}
TOKENS = {
    "main": "content article post entry story main body text",
    "nav": "nav navbar menu breadcrumb breadcrumbs pagination topnav tabs toc toolbar navigation pager",
    "header": "header masthead topbar branding logo hero",
    "footer": "footer copyright legal colophon bottom imprint",
    "side": "sidebar side aside related widget recommended popular trending rail more stories",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo banner",
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe overlay",
    "form": "form search login signup register",
    "comment": "comments comment reply replies discussion disqus responses respond",
    "social": "share social sharing follow",
}
INHERITED = ("main", "nav", "header", "footer", "aside", "form", "list", "table")
_TAG_GROUP = {t: i for i, ts in enumerate(GROUPS.values()) for t in ts.split()}
_TOKEN_GROUP = {t: i for i, ts in enumerate(TOKENS.values()) for t in ts.split()}
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z])", re.S)
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile("[>\"']")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "depth", "tokens", "keep", "children", "chars", "links", "commas", "signs", "blocks", "first", "place")

    def __init__(self, tag: str, parent: "Node | None", attrs: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.keep = "data-keep" in attrs
        self.tokens = 0
        for m in _NAMED.finditer(attrs):
            for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()):
                if w in _TOKEN_GROUP:
                    self.tokens |= 1 << _TOKEN_GROUP[w]
        self.children: list[Node] = []
        self.chars = self.links = self.commas = self.signs = self.blocks = 0
        self.first, self.place = 0, 0


class _Tags:
    """Where the tags of a page end, in time linear in the page however broken it is.

    A ``>`` inside quotes does not end a tag. Where a quote is never closed, the next ``>`` ends it; without one it is no tag.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.special: re.Match | None = None  # the last mark found: the first at or after ``self.since``
        self.since = -1
        self.dead: set[int] = set()  # opening quotes from which no end is reached
        self.raw: dict[str, tuple[int, int]] = {}

    def _mark(self, at: int) -> re.Match | None:
        if self.since < 0 or not (self.since <= at and (self.special is None or at <= self.special.start())):
            self.special, self.since = _SPECIAL.search(self.page, at), at
        return self.special

    def end(self, at: int) -> int | None:
        """The place of the ``>`` that ends a tag whose attributes start at ``at``."""
        if at > self.last:
            return None
        first, opened = at, []
        while (m := self._mark(at)) and m[0] != ">":
            quote = m.start()
            close = -1 if quote in self.dead else self.page.find(m[0], quote + 1)
            opened.append(quote)
            if close < 0:
                break
            at = close + 1
        else:
            if m:
                return m.start()
        self.dead.update(opened)
        return self.page.find(">", first)

    def raw_end(self, tag: str, at: int) -> tuple[int, int] | None:
        """Start and end of the next closing tag of a raw element."""
        beyond = len(self.page) + 1
        found = self.raw.get(tag, (-1, -1))
        if found[0] < at:
            m = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(self.page, at)
            found = self.raw[tag] = m.span() if m else (beyond, beyond)
        return None if found[0] == beyond else found


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The block tree, and the text blocks in page order, each with its node. Scripts, styles and comments are gone.

    As in HTML, a slash before ``>`` closes only void and foreign elements; a raw element with one that is never closed is empty.
    """
    root = node = Node("#document", None, "")
    open_tags: list[tuple[str, Node | None]] = []  # inline ones have no node
    places: dict[str, list[int]] = {}  # of each tag's open elements
    tags = _Tags(page)
    blocks: list[tuple[Node, str]] = []
    pending: list[str] = []
    link_depth = 0
    linked = 0

    def flush() -> None:
        nonlocal pending, linked
        if pending:
            text = " ".join(entities.unescape("".join(pending)).split())
            if text:
                node.chars += len(text)
                node.links += min(linked, len(text))
                node.commas += text.count(",") + text.count(".")
                node.signs += sum(map(text.count, "©|·»"))
                node.blocks += 1
                blocks.append((node, text))
            pending, linked = [], 0

    def close(k: int) -> None:
        """Close the open elements from place ``k`` on."""
        nonlocal node, link_depth
        for tag, own in reversed(open_tags[k:]):
            places[tag].pop()
            if own is not None:
                flush()
                node = own.parent
            elif tag == "a":
                link_depth = max(0, link_depth - 1)
        del open_tags[k:]

    def opened(tag: str, own: Node | None) -> None:
        places.setdefault(tag, []).append(len(open_tags))
        open_tags.append((tag, own))

    def innermost(wanted: frozenset | set, stop: frozenset | set) -> int | None:
        """Place of the innermost open element of ``wanted``, unless one of ``stop`` is open inside it."""

        def last(names: frozenset | set) -> int:
            return max((places[t][-1] for t in names if places.get(t)), default=-1)

        k = last(wanted)
        return k if k > last(stop) else None

    at = 0
    size = len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            pending.append(text)
            if link_depth:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[0].startswith("<![CDATA["):
            pending.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        if m[2] is None:
            continue
        end = None
        if at <= tags.last:
            named = _NAME_END.search(page, at).start()
            end = tags.end(named)
        if end is None:  # no tag
            pending.append(m[0])
            if link_depth:
                linked += len(m[0])
            continue
        attrs, tag, at = page[named:end], page[m.start(2) : named].lower(), end + 1
        if m[1]:
            k = innermost({tag}, frozenset())
            if k is not None:
                close(k)
            continue
        if tag in RAW:
            end = tags.raw_end(tag, at)
            if not attrs.endswith("/"):
                at = end[1] if end else size
            elif tag not in FOREIGN and end:
                at = end[1]
            continue
        if tag in VOID:
            if tag == "br":
                pending.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in CLOSES_P and (k := innermost({"p"}, {"button", "table"})) is not None:
            close(k)
        if tag == "li" and (k := innermost({"li"}, {"ul", "ol", "menu"})) is not None:
            close(k)
        if tag in ("dt", "dd") and (k := innermost({"dt", "dd"}, {"dl"})) is not None:
            close(k)
        if tag in ("tr", "td", "th") and (k := innermost({"td", "th"} | ({"tr"} if tag == "tr" else set()), {"table", "tr"} - {tag})) is not None:
            close(k)
        if tag == "option" and (k := innermost({"option"}, {"select"})) is not None:
            close(k)
        if tag in INLINE:
            opened(tag, None)
            link_depth += tag == "a"
            continue
        flush()
        child = Node(tag, node, attrs)
        child.place = len(node.children)
        child.first = len(blocks)
        node.children.append(child)
        opened(tag, child)
        node = child
    flush()
    return root, blocks


_GROUP_NAMES = list(GROUPS)
FEATURE_COUNT = len(GROUPS) + 2 * len(TOKENS) + len(INHERITED) + 18


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """Nodes with text below them, parents first, and their features."""
    order: list[Node] = []
    stack = [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(reversed(n.children))
    below = {id(n): [n.chars, n.links, n.commas, n.blocks, 1, n.signs, n.chars] for n in order}
    for n in reversed(order):
        if n.parent is not None:
            up, own = below[id(n.parent)], below[id(n)]
            for i in range(6):
                up[i] += own[i]
            up[6] = max(up[6], own[6])
    page = below[id(root)]
    kept = [n for n in order if below[id(n)][0] > 0]
    rows = np.zeros((len(kept), FEATURE_COUNT), np.float32)
    inherited: dict[int, int] = {}
    g, t, a = len(GROUPS), len(TOKENS), len(INHERITED)
    bits = {_GROUP_NAMES.index(name): 1 << (t + k) for k, name in enumerate(INHERITED)}
    for i, n in enumerate(kept):
        chars, links, commas, blocks, nodes, signs, longest = below[id(n)]
        above = inherited[id(n.parent)] if n.parent is not None else 0
        inherited[id(n)] = above | n.tokens | bits.get(_TAG_GROUP.get(n.tag, -1), 0)
        if n.tag in _TAG_GROUP:
            rows[i, _TAG_GROUP[n.tag]] = 1
        for k in range(t):
            rows[i, g + k] = n.tokens >> k & 1
            rows[i, g + t + k] = above >> k & 1
        for k in range(a):
            rows[i, g + 2 * t + k] = above >> (t + k) & 1
        siblings = n.parent.children if n.parent is not None else [n]
        around = sum(below[id(s)][0] for s in siblings) - chars
        before = below[id(siblings[n.place - 1])] if n.place > 0 else None
        after = below[id(siblings[n.place + 1])] if n.parent is not None and n.place + 1 < len(siblings) else None
        parent = below[id(n.parent)] if n.parent is not None else page
        rows[i, g + 2 * t + a :] = (
            np.log1p(chars), links / chars, chars / nodes, chars / blocks, commas / chars, np.log1p(longest), n.depth, len(n.children), n.place,
            len(siblings), np.log1p(around / max(1, len(siblings) - 1)), np.log1p(before[0]) if before else -1, np.log1p(after[0]) if after else -1,
            chars / page[0], chars / max(1, parent[0]), n.first / page[3], n.chars / chars, signs / blocks,
        )
    return kept, rows


def labels(nodes: list[Node]) -> np.ndarray:
    """Of generated pages: does a node hold main text, or stand inside it?"""
    direct: dict[int, bool] = {}
    for n in nodes:
        direct[id(n)] = n.keep or (n.parent is not None and direct[id(n.parent)])
    found = dict(direct)
    for n in reversed(nodes):
        if found[id(n)] and n.parent is not None:
            found[id(n.parent)] = True
    return np.array([found[id(n)] for n in nodes], bool)


class Forest:
    """Trained trees as arrays, so that a task scores all nodes of a batch at once."""

    def __init__(self, model):
        self.trees = []
        for tree, weight in zip(model.trees, model.treeWeights, strict=True):
            feature, bound, left, right, value = [], [], [], [], []

            def walk(node) -> int:
                at = len(feature)
                for column, blank in ((feature, -1), (bound, 0.0), (left, 0), (right, 0), (value, 0.0)):
                    column.append(blank)
                if node.subtreeDepth() == 0:
                    value[at] = node.prediction()
                else:
                    feature[at], bound[at] = node.split().featureIndex(), node.split().threshold()
                    left[at], right[at] = walk(node.leftChild()), walk(node.rightChild())
                return at

            walk(tree._java_obj.rootNode())
            self.trees.append((weight, np.array(feature), np.array(bound), np.array(left), np.array(right), np.array(value)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Log odds: twice the boosted margin."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for weight, feature, bound, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                at = np.where(f < 0, at, np.where(x[rows, np.maximum(f, 0)] <= bound[at], left[at], right[at]))
            total += weight * value[at]
        return 2 * total


def decode(nodes: list[Node], logits: np.ndarray) -> list[bool]:
    """The most probable labelling in which everything below a dropped node is dropped.

    A dropped subtree costs what dropping its topmost node costs; a kept node costs itself and the better choice for
    each child, so a doubtful container is kept for the sake of sure descendants."""
    keep_cost, drop_cost = np.logaddexp(0, -logits), np.logaddexp(0, logits)
    place = {id(n): i for i, n in enumerate(nodes)}
    best = keep_cost.copy()
    for i in range(len(nodes) - 1, 0, -1):
        best[place[id(nodes[i].parent)]] += min(best[i], drop_cost[i])
    kept = [False] * len(nodes)
    for i, n in enumerate(nodes):
        kept[i] = (i == 0 or kept[place[id(n.parent)]]) and best[i] < drop_cost[i]
    return kept


def train(spark: SparkSession, pages: int = TRAINING_PAGES) -> Forest:
    """Trees fitted on generated pages; the same every time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                nodes, x = features(parse(Writer(seed).page())[0])
                y = labels(nodes)
                above = {id(n): bool(k) for n, k in zip(nodes, y, strict=True)}
                open_ = np.array([n.parent is not None and above[id(n.parent)] for n in nodes], bool)
                x, y = x[open_], y[open_].astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.float64).tolist(), pa.list_(pa.float64())), pa.array(y)], ["x", "label"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = spark.range(0, pages, 1, min(4, parts)).mapInArrow(rows, "x array<double>, label double")
    data = data.select(array_to_vector("x").alias("features"), "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP_SIZE, maxBins=32, seed=1).fit(data)
    forest = Forest(model)
    data.unpersist()
    return forest


def _texts(pages: list[str], forest: Forest) -> list[str]:
    parsed = [parse(p) for p in pages]
    found = [features(root) for root, _ in parsed]
    held = [x for _, x in found if len(x)]
    logits = forest.logits(np.concatenate(held)) if held else np.zeros(0)
    out, at = [], 0
    for (_, blocks), (nodes, x) in zip(parsed, found, strict=True):
        kept = {id(n) for n, k in zip(nodes, decode(nodes, logits[at : at + len(x)]), strict=True) if k}
        at += len(x)
        out.append(" ".join(text for node, text in blocks if id(node) in kept))
    return out


def extract_text(pages: DataFrame, forest: Forest, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row. Null, empty and text-free pages give an empty text. Rows that share an id
    are read each for itself; other columns are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [h or "" for h in batch.column("html").to_pylist()]
            texts: list[str] = []
            start = size = 0
            for i, page in enumerate(raw):
                size += len(page)
                if size > BATCH_CHARS or i + 1 == len(raw):
                    texts += _texts(raw[start : i + 1], forest)
                    start, size = i + 1, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
