"""Main text of web pages: boosted trees judge the nodes, a tree decoder keeps the choices consistent."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import drop_work_table, map_slices, table, work_table
from shelfwise.llm.html_tree import INLINE, RAW, Element, parse, squeezed

#: Pages that the trees are fitted on (of those that mark their article the smallest key hashes).
SAMPLE_PAGES = 300
#: Pages with a mark that are parsed first to find them; the range of hashes then widens by WIDEN.
LOOK_PAGES = 1200
WIDEN = 16
ROUNDS = 30
DEPTH = 3
RATE = 0.3
BINS = 24

# Attribute tokens that usual page templates use for the article and for what surrounds it.
CONTENT_TOKENS = frozenset("article articlebody body content entry main post story text".split())
OTHER_TOKENS = frozenset(
    "ad ads advert advertisement alert banner breadcrumb comment comments consent cookie disqus footer form "
    "header login masthead menu nav navbar navigation newsletter notice pager pagination popup promo related "
    "search share sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
OTHER_TAGS = frozenset("nav header footer aside form menu button select dialog".split())
WRAP, MAIN, DROP = 0, 1, 2
FEATURES = 26


@dataclass
class Node:
    """A block element of the tree, inline ones being part of it."""

    element: Element
    parent: int
    depth: int
    place: int
    siblings: int
    chars: int = 0
    words: int = 0
    link_chars: int = 0
    tags: int = 0
    stops: int = 0
    paragraphs: int = 0
    own: int = 0


def nodes(root: Element) -> list[Node]:
    """Block elements in page order, each after its parent, with the sums of their subtrees."""
    out: list[Node] = []
    todo = [(root, -1, 0, 0, 1)]
    while todo:
        e, parent, depth, place, siblings = todo.pop()
        me = len(out)
        node = Node(e, parent, depth, place, siblings)
        out.append(node)
        below: list[tuple[Element, int, int, int, int]] = []
        inner = [(x, False) for x in reversed(e.items)]
        while inner:
            x, link = inner.pop()
            if isinstance(x, str):
                n = len(x) - x.count(" ") - x.count("\n")
                node.chars += n
                node.own += n
                node.words += len(x.split())
                node.stops += x.count(".") + x.count(",")
                if link:
                    node.link_chars += n
            elif x.tag in INLINE:
                node.tags += 1
                inner += [(y, link or x.tag == "a") for y in reversed(x.items)]
            elif x.tag not in RAW:
                node.tags += 1
                below.append((x, me, depth + 1, 0, 0))
        count = len(below)
        todo += [(x, p, d, k, count) for k, (x, p, d, _, _) in reversed(list(enumerate(below)))]
    for node in reversed(out):
        if node.element.tag == "p":
            node.paragraphs += 1
        if node.parent >= 0:
            up = out[node.parent]
            for name in ("chars", "words", "link_chars", "tags", "stops", "paragraphs"):
                setattr(up, name, getattr(up, name) + getattr(node, name))
    return out


def features(found: list[Node]) -> np.ndarray:
    """One row for each node: subtree densities, attribute tokens, depth and sibling statistics."""
    total = max(1, found[0].chars)
    best = [0] * len(found)  # most characters of a sibling group's member
    for n in found[1:]:
        best[n.parent] = max(best[n.parent], n.chars)
    above = [(0, 0, 0)] * len(found)
    rows = []
    for i, n in enumerate(found):
        e = n.element
        good, bad = len(e.tokens & CONTENT_TOKENS), len(e.tokens & OTHER_TOKENS)
        other = int(e.tag in OTHER_TAGS)
        up = above[n.parent] if n.parent >= 0 else (0, 0, 0)
        above[i] = (up[0] + good + (e.tag in ("article", "main")), up[1] + bad, up[2] + other)
        heading = int(e.tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
        rows.append(
            (
                n.chars / total, math.log1p(n.chars), math.log1p(n.words), n.link_chars / max(1, n.chars),
                n.tags / max(1, n.words), n.stops / max(1, n.words), n.paragraphs, n.own / max(1, n.chars),
                math.log1p(n.own), n.depth, n.place, n.siblings, n.place / max(1, n.siblings - 1),
                n.chars / max(1, best[n.parent]) if n.parent >= 0 else 1.0, good, bad, other,
                *up, e.tag == "p", e.tag in ("article", "main"), e.tag in ("ul", "ol", "li"),
                e.tag in ("div", "section"), heading, e.tag in ("#root", "html", "body"),
            )
        )
    return np.array(rows, float)


class BoostedTrees:
    """Gradient-boosted regression trees for the three states, one tree a state and round, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._bin(x)
        score = np.zeros((len(x), 3))
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        target = np.eye(3)[y]
        for _ in range(ROUNDS):
            p = _softmax(score)
            grown = []
            for c in range(3):
                tree = self._grow(binned, (target[:, c] - p[:, c]) * weight, p[:, c] * (1 - p[:, c]) * weight)
                score[:, c] += self._value(tree, binned)
                grown.append(tree)
            self.trees.append(grown)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)])

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A complete tree of DEPTH levels: feature and bin of each inner node, value of each leaf."""
        inner = 2**DEPTH - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        at = np.zeros(len(binned), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            place = at - first
            best = np.full(width, 1e-6)
            for j in range(binned.shape[1]):
                cell = place * BINS + binned[:, j]
                g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(cell, curve, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                won = top > best
                best[won] = top[won]
                feature[first : first + width][won], cut[first : first + width][won] = j, k[won]
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, curve, inner + 1)
        return feature, cut, RATE * g / (h + 1)

    def _value(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], binned: np.ndarray) -> np.ndarray:
        feature, cut, leaf = tree
        at, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return leaf[at - len(feature)]

    def log_probability(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        score = np.column_stack([sum(self._value(r[c], binned) for r in self.trees) for c in range(3)])
        return np.log(_softmax(score) + 1e-9)


def _softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def decode(found: list[Node], log_p: np.ndarray) -> list[int]:
    """The likeliest states of all nodes together.

    A wrapper may hold anything, main text may hold main text and dropped parts, and nothing under
    a dropped node is main, so no two choices on one path contradict each other.
    """
    below = {WRAP: (WRAP, MAIN, DROP), MAIN: (MAIN, DROP), DROP: (DROP,)}
    total = log_p.copy()
    for i in range(len(found) - 1, 0, -1):
        for s, allowed in below.items():
            total[found[i].parent, s] += max(total[i, t] for t in allowed)
    states = [WRAP] * len(found)
    for i in range(1, len(found)):
        allowed = below[states[found[i].parent]]
        states[i] = max(allowed, key=lambda t: (total[i, t], -t))  # noqa: B023
    return states


def text_of(found: list[Node], states: list[int]) -> str:
    """Texts of main nodes in page order, each block cleaned, joined by one space."""
    kept = {id(n.element): s == MAIN for n, s in zip(found, states, strict=True)}
    out: list[str] = []
    open_: list[str] = []

    def flush() -> None:
        block = squeezed("".join(open_))
        if block:
            out.append(block)
        open_.clear()

    todo: list = [(found[0].element, False)]
    while todo:
        x, on = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if on:
                open_.append(x)
        elif x.tag in RAW:
            continue
        elif x.tag in INLINE:
            todo += [(y, on) for y in reversed(x.items)]
        else:
            flush()
            todo.append((None, False))
            todo += [(y, kept[id(x)]) for y in reversed(x.items)]
    flush()
    return " ".join(out)


def _teacher(found: list[Node], article: set[int]) -> np.ndarray:
    """States by which elements are the article's: a node's text decides, 9 of 10 characters either way."""
    inside, part = [False] * len(found), [0] * len(found)
    for i, n in enumerate(found):
        up = inside[n.parent] if n.parent >= 0 else False
        own_drop = n.element.tag in OTHER_TAGS or bool(n.element.tokens & OTHER_TOKENS)
        inside[i] = (up or id(n.element) in article) and not own_drop
        part[i] = n.own if inside[i] else 0
    for i in range(len(found) - 1, 0, -1):
        part[found[i].parent] += part[i]
    share = np.array([p / max(1, n.chars) for p, n in zip(part, found, strict=True)])
    state = np.where(share >= 0.9, MAIN, np.where(share <= 0.1, DROP, WRAP))
    for i, n in enumerate(found):
        if not n.chars:
            state[i] = MAIN if inside[i] else DROP
    return state


def articles(found: list[Node]) -> list[Element]:
    """The article and main elements; of nested ones only the outermost."""
    inside, out = [False] * len(found), []
    for i, n in enumerate(found):
        mark = n.element.tag in ("article", "main")
        above = n.parent >= 0 and inside[n.parent]
        inside[i] = mark or above
        if mark and not above:
            out.append(n.element)
    return out


def _variant(root: Element, rng: random.Random) -> tuple[Element, set[int]]:
    """The page in another usual template: other tags and class names around the same texts, and
    the parts that the given pages lack (side columns, notices, forms, reader comments) filled with
    texts of the page, so that the trees do not hang on one template's marks."""
    marked = articles(nodes(root))
    if len(marked) != 1:
        return root, {id(a) for a in marked}
    article = marked[0]
    texts = [squeezed(x) for n in nodes(article) for x in n.element.items if isinstance(x, str) and len(x) > 20] or ["text"]

    def piece() -> str:
        t = rng.choice(texts)
        a = rng.randrange(max(1, len(t) - 80))
        return t[a : a + rng.randint(20, 200)]

    def box(tag: str, tokens: str, count: int, inner: str = "p") -> Element:
        return Element(tag, frozenset(tokens.split()), [Element(inner, frozenset(), [piece()]) for _ in range(count)])

    def links(tag: str, tokens: str) -> Element:
        entries = [Element("li", frozenset(), [Element("a", frozenset(), [piece()[:15]])]) for _ in range(rng.randint(3, 9))]
        return Element(tag, frozenset(tokens.split()), [Element("ul", frozenset(), entries)])

    kind = rng.randrange(4)
    if kind:
        article.tag = rng.choice(("article", "main", "div", "section"))
        names = ("content", "post", "entry content", "article body", "main", "story", "text")
        article.tokens = frozenset(rng.choice(names).split()) if article.tag in ("div", "section") else article.tokens
        body = next((n.element for n in nodes(root) if n.element.tag == "body"), root)
        for e in body.elements():
            if e.tag in ("nav", "footer", "header") and rng.random() < 0.4:
                e.tokens = e.tokens | {rng.choice(("menu", "nav", "navbar")) if e.tag == "nav" else e.tag}
                e.tag = "div"
        extra = [
            lambda: links("aside", "sidebar"), lambda: box("div", "sidebar related", 3), lambda: box("div", "cookie notice", 1),
            lambda: box("form", "newsletter signup", 2, "label"), lambda: box("section", "comments", rng.randint(2, 8)),
            lambda: box("div", "comment list", rng.randint(2, 6), "div"), lambda: box("header", "", 1),
            lambda: box("div", "share social", 1), lambda: box("aside", "", 2), lambda: links("div", "related"),
            lambda: box("div", "ad banner", 1),
        ]
        for make in rng.sample(extra, rng.randint(1, 5)):
            part = make()
            host = article if rng.random() < 0.2 and article.items else body
            host.items.insert(rng.randint(0, len(host.items)), part)
        if rng.random() < 0.3:  # a wrapper around the whole page
            body.items = [Element("div", frozenset(("wrapper", "page")), body.items)]
    return root, {id(article)}


def labelled(pages: DataFrame, sample: int) -> list[str]:
    """The html of at most ``sample`` pages that mark exactly one article, those with the smallest key hashes.

    Only pages with such a tag are parsed, in growing ranges of the hash until one holds enough of
    them or the range is all, so the pages are the same as if all were parsed. Equal pages count once.
    """
    most = (1 << 63) - 1
    key = F.shiftrightunsigned(F.xxhash64("page_id", "html"), 1)
    known = pages.where("html is not null").where(F.col("html").rlike("(?i)<(article|main)")).select(key.alias("key"), "html")
    n = known.count()

    def run(cols: dict[str, list]) -> dict[str, list]:
        one = [len(articles(nodes(parse(h)))) == 1 for h in cols["html"]]
        return {"key": [k for k, o in zip(cols["key"], one, strict=True) if o]}

    look = max(LOOK_PAGES, 4 * sample)
    while n:
        limit = most if look >= n else most // n * look
        marked = work_table(map_slices(known.where(F.col("key") <= limit), run, "key long", rows=64).distinct())
        chosen = [r["key"] for r in marked.orderBy("key").limit(sample).collect()]
        drop_work_table(marked)
        if chosen and (limit == most or len(chosen) == sample):
            return [r["html"] for r in known.where(F.col("key").isin(chosen)).dropDuplicates(["key"]).collect()]
        if limit == most:
            break
        look *= WIDEN
    return []


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> BoostedTrees | None:
    """Trees fitted on a bounded sample of pages that mark their article, each also in other templates.

    Pages without exactly one article or main element (of nested ones the outermost) teach nothing
    and are not sampled; where no page has one, None.
    """
    xs, ys, ws = [], [], []
    rng = random.Random(7)
    for html in sorted(labelled(pages, sample)):
        for copy in range(4):
            root = parse(html)
            root, article = _variant(root, rng) if copy else (root, {id(a) for a in articles(nodes(root))})
            found = nodes(root)
            xs.append(features(found))
            ys.append(_teacher(found, article))
            ws.append(np.array([1.0 + math.log1p(n.chars) for n in found]))
    if not xs:
        return None
    return BoostedTrees(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


def _plain(found: list[Node]) -> list[int]:
    """States where no trees could be fitted: everything but marked surroundings."""
    states = [MAIN] * len(found)
    for i, n in enumerate(found[1:], 1):
        marked = n.element.tag in OTHER_TAGS or n.element.tag == "head" or n.element.tokens & OTHER_TOKENS
        states[i] = DROP if marked or states[n.parent] == DROP else MAIN
    return states


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; pages are not shuffled.

    Null and empty html give an empty text; html without markup is one block and judged as such. Repeated and null
    ids are rows like others. Where none of all pages marks one article, all but marked surroundings is kept.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    trees = pages.sparkSession.sparkContext.broadcast(fit(pages))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(cols: dict[str, list]) -> dict[str, list]:
        model = trees.value
        found = [nodes(parse(h)) for h in cols["html"]]
        if model is None:
            states = [_plain(f) for f in found]
        else:
            log_p = model.log_probability(np.concatenate([features(f) for f in found]))
            cuts = np.cumsum([len(f) for f in found])[:-1]
            states = [decode(f, p) for f, p in zip(found, np.split(log_p, cuts), strict=True)]
        texts = [text_of(f, s) for f, s in zip(found, states, strict=True)]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_slices(rows, run, f"{kinds}, text string, n_chars long", rows=64)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
