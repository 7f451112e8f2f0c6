"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 10).

A page is parsed into a tree; each element gets features of its own (tag, its parent's tag, hashed
attribute tokens, depth, place among its siblings) and of its subtree (lengths of text and of linked text, their
densities, counts of tags and of commas and ends of sentences).  Boosted regression trees score each
element as main content or not.  Decoding goes down the tree: an element's log odds are added to a
share of its ancestors' odds, an element below a rejected subtree of boilerplate cannot come back, and
an element inside accepted content is dropped only where its own score clearly says so; a choice thus
never contradicts an ancestor's.

The trees are trained here, on pages that a grammar of this module builds with known truth (articles
among menus, headers, adverts, notices, forms, sidebars, comments, footers; wrappers and attribute
names vary), so no page of a corpus is needed; training takes a second on the driver and gives a model
of fixed size.  Extraction is one pass over the pages without a shuffle.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed, empty ones go, the others are joined in page order by a newline.

Defined results: null and empty html give an empty text; broken markup is read as browsers do in the
main (an open paragraph ends where a block begins; what stays open ends with the page); plain text
without markup is content; equal pages give equal rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed by HTML: elements without content, elements whose text is no text, and elements that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg head title textarea select".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
TAGS = ("html", "body", "main", "article", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "a", "b", "span", "nav", "header", "footer", "aside", "form", "table", "tr", "td", "figure", "blockquote", "button", "label", "pre", "input")
PLACE = {t: i for i, t in enumerate(TAGS)}
ATTRIBUTE_SLOTS = 64
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "order")

    def __init__(self, tag: str, attributes: list, parent: "Node | None"):
        self.tag, self.parent, self.children, self.order = tag, parent, [], 0
        self.attributes = [t for k, v in attributes if k in ("class", "id", "role", "itemprop", "aria-label", "hidden", "style") for t in re.findall(r"[a-z]+", f"{k if k == 'hidden' else ''} {v or ''}".lower())]


class _Tree(HTMLParser):
    """Elements and texts in page order.  ``CLOSES``: what an opening tag ends."""

    CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", [], None)
        self.path = [self.root]  # open elements
        self.places: dict[str, list[int]] = {}  # where on the path each tag stands; under "" any block

    def enter(self, n: Node) -> None:
        for k in (n.tag, "") if n.tag in BLOCK else (n.tag,):
            self.places.setdefault(k, []).append(len(self.path))
        self.path.append(n)
        self.at = n

    def up_to(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        """Closes the nearest open element of ``tags``, unless one of ``stop`` is nearer; each element is left once."""
        nearest = lambda names: max((x[-1] for k in names if (x := self.places.get(k))), default=0)
        place = nearest(tags)
        if not place or nearest(stop) > place:
            return
        while len(self.path) > place:
            n = self.path.pop()
            for k in (n.tag, "") if n.tag in BLOCK else (n.tag,):
                self.places[k].pop()
        self.at = self.path[-1]

    def handle_starttag(self, tag, attributes):
        if tag in ("html", "body"):
            if tag == "body":
                self.up_to(("head",), ())
                self.root.attributes += Node(tag, attributes, None).attributes
            return
        if tag in BLOCK and tag != "br":
            self.up_to(("p",), ("table", "td", "article", "section", "div", "nav", "footer", "aside", "li"))
        if tag in self.CLOSES:
            self.up_to(self.CLOSES[tag], ("table",) if tag in ("tr", "td", "th") else ("ul", "ol", "dl", "menu", "select"))
        n = Node(tag, attributes, self.at)
        self.at.children.append(n)
        if tag not in VOID:
            self.enter(n)

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        # formatting does not end a block, and a block does not end what holds it
        self.up_to((tag,), ("",) if tag not in BLOCK else ())

    def handle_data(self, data):
        self.at.children.append(data)


def parse(page: str) -> Node:
    t = _Tree()
    t.feed(page)
    if t.rawdata and t.cdata_elem is None:  # a tag or reference cut off by the page's end
        rest = t.rawdata
        t.rawdata = ""
        if not rest.startswith("<"):
            t.handle_data(html.unescape(rest))
    return t.root


def elements(root: Node) -> list[Node]:
    """Elements in page order, parents first; each one's ``order`` is its place in the list."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        n.order = len(out)
        out.append(n)
        stack += [c for c in reversed(n.children) if isinstance(c, Node)]
    return out


FEATURES = 2 * len(TAGS) + ATTRIBUTE_SLOTS + 20


def features(nodes: list[Node]) -> np.ndarray:
    """A row of numbers for each element."""
    n = len(nodes)
    x = np.zeros((n, FEATURES), "f4")
    chars, linked, commas, ends, tags, paragraphs, links, inputs = (np.zeros(n) for _ in range(8))
    for k in range(n - 1, -1, -1):
        node = nodes[k]
        if node.tag in RAW:
            continue
        tags[k] += 1
        paragraphs[k] += node.tag == "p"
        links[k] += node.tag == "a"
        inputs[k] += node.tag in ("input", "button", "textarea", "select", "label")
        for c in node.children:
            if not isinstance(c, Node):
                chars[k] += len(c.strip())
                commas[k] += c.count(",")
                ends[k] += c.count(". ") + c.rstrip().endswith((".", "!", "?"))
        if node.tag == "a":
            linked[k] = chars[k]
        if node.parent is not None:
            p = node.parent.order
            for a in (chars, linked, commas, ends, tags, paragraphs, links, inputs):
                a[p] += a[k]
    depth, within, above, paragraph = (np.zeros(n) for _ in range(4))
    for k, node in enumerate(nodes):
        if node.tag in PLACE:
            x[k, PLACE[node.tag]] = 1
        if node.parent is not None:
            if node.parent.tag in PLACE:
                x[k, len(TAGS) + ATTRIBUTE_SLOTS + PLACE[node.parent.tag]] = 1
            above[k] = above[node.parent.order] or node.parent.tag in ("article", "main")
            paragraph[k] = (paragraphs[node.parent.order] - paragraphs[k]) > 0
        for t in node.attributes:
            x[k, len(TAGS) + zlib.crc32(t.encode()) % ATTRIBUTE_SLOTS] = 1
        kids = [c for c in node.children if isinstance(c, Node)]
        alike = Counter(c.tag for c in kids)
        for i, c in enumerate(kids):
            depth[c.order] = depth[k] + 1
            within[c.order] = (i + 0.5) / len(kids)
            x[c.order, -1] = len(kids)
            x[c.order, -2] = alike[c.tag]
    parent = np.array([0 if m.parent is None else m.parent.order for m in nodes])
    whole = max(chars[0], 1)
    f = 2 * len(TAGS) + ATTRIBUTE_SLOTS
    x[:, f : f + 18] = np.stack([np.log1p(chars), chars / whole, chars / np.maximum(chars[parent], 1), linked / np.maximum(chars, 1), links / np.maximum(tags, 1), np.log1p(tags), chars / np.maximum(tags, 1) / 50, commas / np.maximum(chars, 1) * 50, ends / np.maximum(chars, 1) * 50, np.log1p(paragraphs), np.log1p(inputs), depth, within, np.arange(n) / n, linked[parent] / np.maximum(chars[parent], 1), np.array([len(m.attributes) > 0 for m in nodes]), above, paragraph], 1)
    return x


@dataclass
class Trees:
    """Complete trees of one depth: each inner node's feature and bound, each leaf's value."""

    base: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, b, leaf in zip(self.feature, self.bound, self.leaf):
            at = np.zeros(len(x), "i8")
            for _ in range(int(np.log2(len(leaf)))):
                at = 2 * at + 1 + (x[rows, f[at]] > b[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.25, ridge: float = 2.0) -> Trees:
    """Second-order boosting of the logistic loss on at most 32 bins for each feature."""
    bounds = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(b, x[:, j], side="left") for j, b in enumerate(bounds)], 1)
    width = 33
    mean = float(np.average(y, weights=weight))
    t = Trees(np.log(mean / (1 - mean)), np.zeros((rounds, 2**depth - 1), "i8"), np.full((rounds, 2**depth - 1), np.inf), np.zeros((rounds, 2**depth)))
    margin = np.full(len(x), t.base)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(x), "i8")
        for level in range(depth):
            n = 2**level
            local = at - (n - 1)
            best, pick, cut_at = np.zeros(n), np.zeros(n, "i8"), np.full(n, width)
            gs, hs = np.bincount(local, g, n), np.bincount(local, h, n)
            for j, b in enumerate(bounds):
                if not len(b):
                    continue
                key = local * width + code[:, j]
                gl = np.cumsum(np.bincount(key, g, n * width).reshape(n, width), 1)[:, : len(b)]
                hl = np.cumsum(np.bincount(key, h, n * width).reshape(n, width), 1)[:, : len(b)]
                gain = gl**2 / (hl + ridge) + (gs[:, None] - gl) ** 2 / (hs[:, None] - hl + ridge) - (gs**2 / (hs + ridge))[:, None]
                k = gain.argmax(1)
                better = gain[np.arange(n), k] > best + 1e-6
                best[better], pick[better], cut_at[better] = gain[np.arange(n), k][better], j, k[better]
            nodes = np.arange(n) + n - 1
            t.feature[r, nodes] = pick
            t.bound[r, nodes] = [bounds[j][c] if c < width else np.inf for j, c in zip(pick, cut_at)]
            at = 2 * at + 1 + (code[np.arange(len(x)), pick[local]] > cut_at[local])
        leaf = at - (2**depth - 1)
        t.leaf[r] = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        margin += t.leaf[r][leaf]
    return t


#: Attribute names that the grammar gives to parts of a page, as web pages commonly use them.
NAMES = {
    "content": ("content", "main", "article", "post", "entry", "story", "body", "text"),
    "nav": ("nav", "menu", "navbar", "breadcrumb", "navigation", "topnav"),
    "header": ("header", "masthead", "banner", "top", "logo"),
    "footer": ("footer", "bottom", "copyright", "legal", "colophon"),
    "aside": ("sidebar", "related", "widget", "aside", "share", "social", "recommended"),
    "ad": ("ad", "ads", "advert", "sponsored", "promo", "advertisement"),
    "notice": ("notice", "cookie", "consent", "alert", "popup", "newsletter", "subscribe", "modal"),
    "form": ("form", "search", "login", "signup"),
    "comments": ("comments", "comment", "replies", "discussion", "respond"),
}
#: Elements that the grammar may use for each part.
ELEMENTS = {"content": ("article", "main", "div", "section", "article"), "nav": ("nav", "div", "nav", "ul"), "header": ("header", "div"), "footer": ("footer", "div", "footer"), "aside": ("aside", "div", "aside"), "ad": ("div", "aside", "section"), "notice": ("div", "section", "aside"), "form": ("form",), "comments": ("section", "div", "ul")}


def made_page(rng: np.random.Generator) -> tuple[Node, dict[int, bool]]:
    """A page of the grammar as its tree, and whether each element (by identity) is content."""
    truth: dict[int, bool] = {}

    def words(n):
        return " ".join("".join(rng.choice(list("abcdefghijklmnoprstuvwy"), rng.integers(2, 9))) + ("," if rng.random() < 0.06 else ". " if rng.random() < 0.06 else "") for _ in range(n)).capitalize() + ("." if rng.random() < 0.9 else "")

    def make(parent, tag, content, text="", names=()):
        n = Node(tag, [("class", " ".join(names))] if names else [], parent)
        parent.children.append(n)
        truth[id(n)] = content
        if text:
            n.children.append(text)
        return n

    def naming(part):
        return () if rng.random() < 0.25 else tuple(rng.choice(NAMES[part], rng.integers(1, 3)))

    def box(parent, part, content=False):
        tag = str(rng.choice(ELEMENTS[part]))
        names = naming(part)
        if tag == "div" and not names and not (content and rng.random() < 0.7):
            names = (str(rng.choice(NAMES[part])),)
        return make(parent, tag, content, names=names)

    def link_list(parent, content=False):
        ul = make(parent, "ul", content)
        for _ in range(rng.integers(2, 9)):
            li = make(ul, "li", content)
            make(li, "a", content, words(rng.integers(1, 4)))

    def boilerplate(parent, part):
        b = box(parent, part)
        if part in ("nav", "aside") or rng.random() < 0.15:
            if part == "aside":
                make(b, "h3", False, words(2))
            link_list(b)
        if part == "form":
            for _ in range(rng.integers(1, 4)):
                make(b, "label", False, words(2))
                make(b, "input", False)
            make(b, "button", False, words(1))
        if part == "comments":
            for _ in range(rng.integers(1, 6)):
                c = make(b, "div", False, names=("comment",) if rng.random() < 0.5 else ())
                make(c, "b", False, words(1))
                make(c, "p", False, words(rng.integers(3, 60)))
        if part in ("ad", "notice", "footer", "header"):
            style = rng.random()
            if style < 0.6:
                b.children.append(words(rng.integers(1, 25)))
            else:
                make(b, "p", False, words(rng.integers(2, 30)))
            if rng.random() < 0.3:
                make(b, "a", False, words(2))
            if part == "footer" and rng.random() < 0.4:
                b.children.append(words(rng.integers(1, 60)))
            if part == "notice" and rng.random() < 0.5:
                make(b, "button", False, words(1))
        return b

    def paragraph(parent):
        kind = rng.random()
        if kind < 0.58:
            p = make(parent, "p" if style < 0.7 else "div", True) if style < 0.85 else parent
            if rng.random() < 0.2:
                b = make(p, "b", True, words(rng.integers(1, 60)))
                if rng.random() < 0.3:
                    make(b, "br", True)
            p.children.append(words(int(rng.choice([1, 2, 4, 30, 60, 120]) * (0.5 + rng.random())) + 1))
            if p is parent:
                make(p, "br", True)
            if rng.random() < 0.2:
                make(p, "a", True, words(rng.integers(1, 4)))
                p.children.append(words(4))
        elif kind < 0.66:
            make(parent, str(rng.choice(["h2", "h3"])), True, words(rng.integers(1, 8)))
        elif kind < 0.9:
            ul = make(parent, str(rng.choice(["ul", "ol"])), True)
            for _ in range(rng.integers(2, 6)):
                make(ul, "li", True, words(rng.integers(1, 5) if rng.random() < 0.5 else rng.integers(2, 25)))
        elif kind < 0.95:
            make(make(parent, "blockquote", True), "p", True, words(rng.integers(5, 40)))
        else:
            tr = make(make(parent, "table", True), "tr", True)
            for _ in range(3):
                make(tr, "td", True, words(rng.integers(1, 5)))

    style = rng.random()  # paragraphs are p, or div, or stand in the article itself
    root = Node("html", [], None)
    truth[id(root)] = True
    body = root
    for _ in range(rng.integers(0, 3)):
        body = make(body, "div", True, names=tuple(rng.choice(["page", "wrapper", "container", "site", "layout"], rng.integers(0, 2))))
    before = [p for p in ("header", "nav", "notice", "ad", "form") if rng.random() < 0.5]
    after = [p for p in ("comments", "aside", "ad", "form", "notice", "nav", "footer") if rng.random() < 0.5]
    for p in before:
        boilerplate(body, p)
    main = box(body, "content", True)
    if rng.random() < 0.4:
        main = box(main, "content", True)
    bare = style >= 0.85 and rng.random() < 0.5  # an article that is nothing but its text
    if bare:
        main.children.append(words(rng.integers(40, 300)))
    if rng.random() < 0.8 and not bare:
        make(main, "h1", True, words(rng.integers(1, 15)))
    short = 1.0 if bare else rng.random()
    if short < 0.2:  # a heading and a few words
        p = make(main, "p", True)
        make(p, "b", True, words(rng.integers(1, 6))) if rng.random() < 0.5 else p.children.append(words(rng.integers(1, 6)))
        if rng.random() < 0.5:
            make(p, "br", True)
    for _ in range(0 if bare or short < 0.2 else rng.integers(1, 4) if short < 0.5 else rng.integers(1, 14)):
        paragraph(main)
        if rng.random() < 0.06:
            boilerplate(main, str(rng.choice(["ad", "aside", "notice", "form"])))
    if rng.random() < 0.15:
        boilerplate(main, str(rng.choice(["comments", "aside", "nav"])))
    for p in after:
        boilerplate(body, p)
    return root, truth


_trained: dict[tuple[int, int], Trees] = {}


def train(pages: int = 800, seed: int = 10) -> Trees:
    """The trees for ``pages`` pages of the grammar; a driver keeps them."""
    if (pages, seed) not in _trained:
        rng = np.random.default_rng(seed)
        xs, ys = [], []
        for _ in range(pages):
            root, truth = made_page(rng)
            nodes = elements(root)
            xs.append(features(nodes))
            ys.append([truth[id(n)] for n in nodes])
        x, y = np.concatenate(xs), np.concatenate(ys).astype("f8")
        weight = np.concatenate([np.full(len(v), 1 / np.sqrt(len(v))) for v in ys])
        weight = weight / weight.mean()
        _trained[pages, seed] = boost(x, y, weight)
    return _trained[pages, seed]


#: Elements that HTML itself sets beside the text.
BESIDE = frozenset("nav footer aside form button dialog menu".split())
#: Blocks of prose that say nothing of themselves where they have no attributes.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl dd dt figure figcaption".split())


def prose(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of each element's whole text, and of those inside links or beside the text."""
    whole, other = np.zeros(len(nodes)), np.zeros(len(nodes))
    for n in reversed(nodes):
        k = n.order
        whole[k] += sum(len(c.strip()) for c in n.children if not isinstance(c, Node)) * (n.tag not in RAW)
        if n.tag == "a" or n.tag in BESIDE:
            other[k] = whole[k]
        if n.parent is not None:
            whole[n.parent.order] += whole[k]
            other[n.parent.order] += other[k]
    return whole, other


def last_resort(nodes: list[Node], margin: np.ndarray) -> int | None:
    """Where all was rejected: the best-scored block that is not beside the text, nor in such a one, and holds more prose than links."""
    whole, other = prose(nodes)
    beside = np.zeros(len(nodes), bool)
    best = None
    for n in nodes[1:]:
        k = n.order
        beside[k] = beside[n.parent.order] or n.tag in BESIDE or n.tag in RAW or margin[k] < -3 and bool(n.attributes)
        if beside[k] or n.tag not in BLOCK or whole[k] <= 2 * other[k] or whole[k] < 25:
            continue
        if best is None or margin[k] > margin[best]:
            best = k
    return best


def decode(nodes: list[Node], margin: np.ndarray, keep: float = 0.2, sure: int | None = None) -> np.ndarray:
    """Whether each element is content, parents decided first.

    An element's evidence is its own margin and ``keep`` of its parent's evidence, within bounds;
    formatting without attributes shares its block's choice, and prose without attributes that of a box
    that was accepted.  ``sure`` and what holds it are accepted whatever their margins.  Below a rejected
    element all are rejected unless that one is a plain wrapper holding something clearly better; an
    accepted element stays open to boilerplate of its own.
    """
    evidence = margin.copy()
    best = margin.copy()  # the best margin below
    for n in reversed(nodes):
        if n.parent is not None:
            best[n.parent.order] = max(best[n.parent.order], best[n.order])
    chosen = np.zeros(len(nodes), bool)
    closed = np.zeros(len(nodes), bool)
    above = set()
    while sure is not None:
        above.add(sure)
        sure = nodes[sure].parent.order if nodes[sure].parent is not None else None
    whole, other = prose(nodes)
    for k, n in enumerate(nodes):
        if n.parent is None:
            chosen[k], evidence[k] = True, 0
            continue
        p = n.parent.order
        evidence[k] = margin[k] + keep * np.clip(evidence[p], -4, 4)
        if n.tag in RAW or closed[p]:
            closed[k] = True
            continue
        if n.tag not in BLOCK and not n.attributes:  # formatting belongs to its block
            evidence[k], chosen[k] = evidence[p], chosen[p]
            continue
        if n.tag in PROSE and not n.attributes and n.parent.parent is not None and chosen[p] and 2 * other[k] < whole[k]:
            evidence[k] = max(evidence[k], evidence[p])  # a paragraph is as good as its box
        if n.tag in ("nav", "footer"):
            evidence[k] = min(evidence[k], -1)
        if k in above:
            evidence[k] = max(evidence[k], 0.5)
        chosen[k] = evidence[k] > 0
        closed[k] = not chosen[k] and not (n.tag in ("div", "section", "main", "table", "tr", "td", "tbody", "center", "form") and best[k] > 1.5 and margin[k] > -2.5)
    return chosen


def blocks(root: Node, chosen: np.ndarray) -> list[str]:
    """Texts of chosen elements, cut where a block begins or ends."""
    out: list[str] = []
    held: list[str] = []

    def flush():
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            out.append(text)

    stack: list = [root]
    while stack:
        n = stack.pop()
        if n is None:
            flush()
        elif not isinstance(n, Node):
            held.append(n)
        elif n.tag not in RAW:
            block = n.tag in BLOCK
            if block:
                flush()
                stack.append(None)
            stack += [c for c in reversed(n.children) if isinstance(c, Node) or chosen[n.order]]
    flush()
    return out


def main_text(page: str | None, trees: Trees) -> str:
    """One page's main text."""
    return main_texts([page], trees)[0]


def main_texts(pages: list[str | None], trees: Trees) -> list[str]:
    """The pages' main texts; the trees rate the elements of all together."""
    parsed = [(root := parse(p), elements(root)) if p else (None, []) for p in pages]
    plain = [all(n.tag not in BLOCK and not n.attributes for n in nodes[1:]) for _, nodes in parsed]
    rated = [features(nodes) for (_, nodes), alone in zip(parsed, plain) if not alone]
    margins = trees.margin(np.concatenate(rated)) if rated else np.empty(0)
    out, at = [], 0
    for (root, nodes), alone in zip(parsed, plain):
        if root is None:
            out.append("")
        elif alone:
            out.append("\n".join(blocks(root, np.ones(len(nodes), bool))))
        else:
            out.append(_decoded(root, nodes, margins[at : at + len(nodes)]))
            at += len(nodes)
    return out


def _decoded(root: Node, nodes: list[Node], margin: np.ndarray) -> str:
    text = "\n".join(blocks(root, decode(nodes, margin)))
    if not text and (best := last_resort(nodes, margin)) is not None:
        chosen = decode(nodes, margin, sure=best)
        inside = np.zeros(len(nodes), bool)
        for n in nodes:
            inside[n.order] = n.order == best or n.parent is not None and inside[n.parent.order]
        text = "\n".join(blocks(root, chosen & inside))
    return text


def _slices(column: pa.Array, chars: int = 1 << 20, rows: int = 200) -> Iterator[list[str | None]]:
    """Pages of about a million characters together."""
    held: list[str | None] = []
    size = 0
    for page in column.to_pylist():
        held.append(page)
        size += len(page or "")
        if size >= chars or len(held) >= rows:
            yield held
            held, size = [], 0
    if held:
        yield held


def extract(pages: DataFrame, trees: Trees | None = None, html_col: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` to ``pages`` (in place of columns so named) and drops the html."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    shared = pages.sparkSession.sparkContext.broadcast(trees or train())

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                some = b.slice(lo, 500)
                texts = [t for part in _slices(some.column(len(kept))) for t in main_texts(part, shared.value)]
                yield pa.record_batch([*some.columns[: len(kept)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select(*kept, html_col).mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "text string, n_chars long"]))


def op10_html(spark, sf_dir):
    """The main text of every row of ``pages``."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
