"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is main text or not. Its own potential comes from its tag, the words of its class, id and role, those of
the elements that it stands in, its size and its share of link text; potentials between parent and child depend on the kind of child. Messages go up from the
leaves and down from the root (sum-product, exact on trees); text is kept where its element's marginal is at least 1/2.
Both kinds of potentials are trained from labelled pages.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import kept_columns, place, plain
from .html_pages import NAMES, labelled_page
from .html_tree import BLOCK, Tree, parse

LABELLED_PAGES = 400
#: Text of these is no text of the page: scripts, styles and what is never shown, and the contents of form controls.
HIDDEN = frozenset("script style template head title iframe noembed noframes textarea select option datalist".split())
#: Tags with a weight of their own.
TAGS = ("article", "main", "section", "div", "p", "li", "ul", "ol", "nav", "header", "footer", "aside", "form", "button", "label", "a", "h1", "h2", "h3", "h4", "table", "td", "blockquote", "pre", "figure", "figcaption", "body", "dialog")
_TAG = {t: i for i, t in enumerate(TAGS)}
_GROUPS = [g for g in NAMES if g != "plain"]
_CUE = {w: g for g in _GROUPS for name in NAMES[g] for w in [name.replace("-", "")]} | {
    "nav": "menu", "navigation": "menu", "breadcrumb": "menu", "pagination": "menu", "toolbar": "menu", "masthead": "header", "footer": "footer", "copyright": "footer", "contentinfo": "footer",
    "banner": "header", "sidebar": "side", "widget": "side", "complementary": "side", "ad": "ad", "ads": "ad", "advert": "ad", "sponsor": "ad", "sponsored": "ad", "promo": "ad", "cookie": "notice", "consent": "notice",
    "gdpr": "notice", "notice": "notice", "alert": "notice", "alertdialog": "notice", "popup": "notice", "modal": "notice", "overlay": "notice", "comment": "comment", "comments": "comment", "reply": "comment", "replies": "comment", "disqus": "comment",
    "newsletter": "form", "subscribe": "form", "signup": "form", "login": "form", "search": "form", "share": "share", "social": "share", "related": "related", "recommended": "related", "popular": "related", "trending": "related",
    "content": "content", "article": "content", "post": "content", "entry": "content", "story": "content", "main": "content",
}
SIZES, LINKS = (1, 5, 15, 40), (0.2, 0.5, 0.8)
N_FEATURES = 1 + len(TAGS) + 1 + len(_GROUPS) + (len(SIZES) + 1) + (len(SIZES) + 1) + (len(LINKS) + 1) + len(_GROUPS) + 1
#: What tags themselves say about the elements inside of them.
_TAG_CUE = {"nav": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "article": "content", "main": "content"}
_CONTENT = _GROUPS.index("content")
KINDS = ("holder", "prose", "item", "inline", "frame")
_KIND = {"p": 1, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1, "blockquote": 1, "pre": 1, "figcaption": 1, "li": 2, "td": 2, "th": 2, "dd": 2, "dt": 2, "tr": 2, "nav": 4, "header": 4, "footer": 4, "aside": 4, "form": 4, "article": 4, "main": 4, "dialog": 4}
_NAME_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def _kind(tag: str) -> int:
    return _KIND.get(tag, 0 if tag in BLOCK or tag == "#page" else 3)


@lru_cache(100_000)
def _own_features(tag: str, attrs: str) -> tuple[int, ...]:
    """Feature numbers that depend on the tag and its attributes."""
    out = [0, 1 + _TAG.get(tag, len(TAGS))]
    groups = set()
    for m in _NAME_ATTR.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name))
            found = _CUE.get(name.replace("-", "").replace("_", ""))
            groups |= {found} if found else {g for p in parts if (g := _CUE.get(p))}
    if len(groups) > 1:
        groups.discard("content")  # "post-comments" are comments
    return tuple(out + [2 + len(TAGS) + _GROUPS.index(g) for g in sorted(groups)])


def _bin(x: float, cuts: tuple) -> int:
    i = 0
    while i < len(cuts) and x >= cuts[i]:
        i += 1
    return i


def node_features(tree: Tree) -> list[list[int]]:
    """The features of each element, as numbers below N_FEATURES."""
    n = len(tree.tag)
    own, linked, total = [0] * n, [0] * n, [0] * n
    for e, piece, _ in tree.text:
        if tree.tag[e] not in HIDDEN:
            own[e] += piece.count(" ") + 1 if piece.strip() else 0
    for i in range(n - 1, -1, -1):
        total[i] += own[i]
        if tree.tag[i] == "a":
            linked[i] = total[i]
        if i:
            p = tree.parent[i]
            total[p] += total[i]
            linked[p] += linked[i]
    first, base = 2 + len(TAGS), 2 + len(TAGS) + len(_GROUPS)
    s = len(SIZES) + 1
    inside = base + 2 * s + len(LINKS) + 1
    out = []
    near, odd = [-1] * n, [False] * n  # the nearest cue of the elements above and of the element itself; any but for content
    for i in range(n):
        f = list(_own_features(tree.tag[i], tree.attrs[i]))
        p = tree.parent[i]
        cue = f[2] - first if len(f) > 2 else _GROUPS.index(_TAG_CUE[tree.tag[i]]) if tree.tag[i] in _TAG_CUE else -1
        if p >= 0:
            if near[p] >= 0:
                f.append(inside + near[p])
            if odd[p]:
                f.append(inside + len(_GROUPS))
            odd[i] = odd[p]
        near[i] = cue if cue >= 0 else near[p] if p >= 0 else -1
        odd[i] = odd[i] or cue >= 0 and cue != _CONTENT
        f += [base + _bin(own[i], SIZES), base + s + _bin(total[i], SIZES), base + 2 * s + _bin(linked[i] / total[i] if total[i] else 0.0, LINKS)]
        out.append(f)
    return out


@dataclass
class TreeModel:
    weights: list[float]  # log odds of each feature
    edges: list[list[list[float]]]  # log potential by kind of child, parent's state, child's state
    root: float  # log odds of the page element

    def marginals(self, tree: Tree, features: list[list[int]] | None = None) -> list[float]:
        """Probability that each element is main text, given the whole tree."""
        n, parent, w = len(tree.tag), tree.parent, self.weights
        unary = [sum([w[f] for f in fs]) for fs in (features or node_features(tree))]
        unary[0] += self.root
        # Upward: s0, s1 collect an element's own potential and its children's messages.
        s0, s1 = [0.0] * n, unary
        m0, m1 = [0.0] * n, [0.0] * n
        kinds = [_kind(t) for t in tree.tag]
        for i in range(n - 1, 0, -1):
            (e00, e01), (e10, e11) = self.edges[kinds[i]]
            a, b = s0[i] + e00, s1[i] + e01
            m0[i] = (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))
            a, b = s0[i] + e10, s1[i] + e11
            m1[i] = (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))
            s0[parent[i]] += m0[i]
            s1[parent[i]] += m1[i]
        # Downward: b0, b1 add what the rest of the tree says.
        b0, b1 = s0[:], s1[:]
        for i in range(1, n):
            p = parent[i]
            r0, r1 = b0[p] - m0[i], b1[p] - m1[i]
            (e00, e01), (e10, e11) = self.edges[kinds[i]]
            a, b = r0 + e00, r1 + e10
            d0 = (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))
            a, b = r0 + e01, r1 + e11
            d1 = (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))
            b0[i], b1[i] = s0[i] + d0, s1[i] + d1
        return [1.0 / (1.0 + math.exp(min(700.0, max(-700.0, x - y)))) for x, y in zip(b0, b1)]


def page_labels(tree: Tree) -> list[int]:
    """States of a labelled page as its marks tell: inside an element with data-main, and not inside one with data-aside."""
    state = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        state[i] = 0 if "data-aside" in tree.attrs[i] else 1 if "data-main" in tree.attrs[i] else state[tree.parent[i]]
    return state


class _Forest:
    """Labelled pages end to end, for training: elements by depth, so that messages pass a depth at a time."""

    def __init__(self, pages: Iterable[str]):
        parent, kind, features, state, depth = [], [], [], [], []
        for html in pages:
            tree, base = parse(html), len(parent)
            state += page_labels(tree)
            features += node_features(tree)
            kind += [_kind(t) for t in tree.tag]
            for p in tree.parent:
                depth.append(0 if p < 0 else depth[base + p] + 1)
                parent.append(-1 if p < 0 else base + p)
        self.parent, self.kind, self.state = np.array(parent), np.array(kind), np.array(state)
        self.cols = np.concatenate([np.array(f) for f in features])
        self.row = np.repeat(np.arange(len(features)), [len(f) for f in features])
        depth = np.array(depth)
        self.levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)]
        self.child = np.flatnonzero(self.parent >= 0)

    def marginals(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of state 1 of each element, and of each pair of states of parent and child."""
        n = len(self.parent)
        s = np.zeros((n, 2))
        s[:, 1] = np.bincount(self.row, weights[self.cols], n)
        m, pair = np.zeros((n, 2)), np.zeros((n, 2, 2))
        e = edges[self.kind]
        for i in reversed(self.levels):
            m[i] = np.logaddexp(s[i, :1] + e[i, :, 0], s[i, 1:] + e[i, :, 1])
            for c in (0, 1):
                s[:, c] += np.bincount(self.parent[i], m[i, c], n)
        b = s.copy()
        for i in self.levels:
            rest = b[self.parent[i]] - m[i]
            pair[i] = rest[:, :, None] + e[i] + s[i][:, None, :]
            b[i] = s[i] + np.logaddexp(rest[:, :1] + e[i, 0, :], rest[:, 1:] + e[i, 1, :])
        pair = np.exp(pair - pair.max((1, 2), keepdims=True))
        return 1 / (1 + np.exp(np.clip(b[:, 0] - b[:, 1], -700, 700))), pair / pair.sum((1, 2), keepdims=True)


def train_tree_model(pages: Iterable[str], steps: int = 120, rate: float = 0.15) -> TreeModel:
    """Weights and edge potentials of greatest likelihood of the labelled pages' states given their features, with a small
    ridge. Sums and products over whole trees give the gradient exactly, so evidence that many children repeat is weighed
    as it deserves. Steps follow the gradient's running mean over its running size."""
    forest = _Forest(pages)
    n, child = len(forest.parent), forest.child
    seen = np.zeros((len(KINDS), 2, 2))
    np.add.at(seen, (forest.kind[child], forest.state[forest.parent[child]], forest.state[child]), 1.0)
    x = np.concatenate([np.zeros(N_FEATURES), np.zeros(seen.size)])
    mean, size = np.zeros(x.size), np.zeros(x.size)
    for t in range(1, steps + 1):
        one, pair = forest.marginals(x[:N_FEATURES], x[N_FEATURES:].reshape(seen.shape))
        expected = np.zeros(seen.shape)
        np.add.at(expected, forest.kind[child], pair[child])
        g = np.concatenate([np.bincount(forest.cols, (forest.state - one)[forest.row], N_FEATURES), (seen - expected).ravel()]) - x
        mean, size = 0.9 * mean + 0.1 * g, 0.99 * size + 0.01 * g * g
        x = x + rate * min(1.0, 2.0 * (1 - t / (steps + 1))) * (mean / (1 - 0.9**t)) / (np.sqrt(size / (1 - 0.99**t)) + 1e-9)
    return TreeModel([float(v) for v in x[:N_FEATURES]], x[N_FEATURES:].reshape(seen.shape).tolist(), 0.0)


@lru_cache(1)
def default_model() -> TreeModel:
    return train_tree_model(labelled_page(i) for i in range(LABELLED_PAGES))


def main_text(html: str, model: TreeModel) -> str:
    """Blocks of main text in page order, joined by one space; white space inside a block is one space."""
    tree = parse(html)
    if not tree.text:
        return ""
    keep = [p >= 0.5 for p in model.marginals(tree)]
    hidden = [False] * len(keep)
    for i in range(1, len(keep)):
        hidden[i] = tree.tag[i] in HIDDEN or hidden[tree.parent[i]]
        keep[i] = keep[i] and not hidden[i]
    blocks, current = [], []
    for e, piece, fresh in tree.text:
        if fresh and current:
            blocks.append("".join(current))
            current = []
        if keep[e]:
            current.append(piece)
    blocks.append("".join(current))
    return " ".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract_main_text(pages: DataFrame, html_col: str = "html", model: TreeModel | None = None) -> DataFrame:
    """pages' columns but the html, with text (empty if none) and n_chars (its code points) added.

    Whole pages are read; null html counts as empty. Character references are decoded. Broken markup never fails, and takes
    time linear in the page. Formulas, drawings and fallback texts (math, svg, canvas, object, noscript, audio, video) count
    as text where they stand in the article. Every row keeps its columns, repeated rows included; columns named text or
    n_chars, whatever their case, are replaced, and other names stay as they are; an empty table gives an empty result.
    Without a model, one is trained from the labelled pages that come with the library.
    """
    model = model or default_model()
    keep, places = kept_columns(pages, ("text", "n_chars"))
    html = place(pages, html_col)
    keep, places = [n for n, c in zip(keep, places) if c != html], [c for c in places if c != html]
    names = [*places, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_buffer().to_pybytes().decode("utf-8", "replace"), model) if h.is_valid else "" for h in batch.column(len(places))]
            cols = [batch.column(i) for i in range(len(places))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    rows = plain(pages)
    src = rows.select(*places, F.col(html).alias("_html"))
    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in places) + "text string, n_chars long"
    return src.mapInArrow(run, schema).toDF(*keep, "text", "n_chars")
