"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements; each stretch of text between block boundaries is a leaf. Every node
is content or not. Its own features give a unary potential, every edge from parent to child a pairwise one.
Sum-product messages upward and downward give exact marginals on the tree, for all pages of a batch at once,
level by level. The weights maximise the likelihood of labelled pages (:mod:`strataflow.llm.labelled_pages`).
Leaves that are content with a probability of one half or more are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.labelled_pages import labelled_pages
from strataflow.llm.tokens import bound_batches

TRAIN_PAGES = 300
EPOCHS, RATE, DECAY = 180, 0.08, 2e-3

# One scan over a tag: a quote counts only after "=", and only if it closes; a tag without end reaches to the end.
_ATTRS = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+(?:>|\Z)"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>script|style|textarea|title|noscript|iframe)(?=[\s/>]){_ATTRS}.*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRS})"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PARTS = re.compile(r"[a-z]+")

_BLOCKS = (
    "html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li nav header footer aside form table thead tbody "
    "tfoot tr td th blockquote pre figure figcaption dl dt dd address fieldset details summary hr center dialog label"
).split()
_BLOCK_SET = frozenset(_BLOCKS)
# Elements that a new element of the key's kind closes, if one is open above the given borders.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_VOID = {"hr"}
# Elements without text of the page; the second ones can hold their own kind.
_CONTROLS, _NESTED = ("button", "select"), ("svg", "template")

# Stems of class, id and role names; each has a weight of its own. Short ones must be the whole part of a name.
_STEMS = (
    "nav menu header masthead footer sidebar widget advert promo banner sponsor cookie consent notice popup modal comment "
    "reply respons discuss share social related recommend breadcrumb pagination pager login signup subscribe newsletter "
    "search toolbar copyright legal alert hidden tag author byline meta rail overlay gdpr teaser trending "
    "article content post entry story main body text prose page title"
).split()
_WHOLE = ("ad", "ads", "side", "top", "bar", "skip", "form")
_SIGNS = re.compile("©|copyright|all rights reserved", re.I)

_TAG_AT = {t: i for i, t in enumerate(_BLOCKS)}
_STEM_AT = {s: len(_BLOCKS) + i for i, s in enumerate((*_STEMS, *_WHOLE))}
_REST = len(_BLOCKS) + len(_STEM_AT)
_LEAF, _LINKS, _SOME_LINKS, _WORDS, _SHORT, _STOP, _SIGN, _FULL, _ONE = range(_REST, _REST + 9)
FEATURES = _REST + 9


@dataclass
class Tree:
    """Nodes of one page in document order; ``parent`` of the root is -1."""

    parent: list[int] = field(default_factory=list)
    names: list[tuple[int, ...]] = field(default_factory=list)  # features of tag and attributes
    text: list[str | None] = field(default_factory=list)  # of leaves
    linked: list[int] = field(default_factory=list)  # characters inside links
    marked: list[bool] = field(default_factory=list)  # labelled pages: inside an element marked as content

    def add(self, parent: int, names: tuple[int, ...], text: str | None, linked: int, marked: bool) -> int:
        for column, value in zip((self.parent, self.names, self.text, self.linked, self.marked),
                                 (parent, names, text, linked, marked)):
            column.append(value)
        return len(self.parent) - 1


def _name_features(tag: str, attrs: str) -> tuple[int, ...]:
    found = {_TAG_AT[tag]}
    for groups in _NAMES.findall(attrs) if "=" in attrs else ():
        for part in _PARTS.findall(_CAMEL.sub(" ", "".join(groups)).lower()):
            if part in _WHOLE:
                found.add(_STEM_AT[part])
            found.update(_STEM_AT[s] for s in _STEMS if part.startswith(s))
    return tuple(found)


def _ends_of_controls(tokens: list[re.Match]) -> dict[int, int]:
    """Token numbers of start tags of controls, each with that of its end tag; unclosed ones are left out."""
    ends, opened = {}, {tag: [] for tag in (*_CONTROLS, *_NESTED)}
    for number, m in enumerate(tokens):
        tag = (m["tag"] or "").lower()
        if tag not in opened:
            continue
        if m["close"]:
            if opened[tag]:
                ends[opened[tag].pop()] = number
        elif not m["attrs"].endswith("/>"):
            if tag in _CONTROLS:
                opened[tag].clear()
            opened[tag].append(number)
    return ends


def parse(page: str) -> Tree:
    """Lenient parse: implied ends, unclosed and stray tags, and truncated pages are accepted.

    A button, selection, drawing or template is left out up to its end tag; without one, or closed in itself, it only
    parts the texts before and after. A raw element (script, style and the like) without an end tag takes the
    rest of the page, as in browsers.
    """
    tree = Tree()
    root = tree.add(-1, (), None, 0, False)
    stack: list[tuple[str, int, bool]] = [("", root, False)]
    words: list[str] = []
    in_link, linked = False, 0

    def flush() -> None:
        nonlocal linked, in_link
        if words:
            text = " ".join("".join(words).split())
            if text:
                tree.add(stack[-1][1], (), text, min(linked, len(text)), stack[-1][2])
            words.clear()
        linked, in_link = 0, False

    def pop_to(depth: int) -> None:
        flush()
        del stack[depth:]

    def write(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            words.append(text)
            if in_link:
                linked += len(text.strip())

    tokens = list(_TOKEN.finditer(page))
    ends = _ends_of_controls(tokens)
    at, skipped = 0, -1
    for number, m in enumerate(tokens):
        if number <= skipped:
            at = m.end()
            continue
        write(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"] is None and m.group().startswith("<!--"):
                continue
            words.append(" ")
            continue
        tag = tag.lower()
        if tag not in _BLOCK_SET:
            if tag == "a":
                in_link = not m["close"]
            elif tag in ("br", "img", "input", "wbr"):
                words.append(" ")
            elif number in ends:
                skipped = ends[number]
                words.append(" ")
            elif tag in _CONTROLS and not m["close"]:
                flush()
            elif tag in _NESTED:
                words.append(" ")
            continue
        if m["close"]:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag), 0)
            pop_to(depth) if depth else flush()
            continue
        flush()
        if any(s[0] == "p" for s in stack[-1:]):
            stack.pop()
        kinds, borders = _CLOSES.get(tag, ((), ()))
        for depth in range(len(stack) - 1, 0, -1) if kinds else ():
            if stack[depth][0] in borders:
                break
            if stack[depth][0] in kinds:
                del stack[depth:]
                break
        if tag in _VOID:
            continue
        marked = stack[-1][2]
        if "data-label" in m["attrs"]:
            marked = 'data-label="1"' in m["attrs"]
        node = tree.add(stack[-1][1], _name_features(tag, m["attrs"]), None, 0, marked)
        stack.append((tag, node, marked))
    write(page[at:])
    flush()
    return tree


@dataclass
class Forest:
    """Trees of many pages: features, parents, nodes by level, and where each page's nodes start."""

    features: np.ndarray
    parent: np.ndarray
    levels: list[np.ndarray]
    leaf: np.ndarray
    first: np.ndarray


def plant(trees: list[Tree]) -> Forest:
    sizes = np.array([len(t.parent) for t in trees])
    first = np.concatenate([[0], np.cumsum(sizes)])
    parent = np.concatenate([np.array(t.parent) + f for t, f in zip(trees, first)])
    roots = first[:-1]
    parent[roots] = -1
    texts = [x for t in trees for x in t.text]
    leaf = np.array([x is not None for x in texts])
    chars = np.array([len(x) if x else 0 for x in texts], float)
    linked = np.array([x for t in trees for x in t.linked], float)
    count = np.array([x.count(" ") + 1 if x else 0 for x in texts], float)

    depth = np.zeros(len(parent), np.int64)
    levels, level = [roots], roots
    children = np.argsort(parent, kind="stable")
    begin = np.searchsorted(parent[children], np.arange(len(parent)), "left")
    end = np.searchsorted(parent[children], np.arange(len(parent)), "right")
    while True:
        spans = [children[begin[n]:end[n]] for n in level]
        level = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        if not len(level):
            break
        depth[level] = len(levels)
        levels.append(level)

    all_chars, all_linked, all_words = chars.copy(), linked.copy(), count.copy()
    for nodes in levels[:0:-1]:
        for total in (all_chars, all_linked, all_words):
            np.add.at(total, parent[nodes], total[nodes])

    x = np.zeros((len(parent), FEATURES))
    names = [n for t in trees for n in t.names]
    rows = np.repeat(np.arange(len(names)), [len(n) for n in names])
    x[rows, np.array([f for n in names for f in n], np.int64)] = 1
    density = all_linked / np.maximum(all_chars, 1)
    x[:, _LEAF] = leaf
    x[:, _LINKS] = density
    x[:, _SOME_LINKS] = density > 0.5
    x[:, _WORDS] = np.log1p(all_words) / 5
    x[:, _SHORT] = leaf & (count <= 3)
    x[:, _STOP] = [bool(t) and t[-1] in ".!?:;…\"'”" for t in texts]
    x[:, _SIGN] = [bool(t) and _SIGNS.search(t) is not None for t in texts]
    x[:, _FULL] = leaf & (count >= 12)
    x[:, _ONE] = 1
    return Forest(x, parent, levels, leaf, first)


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


@dataclass
class TreeModel:
    """``unary`` weighs features for content; ``edge[leaf?, parent, child]`` are log potentials."""

    unary: np.ndarray
    edge: np.ndarray

    def infer(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of content, and of the four states of every node's edge to its parent."""
        n = len(forest.parent)
        local = np.stack([np.zeros(n), forest.features @ self.unary], axis=1)
        pair = self.edge[forest.leaf.astype(int)]
        upward = np.zeros((n, 2))
        below = local.copy()
        for nodes in forest.levels[:0:-1]:  # leaves to root
            t = pair[nodes] + below[nodes][:, None, :]
            upward[nodes] = _log_sum(t[:, :, 0], t[:, :, 1])
            np.add.at(below, forest.parent[nodes], upward[nodes])
        full, states = below.copy(), np.zeros((n, 2, 2))
        for nodes in forest.levels[1:]:  # root to leaves
            rest = full[forest.parent[nodes]] - upward[nodes]
            t = pair[nodes] + rest[:, :, None]
            full[nodes] += _log_sum(t[:, 0], t[:, 1])
            t = t + below[nodes][:, None, :]
            t -= t.max(axis=(1, 2), keepdims=True)
            t = np.exp(t)
            states[nodes] = t / t.sum(axis=(1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -60, 60))), states


def _labels(trees: list[Tree], forest: Forest) -> np.ndarray:
    """Leaves as marked; an inner node is content if half of the text below it is."""
    chars = np.array([len(x) if x else 0 for t in trees for x in t.text], float)
    good = chars * np.array([m for t in trees for m in t.marked])
    marked = np.array([m for t in trees for m in t.marked])
    for nodes in forest.levels[:0:-1]:
        np.add.at(chars, forest.parent[nodes], chars[nodes])
        np.add.at(good, forest.parent[nodes], good[nodes])
    return np.where(forest.leaf, marked, (2 * good >= chars) & (chars > 0)).astype(float)


def fit(pages: list[str]) -> TreeModel:
    """Maximum likelihood on labelled pages (content is inside ``data-label="1"``), by Adam."""
    trees = [parse(p) for p in pages]
    forest = plant(trees)
    y = _labels(trees, forest)
    child = np.flatnonzero(forest.parent >= 0)
    kind, up, down = forest.leaf[child].astype(int), y[forest.parent[child]].astype(int), y[child].astype(int)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind, up, down), 1)
    model = TreeModel(np.zeros(FEATURES), np.zeros((2, 2, 2)))
    moments = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((2, 2, 2)), np.zeros((2, 2, 2))]
    for step in range(1, EPOCHS + 1):
        marginal, states = model.infer(forest)
        expected = np.stack([states[child][kind == k].sum(axis=0) for k in (0, 1)])
        gradients = (forest.features.T @ (y - marginal) / len(pages) - DECAY * model.unary,
                     (seen - expected) / len(pages) - DECAY * model.edge)
        for i, (weights, g) in enumerate(zip((model.unary, model.edge), gradients)):
            moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * g
            moments[2 * i + 1] = 0.99 * moments[2 * i + 1] + 0.01 * g * g
            weights += RATE * (moments[2 * i] / (1 - 0.9**step)) / (np.sqrt(moments[2 * i + 1] / (1 - 0.99**step)) + 1e-8)
    return model


def train(count: int = TRAIN_PAGES) -> TreeModel:
    return fit(labelled_pages(count))


def main_texts(pages: list[str | None], model: TreeModel) -> list[str]:
    """Content leaves of every page, in page order, joined by empty lines."""
    if not pages:
        return []
    trees = [parse(p or "") for p in pages]
    forest = plant(trees)
    marginal, _ = model.infer(forest)
    return ["\n\n".join(t for t, m in zip(tree.text, marginal[first:]) if t is not None and m >= 0.5)
            for tree, first in zip(trees, forest.first)]


_GROUP = 64  # pages of one inference


def _extract(model: TreeModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, texts = batch["html"].to_pylist(), []
            for at in range(0, len(pages), _GROUP):
                texts += main_texts(pages[at:at + _GROUP], model)
            yield pa.record_batch(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages (page_id, url, html)``.

    A null or empty html gives an empty text, an empty table an empty result. Rows are extracted one by one, so
    repeated rows give repeated results; other columns are ignored. A page is parsed in one scan, so time and memory
    grow in proportion to its length.
    """
    bound_batches(pages.sparkSession)
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(_extract(model or train()), "page_id long, url string, text string, n_chars long")
