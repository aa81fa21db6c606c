"""Main-text extraction by gradient-boosted trees over DOM nodes, with hierarchical decoding.

Every block node and run of text gets features: its tag, depth and attribute tokens, those of its ancestors, the
density of text and links in its subtree, and how it stands among its siblings. Two models tell whether a node holds any
main text, and whether it then holds nothing else. Decoding gives each node one of three states, *boilerplate*,
*main* or *mixed*, at the largest total likelihood under the rule that all below a boilerplate node is boilerplate and
all below a main node is main. Runs of one block are one piece of text: they are all kept, or none, as most of its
characters are.

The models are trained here, on pages of many layouts from :mod:`cairn.llm.html_pages`, whose main text is known.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import boosting
from cairn.llm.html_dom import INLINE, Node, parse
from cairn.llm.memory import lean, small_batches

TAGS = (
    ("#text",), ("div",), ("section",), ("article",), ("main",), ("p",), ("h1", "h2", "h3"), ("h4", "h5", "h6"), ("ul", "ol", "menu", "dir"),
    ("li",), ("dl", "dt", "dd"), ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("blockquote", "pre"), ("figure", "figcaption"),
    ("nav",), ("header", "hgroup"), ("footer",), ("aside",), ("form", "fieldset", "legend"), ("dialog", "details", "summary", "address"),
    ("body", "html", "#root"),
)
TAG_GROUP = {tag: k for k, group in enumerate(TAGS) for tag in group}
#: Attribute tokens that say what a node is for.
TOKENS = (
    ("article", "content", "main", "post", "entry", "story", "text", "articlebody", "body", "prose", "page"),
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toc", "tabs", "pagination", "pager", "topbar", "skip"),
    ("header", "head", "masthead", "banner", "logo", "brand", "tagline", "site"),
    ("footer", "foot", "copyright", "colophon", "legal", "contentinfo", "bottom"),
    ("sidebar", "side", "aside", "widget", "widgets", "complementary", "rail", "column"),
    ("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adsbox", "banner", "dfp"),
    ("cookie", "cookies", "consent", "notice", "gdpr", "alert", "modal", "popup", "overlay", "dialog", "warning", "paywall", "message"),
    ("comment", "comments", "commentlist", "reply", "replies", "disqus", "respond", "discussion", "reader"),
    ("form", "search", "login", "signup", "subscribe", "newsletter", "input", "contact", "register"),
    ("share", "social", "related", "recommended", "popular", "trending", "more", "tags", "teaser", "follow", "latest"),
    ("meta", "byline", "author", "date", "info", "time", "published"),
)
TOKEN_GROUP: dict[str, list[int]] = {}
for _k, _group in enumerate(TOKENS):
    for _token in _group:
        TOKEN_GROUP.setdefault(_token, []).append(_k)
MARKS = re.compile(r"[.,;:!?]")
SPACE = re.compile(r"\s+")
T, K = len(TAGS), len(TOKENS)
WIDTH = T + 1 + 2 * K + T + 20
BOILERPLATE, MAIN, MIXED = 0, 1, 2
ROWS = 64


def node_features(nodes: list[Node]) -> np.ndarray:
    """A row of features for each node. Nodes come in page order, so that a subtree is a range of them."""
    n = len(nodes)
    parent = np.array([node.parent for node in nodes])
    own = np.zeros((n, 9))  # chars, linked, marks, words, runs, tags, paragraphs, items, inputs
    longest, until = [0] * n, list(range(1, n + 1))
    flags, kinds, above_flags, above_kinds = [0] * n, [0] * n, [0] * n, [0] * n
    place, seen, hidden, codes = [0] * n, [0] * n, [0.0] * n, {}
    code = np.zeros(n, np.int64)
    for i, node in enumerate(nodes):
        up = node.parent
        if node.tag == "#text":
            text = SPACE.sub(" ", node.text).strip()
            longest[i] = len(text)
            own[i] = len(text), node.linked, len(MARKS.findall(text)), text.count(" ") + 1, 1, 0, 0, 0, node.inputs
        else:
            own[i, 5:] = 1, node.tag == "p", node.tag == "li", node.inputs
        kinds[i] = 1 << TAG_GROUP.get(node.tag, T)
        for token in node.tokens:
            for k in TOKEN_GROUP.get(token, ()):
                flags[i] |= 1 << k
        hidden[i] = float(node.hidden)
        code[i] = codes.setdefault(node.tag, len(codes))
        if i:
            above_flags[i], above_kinds[i] = above_flags[up] | flags[up], above_kinds[up] | kinds[up]
            hidden[i] = max(hidden[i], hidden[up])
            place[i] = seen[up]
            seen[up] += 1
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        if until[i] > until[up]:
            until[up] = until[i]
        if longest[i] > longest[up]:
            longest[up] = longest[i]
    before = np.concatenate([np.zeros((1, 9)), own.cumsum(axis=0)])
    start = before[:-1, 0]
    chars, linked, marks, words, runs, tags, paragraphs, items, inputs = (before[until] - before[:-1]).T
    siblings, same, around, share = np.ones((4, n))
    around[:] = 0
    if n > 1:
        up = parent[1:]
        number = np.bincount(up, minlength=n).astype(float)
        whole_of = np.bincount(up, chars[1:], n)
        siblings[1:] = number[up]
        same[1:] = _sizes(up * len(codes) + code[1:])
        around[1:] = (whole_of[up] - chars[1:]) / np.maximum(1, number[up] - 1)
        share[1:] = chars[1:] / np.maximum(whole_of[up], 1)
    out = np.zeros((n, WIDTH), np.float64)
    out[:, : T + 1] = _bits(kinds, T + 1)
    out[:, T + 1 : T + 1 + K] = _bits(flags, K)
    out[:, T + 1 + K : T + 1 + 2 * K] = _bits(above_flags, K)
    out[:, T + 1 + 2 * K : 2 * T + 1 + 2 * K] = _bits(above_kinds, T)
    rest = out[:, 2 * T + 1 + 2 * K :]
    whole, some = max(chars[0], 1.0), np.maximum(chars, 1)
    rest[:, 0] = [node.depth for node in nodes]
    rest[:, 1] = np.log1p(chars)
    rest[:, 2] = linked / some
    rest[:, 3] = np.log1p(tags)
    rest[:, 4] = chars / (tags + 1)
    rest[:, 5] = 100 * marks / some
    rest[:, 6] = np.log1p(words / np.maximum(runs, 1))
    rest[:, 7] = np.log1p(paragraphs)
    rest[:, 8] = items / (tags + 1)
    rest[:, 9] = np.log1p(inputs)
    rest[:, 10] = np.log1p(siblings)
    rest[:, 11] = place / siblings
    rest[:, 12] = np.log1p(same)
    rest[:, 13] = np.log1p(around)
    rest[:, 14] = share
    rest[:, 15] = start / whole
    rest[:, 16] = chars / whole
    rest[:, 17] = np.log1p(longest)
    rest[:, 18] = hidden
    rest[1:, 19] = rest[parent[1:], 2]
    return out


def _bits(numbers: list[int], width: int) -> np.ndarray:
    return (np.array(numbers, np.int64)[:, None] >> np.arange(width)) & 1


def _sizes(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs."""
    _, at, number = np.unique(keys, return_inverse=True, return_counts=True)
    return number[at]


Models = tuple[boosting.Trees, boosting.Trees]


@lru_cache(maxsize=2)
def trained(pages: int = 800, seed: int = 20) -> Models:
    """The two models, fitted to ``pages`` generated pages."""
    from cairn.llm.html_pages import labelled_pages

    rows, any_main, all_main, size = [], [], [], []
    for source, is_main in labelled_pages(pages, seed):
        nodes = parse(source)
        kept = {node.block for node in nodes if node.tag == "#text" and is_main(node.text)}
        main, chars = np.zeros(len(nodes)), np.zeros(len(nodes))
        for i in range(len(nodes) - 1, -1, -1):
            if nodes[i].tag == "#text":
                chars[i] = max(1, len(nodes[i].text.strip()))
                main[i] = chars[i] * (nodes[i].block in kept)
            if i:
                main[nodes[i].parent] += main[i]
                chars[nodes[i].parent] += chars[i]
        keep = chars > 0
        rows.append(node_features(nodes)[keep])
        any_main.append((main > 0)[keep])
        all_main.append((main == chars)[keep])
        size.append(keep.sum())
    x, some, whole = np.concatenate(rows), np.concatenate(any_main), np.concatenate(all_main)
    weight = np.repeat(1 / np.array(size), size) * len(x) / len(size)
    return boosting.fit(x, some.astype(float), weight), boosting.fit(x[some], whole[some].astype(float), weight[some])


def decode(nodes: list[Node], some: np.ndarray, pure: np.ndarray) -> np.ndarray:
    """The likeliest consistent state of each node. Runs of text and nodes without text are never mixed."""
    some, pure = np.clip(some, 1e-6, 1 - 1e-6), np.clip(pure, 1e-6, 1 - 1e-6)
    own = np.stack([np.log(1 - some), np.log(some * pure), np.log(some * (1 - pure))], axis=1)
    filled = np.array([node.tag == "#text" for node in nodes])
    total = np.zeros_like(own)
    below = np.zeros_like(own)
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i].tag == "#text":
            total[i] = own[i, 0], np.log(some[i]), -np.inf
        elif filled[i]:
            total[i] = own[i] + below[i]
        if i:
            up = nodes[i].parent
            filled[up] |= filled[i]
            below[up, :2] += total[i, :2]
            below[up, 2] += total[i].max()
    state = np.zeros(len(nodes), np.int64)
    for i, node in enumerate(nodes):
        above = state[node.parent] if i else MIXED
        state[i] = int(total[i].argmax()) if above == MIXED else above
    return state


def blocks(nodes: list[Node], state: np.ndarray) -> list[str]:
    """Texts of the blocks whose characters are main for the most part, in page order; white space inside is one space.

    Of a block that is kept only hidden runs that aren't main themselves are left out.
    """
    runs = [(i, node) for i, node in enumerate(nodes) if node.tag == "#text"]
    balance: dict[int, int] = {}
    for i, node in runs:
        n = max(1, len(node.text.strip()))
        balance[node.block] = balance.get(node.block, 0) + (n if state[i] == MAIN else -n)
    held: dict[int, list[str]] = {}
    for i, node in runs:
        if balance[node.block] >= 0 and (state[i] == MAIN or not _hidden(nodes, node)):
            held.setdefault(node.block, []).append(node.text)
    found = (SPACE.sub(" ", "".join(texts)).strip() for texts in held.values())
    return [text for text in found if text]


def _hidden(nodes: list[Node], run: Node) -> bool:
    """Whether an inline element around a run is hidden."""
    up = run.parent
    while nodes[up].tag in INLINE:
        if nodes[up].hidden:
            return True
        up = nodes[up].parent
    return False


def extract_many(sources: list[str], models: Models) -> list[list[str]]:
    pages = [parse(source) for source in sources]
    x = np.concatenate([node_features(nodes) for nodes in pages])
    some, pure = (model.probability(x) for model in models)
    out, at = [], 0
    for nodes in pages:
        part = slice(at, at + len(nodes))
        out.append(blocks(nodes, decode(nodes, some[part], pure[part])))
        at += len(nodes)
    return out


def _extract(models: Models, kept: list[str]):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                found = extract_many([s or "" for s in part["source"].to_pylist()], models)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), pa.array(found, pa.list_(pa.string()))], names=[*kept, "found"])

    return run


def extract(pages: DataFrame, *, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), models: Models | None = None) -> DataFrame:
    """One row per row of ``pages``: the columns ``keep``, ``blocks`` (main text by block) and ``text`` (joined by two line feeds).

    The whole source is read; a null one is empty, and an empty one or one without main text gives no blocks and an
    empty text. Character references are decoded once. Repeated rows are extracted each, an empty table gives an empty
    result, other columns are ignored.
    """
    small_batches(pages.sparkSession)
    base = pages.select(*[pages[c].alias(f"k{i}") for i, c in enumerate(keep)], pages[html_col].alias("source"))
    kept = base.columns[:-1]
    shape = base.drop("source").withColumn("found", F.array(F.lit(""))).schema
    found = base.mapInArrow(_extract(models or trained(), kept), shape)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("found").alias("blocks"), F.array_join("found", "\n\n").alias("text"))
