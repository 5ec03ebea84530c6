"""Main text of web pages by gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of elements, with each run of text between block boundaries as a leaf. Every node
has features of its subtree (text, link and tag density, depth), its tag, the tokens of its attributes
and of its ancestors', and its siblings. Boosted trees, trained here on pages written by html_pages.py
whose main text is known, give the log odds that a node holds main text. The best labelling under the
rule that nothing below a dropped node is kept follows from one pass up and one down, so ancestors and
descendants cannot contradict each other. Scripts, styles and the head are markup and never enter.

The text of a kept leaf has character references decoded, runs of white space as one space and no
spaces at its ends; leaves are joined in page order by one line feed, empty ones left out.

Defined cases: null or empty html, or html without main text, gives an empty text; unclosed and stray tags
are repaired in the manner of browsers; depth is not limited by the stack; repeated rows are extracted
one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.html_pages import training_pages

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Whole subtrees that are scripts, styles, markup or form controls; math, objects and the like may be part of an article.
RAW = frozenset("script style template iframe head textarea select title".split())
INLINE = frozenset("math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup mover munder munderover semantics object canvas noscript svg g text tspan a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",), "option": ("select",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "thead": ("tbody", "tr"), "tfoot": ("tbody", "tr", "td", "th")}
TAGS = ("article main", "nav menu", "header", "footer", "aside", "form fieldset", "p", "div", "section", "ul ol dl", "li dt dd", "h1 h2 h3 h4 h5 h6", "a", "table tbody thead tr td th", "figure figcaption", "body html", "blockquote pre", "button input label")
WORDS = (
    "article content contents main post entry story prose text hentry",
    "nav menu menus navbar navigation breadcrumb breadcrumbs topnav pagination pager toc skip",
    "header masthead topbar brand branding logo banner sitehead hdr",
    "footer foot copyright legal colophon contentinfo bottom ftr",
    "sidebar side aside related recommended widget widgets rail popular trending complementary more teaser",
    "ad ads adv advert adverts advertisement adbox adslot sponsor sponsored promo promotion commercial dfp",
    "comment comments respond reply replies disqus discussion reader readers responses thread feedback",
    "notice cookie cookies consent gdpr alert popup modal newsletter paywall overlay toast message warning privacy",
    "form search login signup subscribe contact input register signin",
    "share sharing social follow tweet like",
)
_TAG = {t: i for i, ts in enumerate(TAGS) for t in ts.split()}
_WORD = {w: i for i, ws in enumerate(WORDS) for w in ws.split()}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])")
_HEAD = re.compile(r"</head\s*>|(?=<body[\s>])", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?]")


class Tree:
    """Nodes in page order, so a parent comes before its children. text: of leaves, else None."""

    def __init__(self):
        self.parent, self.tag, self.text, self.groups, self.label = [-1], ["html"], [None], [0], [None]

    def add(self, parent: int, tag: str, text: str | None, groups: int, label: bool | None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.text.append(text)
        self.groups.append(groups)
        self.label.append(label)
        return len(self.parent) - 1


def _attributes(source: str) -> tuple[int, bool]:
    groups, hidden = 0, False
    for name, *values in _ATTR.findall(source):
        value = "".join(values)
        if name.lower() == "hidden" or name.lower() == "style":
            hidden = hidden or name.lower() == "hidden" or "display:none" in value.replace(" ", "").lower()
            continue
        for w in _SPLIT.split(_CAMEL.sub("-", value).lower()):
            if w in _WORD:
                groups |= 1 << _WORD[w]
    return groups, hidden


def tags(source: str):
    """(start, end, name, rest) of each tag, name "" for comments and declarations; time is in proportion to the length.

    A tag ends at the first > outside quotes. Where quotes or the tag stay open, it ends at the first >, and so do those
    that begin before the place where that was found out; without any > the rest is text.
    """
    at, careless = source.find("<"), -1
    while at >= 0:
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(source)
            yield at, end, "", ""
        elif source.startswith(("<!", "<?"), at):
            end = source.find(">", at) + 1 or len(source)
            yield at, end, "", ""
        elif name := _NAME.match(source, at):
            end = at
            if at >= careless:
                end = _REST.match(source, name.end()).end()
                if not source.startswith(">", end):
                    careless = end
            if at < careless and (end := source.find(">", name.end())) < 0:
                return
            end += 1
            yield at, end, ("/" if source[at + 1] == "/" else "") + name[1].lower(), source[name.end() : end - 1]
        else:
            end = at + 1
        at = source.find("<", end)


class Stack:
    """The open elements. Where each tag stands is known, so that closing one needs no search."""

    BARS = frozenset(("p", "td", "th", "li", "div", "article", "section"))

    def __init__(self):
        self.open, self.at, self.bars = [(0, "html", False)], {"html": [0]}, []

    def push(self, node: int, tag: str, main: bool) -> None:
        if tag in self.BARS:
            self.bars.append(len(self.open))
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((node, tag, main))

    def cut(self, k: int) -> None:
        for _, tag, _ in self.open[k:]:
            self.at[tag].pop()
        del self.open[k:]
        while self.bars and self.bars[-1] >= k:
            self.bars.pop()

    def last(self, *tags: str) -> int:
        """The place of the innermost of these, or 0."""
        return max(at[-1] if (at := self.at.get(t)) else 0 for t in tags)

    def ended_by(self, tag: str) -> int:
        """The outermost element that the start of this one ends, or 0."""
        outer, out = self.last(*SAME[tag]), 0
        for t in ENDS[tag]:
            at = self.at.get(t, ())
            k = bisect.bisect_right(at, outer)
            if k < len(at):
                out = min(out or at[k], at[k])
        return out


def parse(source: str) -> tuple[Tree, list[tuple[int, int]]]:
    """The tree, and for each leaf how many characters of it are inside links. data-main="1" labels a subtree."""
    tree, stack, links = Tree(), Stack(), []
    buffer: list[str] = []
    linked, at, a_open, headless = 0, 0, False, False

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                links.append((tree.add(stack.open[-1][0], "#text", text, 0, stack.open[-1][2]), linked))
            buffer.clear()
        linked = 0

    def close(k: int) -> None:
        flush()
        stack.cut(k)

    for start, stop, tag, rest in tags(source):
        if start < at:
            continue
        if start > at:
            buffer.append(source[at:start])
            linked += (start - at) * a_open
        at = stop
        ending, tag, single = tag.startswith("/"), tag.lstrip("/"), rest.endswith("/")
        if tag in RAW:
            if not ending and not single and not (tag == "head" and headless):
                end = (_HEAD if tag == "head" else re.compile(rf"</{tag}\s*>", re.I)).search(source, at)
                headless = tag == "head" and end is None
                at = end.end() if end else at if headless else len(source)
        elif tag == "br":
            buffer.append(" ")
        elif tag == "a":
            a_open = not ending
        elif not tag or tag in INLINE:
            pass
        elif ending:
            if k := stack.last(tag):
                close(k)
                a_open = False
            elif tag in CLOSES_P:
                flush()
        elif tag in ("html", "body"):
            flush()
            if tag == "body" and len(stack.open) == 1:
                stack.push(tree.add(0, "body", None, _attributes(rest)[0], None), "body", False)
        else:
            if tag in CLOSES_P:
                if stack.bars and stack.open[stack.bars[-1]][1] == "p":
                    close(stack.bars[-1])
            elif tag in SAME and (k := stack.ended_by(tag)):
                close(k)
            flush()
            a_open = False
            if tag in VOID:
                continue
            groups, hidden = _attributes(rest)
            node = tree.add(stack.open[-1][0], tag, None, groups | hidden << len(WORDS), None)
            if not single:
                stack.push(node, tag, 'data-main="0"' not in rest and (stack.open[-1][2] or 'data-main="1"' in rest))
    buffer.append(source[at:])
    flush()
    return tree, links


N_WORDS = len(WORDS) + 1
N_FEATURES = 2 * N_WORDS + 2 * (len(TAGS) + 1) + 16


def features(tree: Tree, links: list[tuple[int, int]]) -> np.ndarray:
    n = len(tree.parent)
    parent = np.array(tree.parent)
    size, link, blocks, marks, words, below = (np.zeros(n) for _ in range(6))
    for i, linked in links:
        t = tree.text[i]
        size[i], link[i], blocks[i], marks[i], words[i] = len(t), min(linked, len(t)), 1, len(_PUNCTUATION.findall(t)), t.count(" ") + 1
    depth, inherited, tags_above = np.zeros(n), list(tree.groups), [0] * n
    kids, place = np.zeros(n), np.zeros(n)
    before, after, last = np.zeros(n), np.zeros(n), [-1] * n
    tag = [_TAG.get(t, len(TAGS)) for t in tree.tag]
    for i in range(1, n):
        p = tree.parent[i]
        depth[i] = depth[p] + 1
        inherited[i] |= inherited[p]
        tags_above[i] = tags_above[p] | 1 << tag[p]
        place[i] = kids[p]
        kids[p] += 1
    own = np.stack([size, link, blocks, marks, words], axis=1)
    rows = own.tolist()
    for i in range(n - 1, 0, -1):
        p, r = tree.parent[i], rows[i]
        q = rows[p]
        q[0] += r[0]
        q[1] += r[1]
        q[2] += r[2]
        q[3] += r[3]
        q[4] += r[4]
        below[p] += below[i] + 1
    own = np.array(rows)
    for i in range(1, n):
        p = tree.parent[i]
        if last[p] >= 0:
            before[i], after[last[p]] = own[last[p], 0], own[i, 0]
        last[p] = i
    size, link, blocks, marks, words = own.T
    up = np.maximum(parent, 0)
    bits = lambda masks, k: (np.array(masks, np.int64)[:, None] >> np.arange(k)) & 1
    log = np.log1p
    numbers = np.stack([
        depth, log(size), link / np.maximum(size, 1), log(below), size / (below + 1), log(blocks), size / np.maximum(blocks, 1), marks / np.maximum(size, 1) * 100,
        words / np.maximum(blocks, 1), place, kids[up], size / np.maximum(size[up], 1), size / max(1.0, size[0]), log(before), log(after), np.array([t is not None for t in tree.text], float),
    ], axis=1)
    one = np.zeros((n, len(TAGS) + 1))
    one[np.arange(n), tag] = 1
    return np.concatenate([numbers, one, bits(tags_above, len(TAGS) + 1), bits(tree.groups, N_WORDS), bits(inherited, N_WORDS)], axis=1).astype(np.float32)


# Boosted trees

TREES, DEPTH, RATE, BINS, LEAST = 60, 5, 0.25, 32, 8


class Boosted:
    """Trees of log odds, grown level by level on histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH):
        self.depth, self.edges = depth, [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        b = self._bins(x)
        n, m = x.shape
        self.start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score = np.full(n, self.start)
        flat = b.astype(np.int64) + np.arange(m) * BINS
        self.feature, self.cut, self.leaf = (np.zeros((trees, 1 << depth), k) for k in (np.int64, np.int64, float))
        for t in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            at = np.zeros(n, np.int64)
            for d in range(depth):
                k = 1 << d
                key = (at[:, None] * (m * BINS) + flat).ravel()
                gs, hs, ns = (np.cumsum(np.bincount(key, np.repeat(v, m), k * m * BINS).reshape(k, m, BINS), axis=2) for v in (g, h, np.ones(n)))
                gt, ht, nt = gs[..., -1:], hs[..., -1:], ns[..., -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(ns < LEAST) | (nt - ns < LEAST)] = 0
                best = gain.reshape(k, -1).argmax(axis=1)
                f, c = best // BINS, best % BINS
                c[gain.reshape(k, -1)[np.arange(k), best] <= 1e-9] = BINS  # all go left
                self.feature[t, k - 1 : 2 * k - 1], self.cut[t, k - 1 : 2 * k - 1] = f, c
                at = 2 * at + (b[np.arange(n), f[at]] > c[at])
            gs, hs = (np.bincount(at, v, 1 << depth) for v in (g, h))
            self.leaf[t] = RATE * gs / (hs + 1)
            score += self.leaf[t][at]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c) for e, c in zip(self.edges, x.T, strict=True)], axis=1).astype(np.uint8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b, rows = self._bins(x), np.arange(len(x))
        out = np.full(len(x), self.start)
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for d in range(self.depth):
                i = at + (1 << d) - 1
                at = 2 * at + (b[rows, f[i]] > c[i])
            out += leaf[at]
        return out


def decode(parent: list[int], log_odds: np.ndarray) -> list[bool]:
    """The likeliest labels in which a kept node's ancestors are kept. The root is."""
    odds = log_odds.tolist()
    keep, gain = [max(0.0, x) - max(0.0, -x) for x in odds], [0.0] * len(odds)
    # Keeping a node gains its log odds over dropping it, and lets each child gain if it can.
    for i in range(len(odds) - 1, -1, -1):
        keep[i] = odds[i] + gain[i]
        if i and keep[i] > 0:
            gain[parent[i]] += keep[i]
    out = [True] * len(odds)
    for i in range(1, len(odds)):
        out[i] = out[parent[i]] and keep[i] > 0
    return out


def labels(tree: Tree) -> np.ndarray:
    """A leaf's own; another node holds main text if anything below does."""
    y = [bool(x) for x in tree.label]
    for i in range(len(y) - 1, 0, -1):
        y[tree.parent[i]] = y[tree.parent[i]] or y[i]
    return np.array(y, float)


@cache
def model(pages: int = 500, seed: int = 1) -> Boosted:
    """Trained on pages written here; the same for the same arguments."""
    x, y = [], []
    for source in training_pages(pages, seed):
        tree, links = parse(source)
        x.append(features(tree, links)[1:])
        y.append(labels(tree)[1:])
    return Boosted(np.concatenate(x), np.concatenate(y))


def extract(sources: list[str | None], trees: Boosted) -> list[str]:
    parsed = [parse(s or "") for s in sources]
    sizes = [len(t.parent) for t, _ in parsed]
    if not sources:
        return []
    odds = trees.log_odds(np.concatenate([features(t, links) for t, links in parsed]))
    out, at = [], 0
    for (tree, links), n in zip(parsed, sizes, strict=True):
        kept = decode(tree.parent, odds[at : at + n])
        out.append("\n".join(tree.text[i] for i, _ in links if kept[i]))
        at += n
    return out


_BATCH = 200


def extract_pages(pages: DataFrame, trees: Boosted | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""
    held, kind = pages.sparkSession.sparkContext.broadcast(trees or model()), dict(pages.dtypes)["page_id"]

    def apply(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                b = batch.slice(at, _BATCH)
                texts = extract(b.column("html").to_pylist(), held.value)
                yield pa.record_batch({"page_id": b.column("page_id"), "url": b.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    return pages.select("page_id", "url", "html").mapInArrow(apply, f"page_id {kind}, url string, text string, n_chars long")
