"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every page becomes a tree of elements and texts. Boosted trees score each node from the
density of its subtree, its attribute tokens, its depth and its siblings. Hierarchical
decoding then picks the set of nodes with the largest summed log odds among all sets that
hold the parent of each of their nodes, so nothing is kept below something dropped. Kept
texts are joined by block elements.

The trees are fitted on a bounded sample: about ``TRAIN_PAGES`` pages, chosen by a hash of the
page among those that mark their article up by element (``article``, ``main``). The
sample teaches by its own markup and by copies in which the telling elements are replaced by
``div`` with usual class names and usual furniture (notices, comments, forms, side bars,
made of the page's own texts) is added, so the scores do not depend on the element names.
Everything else runs over whole pages in one pass without a shuffle.

Defined cases: null, empty and text-only pages work like any page (no text gives an empty
string); markup that is cut off, unclosed or misnested is closed as browsers do it for
paragraphs, list items and table cells; of the elements that are dropped whole (drawings,
frames, objects, templates and the like) one that is never closed, or closed in its own tag,
holds nothing, so no text after it is lost; very long pages are read whole; equal pages get equal texts; an empty table gives
an empty result; without any page to learn from, a fixed rule on links and element names
takes the place of the trees; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edops.llm.common import arrow_rows, unit_draw
from edops.llm.words import slices
from edops.session import stage

TRAIN_PAGES = 300
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 32

# Names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style".split())  # text up to the close tag, or to the end of the page
_DROPPED = frozenset("template noscript iframe svg textarea select object canvas title head".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split()
)
_CLOSES_ITSELF = {"li": ("ul", "ol"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table", "tbody"), "option": ("select",)}
_GROUPS = [
    ("#text",), ("p", "blockquote", "pre"), ("h1", "h2", "h3", "h4", "h5", "h6"), ("li", "ul", "ol", "dl", "dt", "dd"),
    ("a",), ("div", "section", "span"), ("article", "main"), ("nav", "menu"), ("aside",), ("footer",), ("header",),
    ("form", "button", "input", "label", "fieldset"), ("table", "tr", "td", "th", "tbody"), ("html", "body"),
]
_GROUP = {name: i for i, names in enumerate(_GROUPS) for name in names}
# Usual tokens of class, id and role attributes.
_GOOD = frozenset("article content main post entry story body text articlebody maincontent".split())
_BAD = frozenset(
    "nav menu navbar navigation breadcrumb footer foot copyright header masthead sidebar side aside widget ad ads advert "
    "advertisement banner sponsored promo cookie notice consent popup modal comment comments reply discussion respond "
    "share social related recommended newsletter subscribe signup login form search pagination pager tags skip".split()
)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


_DROPPED_TAG = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1[^>]*>|\Z)|<(/?)({"|".join(sorted(_DROPPED))})\b((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>""",
    re.S | re.I,
)


def dropped_ranges(source: str) -> dict[int, int]:
    """End of each dropped element that is closed, by the end of its open tag.

    A close tag belongs to the last open one of its name; an element without one, or closed
    in its own tag, holds nothing.
    """
    opened: dict[str, list[int]] = {}
    ranges = {}
    for found in _DROPPED_TAG.finditer(source):
        if not found[3]:
            continue
        waiting = opened.setdefault(found[3].lower(), [])
        if not found[2]:
            if not found[4].endswith("/"):
                waiting.append(found.end())
        elif waiting:
            ranges[waiting.pop()] = found.end()
    return ranges


@dataclass
class Nodes:
    """Nodes of one or more pages in document order; a parent stands before its children."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    good: list[int] = field(default_factory=list)
    bad: list[int] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    page: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, page: int, attributes: str = "", text: str | None = None) -> int:
        tokens = set()
        if attributes:
            for match in _ATTRIBUTE.finditer(attributes):
                tokens.update(_WORD.findall((match[2] or match[3] or match[4] or "").lower()))
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.good.append(len(tokens & _GOOD))
        self.bad.append(len(tokens & _BAD))
        self.text.append(text)
        self.page.append(page)
        return len(self.tag) - 1


_CLOSE = {tag: re.compile(f"</{tag}[^>]*>", re.I) for tag in _RAW}
_HEAD_END = re.compile(r"</head\b|<body\b", re.I)


def parse(source: str, nodes: Nodes, page: int) -> None:
    """Append the tree of one page."""
    root = nodes.add("html", -1, page)
    stack, at, end, ranges = [root], 0, len(source), None
    while at < end:
        found = _TOKEN.search(source, at)
        start = found.start() if found else end
        if start > at and nodes.tag[stack[-1]] != "option":  # what a form offers is no text
            nodes.add("#text", stack[-1], page, text=html.unescape(source[at:start]))
        if not found:
            break
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1):
                if nodes.tag[stack[i]] == tag:
                    del stack[i:]
                    break
        elif tag in _RAW:
            close = _CLOSE[tag].search(source, at)
            at = close.end() if close else end
        elif tag in _DROPPED:
            ranges = dropped_ranges(source) if ranges is None else ranges
            if at in ranges:
                at = ranges[at]
            elif tag in ("head", "title") and not found[3].endswith("/"):
                # Never closed: it ends with the head, or where the body starts.
                close = _HEAD_END.search(source, at)
                at = close.start() if close else at
        elif tag in ("html", "body") and len(stack) == 1:
            if tag == "body":
                stack.append(nodes.add(tag, stack[-1], page, found[3]))
        else:
            if tag not in _INLINE:  # a block closes an open paragraph and what is open in it
                for i in range(len(stack) - 1, 0, -1):
                    if nodes.tag[stack[i]] == "p":
                        del stack[i:]
                        break
                    if nodes.tag[stack[i]] not in _INLINE:
                        break
            if tag in _CLOSES_ITSELF:
                for i in range(len(stack) - 1, 0, -1):
                    if nodes.tag[stack[i]] == tag:
                        del stack[i:]
                        break
                    if nodes.tag[stack[i]] in _CLOSES_ITSELF[tag]:
                        break
            node = nodes.add(tag, stack[-1], page, found[3])
            if tag not in _VOID and not found[3].endswith("/"):
                stack.append(node)


_MARKS = re.compile(r"[.,;:!?]")


def features(nodes: Nodes) -> np.ndarray:
    """(nodes, features) over whole batches: own, subtree, sibling and ancestor measures."""
    n = len(nodes.tag)
    parent, depth, page = np.array(nodes.parent), np.array(nodes.depth), np.array(nodes.page)
    group = np.array([_GROUP.get(t, len(_GROUPS)) for t in nodes.tag])
    texts = [" ".join(t.split()) if t else "" for t in nodes.text]
    chars = np.array([len(t) for t in texts], float)
    words = np.array([t.count(" ") + 1 if t else 0 for t in texts], float)
    marks = np.array([len(_MARKS.findall(t)) if t else 0 for t in texts], float)
    linked = np.zeros(n, bool)
    good, bad = np.array(nodes.good, float), np.array(nodes.bad, float)
    good_above, bad_above = good.copy(), bad.copy()
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
    link = group == _GROUP["a"]
    for level in levels[1:]:
        up = parent[level]
        linked[level] = linked[up] | link[up]
        good_above[level] += good_above[up]
        bad_above[level] += bad_above[up]
    sums = np.stack([chars, words, marks, chars * linked, np.ones(n), (chars > 0).astype(float)], axis=1)
    for level in reversed(levels[1:]):
        np.add.at(sums, parent[level], sums[level])
    whole = sums[np.flatnonzero(parent < 0), 0]
    total = np.maximum(whole[page - page.min(initial=0)] if n else whole, 1)
    # Siblings in order: children of one parent stand next to each other.
    order = np.lexsort((np.arange(n), parent, page))
    same_left = np.zeros(n, bool)
    same_left[1:] = (parent[order][1:] == parent[order][:-1]) & (page[order][1:] == page[order][:-1])
    first = np.maximum.accumulate(np.where(same_left, 0, np.arange(n)))
    brothers = np.bincount(first, minlength=n)[first] if n else first
    before, after, turn, many = (np.zeros(n) for _ in range(4))
    held = sums[order, 0]
    before[order[1:]] = np.where(same_left[1:], held[:-1], 0)
    after[order[:-1]] = np.where(same_left[1:], held[1:], 0)
    turn[order], many[order] = np.arange(n) - first, brothers
    key = first * (len(_GROUPS) + 1) + group[order]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    alike = np.zeros(n)
    alike[order] = count[back] / np.maximum(brothers, 1)
    passed = np.concatenate([[0], np.cumsum(chars)])[:-1]
    opened = passed[np.searchsorted(page, page)] if n else passed
    safe = np.maximum(sums[:, 0], 1)
    up_group = np.where(parent >= 0, group[parent], -1)
    one_hot = (group[:, None] == np.arange(len(_GROUPS))[None, :]).astype(float)
    rest = np.stack(
        [
            depth, np.log1p(sums[:, 0]), np.log1p(sums[:, 1]), sums[:, 2] / safe, sums[:, 3] / safe, sums[:, 4] / safe,
            np.log1p(sums[:, 4]), sums[:, 0] / np.maximum(sums[:, 5], 1), sums[:, 0] / total, (passed - opened) / total,
            np.log1p(before), np.log1p(after), turn, np.log1p(many), alike, good, bad, good_above, bad_above, up_group,
        ],
        axis=1,
    )
    return np.concatenate([one_hot, rest], axis=1)


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Gradient-boosted trees of the logistic loss over binned features."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    prior = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    start = float(np.log(prior / (1 - prior)))
    score = np.full(len(y), start)
    size = (1 << (DEPTH + 1)) - 1
    split = np.full((TREES, size), -1)
    limit, value = np.zeros((TREES, size)), np.zeros((TREES, size))
    for t in range(TREES):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = weight * (chance - y), weight * np.maximum(chance * (1 - chance), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH + 1):
            lo = (1 << level) - 1
            here = node - lo
            live = node >= lo
            g = np.bincount(here[live], slope[live], 1 << level)
            h = np.bincount(here[live], bend[live], 1 << level)
            value[t, lo : lo + (1 << level)] = -RATE * g / (h + 1)
            if level == DEPTH:
                break
            best = np.full(1 << level, 1e-3)
            cut = np.full(1 << level, -1)
            at = np.zeros(1 << level, np.int64)
            for f in range(x.shape[1]):
                cell = here[live] * BINS + binned[live, f]
                gl = np.bincount(cell, slope[live], (1 << level) * BINS).reshape(-1, BINS).cumsum(axis=1)
                hl = np.bincount(cell, bend[live], (1 << level) * BINS).reshape(-1, BINS).cumsum(axis=1)
                gain = gl**2 / (hl + 1) + (g[:, None] - gl) ** 2 / (h[:, None] - hl + 1) - (g**2 / (h + 1))[:, None]
                gain[:, len(edges[f]) :] = -1
                top = gain.argmax(axis=1)
                better = gain[np.arange(1 << level), top] > best
                best[better], cut[better], at[better] = gain[np.arange(1 << level), top][better], f, top[better]
            for k in np.flatnonzero(cut >= 0):
                split[t, lo + k], limit[t, lo + k] = cut[k], edges[cut[k]][at[k]]
            grows = live & (cut[np.where(live, here, 0)] >= 0)
            rows = np.flatnonzero(grows)
            right = x[rows, split[t, node[rows]]] > limit[t, node[rows]]
            node[rows] = 2 * node[rows] + 1 + right
        score += value[t, node]
    return {"start": start, "split": split, "limit": limit, "value": value}


def log_odds(model: dict, x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for split, limit, value in zip(model["split"], model["limit"], model["value"]):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            axis = split[node]
            inner = axis >= 0
            node = np.where(inner, 2 * node + 1 + (x[rows, np.maximum(axis, 0)] > limit[node]), node)
        score += value[node]
    return score


def fixed_rule(x: np.ndarray) -> np.ndarray:
    """Score without trees: links and furniture count against a node."""
    n = len(_GROUPS)
    furniture = x[:, [_GROUP[t] for t in ("nav", "aside", "footer", "header", "form")]].any(axis=1)
    return np.where(furniture | (x[:, n + 4] > 0.5) | (x[:, n + 18] > 0), -3.0, 1.0)


def decode(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """The best set of nodes that holds every parent of its nodes.

    Bottom-up, a node is worth its own weighted odds and its children's worth, or nothing if
    that is negative; top-down, it stays if it is worth something and its parent stays. The
    odds of a node include its parent's, so a short line follows the block it stands in.
    """
    depth, parent = np.array(nodes.depth), np.array(nodes.parent)
    chars = np.array([len(t.strip()) if t else 0 for t in nodes.text], float)
    odds = odds + np.where(parent >= 0, odds[np.maximum(parent, 0)], 0)
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
    held = chars.copy()
    for level in reversed(levels[1:]):
        np.add.at(held, parent[level], held[level])
    worth = odds * np.log1p(held)
    for level in reversed(levels):
        worth[level] = np.maximum(worth[level], 0)
        if len(level) and depth[level[0]] > 0:
            np.add.at(worth, parent[level], worth[level])
    keep = worth > 0
    blank = np.array([t is not None and not t.strip() for t in nodes.text], bool)
    said = np.array([t == "#text" for t in nodes.tag], bool)
    inline = said | np.array([t in _INLINE for t in nodes.tag], bool)
    speaks, follows = np.zeros(len(parent), bool), np.zeros(len(parent), bool)
    for level in levels[1:]:
        up = parent[level]
        keep[level] &= keep[up]
        # What stands inside a line of kept text is part of that line.
        speaks[up[said[level] & ~blank[level] & keep[level]]] = True
        follows[level] = inline[level] & keep[up] & (speaks[up] | follows[up])
        keep[level] |= follows[level]
    keep[blank] = keep[np.maximum(parent[blank], 0)]  # white space goes with its element
    return keep


def assemble(nodes: Nodes, keep: np.ndarray, n_pages: int) -> list[str]:
    """Text of every page: kept texts, one line per block."""
    lines: list[list[str]] = [[] for _ in range(n_pages)]
    block_of = np.zeros(len(nodes.tag), np.int64)
    open_: list[str] = []
    at, where = -1, -1

    def close(page: int) -> None:
        line = " ".join("".join(open_).split())
        if line:
            lines[page].append(line)
        open_.clear()

    for i, tag in enumerate(nodes.tag):
        parent = nodes.parent[i]
        if tag in _INLINE or tag == "#text":
            block_of[i] = block_of[parent] if parent >= 0 else i
        else:
            block_of[i] = i
        if keep[i] and (tag == "#text" or tag in ("br", "wbr")):
            if where >= 0 and (block_of[i] != at or nodes.page[i] != where):
                close(where)
            at, where = block_of[i], nodes.page[i]
            open_.append(nodes.text[i] if tag == "#text" else " ")
        elif tag not in _INLINE and tag != "#text" and where >= 0:  # a block between two texts of one element parts them
            close(where)
            at, where = -1, -1
    if where >= 0:
        close(where)
    return ["\n".join(x) for x in lines]


def _labels(nodes: Nodes) -> np.ndarray:
    """1 for texts of the marked article outside its furniture and for every element above one."""
    n = len(nodes.tag)
    inside, outside = np.zeros(n, bool), np.zeros(n, bool)
    furniture = {"nav", "aside", "footer", "header", "form", "menu"}
    for i in range(n):
        p = nodes.parent[i]
        inside[i] = (p >= 0 and inside[p]) or nodes.tag[i] in ("article", "main") or nodes.text[i] == _ARTICLE
        outside[i] = (p >= 0 and outside[p]) or nodes.tag[i] in furniture or nodes.bad[i] > 0
    label = np.array([t is not None and bool(t.strip()) for t in nodes.text]) & inside & ~outside
    for i in range(n - 1, 0, -1):
        if label[i] and nodes.parent[i] >= 0:
            label[nodes.parent[i]] = True
    return label


def sample_nodes(pages: list[str], seed: int = 3) -> tuple[Nodes, np.ndarray]:
    """Training nodes and labels: every page as it is, and a copy in other markup."""
    draw = random.Random(seed)
    nodes, labels = Nodes(), []
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split())[-400:] for p in pages] or [""]
    number = 0
    for source in pages:
        for variant in range(2):
            own = Nodes()
            parse(_dress(source, draw, lines) if variant else source, own, number)
            if variant:  # marks of the article survive as a token of their own
                for i, tag in enumerate(own.tag):
                    if tag == "x-article":
                        own.tag[i], own.text[i] = "div", _ARTICLE
            found = _labels(own)
            own.text = [None if t == _ARTICLE else t for t in own.text]
            shift = len(nodes.tag)
            nodes.tag += own.tag
            nodes.parent += [p + shift if p >= 0 else -1 for p in own.parent]
            nodes.depth += own.depth
            nodes.good += own.good
            nodes.bad += own.bad
            nodes.text += own.text
            nodes.page += own.page
            labels.append(found)
            number += 1
    return nodes, np.concatenate(labels) if labels else np.zeros(0, bool)


_ARTICLE = "\0article"


def _dress(source: str, draw: random.Random, lines: list[str]) -> str:
    """A page in which elements that tell the article are plain, with usual furniture added."""
    name = draw.choice(["content", "post", "entry", "article-body", "main", "story", ""])
    opened = f'<x-article class="{name}">' if name else "<x-article>"
    source = re.sub(r"<(article|main)\b[^>]*>", opened, source, flags=re.I)
    source = re.sub(r"</(article|main)\s*>", "</x-article>", source, flags=re.I)
    for tag, names in (("nav", ["menu", "nav", "navigation"]), ("footer", ["footer", "copyright"]), ("header", ["header", "masthead"]), ("aside", ["sidebar", "widget"])):
        if draw.random() < 0.7:
            source = re.sub(rf"<{tag}\b[^>]*>", f'<div class="{draw.choice(names)}">', source, flags=re.I)
            source = re.sub(rf"</{tag}\s*>", "</div>", source, flags=re.I)

    def said(words: int) -> str:
        return html.escape(" ".join(draw.choice(lines).split()[:words]))

    side = draw.choice(["aside", "div"])
    extra = [
        f'<div class="{draw.choice(["cookie", "notice", "consent"])}"><p>{said(20)}</p><button>{said(1)}</button></div>',
        f'<div class="{draw.choice(["comments", "comment", "discussion"])}"><h3>{said(2)}</h3><p>{said(30)}</p><p>{said(20)}</p></div>',
        f'<form class="{draw.choice(["search", "newsletter", "login"])}"><label>{said(3)}</label><input></form>',
        f'<{side} class="{draw.choice(["sidebar", "related", "widget"])}"><p>{said(25)}</p><ul><li><a>{said(4)}</a></li><li><a>{said(4)}</a></li></ul></{side}>',
        f'<div class="{draw.choice(["ad", "banner", "sponsored", "promo"])}">{said(12)}</div>',
        f'<header class="{draw.choice(["header", "masthead"])}"><a>{said(3)}</a><p>{said(6)}</p></header>',
    ]
    for block in draw.sample(extra, 3):
        place = draw.choice(["<x-article", "</x-article>"])
        if place in source:
            at = source.index(place) + (len(place) if place[1] == "/" else 0)
            source = source[:at] + block + source[at:]
    return source


def train(pages: DataFrame, address: str = "url", page: str = "html", sample: int = TRAIN_PAGES) -> dict | None:
    """Trees from a bounded sample of pages that mark their article up; None without any."""
    marked = pages.filter(F.col(page).rlike(r"(?i)<(article|main)\b"))
    share = sample / max(marked.count(), sample)
    chosen = marked.filter(unit_draw(F.col(address), F.col(page)) < share)
    rows = chosen.select(F.col(page).alias("html")).limit(2 * sample).collect()
    rows.sort(key=lambda r: r["html"])
    nodes, labels = sample_nodes([r["html"] for r in rows])
    if not labels.any():
        return None
    x = features(nodes)
    weight = x[:, len(_GROUPS) + 1] + 0.1  # log of the characters
    return fit_trees(x, labels.astype(float), weight)


def extract_batch(sources: list[str], model: dict | None) -> list[str]:
    nodes = Nodes()
    for i, source in enumerate(sources):
        parse(source, nodes, i)
    x = features(nodes)
    odds = log_odds(model, x) if model else fixed_rule(x)
    return assemble(nodes, decode(nodes, odds), len(sources))


def _extract(model: dict | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = extract_batch([x or "" for x in part["html"].to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["key", "url", "text", "n_chars"],
                )

    return run


def extract(pages: DataFrame, key: str = "page_id", address: str = "url", page: str = "html", sample: int = TRAIN_PAGES) -> DataFrame:
    """One row per page: key, url, text, n_chars."""
    model = train(pages, address, page, sample)
    rows = pages.select(F.col(key).alias("key"), F.col(address).alias("url"), F.col(page).alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("key", "url")]
    with arrow_rows(pages.sparkSession, 256):
        found = rows.mapInArrow(_extract(model), f"key {kinds[0]}, url {kinds[1]}, text string, n_chars long")
        return stage(found, "page-texts")
