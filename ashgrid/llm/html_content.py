"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: its block elements, and one leaf per block of text.
Each node is content or not; an element is content if it holds main text.  Node
potentials come from tag, class words, text length and link share, parent-child
potentials from what the child is.  One sweep of sum-product messages from the
leaves upward and one downward give the exact marginal of every node; the text
leaves that are more likely content than not are the main text, in page order.

The weights start from a prior that states what tags and class words mean, and
are fitted to labelled pages by gradient steps on the exact likelihood.  The
labels are the pages' own: where a page marks its article (``article``,
``main``), the text inside it is content but for the parts that are marked as
something else.  ``TRAIN_PAGES`` bounds the sample, the different pages with
the smallest hashes of id, url and html; pages of more than ``TRAIN_NODES`` nodes
or 40 characters for each of these are not sampled.  All
pages are extracted, whole, whatever their length.

Defined results: null or empty html has the empty text; a page without any
labelled page in its table is read with the prior; repeated rows are extracted
alike.  Script, style, title, textarea and the like hold raw text up to their
closing tag, or to the end of the page; drawings and templates are skipped if they
are closed, and are empty if not or if they close themselves; formulas, objects,
canvases and noscript are read like the text around them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

TRAIN_PAGES, TRAIN_NODES = 600, 2000
STEPS, RATE, PULL = 60, 0.3, 0.02

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""",
    re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORDS = re.compile(r"[a-z]+")

#: fixed values: kinds of elements in HTML
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
SKIPPED = frozenset("svg template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var object canvas noscript math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup "
    "munder mover munderover mstyle mspace mtable mtr mtd semantics annotation".split())
ASIDE_TAGS = frozenset("nav footer aside form header button fieldset menu dialog select".split())
MAIN_TAGS = frozenset("article main".split())
#: class, id and role words, by what they say of an element
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended recirculation share sharing social "
    "comment comments reply replies respond disqus discussion notice notification alert cookie cookies consent gdpr popup modal "
    "overlay newsletter subscribe subscription signup login register search form copyright legal disclaimer pagination pager "
    "toolbar complementary contentinfo hidden".split())
MAIN_WORDS = frozenset("article content post entry main story body text page".split())
SENTENCE = ".!?:;,\"')"

LENGTHS, LINKS = (20, 60, 200), (0.05, 0.5)
FEATURES = ("bias_leaf", "bias_element", "outside", "aside_tag", "aside_word", "main_tag", "main_word", "hidden",
            "p", "heading", "list", "table", "div",
            *[f"length{i}" for i in range(len(LENGTHS) + 1)], *[f"links{i}" for i in range(len(LINKS) + 1)], "sentence")
AT = {f: i for i, f in enumerate(FEATURES)}
#: what each feature is taken to say (log odds of content) before any page is seen
PRIOR = {"outside": -6.0, "aside_tag": -8.0, "aside_word": -8.0, "hidden": -8.0, "main_tag": 3.0, "main_word": 1.0, "p": 0.5, "heading": 0.3,
         "list": -0.3, "length0": -0.5, "length2": 0.7, "length3": 1.2, "links2": -2.0, "sentence": 0.4}
#: kinds of child, and the prior of (parent, child) states (0,0) (0,1) (1,0) (1,1)
KINDS = ("leaf", "element", "aside", "main")
PAIR_PRIOR = {"leaf": (2, -6, -1, 1), "element": (2, -6, 0, 1), "aside": (2, -6, 2, -2), "main": (2, -6, -2, 2)}


class Page:
    """Nodes of one page in page order: parent, kind, feature lists, labels; texts of the leaves."""

    __slots__ = ("parent", "kind", "features", "text", "main", "aside", "depth")

    def __init__(self, html: str):
        self.parent, self.kind, self.features, self.text = [-1], [1], [[AT["bias_element"]]], [None]
        self.main, self.aside, self.depth = [False], [False], [0]
        self._read(html)
        if any(self.main):  # the page marks its article: text elsewhere is told so
            for i, t in enumerate(self.text):
                if t is not None and not self.main[i]:
                    self.features[i].append(AT["outside"])

    def _add(self, parent: int, kind: int, features: list[int], text: str | None, main: bool, aside: bool) -> int:
        self.parent.append(parent), self.kind.append(kind), self.features.append(features), self.text.append(text)
        self.main.append(main), self.aside.append(aside), self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def _element(self, tag: str, attributes: str, parent: int) -> int:
        features = [AT["bias_element"]]
        words: set[str] = set()
        hidden = False
        if attributes and not attributes.isspace():
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id", "role"):
                    words.update(WORDS.findall(value))
                elif name == "style":
                    hidden |= "display:none" in value.replace(" ", "")
                else:
                    hidden |= name == "hidden" or value == "true"
        inside_main = self.main[parent]
        aside = bool(words & ASIDE_WORDS) or (tag in ASIDE_TAGS and not (tag == "header" and inside_main))
        main = tag in MAIN_TAGS or bool(words & MAIN_WORDS) and not aside
        if tag in ASIDE_TAGS and aside:
            features.append(AT["aside_tag"])
        if words & ASIDE_WORDS:
            features.append(AT["aside_word"])
        if tag in MAIN_TAGS:
            features.append(AT["main_tag"])
        elif main:
            features.append(AT["main_word"])
        if hidden:
            features.append(AT["hidden"])
        shape = "p" if tag in ("p", "blockquote", "pre") else "heading" if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else \
            "list" if tag in ("ul", "ol", "li", "dl", "dt", "dd") else "table" if tag in ("table", "tbody", "thead", "tr", "td", "th") else "div"
        features.append(AT[shape])
        kind = 2 if aside or hidden else 3 if main else 1
        return self._add(parent, kind, features, None, inside_main or tag in MAIN_TAGS, self.aside[parent] or aside or hidden)

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("body", 0)]
        opened: Counter[str] = Counter()  # tags on the stack, but for its bottom
        run: list[str] = []
        unclosed: set[str] = set()  # skipped tags that no closing tag follows any more
        linked, depth_a, at, size = 0, 0, 0, len(html)

        def flush() -> None:
            nonlocal linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    node = stack[-1][1]
                    share = linked / max(1, len(text))
                    features = [AT["bias_leaf"], AT[f"length{np.searchsorted(LENGTHS, len(text))}"],
                                AT["links0"] + (share > LINKS[0]) + (share > LINKS[1])]
                    if text[-1] in SENTENCE:
                        features.append(AT["sentence"])
                    self._add(node, 0, features, text, self.main[node], self.aside[node])
                run.clear()
            linked = 0

        def close(upto: int) -> None:
            flush()
            opened.subtract(tag for tag, _ in stack[upto:])
            del stack[upto:]

        def add(text: str) -> None:
            nonlocal linked
            if "&" in text:
                text = unescape(text)
            run.append(text)
            if depth_a:
                linked += len(text)

        while at < size:
            found = TAG.search(html, at)
            if not found:
                add(html[at:])
                break
            if found.start() > at:
                add(html[at:found.start()])
            at = found.end()
            tag = found[2] or found[5]
            if not tag:
                continue
            tag, ending = tag.lower(), found[1] or found[4]
            if ending:
                if tag in INLINE:
                    if tag == "a" and depth_a:
                        depth_a -= 1
                elif tag == "head":
                    flush()
                elif opened[tag]:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == tag:
                            close(k)
                            depth_a = 0
                            break
                continue
            if tag in RAW or tag in SKIPPED:
                closed = tag in SKIPPED and html[at - 2] == "/"
                end = None if closed or tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
                if end:
                    at = end.end()
                elif tag in RAW:
                    at = size
                elif not closed:
                    unclosed.add(tag)
                continue
            if tag == "br":
                run.append(" ")
                continue
            if tag in INLINE:
                depth_a += tag == "a"
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            flush()
            if tag in ("html", "body", "head"):
                continue
            top = stack[-1][0]
            if top == "p" or top == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option") or \
                    (top, tag) in (("dt", "dd"), ("dd", "dt"), ("td", "th"), ("th", "td")):
                close(len(stack) - 1)
            elif tag == "tr" and top in ("td", "th") and len(stack) > 2:
                close(len(stack) - (2 if stack[-2][0] == "tr" else 1))
            opened[tag] += 1
            stack.append((tag, self._element(tag, found[3] or found[6] or "", stack[-1][1])))
        flush()

    def labels(self) -> np.ndarray | None:
        """1 where a leaf lies in the marked article and an element holds such a
        leaf; None for pages that mark no article."""
        if not any(self.main):
            return None
        y = np.zeros(len(self.parent), dtype=np.int64)
        for i in range(len(self.parent) - 1, -1, -1):
            if self.text[i] is not None and self.main[i] and not self.aside[i]:
                y[i] = 1
            if y[i] and self.parent[i] >= 0:
                y[self.parent[i]] = 1
        return y


class Forest:
    """Many pages as one set of arrays, nodes grouped by depth."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages])
        base = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.parent = np.concatenate([np.array(p.parent) for p in pages])
        self.parent = np.where(self.parent < 0, -1, self.parent + base)
        self.kind = np.concatenate([np.array(p.kind) for p in pages])
        count = [len(f) for p in pages for f in p.features]
        self.node = np.repeat(np.arange(len(count)), count)
        self.feature = np.array([x for p in pages for f in p.features for x in f])
        depth = np.array([d for p in pages for d in p.depth])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log P(node), log P(parent, child) by child, and the tree's log partition at its root."""
        own = np.zeros((len(self.parent), 2))
        own[:, 1] = np.bincount(self.node, weights[self.feature], len(self.parent))
        up = own.copy()
        sent = np.zeros_like(own)
        for level in reversed(self.levels[1:]):
            sent[level] = np.logaddexp.reduce(pair[self.kind[level]] + up[level][:, None, :], axis=2)
            np.add.at(up, self.parent[level], sent[level])
        whole = up.copy()  # of the root, then of each node with what comes from above
        both = np.zeros((len(self.parent), 2, 2))
        for level in self.levels[1:]:
            above = whole[self.parent[level]] - sent[level]
            joint = above[:, :, None] + pair[self.kind[level]] + up[level][:, None, :]
            whole[level] = np.logaddexp.reduce(joint, axis=1)
            both[level] = joint - np.logaddexp.reduce(joint, axis=(1, 2))[:, None, None]
        return whole - np.logaddexp.reduce(whole, axis=1)[:, None], both, np.logaddexp.reduce(whole, axis=1)


def prior() -> tuple[np.ndarray, np.ndarray]:
    w = np.array([PRIOR.get(f, 0.0) for f in FEATURES])
    return w, np.array([np.reshape(PAIR_PRIOR[k], (2, 2)) for k in KINDS], dtype=float)


def fit(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Weights after gradient steps on the pages' exact log likelihood, pulled to the prior."""
    w0, p0 = prior()
    labelled = [(p, y) for p in pages if (y := p.labels()) is not None]
    if not labelled:
        return w0, p0
    forest = Forest([p for p, _ in labelled])
    y = np.concatenate([y for _, y in labelled])
    n, child = len(y), np.flatnonzero(forest.parent >= 0)
    seen_w = np.bincount(forest.feature, y[forest.node], len(w0))
    seen_p = np.zeros_like(p0)
    np.add.at(seen_p, (forest.kind[child], y[forest.parent[child]], y[child]), 1)
    w, p = w0.copy(), p0.copy()
    for _ in range(STEPS):
        single, both, _ = forest.marginals(w, p)
        want_w = np.bincount(forest.feature, np.exp(single[forest.node, 1]), len(w0))
        want_p = np.zeros_like(p0)
        np.add.at(want_p, forest.kind[child], np.exp(both[child]))
        w += RATE * (len(w0) * (seen_w - want_w) / n - PULL * (w - w0))
        p += RATE * (len(w0) * (seen_p - want_p) / n - PULL * (p - p0))
    return w, p


def extract(htmls: list[str], weights: np.ndarray, pair: np.ndarray) -> list[str]:
    pages = [Page(h) for h in htmls]
    forest = Forest(pages)
    single, _, _ = forest.marginals(weights, pair)
    content = single[:, 1] > single[:, 0]
    out, at = [], 0
    for p in pages:
        out.append("\n".join(t for i, t in enumerate(p.text) if t is not None and content[at + i]))
        at += len(p.text)
    return out


def train(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Fit on the bounded sample, inside one task: the driver gets the weights only."""
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, url_col, html_col)])
    marked = (pages.filter(F.lower(F.col(html_col)).rlike("<(article|main)[ >]") & (F.length(html_col) < 40 * TRAIN_NODES))
              .select(h.alias("h"), F.col(html_col).alias("html")))
    # the hashes first: only the sampled pages themselves travel
    last = marked.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).agg(F.max("h")).first()[0]
    if last is None:
        return prior()
    sample = marked.filter(F.col("h") <= last).dropDuplicates(["h"]).repartition(1).sortWithinPartitions("h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = [p for b in batches for p in map(Page, b["html"]) if len(p.parent) <= TRAIN_NODES]
        w, p = fit(read)
        yield pd.DataFrame({"w": [w.tolist()], "p": [p.reshape(-1).tolist()]})

    row = sample.select("html").mapInPandas(run, "w array<double>, p array<double>").first()
    return (np.array(row["w"]), np.reshape(row["p"], (len(KINDS), 2, 2))) if row else prior()


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              slice_pages: int = 128) -> DataFrame:
    """One row per page: id, url, text."""
    weights, pair = train(pages, id_col, url_col, html_col)
    d = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), slice_pages):
                part = batch.iloc[at:at + slice_pages]
                yield pd.DataFrame({"id": part["id"].astype("Int64") if part["id"].dtype != object else part["id"],
                                    "url": part["url"], "text": extract(list(part["html"]), weights, pair)})

    return d.mapInPandas(run, f"id {d.schema['id'].dataType.simpleString()}, url string, text string")
