"""Main text of pages by a tree-structured graphical model over the DOM.

Each element is content or not. Features of the element (name, class words, lengths, share of links) give its own
potential; an element and its parent share a potential by their two states, one table for blocks and one for inline
elements. Messages go up from the leaves and down again (sum-product), so each element's marginal is exact. Weights are
trained by the exact gradient of the likelihood, expected less observed counts, on labelled pages.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilnote.llm.common import map_batches
from veilnote.llm.dom import INLINE, Page, parse
from veilnote.llm.labelled_pages import labelled_pages

#: Labelled pages, steps of the gradient and weight decay.
PAGES, STEPS, DECAY = 1200, 200, 1e-4

# Elements that are never content, and words of class names by what they tell.
NEVER = frozenset("head title meta link script style noscript template iframe svg canvas object nav form button select option input textarea "
                  "label fieldset".split())
TAGS = ("article main section div p h1 h2 h3 h4 li ul ol a b strong em i span table tr td blockquote pre code figure figcaption header footer aside nav "
        "body dl dt dd time small details summary #page html").split()
CLASS_WORDS = {
    "content": "article content main post entry story text body prose",
    "menu": "nav menu navbar breadcrumb breadcrumbs navigation toc pagination pager tabs skip",
    "edge": "header footer masthead top bottom copyright legal site banner",
    "side": "sidebar side aside related widget recommended popular more tags trending",
    "notice": "cookie cookies consent notice alert modal popup gdpr newsletter subscribe signup promo",
    "advert": "ad ads advert advertisement sponsor sponsored adsense promoted",
    "talk": "comment comments respond reply discussion disqus replies thread",
    "share": "share social follow login search meta byline author",
}
WORDS = {w: group for group, listed in CLASS_WORDS.items() for w in listed.split()}
GROUPS = list(CLASS_WORDS)
STEPS_OF_LENGTH = (1, 20, 60, 150, 400, 1000)
#: Columns of features: each tag, other tag, each group, the same of any ancestor, lengths of own and whole text, links,
#: text right in the page or its body, paragraphs right in it whose class tells nothing.
OFFSETS = dict(zip(("tag", "group", "above", "tag_above", "own", "whole", "links", "open", "top", "always"), np.cumsum(
    [0, len(TAGS) + 1, len(GROUPS), len(GROUPS), len(TAGS) + 1, len(STEPS_OF_LENGTH) + 1, len(STEPS_OF_LENGTH) + 1, 6, 1, 1]).tolist(), strict=True))
WIDTH = OFFSETS["always"] + 1
TAG_AT = {t: k for k, t in enumerate(TAGS)}
_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Forest:
    """The elements of many pages: parents (-1: none), depths, whether inline or never content, and (element, feature)."""

    parent: np.ndarray
    depth: np.ndarray
    inline: np.ndarray
    never: np.ndarray
    rows: np.ndarray
    features: np.ndarray

    def levels(self) -> list[np.ndarray]:
        order = np.argsort(self.depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1)


def forest(pages: list[Page]) -> Forest:
    base = np.cumsum([0] + [len(p.tags) for p in pages])
    parent = np.concatenate([np.where(np.array(p.parents) < 0, -1, np.array(p.parents) + b) for p, b in zip(pages, base, strict=False)])
    depth = np.concatenate([np.array(p.depths) for p in pages])
    tags = [t for p in pages for t in p.tags]
    own, linked = np.zeros(len(tags)), np.zeros(len(tags))
    for p, b in zip(pages, base, strict=False):
        for k, text in p.texts:
            if k >= 0:
                own[b + k] += len(text.strip())
    is_link = np.array([t == "a" for t in tags])
    never = np.array([t in NEVER for t in tags])
    own[never] = 0
    made = Forest(parent, depth, np.array([t in INLINE for t in tags]), never, np.zeros(0, int), np.zeros(0, int))
    whole, linked = own.copy(), np.where(is_link, own, 0)
    levels = made.levels()
    for level in reversed(levels[1:]):
        np.add.at(whole, parent[level], whole[level])
        linked[level] = np.where(is_link[level], whole[level], linked[level])
        np.add.at(linked, parent[level], linked[level])
    groups = np.zeros((len(tags), len(GROUPS)), bool)
    for k, names in enumerate(n for p in pages for n in p.names):
        if names:
            for word in _SPLIT.split(names):
                if word in WORDS:
                    groups[k, GROUPS.index(WORDS[word])] = True
    tag = np.array([TAG_AT.get(t, len(TAGS)) for t in tags])
    tag_sets = np.zeros((len(tags), len(TAGS) + 1), bool)
    tag_sets[np.arange(len(tags)), tag] = True
    above, tags_above = np.zeros_like(groups), np.zeros_like(tag_sets)
    for level in levels[1:]:
        above[level] = groups[parent[level]] | above[parent[level]]
        tags_above[level] = tag_sets[parent[level]] | tags_above[parent[level]]
    outer = np.array([t in ("#page", "html", "body") for t in tags])
    within = np.where(parent >= 0, outer[parent], False)
    paragraph = np.array([t == "p" for t in tags])
    share = np.where(whole > 0, linked / np.maximum(whole, 1), 0)
    pairs = [(np.arange(len(tags)), OFFSETS["tag"] + tag),
             (np.arange(len(tags)), OFFSETS["own"] + np.searchsorted(STEPS_OF_LENGTH, own, "right")),
             (np.arange(len(tags)), OFFSETS["whole"] + np.searchsorted(STEPS_OF_LENGTH, whole, "right")),
             (np.arange(len(tags)), OFFSETS["links"] + np.minimum(5, (share * 5).astype(int))),
             (np.arange(len(tags)), np.full(len(tags), OFFSETS["always"]))]
    for name, flag in (("open", outer & (own > 0)), ("top", within & paragraph & ~groups.any(axis=1))):
        pairs.append((np.flatnonzero(flag), np.full(int(flag.sum()), OFFSETS[name])))
    for name, flags in (("group", groups), ("above", above), ("tag_above", tags_above)):
        row, column = np.nonzero(flags)
        pairs.append((row, OFFSETS[name] + column))
    made.rows, made.features = (np.concatenate(x) for x in zip(*pairs, strict=True))
    return made


@dataclass
class Model:
    """Weight of each feature for content, and potentials by (inline, parent's state, child's state)."""

    weights: np.ndarray
    edges: np.ndarray


def marginals(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Chance of content of each element, and of each pair of states (parent, child) of each element with a parent."""
    n = len(trees.parent)
    own = np.zeros((n, 2))
    own[:, 1] = np.bincount(trees.rows, model.weights[trees.features], n)
    own[trees.never, 1] = -1e9
    levels, up, sent = trees.levels(), own.copy(), np.zeros((n, 2))
    edge = model.edges[trees.inline.astype(int)]                # element, parent's state, own state
    for level in reversed(levels[1:]):
        sent[level] = np.logaddexp(*(edge[level, :, c] + up[level, c, None] for c in (0, 1)))
        np.add.at(up, trees.parent[level], sent[level])
    total = up.copy()                                           # log beliefs
    pair = np.zeros((n, 2, 2))
    for level in levels[1:]:
        above = total[trees.parent[level]] - sent[level]
        joint = above[:, :, None] + edge[level] + up[level][:, None, :]
        total[level] = np.logaddexp(joint[:, 0], joint[:, 1])
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        pair[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), pair


def train(pages: list[tuple[Page, list[bool]]], steps: int = STEPS) -> Model:
    """Adam steps along the exact gradient; the same pages give the same model."""
    trees = forest([p for p, _ in pages])
    truth = np.concatenate([np.array(y) for _, y in pages]).astype(float)
    truth[trees.never] = 0
    inline, child = trees.inline.astype(int), np.flatnonzero(trees.parent >= 0)
    seen_pairs = np.zeros((2, 2, 2))
    np.add.at(seen_pairs, (inline[child], truth[trees.parent[child]].astype(int), truth[child].astype(int)), 1)
    free = ~trees.never
    size = WIDTH + 8
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        chance, pair = marginals(trees, Model(theta[:WIDTH], theta[WIDTH:].reshape(2, 2, 2)))
        expected = np.stack([pair[child[inline[child] == k]].sum(0) for k in (0, 1)])
        slope = np.concatenate([np.bincount(trees.features, ((truth - chance) * free)[trees.rows], WIDTH), (seen_pairs - expected).ravel()])
        slope = slope / len(truth) - DECAY * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta = theta + 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:WIDTH], theta[WIDTH:].reshape(2, 2, 2))


def text_of(page: Page, content: np.ndarray) -> str:
    """Texts of the content elements in page order. Blocks are joined, and white space within them becomes, one space."""
    return " ".join("".join(" " if k < 0 else text for k, text in page.texts if k < 0 or content[k]).split())


def main_texts(sources: list[str], model: Model) -> list[str]:
    pages = [parse(s) for s in sources]
    chance, _ = marginals(forest(pages), model)
    out, at = [], 0
    for page in pages:
        out.append(text_of(page, chance[at:at + len(page.tags)] >= 0.5))
        at += len(page.tags)
    return out


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages(page_id, url, html): the main text of the whole html.

    Null and empty html have the empty text. Html that isn't closed or isn't html at all is read as far as it makes
    sense. Null and repeated ids are rows like any other; extra columns are ignored.
    """
    known = model or train([(p, y) for p, y in labelled_pages(PAGES)])

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts: list[str] = []
        for lo in range(0, batch.num_rows, 64):
            texts += main_texts([s or "" for s in batch.column(2).slice(lo, 64).to_pylist()], known)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    ready = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(ready, read, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
