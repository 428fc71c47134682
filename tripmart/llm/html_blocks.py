"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read once into a flat list of text blocks: the text between two tags
that begin or end a block.  Each block is described by its words and link
density, the same of its neighbours before and after, and by where it stands
(heading, list item, innermost container whose name tells something).  A
decision tree, trained on the small labelled table of ``labelled_pages``,
tells the article's blocks from the rest.  A container of the frame settles
it; anywhere else links and words of a block and its neighbours do, so lists of
links go from inside an article, too, and no named container is needed.

Scripts, styles, comments and the head give no blocks.  Character references
are decoded once, white space inside a block becomes one space, and blocks are
joined in page order by one space.

Defined results: a null or empty page, and one without article text, gives an
empty text; an unclosed tag or comment runs to the end of the page; repeated
pages and null ids are extracted each for itself; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import html as html_module
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.labelled_pages import LABELLED_PAGES

# Element names by what they do to the text around them.
NO_TEXT = frozenset("script style template iframe object svg math noframes noembed".split())
HEAD = frozenset("head title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE_TAGS = frozenset("article main".split())
FRAME_TAGS = frozenset("nav header footer aside form menu dialog select button textarea fieldset noscript".split())
ARTICLE_HINTS = frozenset("article story entry post articlebody main".split())
FRAME_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-links comment comments "
    "consent cookie cookies copyright disclaimer discussion footer gdpr header login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification pagination pager popup promo promoted promotion related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags toolbar widget widgets".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<([/!?]?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<[/!?]?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "inside", "heading", "list_item", "frame_depth",
)


@dataclass
class Block:
    text: str
    features: list[float] = field(default_factory=list)


def _mark(tag: str, attributes: str, in_article: bool) -> int:
    """1 for an article container, -1 for one of the frame around it, 0 for any other (an article's own header too)."""
    hints: set[str] = set()
    if "=" in attributes:
        for _, value in _ATTRIBUTE.findall(attributes):
            hints.update(_WORDS.findall(value.lower()))
    if hints & FRAME_HINTS or tag in FRAME_TAGS and not (tag == "header" and in_article):
        return -1
    return 1 if tag in ARTICLE_TAGS or hints & ARTICLE_HINTS else 0


@cache
def _end_of(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page with their features."""
    raw: list[tuple[str, int, int, tuple[int, bool, bool, int]]] = []  # text, words, linked words, place
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    linked = 0
    link_from = -1  # parts before this one are outside the open link

    def place() -> tuple[int, bool, bool, int]:
        inside = next((m for _, m in reversed(stack) if m), 0)
        tags = {t for t, _ in stack[-3:]}
        return inside, bool(tags & HEADINGS), "li" in tags, sum(m < 0 for _, m in stack)

    def words_in(pieces: list[str]) -> int:
        return len(html_module.unescape("".join(pieces)).split())

    def flush() -> None:
        nonlocal parts, linked, link_from
        if parts:
            text = " ".join(html_module.unescape("".join(parts)).split())
            if text:
                if link_from >= 0:
                    linked += words_in(parts[link_from:])
                raw.append((text, text.count(" ") + 1, linked, place()))
        parts, linked = [], 0
        link_from = 0 if link_from >= 0 else -1

    at, end = 0, len(page)
    while at < end:
        tag_match = _TAG.search(page, at)
        if tag_match is None:
            parts.append(page[at:])
            break
        if tag_match.start() > at:
            parts.append(page[at:tag_match.start()])
        at = tag_match.end()
        kind, name, attributes = tag_match.group(1, 2, 3)
        if not name or kind in ("!", "?"):
            continue
        tag = name.lower()
        if not kind and (tag in NO_TEXT or tag in HEAD) and not attributes.endswith("/"):
            if tag == "head":
                continue
            closing = _end_of(tag).search(page, at)
            at = closing.end() if closing else end
            if tag not in INLINE and tag not in HEAD:
                parts.append(" ")
            continue
        if tag == "a":
            if kind and link_from >= 0:
                linked += words_in(parts[link_from:])
                link_from = -1
            elif not kind and link_from < 0:
                link_from = len(parts)
            continue
        if tag in INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if tag in VOID or tag in ("html", "body", "head"):
            continue
        if kind:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            if stack and stack[-1][0] == "p":
                stack.pop()  # a paragraph ends where the next block begins
            if tag == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            stack.append((tag, _mark(tag, attributes, any(m > 0 for _, m in stack))))
    flush()

    none = ("", 0, 0, (0, False, False, 0))
    out = []
    for k, (text, n, links, (inside, heading, item, depth)) in enumerate(raw):
        _, n_before, links_before, _ = raw[k - 1] if k else none
        _, n_after, links_after, _ = raw[k + 1] if k + 1 < len(raw) else none
        out.append(Block(text, [
            float(n), links / n, float(n_before), links_before / max(1, n_before), float(n_after),
            links_after / max(1, n_after), float(inside), float(heading), float(item), float(depth),
        ]))
    return out


@dataclass
class Node:
    """A leaf (``feature`` < 0) or a split: values up to ``limit`` go to ``low``."""

    share: float
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 6, min_leaf: int = 3) -> Node:
    """Grow a tree by the largest drop in Gini impurity."""
    node = Node(float(y.mean()) if len(y) else 0.0)
    if depth == 0 or len(y) < 2 * min_leaf or node.share in (0.0, 1.0):
        return node
    best = 1e-9
    whole = len(y) * node.share * (1 - node.share)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        value, hits = x[order, f], np.cumsum(y[order])
        n_low = np.arange(1, len(y))
        n_high = len(y) - n_low
        low, high = hits[:-1], hits[-1] - hits[:-1]
        gain = whole - low * (n_low - low) / n_low - high * (n_high - high) / n_high
        gain[(value[1:] == value[:-1]) | (n_low < min_leaf) | (n_high < min_leaf)] = 0
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, node.feature, node.limit = gain[k], f, float((value[k] + value[k + 1]) / 2)
    if node.feature >= 0:
        goes_low = x[:, node.feature] <= node.limit
        node.low = train_tree(x[goes_low], y[goes_low], depth - 1, min_leaf)
        node.high = train_tree(x[~goes_low], y[~goes_low], depth - 1, min_leaf)
    return node


def is_article(node: Node, features: list[float]) -> bool:
    while node.feature >= 0:
        node = node.low if features[node.feature] <= node.limit else node.high
    return node.share >= 0.5


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of every block of the labelled pages."""
    x, y = [], []
    for page, article in LABELLED_PAGES:
        for block in blocks(page):
            x.append(block.features)
            y.append(block.text in article)
    return np.array(x), np.array(y, float)


@cache
def default_tree() -> Node:
    return train_tree(*labelled_table())


def extract(page: str | None, tree: Node) -> str:
    return " ".join(b.text for b in blocks(page or "") if is_article(tree, b.features))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``."""
    tree = default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), tree) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
