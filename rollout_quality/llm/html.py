"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page becomes a flat list of text blocks (text between block-level tags). A block is described by its own word
count and link density, those of the blocks before and after it, and by what the enclosing containers say of
themselves. A decision tree, grown from a small labelled table below, tells article blocks from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from rollout_quality.llm.common import ready

# Names of HTML elements by their role, and words that sites use in class, id and role attributes.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "select", "head", "title", "audio", "video")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "meter", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr")
CONTAINERS = ("article", "aside", "blockquote", "body", "center", "dialog", "div", "dl", "figure", "fieldset", "footer", "form", "header", "html", "main", "menu", "nav", "ol", "section", "table", "ul")
AROUND = ("nav", "aside", "footer", "form", "menu", "dialog", "fieldset", "button")
AROUND_WORDS = ("ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "captcha", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "dialog", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "pager", "popup", "promo", "promoted", "related", "replies", "reply", "respond", "rss", "search", "share", "sharing", "sidebar", "sidenav", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget")
MAIN_WORDS = ("article", "content", "entry", "main", "post", "story", "text")
# Elements that hold the whole page, and what makes a compound name tell of a state (has-sidebar, menu-open) of a wrapper.
PAGE = ("body", "html")
STATE_BEFORE = ("has", "with", "without", "no", "not", "layout")
STATE_AFTER = ("open", "opened", "closed", "collapsed", "expanded", "enabled", "disabled")
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "around", "main", "heading")

# Labelled blocks, one row each: the FEATURES above, then 1 for article text. Collected by hand from
# typical layouts: news and blog articles, pages without an article element, menus, footers, notices, comments.
LABELLED = (
    # paragraphs and headings inside an article element
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 1, 0, 1), (25, 0.1, 80, 0.0, 5, 0.0, 0, 1, 0, 1), (1, 0.0, 40, 0.0, 30, 0.0, 0, 1, 0, 1),
    (3, 0.0, 0, 0.0, 60, 0.0, 0, 1, 1, 1), (9, 0.0, 6, 1.0, 45, 0.0, 0, 1, 1, 1), (2, 0.0, 1, 0.0, 4, 0.0, 0, 1, 0, 1),
    (12, 0.0, 9, 0.0, 10, 1.0, 0, 1, 0, 1), (7, 1.0, 60, 0.0, 50, 0.0, 0, 1, 0, 1), (4, 0.5, 50, 0.0, 3, 0.0, 0, 1, 0, 1),
    (150, 0.02, 12, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 5, 0.0, 5, 0.0, 0, 1, 0, 1), (1, 1.0, 30, 0.0, 8, 0.0, 0, 1, 0, 1),
    (1, 0.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1), (2, 0.0, 1, 1.0, 12, 0.0, 0, 1, 0, 1), (10, 0.0, 9, 1.0, 2, 1.0, 0, 1, 1, 1),
    (6, 0.0, 3, 0.8, 1, 1.0, 0, 1, 0, 1), (4, 1.0, 2, 1.0, 5, 1.0, 0, 1, 0, 1), (3, 0.7, 9, 1.0, 2, 1.0, 0, 1, 0, 1),
    (20, 0.3, 8, 0.0, 6, 0.9, 0, 1, 0, 1), (24, 0.0, 11, 0.0, 9, 0.0, 0, 1, 0, 1), (14, 0.0, 1, 0.0, 16, 0.0, 0, 1, 0, 1),
    (8, 0.2, 0, 0.0, 1, 0.0, 0, 1, 0, 1), (2, 0.0, 3, 0.0, 2, 1.0, 0, 1, 0, 1), (30, 0.9, 4, 0.0, 5, 0.0, 0, 1, 0, 1),
    # menus, sidebars, footers, forms, notices, adverts and comments, inside an article or not
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (9, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0),
    (14, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0, 0), (40, 0.3, 60, 0.0, 20, 0.5, 1, 0, 0, 0), (6, 0.0, 3, 0.0, 90, 0.0, 1, 0, 1, 0),
    (60, 0.0, 5, 0.0, 45, 0.0, 1, 0, 0, 0), (120, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0, 0), (30, 0.0, 70, 0.0, 25, 0.0, 1, 1, 0, 0),
    (5, 1.0, 50, 0.0, 60, 0.0, 1, 1, 0, 0), (90, 0.0, 6, 0.0, 8, 0.0, 1, 1, 0, 0), (3, 0.0, 30, 0.0, 45, 0.0, 1, 1, 1, 0),
    (200, 0.0, 150, 0.0, 100, 0.0, 1, 1, 0, 0), (2, 0.0, 3, 0.0, 4, 0.0, 1, 1, 0, 0),
    # pages that name no article: text stands out by length and few links
    (60, 0.05, 3, 1.0, 75, 0.0, 0, 0, 0, 1), (90, 0.0, 60, 0.0, 80, 0.1, 0, 0, 0, 1), (35, 0.1, 70, 0.0, 40, 0.0, 0, 0, 0, 1),
    (18, 0.0, 55, 0.0, 60, 0.0, 0, 0, 0, 1), (16, 0.0, 40, 0.1, 2, 1.0, 0, 0, 0, 1), (8, 0.0, 45, 0.0, 50, 0.0, 0, 0, 0, 1),
    (7, 0.0, 2, 1.0, 70, 0.0, 0, 0, 1, 1), (3, 0.0, 4, 1.0, 45, 0.1, 0, 0, 1, 1), (4, 0.0, 60, 0.0, 50, 0.0, 0, 0, 1, 1),
    (22, 0.2, 40, 0.0, 15, 0.0, 0, 0, 0, 1), (5, 0.0, 30, 0.0, 28, 0.0, 0, 0, 0, 1), (45, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (6, 1.0, 0, 0.0, 5, 1.0, 0, 0, 0, 0), (25, 0.9, 4, 1.0, 6, 1.0, 0, 0, 0, 0),
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 1, 0), (5, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (8, 0.0, 6, 1.0, 0, 0.0, 0, 0, 0, 0),
    (3, 0.7, 60, 0.0, 2, 1.0, 0, 0, 0, 0), (10, 0.6, 20, 0.8, 9, 0.7, 0, 0, 0, 0), (6, 0.0, 1, 1.0, 4, 0.5, 0, 0, 0, 0),
    (30, 0.8, 50, 0.0, 5, 1.0, 0, 0, 0, 0), (2, 0.0, 4, 0.5, 3, 0.6, 0, 0, 0, 0), (9, 0.5, 10, 0.9, 4, 1.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 9, 0.0, 0, 0, 0, 0), (10, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 0), (7, 0.0, 12, 0.0, 0, 0.0, 0, 0, 0, 0),
    (12, 0.4, 30, 0.0, 3, 0.0, 0, 0, 0, 0), (2, 0.0, 8, 0.0, 5, 0.0, 0, 0, 0, 0), (4, 0.0, 1, 0.0, 2, 0.0, 0, 0, 1, 0),
)
DEPTH = 6
LEAST = 1

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+")
_HEADING = re.compile(r"h[1-6]$")


@dataclass
class Block:
    text: str
    words: int
    links: float
    around: bool
    main: bool
    heading: bool


def _is_around(token: str) -> bool:
    """Whether one class, id or role names something around the article."""
    said = _NAME.findall(token)
    state = len(said) > 1 and (said[0] in STATE_BEFORE or said[-1] in STATE_AFTER)
    return not state and bool(set(said) & set(AROUND_WORDS))


@cache
def _meaning(name: str, rest: str) -> tuple[bool, bool]:
    """Whether a container is around the article, and whether it says it holds the main text."""
    around, main = name in AROUND, name in ("article", "main")
    for attribute, *values in _ATTRIBUTE.findall(rest):
        attribute, value = attribute.lower(), "".join(values).lower()
        if attribute == "hidden" or attribute == "aria-hidden" and value == "true":
            around = True
        elif attribute == "style":
            around |= "display:none" in value.replace(" ", "")
        else:
            said = set(_NAME.findall(value))
            around |= name not in PAGE and any(_is_around(token) for token in value.split())
            main |= bool(said & set(MAIN_WORDS)) and name in CONTAINERS and name not in PAGE
    return around, main and not around


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order. Unclosed elements end with the container they are in."""
    found: list[Block] = []
    # The containers that are open: name, around the article, main text.
    open_: list[tuple[str, bool, bool]] = [("", False, False)]
    texts: list[str] = []
    linked, link, heading = 0, False, False

    def flush() -> None:
        nonlocal linked
        words = "".join(texts).split()
        if words:
            _, around, main = open_[-1]
            found.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), around, main, heading))
        texts.clear()
        linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            texts.append(html.unescape(raw) if "&" in raw else raw)
            linked += len(texts[-1].split()) if link else 0

    at, page = 0, page or ""
    for piece in _PIECE.finditer(page):
        text(page[at : piece.start()])
        at = piece.end()
        name = (piece["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            link = not piece["end"]
        if name in INLINE:
            continue
        if name == "br":
            texts.append(" ")
            continue
        flush()
        link = False
        if _HEADING.match(name):
            heading = not piece["end"]
        if name not in CONTAINERS:
            own = _meaning(name, piece["rest"]) if not piece["end"] and piece["rest"] else None
            # A paragraph or list item can mark itself as something around the article.
            if own and own[0]:
                open_.append((name, True, False))
            elif piece["end"] and open_[-1][0] == name:
                open_.pop()
        elif not piece["end"]:
            around, main = _meaning(name, piece["rest"])
            above = open_[-1]
            # The header of an article is part of it; a page's is not.
            around |= name == "header" and not above[2]
            open_.append((name, above[1] or around, above[2] or main))
        elif any(o[0] == name for o in open_):
            while open_.pop()[0] != name:
                pass
    text(page[at:])
    flush()
    return found


def features(found: list[Block]) -> np.ndarray:
    own = np.array([(b.words, b.links) for b in found], float)
    edge = np.zeros((1, 2))
    flags = np.array([(b.around, b.main, b.heading) for b in found], float)
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), flags])


def _impurity(y: np.ndarray) -> float:
    return 2.0 * y.mean() * (1.0 - y.mean()) * len(y) if len(y) else 0.0


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = LEAST) -> tuple:
    """A classification tree by Gini impurity: (feature, threshold, low, high) or (share of ones,)."""
    best = None
    if depth and 0 < y.sum() < len(y):
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                if min(low.sum(), (~low).sum()) >= least:
                    score = _impurity(y[low]) + _impurity(y[~low])
                    if best is None or score < best[0] - 1e-12:
                        best = (score, f, cut, low)
    if best is None or best[0] >= _impurity(y) - 1e-12:
        return (float(y.mean()),)
    _, f, cut, low = best
    return f, float(cut), grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def share(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    out, low = np.empty(len(x)), x[:, tree[0]] <= tree[1]
    out[low], out[~low] = share(tree[2], x[low]), share(tree[3], x[~low])
    return out


@cache
def trained(table: tuple = LABELLED) -> tuple:
    rows = np.array(table, float)
    return grow(rows[:, :-1], rows[:, -1])


def main_texts(pages: list[str | None]) -> list[str]:
    found = [blocks(page) for page in pages]
    rows = [features(f) for f in found if f]
    kept = (share(trained(), np.vstack(rows)) > 0.5).tolist() if rows else []
    out, at = [], 0
    for page in found:
        out.append(" ".join(b.text for b, keep in zip(page, kept[at : at + len(page)]) if keep))
        at += len(page)
    return out


def extract(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text in column `out` instead of the html.

    Null or empty html, or a page without article blocks: empty text. Very long pages are read whole. Repeated rows
    stay repeated. An input column named like `out` is replaced.
    """
    ready(pages.sparkSession)
    kept = pages.select(*[c for c in pages.columns if c in (html_column,) or c != out])
    schema = kept.drop(html_column).schema.add(out, "string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = main_texts(list(frame[html_column]))
            yield frame.drop(columns=html_column).assign(**{out: texts})[schema.names]

    return kept.mapInPandas(run, schema)
