"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks in page order. Each block carries its
word count and link density, those of its neighbours, and where it stands
(inside an article or main element, or inside a container whose tag, role,
class or id names boilerplate), with the share of the page's words there. A
decision tree, grown here from a small labelled table, keeps or drops each
block: boilerplate goes by its tag or names, all else by words, densities and
share as well, inside an article and outside. Two kinds of container are only
doubtful, and there the tree weighs the text: a form (generated sites wrap
whole pages in one) and a name that boilerplate shares with subjects
("search-engines", "social-history"). An article inside of them is an article.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tasks import map_arrow

RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr"}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar"}
ASIDE_NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
               "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside",
               "widget", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "comment", "comments",
               "disqus", "respond", "reply", "replies", "share", "sharing", "social", "related", "recommended", "newsletter",
               "subscribe", "signup", "login", "search", "pagination", "pager", "toolbar", "legal", "copyright"}
MAIN_TAGS = {"article", "main"}

#: Names that stand for a subject too, if their other words say nothing of a page's parts.
SUBJECTS = {"search", "social", "share", "sharing", "legal", "copyright", "menu", "related", "alert", "login", "header", "nav",
            "navigation", "toolbar", "banner", "advertising", "overlay", "aside", "cookies", "reply", "recommended"}
PARTS = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "col", "column", "container",
         "content", "div", "fixed", "form", "global", "group", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list",
         "logo", "main", "media", "mobile", "network", "networks", "outer", "page", "pages", "panel", "post", "posts", "primary", "right",
         "row", "secondary", "section", "site", "sticky", "stories", "story", "text", "title", "tool", "tools", "top", "topics", "wrap", "wrapper"}
#: What a header is of, if it is the article's own.
OWN = {"article", "entry", "post", "story", "chapter", "section"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*+\"?|'[^']*+'?)|[^>])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=>/][^\s=>/]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++)))?")
_WORD = re.compile(r"[a-z0-9]+")


#: How sure it is that a container holds boilerplate: not at all, a name that may be a subject's, a form, sure.
PLAIN, NAMED, FORM, ASIDE = 0.0, 0.3, 0.6, 1.0


def _named(value: str, in_main: bool) -> float:
    """What the words of a class or id say."""
    level = PLAIN
    for token in value.split():
        words = set(_WORD.findall(token))
        names = words & ASIDE_NAMES
        if not names or (in_main and names == {"header"} and words & OWN):
            continue
        level = max(level, NAMED if names <= SUBJECTS and {w for w in words - names - PARTS if not w.isdigit()} else ASIDE)
    return level


def _aside(tag: str, attrs: str, in_main: bool) -> float:
    if tag in ASIDE_TAGS and not (tag == "header" and in_main):
        level = FORM if tag == "form" else ASIDE
    else:
        level = PLAIN
    seen = set()
    for name, *values in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), "".join(values).lower()
        if name in seen:  # the first of repeated attributes counts
            continue
        seen.add(name)
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return ASIDE
        if name == "role" and value in ASIDE_ROLES:
            level = max(level, FORM if value == "form" else ASIDE)
        if name in ("class", "id") and tag not in ("html", "body", *MAIN_TAGS):
            level = max(level, _named(value, in_main))
    return level


def blocks(page: str) -> list[dict]:
    """Text blocks of a page in order: text, words, link words, aside (how sure
    it is that they stand in boilerplate), main. Takes time and memory in
    proportion to the page, however deep it is nested."""
    found, parts, stack, opened = [], [], [], Counter()
    state = {"links": 0, "aside": PLAIN, "main": 0}

    def close():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            words = len(text.split())
            found.append({"text": text, "words": words, "links": min(state["links"], words),
                          "aside": state["aside"], "main": state["main"] > 0})
        state["links"] = 0

    def add(text):
        if text:
            parts.append(text)
            if opened["a"]:
                state["links"] += len(text.split())

    def push(tag, level):
        # An element inherits its container's level; an article only a sure one.
        stack.append((tag, level, state["aside"]))
        held = state["aside"] if tag not in MAIN_TAGS or state["aside"] == ASIDE else PLAIN
        state["aside"] = max(held, level)
        state["main"] += tag in MAIN_TAGS
        opened[tag] += 1

    def pop():
        tag, _, state["aside"] = stack.pop()
        state["main"] -= tag in MAIN_TAGS
        opened[tag] -= 1
        return tag

    at = 0
    for m in iter(lambda: _TAG.search(page, at), None):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if opened[tag]:
                if tag not in INLINE:
                    close()
                while pop() != tag:
                    pass
            elif tag == "p":
                close()
        elif tag in RAW:
            if not m[0].rstrip(">").endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag == "br":
            parts.append(" ")
        else:
            if tag not in INLINE:
                close()
                while stack and stack[-1][0] in INLINE and stack[-1][1] == PLAIN:  # left open inside the last block
                    pop()
                if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
                    pop()
            if tag not in VOID:
                push(tag, _aside(tag, m[3], state["main"] > 0))
    add(page[at:])
    close()
    return found


FEATURES = ["words", "link_density", "words_before", "density_before", "words_after", "density_after", "share", "aside", "place"]


def features(page_blocks: list[dict]) -> np.ndarray:
    """One row for each block. place: 1 inside an article or main element, -1
    outside of it on a page that has one, 0 on a page without. Blocks before and
    after are the nearest of the same kind of place. share: how many of the
    page's words outside links and boilerplate (and, for blocks outside doubtful
    containers, outside those) stand in blocks of that kind."""
    n = len(page_blocks)
    words = np.array([b["words"] for b in page_blocks], dtype=float)
    density = np.array([b["links"] / b["words"] for b in page_blocks], dtype=float)
    main = np.array([b["main"] for b in page_blocks], dtype=bool)
    aside = np.array([b["aside"] for b in page_blocks], dtype=float)
    place = np.where(main, 1.0, -1.0 if (main & (aside < ASIDE)).any() else 0.0)
    plain = np.where(aside == ASIDE, 0.0, words * (1 - density))
    near, share = np.zeros((n, 4)), np.zeros(n)
    for kind in (aside == ASIDE, aside == FORM, aside == NAMED, (aside == PLAIN) & main, (aside == PLAIN) & ~main):
        at = np.flatnonzero(kind)
        near[at[1:], 0], near[at[1:], 1] = words[at[:-1]], density[at[:-1]]
        near[at[:-1], 2], near[at[:-1], 3] = words[at[1:]], density[at[1:]]
        beside = aside == PLAIN if (aside[at] == PLAIN).any() else aside < ASIDE
        share[at] = plain[at].sum() / max(plain[beside].sum(), 1.0)
    return np.column_stack([words, density, near, share, aside, place])


#: Labelled blocks of pages without an article: words, link density, the same of
#: the block before and after, then 1 for main text and 0 for the rest.
LABELLED = [
    (90, 0.0, 8, 0.0, 70, 0.0, 1), (35, 0.05, 60, 0.0, 40, 0.0, 1), (20, 0.1, 50, 0.0, 45, 0.0, 1), (300, 0.0, 0, 0.0, 0, 0.0, 1),
    (8, 0.0, 3, 0.9, 60, 0.0, 1), (6, 0.0, 45, 0.0, 55, 0.0, 1), (12, 0.0, 30, 0.0, 3, 0.0, 1), (45, 0.0, 1, 1.0, 6, 0.0, 1),
    (25, 0.3, 40, 0.0, 35, 0.0, 1), (18, 0.0, 6, 0.0, 25, 0.0, 1), (1, 0.0, 60, 0.0, 80, 0.0, 1), (150, 0.0, 1, 0.0, 4, 1.0, 1),
    (3, 1.0, 2, 1.0, 4, 1.0, 0), (5, 0.8, 40, 0.0, 3, 1.0, 0), (10, 0.9, 5, 1.0, 60, 0.0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0),
    (30, 0.7, 20, 0.8, 10, 0.9, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0), (5, 0.0, 4, 0.5, 3, 0.0, 0), (2, 1.0, 60, 0.0, 45, 0.1, 0),
    (3, 0.0, 5, 0.0, 0, 0.0, 0), (12, 0.6, 80, 0.0, 6, 0.0, 0), (2, 0.0, 6, 0.0, 4, 0.0, 0), (40, 0.8, 30, 0.0, 20, 0.0, 0),
    (2, 0.0, 0, 0.0, 60, 0.0, 1), (3, 0.0, 2, 1.0, 90, 0.0, 1), (2, 0.0, 70, 0.0, 50, 0.0, 1), (4, 0.0, 1, 1.0, 40, 0.0, 1),
]
#: The same inside an article, with the share before the label: titles, short
#: lines and long paragraphs; link lists and cards that announce other pages.
INSIDE = [
    (90, 0.0, 8, 0.0, 70, 0.0, 1.0, 1), (35, 0.05, 60, 0.0, 40, 0.0, 0.9, 1), (300, 0.0, 0, 0.0, 0, 0.0, 1.0, 1), (8, 0.0, 0, 0.0, 60, 0.0, 1.0, 1),
    (6, 0.0, 45, 0.0, 55, 0.0, 0.8, 1), (1, 0.0, 60, 0.0, 80, 0.0, 1.0, 1), (3, 0.0, 4, 0.0, 2, 0.0, 1.0, 1), (1, 0.0, 2, 0.0, 0, 0.0, 1.0, 1),
    (2, 0.0, 6, 0.0, 4, 0.0, 0.9, 1), (12, 0.0, 30, 0.0, 0, 0.0, 0.7, 1), (4, 0.0, 0, 0.0, 5, 0.0, 1.0, 1), (10, 0.0, 0, 0.0, 0, 0.0, 1.0, 1),
    (25, 0.3, 40, 0.0, 35, 0.0, 1.0, 1), (60, 0.2, 50, 0.0, 3, 1.0, 0.9, 1), (45, 0.0, 1, 1.0, 6, 0.0, 1.0, 1), (5, 0.0, 50, 0.0, 4, 1.0, 1.0, 1),
    (8, 0.0, 0, 0.0, 2, 1.0, 1.0, 1), (5, 0.0, 3, 1.0, 70, 0.0, 1.0, 1), (60, 0.0, 40, 0.0, 50, 0.0, 0.2, 1), (6, 0.0, 45, 0.0, 55, 0.0, 0.3, 1),
    (80, 0.0, 5, 0.0, 60, 0.0, 0.15, 1), (14, 0.0, 3, 1.0, 30, 0.0, 0.9, 1), (70, 0.0, 40, 0.0, 0, 0.0, 0.2, 1), (60, 0.0, 50, 0.0, 6, 1.0, 0.3, 1),
    (45, 0.0, 6, 0.0, 8, 0.0, 0.1, 1), (90, 0.0, 0, 0.0, 0, 0.0, 0.3, 1),
    (1, 0.0, 3, 0.0, 2, 0.0, 0.7, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0.8, 1), (3, 0.0, 4, 0.0, 0, 0.0, 0.9, 1), (4, 0.0, 60, 0.0, 3, 0.0, 0.9, 1),
    (3, 0.0, 5, 0.0, 8, 0.0, 0.9, 1), (4, 0.0, 3, 0.0, 12, 0.0, 0.8, 1), (2, 0.0, 9, 0.0, 15, 0.0, 0.9, 1), (5, 0.0, 90, 0.0, 20, 0.0, 1.0, 1),
    (1, 0.0, 20, 0.0, 30, 0.0, 1.0, 1), (3, 0.0, 100, 0.0, 0, 0.0, 1.0, 1), (2, 0.0, 0, 0.0, 1, 0.0, 1.0, 1), (5, 0.0, 5, 0.0, 5, 0.0, 0.7, 1),
    (3, 1.0, 2, 1.0, 4, 1.0, 1.0, 0), (5, 0.8, 40, 0.0, 3, 1.0, 0.9, 0), (10, 0.9, 5, 1.0, 60, 0.0, 1.0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0.6, 0),
    (30, 0.7, 20, 0.8, 10, 0.9, 0.8, 0), (12, 0.6, 80, 0.0, 6, 0.0, 1.0, 0), (40, 0.8, 30, 0.0, 20, 0.0, 1.0, 0), (8, 1.0, 0, 0.0, 15, 0.0, 0.1, 0),
    (6, 1.0, 12, 0.0, 14, 0.0, 0.3, 0), (2, 1.0, 15, 0.0, 7, 1.0, 0.2, 0), (12, 0.0, 7, 1.0, 6, 1.0, 0.2, 0), (15, 0.0, 6, 1.0, 8, 1.0, 0.1, 0),
    (20, 0.0, 8, 1.0, 2, 1.0, 0.4, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0.3, 0), (14, 0.0, 9, 1.0, 0, 0.0, 0.1, 0), (12, 0.0, 4, 0.0, 5, 0.0, 0.1, 0),
    (5, 0.0, 12, 0.0, 14, 0.0, 0.15, 0), (16, 0.0, 6, 0.0, 3, 1.0, 0.2, 0), (4, 0.0, 0, 0.0, 12, 0.0, 0.1, 0), (12, 0.0, 5, 0.0, 0, 0.0, 0.2, 0),
]
#: And outside of the articles of a page: text that stands in plain containers
#: beside cards; notices, comments and link lists beside an article.
OUTSIDE = [
    (90, 0.0, 8, 0.0, 70, 0.0, 0.9, 1), (35, 0.05, 60, 0.0, 40, 0.0, 0.8, 1), (20, 0.1, 50, 0.0, 45, 0.0, 0.9, 1), (300, 0.0, 0, 0.0, 0, 0.0, 0.8, 1),
    (8, 0.0, 0, 0.0, 60, 0.0, 0.8, 1), (6, 0.0, 45, 0.0, 55, 0.0, 0.9, 1), (12, 0.0, 30, 0.0, 3, 0.0, 0.9, 1), (45, 0.0, 1, 1.0, 40, 0.0, 1.0, 1),
    (25, 0.3, 40, 0.0, 35, 0.0, 0.9, 1), (1, 0.0, 60, 0.0, 80, 0.0, 0.95, 1), (150, 0.0, 1, 0.0, 4, 1.0, 0.7, 1), (40, 0.0, 40, 0.0, 0, 0.0, 0.6, 1),
    (3, 0.0, 0, 0.0, 70, 0.0, 0.9, 1), (4, 0.0, 50, 0.0, 60, 0.0, 0.9, 1), (2, 0.0, 0, 0.0, 90, 0.0, 0.8, 1),
    (1, 0.0, 3, 0.0, 2, 0.0, 0.6, 0), (1, 0.0, 0, 0.0, 0, 0.0, 0.8, 0), (3, 0.0, 4, 0.0, 0, 0.0, 0.9, 0), (4, 0.0, 60, 0.0, 3, 0.0, 0.9, 0),
    (3, 0.0, 5, 0.0, 8, 0.0, 0.9, 0), (4, 0.0, 3, 0.0, 12, 0.0, 0.8, 0), (2, 0.0, 9, 0.0, 15, 0.0, 0.9, 0),
    (3, 1.0, 2, 1.0, 4, 1.0, 0.1, 0), (5, 0.8, 40, 0.0, 3, 1.0, 0.8, 0), (10, 0.9, 5, 1.0, 60, 0.0, 0.7, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0.0, 0),
    (30, 0.7, 20, 0.8, 10, 0.9, 0.4, 0), (12, 0.6, 80, 0.0, 6, 0.0, 0.9, 0), (40, 0.8, 30, 0.0, 20, 0.0, 0.8, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0.1, 0),
    (3, 0.0, 5, 0.0, 0, 0.0, 0.02, 0), (12, 0.0, 0, 0.0, 0, 0.0, 0.05, 0), (15, 0.0, 4, 0.0, 6, 0.0, 0.1, 0), (5, 0.0, 4, 0.5, 3, 0.0, 0.5, 0),
    (40, 0.0, 0, 0.0, 0, 0.0, 0.05, 0), (60, 0.0, 30, 0.0, 20, 0.0, 0.15, 0), (25, 0.0, 50, 0.0, 10, 0.0, 0.1, 0), (2, 0.0, 6, 0.0, 4, 0.0, 0.3, 0),
]
#: In a container with a doubtful name: paragraphs and the titles over them; short lines, button rows and cards.
UNDER_NAME = [
    (90, 0.0, 8, 0.0, 70, 0.0, 0.4, 1), (35, 0.05, 60, 0.0, 40, 0.0, 0.2, 1), (300, 0.0, 0, 0.0, 0, 0.0, 0.5, 1), (25, 0.0, 3, 0.0, 0, 0.0, 0.1, 1),
    (30, 0.2, 25, 0.0, 0, 0.0, 0.2, 1), (20, 0.0, 0, 0.0, 0, 0.0, 0.1, 1), (3, 0.0, 0, 0.0, 60, 0.0, 0.3, 1), (5, 0.0, 80, 0.0, 45, 0.0, 0.4, 1),
    (2, 0.0, 0, 0.0, 25, 0.0, 0.1, 1), (8, 0.0, 30, 0.0, 35, 0.0, 0.5, 1), (45, 0.0, 0, 0.0, 0, 0.0, 0.15, 1), (1, 0.0, 0, 0.0, 40, 0.0, 0.3, 1),
    (3, 1.0, 2, 1.0, 4, 1.0, 0.0, 0), (5, 0.8, 40, 0.0, 3, 1.0, 0.1, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0.0, 0), (12, 0.6, 30, 0.0, 6, 0.0, 0.2, 0),
    (40, 0.8, 30, 0.0, 20, 0.0, 0.3, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0.02, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0.01, 0), (6, 0.0, 4, 0.0, 5, 0.0, 0.05, 0),
    (10, 0.0, 5, 0.0, 0, 0.0, 0.05, 0), (3, 0.0, 40, 0.0, 0, 0.0, 0.1, 0), (12, 0.0, 6, 1.0, 7, 1.0, 0.1, 0), (25, 0.9, 0, 0.0, 0, 0.0, 0.1, 0),
]


def labelled_table() -> np.ndarray:
    """The labelled blocks with their places; all of them as not main text in
    boilerplate and in a form that holds little of the page; and under a doubtful name."""
    plain = [(*seen, 1.0, label) for *seen, label in LABELLED]
    # An article that holds most of the page's plain words: its blocks without links stay, whatever the words of their neighbours.
    sizes = (0, 3, 8, 14, 40, 150)
    holds = [(w, 0.0, before, 0.0, after, 0.0, share, 1) for w in (1, *sizes[1:]) for before in sizes for after in sizes for share in (0.6, 0.8, 1.0)]
    rows = [(*seen, share, PLAIN, place, label) for place, table in ((0, plain), (1, INSIDE + holds), (-1, OUTSIDE)) for *seen, share, label in table]
    doubtful = [(*seen, share, FORM, 0, label) for *seen, share, label in plain]
    doubtful += [(*seen, share, FORM, place, 0) for place in (-1, 0, 1) for share in (0.1, 0.4) for *seen, _, _ in plain]
    doubtful += [(*seen, share, NAMED, place, label) for place in (0, 1) for *seen, share, label in UNDER_NAME]
    doubtful += [(*seen, share, NAMED, -1, 0) for *seen, share, _ in UNDER_NAME]
    return np.array(rows + doubtful + [(*seen, ASIDE, place, 0) for *seen, _, place, _ in rows], dtype=float)


def grow_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 8):
    """Binary decision tree by Gini impurity: a share of 1s, or (feature, cut, low, high)."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return float(share)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] < cut
            a, b = labels[low], labels[~low]
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return float(share)
    _, f, cut = best
    low = rows[:, f] < cut
    return f, float(cut), grow_tree(rows[low], labels[low], depth - 1), grow_tree(rows[~low], labels[~low], depth - 1)


def classify(tree, rows: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(rows), tree)
    f, cut, low, high = tree
    return np.where(rows[:, f] < cut, classify(low, rows), classify(high, rows))


def trained_tree():
    table = labelled_table()
    return grow_tree(table[:, :-1], table[:, -1])


def main_text(page: str, tree) -> str:
    found = blocks(page)
    keep = classify(tree, features(found)) >= 0.5
    return " ".join(b["text"] for b, k in zip(found, keep) if k)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``.

    Character references are decoded, white space inside a block becomes one
    space, and the kept blocks are joined in page order by one space; nothing
    is capped. Quotes open a value only behind its equals sign; a quote or tag that is
    not closed reaches to the end of the page. Null and empty pages, and pages without main text, give an empty
    text. Null and repeated ids are carried as they are; other columns are
    ignored; an empty table gives no rows.
    """
    tree = trained_tree()

    def run(batches):
        for batch in batches:
            texts = [main_text(p, tree) if p else "" for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return map_arrow(narrow, run, f"{kinds}, text string, n_chars long")
