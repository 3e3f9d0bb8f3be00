"""Main text of HTML pages as the maximum-scoring run of tokens.

A page is a sequence of tags and words.  Words score by where they stand (in a paragraph, a list entry, a link, ...),
tags score below zero, and the contiguous run with the largest sum is the content; one linear scan finds it.  The
weights are log-odds counted by Spark over all pages that mark their content themselves with ``<article>`` or ``<main>``;
a few words per place stand in where there are no such pages.  What is of a kind that never belongs to the text (menus,
forms, adverts, comments, scripts, ...) scores nothing and is left out of the run.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import free_name, id_and_text, map_arrow, slices

#: Up to the end of a tag, never into the next one, and never tried again from the middle: scanning stays linear.
_ATTRIBUTES = r"(?:\"[^\"]*+\"|'[^']*+'|[^'\"<>]|<(?![a-z/!?]))*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|select)\b" + _ATTRIBUTES + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][\w:-]*+)(?P<attributes>" + _ATTRIBUTES + r")>"
    r"|<[!?/][^<>]*+>"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_NAMING = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Element names of HTML by what they mean for the text, and words that name page furniture.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br".split())
_FURNITURE = frozenset("nav aside form footer header button menu dialog head".split())
_PLACES = ("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption caption article section main div body").split()
_TAGS = frozenset([*_PLACES, *_INLINE, *"ul ol dl table thead tbody tr figure hr picture video audio".split()])
_MARKS = frozenset(["article", "main"])
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies consent gdpr notice notices "
    "alert banner comment comments reply replies discussion disqus share sharing social related recommended newsletter "
    "subscribe subscription signup login popup modal overlay widget pagination pager copyright search".split())
#: Of these, words that the text itself is named by as well: inside a marked content they say nothing.
_AMBIGUOUS = frozenset(
    "alert banner consent copyright cookie cookies discussion gdpr header masthead menu notice notices overlay promotion "
    "reply replies search side signup subscription".split())
_LIMITS = frozenset("ul ol table td th article section div main nav aside".split())
_WHOLE_PAGE = frozenset("html body article main".split())
_NOT = frozenset("no has with without".split())

#: Words assumed inside and outside the content for each place, before anything is counted.
_PRIOR_IN, _PRIOR_OUT, _LINK_IN, _LINK_OUT = 20.0, 5.0, 5.0, 10.0
#: Limits of a word's and a tag's weight, and the weight of a mark's own tags: a few words do not reach across them.
_WORD_LIMIT, _TAG_LEAST, _TAG_MOST, _MARK_TAG = 2.0, -2.0, -0.1, -8.0
#: A tag of the page's furniture: a menu parts two runs of words, a small advert does not.
_FURNITURE_TAG = -0.3


def _is_furniture(name: str, attributes: str, marked: bool) -> str:
    """Why an element never belongs to the text ("" if it may); the header of a marked content does."""
    if name in _FURNITURE and not (marked and name == "header"):
        return name
    if not attributes or name in _WHOLE_PAGE:
        return ""
    for groups in _NAMING.findall(attributes):
        for token in "".join(groups).lower().split():
            words = re.split(r"[-_]+", token)
            if marked:
                # Named by nothing else: "search-space" is about a space.
                named = all(w in _NAMES for w in words) and not _AMBIGUOUS.issuperset(words)
            else:
                named = words[0] not in _NOT and not _NAMES.isdisjoint(words)
            if named and not (marked and "header" in words):
                return token
    return ""


class _Open:
    """The open elements, with what is asked about them counted: no step looks through the whole stack."""

    def __init__(self):
        self.stack: list[list[str]] = []
        self.places = {}  # of each name, and of all limits and furniture, where on the stack
        self.limits: list[int] = []
        self.furniture: list[int] = []
        self.texts: list[str] = []
        self.marks = self.parted = 0

    def push(self, name: str, why: str) -> None:
        at = len(self.stack)
        self.stack.append([name, why])
        self.places.setdefault(name, []).append(at)
        if name in _LIMITS:
            self.limits.append(at)
        if why:
            self.furniture.append(at)
        elif name in _MARKS:
            self.marks += 1
        if name in _PLACES:
            self.texts.append(name)
        self.parted += name in _FURNITURE or "comment" in why

    def pop(self) -> str:
        name, why = self.stack.pop()
        at = len(self.stack)
        self.places[name].pop()
        for held in (self.limits, self.furniture):
            if held and held[-1] == at:
                held.pop()
        self.marks -= not why and name in _MARKS
        if name in _PLACES:
            self.texts.pop()
        self.parted -= name in _FURNITURE or "comment" in why
        return name

    def shut(self, name: str) -> None:
        if self.places.get(name):
            while self.pop() != name:
                pass

    def shut_from_last(self, name: str) -> None:
        """Close the last ``name`` and all in it, unless an element in between keeps it open."""
        at = self.places.get(name)
        if at and not (self.limits and self.limits[-1] > at[-1]):
            for _ in range(len(self.stack) - at[-1]):
                self.pop()

    def forgive(self) -> None:
        """What is open is no furniture, whatever the page calls it."""
        for at in self.furniture:
            self.marks += self.stack[at][0] in _MARKS
            self.stack[at][1] = ""
        self.furniture = []


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool, str]]:
    """(tag, place, in a link, inside a mark, text) of each tag and stretch of text; in furniture the place is empty."""
    opened = _Open()
    for match in _TOKEN.finditer(page):
        text = match["text"]
        if text is None:
            name = (match["name"] or "").lower()
            if not name:
                continue
            # A mark that is itself furniture, as an article of the comments is, does not count.
            marked, shut = opened.marks > 0, bool(opened.furniture)
            if match["end"]:
                opened.shut(name)
            elif name not in _VOID:
                # A new block ends an open paragraph, a new list entry the one before.
                if name == "li" and opened.places.get("li"):
                    opened.shut_from_last("li")
                elif name not in _INLINE:
                    opened.shut_from_last("p")
                named = _is_furniture("div" if name in _MARKS else name, match["attributes"], marked)
                if name in _MARKS and not named and not opened.parted:
                    # Whatever the page calls the elements around it: this is its content.
                    opened.forgive()
                opened.push(name, named)
            shut = shut or bool(opened.furniture)
            yield name, "" if shut else name, False, marked, ""
            continue
        place = "" if opened.furniture else opened.texts[-1] if opened.texts else "body"
        yield "", place, bool(opened.places.get("a")), opened.marks > 0, text


def _count_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Words by place, and tags, inside and outside the marks of pages that have one."""
    for batch in batches:
        inside, outside = Counter(), Counter()
        for part in slices(batch):
            for page in part["text"].to_pylist():
                own = Counter(), Counter()
                for tag, place, link, marked, text in tokens(page or ""):
                    if place:
                        name = f"{place} {int(link)}" if not tag else f"<{tag}" if tag in _TAGS else "<"
                        own[0 if marked else 1][name] += len(text.split()) if not tag else 1
                if own[0]:
                    inside.update(own[0])
                    outside.update(own[1])
        keys = sorted({*inside, *outside})
        yield {"key": keys, "inside": [inside[k] for k in keys], "outside": [outside[k] for k in keys]}


def page_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Weight of each place ("p 0": words of a paragraph, "p 1": of a link in one) and of each tag ("<p").

    As many entries as there are known element names, whatever the pages.
    """
    rows = map_arrow(id_and_text(pages, id_col, html_col), _count_pages, "key string, inside bigint, outside bigint")
    counted = {r["key"]: (r["inside"] or 0, r["outside"] or 0) for r in
               rows.groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()}
    weights = {}
    for place in _PLACES:
        for link, (prior_in, prior_out) in enumerate([(_PRIOR_IN, _PRIOR_OUT), (_LINK_IN, _LINK_OUT)]):
            inside, outside = counted.get(f"{place} {link}", (0, 0))
            odds = np.log((inside + prior_in) / (outside + prior_out))
            weights[f"{place} {link}"] = float(np.clip(odds, -_WORD_LIMIT, _WORD_LIMIT))
    for tag in ["", *sorted(_TAGS)]:
        inside, outside = counted.get(f"<{tag}", (0, 0))
        weights[f"<{tag}"] = float(np.clip(np.log((inside + 1) / (outside + 1)), _TAG_LEAST, _TAG_MOST))
    return weights | {f"<{tag}": _MARK_TAG for tag in _MARKS}


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest positive sum, the first and shortest of equals; (0, 0) if none."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, bounds = total, (start, i + 1)
    return bounds


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Text of the best run: white space of a block as one blank, blocks joined by a line break."""
    found = list(tokens(page or ""))
    scores = [
        (weights.get(f"<{tag}", weights["<"]) if place else _FURNITURE_TAG) if tag
        else len(text.split()) * weights[f"{place} {int(link)}"] if place else 0.0
        for tag, place, link, _, text in found
    ]
    start, stop = best_run(scores)
    blocks: list[list[str]] = [[]]
    for tag, place, _, _, text in found[start:stop]:
        if tag == "br":
            blocks[-1].append(" ")
        elif tag and tag not in _INLINE:
            blocks.append([])
        elif place:
            blocks[-1].append(html.unescape(text))
    lines = (" ".join("".join(block).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame, weights: dict[str, float], id_col: str = "page_id", html_col: str = "html",
                 text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in one more column, ``text_col``.

    A column of ``pages`` that has this name stays as it is, and the text is in ``text_1`` (or the first number that is free).
    Null, empty or content-free pages give an empty text.  Rows are independent: null ids and repeated rows get their
    text like all others; an empty table gives no rows.
    """
    @F.pandas_udf("string")
    def text(column):
        return column.map(lambda page: main_text(page, weights))

    return pages.withColumn(free_name(pages, text_col), text(F.col(html_col)))
