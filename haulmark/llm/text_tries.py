"""Compressed tries of whole texts, and ranges of texts by adaptive prefixes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import as_bytes, map_arrow, slices
from haulmark.session import pin

#: Bytes of a text that are compared at a time when ranges are made.
STEP = 64
SAMPLED_PER_RANGE = 16


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving: each step compares slices in C."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Node:
    """A node is reached by ``text[start:stop]`` after its parent; where texts end there, it has a terminal."""

    __slots__ = ("text", "start", "stop", "children", "least", "rows")

    def __init__(self, text: bytes, start: int, stop: int):
        self.text, self.start, self.stop = text, start, stop
        self.children: dict[int, Node] = {}
        self.least: int | None = None
        self.rows: dict[tuple, int] | None = None


class TextTrie:
    """A radix trie of whole texts.  A terminal holds the smallest id of its text and the rows that have that text.

    Edges are stretches of the texts inserted, so the trie holds each byte of a distinct text once.
    """

    def __init__(self):
        self.root = Node(b"", 0, 0)
        self.bytes = 0
        self.texts = 0

    def insert(self, text: bytes, key: int, row: tuple, n: int = 1) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text, at, len(text))
                self.bytes += len(text) - at
                node, at = child, len(text)
                break
            length = child.stop - child.start
            if text[at:at + length] == child.text[child.start:child.stop]:
                node, at = child, at + length
                continue
            same = shared_length(text[at:at + length], child.text[child.start:child.stop])
            upper = Node(child.text, child.start, child.start + same)
            child.start += same
            upper.children[child.text[child.start]] = child
            node.children[text[at]] = upper
            node, at = upper, at + same
        if node.rows is None:
            node.rows, node.least = {}, key
            self.texts += 1
        node.least = min(node.least, key)
        entry = (key, *row)
        node.rows[entry] = node.rows.get(entry, 0) + n

    def terminals(self) -> Iterator[tuple[bytes, int, dict[tuple, int]]]:
        """Text, smallest id and rows (with how often each came) of every terminal."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.rows is not None:
                yield node.text[:node.stop], node.least, node.rows
            stack.extend(node.children.values())


class Router:
    """Numbers the ranges of texts.

    A text belongs to the range of its first ``STEP`` bytes.  Where very many texts share those, they have a router of
    their own, which skips what all of them share and goes on from there: prefixes are as long as the data ask for.
    """

    def __init__(self, cuts: list[bytes], first: int):
        self.cuts, self.first = cuts, first
        self.below: dict[bytes, tuple[bytes, Router | None, int]] = {}

    def place(self, text: bytes, at: int = 0) -> tuple[int, int]:
        """Number of the range, and -- for a crowded prefix that has no router yet -- where its texts go on, else -1."""
        router = self
        while True:
            head = text[at:at + STEP]
            found = router.below.get(head)
            if found is None:
                return router.first + bisect_right(router.cuts, head), -1
            common, lower, number = found
            if lower is None:
                return number, at + STEP
            at += STEP
            if not text.startswith(common, at):
                # Not in the sample: any range will do, if it is always the same for a text.
                return number, -1
            router, at = lower, at + len(common)

    def of(self, text: bytes) -> int:
        return self.place(text)[0]


def _level(heads: list[bytes], per_range: float, first: int) -> tuple[Router, int]:
    """A router for sampled texts, given the ``STEP`` bytes of each that count here, and the next free number."""
    heads = sorted(heads)
    counts: dict[bytes, int] = {}
    for head in heads:
        counts[head] = counts.get(head, 0) + 1
    crowded = [head for head, n in counts.items() if n >= 2 * per_range and len(head) == STEP]
    rest = [head for head in heads if head not in set(crowded)]
    ranges = max(1, round(len(rest) / per_range))
    cuts = sorted({rest[len(rest) * i // ranges] for i in range(1, ranges)}) if rest else []
    router = Router(cuts, first)
    number = first + len(cuts) + 1
    for head in crowded:
        router.below[head] = (b"", None, number)
        number += 1
    return router, number


def text_ranges(texts: DataFrame, text_col: str, ranges: int, rows: int) -> tuple[Router, int]:
    """A router that cuts whole texts into about ``ranges`` ranges of like size, and how many numbers it gives out.

    Made from a sample of about ``SAMPLED_PER_RANGE`` texts per range, copies counting once; the sample only decides how
    even the ranges are.  The driver holds some dozens of bytes of each sampled text, and what a crowded prefix's texts
    share once per such prefix.
    """
    if ranges <= 1 or not rows:
        return Router([], 0), 1
    share = min(1.0, ranges * SAMPLED_PER_RANGE / rows)
    sample = pin(
        texts.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
        .sample(fraction=share, seed=41).withColumn("hash", F.xxhash64("text")).dropDuplicates(["hash"]), "text-sample")
    heads = [bytes(r[0]) for r in sample.select(F.expr(f"substring(text, 1, {STEP})")).collect()]
    per_range = max(1.0, len(heads) / ranges)
    router, numbers = _level(heads, per_range, 0)
    while True:
        def crowded(batches: Iterator[pa.RecordBatch], router: Router = router) -> Iterator[dict]:
            for batch in batches:
                for part in slices(batch):
                    placed = [(text, *router.place(text)) for text in as_bytes(part["text"])]
                    kept = [(number, text[at:]) for text, number, at in placed if at >= 0]
                    if kept:
                        yield dict(zip(("number", "rest"), zip(*kept)))

        pending = {entry[2]: (level, head) for level in _levels(router) for head, entry in level.below.items() if entry[1] is None}
        if not pending:
            return router, numbers
        rests = map_arrow(sample.select("text"), crowded, "number int, rest binary")
        # One row per crowded prefix; what the least and the greatest share, all share.
        ends = rests.groupBy("number").agg(F.min("rest").alias("low"), F.max("rest").alias("high")).collect()
        common = {r["number"]: bytes(r["low"])[:shared_length(bytes(r["low"]), bytes(r["high"]))] for r in ends}
        lengths = F.create_map(*[F.lit(x) for number, text in common.items() for x in (number, len(text))])
        found: dict[int, list[bytes]] = {}
        for r in rests.select("number", F.expr("rest").substr(lengths[F.col("number")] + 1, F.lit(STEP)).alias("head")).collect():
            found.setdefault(r["number"], []).append(bytes(r["head"]))
        for number, (level, head) in pending.items():
            lower, numbers = _level(found[number], per_range, numbers)
            level.below[head] = (common[number], lower, number)


def _levels(router: Router) -> Iterator[Router]:
    yield router
    for _, lower, _ in router.below.values():
        if lower is not None:
            yield from _levels(lower)

