"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of ``m`` characters that occurs with at most ``k`` edits shares at least ``m - q + 1 - k * q`` q-grams with the
place where it occurs, and their diagonals (place in the document minus place in the item) lie within ``k`` of each
other.  So diagonals are counted in bands of ``2 (k + 1)`` that overlap by half; regions whose band reaches the bound are
aligned, and stay if the distance is within ``k``.

Parts of items are windows of ``part_chars`` characters at every offset of an item, each with the budget of its own
length.  They need no index of their own: the item's shared q-grams are counted in bands of the window's budget, within
the window's offsets, and all windows of a band that reach the bound are aligned together.

The benchmark is the query set: it is read in blocks of bounded size, and each block's q-gram index is applied to all
documents where they are read; documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import id_and_text, map_arrow, mix, slices

Q = 8
MAX_EDIT_SHARE = 0.08
#: Characters of an item that count as a leaked part.
PART_CHARS = 100
#: Characters of benchmark text held in one index.
BLOCK_CHARS = 4_000_000
#: Characters of a document looked at together; the overlap covers the longest item of a block.
PIECE_CHARS = 1_000_000
_BITS = 22

_MATCH = "id bigint, item bigint, start bigint, stop bigint, edits int"


def normalise(text: str) -> np.ndarray:
    """Code points of the text in lower case and with every ASCII white space as a blank, as many as the text has."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    points = np.frombuffer(lower.encode("utf-32-le"), "<u4").astype(np.uint64)
    return np.where((points >= 9) & (points <= 13), np.uint64(32), points)


def _codes(points: np.ndarray, q: int) -> np.ndarray:
    out = np.zeros(max(0, len(points) - q + 1), np.uint64)
    for i in range(q if len(out) else 0):
        out = out * np.uint64(0x100000001B3) + points[i:i + len(out)]
    return mix(out)


def edit_budget(length: int, share: float) -> int:
    """Edits allowed for an item of this length."""
    return int(length * share)


def last_row(a: np.ndarray, b: np.ndarray, free_start: bool) -> np.ndarray:
    """Edits between all of ``a`` and each prefix of ``b``, or with a free start the best part of ``b`` that ends there."""
    steps = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64) if free_start else steps.copy()
    for i, symbol in enumerate(a, 1):
        following = np.minimum(row[1:] + 1, row[:-1] + (b != symbol))
        row = np.minimum.accumulate(np.append(i, following) - steps) + steps
    return row


def least_edits(windows: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Edits of each window (a row) at its best place in its own region (the same row)."""
    steps = np.arange(regions.shape[1] + 1, dtype=np.int32)
    row = np.zeros((len(windows), len(steps)), np.int32)
    for i in range(windows.shape[1]):
        following = np.empty_like(row)
        following[:, 0] = i + 1
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (regions != windows[:, i:i + 1]), out=following[:, 1:])
        row = np.minimum.accumulate(following - steps, axis=1) + steps
    return row.min(axis=1)


def align(item: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """Best place of the item in the region: (start, stop, edits), or None if it takes more than ``budget`` edits."""
    row = last_row(item, region, True)
    stop = int(row.argmin())
    edits = int(row[stop])
    if edits > budget:
        return None
    back = last_row(item[::-1], region[max(0, stop - len(item) - budget):stop][::-1], False)
    return stop - int(np.flatnonzero(back == edits)[0]), stop, edits


@dataclass
class GramIndex:
    """One block of items: which q-gram lies where in which item."""

    items: list[int]
    points: list[np.ndarray]
    budgets: np.ndarray
    needed: np.ndarray

    def __init__(self, rows: list[tuple[int, str]], q: int, share: float, part_chars: int | None = None):
        self.q = q
        self.items = [item for item, _ in rows]
        self.points = [normalise(text) for _, text in rows]
        lengths = np.array([len(p) for p in self.points])
        # An item too short for the lemma at its budget gets the largest budget at which the bound still is positive.
        self.budgets = np.minimum([edit_budget(n, share) for n in lengths], np.maximum(0, (lengths - q) // q))
        self.needed = np.maximum(1, lengths - q + 1 - self.budgets * q)
        self.part_chars = part_chars
        if part_chars is not None:
            if part_chars < q:
                raise ValueError(f"part_chars must be at least {q}, not {part_chars}")
            self.part_budget = min(edit_budget(part_chars, share), (part_chars - q) // q)
            self.part_needed = max(1, part_chars - q + 1 - self.part_budget * q)
            self.divisible = lengths > part_chars
        self.longest = int((lengths + self.budgets).max())
        self.short = [i for i in range(len(rows)) if lengths[i] < q]
        codes = [_codes(p, q) for p in self.points]
        flat = np.concatenate(codes)
        owner = np.repeat(np.arange(len(rows)), [len(c) for c in codes])
        offset = np.concatenate([np.arange(len(c)) for c in codes])
        order = np.argsort(flat, kind="stable")
        self.codes, self.first = np.unique(flat[order], return_index=True)
        self.counts = np.diff(np.append(self.first, len(flat)))
        self.owner, self.offset = owner[order], offset[order]
        # Items follow each other, a window apart.
        self.begins = np.append(0, np.cumsum(lengths + (part_chars or 0))[:-1])
        self.stamp = np.zeros(len(flat), np.int64)
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[self.codes >> np.uint64(64 - _BITS)] = True

    def shared(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, diagonal, place among all q-grams of the items) of all q-grams that an item shares with the text."""
        none = np.zeros(0, np.int64)
        codes = _codes(points, self.q)
        places = np.flatnonzero(self.bitmap[codes >> np.uint64(64 - _BITS)])
        if not len(places):
            return none, none, none
        gram = np.minimum(np.searchsorted(self.codes, codes[places]), len(self.codes) - 1)
        same = self.codes[gram] == codes[places]
        places, gram = places[same], gram[same]
        counts = self.counts[gram]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        posting = np.repeat(self.first[gram], counts) + within
        return self.owner[posting], np.repeat(places, counts) - self.offset[posting], posting

    def regions(self, item: np.ndarray, diagonal: np.ndarray, budgets: np.ndarray,
                needed: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first and last possible diagonal) of all bands that meet their item's bound."""
        # Every item with too few shared q-grams in the whole text is out before bands are counted.
        enough = np.bincount(item, minlength=len(self.items)) >= needed
        some = enough[item]
        if not some.any():
            return
        item, diagonal = item[some], diagonal[some]
        step = budgets[item] + 1
        band = np.floor_divide(diagonal, step)
        # A band is (band, band + 1): each diagonal lies in two.
        stride = int(band.max() - band.min()) + 3
        low = int(band.min()) - 1
        key = item * stride + (band - low)
        keys, sizes = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        owners = keys // stride
        for k, i in zip(keys[sizes >= needed[owners]].tolist(), owners[sizes >= needed[owners]].tolist()):
            start = (k % stride + low) * int(budgets[i] + 1)
            yield i, start, start + 2 * int(budgets[i] + 1) - 1

    def holds_window(self, item: np.ndarray, posting: np.ndarray) -> np.ndarray:
        """Which q-grams are of an item that shares enough different ones within some window, wherever in the text."""
        # The last of equal places stays: each q-gram of an item counts once.
        order = np.arange(len(posting))
        self.stamp[posting] = order
        once = self.stamp[posting] == order
        enough = self.divisible & (np.bincount(item[once], minlength=len(self.items)) >= self.part_needed)
        once &= enough[item]
        at = np.sort(self.begins[item[once]] + self.offset[posting[once]])
        last = at[self.part_needed - 1:]
        near = last - at[:len(last)] <= self.part_chars - self.q
        enough[:] = False
        enough[np.searchsorted(self.begins, last[near], "right") - 1] = True
        return enough[item]

    def part_in(self, piece: np.ndarray, i: int, low: int, high: int, offsets: np.ndarray) -> tuple[int, int, int] | None:
        """Place of all windows of the item that lie in a band whose shared q-grams have these offsets, and its edits."""
        size, budget, item = self.part_chars, self.part_budget, self.points[i]
        before = np.append(0, np.cumsum(np.bincount(offsets, minlength=len(item))))
        begins = np.arange(len(item) - size + 1)
        begins = begins[before[begins + size - self.q + 1] - before[begins] >= self.part_needed]
        if not len(begins):
            return None
        # What lies outside the text equals no character.
        width = high - low + 1 + size + 2 * budget
        at = (low - budget + begins)[:, None] + np.arange(width)
        regions = np.where((at >= 0) & (at < len(piece)), piece[np.clip(at, 0, len(piece) - 1)], np.uint64(1 << 32))
        edits = least_edits(np.lib.stride_tricks.sliding_window_view(item, size)[begins], regions)
        found = begins[edits <= budget]
        if not len(found):
            return None
        start, stop = len(piece), 0
        for begin in {int(found[0]), int(found[-1])}:
            first = max(0, low - budget + begin)
            place = align(item[begin:begin + size], piece[first:high + begin + size + budget + 1], budget)
            start, stop = min(start, first + place[0]), max(stop, first + place[1])
        return start, stop, int(last_row(item, piece[start:stop], False)[-1])

    def matches(self, points: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Best place (start, stop, edits) of each item found: of the whole item, or else of a part of it."""
        best: dict[int, tuple[int, int, int]] = {}
        parts: dict[int, tuple[int, int, int]] = {}

        def note(of: dict[int, tuple[int, int, int]], i: int, at: int, found: tuple[int, int, int]) -> None:
            place = (at + found[0], at + found[1], found[2])
            of[i] = min(of.get(i, place), place, key=lambda p: (p[2], p[0]))

        for at in range(0, max(1, len(points)), PIECE_CHARS):
            piece = points[at:at + PIECE_CHARS + 2 * self.longest]
            item, diagonal, posting = self.shared(piece)
            for i, low, high in self.regions(item, diagonal, self.budgets, self.needed):
                low = max(0, low - int(self.budgets[i]))
                region = piece[low:high + len(self.points[i]) + int(self.budgets[i]) + 1]
                found = align(self.points[i], region, int(self.budgets[i]))
                if found:
                    note(best, i, at + low, found)
            if self.part_chars is not None and len(item):
                some = self.holds_window(item, posting)
                some[np.isin(item, list(best))] = False
                item, diagonal, offset = item[some], diagonal[some], self.offset[posting[some]]
                same = np.ones(len(self.items), np.int64)
                for i, low, high in self.regions(item, diagonal, same * self.part_budget, same * self.part_needed):
                    inside = (item == i) & (diagonal >= low) & (diagonal <= high)
                    found = self.part_in(piece, i, low, high, offset[inside])
                    if found:
                        note(parts, i, at, found)
        best = parts | best
        if self.short:
            text = points.astype("<u4").tobytes().decode("utf-32-le")
            for i in self.short:
                start = text.find(self.points[i].astype("<u4").tobytes().decode("utf-32-le"))
                if start >= 0:
                    best[i] = (start, start + len(self.points[i]), 0)
        return best


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one block in the driver at a time."""
    block, size = [], 0
    for row in benchmark.filter("id IS NOT NULL AND length(text) > 0").distinct().toLocalIterator():
        block.append((row["id"], row["text"]))
        size += len(row["text"])
        if size >= block_chars:
            yield sorted(block)
            block, size = [], 0
    if block:
        yield sorted(block)


def find_items(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", q: int = Q, share: float = MAX_EDIT_SHARE,
               block_chars: int = BLOCK_CHARS, part_chars: int | None = None) -> DataFrame:
    """Items that occur in documents: ``id``, ``item``, ``start``, ``stop`` (code points) and ``edits``.

    An item occurs if some part of the document differs from the whole item by at most ``share`` of its length in
    insertions, deletions and substitutions; case is ignored and any ASCII white space equals a blank.  Items below
    about ``q / (1 - share * q)`` characters get a smaller budget, items below ``q`` must occur exactly.  One row per
    document and item, the best place (of equals the first).

    With ``part_chars`` an item also occurs if any ``part_chars`` consecutive characters of it do, by the budget of that
    length; items that are not longer occur only whole.  A document that holds the whole item gets the whole item's row;
    else the row spans all of the item's windows found at one place, and ``edits`` is their distance from the whole item,
    so it is above the item's budget.

    * null or empty texts and items, and items without id: never match;
    * a document without id: its rows have a null id;
    * repeated documents give their rows again; of several texts under one item id each is looked for;
    * empty tables: no rows.
    """
    docs = id_and_text(df, id_col, text_col).filter("length(text) > 0")
    parts = []
    for rows in _blocks(id_and_text(benchmark, item_id, item_text), block_chars):
        parts.append(map_arrow(docs, _search(rows, q, share, part_chars), _MATCH))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], _MATCH)


def _search(rows: list[tuple[int, str]], q: int, share: float, part_chars: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        index = GramIndex(rows, q, share, part_chars)
        for part in (part for batch in batches for part in slices(batch)):
            found = []
            for doc, text in zip(part["id"].to_pylist(), part["text"].to_pylist()):
                found += [(doc, index.items[i], *place) for i, place in index.matches(normalise(text)).items()]
            ids, items, starts, stops, edits = zip(*found) if found else ((),) * 5
            yield {"id": ids, "item": items, "start": starts, "stop": stops, "edits": edits}

    return run


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options: object) -> DataFrame:
    """Rows of ``df`` in which no benchmark item occurs (``options`` as in ``find_items``), all columns as they are.

    Rows of one id go together; rows without id stay.
    """
    hit = find_items(df, benchmark, id_col, text_col, **options).select(F.col("id").alias("_hit")).distinct()
    return df.join(hit, df[id_col].cast("bigint") == hit["_hit"], "left_anti")
