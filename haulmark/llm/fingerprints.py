"""Document fingerprints by winnowing.

Rolling hashes of all ``GRAM``-character runs; of every ``WINDOW`` consecutive ones the smallest is kept, of equals the
rightmost, with its position.  So two texts that share ``GRAM + WINDOW - 1`` characters anywhere share a kept hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import id_and_text, map_arrow, mix, slices
from haulmark.operators.ordered import bin_of

GRAM, WINDOW = 16, 85
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: Rows of one key range of the order, and the most ranges (and so boundaries held by the driver).
ROWS_PER_RANGE, MAX_RANGES = 2_000, 8_192

_PAIR = ("id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, "
         "near_next double")


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, as many as 2**bits."""
    tables = []
    for base in (_BASE, _INVERSE):
        powers = np.full(1 << bits, base, np.uint64)
        powers[0] = 1
        tables.append(np.multiply.accumulate(powers))
    return tables[0], tables[1]


def rolling_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` code points, from running sums of a polynomial modulo 2**64."""
    count = len(points) - size + 1
    powers, inverses = _powers(max(16, int(len(points)).bit_length()))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points * powers[:len(points)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inverses[:count])


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept 32-bit hashes and their positions, by position; a text shorter than a gram is hashed as a whole."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes = rolling_hashes(points, min(gram, len(points))) >> np.uint64(32)
    # Rightmost of equals: positions count down in the lower half.
    last = np.uint64(len(hashes) - 1)
    low = (hashes << np.uint64(32)) | (last - np.arange(len(hashes), dtype=np.uint64))
    width, span = min(window, len(hashes)), 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:span - width], low[width - span:])
    kept = low[np.append(True, low[1:] != low[:-1])]
    return (kept >> np.uint64(32)).astype(np.uint32), (last - (kept & np.uint64(0xFFFFFFFF))).astype(np.int64)


def as_string(kept: tuple[np.ndarray, np.ndarray]) -> str:
    """Hash (hex) and position of each kept gram: ``0f3a9c01@17 ...``."""
    return " ".join(f"{h:08x}@{p}" for h, p in zip(kept[0].tolist(), kept[1].tolist()))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared kept hashes over all kept hashes of both (as sets); of two empty fingerprints 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, b = np.unique(a), np.unique(b)
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int((a[at] == b).sum())
    return both / (len(a) + len(b) - both)


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                window: int = WINDOW) -> DataFrame:
    """``id``, ``n_chars`` and kept ``hashes`` and ``positions`` (arrays) of every row's whole text.

    A null text counts as empty and has an empty fingerprint; a text of fewer than ``gram`` characters has the hash of
    the whole.  One row per input row, repeated rows and null ids included; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part["text"].to_pylist()]
                kept = [winnow(t, gram, window) for t in texts]
                yield {"id": part["id"], "n_chars": [len(t) for t in texts],
                       "hashes": [h.astype(np.int64) for h, _ in kept], "positions": [p for _, p in kept]}

    return map_arrow(id_and_text(df, id_col, text_col), run,
                     "id bigint, n_chars bigint, hashes array<bigint>, positions array<bigint>")


def _ranges(ids: DataFrame, rows_per_range: int) -> list[tuple[int]]:
    """Lower bounds of all ranges of the id order but the first, from a sample of bounded size."""
    rows = ids.count()
    ranges = min(MAX_RANGES, rows // rows_per_range)
    if ranges < 2:
        return []
    sample = sorted(r[0] for r in ids.sample(fraction=min(1.0, 32 * ranges / rows), seed=11).collect())
    return [(x,) for x in sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)})] if sample else []


def compare_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                       window: int = WINDOW, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each document, its edited text and the next document, compared by fingerprint.

    The edited text has the last quarter of the characters replaced by the first as many of the next document (all if it
    has fewer), in ascending order of id, after the last the first.  Gives ``id``, ``n_chars``, ``edited`` (text),
    ``fingerprint``, ``edited_fingerprint`` (strings), ``near_edited`` and ``near_next``.

    The order is cut into ranges of ids; a range is streamed in order by one task, and the first row of the next range is
    sent along with it.

    * null text: empty;
    * repeated ids: ordered by text (null first); a document alone in its table is followed by itself;
    * null id: not in the order; compared with itself, unedited;
    * empty table: no rows.
    """
    rows = id_and_text(df, id_col, text_col)
    ordered = rows.filter("id IS NOT NULL")
    ids = ordered.select("id")
    cuts = _ranges(ids, rows_per_range)
    number = bin_of([F.col("id")], cuts, [ids.schema["id"].dataType])
    firsts = sorted((r["bin"], r["first"]) for r in ids.groupBy(number.alias("bin")).agg(F.min("id").alias("first")).collect())
    # One entry per range: the first id after it, around the end.
    heads = [(firsts[(i + 1) % len(firsts)][1], firsts[i][0]) for i in range(len(firsts))]
    own = ordered.select(number.alias("bin"), F.lit(False).alias("copy"), "id", "text")
    # At most MAX_RANGES rows.
    copies = ordered.join(F.broadcast(df.sparkSession.createDataFrame(heads, "id bigint, bin int")), "id").select(
        "bin", F.lit(True).alias("copy"), "id", "text")
    lone = rows.filter("id IS NULL").select(F.lit(-1).alias("bin"), F.lit(False).alias("copy"), "id", "text")
    streamed = own.unionByName(copies).repartition("bin").sortWithinPartitions("bin", "copy", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        waiting = None
        for batch in batches:
            for part in slices(batch):
                out = []
                for place, copy, key, text in zip(*(part[c].to_pylist() for c in ("bin", "copy", "id", "text"))):
                    text = text or ""
                    kept = winnow(text, gram, window)
                    if waiting is not None:
                        out.append(_compared(*waiting[1:], text, kept, gram, window))
                    if key is None:
                        out.append(_compared(key, text, kept, text, kept, gram, window))
                    waiting = None if copy or key is None else (place, key, text, kept)
                if out:
                    yield dict(zip(("id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited",
                                    "near_next"), zip(*out)))

    # A copy that follows another copy finds nobody waiting.
    return map_arrow(streamed, run, _PAIR).unionByName(map_arrow(lone, run, _PAIR))


def _compared(key: int | None, text: str, kept: tuple, following: str, next_kept: tuple, gram: int, window: int) -> tuple:
    share = len(text) // 4 if key is not None else 0
    edited = text[:len(text) - share] + following[:share]
    edited_kept = winnow(edited, gram, window)
    return (key, len(text), edited, as_string(kept), as_string(edited_kept), likeness(kept[0], edited_kept[0]),
            likeness(kept[0], next_kept[0]))
