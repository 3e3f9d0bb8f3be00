"""Line deduplication: of a line that several documents hold, only the smallest document keeps it.

Hashes of line keys are range-partitioned by (hash, document, position) and sorted that way, so a line found in a third
of all documents is spread over many ranges.  A task streams its range and sees the first holder of each hash first.
Only the hash that a range begins with may have begun in an earlier one; ranges hand over one row each for that.  The
result is a compressed keep bitmap per document; texts are read again only where a bitmap is applied.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.llm.common import as_bytes, free_name, id_and_text, map_arrow, slices, text_key
from haulmark.session import pin

MIN_KEY_CHARS = 10

_LINE = "h1 bigint, h2 bigint, id bigint, row bigint, pos int"
_MARK = "kind tinyint, h1 bigint, h2 bigint, id bigint, row bigint, pos int"
_DROPPED, _OPEN, _LAST = 0, 1, 2


def _code_points(data: bytes) -> int:
    return len(data.decode("utf-8"))


def line_keys(text: bytes, min_chars: int) -> tuple[int, list[int], list[bytes]]:
    """Number of lines, and positions and keys of those long enough to be compared.

    ``bytes.strip`` and ``bytes.lower`` know exactly the ASCII white space and letters that a key is made with.
    """
    lines = text.lower().split(b"\n")
    at, keys = [], []
    for i, line in enumerate(lines):
        key = line.strip()
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or _code_points(key) >= min_chars):
            at.append(i)
            keys.append(key)
    return len(lines), at, keys


def _hash_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in (part for whole in batches for part in slices(whole)):
            hashes, ids, rows, positions = [], [], [], []
            for key, row, text in zip(batch["id"].to_pylist(), batch["row"].to_pylist(), as_bytes(batch["text"])):
                lines, at, keys = line_keys(text, min_chars)
                # Position -1 carries the number of lines instead of a hash.
                hashes.append(lines.to_bytes(8, "little") + bytes(8))
                hashes.extend(map(xxhash.xxh3_128_digest, keys))
                positions.append(-1)
                positions.extend(at)
                ids.append(np.full(len(at) + 1, key, np.int64))
                rows.append(np.full(len(at) + 1, row, np.int64))
            if not hashes:
                continue
            pair = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield {"h1": pair[:, 0], "h2": pair[:, 1], "id": np.concatenate(ids), "row": np.concatenate(rows),
                   "pos": np.array(positions, np.int32)}

    return run


def _first_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One sorted range: rows whose hash has an earlier holder, rows that the range before must decide, its last hash."""
    current, holder, opening = None, None, None
    for batch in batches:
        h1, h2, ids = (batch[c].to_numpy() for c in ("h1", "h2", "id"))
        if not len(h1):
            continue
        begins = np.ones(len(h1), bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        begins[0] = (h1[0], h2[0]) != current
        if opening is None:
            opening = (h1[0], h2[0])
        # Index of the row that began each row's hash; -1 if that was in the batch before.
        began = np.maximum.accumulate(np.where(begins, np.arange(len(h1)), -1))
        holders = np.where(began >= 0, ids[began], ids[0] if holder is None else holder)
        opens = (ids == holders) & (h1 == opening[0]) & (h2 == opening[1])
        chosen = (ids != holders) | opens
        current, holder = (h1[-1], h2[-1]), holders[-1]
        yield {"kind": np.where(opens[chosen], _OPEN, _DROPPED).astype(np.int8), "h1": h1[chosen], "h2": h2[chosen],
               "id": ids[chosen], "row": batch["row"].to_numpy()[chosen], "pos": batch["pos"].to_numpy()[chosen]}
    if current is not None:
        yield {"kind": [_LAST], "h1": [current[0]], "h2": [current[1]], "id": [holder], "row": [0], "pos": [0]}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        maps, dropped = [], []
        for lines, gone in zip(batch["n_lines"].to_pylist(), batch["gone"].to_pylist()):
            keep = np.ones(lines, bool)
            keep[gone] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 6))
            dropped.append(len(gone))
        yield {"id": batch["id"], "row": batch["row"], "n_lines": batch["n_lines"], "n_dropped": dropped, "keep_bitmap": maps}


def line_keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """Which lines each document keeps: ``id``, ``row`` (key of the text), ``n_lines``, ``n_dropped``, ``keep_bitmap``.

    Lines are split at ``\\n``; a line's key is the line without ASCII white space at its ends and with A-Z in lower
    case.  A key of at least ``min_chars`` code points that at least two ids hold loses all its lines except those of
    the smallest id.  The bitmap has one bit per line, most significant first, packed by zlib.

    * null or empty text: one empty line, kept;
    * null id: no row (it neither holds nor loses lines);
    * repeated rows or several texts under one id: they count as one document; one row per id and different text;
    * empty table: no rows.
    """
    rows = (
        id_and_text(df, id_col, text_col).filter(F.col("id").isNotNull())
        .select("id", text_key("text").alias("row"), "text")
    )
    lines = pin(map_arrow(rows, _hash_lines(min_chars), _LINE), "line-hashes")
    order = ["h1", "h2", "id", "row", "pos"]
    ranged = lines.filter("pos >= 0").repartitionByRange(*order).sortWithinPartitions(*order)
    marks = pin(map_arrow(ranged, _first_holders, _MARK), "line-marks")
    # At most one row for each range of the shuffle above: small whatever the data.
    last = marks.filter(F.col("kind") == _LAST).groupBy("h1", "h2").agg(F.min("id").alias("holder"))
    decided = (
        marks.filter(F.col("kind") == _OPEN).join(F.broadcast(last), ["h1", "h2"])
        .filter("holder < id").select("id", "row", "pos")
    )
    dropped = marks.filter(F.col("kind") == _DROPPED).select("id", "row", "pos").unionByName(decided)
    counts = lines.filter("pos < 0").select("id", "row", F.lit(None).cast("int").alias("pos"),
                                            F.col("h1").cast("int").alias("n_lines"))
    gathered = (
        dropped.withColumn("n_lines", F.lit(None).cast("int")).unionByName(counts).groupBy("id", "row")
        .agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone"))
    )
    return map_arrow(gathered, _pack, "id bigint, row bigint, n_lines bigint, n_dropped bigint, keep_bitmap binary")


@F.udf(T.StringType(), useArrow=True)
def _kept_lines(text: str | None, bitmap: bytes | None) -> str | None:
    if bitmap is None:
        return None
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join(line for line, bit in zip(lines, keep) if bit)


def kept_text(text: Column, bitmap: Column, n_dropped: Column) -> Column:
    """The text without its dropped lines; only rows that lose a line send theirs to Python."""
    changed = F.coalesce(n_dropped, F.lit(0)) > 0
    return F.when(changed, _kept_lines(F.when(changed, text), F.when(changed, bitmap))).otherwise(text)


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """All rows and columns of ``df``, with ``text_col`` reduced to its kept lines, and ``n_lines``, ``n_dropped``.

    A column of ``df`` that already has one of these names stays as it is, and the new one is called ``n_lines_1`` (or
    the first number that is free).  A null text stays null; a row without id keeps its text and counts no dropped line.
    """
    own = {c: free_name(df, f"_{c}") for c in ("id", "row", "gone", "bitmap", "here")}
    bitmaps = line_keep_bitmaps(df, id_col, text_col, min_chars).select(
        F.col("id").alias(own["id"]), F.col("row").alias(own["row"]), F.col("n_dropped").alias(own["gone"]),
        F.col("keep_bitmap").alias(own["bitmap"]),
    )
    joined = df.withColumn(own["here"], text_key(text_col)).join(
        bitmaps.hint("shuffle_hash"),
        (F.col(id_col).cast("bigint") == F.col(own["id"])) & (F.col(own["here"]) == F.col(own["row"])), "left",
    )
    text = F.col(text_col)
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        *[kept_text(text, F.col(own["bitmap"]), F.col(own["gone"])).alias(c) if c == text_col else F.col(c) for c in df.columns],
        F.coalesce(lines, F.lit(1)).cast("bigint").alias(free_name(df, "n_lines")),
        F.coalesce(own["gone"], F.lit(0)).cast("bigint").alias(free_name(df, "n_dropped")),
    )
