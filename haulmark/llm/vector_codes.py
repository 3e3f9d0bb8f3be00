"""Vector codes: vectors of integers, cut into parts, each part replaced by the number of its nearest codebook entry.

Distances are compared after an integer Walsh-Hadamard transform.  A part and an entry, padded with zeros to a power of
two, keep their squared distance, times that power, under the transform.  Coefficients are taken in order of sequency:
the first ones hold most of the difference of smooth vectors, so that most entries are out, exactly, after a few of them.
Everything is done with 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import map_arrow
from haulmark.session import pin

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors compared at a time.
ROWS_AT_A_TIME = 2_048


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``size`` (a power of two), by their number of sign changes."""
    i = np.arange(size)
    odd = np.bitwise_count(i[:, None] & i[None, :]) & 1
    return np.argsort((odd[:, 1:] != odd[:, :-1]).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients, in order of sequency, of the last axis padded with zeros to a power of two."""
    width = x.shape[-1]
    size = 1 << (width - 1).bit_length()
    out = np.zeros((*x.shape[:-1], size), np.int64)
    out[..., :width] = x
    step = 1
    while step < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * step), 2, step)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(out.shape)
        step *= 2
    return out[..., sequency_order(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``x`` the nearest entry (of equals the first) and its squared distance; both are transformed."""
    size = x.shape[1]
    lead = max(1, size // 4)
    partial = np.zeros((len(x), len(entries)), np.int64)
    for j in range(lead):
        difference = x[:, j, None] - entries[None, :, j]
        partial += difference * difference
    rows = np.arange(len(x))
    guess = partial.argmin(axis=1)
    rest = x[:, lead:] - entries[guess, lead:]
    # No entry that is already further away than this one is in the end can be the nearest.
    bound = partial[rows, guess] + (rest * rest).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    sums = partial[row, entry]
    for j in range(lead, size):
        difference = x[row, j] - entries[entry, j]
        sums = sums + difference * difference
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    # Rows are in order, and so are the entries of a row.
    begins = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    best = np.minimum.reduceat(sums, begins)
    hits = np.flatnonzero(sums == best[row])
    first = hits[np.append(True, row[hits][1:] != row[hits][:-1])]
    return entry[first], best // size


def integer_parts(vectors: pa.Array, width: int, parts: int, scale: int) -> np.ndarray:
    """Vectors as integers ``floor(scale * x)``, rows x parts x ``width``; what a vector lacks counts as zero."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
    out = np.zeros((len(lengths), parts * width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out.reshape(len(lengths), parts, width)


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray, scale: int) -> Iterator[tuple]:
    """Batches, their integer parts, and index and squared distance of the nearest entry of each part."""
    parts, _, width = books.shape
    coded = transform(books)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
            piece = batch.slice(at, ROWS_AT_A_TIME)
            x = integer_parts(piece["vector"], width, parts, scale)
            turned = transform(x)
            found = [nearest(turned[:, p], coded[p]) for p in range(parts)]
            yield piece, x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _moved(vectors: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """Codebooks after one round: each entry becomes the componentwise floor of the mean of its parts."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, x, index, _ in _assigned(batches, books, scale):
            for p in range(parts):
                np.add.at(sums[p], index[:, p], x[:, p])
                counts[p] += np.bincount(index[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        if len(part):
            yield {"part": part, "entry": entry, "n": counts[part, entry], "sums": list(sums[part, entry])}

    sums = map_arrow(vectors.select("vector"), run, "part int, entry int, n bigint, sums array<bigint>")
    # As many rows as the codebooks have components.
    totals = (
        sums.select("part", "entry", "n", F.posexplode("sums").alias("place", "value")).groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(20,0)")).alias("total")).collect()
    )
    moved = books.copy()
    for r in totals:
        moved[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return moved


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id``, ``vector`` (doubles) and ``label`` of the rows whose vector holds finite numbers only."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                     F.col(label_col).alias("label"))
    # NaN is above every number.
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("vector").isNotNull() & finite)


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                  scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (parts x entries x width) of what ``usable`` gives; None if that has no rows.

    They start as the parts of the rows with the smallest ids (rows without id come last; repeated ids in order of their
    vectors) and move ``rounds`` times.  A vector shorter than the longest one is taken as if zeros followed, and all are
    if the length is no multiple of ``parts``.  Raises ValueError where a component is so large that a squared distance
    might not fit into 64 bits.
    """
    widest, largest = vectors.agg(
        F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    if widest is None:
        return None
    width = max(1, -(-widest // parts))
    size = 1 << (width - 1).bit_length()
    if largest is not None and 4 * size * width * (scale * largest + 1) ** 2 >= 2**63 / parts:
        raise ValueError(f"components up to {largest} are too large for 64-bit distances")
    # At most ``entries`` rows.
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    books = integer_parts(pa.array([r[0] for r in first], pa.list_(pa.float64())), width, parts, scale).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _moved(vectors, books, scale)
    return books


def codebooks_sha256(books: np.ndarray) -> str:
    """Of all components in decimal, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def assign_codes(vectors: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``id``, ``label``, ``code`` (two hex digits per part) and ``error`` (squared distances summed) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for piece, _, index, distance in _assigned(batches, books, scale):
            yield {"id": piece["id"], "label": piece["label"], "error": distance.sum(axis=1),
                   "code": [row.tobytes().hex() for row in index.astype(np.uint8)]}

    kind = vectors.schema["label"].dataType.simpleString()
    return map_arrow(vectors, run, f"id bigint, label {kind}, code string, error bigint")


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``id``, ``label``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable row.

    ``label_error`` is the sum of ``error`` over all rows with the same label.  At most 256 ``entries``.

    * null vector, or one that holds a null, NaN or infinity: no row;
    * null label: a label of its own; null id: coded like any other, but last when codebooks start;
    * repeated rows: each is coded and counted; equal distances: the lower entry;
    * vectors of other lengths, an empty one included: zeros follow;
    * empty table, or no usable row: no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    vectors = usable(df, id_col, vector_col, label_col)
    books = fit_codebooks(vectors, parts, entries, rounds, scale)
    if books is None:
        kind = vectors.schema["label"].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"id bigint, label {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    coded = pin(assign_codes(vectors, books, scale), "vector-codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = by_label.withColumnRenamed("label", "_of")
    # A label may hold most rows: one row per label meets them, which adaptive execution splits or broadcasts by its size.
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_of")))
    return joined.select("id", "label", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
