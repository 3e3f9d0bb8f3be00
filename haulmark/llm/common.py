"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Entries after which a worker's word table starts anew, so that its memory is bounded.
WORD_TABLE_LIMIT = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, under fixed names: ``id`` (bigint) and ``text``.

    A column that already is as it should be is taken as it is: an alias that changes nothing would make two plans of
    the same table differ, and their exchange would not be shared.
    """
    def fixed(column: str, name: str, kind: T.DataType) -> Column:
        same = column == name and df.schema[column].dataType == kind
        return F.col(column) if same else F.col(column).cast(kind).alias(name)

    return df.select(fixed(id_col, "id", T.LongType()), fixed(text_col, "text", T.StringType()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with a number after it if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    number, free = 0, name
    while free.lower() in taken:
        number += 1
        free = f"{name}_{number}"
    return free


def text_key(text: Column | str) -> Column:
    """Tells rows of one id but different texts apart (a null text counts as empty)."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of about ``size`` bytes of ``column`` or one row: what is unpacked at a time.

    Of a column of arrays, ``size`` elements.
    """
    values = batch[column]
    lengths = pc.list_value_length(values) if pa.types.is_nested(values.type) else pc.binary_length(values.cast(pa.binary()))
    lengths = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, object]]],
              schema: str) -> DataFrame:
    """``mapInArrow`` for a function that yields one dict of columns at a time."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            arrays = [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        # Spark keeps the worker for a while: what it freed goes back to the machine.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, struct)


class WordHashes(dict):
    """64-bit hash of a word, computed once per worker for each word of a bounded table."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_TABLE_LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    factor = np.uint64(seed | 1)
    for i in range(size):
        out = out * factor + words[i:i + count]
    return mix(out)
