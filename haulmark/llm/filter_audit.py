"""Audit of how filters interact: what each filter removes in every order in which the filters can be applied.

A document's failures are bits of a mask.  Four filters look at one text; the fifth, "identical to a smaller document's
text", needs all: texts are range-partitioned by adaptive prefixes and inserted whole into compressed tries, whose
terminals hold the smallest id.  Before that each task inserts its own texts into a trie, so of many copies one per task
is sent on.  What remains are counts per part and mask, from which all orders follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import ceil, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import as_bytes, map_arrow, slices
from haulmark.llm.text_tries import TextTrie, text_ranges

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Text of one range, and text after which a trie is emptied.
BYTES_PER_RANGE = 64_000_000
TRIE_BYTES = 32_000_000
#: Texts are sorted by so many characters within a partition, so that a trie can be emptied between two of them.
SORT_CHARS = 64

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SIGNS = b"#$%&*|"
#: Bytes that begin a code point: all but 0x80 to 0xBF.
_BEGINNING = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)

_ROW = "range int, text string, id bigint, part string, mask int, n bigint"
_FLAG = "id bigint, part string, mask int, n bigint"


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text (UTF-8) fails.

    ``bytes.split`` cuts at exactly the six ASCII white space characters.
    """
    words = text.split()
    points = len(text) - len(text.translate(None, _BEGINNING))
    mask = int(len(words) < 100)
    mask |= (100 * len(set(words)) < 80 * len(words)) << 1
    mask |= (100 * (len(text) - len(text.translate(None, _CAPITALS))) > 10 * points) << 2
    mask |= (len(text.translate(None, _SIGNS)) < len(text)) << 3
    return mask


def _local(router):
    """Rows whose copy flag is known (without text), and one row for each distinct text that a trie saw."""
    def out(trie: TextTrie) -> Iterator[dict]:
        rows, size = [], 0
        for text, least, held in trie.terminals():
            number = router.of(text)
            for (key, part, mask), n in held.items():
                if key > least:
                    rows.append((number, None, key, part, mask | COPY, n))
                else:
                    rows.append((number, text.decode(), key, part, mask, n))
                    size += len(text)
            if size >= 1_000_000 or len(rows) >= 10_000:
                yield _columns(_ROW, rows)
                rows, size = [], 0
        if rows:
            yield _columns(_ROW, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trie = TextTrie()
        for batch in batches:
            for piece in slices(batch):
                without_id = []
                for key, part, text in zip(piece["id"].to_pylist(), piece["part"].to_pylist(), as_bytes(piece["text"])):
                    if key is None:
                        without_id.append((router.of(text), None, None, part, text_mask(text), 1))
                    else:
                        trie.insert(text, key, (part, text_mask(text)))
                if without_id:
                    yield _columns(_ROW, without_id)
                if trie.bytes >= TRIE_BYTES:
                    yield from out(trie)
                    trie = TextTrie()
        yield from out(trie)

    return run


def _columns(schema: str, rows: list[tuple]) -> dict:
    return dict(zip((c.split(" ")[0] for c in schema.split(", ")), zip(*rows)))


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of consecutive ranges, sorted by range and the first characters of the text."""
    def out(trie: TextTrie) -> Iterator[dict]:
        rows = [(key, part, mask | (COPY if key > least else 0), n)
                for _, least, held in trie.terminals() for (key, part, mask), n in held.items()]
        if rows:
            yield _columns(_FLAG, rows)

    trie, last = TextTrie(), None
    for batch in batches:
        for piece in slices(batch):
            known = []
            for number, text, key, part, mask, n in zip(*(piece[c].to_pylist() for c in ("range", "text", "id", "part", "mask", "n"))):
                if text is None:
                    known.append((key, part, mask, n))
                    continue
                head = (number, text[:SORT_CHARS])
                if head != last and trie.bytes >= TRIE_BYTES:
                    yield from out(trie)
                    trie = TextTrie()
                last = head
                trie.insert(text.encode(), key, (part, mask), n)
            if known:
                yield _columns(_FLAG, known)
    yield from out(trie)


def failure_masks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id``, ``part``, ``mask`` (bit i: fails the i-th of ``FILTERS``) and ``n``, the number of rows that have all three.

    A: under 100 words; B: under 80 % of the words are distinct; C: over 10 % of the characters are A-Z; D: holds one of
    ``#$%&*|``; E: the text of a row with a smaller id, whatever its part, is identical.

    * null text: empty; null part: the empty string;
    * null id: never a copy, nor is anything a copy of it; repeated rows: counted, not copies of each other;
    * empty table: no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(max(1, size["n"]), max(partitions, ceil((size["bytes"] or 0) / BYTES_PER_RANGE)))
    router, numbers = text_ranges(rows, "text", ranges, size["n"])
    local = map_arrow(rows, _local(router), _ROW)
    # A range is one partition, or several share one if there are more of them; each is sorted and streamed.
    ranged = local.repartitionById(min(numbers, partitions), F.col("range") % min(numbers, partitions)) \
        .sortWithinPartitions("range", F.substring("text", 1, SORT_CHARS))
    return map_arrow(ranged, _flags, _FLAG)


def _orders() -> str:
    """SQL for an array with one entry per order of the filters and step in it."""
    entries = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            entries.append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, 'bit', {bit}, 'before', {before})")
            before |= bit
    return f"array({', '.join(entries)})"


def audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """One row per part, order of the five filters and step, with counts of documents within the part.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fails the step's filter, but is gone already),
    ``unique_fails`` (fails only that filter), ``good_lost`` and ``toxic_lost`` (removed here, with such a label) and
    ``shapley`` (removed by the filter, summed over all orders).  See ``failure_masks`` for the filters.

    A document is good or toxic if any of its labels says so; labels that are null, or of other documents, do not count.
    An empty table of documents gives no rows, one of labels zeros.
    """
    masks = failure_masks(df, id_col, text_col, part_col).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.select(F.col(id_col).cast("bigint").alias("id"), (F.col(quality_col) == 1).alias("good"), (F.col(toxic_col) == 1).alias("toxic")) \
        .filter("id IS NOT NULL AND (good OR toxic)").groupBy("id") \
        .agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    counts = masks.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    # At most 32 masks per part, each with 600 steps.
    steps = counts.select("part", "mask", "n", "good", "toxic", F.expr(f"inline({_orders()})"))
    fails, gone = F.expr("mask & bit != 0"), F.expr("mask & before != 0")

    def total(value: str, when: Column) -> Column:
        return F.sum(F.when(when, F.expr(value)).otherwise(0)).cast("bigint")

    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"), total("n", F.expr("mask = bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"), total("toxic", fails & ~gone).alias("toxic_lost"),
        # Of all orders, one in as many as filters are failed begins, among those, with this one.
        total(f"n * ({factorial(len(FILTERS))} div bit_count(mask))", fails).alias("shapley"),
    )
