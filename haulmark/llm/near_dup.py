"""Near-duplicate classes by min-max hashing of word shingles.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so 48 permutations fill
96 values.  32 bands of 3 values each find a pair of similarity 0.75 with probability 1 - (1 - 0.75^3)^32, all but
3 in 100 million.  Candidates are confirmed on the full shingle sets.

Documents with the same set are one class from the start.  A band's bucket is not expanded into pairs: its members are
compared with its first member, components are formed, and only members that then still are in different components are
compared further, eight times as many members of the bucket each round, and only where their sets can be similar enough.
So a bucket of near copies costs about one comparison per member, and yet no link between components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.llm.common import WordHashes, as_bytes, gram_hashes, id_and_text, map_arrow, mix, slices
from haulmark.llm.components import merge_components, relabel
from haulmark.session import pin

SHINGLE_WORDS = 5
MIN_PERCENT = 75
PERMUTATIONS, BAND_ROWS = 48, 3
_BANDS = 2 * PERMUTATIONS // BAND_ROWS

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64)
#: Shingles hashed at a time.
_AT_ONCE = 500_000


def shingle_set(text: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of the whole sequence if the text has fewer words."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    if len(words) < size:
        return gram_hashes(words, len(words), seed=2 * len(words) + 1)
    return np.unique(gram_hashes(words, size))


def min_max_bands(sets: list[np.ndarray]) -> np.ndarray:
    """One row of band keys per non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    values = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for i, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS)):
        permuted = flat * factor + shift
        values[:, 2 * i] = np.minimum.reduceat(permuted, starts)
        values[:, 2 * i + 1] = np.maximum.reduceat(permuted, starts)
    keys = np.tile(np.arange(1, _BANDS + 1, dtype=np.uint64), (len(sets), 1))
    for row in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, row::BAND_ROWS])
    return keys.view(np.int64)


def _portions(sets: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    portion, size = [], 0
    for one in sets:
        portion.append(one)
        size += len(one)
        if size >= _AT_ONCE:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in (part for batch in batches for part in slices(batch)):
            at = 0
            for sets in _portions(shingle_set(text, hashes, size) for text in as_bytes(batch["text"])):
                some = [s for s in sets if len(s)]
                bands = iter(min_max_bands(some)) if some else iter(())
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                yield {"id": batch["id"].slice(at, len(sets)), "n_shingles": [len(s) for s in sets],
                       "s1": digests[:, 0], "s2": digests[:, 1], "bands": [next(bands) if len(s) else [] for s in sets]}
                at += len(sets)

    return run


def _stored_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for part in (part for batch in batches for part in slices(batch)):
            yield {"id": part["id"],
                   "shingles": [shingle_set(text, hashes, size).tobytes() for text in as_bytes(part["text"])]}

    return run


@F.pandas_udf(T.LongType())
def _shared(left: pd.Series, right: pd.Series) -> pd.Series:
    """Number of shingles that two stored sets have in common."""
    out = []
    for a, b in zip(left, right):
        a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        at = np.minimum(np.searchsorted(a, b), len(a) - 1)
        out.append(int((a[at] == b).sum()))
    return pd.Series(out, dtype="int64")


def near_duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           shingle_words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_shingles`` (set size), ``component_id``, ``kept``.

    Words are runs of anything but ASCII white space, A-Z in lower case.  Two documents are linked if ``100 *
    intersection >= min_percent * union`` of their sets of ``shingle_words``-word shingles (fewer words: the whole
    sequence is the one shingle).  ``component_id`` is the smallest id reachable over links, the own one included;
    ``kept`` says that it is the own one.

    * null, empty or blank text: empty set, linked with nothing;
    * null id: linked with nothing, ``component_id`` null, kept;
    * repeated rows, or several texts under one id: one document, whose rows share a component;
    * empty table: no rows.
    """
    rows = id_and_text(df, id_col, text_col)
    signed = pin(
        map_arrow(rows, _signatures(shingle_words), "id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>"),
        "signatures",
    )
    linkable = signed.filter("id IS NOT NULL AND n_shingles > 0")
    # The first document of each set stands for all that have the same set.
    classes = pin(
        linkable.groupBy("s1", "s2").agg(F.min(F.struct("id", "bands")).alias("first"), F.min("n_shingles").alias("n"))
        .select("s1", "s2", F.col("first.id").alias("rep"), "n", "first.bands"), "classes",
    )
    members = classes.select("rep", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).filter("pivot < last")
    in_bucket = pin(members.join(buckets, "key").select("key", "rep", "pivot"), "buckets")
    pairs = pin(in_bucket.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = pin(
        map_arrow(rows.join(wanted.hint("shuffle_hash"), "id", "left_semi"), _stored_sets(shingle_words),
                  "id bigint, shingles binary"),
        "shingle-sets",
    )
    def compared(some: DataFrame) -> DataFrame:
        """Pairs (a, b) with ``both``, the number of shared shingles, and whether they are ``linked``."""
        left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
        sizes = (F.length("left") + F.length("right")) / F.lit(8)
        counted = some.join(right, "b").join(left, "a").select("a", "b", _shared("left", "right").alias("both"), sizes.alias("n"))
        return counted.select(
            "a", "b", "both", (100 * F.col("both") >= min_percent * (F.col("n") - F.col("both"))).alias("linked"))

    first_round = pin(compared(pairs), "compared")
    labels = merge_components(None, first_round.filter("linked").select("a", "b"))
    labels = _finish_buckets(in_bucket, classes, first_round, sets, labels, compared, min_percent)

    found = classes.select("s1", "s2", "rep")
    joined = signed.select("id", "n_shingles", "s1", "s2").join(
        found.withColumn("linkable", F.lit(True)), ["s1", "s2"], "left")
    of_class = F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.col("rep"))
    out = joined.withColumn("component_id", F.coalesce(of_class, "id"))
    if labels is not None:
        out = relabel(out, "component_id", labels)
    return out.select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        sets = [np.frombuffer(s, np.int64) for s in batch["shingles"].to_pylist()]
        sizes = [len(s) for s in sets]
        if sizes:
            yield {"shingle": np.concatenate(sets), "id": np.repeat(batch["id"].to_numpy(), sizes), "n": np.repeat(sizes, sizes)}


def _finish_buckets(in_bucket: DataFrame, classes: DataFrame, first_round: DataFrame, sets: DataFrame,
                    labels: DataFrame | None, compared, percent: int) -> DataFrame | None:
    """Compare what shares a bucket but not yet a component, with members 2-8, 9-64, ... of each bucket.

    Of the shingles that two members share, some are among the bucket's first member's, at most as many as either shares
    with that one, and some are not, at most as many as either has in common with any set left.  The sum of the two
    bounds, with the sizes, rules most pairs out before they are made.  A pair is made in its first common band only.
    """
    def placed(df: DataFrame) -> DataFrame:
        with_label = df.withColumn("label", F.col("rep"))
        return with_label if labels is None else relabel(with_label, "label", labels)

    def divided(df: DataFrame) -> DataFrame:
        """Buckets with more than one component; two members have been compared already."""
        keys = placed(df).groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"),
        ).filter("low < high AND n > 2").select("key")
        return df.join(keys, "key", "left_semi")

    left = pin(divided(in_bucket), "open-buckets")
    tested = first_round.select("a", "b")
    shingles = map_arrow(sets.join(left.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), _shingles,
                         "shingle bigint, id bigint, n int")
    common = shingles.groupBy("shingle").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    sizes = (
        shingles.join(common.select("shingle"), "shingle", "left_semi").groupBy(F.col("id").alias("rep"))
        .agg(F.max("n").alias("n"), F.count("*").alias("m")).filter(100 * F.col("m") >= percent * F.col("n"))
    )
    turn = Window.partitionBy("key").orderBy("rep")
    with_first = first_round.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), F.col("both").cast("bigint").alias("own"))
    open_members = left.join(sizes, "rep").join(with_first, ["pivot", "rep"], "left").join(
        classes.select("rep", "bands"), "rep").select(
        "key", "rep", "bands", "n", F.coalesce("own", F.col("n").cast("bigint")).alias("own"), "m")
    open_members = pin(open_members.withColumn("other", F.greatest(F.col("m") - F.col("own"), F.lit(0))).drop("m").withColumn(
        "turn", F.row_number().over(turn)), "open-buckets")
    after, upto = 0, 8
    while True:
        here = pin(placed(open_members), "open-buckets")
        pivots = here.filter((F.col("turn") > after) & (F.col("turn") <= upto)).select(
            "key", *[F.col(c).alias(f"p_{c}") for c in ("rep", "turn", "label", "n", "own", "other", "bands")])
        if pivots.isEmpty():
            return labels
        most = F.least("own", "p_own") + F.least("other", "p_other")
        possible = (F.col("turn") > F.col("p_turn")) & (F.col("label") != F.col("p_label")) & (
            100 * most >= percent * (F.col("n") + F.col("p_n") - most)) & (
            F.element_at(F.array_intersect("bands", "p_bands"), 1) == F.col("key"))
        pairs = (
            here.withColumnRenamed("key", "_key").join(pivots, (F.col("_key") == F.col("key")) & possible)
            .select(F.least("p_rep", "rep").alias("a"), F.greatest("p_rep", "rep").alias("b")).distinct()
            .join(tested, ["a", "b"], "left_anti")
        )
        pairs = pin(pairs, "pairs")
        if not pairs.isEmpty():
            labels = merge_components(labels, compared(pairs).filter("linked").select("a", "b"))
            tested = tested.unionByName(pairs)
            # Stored, or the plan would double with every round.
            open_members = pin(divided(open_members), "open-buckets")
        after, upto = upto, 8 * upto


def keep_one_of_each_class(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """Rows of ``df`` whose id is the smallest of its component, all columns as they are; rows without id stay."""
    classes = near_duplicate_classes(df, id_col, text_col, **options)
    gone = classes.filter(~F.col("kept")).select(F.col("id").alias("_gone")).distinct()
    return df.join(gone, df[id_col].cast("bigint") == gone["_gone"], "left_anti")
