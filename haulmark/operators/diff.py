"""Comparing two sides: names and sizes, then contents, then stored objects against their metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.digests import digest_words
from haulmark.operators.skew import hot_keys, lookup_join, one_per_key


def _both_sides(src: DataFrame, dst: DataFrame, values: list[str]) -> DataFrame:
    """One row per file name with ``src_<value>`` / ``dst_<value>`` and flags ``in_src``, ``in_dst`` and ``repeated``.

    ``repeated``: one side has the name several times with different values.

    Instead of a full outer join: one union and one aggregate, so both sides go through a single shuffle, nothing is
    sorted when the values are numbers, and repeated names collapse before the shuffle.
    """
    def side(df: DataFrame, mine: str) -> DataFrame:
        columns = [F.lit(mine == s).alias(f"in_{s}") for s in ("src", "dst")]
        for s in ("src", "dst"):
            columns += [
                (F.col(v) if s == mine else F.lit(None).cast(src.schema[v].dataType)).alias(f"{s}_{v}") for v in values
            ]
        return df.filter("is_file").select("entry_name", *columns)

    sides = [f"{s}_{v}" for s in ("src", "dst") for v in values]
    aggregates = [F.max(f"in_{s}").alias(f"in_{s}") for s in ("src", "dst")]
    aggregates += [F.min(c).alias(c) for c in sides]
    # Equal only if all rows of a name agree, nulls included.
    clash = [F.coalesce(F.min(c) != F.max(c), F.lit(False)) for c in sides]
    clash += [(F.count(f"{s}_{v}") > 0) & (F.count(f"{s}_{v}") < F.count_if(f"in_{s}")) for s in ("src", "dst") for v in values]
    aggregates.append(reduce(Column.__or__, clash).alias("repeated"))
    return side(src, "src").unionByName(side(dst, "dst")).groupBy("entry_name").agg(*aggregates)


def _listing_status() -> Column:
    return (
        F.when(F.col("repeated"), "DUPLICATE_NAME")
        .when(~F.col("in_dst"), "MISSING_AT_DEST")
        .when(~F.col("in_src"), "MISSING_AT_SRC")
        .when(F.col("src_file_size").eqNullSafe(F.col("dst_file_size")), "SAME")
        .otherwise("SIZE_MISMATCH")
    )


def dir_diff(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Files of two listings: ``entry_name, src_size, dst_size, status``; directories are not compared.

    Rows that repeat a name with another size make it ``DUPLICATE_NAME``; the sizes then are the smallest.
    """
    return _both_sides(src, dst, ["file_size"]).select(
        "entry_name",
        F.col("src_file_size").alias("src_size"),
        F.col("dst_file_size").alias("dst_size"),
        _listing_status().alias("status"),
    )


def diff_union(diff: DataFrame) -> DataFrame:
    """Only the differences of a ``dir_diff``."""
    return diff.filter(F.col("status") != "SAME")


def _with_words(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns(dict(zip(names, digest_words("md5"), strict=True)))


def content_diff(src: DataFrame, dst: DataFrame) -> DataFrame:
    """``dir_diff`` for listings that already carry a base64 ``md5`` column.

    ``SAME`` becomes ``SAME_EMPTY``, ``CHECKSUM_MISMATCH`` or ``UNREADABLE`` where that is the case.
    """
    words = ["md5_0", "md5_1", "md5_2"]
    status = _listing_status()
    unread = F.col("src_md5_0").isNull() | F.col("dst_md5_0").isNull()
    equal = reduce(Column.__and__, [F.col(f"src_{w}") == F.col(f"dst_{w}") for w in words])
    return _both_sides(_with_words(src, words), _with_words(dst, words), ["file_size", *words]).select(
        "entry_name",
        F.col("src_file_size").alias("src_size"),
        F.col("dst_file_size").alias("dst_size"),
        F.when(status != "SAME", status)
        .when(F.col("src_file_size") == 0, "SAME_EMPTY")
        .when(unread, "UNREADABLE")
        .when(~equal, "CHECKSUM_MISMATCH")
        .otherwise("SAME").alias("status"),
    )


def skip_empty_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs that have something to read."""
    return pairs.filter(F.col("file_size") > 0)


def one_per_source(pairs: DataFrame) -> DataFrame:
    """Drop all but one pair of each source (the one with the smallest target)."""
    return one_per_key(pairs.select("src_file", "dest_file", "file_size"), "src_file")


def _digest_of(digests: DataFrame, key: str, name: str) -> DataFrame:
    return digests.groupBy(F.col("path").alias(key)).agg(F.min("md5").alias(name))


def size_status(src_size: Column, dst_size: Column) -> Column:
    """What sizes alone settle (null: the file is not there); null where contents must be compared."""
    return (
        F.when(src_size.isNull(), "MISSING_SOURCE").when(dst_size.isNull(), "MISSING")
        .when(src_size != dst_size, "SIZE_MISMATCH").when(src_size == 0, "MATCH")
    )


def compare_content(pairs: DataFrame, src_md5: DataFrame, dst_md5: DataFrame) -> DataFrame:
    """``MATCH``, ``MISMATCH``, ``SIZE_MISMATCH``, ``MISSING`` or ``UNREADABLE`` (a digest is missing) per pair.

    ``dest_size`` is the size of the target, null if there is none: only two empty files match without digests.  Digests
    are ``(path, md5)``.  A source counts once.  Many sources may share one target, so that lookup splits off hot targets.
    """
    kept = one_per_key(pairs.filter("is_file").select("src_file", "dest_file", "file_size", "dest_size"), "src_file")
    with_src = kept.join(_digest_of(src_md5, "src_file", "src_md5"), "src_file", "left")
    both = lookup_join(with_src, _digest_of(dst_md5, "dest_file", "dst_md5"), "dest_file", "left",
                       hot_keys(pairs, "dest_file"))
    settled = size_status(F.col("file_size"), F.col("dest_size"))
    return both.select(
        "src_file", "dest_file", "file_size", "dest_size", "src_md5", "dst_md5",
        F.when(settled.isNotNull(), settled)
        .when(F.col("src_md5").isNull() | F.col("dst_md5").isNull(), "UNREADABLE")
        .when(F.col("src_md5") == F.col("dst_md5"), "MATCH")
        .otherwise("MISMATCH").alias("status"),
    )


def compare_parts(src_parts: DataFrame, dst_parts: DataFrame) -> DataFrame:
    """Compare digests per byte range (``entry_name, part_no, md5``), which spreads one huge file over many tasks.

    One row per file: number of parts, parts that differ, are unread or missing on a side, those unread or missing, and a
    status.
    """
    words = ["md5_0", "md5_1", "md5_2"]
    keys = ["entry_name", "part_no"]

    def side(parts: DataFrame, mine: str) -> DataFrame:
        columns = [
            (F.col(w) if s == mine else F.lit(None).cast("bigint")).alias(f"{s}_{w}") for s in "sd" for w in words
        ]
        return _with_words(parts.select(*keys, "md5"), words).select(*keys, *columns)

    per_part = side(src_parts, "s").unionByName(side(dst_parts, "d")).groupBy(*keys).agg(
        *[F.min(f"{s}_{w}").alias(f"{s}_{w}") for s in "sd" for w in words]
    )
    equal = reduce(Column.__and__, [F.col(f"s_{w}") == F.col(f"d_{w}") for w in words])
    unread = F.col("s_md5_0").isNull() | F.col("d_md5_0").isNull()
    return per_part.groupBy("entry_name").agg(
        F.count("*").alias("parts"), F.count_if(~F.coalesce(equal, F.lit(False))).alias("bad_parts"),
        F.count_if(unread).alias("unread_parts"),
    ).withColumn("status", F.when(F.col("bad_parts") == 0, "MATCH").otherwise("MISMATCH"))


def verify_objects(listing: DataFrame, meta: DataFrame, digests: DataFrame, verify: bool = True) -> DataFrame:
    """Check stored objects against what their metadata promises.

    ``digests`` is ``(entry_name, md5, bytes_read)`` of what was really read.  The user's ``contentlength`` must equal
    the stored length; the expected digest is the user's ``contentmd5``, else the store's own.
    """
    user_length = F.try_element_at("user_metadata", F.lit("contentlength")).try_cast("bigint")
    expected = F.coalesce(F.try_element_at("user_metadata", F.lit("contentmd5")), F.col("content_md5"))
    conflict = F.coalesce(F.col("user_length") != F.col("content_length"), F.lit(False))
    status = F.when(conflict, "LENGTH_CONFLICT").when(F.col("content_length") == 0, "OK")
    status = status.when(F.col("bytes_read").isNull(), "UNREADABLE")
    if verify:
        status = status.when(F.col("expected_md5").isNull(), "NO_CHECKSUM")
    status = status.when(F.col("bytes_read") != F.col("content_length"), "SHORT_READ")
    if verify:
        status = status.when(~F.col("expected_md5").eqNullSafe(F.col("md5")), "CHECKSUM_MISMATCH")
    # Maps cannot be compared, so the two entries that count are taken out before rows are made unique.
    promised = one_per_key(meta.select(
        "entry_name", "content_length", user_length.alias("user_length"), expected.alias("expected_md5")
    ), "entry_name")
    found = one_per_key(digests.select("entry_name", "md5", "bytes_read"), "entry_name")
    known = promised.join(found, "entry_name", "left")
    return (
        listing.filter("is_file").select("entry_name", "file_size").join(known, "entry_name", "left")
        .select("entry_name", "file_size", "expected_md5", "md5",
                F.when(F.col("content_length").isNull(), "NO_METADATA").otherwise(status.otherwise("OK"))
                .alias("status"))
    )
