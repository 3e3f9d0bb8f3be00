"""Working with listings: building pairs, duplicates, membership, summaries, order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.functions import paths
from haulmark.operators.ordered import row_position
from haulmark.operators.skew import hot_keys

_SLICES = 64


def dedupe_listing(listing: DataFrame, order_cols: Sequence[Column | str]) -> tuple[DataFrame, DataFrame]:
    """Split into ``(kept, rejected)``: the first row of each entry name along ``order_cols``, and the others."""
    marked = mark_first(listing, order_cols)
    return marked.filter("kept").drop("kept"), marked.filter("not kept").drop("kept")


def mark_first(listing: DataFrame, order_cols: Sequence[Column | str]) -> DataFrame:
    """Add ``kept``: this is the first row of its entry name along ``order_cols``.

    A name cannot be a file and a directory at once, so the name alone is the key (the slash of a directory does not
    count).  A name on a large part of the rows is settled in slices first; one winner per slice goes on.  Slices and
    ties in the order are settled by a hash of the whole row, so every reading of the result agrees.
    """
    row = F.xxhash64(*[F.col(c) for c in listing.columns])
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols] + [row]
    named = listing.withColumn("_name", F.regexp_replace("entry_name", "/$", ""))
    hot = hot_keys(named, "_name")
    if not hot:
        first = F.row_number().over(Window.partitionBy("_name").orderBy(*order)) == 1
        return named.withColumn("kept", first).drop("_name")

    slice_id = F.when(F.col("_name").isin(hot), F.pmod(row, F.lit(_SLICES))).otherwise(-1)
    ranked = named.withColumn("_slice", slice_id).withColumn(
        "_first", F.row_number().over(Window.partitionBy("_name", "_slice").orderBy(*order)) == 1
    )
    undecided = F.col("_first") & (F.col("_slice") >= 0)
    decided = ranked.filter(~undecided).withColumn("kept", F.col("_first"))
    # At most 64 rows per hot name.
    finals = ranked.filter(undecided).withColumn(
        "kept", F.row_number().over(Window.partitionBy("_name").orderBy(*order)) == 1
    )
    return decided.unionByName(finals).drop("_name", "_slice", "_first")


def union_sources(listings: Sequence[DataFrame], roots: Sequence[str], root_at_source: bool = False) -> DataFrame:
    """Several source trees as one listing.

    Names start below the source directory itself (``root_at_source``: one source into a new target, or an update) or
    below its parent, which keeps the directory's own name.
    """
    def rooted(listing: DataFrame, root: str) -> DataFrame:
        root = root.rstrip("/")
        base, _, own = root.rpartition("/")
        if root_at_source:
            return listing.withColumn("base_dir", F.lit(root))
        return listing.withColumn("base_dir", F.lit(base)).withColumn(
            "entry_name", F.concat(F.lit(own + "/"), F.col("entry_name"))
        )

    return reduce(DataFrame.unionByName, [rooted(l, r) for l, r in zip(listings, roots, strict=True)])


def make_pairs(listing: DataFrame, dest_root: str | None, include_dirs: bool = True) -> DataFrame:
    """Source and target path of every entry; no ``dest_root`` gives ``''`` (read only)."""
    rows = listing if include_dirs else listing.filter("is_file")
    dest = F.lit("") if dest_root is None else F.concat(F.lit(dest_root.rstrip("/") + "/"), F.col("entry_name"))
    return rows.select(
        F.concat("base_dir", F.lit("/"), "entry_name").alias("src_file"),
        dest.alias("dest_file"), "is_file", "file_size",
    )


def _membership(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per ``(entry_name, is_file)`` with flags ``in_a`` / ``in_b``.

    A union and one hash aggregate: both sides share a shuffle, and repeated names shrink before it.
    """
    key = ["entry_name", "is_file"]
    tagged = a.select(*key, F.lit(True).alias("a"), F.lit(False).alias("b")).unionByName(
        b.select(*key, F.lit(False).alias("a"), F.lit(True).alias("b"))
    )
    return tagged.groupBy(*key).agg(F.max("a").alias("in_a"), F.max("b").alias("in_b"))


def presence(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every entry once, with ``in_a`` and ``in_b``: one pass over both listings."""
    return _membership(a, b)


def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries of ``a`` that ``b`` does not have."""
    return _membership(a, b).filter("in_a and not in_b").select("entry_name", "is_file")


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries that both listings have."""
    return _membership(a, b).filter("in_a and in_b").select("entry_name", "is_file")


def listing_summary(listing: DataFrame) -> DataFrame:
    """One row: file, empty-directory and empty-file counts, bytes, and the largest file (smallest name on ties)."""
    size = F.when(F.col("is_file"), F.col("file_size"))
    largest = F.min_by(F.when(size > 0, F.col("entry_name")), F.when(size > 0, F.struct(-size, F.col("entry_name"))))
    return listing.agg(
        F.count_if("is_file").alias("files"),
        F.count_if(~F.col("is_file")).alias("empty_dirs"),
        F.count_if(size == 0).alias("empty_files"),
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.coalesce(F.max(size), F.lit(0)).cast("bigint").alias("max_size"),
        F.coalesce(largest, F.lit("")).alias("max_name"),
    )


def totals_match(src: DataFrame, dst: DataFrame) -> DataFrame:
    """One row: file counts and bytes of both sides and whether they agree."""
    both = src.filter("is_file").select(F.lit("src").alias("side"), "file_size").unionByName(
        dst.filter("is_file").select(F.lit("dst").alias("side"), "file_size")
    )
    totals = both.agg(*[
        agg
        for side in ("src", "dst")
        for agg in (
            F.count_if(F.col("side") == side).alias(f"{side}_files"),
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("file_size"))), F.lit(0)).cast("bigint")
            .alias(f"{side}_bytes"),
        )
    ])
    same = (F.col("src_files") == F.col("dst_files")) & (F.col("src_bytes") == F.col("dst_bytes"))
    return totals.withColumn("totals_match", same)


def order_by_size(rows: DataFrame, name_col: str = "src_file") -> DataFrame:
    """Largest first, names ascending on ties, with the position as a column."""
    return row_position(rows, [-F.col("file_size"), F.col(name_col)], in_order=True)


def order_by_name(listing: DataFrame) -> DataFrame:
    """Files by name, then directories by name, with the position as a column."""
    return row_position(listing, [~F.col("is_file"), F.col("entry_name")], in_order=True)


def largest(listing: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` largest files."""
    return listing.filter("is_file").orderBy(F.desc("file_size"), "entry_name").limit(k)


def parents_of(listing: DataFrame) -> DataFrame:
    """Every directory that the names of a listing imply, as directory entries."""
    return (
        listing.select(paths.parent("entry_name").alias("parent")).filter("parent <> ''").distinct()
        .select(F.explode_outer(F.concat(paths.ancestors("parent"), F.array("parent"))).alias("entry_name")).distinct()
        .select("entry_name", F.lit(False).alias("is_file"))
    )
