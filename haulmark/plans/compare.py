"""Compare two trees: names, then sizes, then (only where both agree) contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators.diff import compare_parts, dir_diff, size_status
from haulmark.operators.digest import CHUNK_BYTES, part_md5, range_plan
from haulmark.session import pin
from haulmark.sources.files import file_sizes, list_files

_STATUS = {"MATCH": "SAME", "MISMATCH": "CHECKSUM_MISMATCH", "UNREADABLE": "UNREADABLE"}


def compare_trees(spark: SparkSession, src_root: str, dst_root: str, checksum: bool = False,
                  gate: bool = True, tasks: int | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``entry_name, src_size, dst_size, status`` of every file on either side.

    ``checksum`` reads contents of files that agree in size.  With ``gate`` nothing is read unless the listings agree
    completely; otherwise everything is reported at once.  Contents are compared by ranges of ``chunk_bytes``, spread
    over ``tasks`` tasks.
    """
    src_root, dst_root = src_root.rstrip("/"), dst_root.rstrip("/")
    diff = dir_diff(list_files(spark, src_root), list_files(spark, dst_root))
    if not checksum:
        return diff
    diff = pin(diff, "diff")
    if gate and not diff.filter("status <> 'SAME'").isEmpty():
        return diff
    pairs = diff.filter("status = 'SAME' and src_size > 0").select(
        F.concat(F.lit(src_root + "/"), "entry_name").alias("src_file"),
        F.concat(F.lit(dst_root + "/"), "entry_name").alias("dest_file"),
        "src_size", "dst_size",
    )
    compared = compare_pairs(pairs, tasks, chunk_bytes, sized=True).select(
        F.substring("src_file", len(src_root) + 2, 2**31 - 1).alias("entry_name"),
        F.create_map(*[F.lit(x) for kv in _STATUS.items() for x in kv])[F.col("status")].alias("content"),
    )
    return diff.join(compared, "entry_name", "left").select(
        "entry_name", "src_size", "dst_size", F.coalesce("content", "status").alias("status")
    )


def compare_pairs(pairs: DataFrame, tasks: int | None = None, chunk_bytes: int = CHUNK_BYTES,
                  sized: bool = False) -> DataFrame:
    """Compare pairs of files (``src_file, dest_file``) that are read now: one row per different pair.

    Gives both sizes, ``parts``, ``bad_parts`` and ``status``: ``MISSING_SOURCE``, ``MISSING`` (target), ``SIZE_MISMATCH``,
    ``MATCH``, ``MISMATCH`` or ``UNREADABLE``; without target (null or empty) the source is only read: ``READABLE`` or
    ``UNREADABLE``.  Sizes are looked up, unless ``sized`` says that the pairs have ``src_size`` and ``dst_size``, and
    settle what they can.  All else is compared by ranges: a huge file is the work of many tasks.
    """
    columns = ["src_file", F.coalesce("dest_file", F.lit("")).alias("dest_file")]
    named = pairs.select(*columns, *(["src_size", "dst_size"] if sized else [])).distinct()
    if not sized:
        paths = named.select(F.col("src_file").alias("path")).union(named.select("dest_file")).filter("path <> ''").distinct()
        sizes = pin(file_sizes(paths, tasks), "sizes")
        for path, size in (("src_file", "src_size"), ("dest_file", "dst_size")):
            named = named.join(sizes.select(F.col("path").alias(path), F.col("size").alias(size)), path, "left")
    alone = F.col("dest_file") == ""
    settled = F.when(alone, F.when(F.col("src_size").isNull(), "MISSING_SOURCE").when(F.col("src_size") == 0, "READABLE"))
    settled = settled.otherwise(size_status(F.col("src_size"), F.col("dst_size")))
    named = pin(named.withColumn("settled", settled), "sized-pairs")

    todo = named.filter("settled IS NULL").select("src_file", "dest_file", F.col("src_size").alias("file_size"))
    read = todo.select(F.col("src_file").alias("path"), "file_size").union(
        todo.filter(~alone).select("dest_file", "file_size")).distinct().withColumn("is_file", F.lit(True))
    digests = pin(part_md5(range_plan(read, chunk_bytes, 0, "path"), tasks), "range-digests")
    pair = F.struct("src_file", "dest_file").alias("entry_name")
    left = todo.join(digests, F.col("src_file") == F.col("path")).select(pair, "part_no", "md5")
    # Without target the source is held against itself: what was read agrees.
    right = todo.join(digests, F.when(alone, F.col("src_file")).otherwise(F.col("dest_file")) == F.col("path")).select(
        pair, "part_no", "md5")
    compared = compare_parts(left, right).select("entry_name.*", "parts", "bad_parts", "unread_parts")
    found = (
        F.when(F.col("unread_parts") > 0, "UNREADABLE").when(F.col("bad_parts") > 0, "MISMATCH")
        .otherwise(F.when(alone, "READABLE").otherwise("MATCH"))
    )
    return named.join(compared, ["src_file", "dest_file"], "left").select(
        "src_file", "dest_file", "src_size", "dst_size", "parts", "bad_parts", F.coalesce("settled", found).alias("status"))


def compare_file(spark: SparkSession, src: str, dst: str | None = None) -> DataFrame:
    """Compare two single files, or without ``dst`` check that the file can be read completely."""
    return compare_pairs(spark.createDataFrame([(src, dst)], "src_file string, dest_file string"))
