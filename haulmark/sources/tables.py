"""Listings that already exist as tables, and text lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.session import pin


def listing_from_table(df: DataFrame, path_col: str, size_col: str, root: str) -> DataFrame:
    """LISTING of the rows below ``root`` (``dir`` does not take in ``dir2``); names ending in ``/`` are markers."""
    root = root.rstrip("/")
    below = df.filter(F.col(path_col).startswith(root + "/") & (F.col(path_col) != root + "/"))
    return below.select(
        F.lit(root).alias("base_dir"),
        F.expr(f"substring(`{path_col}`, {len(root) + 2})").alias("entry_name"),
        (~F.col(path_col).endswith("/")).alias("is_file"),
        F.col(size_col).cast("bigint").alias("file_size"),
    )


def parse_manifest(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """``src dest size`` lines -> ``(pairs, rejects)``.

    Exactly three fields separated by single blanks; blanks at the end do not count.  Rejects are ``(value, reason)``
    with ``BAD_FIELD_COUNT`` or ``BAD_SIZE``.
    """
    parsed = lines.select(F.col(column).alias("value"), F.split(F.rtrim(column), " ").alias("_f")).withColumn(
        "_size", F.when(F.size("_f") == 3, _size_of(F.get("_f", F.lit(2))))
    )
    pairs = parsed.filter(F.col("_size").isNotNull()).select(
        F.get("_f", F.lit(0)).alias("src_file"), F.get("_f", F.lit(1)).alias("dest_file"),
        F.lit(True).alias("is_file"), F.col("_size").alias("file_size"),
    )
    reason = F.when(F.size("_f") == 3, "BAD_SIZE").otherwise("BAD_FIELD_COUNT")
    return pairs, parsed.filter(F.col("_size").isNull()).select("value", reason.alias("reason"))


def _size_of(text: Column) -> Column:
    return F.when(text.rlike("^[+-]?[0-9]+$"), text).try_cast("bigint")


def manifest_totals(pairs: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: accepted files and bytes, and rejected lines."""
    both = pairs.select("file_size", F.lit(True).alias("ok")).unionByName(
        rejects.select(F.lit(0).cast("bigint").alias("file_size"), F.lit(False).alias("ok"))
    )
    return both.agg(
        F.count_if("ok").alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("bytes"),
        F.count_if(~F.col("ok")).alias("rejected"),
    )


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``parse_manifest`` of text files."""
    return parse_manifest(spark.read.text(path))


def read_uri_list(spark: SparkSession, path: str) -> DataFrame:
    """One path per line."""
    return spark.read.text(path).select(F.col("value").alias("uri"))


def missing_sources(uris: DataFrame, present: DataFrame) -> DataFrame:
    """All URIs (once each) that are not among ``present`` (a ``uri`` column)."""
    tagged = uris.select("uri", F.lit(True).alias("asked"), F.lit(False).alias("found")).unionByName(
        present.select("uri", F.lit(False).alias("asked"), F.lit(True).alias("found"))
    )
    flags = tagged.groupBy("uri").agg(F.max("asked").alias("asked"), F.max("found").alias("found"))
    return flags.filter("asked and not found").select("uri")


def check_sources(uris: DataFrame, present: DataFrame) -> None:
    """Raise once if any source is missing; the error names a table (column ``uri``) that holds every missing one."""
    missing = pin(missing_sources(uris, present), "missing-sources")
    count = missing.count()
    if count:
        raise MissingSources(count, missing)


class MissingSources(FileNotFoundError):
    """``count`` sources are missing: the rows of ``table``."""

    def __init__(self, count: int, table: DataFrame):
        super().__init__(f"{count} missing sources, listed in {table.inputFiles()[0].rsplit('/', 1)[0]}")
        self.count, self.table = count, table
