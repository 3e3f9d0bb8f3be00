"""Expired files, by the epoch milliseconds at the end of their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: a dot and digits at the very end of a path.
EPOCH_SUFFIX = r"\.([0-9]+)$"


def _with_epoch(files: DataFrame) -> DataFrame:
    digits = F.regexp_extract("path", EPOCH_SUFFIX, 1)
    return files.withColumn("_digits", digits).withColumn("epoch_ms", F.col("_digits").try_cast("bigint"))


def retention_candidates(files: DataFrame, bound_ms: int) -> DataFrame:
    """Files (``path, file_size``) whose epoch is strictly before the bound; names without one are never chosen."""
    return _with_epoch(files).filter(F.col("epoch_ms") < bound_ms).drop("_digits")


def retention_unmatched(files: DataFrame) -> DataFrame:
    """Files that retention can never choose, with the reason."""
    return _with_epoch(files).filter(F.col("epoch_ms").isNull()).select(
        "path", "file_size",
        F.when(F.col("_digits") == "", "NO_EPOCH").otherwise("EPOCH_OUT_OF_RANGE").alias("reason"),
    )


def retention_stats(files: DataFrame, bound_ms: int) -> DataFrame:
    """One row: matched, unmatched, deleted files and deleted bytes."""
    old = F.col("epoch_ms") < bound_ms
    return _with_epoch(files).agg(
        F.count_if(F.col("epoch_ms").isNotNull()).alias("matched"),
        F.count_if(F.col("epoch_ms").isNull()).alias("unmatched"),
        F.count_if(old).alias("deleted"),
        F.coalesce(F.sum(F.when(old, F.col("file_size"))), F.lit(0)).cast("bigint").alias("deleted_bytes"),
    )
