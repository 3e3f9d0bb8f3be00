"""Multipart uploads that were begun and never finished."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions.bounds import moment


def stale_uploads(uploads: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Uploads begun strictly before ``as_of`` minus ``days`` times 24 hours (a constant the scan can prune with)."""
    return uploads.filter(F.col("initiated") < moment(uploads, "initiated", as_of - timedelta(hours=24 * days)))


def upload_sizes(uploads: DataFrame, parts: DataFrame) -> DataFrame:
    """``upload_id, key, parts, bytes`` per upload; an upload without parts has 0.

    Parts are summed before they meet the uploads, so an upload with very many parts costs one row per map task.
    """
    sums = parts.groupBy("upload_id").agg(F.count("*").alias("parts"), F.sum("size").alias("bytes"))
    return uploads.join(sums, "upload_id", "left").select(
        "upload_id", "key",
        F.coalesce("parts", F.lit(0)).cast("bigint").alias("parts"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
    )


def reclaimed(sizes: DataFrame) -> DataFrame:
    """One row: uploads released and their bytes."""
    return sizes.agg(
        F.count("*").alias("uploads"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes")
    )
