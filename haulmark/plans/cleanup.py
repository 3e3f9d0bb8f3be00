"""Removing what is too old."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.bounds import bound_millis
from haulmark.operators.retention import retention_candidates
from haulmark.operators.transfer import delete_files
from haulmark.operators.uploads import stale_uploads, upload_sizes
from haulmark.sources.files import list_files


def cleanup_dir(spark: SparkSession, root: str, before: str, tz: str = "UTC", dry_run: bool = True) -> DataFrame:
    """Delete files below ``root`` whose name ends in an epoch before the bound; by default only report them."""
    bound = bound_millis(before, tz)
    listed = list_files(spark, root, dirs="none")
    files = listed.select(F.concat("base_dir", F.lit("/"), "entry_name").alias("path"), "file_size")
    return delete_files(retention_candidates(files, bound), dry_run)


def cleanup_uploads(uploads: DataFrame, parts: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Uploads to abort, with their parts and bytes."""
    return upload_sizes(stale_uploads(uploads, as_of, days), parts)
