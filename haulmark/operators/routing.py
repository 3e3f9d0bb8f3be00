"""Which kind of job a pair needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions.paths import fs_type

# Fixed values: (source kind, target kind) -> job; a missing target counts as UNKNOWN, LOCAL as HDFS.
ROUTES = {
    ("S3", "HDFS"): "GET",
    ("S3", "UNKNOWN"): "VERIFY",
    ("HDFS", "S3"): "PUT",
    ("HDFS", "HDFS"): "INTERNAL_COPY",
}


def route(pairs: DataFrame) -> DataFrame:
    """Add ``route``, decided for every row; anything else is ``UNSUPPORTED``."""
    def kind(column: str):
        found = F.when(F.col(column) == "", "UNKNOWN").otherwise(fs_type(column))
        return F.when(found == "LOCAL", "HDFS").otherwise(found)

    src, dst = kind("src_file"), kind("dest_file")
    job = F.lit("UNSUPPORTED")
    for (src_kind, dst_kind), name in ROUTES.items():
        job = F.when((src == src_kind) & (dst == dst_kind), name).otherwise(job)
    return pairs.withColumn("route", job)
