"""Work plans on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.paths import part_name
from haulmark.operators.layout import number_plan
from haulmark.operators.ordered import ROWS_PER_BIN


def write_plan(grouped: DataFrame, path: str, rows_per_file: int = ROWS_PER_BIN) -> None:
    """Store grouped pairs as one folder per group (``filegroup-003``), rows numbered from 0 in work order.

    The ranges of (group, number) that number the rows also write them, so a large group becomes several files of about
    ``rows_per_file`` rows instead of one task's work, and nothing is shuffled again.
    """
    numbered = number_plan(grouped, rows_per_bin=rows_per_file, in_order=True)
    named = numbered.withColumn("file_group", part_name("filegroup", "group_id"))
    named.sortWithinPartitions("file_group", "row_no").write.partitionBy("file_group").parquet(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """A stored plan, with ``group_id`` and ``row_no``."""
    return spark.read.parquet(path).drop("file_group")
