"""Failure logs of copy jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses of ``copy_files`` that count as done.
DONE = ["COPIED", "READ", "MKDIR", "SKIPPED"]


def is_done() -> Column:
    """A result row that ended well."""
    tolerated = (F.col("status") == "SIZE_CHANGED") & F.col("error").isNull()
    return F.col("status").isin(DONE) | tolerated


def failures(result: DataFrame) -> DataFrame:
    """Result rows that did not end well."""
    return result.filter(~is_done())


def render_log(result: DataFrame) -> DataFrame:
    """Log lines: ``SKIP: source`` and ``FAIL target : error``."""
    line = F.when(F.col("status") == "SKIPPED", F.concat(F.lit("SKIP: "), F.col("src_file"))).when(
        ~is_done(),
        F.concat(F.lit("FAIL "), F.col("dest_file"), F.lit(" : "), F.coalesce("error", "status")),
    )
    return result.select(line.alias("value")).filter("value is not null")


def write_failure_log(result: DataFrame, path: str) -> None:
    """Store the log lines as text."""
    render_log(result).write.text(path)
