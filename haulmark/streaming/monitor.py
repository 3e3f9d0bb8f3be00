"""The bandwidth monitor as a stream: one row per closed interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from haulmark.operators.throttle import throttle_intervals


def bandwidth_monitor(transfers: DataFrame, interval_ms: int, limit_mib_s: float, workers: int = 1,
                      late: str = "1 minute") -> DataFrame:
    """``throttle_intervals`` over a stream of transfers; an interval closes ``late`` after its end."""
    return throttle_intervals(transfers.withWatermark("ts", late), interval_ms, limit_mib_s, workers)


def start_monitor(intervals: DataFrame, path: str) -> StreamingQuery:
    """Append closed intervals to a parquet folder, working off what is available.

    The stream's own state lies inside that folder (readers skip it), so a later start with the same path goes on where
    the one before ended: every interval is written once.
    """
    return (
        intervals.writeStream.format("parquet").outputMode("append")
        .option("path", path)
        .option("checkpointLocation", f"{path.rstrip('/')}/_monitor")
        .trigger(availableNow=True).start()
    )
