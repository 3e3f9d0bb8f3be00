"""Bandwidth limits, evaluated on transfer logs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.bounds import epoch_millis
from haulmark.operators.ordered import running_sum

#: Fixed value: limit per worker in MB/s when none is given.
DEFAULT_LIMIT = 20.0


def required_delay(transfers: DataFrame, limit_mb_s: float, start: datetime, tie_cols: tuple[str, ...] = (),
                   **kwargs: int) -> DataFrame:
    """Add ``cum_bytes`` and ``delay_ms``: how long a worker must wait after each transfer to keep to the limit.

    MB are 10^6 bytes here.  ``tie_cols`` order transfers of one worker at the same moment.  One busy worker may hold
    most of the log: the running sum is cut along time as well as along workers.
    """
    start = start if start.tzinfo else start.replace(tzinfo=timezone.utc)
    start_ms = int(start.timestamp() * 1000)
    summed = running_sum(transfers, F.col("bytes"), ["ts", *tie_cols], ["worker"], "cum_bytes", **kwargs)
    expected = (F.expr("cum_bytes div 1000").cast("double") / F.lit(float(limit_mb_s))).cast("bigint")
    elapsed = epoch_millis(transfers, "ts") - F.lit(start_ms).cast("bigint")
    return summed.withColumn("delay_ms", F.greatest(F.lit(0).cast("bigint"), expected - elapsed))


def interval_columns(limit_mib_s: float, interval_ms: int, workers: int) -> dict[str, Column]:
    """Columns computed from an interval's ``bytes``: ``used_mib_s, over_limit, sleep_ms, total_sleep_ms``.

    MiB are 1024^2 bytes here.  All literals are doubles: decimals would round differently.
    """
    mib = F.col("bytes").cast("double") / F.lit(1048576.0).cast("double")
    used = mib / (F.lit(float(interval_ms)) / F.lit(1000.0).cast("double"))
    limit = F.lit(float(limit_mib_s))
    over = used > limit
    sleep = F.when(over, ((used - limit) / used * F.lit(float(interval_ms))).cast("bigint")).otherwise(F.lit(0))
    sleep = sleep.cast("bigint")
    return {"used_mib_s": used, "over_limit": over, "sleep_ms": sleep, "total_sleep_ms": sleep * workers}


def throttle_intervals(transfers: DataFrame, interval_ms: int, limit_mib_s: float, workers: int = 1) -> DataFrame:
    """Use of each interval (all workers together) and the pause that would have kept it at the limit.

    Works on a stream too; give it a watermark on ``ts`` first (see ``haulmark.streaming``).
    """
    used = transfers.groupBy(F.window("ts", f"{interval_ms} milliseconds").alias("_w")).agg(F.sum("bytes").alias("bytes"))
    return used.select(
        F.col("_w.start").alias("interval_start"), "bytes",
        *[c.alias(n) for n, c in interval_columns(limit_mib_s, interval_ms, workers).items()],
    )
