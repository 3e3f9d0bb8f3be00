"""Queries: copy jobs, their results, and bandwidth limits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators import throttle
from haulmark.operators import transfer as ops
from haulmark.operators.digest import file_md5
from haulmark.operators.layout import assign_groups
from haulmark.operators.listing import make_pairs
from haulmark.plans import copy_in_waves
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query
from haulmark.session import new_folder
from haulmark.sources import logs
from haulmark.sources.files import list_files
from haulmark.streaming import bandwidth_monitor, start_monitor


@query("copy_files", f"""WITH {fx.SRC}
SELECT entry_name, 'COPIED' AS status, file_size AS bytes_copied, md5 AS src_md5 FROM src""")
def copy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real tree, written from the documents, listed, balanced and copied with verification."""
    root = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    pairs = make_pairs(list_files(spark, root), new_folder(spark, "copy"))
    return ops.copy_files(assign_groups(pairs, 8)).select(
        F.expr(f"substring(src_file, {len(root) + 2})").alias("entry_name"), "status", "bytes_copied", "src_md5"
    )


@query("copy_waves", f"""WITH {fx.SRC}, s AS (
  SELECT *, CAST(sum(file_size) OVER (ORDER BY entry_name) AS BIGINT) - file_size AS before, sum(file_size) OVER () // 4 + 1 AS w FROM src)
SELECT entry_name, CAST(before // w AS INTEGER) AS wave, 'COPIED' AS status, file_size AS bytes_copied, md5 AS src_md5 FROM s""")
def copy_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real tree in four waves; the job stops after the second and another call goes on from its journal."""
    root = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    pairs = make_pairs(list_files(spark, root), new_folder(spark, "wave-copy"))
    journal, wave = new_folder(spark, "journal"), pairs.agg(F.sum("file_size")).first()[0] // 4 + 1
    copy_in_waves(spark, journal, pairs, wave, max_waves=2)
    return copy_in_waves(spark, journal).select(
        F.expr(f"substring(src_file, {len(root) + 2})").alias("entry_name"), "wave", "status", "bytes_copied", "src_md5"
    )


_CHUNK = 2048


@query("copy_ranges", f"""WITH {fx.SRC}
SELECT entry_name, 'COPIED' AS status, file_size AS bytes_copied, CASE WHEN file_size < {_CHUNK} THEN md5 END AS src_md5, md5 AS dest_md5 FROM src""")
def copy_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real tree whose larger files are copied in ranges, no task reading more than one; then the copies are digested."""
    root = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    target = new_folder(spark, "range-copy")
    conf = ops.CopyConf(ranged_from=_CHUNK, chunk_bytes=_CHUNK, whole_md5=False)
    copied = ops.copy_files(make_pairs(list_files(spark, root), target), conf)
    there = file_md5(copied.select(F.col("dest_file").alias("path"), F.col("bytes_copied").alias("file_size")))
    return copied.join(there.select(F.col("path").alias("dest_file"), F.col("md5").alias("dest_md5")), "dest_file").select(
        F.expr(f"substring(src_file, {len(root) + 2})").alias("entry_name"), "status", "bytes_copied", "src_md5", "dest_md5"
    )


@query("create_markers", """SELECT 'd'||doc_id||CASE WHEN doc_id%2=0 THEN '/' ELSE '' END AS entry_name,
  CASE WHEN doc_id%2=0 THEN 'MKDIR' ELSE 'COPIED' END AS status, CAST(0 AS BIGINT) AS bytes_copied FROM documents""")
def create_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty directories and empty files only."""
    names = fx.table(spark, sf_dir, "documents").selectExpr(
        "'d'||doc_id||CASE WHEN doc_id%2=0 THEN '/' ELSE '' END AS entry_name", "'' AS c"
    )
    root = fx.written_tree(spark, sf_dir, "markers", names)
    pairs = make_pairs(list_files(spark, root), new_folder(spark, "markers-copy"))
    return ops.copy_files(pairs).select(
        F.expr(f"substring(src_file, {len(root) + 2})").alias("entry_name"), "status", "bytes_copied"
    )


@query("failures", f"""WITH {fx.RESULTS}
SELECT src_file, dest_file, status FROM results WHERE status NOT IN ('COPIED', 'SKIPPED')""")
def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.failures(fx.results(spark, sf_dir)).select("src_file", "dest_file", "status")


@query("failure_log", f"""WITH {fx.RESULTS}
SELECT CASE WHEN status='SKIPPED' THEN 'SKIP: '||src_file
            ELSE 'FAIL '||dest_file||' : '||coalesce(error, status) END AS value
FROM results WHERE status<>'COPIED'""")
def failure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as written to text files."""
    path = new_folder(spark, "failure-log")
    logs.write_failure_log(fx.results(spark, sf_dir), path)
    return spark.read.text(path)


@query("unfinished", f"""WITH {fx.RESULTS}
SELECT src_file, dest_file FROM results WHERE status NOT IN ('COPIED', 'SKIPPED') OR bytes_copied%11=0""")
def unfinished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of some pairs never arrived."""
    results = fx.results(spark, sf_dir)
    return ops.unfinished(results.select("src_file", "dest_file"), results.filter("bytes_copied%11<>0"))


@query("copy_counters", f"""WITH {fx.RESULTS}
SELECT CAST(count(*) FILTER (status='COPIED') AS BIGINT) AS copy,
  CAST(count(*) FILTER (status='SKIPPED') AS BIGINT) AS skip,
  CAST(count(*) FILTER (status NOT IN ('COPIED','SKIPPED')) AS BIGINT) AS fail,
  CAST(sum(bytes_expected) FILTER (status<>'SKIPPED') AS BIGINT) AS bytes_expected,
  CAST(sum(bytes_copied) FILTER (status='COPIED') AS BIGINT) AS bytes_copied FROM results""")
def copy_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.copy_counters(fx.results(spark, sf_dir))


@query("transfer_rate", f"""WITH {fx.RESULTS}
SELECT src_file, CASE WHEN elapsed_ms<>0
  THEN CAST(bytes_copied AS DOUBLE)/CAST(1000 AS DOUBLE)/CAST(elapsed_ms AS DOUBLE) END AS mb_s FROM results""")
def transfer_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.transfer_rate(fx.results(spark, sf_dir)).select("src_file", "mb_s")


@query("required_delay", f"""WITH {fx.TRANSFERS}, s AS (
  SELECT event_id, worker, bytes, CAST(sum(bytes) OVER (PARTITION BY worker ORDER BY ts, event_id
                                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_bytes,
         epoch_us(ts)//1000 - 1704067200000 AS elapsed FROM transfers)
SELECT event_id, worker, bytes, cum_bytes, CAST(greatest(0,
  CAST(trunc(CAST(cum_bytes//1000 AS DOUBLE)/CAST(0.2 AS DOUBLE)) AS BIGINT)-elapsed) AS BIGINT) AS delay_ms FROM s""")
def required_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throttle.required_delay(
        fx.transfers(spark, sf_dir), 0.2, datetime(2024, 1, 1), ("event_id",)
    ).drop("ts")


_HOUR_MS, _LIMIT = 3_600_000, 0.2
_HOURS = f"""WITH {fx.TRANSFERS}, w AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS interval_start, CAST(sum(bytes) AS BIGINT) AS bytes
  FROM transfers GROUP BY 1),
u AS (SELECT *, CAST(bytes AS DOUBLE)/CAST(1048576 AS DOUBLE)/(CAST({_HOUR_MS} AS DOUBLE)/CAST(1000 AS DOUBLE))
  AS used_mib_s FROM w),
t AS (SELECT interval_start, bytes, used_mib_s, used_mib_s>CAST({_LIMIT} AS DOUBLE) AS over_limit,
  CASE WHEN used_mib_s>CAST({_LIMIT} AS DOUBLE)
    THEN CAST(trunc((used_mib_s-CAST({_LIMIT} AS DOUBLE))/used_mib_s*CAST({_HOUR_MS} AS DOUBLE)) AS BIGINT)
    ELSE CAST(0 AS BIGINT) END AS sleep_ms FROM u)"""


def _naive(intervals: DataFrame) -> DataFrame:
    return intervals.withColumn("interval_start", F.col("interval_start").cast("timestamp_ntz"))


@query("throttle_intervals", f"{_HOURS} SELECT *, sleep_ms*4 AS total_sleep_ms FROM t")
def throttle_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(throttle.throttle_intervals(fx.transfers(spark, sf_dir), _HOUR_MS, _LIMIT, workers=4))


@query("bandwidth_monitor", f"""{_HOURS}
SELECT *, sleep_ms AS total_sleep_ms FROM t
WHERE interval_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM transfers) - INTERVAL 30 MINUTE""")
def monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream over the event log: intervals closed by the watermark."""
    # A file source takes a single file only as a pattern.
    stream = spark.readStream.schema(fx.table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    log = stream.selectExpr(
        "CAST(ts AS timestamp) AS ts", "user_id AS worker", "CAST(floor(value*1000000) AS bigint) AS bytes"
    )
    path = new_folder(spark, "intervals")
    start_monitor(bandwidth_monitor(log, _HOUR_MS, _LIMIT, late="30 minutes"), path).awaitTermination()
    return _naive(spark.read.parquet(path))
