"""Queries: what is too old."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.bounds import bound_millis, parse_bound
from haulmark.operators import retention, uploads
from haulmark.operators.transfer import delete_files
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query

_OLD = f"""WITH {fx.WALS}, m AS (
  SELECT path, file_size, TRY_CAST(regexp_extract(path, '\\.([0-9]+)$', 1) AS BIGINT) AS epoch_ms FROM wals)"""


@query("retention_candidates", f"{_OLD} SELECT path, file_size, epoch_ms FROM m WHERE epoch_ms < {fx.EPOCH_BOUND_MS}")
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.retention_candidates(fx.wal_files(spark, sf_dir), bound_millis(fx.EPOCH_BOUND))


@query("retention_unmatched", f"{_OLD} SELECT path, file_size, 'NO_EPOCH' AS reason FROM m WHERE epoch_ms IS NULL")
def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.retention_unmatched(fx.wal_files(spark, sf_dir))


@query("retention_stats", f"""{_OLD}
SELECT CAST(count(epoch_ms) AS BIGINT) AS matched, CAST(count(*)-count(epoch_ms) AS BIGINT) AS unmatched,
       CAST(count(*) FILTER (epoch_ms < {fx.EPOCH_BOUND_MS}) AS BIGINT) AS deleted,
       CAST(coalesce(sum(file_size) FILTER (epoch_ms < {fx.EPOCH_BOUND_MS}), 0) AS BIGINT) AS deleted_bytes FROM m""")
def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.retention_stats(fx.wal_files(spark, sf_dir), bound_millis(fx.EPOCH_BOUND))


@query("delete_files", f"""{_OLD}
SELECT path, file_size, 'WOULD_DELETE' AS status FROM m WHERE epoch_ms < {fx.EPOCH_BOUND_MS}""")
def deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dry run; nothing is touched."""
    chosen = retention.retention_candidates(fx.wal_files(spark, sf_dir), bound_millis(fx.EPOCH_BOUND))
    return delete_files(chosen).drop("error")


# Bounds as operators type them: midnight as 00 or 24, now and then nonsense.
@query("parse_bound", """SELECT event_id, CASE WHEN event_id%10=0 THEN NULL ELSE epoch_us(ts)//1000 END AS epoch_ms
FROM events""")
def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd-HH-mm-ss-SSS")
    typed = F.when(F.col("event_id") % 2 == 0, F.regexp_replace(text, r"^(\d+-\d+-\d+)-00-", "$1-24-")).otherwise(text)
    typed = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("x"), typed)).otherwise(typed)
    return fx.table(spark, sf_dir, "events").select("event_id", parse_bound(typed).alias("epoch_ms"))


_AS_OF, _DAYS = datetime(1998, 8, 31), 91
_STALE = f"WITH {fx.UPLOADS}, stale AS (SELECT * FROM uploads WHERE initiated < TIMESTAMP '1998-06-01 00:00:00')"
_SIZES = f"""{_STALE}, sums AS (SELECT upload_id, count(*) AS parts, sum(size) AS bytes FROM parts GROUP BY upload_id),
sizes AS (SELECT s.upload_id, s.key, CAST(coalesce(p.parts,0) AS BIGINT) AS parts,
                 CAST(coalesce(p.bytes,0) AS BIGINT) AS bytes FROM stale s LEFT JOIN sums p USING (upload_id))"""


@query("stale_uploads", f"{_STALE} SELECT upload_id, key, initiated FROM stale")
def stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uploads.stale_uploads(fx.uploads(spark, sf_dir), _AS_OF, _DAYS)


@query("upload_sizes", f"{_SIZES} SELECT upload_id, key, parts, bytes FROM sizes")
def upload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uploads.upload_sizes(stale(spark, sf_dir), fx.parts(spark, sf_dir))


@query("reclaimed", f"{_SIZES} SELECT CAST(count(*) AS BIGINT) AS uploads, CAST(sum(bytes) AS BIGINT) AS bytes FROM sizes")
def reclaimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uploads.reclaimed(upload_sizes(spark, sf_dir))
