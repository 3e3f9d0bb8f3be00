"""Queries: spreading work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators import layout as ops
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query
from haulmark.session import new_folder
from haulmark.sources.plan_store import read_plan, write_plan

# Weight: 1000 + bytes.  Heavy files (above 1/160 of all) longest first, each to the lightest of 8 groups, lowest on ties;
# light ones by the gap below the common level in which their start falls.
_GROUPS = f"""WITH RECURSIVE {fx.PAIRS}, it AS (
  SELECT src_file, file_size, 1000+file_size AS w, (1000+file_size)*160 > sum(1000+file_size) OVER () AS heavy,
         row_number() OVER (ORDER BY file_size DESC, src_file) AS rn FROM pairs),
r AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS src_file, CAST(0 AS BIGINT) AS file_size,
             CAST(-1 AS BIGINT) AS g, [CAST(0 AS BIGINT) for i in range(8)] AS loads
      UNION ALL
      SELECT it.rn, it.src_file, it.file_size, list_position(r.loads, list_min(r.loads))-1,
             list_transform(r.loads, lambda x, i: CASE WHEN i=list_position(r.loads, list_min(r.loads))
                                                  THEN x+it.w ELSE x END)
      FROM r JOIN it ON it.rn=r.rn+1 AND it.heavy),
ends AS (SELECT unnest(loads) AS load, unnest(range(8)) AS g FROM (SELECT loads FROM r ORDER BY rn DESC LIMIT 1)),
light AS (SELECT src_file, file_size, rn, sum(w) OVER (ORDER BY rn) - w AS before FROM it WHERE NOT heavy),
rest AS (SELECT coalesce(sum(w), 0) AS amount FROM it WHERE NOT heavy),
level AS (SELECT min((amount + below + i - 1)//i) AS level FROM rest, (
  SELECT sum(load) OVER (ORDER BY load, g) AS below, row_number() OVER (ORDER BY load, g) AS i FROM ends)),
gaps AS (SELECT g, sum(level-load) OVER (ORDER BY g) - (level-load) AS begins FROM ends, level WHERE load < level),
placed AS (SELECT src_file, file_size, rn, g FROM r WHERE rn>0
  UNION ALL SELECT src_file, file_size, rn, (SELECT max_by(g, begins) FROM gaps WHERE begins<=before) FROM light)"""


def _balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.assign_groups(fx.grouped_pairs(spark, sf_dir).drop("group_id"), 8)


@query("assign_groups", f"{_GROUPS} SELECT src_file, file_size, CAST(g AS INTEGER) AS group_id FROM placed")
def assign_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _balanced(spark, sf_dir).select("src_file", "file_size", "group_id")


@query("write_plan", f"""{_GROUPS}
SELECT src_file, file_size, CAST(g AS INTEGER) AS group_id, printf('filegroup-%03d', g) AS file_group,
       CAST(row_number() OVER (PARTITION BY g ORDER BY rn)-1 AS BIGINT) AS row_no FROM placed""")
def plan_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balanced plan, stored and read back."""
    path = new_folder(spark, "plan")
    write_plan(_balanced(spark, sf_dir), path)
    return read_plan(spark, path).select(
        "src_file", "file_size", "group_id", "row_no",
        F.regexp_extract(F.col("_metadata.file_path"), "file_group=([^/]+)/", 1).alias("file_group"),
    )


@query("group_summary", f"""WITH {fx.PAIRS}
SELECT group_id, CAST(count(*) AS BIGINT) AS files, CAST(0 AS BIGINT) AS dirs, CAST(sum(file_size) AS BIGINT) AS bytes,
       CAST(sum(file_size)+1000*count(*) AS BIGINT) AS weight FROM pairs GROUP BY group_id""")
def group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.group_summary(fx.grouped_pairs(spark, sf_dir))


@query("split_plan", f"""WITH {fx.SRC}, b AS (
  SELECT entry_name, file_size, sum(file_size) OVER (ORDER BY entry_name) - file_size AS before,
         sum(file_size) OVER () AS total FROM src)
SELECT entry_name, file_size, CAST(least(before*8//total, 7) AS INTEGER) AS split_id FROM b""")
def split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.split_plan(fx.src_listing(spark, sf_dir).select("entry_name", "file_size"), 8, "entry_name")


@query("task_count", """SELECT CAST(sum(CAST(floor(l_extendedprice*100) AS BIGINT)) AS BIGINT) AS total_bytes,
  CAST(greatest(1, least(sum(CAST(floor(l_extendedprice*100) AS BIGINT))//268435456, 60)) AS BIGINT) AS tasks
FROM lineitem""")
def task_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.task_count(fx.table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(floor(l_extendedprice*100) AS bigint) AS file_size"
    ), nodes=3)
