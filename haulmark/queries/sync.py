"""Queries: planning an incremental sync."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.attributes import parse_attrs
from haulmark.operators import sync as ops
from haulmark.operators.digest import file_md5
from haulmark.operators.routing import route
from haulmark.plans.sync import keep_attributes, plan_sync, run_sync
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query
from haulmark.sources.files import list_files


@query("select_updates", f"""WITH {fx.SRC}, {fx.DST}
SELECT s.entry_name, s.file_size, CASE WHEN d.entry_name IS NULL THEN 'MISSING' ELSE 'DIFFERS' END AS reason
FROM src s LEFT JOIN dst d ON s.entry_name=d.entry_name
WHERE d.entry_name IS NULL OR s.file_size<>d.file_size OR (s.doc_id%3<>0 AND s.md5<>d.md5)""")
def select_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third source has no checksum: there the length decides."""
    src = fx.src_listing(spark, sf_dir, True).withColumn("checksum", F.expr("CASE WHEN doc_id%3<>0 THEN md5 END"))
    dst = fx.dst_listing(spark, sf_dir, True).withColumnRenamed("md5", "checksum")
    return ops.select_updates(src, dst).select("entry_name", "file_size", "reason")


def _action_sql(replace: str) -> str:
    return f"""WITH {fx.SRC}, {fx.DST}, s AS (
  SELECT entry_name, doc_id%10<>1 AS is_file, file_size FROM src), d AS (
  SELECT entry_name, doc_id%6<>1 AS is_file, file_size FROM dst)
SELECT s.entry_name, s.is_file,
  CASE WHEN NOT s.is_file THEN CASE WHEN d.is_file THEN 'FAIL' ELSE 'MKDIR' END
       WHEN d.entry_name IS NULL THEN 'COPY'
       WHEN NOT ({replace}) THEN 'SKIP' WHEN NOT d.is_file THEN 'FAIL' ELSE 'OVERWRITE' END AS action
FROM s LEFT JOIN d ON s.entry_name=d.entry_name"""


def _actions(spark: SparkSession, sf_dir: str, **mode: bool) -> DataFrame:
    src = fx.src_listing(spark, sf_dir).withColumn("is_file", F.expr("doc_id%10<>1"))
    dst = fx.dst_listing(spark, sf_dir).withColumn("is_file", F.expr("doc_id%6<>1"))
    return ops.copy_action(src, dst, **mode).select("entry_name", "is_file", "action")


@query("copy_action", _action_sql("s.file_size<>d.file_size"))
def copy_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir, update=True)


@query("copy_action_overwrite", _action_sql("true"))
def copy_action_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir, overwrite=True)


@query("copy_action_keep", _action_sql("false"))
def copy_action_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir)


_KINDS = """CASE doc_id%6 WHEN 0 THEN 's3n://b/' WHEN 1 THEN 'hdfs://nn/' WHEN 2 THEN '/' WHEN 3 THEN 'file:///'
  WHEN 4 THEN 'S3://b/' ELSE 'ftp://h/' END||'a'||doc_id AS src_file,
  CASE doc_id%7 WHEN 0 THEN '/' WHEN 1 THEN 's3a://b/' WHEN 2 THEN 'webhdfs://h/' WHEN 3 THEN 'file:/'
  WHEN 4 THEN '' ELSE 'gs://b/' END||CASE WHEN doc_id%7=4 THEN '' ELSE 'b'||doc_id END AS dest_file"""


@query("route", f"""WITH kinds AS (SELECT doc_id, {_KINDS} FROM documents), k AS (SELECT *,
  CASE WHEN doc_id%6 IN (0,4) THEN 'S3' WHEN doc_id%6=5 THEN 'UNKNOWN' ELSE 'HDFS' END AS s,
  CASE doc_id%7 WHEN 1 THEN 'S3' WHEN 0 THEN 'HDFS' WHEN 2 THEN 'HDFS' WHEN 3 THEN 'HDFS' ELSE 'UNKNOWN' END AS d
  FROM kinds)
SELECT src_file, dest_file, CASE WHEN s='S3' AND d='HDFS' THEN 'GET' WHEN s='S3' AND d='UNKNOWN' THEN 'VERIFY'
  WHEN s='HDFS' AND d='S3' THEN 'PUT' WHEN s='HDFS' AND d='HDFS' THEN 'INTERNAL_COPY' ELSE 'UNSUPPORTED' END AS route
FROM k""")
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(spark.sql(f"SELECT {_KINDS} FROM {{documents}}", documents=fx.table(spark, sf_dir, "documents")))


_CLAIMS = """'/in/o'||l_orderkey||'/'||l_partkey||'/'||l_suppkey AS src_file, '/out/p'||l_partkey%1500 AS dest_file"""


@query("duplicate_dests", f"""WITH claims AS (SELECT {_CLAIMS} FROM lineitem)
SELECT dest_file, CAST(count(*) AS BIGINT) AS sources, min(src_file) AS first_source, max(src_file) AS last_source
FROM claims GROUP BY dest_file HAVING count(*)>1""")
def duplicate_dests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_dests(_claims(spark, sf_dir))


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT {_CLAIMS} FROM {{lineitem}}", lineitem=fx.table(spark, sf_dir, "lineitem"))


@query("prev_dest", f"""WITH claims AS (SELECT {_CLAIMS} FROM lineitem), p AS (
  SELECT dest_file, src_file, lag(src_file) OVER (PARTITION BY dest_file ORDER BY src_file) AS prev_src FROM claims)
SELECT * FROM p WHERE prev_src IS NOT NULL""")
def prev_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.prev_dest(_claims(spark, sf_dir))


_OWNED = """'u'||doc_id%7 AS owner, 'g'||doc_id%3 AS grp, 'rw'||doc_id%2 AS permission"""
_OWNED_DST = """'u'||CASE WHEN doc_id%5=0 THEN 9 ELSE doc_id%7 END AS owner,
  'g'||CASE WHEN doc_id%4=0 THEN 9 ELSE doc_id%3 END AS grp, 'rw'||CASE WHEN doc_id%10=0 THEN 9 ELSE doc_id%2 END
  AS permission"""


@query("attr_drift", f"""WITH {fx.SRC}, {fx.DST}, s AS (SELECT entry_name, {_OWNED} FROM src),
d AS (SELECT entry_name, {_OWNED_DST} FROM dst)
SELECT s.entry_name, CASE WHEN s.owner<>d.owner THEN s.owner END AS new_owner,
  CASE WHEN s.grp<>d.grp THEN s.grp END AS new_grp, CAST(NULL AS VARCHAR) AS new_permission
FROM s JOIN d ON s.entry_name=d.entry_name WHERE s.owner<>d.owner OR s.grp<>d.grp""")
def attr_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    def owned(listing: DataFrame, columns: str) -> DataFrame:
        return spark.sql(f"SELECT entry_name, {columns} FROM {{listing}}", listing=listing)

    return ops.attr_drift(owned(fx.src_listing(spark, sf_dir), _OWNED),
                          owned(fx.dst_listing(spark, sf_dir), _OWNED_DST), parse_attrs("ug"))


def _budget_sql(max_bytes: int, max_files: int) -> str:
    return f"""WITH RECURSIVE {fx.SRC}, it AS (
  SELECT entry_name, file_size, row_number() OVER (ORDER BY entry_name) AS rn FROM src),
r AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS entry_name, CAST(0 AS BIGINT) AS file_size,
             false AS ok, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS b
      UNION ALL
      SELECT it.rn, it.entry_name, it.file_size, r.n<{max_files} AND r.b+it.file_size<={max_bytes},
             CASE WHEN r.n<{max_files} AND r.b+it.file_size<={max_bytes} THEN r.n+1 ELSE r.n END,
             CASE WHEN r.n<{max_files} AND r.b+it.file_size<={max_bytes} THEN r.b+it.file_size ELSE r.b END
      FROM r JOIN it ON it.rn=r.rn+1)
SELECT entry_name, file_size FROM r WHERE ok"""


def _admitted(spark: SparkSession, sf_dir: str, max_files: int | None, max_bytes: int) -> DataFrame:
    files = fx.src_listing(spark, sf_dir).select("entry_name", "is_file", "file_size")
    return ops.budget_admit(files, max_files, max_bytes).select("entry_name", "file_size")


@query("budget_admit", _budget_sql(500_000, 1_000_000_000))
def budget_admit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admitted(spark, sf_dir, None, 500_000)


@query("budget_admit_both_limits", _budget_sql(400_000, 120))
def budget_admit_both_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A byte limit and a file limit, as a sync may be given."""
    return _admitted(spark, sf_dir, 120, 400_000)


@query("run_sync", f"""WITH {fx.SRC}, {fx.DST}
SELECT entry_name, file_size, md5, 'THERE' AS state FROM src
UNION ALL SELECT entry_name, file_size, NULL, 'DELETED' FROM dst WHERE entry_name NOT IN (SELECT entry_name FROM src)""")
def run_sync_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real trees: the target is made equal to the source, deletions included; what is there after, and what went."""
    src = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    dst = fx.fresh_tree(spark, "synced", fx.dst_content(spark, sf_dir))
    plan = plan_sync(list_files(spark, src), list_files(spark, dst), dst, overwrite=True, delete=True)
    result = run_sync(plan, dst, groups=8, dry_run_deletes=False)
    there = list_files(spark, dst).filter("is_file").select(
        F.concat(F.lit(dst + "/"), "entry_name").alias("path"), "file_size")
    digested = file_md5(there).select("path", "file_size", F.when(F.col("file_size") >= 0, F.col("md5")).alias("md5"),
                                      F.lit("THERE").alias("state"))
    gone = result.deleted.filter("status = 'DELETED' AND is_file").select(
        "path", "file_size", F.lit(None).cast("string").alias("md5"), F.lit("DELETED").alias("state"))
    return digested.unionByName(gone).select(F.expr(f"substring(path, {len(dst) + 2})").alias("entry_name"), "file_size", "md5", "state")


_WANTED = "CASE doc_id%3 WHEN 0 THEN '0600' WHEN 1 THEN '0440' ELSE '0755' END AS permission"
_PARENT = "regexp_replace(entry_name, '/[^/]*$', '') AS entry_name, false AS is_file, '0750' AS permission"


@query("keep_attributes", f"""WITH {fx.SRC}, {fx.DST}
SELECT entry_name, is_file, {_WANTED} FROM src WHERE entry_name IN (SELECT entry_name FROM dst)
UNION ALL (SELECT {_PARENT} FROM src INTERSECT SELECT {_PARENT} FROM dst)""")
def keep_attributes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real tree gets the permissions of the source listing, directories included; what is there afterwards."""
    root = fx.fresh_tree(spark, "attributes", fx.dst_content(spark, sf_dir))
    src = fx.src_listing(spark, sf_dir)
    nobody = [F.lit(None).cast("string").alias(c) for c in ("owner", "grp")]
    parents = src.select(F.regexp_replace("entry_name", "/[^/]*$", "").alias("entry_name"), F.lit(False).alias("is_file"),
                         F.lit("0750").alias("permission")).distinct()
    wanted = src.selectExpr("entry_name", "is_file", _WANTED).unionByName(parents)
    keep_attributes(wanted.select("*", *nobody), root, parse_attrs("p"))
    there = list_files(spark, root, dirs="all", attributes=True)
    return there.join(wanted, "entry_name", "left_semi").select("entry_name", "is_file", "permission")
