"""The driver's tables seen as listings, object metadata, logs and manifests.

Every function has an SQL twin (upper-case constant), a list of common table expressions for the oracle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.bounds import epoch_millis
from haulmark.session import new_folder
from haulmark.sources import filesystem as fs

SRC_ROOT, DST_ROOT = "hdfs://nn:8020/backup", "s3n://bucket/backup"
#: Files whose contents a task of a tree unpacks at a time.
_UNPACKED = 100
EPOCH_BOUND = "2024-01-15-12-00-00-000"
EPOCH_BOUND_MS = 1705320000000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NAME = "lang||'/'||source||'/doc'||doc_id||'.txt'"

SRC = f"""src AS (
  SELECT doc_id, entry_name, c, true AS is_file, CAST(strlen(c) AS BIGINT) AS file_size,
         to_base64(unhex(md5(c))) AS md5
  FROM (SELECT doc_id, {_NAME} AS entry_name, CASE WHEN doc_id%50=0 THEN '' ELSE text END AS c FROM documents))"""

DST = f"""dst AS (
  SELECT doc_id, entry_name, c, true AS is_file, CAST(strlen(c) AS BIGINT) AS file_size,
         to_base64(unhex(md5(c))) AS md5
  FROM (SELECT doc_id, {_NAME} AS entry_name,
               CASE WHEN doc_id%50=0 THEN '' WHEN doc_id%13=0 THEN text||'x'
                    WHEN doc_id%11=0 THEN translate(text,'e','a') ELSE text END AS c
        FROM documents WHERE doc_id%17<>0
        UNION ALL
        SELECT doc_id, {_NAME}||'.extra', text FROM documents WHERE doc_id%19=0))"""


def src_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, entry_name, c``."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{_NAME} AS entry_name", "CASE WHEN doc_id%50=0 THEN '' ELSE text END AS c"
    )


def dst_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after some files were changed, lost or added."""
    documents = table(spark, sf_dir, "documents")
    changed = documents.filter("doc_id%17<>0").selectExpr(
        "doc_id", f"{_NAME} AS entry_name",
        """CASE WHEN doc_id%50=0 THEN '' WHEN doc_id%13=0 THEN text||'x'
                WHEN doc_id%11=0 THEN translate(text,'e','a') ELSE text END AS c""",
    )
    return changed.unionByName(documents.filter("doc_id%19=0").selectExpr(
        "doc_id", f"{_NAME}||'.extra' AS entry_name", "text AS c"
    ))


def as_listing(content: DataFrame, root: str, md5: bool = False) -> DataFrame:
    """LISTING of a content table, with ``md5`` if asked for; contents go no further than the scan."""
    return content.select(
        F.lit(root).alias("base_dir"), "entry_name", F.lit(True).alias("is_file"),
        F.octet_length("c").cast("bigint").alias("file_size"), "doc_id",
        *([F.base64(F.unhex(F.md5("c"))).alias("md5")] if md5 else []),
    )


def src_listing(spark: SparkSession, sf_dir: str, md5: bool = False) -> DataFrame:
    return as_listing(src_content(spark, sf_dir), SRC_ROOT, md5)


def dst_listing(spark: SparkSession, sf_dir: str, md5: bool = False) -> DataFrame:
    return as_listing(dst_content(spark, sf_dir), DST_ROOT, md5)


PAIRS = SRC + f""", pairs AS (
  SELECT doc_id, '{SRC_ROOT}/'||entry_name AS src_file, '{DST_ROOT}/'||entry_name AS dest_file,
         true AS is_file, file_size, CAST(doc_id%8 AS INTEGER) AS group_id FROM src)"""


def grouped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PAIR plus ``group_id`` (by number, not balanced)."""
    return src_listing(spark, sf_dir).select(
        F.concat(F.lit(SRC_ROOT + "/"), "entry_name").alias("src_file"),
        F.concat(F.lit(DST_ROOT + "/"), "entry_name").alias("dest_file"),
        "is_file", "file_size", (F.col("doc_id") % 8).cast("int").alias("group_id"),
    )


_WAL = """'/wals/rs-'||user_id||'/'||event_type||'%2C60020.'||{ms}||
  CASE WHEN event_type='error' THEN '.tmp' ELSE '' END"""
WALS = f"""wals AS (
  SELECT {_WAL.format(ms="(epoch_us(ts)//1000)")} AS path, CAST(floor(value*1000) AS BIGINT) AS file_size
  FROM events)"""


def wal_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, file_size`` of log files, most with an epoch at the end of their name."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("ms", epoch_millis(events, "ts")).selectExpr(
        _WAL.format(ms="ms") + " AS path", "CAST(floor(value*1000) AS bigint) AS file_size"
    )


UPLOADS = """uploads AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS upload_id, 'cust'||o_custkey AS key, o_orderdate AS initiated FROM orders),
parts AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS upload_id, CAST(l_quantity*1048576 AS BIGINT) AS size FROM lineitem)"""


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS upload_id", "'cust'||o_custkey AS key", "o_orderdate AS initiated"
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS string) AS upload_id", "CAST(l_quantity*1048576 AS bigint) AS size"
    )


_LINE = """CASE WHEN page_id%10=0 THEN url
  WHEN page_id%10=1 THEN 's3n://b/p'||page_id||'  /dst/p'||page_id||' 5'
  WHEN page_id%10=2 THEN 's3n://b/p'||page_id||' /dst/p'||page_id||' 5 '
  WHEN page_id%10=3 THEN 's3n://b/p'||page_id||' /dst/p'||page_id||' x5'
  ELSE 's3n://b/p'||page_id||' /dst/p'||page_id||' '||length(html) END AS value"""
MANIFEST = f"""lines AS (SELECT {_LINE} FROM pages),
fields AS (SELECT value, string_split(rtrim(value), ' ') AS f FROM lines),
sized AS (SELECT value, f, CASE WHEN len(f)=3 AND regexp_full_match(f[3], '[+-]?[0-9]+')
                                THEN TRY_CAST(f[3] AS BIGINT) END AS size FROM fields)"""


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr(_LINE)


TRANSFERS = """transfers AS (
  SELECT event_id, user_id AS worker, ts, CAST(floor(value*1000000) AS BIGINT) AS bytes FROM events)"""


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id AS worker", "ts", "CAST(floor(value*1000000) AS bigint) AS bytes"
    )


# What a copy job might have reported: the priority stands for the outcome.
_RESULT = """'/data/o'||o_orderkey AS src_file, '/copy/o'||o_orderkey AS dest_file,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'SKIPPED' WHEN '2-HIGH' THEN 'FAILED' WHEN '3-MEDIUM' THEN 'COPIED'
       WHEN '4-NOT SPECIFIED' THEN 'COPIED' ELSE 'CHECKSUM_MISMATCH' END AS status,
  CAST(floor(o_totalprice) AS BIGINT) AS bytes_expected, CAST(floor(o_totalprice) AS BIGINT) AS bytes_copied,
  CAST(o_custkey%50 AS BIGINT) AS elapsed_ms,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'disk '||o_custkey%7 END AS error"""
RESULTS = f"results AS (SELECT {_RESULT} FROM orders)"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT {_RESULT} FROM {{orders}}", orders=table(spark, sf_dir, "orders"))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, unpacked few at a time: contents stay packed until they are written."""
    for start in range(0, batch.num_rows, _UNPACKED):
        yield from zip(*(column.to_pylist() for column in batch.slice(start, _UNPACKED).columns))


def _tree_writer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents = set()
        for batch in batches:
            for name, content in _rows(batch):
                path = f"{root}/{name}"
                if name.endswith("/"):
                    fs.make_dir(path)
                    continue
                parent = path.rpartition("/")[0]
                if parent not in parents:
                    fs.make_dir(parent)
                    parents.add(parent)
                with fs.writing(path) as out:
                    out.write(content.encode())
            yield batch.select(["entry_name"])

    return run


_trees: dict[tuple[str, str, str], str] = {}


def fresh_tree(spark: SparkSession, label: str, content: DataFrame) -> str:
    """Write ``entry_name, c`` as real files (names ending in ``/``: directories) into a folder of their own."""
    root = new_folder(spark, f"tree-{label}")
    tasks = spark.sparkContext.defaultParallelism
    content.select("entry_name", "c").repartition(tasks, "entry_name").mapInArrow(
        _tree_writer(root), "entry_name string"
    ).write.format("noop").mode("overwrite").save()
    return root


def written_tree(spark: SparkSession, sf_dir: str, label: str, content: DataFrame) -> str:
    """``fresh_tree`` once per session, for queries that only read the tree."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _trees:
        _trees[key] = fresh_tree(spark, label, content)
    return _trees[key]
