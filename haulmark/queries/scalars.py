"""Queries: column helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions import paths, sizes
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query


def _select(spark: SparkSession, sf_dir: str, table: str, columns: str) -> DataFrame:
    return spark.sql(f"SELECT {columns} FROM {{data}}", data=fx.table(spark, sf_dir, table))


_URI = """doc_id, CASE doc_id%9 WHEN 0 THEN 'hdfs://nn:8020' WHEN 1 THEN 's3n://bucket' WHEN 2 THEN 's3a://bucket2'
  WHEN 3 THEN 'file://' WHEN 4 THEN '' WHEN 5 THEN 'WebHDFS://host' WHEN 6 THEN 'ftp://host' WHEN 7 THEN 'S3://bk'
  END||'/'||lang||'/'||source||CASE WHEN doc_id%4=0 THEN '//' ELSE '/' END||'doc'||doc_id AS uri"""


@query("fs_type", f"""WITH u AS (SELECT {_URI} FROM documents)
SELECT doc_id, CASE WHEN doc_id%9 IN (0,4,5) THEN 'HDFS' WHEN doc_id%9 IN (1,2,7) THEN 'S3' WHEN doc_id%9=3 THEN 'LOCAL'
  ELSE 'UNKNOWN' END AS fs_type FROM u""")
def fs_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "documents", _URI).select("doc_id", paths.fs_type("uri").alias("fs_type"))


@query("split_uri", f"""WITH u AS (SELECT {_URI} FROM documents)
SELECT doc_id, nullif(split_part(split_part(nullif(uri, ''), '://', CASE WHEN contains(uri,'://') THEN 2 ELSE 3 END), '/', 1), '')
         AS bucket,
       regexp_replace(uri, '^([A-Za-z0-9]+://[^/]*)?/', '') AS key FROM u""")
def split_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _select(spark, sf_dir, "documents", _URI).select("doc_id", paths.split_uri("uri").alias("s"))
    return split.select("doc_id", F.when(F.col("s.key").isNotNull(), F.col("s.bucket")).alias("bucket"), "s.key")


@query("relative_path", f"""WITH u AS (SELECT {_URI}, lang, source FROM documents)
SELECT doc_id, CASE WHEN uri IS NOT NULL AND lang='en' THEN source||'/doc'||doc_id END AS relative FROM u""")
def relative_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component by component: repeated slashes do not count, and ``/e`` is not a root of ``/en``."""
    return _select(spark, sf_dir, "documents", _URI).select(
        "doc_id", paths.relative_path("uri", "hdfs://nn:8020//en/").alias("relative")
    )


_DOTTED = """url, CASE page_id%5 WHEN 0 THEN url||'.tar.gz' WHEN 1 THEN 'plain'||page_id WHEN 2 THEN 'a.b'||page_id||'..'
  WHEN 3 THEN 'end.' ELSE '.x'||page_id END AS name"""


@query("suffix", f"""WITH n AS (SELECT page_id, {_DOTTED} FROM pages)
SELECT page_id, CASE page_id%5 WHEN 0 THEN 'gz' WHEN 2 THEN 'b'||page_id WHEN 4 THEN 'x'||page_id ELSE '' END AS suffix
FROM n""")
def suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "pages", "page_id, " + _DOTTED).select("page_id", paths.suffix("name").alias("suffix"))


@query("replace_suffix", f"""WITH n AS (SELECT page_id, {_DOTTED} FROM pages)
SELECT page_id, CASE page_id%5 WHEN 0 THEN url||'.tar.new' WHEN 2 THEN 'a.b'||page_id||'..new' WHEN 4 THEN '.new'
  ELSE name||'.new' END AS renamed FROM n""")
def replace_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "pages", "page_id, " + _DOTTED).select(
        "page_id", paths.replace_suffix("name", ".new").alias("renamed")
    )


_SIZED = """p_partkey, p_size||CASE p_partkey%9 WHEN 0 THEN '' WHEN 1 THEN 'k' WHEN 2 THEN 'M' WHEN 3 THEN 'g'
  WHEN 4 THEN 't' WHEN 5 THEN 'p' WHEN 6 THEN 'E' WHEN 7 THEN 'x' ELSE ' k' END AS text"""


@query("parse_size", f"""WITH s AS (SELECT {_SIZED}, p_size FROM part), b AS (
  SELECT p_partkey, CASE WHEN p_partkey%9<7 THEN CAST(p_size AS HUGEINT)*(CAST(1 AS HUGEINT) << (10*(p_partkey%9))::INT) END
    AS size FROM s)
SELECT p_partkey, CASE WHEN size BETWEEN 1 AND 9223372036854775807 THEN CAST(size AS BIGINT) END AS size FROM b""")
def parse_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "part", _SIZED).select("p_partkey", sizes.parse_size("text").alias("size"))


_COUNT = """o_orderkey, o_orderkey*CASE o_orderkey%4 WHEN 0 THEN 1 WHEN 1 THEN 1021 WHEN 2 THEN 1048573
  ELSE 1073741789 END AS n"""


@query("human_bytes", f"""WITH c AS (SELECT {_COUNT} FROM orders)
SELECT o_orderkey, n||' bytes ('||CASE WHEN n<1024 THEN printf('%.1f', CAST(n AS DOUBLE))
  WHEN n<1048576 THEN printf('%.1fk', n/CAST(1024 AS DOUBLE)) WHEN n<1073741824 THEN printf('%.1fm', n/CAST(1048576 AS DOUBLE))
  ELSE printf('%.1fg', n/CAST(1073741824 AS DOUBLE)) END||')' AS text FROM c""")
def human_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "orders", _COUNT).select("o_orderkey", sizes.human_bytes("n").alias("text"))


_TWO = """doc_id, lang||CASE doc_id%3 WHEN 0 THEN '' WHEN 1 THEN '/'||source ELSE 'x' END AS x, lang||'/'||source AS y"""


@query("is_ancestor", f"WITH t AS (SELECT {_TWO} FROM documents) SELECT doc_id, doc_id%3<>2 AS below FROM t")
def is_ancestor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "documents", _TWO).select("doc_id", paths.is_ancestor("x", "y").alias("below"))


@query("format_entry", f"""WITH {fx.SRC}
SELECT '{fx.SRC_ROOT} | '||entry_name||' | file | '||file_size AS line FROM src""")
def format_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.src_listing(spark, sf_dir).select(
        paths.format_entry("base_dir", "entry_name", "is_file", "file_size").alias("line")
    )


@query("part_name", """SELECT doc_id, printf('filegroup-%03d', doc_id) AS plan_file,
  printf('multipart-down-%04d', doc_id) AS interim_file FROM documents""")
def part_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", paths.part_name("filegroup", "doc_id").alias("plan_file"),
        paths.part_name("multipart", "doc_id").alias("interim_file"),
    )
