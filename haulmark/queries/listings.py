"""Queries: listings, manifests and text lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators import listing as ops
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query
from haulmark.session import new_folder
from haulmark.sources import tables
from haulmark.sources.files import list_files

# Names as a walker meets them: hidden and underscore names, blanks, accents, markers for empty directories.
_TREE = """SELECT CASE WHEN doc_id%9=0 THEN '.archive/t'||doc_id%5||'/.hidden'||doc_id
                       WHEN doc_id%9=1 THEN '_tmp dir/'||lang||'/_SUCCESS'||doc_id
                       WHEN doc_id%9=2 THEN 'dir2/é '||doc_id||'.txt'
                       ELSE 'dir/'||lang||'/'||source||'/doc'||doc_id END AS entry_name,
                  CASE WHEN doc_id%50=0 THEN '' ELSE text END AS c FROM {documents}
           UNION ALL SELECT 'void/'||lang||'/d'||doc_id||'/', '' FROM {documents} WHERE doc_id%25=0"""


def _tree(spark: SparkSession, sf_dir: str) -> str:
    content = spark.sql(_TREE, documents=fx.table(spark, sf_dir, "documents"))
    return fx.written_tree(spark, sf_dir, "names", content)


_TREE_ORACLE = f"WITH tree AS ({_TREE.format(documents='documents')})"


@query("list_files", f"""{_TREE_ORACLE}
SELECT entry_name, true AS is_file, CAST(strlen(c) AS BIGINT) AS file_size FROM tree WHERE NOT ends_with(entry_name,'/')""")
def all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files written from the documents, listed level by level."""
    return list_files(spark, _tree(spark, sf_dir), dirs="none").select("entry_name", "is_file", "file_size")


@query("list_empty_dirs", f"""{_TREE_ORACLE}
SELECT entry_name, CAST(0 AS BIGINT) AS file_size FROM tree WHERE ends_with(entry_name,'/')""")
def empty_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, _tree(spark, sf_dir)).filter("not is_file").select("entry_name", "file_size")


_OBJECTS = """CASE WHEN doc_id%3=0 THEN 's3n://bucket/dir2/' ELSE 's3n://bucket/dir/' END||lang||'/'||
  CASE WHEN doc_id%20=0 THEN source||'/' ELSE source||'/doc'||doc_id END"""


@query("listing_from_table", f"""WITH objects AS (SELECT {_OBJECTS} AS path, n_chars FROM documents)
SELECT substring(path, 18) AS entry_name, NOT ends_with(path,'/') AS is_file, n_chars AS file_size
FROM objects WHERE starts_with(path, 's3n://bucket/dir/')""")
def from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = fx.table(spark, sf_dir, "documents").selectExpr(f"{_OBJECTS} AS path", "n_chars")
    return tables.listing_from_table(objects, "path", "n_chars", "s3n://bucket/dir").drop("base_dir")


@query("dedupe_listing", """WITH l AS (
  SELECT 'o'||l_orderkey||'/'||l_linenumber AS entry_name, CAST(l_quantity AS BIGINT) AS file_size, l_partkey AS part,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_quantity AS BIGINT), l_partkey) AS rn
  FROM lineitem)
SELECT entry_name, file_size, part, rn=1 AS kept FROM l""")
def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "'o'||l_orderkey||'/'||l_linenumber AS entry_name", "CAST(l_quantity AS bigint) AS file_size",
        "l_partkey AS part",
    )
    return ops.mark_first(rows, ["file_size", "part"])


@query("make_pairs", f"""WITH {fx.SRC}
SELECT '{fx.SRC_ROOT}/'||entry_name AS src_file, '/dst/'||entry_name AS dest_file, is_file, file_size FROM src""")
def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.make_pairs(fx.src_listing(spark, sf_dir), "/dst//")


@query("union_sources", f"""WITH {fx.SRC}
SELECT '/a' AS base_dir, 'x/'||entry_name AS entry_name, file_size FROM src WHERE starts_with(entry_name,'en/')
UNION ALL SELECT '/b', 'y/'||entry_name, file_size FROM src WHERE NOT starts_with(entry_name,'en/')""")
def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fx.src_listing(spark, sf_dir)
    english = F.col("entry_name").startswith("en/")
    return ops.union_sources([src.filter(english), src.filter(~english)], ["/a/x", "/b/y/"]).select(
        "base_dir", "entry_name", "file_size"
    )


@query("listing_summary", f"""WITH {fx.SRC}
SELECT CAST(count(*) AS BIGINT) AS files, CAST(0 AS BIGINT) AS empty_dirs,
       CAST(count(*) FILTER (file_size=0) AS BIGINT) AS empty_files, CAST(sum(file_size) AS BIGINT) AS total_bytes,
       max(file_size) AS max_size, coalesce(min_by(entry_name, row(-file_size, entry_name)), '') AS max_name FROM src""")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.listing_summary(fx.src_listing(spark, sf_dir))


@query("order_by_size", f"""WITH {fx.SRC}
SELECT entry_name, file_size, CAST(row_number() OVER (ORDER BY file_size DESC, entry_name) AS BIGINT) AS position
FROM src""")
def by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.order_by_size(fx.src_listing(spark, sf_dir).select("entry_name", "file_size"), "entry_name")


@query("order_by_name", f"""WITH {fx.DST}
SELECT entry_name, is_file, CAST(row_number() OVER (ORDER BY is_file DESC, entry_name) AS BIGINT) AS position
FROM (SELECT entry_name, entry_name NOT LIKE '%.extra' AS is_file FROM dst)""")
def by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.dst_listing(spark, sf_dir).selectExpr("entry_name", "entry_name NOT LIKE '%.extra' AS is_file")
    return ops.order_by_name(rows)


@query("largest", f"""WITH {fx.SRC}
SELECT entry_name, file_size FROM src ORDER BY file_size DESC, entry_name LIMIT 10""")
def largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return ops.largest(fx.src_listing(spark, sf_dir).select("entry_name", "is_file", "file_size"), 10).drop("is_file")


def _written_lines(spark: SparkSession, lines: DataFrame, label: str) -> str:
    path = new_folder(spark, label)
    lines.select("value").write.text(path)
    return path


@query("read_manifest", f"""WITH {fx.MANIFEST}
SELECT CASE WHEN size IS NULL THEN value ELSE f[1] END AS src_file,
       CASE WHEN size IS NULL THEN NULL ELSE f[2] END AS dest_file, size AS file_size,
       CASE WHEN size IS NOT NULL THEN 'OK' WHEN len(f)=3 THEN 'BAD_SIZE' ELSE 'BAD_FIELD_COUNT' END AS outcome
FROM sized""")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest text files, written from the pages and read back: accepted rows and rejects."""
    good, bad = tables.read_manifest(spark, _written_lines(spark, fx.manifest_lines(spark, sf_dir), "manifest"))
    return good.select("src_file", "dest_file", "file_size", F.lit("OK").alias("outcome")).unionByName(
        bad.select(F.col("value").alias("src_file"), F.lit(None).cast("string").alias("dest_file"),
                   F.lit(None).cast("bigint").alias("file_size"), F.col("reason").alias("outcome"))
    )


@query("manifest_totals", f"""WITH {fx.MANIFEST}
SELECT CAST(count(size) AS BIGINT) AS files, CAST(coalesce(sum(size),0) AS BIGINT) AS bytes,
       CAST(count(*)-count(size) AS BIGINT) AS rejected FROM sized""")
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.manifest_totals(*tables.parse_manifest(fx.manifest_lines(spark, sf_dir)))


@query("read_uri_list", "SELECT url AS uri FROM pages")
def uri_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = fx.table(spark, sf_dir, "pages").select(F.col("url").alias("value"))
    return tables.read_uri_list(spark, _written_lines(spark, urls, "uris"))


@query("check_sources", """SELECT '/data/o'||o_orderkey AS uri FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = fx.table(spark, sf_dir, "orders").selectExpr("'/data/o'||o_orderkey AS uri")
    present = fx.table(spark, sf_dir, "lineitem").selectExpr("'/data/o'||l_orderkey AS uri")
    return tables.missing_sources(asked, present)
