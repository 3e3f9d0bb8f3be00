"""Queries: comparing two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.paths import ancestors, parent
from haulmark.operators import diff
from haulmark.operators.listing import parents_of, totals_match
from haulmark.operators.listing import presence as listing_presence
from haulmark.operators.sync import extraneous
from haulmark.plans.compare import compare_pairs
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query

_DIFF = f"""WITH {fx.SRC}, {fx.DST}, diff AS (
  SELECT coalesce(s.entry_name, d.entry_name) AS entry_name, s.file_size AS src_size, d.file_size AS dst_size,
         s.md5 AS src_md5, d.md5 AS dst_md5,
         CASE WHEN d.entry_name IS NULL THEN 'MISSING_AT_DEST' WHEN s.entry_name IS NULL THEN 'MISSING_AT_SRC'
              WHEN s.file_size=d.file_size THEN 'SAME' ELSE 'SIZE_MISMATCH' END AS status
  FROM src s FULL OUTER JOIN dst d ON s.entry_name=d.entry_name)"""

_CONTENT = f"""{_DIFF}, full_diff AS (
  SELECT entry_name, src_size, dst_size,
         CASE WHEN status<>'SAME' THEN status WHEN src_size=0 THEN 'SAME_EMPTY'
              WHEN src_md5<>dst_md5 THEN 'CHECKSUM_MISMATCH' ELSE 'SAME' END AS status FROM diff)"""


@query("compare_trees", f"""{_CONTENT}
SELECT status, CAST(count(*) AS BIGINT) AS files,
       CAST(sum(coalesce(src_size,0)+coalesce(dst_size,0)) AS BIGINT) AS bytes
FROM full_diff GROUP BY status""")
def compare_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: both trees compared by name, size and content, one row per outcome."""
    compared = diff.content_diff(fx.src_listing(spark, sf_dir, True), fx.dst_listing(spark, sf_dir, True))
    zero = F.lit(0).cast("bigint")
    return compared.groupBy("status").agg(
        F.count("*").alias("files"),
        F.sum(F.coalesce("src_size", zero) + F.coalesce("dst_size", zero)).alias("bytes"),
    )


@query("dir_diff", f"{_DIFF} SELECT entry_name, src_size, dst_size, status FROM diff")
def dir_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.dir_diff(fx.src_listing(spark, sf_dir), fx.dst_listing(spark, sf_dir))


@query("diff_union", f"{_DIFF} SELECT entry_name, src_size, dst_size, status FROM diff WHERE status<>'SAME'")
def diff_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff_union(dir_diff(spark, sf_dir))


@query("presence", f"""WITH {fx.SRC}, {fx.DST}
SELECT entry_name, 'ONLY_SRC' AS presence FROM src WHERE entry_name NOT IN (SELECT entry_name FROM dst)
UNION ALL SELECT entry_name, 'ONLY_DST' FROM dst WHERE entry_name NOT IN (SELECT entry_name FROM src)
UNION ALL SELECT entry_name, 'BOTH' FROM src WHERE entry_name IN (SELECT entry_name FROM dst)""")
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing_presence(fx.src_listing(spark, sf_dir), fx.dst_listing(spark, sf_dir))
    where = F.when(~F.col("in_b"), "ONLY_SRC").when(~F.col("in_a"), "ONLY_DST").otherwise("BOTH")
    return found.select("entry_name", where.alias("presence"))


@query("totals_match", f"""WITH {fx.SRC}, {fx.DST}
SELECT s.n AS src_files, s.b AS src_bytes, d.n AS dst_files, d.b AS dst_bytes, s.n=d.n AND s.b=d.b AS totals_match
FROM (SELECT CAST(count(*) AS BIGINT) n, CAST(sum(file_size) AS BIGINT) b FROM src) s,
     (SELECT CAST(count(*) AS BIGINT) n, CAST(sum(file_size) AS BIGINT) b FROM dst) d""")
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals_match(fx.src_listing(spark, sf_dir), fx.dst_listing(spark, sf_dir))


def _digests(listing: DataFrame, root: str) -> DataFrame:
    return listing.select(F.concat(F.lit(root + "/"), "entry_name").alias("path"), "md5")


# Contents of files numbered 7, 14, ... at the target could not be read.
_COMPARED = f"""WITH {fx.PAIRS}, {fx.DST}, digests AS (
  SELECT '{fx.DST_ROOT}/'||entry_name AS path, md5 FROM dst WHERE doc_id%7<>0)
SELECT p.src_file, p.dest_file, p.file_size, t.file_size AS dest_size, s.md5 AS src_md5, d.md5 AS dst_md5,
       CASE WHEN t.file_size IS NULL THEN 'MISSING' WHEN p.file_size<>t.file_size THEN 'SIZE_MISMATCH'
            WHEN p.file_size=0 THEN 'MATCH' WHEN d.md5 IS NULL THEN 'UNREADABLE'
            WHEN s.md5=d.md5 THEN 'MATCH' ELSE 'MISMATCH' END AS status
FROM pairs p JOIN src s ON s.doc_id=p.doc_id LEFT JOIN digests d ON d.path=p.dest_file
LEFT JOIN dst t ON '{fx.DST_ROOT}/'||t.entry_name=p.dest_file"""


@query("compare_content", _COMPARED)
def compare_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    dst = fx.dst_listing(spark, sf_dir, True)
    sizes = dst.select(F.concat(F.lit(fx.DST_ROOT + "/"), "entry_name").alias("dest_file"), F.col("file_size").alias("dest_size"))
    pairs = fx.grouped_pairs(spark, sf_dir).drop("group_id").join(sizes, "dest_file", "left")
    return diff.compare_content(
        pairs, _digests(fx.src_listing(spark, sf_dir, True), fx.SRC_ROOT), _digests(dst.filter("doc_id%7<>0"), fx.DST_ROOT)
    )


@query("skip_empty_pairs", f"WITH {fx.PAIRS} SELECT src_file, dest_file, file_size FROM pairs WHERE file_size>0")
def skip_empty_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.skip_empty_pairs(fx.grouped_pairs(spark, sf_dir)).select("src_file", "dest_file", "file_size")


@query("compare_file", f"""WITH {fx.SRC}, {fx.DST}, paired AS (
  SELECT s.entry_name, true AS with_target, s.file_size AS src_size, d.file_size AS dst_size, s.md5=d.md5 AS same
  FROM src s LEFT JOIN dst d ON d.entry_name=s.entry_name
  UNION ALL SELECT entry_name, false, file_size, NULL, true FROM src WHERE doc_id%3=0),
judged AS (SELECT *, CASE WHEN NOT with_target THEN 'READABLE' WHEN dst_size IS NULL THEN 'MISSING'
    WHEN src_size<>dst_size THEN 'SIZE_MISMATCH' WHEN same THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM paired)
SELECT entry_name, with_target, src_size, dst_size, status,
  CASE WHEN status IN ('MATCH', 'MISMATCH', 'READABLE') AND src_size>0 THEN (src_size+1023)//1024 END AS parts
FROM judged""")
def compare_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files: every source against its target, which may be missing, longer or empty, and a third by themselves."""
    content = fx.src_content(spark, sf_dir)
    src = fx.written_tree(spark, sf_dir, "src", content)
    dst = fx.written_tree(spark, sf_dir, "dst", fx.dst_content(spark, sf_dir))
    source = F.concat(F.lit(src + "/"), "entry_name").alias("src_file")
    pairs = content.select(source, F.concat(F.lit(dst + "/"), "entry_name").alias("dest_file")).unionByName(
        content.filter("doc_id%3=0").select(source, F.lit(None).cast("string").alias("dest_file")))
    return compare_pairs(pairs, chunk_bytes=1024).select(
        F.expr(f"substring(src_file, {len(src) + 2})").alias("entry_name"), (F.col("dest_file") != "").alias("with_target"),
        "src_size", "dst_size", "status", "parts",
    )


@query("verify_objects", f"""WITH {fx.SRC}, meta AS (
  SELECT entry_name, file_size, md5,
    CASE WHEN doc_id%3=0 THEN NULL WHEN doc_id%31=0 THEN file_size+1 ELSE file_size END AS ulen,
    CASE WHEN doc_id%4=0 THEN NULL WHEN doc_id%23=0 THEN 'AAAAAAAAAAAAAAAAAAAAAA==' ELSE md5 END AS umd5,
    CASE WHEN doc_id%8=0 THEN NULL ELSE md5 END AS smd5 FROM src)
SELECT entry_name, file_size, coalesce(umd5, smd5) AS expected_md5, md5,
  CASE WHEN ulen<>file_size THEN 'LENGTH_CONFLICT' WHEN file_size=0 THEN 'OK'
       WHEN coalesce(umd5, smd5) IS NULL THEN 'NO_CHECKSUM' WHEN coalesce(umd5, smd5)<>md5 THEN 'CHECKSUM_MISMATCH'
       ELSE 'OK' END AS status FROM meta""")
def verify_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = fx.src_listing(spark, sf_dir, True)
    meta = listing.select(
        "entry_name", F.col("file_size").alias("content_length"),
        F.expr("CASE WHEN doc_id%8=0 THEN NULL ELSE md5 END").alias("content_md5"),
        F.expr("""map_filter(map(
            'contentlength', CAST(CASE WHEN doc_id%3=0 THEN NULL WHEN doc_id%31=0 THEN file_size+1
                                       ELSE file_size END AS string),
            'contentmd5', CASE WHEN doc_id%4=0 THEN NULL WHEN doc_id%23=0 THEN 'AAAAAAAAAAAAAAAAAAAAAA=='
                               ELSE md5 END), (k, v) -> v IS NOT NULL)""").alias("user_metadata"),
    )
    digests = listing.select("entry_name", "md5", F.col("file_size").alias("bytes_read"))
    return diff.verify_objects(listing, meta, digests)


@query("extraneous", f"""WITH {fx.SRC}, {fx.DST},
dstx AS (SELECT entry_name, true AS is_file FROM dst
         UNION ALL SELECT 'gone/'||source||'/doc'||doc_id, true FROM documents WHERE doc_id%7=0),
src_dirs AS (SELECT DISTINCT array_to_string(string_split(entry_name,'/')[1:n], '/') AS entry_name
             FROM src, range(1, 64) r(n) WHERE n < len(string_split(entry_name,'/'))),
dst_dirs AS (SELECT DISTINCT array_to_string(string_split(entry_name,'/')[1:n], '/') AS entry_name
             FROM dstx, range(1, 64) r(n) WHERE n < len(string_split(entry_name,'/'))),
gone AS (SELECT * FROM (SELECT entry_name, is_file FROM dstx UNION ALL SELECT entry_name, false FROM dst_dirs)
         WHERE entry_name NOT IN (SELECT entry_name FROM src UNION ALL SELECT entry_name FROM src_dirs)),
below AS (SELECT DISTINCT g.entry_name FROM gone g, range(1, 64) r(n)
          WHERE n < len(string_split(g.entry_name,'/'))
            AND array_to_string(string_split(g.entry_name,'/')[1:n], '/') IN (SELECT entry_name FROM gone))
SELECT entry_name, is_file FROM gone WHERE entry_name NOT IN (SELECT entry_name FROM below)""")
def extraneous_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fx.src_listing(spark, sf_dir).select("entry_name", "is_file")
    more = fx.table(spark, sf_dir, "documents").filter("doc_id%7=0").selectExpr(
        "'gone/'||source||'/doc'||doc_id AS entry_name", "true AS is_file"
    )
    dst = fx.dst_listing(spark, sf_dir).select("entry_name", "is_file").unionByName(more)
    return extraneous(src.unionByName(parents_of(src)), dst.unionByName(parents_of(dst)))


@query("ancestors", f"""WITH {fx.SRC}
SELECT entry_name, CASE WHEN n+1=len(f) THEN true ELSE false END AS is_parent, array_to_string(f[1:n], '/') AS ancestor
FROM (SELECT entry_name, string_split(entry_name,'/') AS f FROM src), range(1, 64) r(n) WHERE n < len(f)""")
def ancestor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.src_listing(spark, sf_dir).select(
        "entry_name", F.explode(ancestors("entry_name")).alias("ancestor")
    ).withColumn("is_parent", F.col("ancestor") == parent("entry_name"))
