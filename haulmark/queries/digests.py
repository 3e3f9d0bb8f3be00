"""Queries: digests of files, ranges and reassembled parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.digests import md5_base64, md5_hex
from haulmark.operators import diff
from haulmark.operators import digest as ops
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query
from haulmark.sources.files import list_files


@query("md5_base64", "SELECT page_id, to_base64(unhex(md5(html))) AS md5 FROM pages")
def base64_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "pages").select("page_id", md5_base64("html").alias("md5"))


@query("md5_hex", "SELECT page_id, md5(html) AS md5 FROM pages")
def hex_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "pages").select("page_id", md5_hex("html").alias("md5"))


@query("file_md5", f"""WITH {fx.SRC}
SELECT entry_name, file_size, md5, file_size AS bytes_read FROM src""")
def whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files, written from the documents, listed and read."""
    root = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    files = list_files(spark, root).select(F.concat("base_dir", F.lit("/"), "entry_name").alias("path"), "file_size")
    return ops.file_md5(files).select(
        F.expr(f"substring(path, {len(root) + 2})").alias("entry_name"), "file_size", "md5", "bytes_read"
    )


_CHUNK, _MIN = 1000, 2000
_RANGES = f"""WITH {fx.SRC}, c AS (
  SELECT *, CASE WHEN file_size>={_MIN} THEN {_CHUNK} ELSE file_size END AS chunk FROM src WHERE file_size>0),
ranges AS (
  SELECT entry_name, c, CAST(i AS BIGINT) AS part_no, CAST(i*chunk AS BIGINT) AS "begin",
         CAST(least((i+1)*chunk, file_size)-1 AS BIGINT) AS "end"
  FROM (SELECT entry_name, c, file_size, chunk, unnest(range(0, (file_size+chunk-1)//chunk)) AS i FROM c))"""


@query("range_plan", f'{_RANGES} SELECT entry_name, part_no, "begin", "end" FROM ranges')
def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.range_plan(fx.src_listing(spark, sf_dir), _CHUNK, _MIN).select("entry_name", "part_no", "begin", "end")


# Of some files one range never arrived, and some parts were reported twice.
@query("range_coverage", f"""{_RANGES}, done AS (
  SELECT entry_name, part_no, "begin", "end" FROM ranges WHERE part_no<>1 OR strlen(entry_name)%3<>0)
SELECT s.entry_name, s.file_size, CAST(count(d.part_no) AS BIGINT) AS parts,
       CAST(coalesce(sum("end"-"begin"+1), 0) AS BIGINT) AS bytes,
       coalesce(sum("end"-"begin"+1), 0)=s.file_size AS complete
FROM src s LEFT JOIN done d USING (entry_name) WHERE s.file_size>0 GROUP BY s.entry_name, s.file_size""")
def range_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = fx.src_listing(spark, sf_dir)
    planned = ops.range_plan(listing, _CHUNK, _MIN)
    done = planned.filter("part_no<>1 OR octet_length(entry_name)%3<>0")
    return ops.range_coverage(listing, done.unionByName(done.filter("part_no%2=0")))


_HEX = 'substring(hex(encode(c)), 2*"begin"+1, 2*("end"-"begin"+1))'


@query("part_md5", f"""{_RANGES}
SELECT entry_name, part_no, "end"-"begin"+1 AS bytes_read, to_base64(unhex(md5(unhex({_HEX})))) AS md5 FROM ranges""")
def file_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of real files, each read on its own."""
    root = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    planned = ops.range_plan(list_files(spark, root), _CHUNK, _MIN).withColumn(
        "path", F.concat("base_dir", F.lit("/"), "entry_name")
    )
    return ops.part_md5(planned).select(
        F.expr(f"substring(path, {len(root) + 2})").alias("entry_name"), "part_no", "bytes_read", "md5"
    )


def _parts_sql(name: str) -> str:
    return f"""{name}_parts AS (
  SELECT entry_name, CAST(i+1 AS BIGINT) AS part_no, unhex(substring(hex(encode(c)), 2*{_CHUNK}*i+1, 2*{_CHUNK})) AS data
  FROM (SELECT entry_name, c, unnest(range(0, greatest(1, (file_size+{_CHUNK - 1})//{_CHUNK}))) AS i FROM {name}))"""


@query("content_part_md5", f"""WITH {fx.SRC}, {_parts_sql('src')}
SELECT entry_name, part_no, octet_length(data) AS bytes, to_base64(unhex(md5(data))) AS md5 FROM src_parts""")
def content_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.content_part_md5(fx.src_content(spark, sf_dir), "entry_name", "c", _CHUNK)


@query("compare_parts", f"""WITH {fx.SRC}, {fx.DST}, {_parts_sql('src')}, {_parts_sql('dst')}, b AS (
  SELECT coalesce(s.entry_name, d.entry_name) AS entry_name,
         CASE WHEN s.entry_name IS NULL OR d.entry_name IS NULL OR md5(s.data)<>md5(d.data) THEN 1 ELSE 0 END AS bad,
         CASE WHEN s.entry_name IS NULL OR d.entry_name IS NULL THEN 1 ELSE 0 END AS unread
  FROM src_parts s FULL OUTER JOIN dst_parts d ON s.entry_name=d.entry_name AND s.part_no=d.part_no)
SELECT entry_name, CAST(count(*) AS BIGINT) AS parts, CAST(sum(bad) AS BIGINT) AS bad_parts,
       CAST(sum(unread) AS BIGINT) AS unread_parts,
       CASE WHEN sum(bad)=0 THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM b GROUP BY entry_name""")
def compare_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.compare_parts(
        ops.content_part_md5(fx.src_content(spark, sf_dir), "entry_name", "c", _CHUNK),
        ops.content_part_md5(fx.dst_content(spark, sf_dir), "entry_name", "c", _CHUNK),
    )


@query("reassemble", """SELECT conv_id, CAST(count(*) AS BIGINT) AS parts, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
  to_base64(unhex(md5(string_agg(text, '' ORDER BY turn)))) AS md5 FROM conversations GROUP BY conv_id""")
def reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.reassemble(fx.table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
