"""Queries: listings of a store by key, and objects with what was promised about them."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators.objects import download_files, read_objects, upload_files, verify_store
from haulmark.queries import fixtures as fx
from haulmark.queries.base import query
from haulmark.queries.listings import _TREE_ORACLE, _tree
from haulmark.session import new_folder
from haulmark.sources.keys import list_keys, register_keys
from haulmark.sources.stores import FolderStore

_PAGE_KEYS, _TASK_PAGES = 50, 2


@query("list_keys", f"""{_TREE_ORACLE}
SELECT entry_name, NOT ends_with(entry_name,'/') AS is_file, CAST(strlen(c) AS BIGINT) AS file_size FROM tree""")
def all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files listed as keys, in pages small enough that intervals are handed back and split."""
    keys = list_keys(spark, FolderStore(_tree(spark, sf_dir)), page_keys=_PAGE_KEYS, task_pages=_TASK_PAGES)
    return keys.select("entry_name", "is_file", "file_size")


@query("keys_source", f"""{_TREE_ORACLE}
SELECT entry_name AS key, CAST(strlen(c) AS BIGINT) AS size FROM tree WHERE starts_with(entry_name, 'dir/')""")
def keys_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a data source: the filter on a subtree reaches the store."""
    register_keys(spark, "query_keys", FolderStore(_tree(spark, sf_dir)), page_keys=_PAGE_KEYS)
    rows = spark.read.format("query_keys").option("pushdown", True).load()
    return rows.filter(F.col("key").startswith("dir/")).select("key", "size")


def _uploaded(spark: SparkSession, sf_dir: str, label: str) -> tuple[FolderStore, DataFrame]:
    src = fx.written_tree(spark, sf_dir, "src", fx.src_content(spark, sf_dir))
    store = FolderStore(new_folder(spark, label))
    pairs = fx.src_content(spark, sf_dir).select(
        F.concat(F.lit(src + "/"), "entry_name").alias("src_file"), F.concat(F.lit("kept/"), "entry_name").alias("key"))
    return store, upload_files(pairs, store)


@query("upload_files", f"""WITH {fx.SRC}
SELECT entry_name, 'UPLOADED' AS status, file_size AS content_length, md5 AS content_md5, md5 AS user_md5,
       CAST(file_size AS VARCHAR) AS user_length FROM src""")
def uploads_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files put into a store, and what the store then knows about them."""
    store, uploaded = _uploaded(spark, sf_dir, "uploaded")
    known = read_objects(list_keys(spark, store, "kept"), store, contents=False)
    names = uploaded.select(F.expr("substring(key, 6)").alias("entry_name"), "status")
    return names.join(known, "entry_name").select(
        "entry_name", "status", "content_length", "content_md5", F.col("user_metadata")["contentmd5"].alias("user_md5"),
        F.col("user_metadata")["contentlength"].alias("user_length"))


# What happens to an object after its upload; the sizes of empty ones cannot shrink.
_HARM = """CASE WHEN doc_id%31=0 THEN 'LENGTH' WHEN doc_id%29=0 THEN 'FORGET' WHEN doc_id%23=0 AND {size}>0 THEN 'CUT'
  WHEN doc_id%19=0 AND {size}>0 THEN 'CHANGE' WHEN doc_id%17=0 THEN 'NO_MD5' WHEN doc_id%13=0 AND {size}>0 THEN 'LOSE'
  ELSE 'NONE' END"""
_HARMED = f"WITH {fx.SRC}, harmed AS (SELECT *, {_HARM.format(size='file_size')} AS harm FROM src)"


def _harm(store: FolderStore):
    """Objects that lost bytes, changed, disappeared, or whose metadata say something else."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, harm in zip(batch["key"], batch["harm"]):
                path = f"{store.root}/{key}"
                promise = store.head(key)
                data = b"".join(store.get(key))
                if harm == "LENGTH":
                    store.put(key, [data], {**promise.user_metadata, "contentlength": str(promise.size + 1)})
                elif harm == "NO_MD5":
                    store.promise(key, promise._replace(md5=None, user_metadata={}))
                elif harm == "FORGET":
                    os.unlink(f"{store.promised}/{key}")
                elif harm == "LOSE":
                    os.unlink(path)
                else:
                    with open(path, "wb") as out:
                        out.write(data[:-1] if harm == "CUT" else bytes([data[0] ^ 1]) + data[1:])
            yield batch[["key"]]

    return run


def _harmed_store(spark: SparkSession, sf_dir: str) -> tuple[FolderStore, DataFrame]:
    """A store of its own, and its listing from before the harm."""
    store, _ = _uploaded(spark, sf_dir, "harmed")
    listing = list_keys(spark, store, "kept")
    harmed = fx.src_content(spark, sf_dir).select(
        F.concat(F.lit("kept/"), "entry_name").alias("key"), F.expr(_HARM.format(size="octet_length(c)")).alias("harm"))
    harmed.filter("harm <> 'NONE'").mapInPandas(_harm(store), "key string").write.format("noop").mode("overwrite").save()
    return store, listing


@query("verify_store", f"""{_HARMED}
SELECT entry_name, file_size, CASE harm WHEN 'LENGTH' THEN 'LENGTH_CONFLICT' WHEN 'FORGET' THEN 'NO_METADATA'
  WHEN 'CUT' THEN 'SHORT_READ' WHEN 'CHANGE' THEN 'CHECKSUM_MISMATCH' WHEN 'LOSE' THEN 'UNREADABLE'
  WHEN 'NO_MD5' THEN CASE WHEN file_size=0 THEN 'OK' ELSE 'NO_CHECKSUM' END ELSE 'OK' END AS status FROM harmed""")
def store_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real store read against its metadata: all seven outcomes."""
    store, listing = _harmed_store(spark, sf_dir)
    return verify_store(listing, store, tries=2).select("entry_name", "file_size", "status")


@query("download_files", f"""{_HARMED},
judged AS (SELECT *, CASE harm WHEN 'LENGTH' THEN 'LENGTH_CONFLICT' WHEN 'FORGET' THEN 'NO_METADATA'
  WHEN 'CUT' THEN 'SHORT_READ' WHEN 'CHANGE' THEN 'CHECKSUM_MISMATCH' WHEN 'LOSE' THEN 'OPEN_FAILED'
  WHEN 'NO_MD5' THEN CASE WHEN file_size=0 THEN 'DOWNLOADED' ELSE 'NO_CHECKSUM' END ELSE 'DOWNLOADED' END AS status FROM harmed)
SELECT entry_name, status, status='DOWNLOADED' AS is_there, CASE WHEN status='DOWNLOADED' THEN md5 END AS md5 FROM judged""")
def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store fetched: what its metadata do not bear out does not become a file."""
    store, listing = _harmed_store(spark, sf_dir)
    dest = new_folder(spark, "downloaded")
    objects = listing.select(F.concat(F.lit("kept/"), "entry_name").alias("key"),
                             F.concat(F.lit(dest + "/"), "entry_name").alias("dest_file"))
    done = download_files(objects, store, tries=2)
    there = list_keys(spark, FolderStore(dest)).select("entry_name", F.lit(True).alias("is_there"))
    return done.select(F.expr("substring(key, 6)").alias("entry_name"), "status", "md5").join(there, "entry_name", "left").select(
        "entry_name", "status", F.coalesce("is_there", F.lit(False)).alias("is_there"), "md5")
