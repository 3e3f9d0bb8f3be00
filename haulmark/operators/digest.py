"""Digests of whole files and of their byte ranges."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions.digests import md5_base64
from haulmark.operators.ordered import bound_once
from haulmark.sources import filesystem as fs

# Part size, smallest file that is split, part size with interim files, attempts per file.
CHUNK_BYTES = 30 * 1024 * 1024
MULTIPART_BYTES = 4 * 1024 * 1024
INTERIM_CHUNK_BYTES = 16 * 1024 * 1024
TRIES = 5


def range_plan(listing: DataFrame, chunk_bytes: int = CHUNK_BYTES, min_bytes: int = MULTIPART_BYTES,
               name_col: str = "entry_name") -> DataFrame:
    """Byte ranges of every non-empty file: ``part_no`` from 0, ``begin``, ``end`` (inclusive).

    Files below ``min_bytes`` are one range.  Ranges are rows, so one huge file is the work of many tasks.
    """
    size = F.col("file_size")
    chunk = F.when(size >= min_bytes, F.lit(chunk_bytes)).otherwise(size).cast("bigint")
    parts = listing.filter(F.col("is_file") & (size > 0)).withColumn("_chunk", chunk).withColumn(
        "part_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(file_size - 1) div _chunk")))
    )
    begin = F.col("part_no") * F.col("_chunk")
    return parts.select(
        name_col, "part_no", begin.alias("begin"), (F.least(begin + F.col("_chunk"), size) - 1).alias("end"),
        *[c for c in listing.columns if c not in (name_col, "part_no", "begin", "end")],
    )


def _b64(digest: hashlib._Hash) -> str:
    return base64.b64encode(digest.digest()).decode()


def _digest(path: str, begin: int, length: int | None) -> tuple[str, int]:
    digest, count = hashlib.md5(usedforsecurity=False), 0
    with fs.reading(path) as stream:
        for block in fs.blocks(stream, begin, length):
            digest.update(block)
            count += len(block)
    return _b64(digest), count


def _digest_row(path: str, begin: int, length: int, whole: bool) -> tuple[str | None, int, int, str | None]:
    """``(md5, bytes_read, attempts, error)``; every attempt starts from nothing."""
    count, error = 0, None
    for attempt in range(1, TRIES + 1):
        try:
            md5, count = _digest(path, begin, None if whole else length)
            if count == length:
                return md5, count, attempt, None
            error = f"read {count} of {length} bytes"
        except FileNotFoundError as e:
            return None, 0, attempt, str(e)
        except (OSError, ValueError) as e:
            # Also a path that no file system here can open.
            error = str(e)
    return None, count, TRIES, error


_DIGESTED = ["md5", "bytes_read", "attempts", "error"]
_DIGESTED_DDL = "md5 string, bytes_read bigint, attempts int, error string"


def _spread(df: DataFrame, tasks: int | None, key: list[str]) -> DataFrame:
    """One partition per work group where groups were assigned, else hashed over ``tasks`` partitions."""
    if "group_id" in df.columns:
        # A number keeps adaptive execution from merging groups: their rows are few, their files are not.
        return df.repartitionById(tasks or (df.agg(F.max("group_id")).first()[0] or 0) + 1, "group_id")
    tasks = tasks or 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, *key)


def file_md5(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Base64 MD5 of files (``path, file_size``): ``md5, bytes_read, attempts, error`` per path.

    Contents stream through in 1 MiB blocks.  A whole-file MD5 is serial by nature: where one file outweighs the rest,
    compare ``part_md5`` instead.  With a ``group_id`` column (numbers below ``tasks``) each group is one task.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_digest_row(p, 0, s, True) for p, s in zip(batch["path"], batch["file_size"])]
            yield pd.concat([batch[["path", "file_size"]].reset_index(drop=True),
                             pd.DataFrame(rows, columns=_DIGESTED)], axis=1)

    keep = ["path", "file_size"] + (["group_id"] if "group_id" in files.columns else [])
    return _spread(files.select(*keep), tasks, ["path"]).mapInPandas(
        run, f"path string, file_size bigint, {_DIGESTED_DDL}"
    )


def part_md5(ranges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Base64 MD5 of byte ranges of files (``path, part_no, begin, end``)."""
    keys = ["path", "part_no", "begin", "end"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_digest_row(p, b, e - b + 1, False) for p, b, e in zip(batch["path"], batch["begin"], batch["end"])]
            yield pd.concat([batch[keys].reset_index(drop=True), pd.DataFrame(rows, columns=_DIGESTED)], axis=1)

    return _spread(ranges.select(*keys), tasks, ["path", "part_no"]).mapInPandas(
        run, f"path string, part_no bigint, begin bigint, end bigint, {_DIGESTED_DDL}"
    )


def content_part_md5(df: DataFrame, name_col: str, content_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``part_md5`` of contents held in a column; parts count from 1, empty content has one empty part.

    Digests are taken inside the row and only they are exploded, never copies of the content.
    """
    chunk = F.lit(chunk_bytes).cast("int")

    def parts(content):
        last = F.greatest(F.lit(0), F.floor((F.octet_length(content) - 1) / chunk)).cast("int")

        def part(i):
            data = F.substring(content, i * chunk + 1, chunk)
            return F.struct((i + 1).cast("bigint").alias("part_no"),
                            F.octet_length(data).cast("bigint").alias("bytes"), md5_base64(data).alias("md5"))

        return F.transform(F.sequence(F.lit(0), last), part)

    # Every row has a part; the outer form keeps the optimizer from computing all digests once more to filter on them.
    return df.filter(F.col(content_col).isNotNull()).select(
        name_col, bound_once(F.col(content_col).cast("binary"), parts).alias("_parts")
    ).select(name_col, F.inline_outer("_parts"))


def reassemble(chunks: DataFrame, file_col: str, order_col: str, data_col: str) -> DataFrame:
    """Digest of each file put together from parts that arrived in any order: ``parts, bytes, md5``.

    Parts are sorted by Spark and pass one by one through the digest, so a file of any size needs one part of memory.
    A whole-file MD5 is serial: the parts of one file stay in one task (see ``compare_parts`` for the parallel check).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, digest, parts, size, started = None, None, 0, 0, False
        done: list[tuple] = []
        for batch in batches:
            for file, data in zip(batch["file"], batch["data"]):
                if not started or file != name:
                    if started:
                        done.append((name, parts, size, _b64(digest)))
                    name, digest, parts, size, started = file, hashlib.md5(usedforsecurity=False), 0, 0, True
                digest.update(data)
                parts += 1
                size += len(data)
            if done:
                yield pd.DataFrame(done, columns=["file", "parts", "bytes", "md5"])
                done = []
        if started:
            yield pd.DataFrame([(name, parts, size, _b64(digest))], columns=["file", "parts", "bytes", "md5"])

    ddl = f"file {chunks.schema[file_col].dataType.simpleString()}, parts bigint, bytes bigint, md5 string"
    return (
        chunks.select(F.col(file_col).alias("file"), F.col(order_col).alias("no"),
                      F.col(data_col).cast("binary").alias("data"))
        .repartition("file").sortWithinPartitions("file", "no").select("file", "data")
        .mapInPandas(run, ddl).withColumnRenamed("file", file_col)
    )


def range_coverage(listing: DataFrame, done: DataFrame) -> DataFrame:
    """Whether the finished ranges (``entry_name, part_no, begin, end``) make up each file without gap or overlap.

    ``entry_name, file_size, parts, bytes, complete``.  Repeated reports of a part count once; if they do not agree the
    file is not complete.  Only sums travel, so the number of parts of a file does not matter.
    """
    unique = done.groupBy("entry_name", "part_no").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"),
        ((F.min("begin") == F.max("begin")) & (F.min("end") == F.max("end"))).alias("agreed"),
    )
    length = F.col("end") - F.col("begin") + 1
    # Parts are numbered from 0 and begin at number x length of a full part.  If none is longer than that, lengths that
    # add up to the file leave no room for a gap or an overlap.
    sums = unique.groupBy("entry_name").agg(
        F.count("*").alias("parts"), F.sum(length).alias("bytes"), F.max("end").alias("_last"),
        F.min(F.coalesce("agreed", F.lit(False))).alias("_agreed"),
        F.max("part_no").alias("_top"),
        F.max(length).alias("_longest"),
        # Equal only if every part begins where its number says.
        F.min(F.try_divide(F.col("begin"), F.col("part_no"))).alias("_step_min"),
        F.max(F.try_divide(F.col("begin"), F.col("part_no"))).alias("_step_max"),
        F.max(F.when(F.col("part_no") == 0, F.col("begin"))).alias("_first"),
    )
    files = listing.filter(F.col("is_file") & (F.col("file_size") > 0)).select("entry_name", "file_size")
    whole = (
        F.col("_agreed") & (F.col("_first") == 0) & (F.col("_top") + 1 == F.col("parts")) & (F.col("bytes") == F.col("file_size"))
        & (F.col("_last") + 1 == F.col("file_size")) & F.col("_step_min").eqNullSafe(F.col("_step_max"))
        & ((F.col("parts") == 1) | (F.col("_longest") <= F.col("_step_min")))
    )
    zero = F.lit(0).cast("bigint")
    return files.join(sums, "entry_name", "left").select(
        "entry_name", "file_size", F.coalesce("parts", zero).alias("parts"), F.coalesce("bytes", zero).alias("bytes"),
        F.coalesce(whole, F.lit(False)).alias("complete"),
    )
