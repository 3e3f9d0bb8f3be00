"""Copying and deleting files, and reading the results."""

from __future__ import annotations

import base64
import hashlib
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark import schemas
from haulmark.operators.digest import INTERIM_CHUNK_BYTES, TRIES, range_coverage, range_plan
from haulmark.operators.layout import FILES_PER_TASK
from haulmark.session import pin
from haulmark.sources import filesystem as fs
from haulmark.sources.logs import failures, is_done

_RESULT = [f.name for f in schemas.RESULT.fields]


@dataclass(frozen=True)
class CopyConf:
    """How ``copy_files`` works."""

    #: Read every new file back and compare digests before it takes its place.
    verify_checksum: bool = True
    #: Keep a copy whose source no longer has the planned size (a log that is still written).
    allow_size_change: bool = False
    #: Copies in flight per task, to hide the latency of a store.  Small files that go from disk to disk are copied one
    #: after the other: there is nothing to wait for, and threads only get in each other's way.
    threads: int = 4
    tries: int = TRIES
    #: Files of at least this size are copied in parallel ranges; None: never.
    ranged_from: int | None = 2 * INTERIM_CHUNK_BYTES
    chunk_bytes: int = INTERIM_CHUNK_BYTES
    #: Read a file that was copied in ranges once more, in one task, for the digest of the whole.  Without it ``src_md5``
    #: is null for such files, each range being checked by itself, and no task reads more than a range.
    whole_md5: bool = True
    #: Number of tasks; None: one per work group or, if that has many files, several; four per core without groups.
    tasks: int | None = None


class _SizeChanged(Exception):
    pass


class _Mismatch(Exception):
    pass


def _b64(digest: hashlib._Hash) -> str:
    return base64.b64encode(digest.digest()).decode()


def _md5_of(path: str) -> str:
    digest = hashlib.md5(usedforsecurity=False)
    with fs.reading(path) as stream:
        for block in fs.blocks(stream):
            digest.update(block)
    return _b64(digest)


def _pour(sources: list[str], target: str | None) -> tuple[str, int]:
    """Stream the sources one after the other into a new file (or nowhere): digest and bytes."""
    digest, count = hashlib.md5(usedforsecurity=False), 0

    def through(write) -> None:
        nonlocal count
        for source in sources:
            with fs.reading(source) as stream:
                for block in fs.blocks(stream):
                    digest.update(block)
                    count += len(block)
                    write(block)

    if target is None:
        through(lambda block: None)
    else:
        with fs.writing(target) as out:
            through(out.write)
    return _b64(digest), count


def _copy_once(sources: list[str], dest: str, size: int, expected: str | None, allow_size_change: bool,
               conf: CopyConf) -> tuple[str, str, int]:
    """``(status, md5, bytes)``.  The target appears complete and checked or not at all."""
    if not dest:
        md5, count = _pour(sources, None)
        if count != size:
            raise _SizeChanged(f"read {count} of {size} bytes")
        if expected and md5 != expected:
            raise _Mismatch(f"read {md5}, expected {expected}")
        return "READ", md5, count
    fs.make_dir(dest.rpartition("/")[0] or "/")
    temp = f"{dest}._tmp_{uuid.uuid4().hex}"
    try:
        md5, count = _pour(sources, temp)
        if count != size and not allow_size_change:
            raise _SizeChanged(f"copied {count} of {size} bytes")
        if expected and md5 != expected:
            raise _Mismatch(f"read {md5}, expected {expected}")
        if conf.verify_checksum and count and _md5_of(temp) != md5:
            raise _Mismatch("target differs from what was sent")
        fs.move(temp, dest)
    except BaseException:
        fs.remove(temp)
        raise
    return "COPIED" if count == size else "SIZE_CHANGED", md5, count


def _commit(row, size: int, expected: str | None, conf: CopyConf) -> tuple[str, str | None, int]:
    """Put a file whose ranges are all written in its place: ``(status, md5, bytes)``."""
    found = fs.stat(row.src_file)[2]
    if found != size:
        raise _SizeChanged(f"the source has {found} of {size} bytes")
    if not fs.stat(row.temp)[0]:
        # An earlier run of this task has moved it; nobody else does.
        if fs.stat(row.dest_file)[2] != size:
            raise FileNotFoundError(row.temp)
        return "COPIED", _md5_of(row.dest_file) if conf.whole_md5 or expected else None, size
    md5 = _md5_of(row.temp) if conf.whole_md5 or expected else None
    if expected and md5 != expected:
        raise _Mismatch(f"read {md5}, expected {expected}")
    fs.move(row.temp, row.dest_file)
    return "COPIED", md5, size


def _copy_row(row, conf: CopyConf) -> tuple:
    """One RESULT row; trouble with a file is a status, never a failed task."""
    begun = time.monotonic()
    attempts, error, status, md5, count = 0, None, "FAILED", None, 0
    expected = None if row.expected_md5 is None or pd.isna(row.expected_md5) else row.expected_md5
    size = int(row.file_size)
    if row.action == "SKIP":
        status, size = "SKIPPED", 0
    elif row.action == "FAIL":
        error = "target is a directory where a file is expected, or the reverse"
    elif not row.is_file:
        attempts = 1
        try:
            fs.make_dir(row.dest_file)
            status = "MKDIR"
        except (OSError, ValueError) as e:
            error = str(e)
    else:
        parts = int(row.parts)
        in_place = bool(row.temp)
        sources = [row.src_file] if not parts or in_place else [_interim(row.dest_file, i) for i in range(parts)]
        while attempts < conf.tries:
            attempts += 1
            try:
                exists, is_file, _ = fs.stat(row.dest_file) if row.dest_file else (False, True, 0)
                if exists and not is_file:
                    error = "target is a directory"
                    break
                if in_place and parts:
                    status, md5, count = _commit(row, size, expected, conf)
                else:
                    status, md5, count = _copy_once(sources, row.dest_file, size, expected,
                                                    conf.allow_size_change or bool(row.may_grow), conf)
                error = None
                break
            except FileNotFoundError as e:
                if parts:
                    # An earlier run of this task already used the interim files up: copy in one piece.
                    sources, parts, attempts = [row.src_file], 0, attempts - 1
                    continue
                status, error = "OPEN_FAILED", str(e)
                break
            except _SizeChanged as e:
                # A source that grew while its ranges were read is copied in one piece.
                sources, parts = [row.src_file], 0
                status, error = "SIZE_CHANGED", str(e)
            except _Mismatch as e:
                status, error = "CHECKSUM_MISMATCH", str(e)
            except (OSError, ValueError) as e:
                # Also a path that no file system here can open.
                status, error = "FAILED", str(e)
        if in_place:
            fs.remove(row.temp)
        for part_no in range(0 if in_place else int(row.parts)):  # only there if the ranges could be written
            fs.remove(_interim(row.dest_file, part_no))
    elapsed = int((time.monotonic() - begun) * 1000)
    return (row.src_file, row.dest_file, status, attempts, size, count, md5, elapsed, error)


def _interim(dest: str, part_no: int) -> str:
    return f"{dest}._parts.multipart-down-{part_no:04d}"


def _waits(row) -> bool:
    """Whether copying it takes time in which another copy could go on."""
    remote = any(isinstance(path, str) and fs.local_path(path) is None for path in (row.src_file, row.dest_file))
    return remote or (not pd.isna(row.file_size) and row.file_size > fs.BLOCK)


def _copier(conf: CopyConf):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(conf.threads) as pool:
            for batch in batches:
                pairs = list(batch.itertuples(index=False))
                begun = [pool.submit(_copy_row, row, conf) if _waits(row) else None for row in pairs]
                rows = [_copy_row(row, conf) if job is None else job.result() for row, job in zip(pairs, begun)]
                yield pd.DataFrame(rows, columns=_RESULT)

    return run


_FETCHED = "src_file string, dest_file string, part_no bigint, begin bigint, end bigint, ok boolean"


def _fetch_range(row, conf: CopyConf) -> tuple:
    """Copy one byte range: to its place in the new file, or on a store into an interim file of its own."""
    begin, length = int(row.begin), int(row.end - row.begin + 1)
    in_place = bool(row.temp)
    target = row.temp if in_place else _interim(row.dest_file, row.part_no)
    ok = False
    for _ in range(conf.tries):
        try:
            fs.make_dir(target.rpartition("/")[0] or "/")
            digest, count = hashlib.md5(usedforsecurity=False), 0
            opened = fs.writing_at(target, int(row.file_size), begin) if in_place else fs.writing(target)
            with fs.reading(row.src_file) as stream, opened as out:
                for block in fs.blocks(stream, begin, length):
                    out.write(block)
                    digest.update(block)
                    count += len(block)
            ok = count == length
            if ok and conf.verify_checksum:
                back = hashlib.md5(usedforsecurity=False)
                with fs.reading(target) as stream:
                    for block in fs.blocks(stream, begin if in_place else 0, length):
                        back.update(block)
                ok = back.digest() == digest.digest()
            if ok:
                break
        except (OSError, ValueError):
            ok = False
    return row.src_file, row.dest_file, row.part_no, row.begin, row.end, ok


def _fetcher(conf: CopyConf):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(conf.threads) as pool:
            for batch in batches:
                rows = list(pool.map(lambda row: _fetch_range(row, conf), batch.itertuples(index=False)))
                yield pd.DataFrame(rows, columns=["src_file", "dest_file", "part_no", "begin", "end", "ok"])

    return run


def _fetch_ranges(large: DataFrame, conf: CopyConf, tasks: int) -> DataFrame:
    """Copy the ranges of large files in parallel; adds ``temp`` and ``parts`` (0 unless all ranges are there).

    Phase one of two.  A range is written at its offset into one file of full length under a name of its own, the same
    in every run of the task; a stored row tells that it is there.  Phase two moves a file into its place, and only if
    the rows make up the whole file.
    """
    remote = F.col("dest_file").contains("://") & ~F.col("dest_file").startswith("file:")
    # Two sources of one target do not write into one file.
    own = F.concat("dest_file", F.lit(f"._tmp_{uuid.uuid4().hex}_"), F.hex(F.xxhash64("src_file")))
    large = large.withColumn("temp", F.when(~remote, own))
    ranges = range_plan(large, conf.chunk_bytes, 0, "src_file")
    fetched = pin(
        ranges.select("src_file", "dest_file", "file_size", "temp", "part_no", "begin", "end")
        .repartition(tasks, "src_file", "part_no").mapInPandas(_fetcher(conf), _FETCHED),
        "ranges",
    )
    pair = F.struct("src_file", "dest_file").alias("entry_name")
    covered = range_coverage(large.select(pair, "is_file", "file_size").distinct(), fetched.filter("ok").select(pair, "part_no", "begin", "end"))
    found = covered.select("entry_name.*", F.when(F.col("complete"), F.col("parts")).otherwise(0).cast("int").alias("parts"))
    return large.drop("parts").join(found, ["src_file", "dest_file"]).select(large.columns)


def _task_of_group(rows: DataFrame) -> tuple[Column, int]:
    """Number of each row's task, and how many there are: for a group one for every ``FILES_PER_TASK`` files.

    Groups of equal weight are few large files, which wait for the disk, or very many small ones, which take the processor.
    Tasks begin by number, so the numbers are dealt out such that those of one group do not all run at the same time.
    """
    group = F.coalesce("group_id", F.lit(0))
    # One row per group.
    counts = rows.groupBy(group.alias("group_id")).agg(F.count("*").alias("files")).collect()
    if not counts:
        return F.lit(0), 1
    places, total = [], 0
    for row in sorted(counts):
        parts = -(-row.files // FILES_PER_TASK)
        places.append(f"{row.group_id}, struct({total}L AS first, {parts}L AS parts)")
        total += parts
    # The task that begins as number k is k * step modulo the total; rows need the way back.
    step = next(s for s in range(round(total * 0.618) or 1, 2 * total + 1) if gcd(s, total) == 1)
    place = F.element_at(F.expr(f"map({', '.join(places)})"), group)
    part = place["first"] + F.pmod(F.xxhash64("src_file", "dest_file"), place["parts"])
    return F.pmod(part * pow(step, -1, total), F.lit(total)).cast("int"), total


def copy_files(plan: DataFrame, conf: CopyConf | None = None) -> DataFrame:
    """Run a plan of pairs now and return one RESULT row per pair.

    ``plan`` is PAIR, optionally with ``group_id`` (a group is one task, or several if ``conf.tasks`` does not say how many
    there are and it has more than ``FILES_PER_TASK`` files), ``action`` (from ``copy_action``),
    ``expected_md5`` and ``may_grow`` (the source may be a log that is still written).  Targets are written under a name of their own, checked, then moved into place, so a task that
    runs again does no harm.  The results are stored, so that looking at them does not copy again.
    """
    conf = conf or CopyConf()
    spark = plan.sparkSession
    if spark.conf.get("spark.speculation", "false") == "true":
        raise RuntimeError("copy_files must not run with spark.speculation: two copies of one file would race")

    def optional(name: str, dtype: str, default: object = None):
        return F.col(name) if name in plan.columns else F.lit(default).cast(dtype).alias(name)

    rows = plan.select(
        "src_file", "dest_file", "is_file", "file_size", optional("action", "string", "COPY"),
        optional("expected_md5", "string"), optional("may_grow", "boolean", False), F.lit(0).alias("parts"),
        F.lit(None).cast("string").alias("temp"),
        *(["group_id"] if "group_id" in plan.columns else []),
    )
    tasks = conf.tasks or 4 * spark.sparkContext.defaultParallelism
    if conf.ranged_from is not None:
        is_large = F.col("is_file") & (F.col("file_size") >= conf.ranged_from) & (F.col("dest_file") != "") & (
            F.col("file_size") > 0) & ~F.col("action").isin("SKIP", "FAIL")
        if not rows.filter(is_large).isEmpty():
            # Null sizes and actions are not large.
            small = rows.filter(~F.coalesce(is_large, F.lit(False)))
            rows = small.unionByName(_fetch_ranges(rows.filter(is_large), conf, tasks))
    if "group_id" in rows.columns:
        task, groups = (F.col("group_id"), conf.tasks) if conf.tasks else _task_of_group(rows)
        spread = rows.withColumn("group_id", task).repartitionById(groups, "group_id").drop("group_id")
    else:
        spread = rows.repartition(tasks, "src_file", "dest_file")
    return pin(spread.mapInPandas(_copier(conf), schemas.RESULT), "copied")


def raise_on_failure(result: DataFrame) -> None:
    """Raise if any pair failed."""
    count = failures(result).count()
    if count:
        raise RuntimeError(f"{count} pairs failed")


def unfinished(plan: DataFrame, result: DataFrame) -> DataFrame:
    """Pairs of a plan without a good result."""
    done = result.filter(is_done()).select("src_file", "dest_file").distinct()
    return plan.join(done, ["src_file", "dest_file"], "left_anti")


def copy_counters(result: DataFrame) -> DataFrame:
    """One row: copied, skipped and failed pairs, bytes expected (of files that were opened) and copied."""
    copied = F.col("status").isin("COPIED", "READ", "SIZE_CHANGED") & F.col("error").isNull()
    good = is_done()
    opened = ~F.col("status").isin("SKIPPED", "MKDIR", "OPEN_FAILED")
    return result.agg(
        F.count_if(copied).alias("copy"),
        F.count_if(F.col("status") == "SKIPPED").alias("skip"),
        F.count_if(~good).alias("fail"),
        F.coalesce(F.sum(F.when(opened, F.col("bytes_expected"))), F.lit(0)).cast("bigint").alias("bytes_expected"),
        F.coalesce(F.sum(F.when(copied, F.col("bytes_copied"))), F.lit(0)).cast("bigint").alias("bytes_copied"),
    )


def transfer_rate(result: DataFrame) -> DataFrame:
    """Add ``mb_s`` (10^6 bytes per second) per file; null for an elapsed time of 0."""
    rate = F.try_divide(F.col("bytes_copied").cast("double") / F.lit(1000.0).cast("double"),
                        F.col("elapsed_ms").cast("double"))
    return result.withColumn("mb_s", rate)


def _deleter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        status, errors = [], []
        for path, is_file in zip(batch["path"], batch.pop("is_file")):
            try:
                (fs.remove if is_file else fs.remove_tree)(path)
                status.append("DELETED")
                errors.append(None)
            except (OSError, ValueError) as e:
                status.append("FAILED")
                errors.append(str(e))
        yield batch.assign(status=status, error=errors)


def delete_files(candidates: DataFrame, dry_run: bool = True, tasks: int | None = None) -> DataFrame:
    """Delete the files of ``candidates`` (``path, file_size``); a dry run only reports the same rows.

    With an ``is_file`` column, rows that are none are directories and go with all they hold.  What is already gone
    counts as deleted, so a task may run again.
    """
    is_file = F.col("is_file") if "is_file" in candidates.columns else F.lit(True)
    files = candidates.select("path", "file_size", is_file.alias("is_file"))
    if dry_run:
        return files.drop("is_file").withColumn("status", F.lit("WOULD_DELETE")).withColumn(
            "error", F.lit(None).cast("string"))
    tasks = tasks or 4 * candidates.sparkSession.sparkContext.defaultParallelism
    return pin(
        files.repartition(tasks, "path").mapInPandas(
            _deleter, "path string, file_size bigint, status string, error string"
        ),
        "deleted",
    )
