"""Listing a tree on executors."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.session import pin
from haulmark.sources import filesystem as fs

_COLUMNS = ["entry_name", "is_file", "file_size", "mtime_s", "is_marker", "is_pending", "owner", "grp", "permission"]
_FOUND = ("entry_name string, is_file boolean, file_size bigint, mtime_s double, is_marker boolean, is_pending boolean, "
          "owner string, grp string, permission string")
_BATCH = 10_000

#: How far a task goes down on its own before it hands directories back: entries seen, and directories.
_TASK_ENTRIES = 20_000
_TASK_DIRS = 200


def _lister(root: str, max_depth: int | None):
    def listed(directory: str) -> Iterator[tuple]:
        empty = True
        for child in fs.children(f"{root}/{directory}" if directory else root or "/"):
            empty = False
            name = f"{directory}/{child.name}" if directory else child.name
            yield name, child.is_file, child.size, child.mtime, False, False, child.owner, child.grp, child.permission
        if empty and directory:
            yield directory + "/", False, 0, 0.0, True, False, None, None, None

    def pending(row: tuple) -> tuple:
        return *row[:5], True, *row[6:]

    def walk(directories: Iterator[str]) -> Iterator[tuple]:
        entries, below = 0, deque()
        for directory in directories:
            for row in listed(directory):
                entries += 1
                if row[1] or row[4]:
                    yield row
                elif max_depth is not None and row[0].count("/") + 1 >= max_depth:
                    yield row
                elif entries + len(below) < _TASK_ENTRIES and len(below) < _TASK_DIRS:
                    below.append(row)
                else:
                    yield pending(row)
        dirs = 0
        while below:
            row = below.popleft()
            if entries >= _TASK_ENTRIES or dirs >= _TASK_DIRS:
                yield pending(row)
                continue
            dirs += 1
            yield row
            for child in listed(row[0]):
                entries += 1
                if child[1] or child[4] or (max_depth is not None and child[0].count("/") + 1 >= max_depth):
                    yield child
                elif len(below) < _TASK_DIRS:
                    below.append(child)
                else:
                    yield pending(child)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = walk(name for batch in batches for name in batch["directory"])
        while chunk := list(islice(rows, _BATCH)):
            yield pd.DataFrame(chunk, columns=_COLUMNS)

    return run


def list_files(spark: SparkSession, root: str, max_depth: int | None = None, dirs: str = "empty",
               attributes: bool = False) -> DataFrame:
    """LISTING (with ``mtime``) of everything below ``root``: hidden, zero-byte and oddly named files included.

    ``dirs``: ``"empty"`` reports empty directories (name ends in ``/``), ``"all"`` every directory, ``"none"`` none.
    ``attributes`` adds ``owner, grp, permission`` (octal); they are null of remote entries, and of the names ending in ``/``.
    A root that is a file gives one row.  Each round lists the waiting directories in parallel and stores what it found,
    so a directory is read once.  A task goes further down by itself for a while and hands back what is left for the
    next round; a directory of any size is passed on in batches.
    """
    if dirs not in ("empty", "all", "none"):
        raise ValueError(f"dirs: {dirs!r}")
    root = root.rstrip("/")
    exists, is_file, size = fs.stat(root or "/")
    if not exists:
        raise FileNotFoundError(root)
    if is_file:
        base, _, name = root.rpartition("/")
        one = spark.createDataFrame(
            [(base, name, True, size, None, *fs.attributes(root))],
            "base_dir string, entry_name string, is_file boolean, file_size bigint, mtime timestamp, owner string, grp string, "
            "permission string",
        )
        return one if attributes else one.drop("owner", "grp", "permission")

    frontier, waiting, rounds = spark.createDataFrame([("",)], "directory string"), 1, []
    parallelism = spark.sparkContext.defaultParallelism
    while waiting:
        tasks = min(waiting, 4 * parallelism)
        found = pin(
            frontier.repartition(tasks, "directory").mapInPandas(_lister(root, max_depth), _FOUND), "listing"
        )
        rounds.append(found)
        frontier = found.filter("is_pending").select(F.col("entry_name").alias("directory"))
        waiting = frontier.count()
    wanted = {
        "empty": F.col("is_file") | F.col("is_marker"),
        "all": ~F.col("is_marker"),
        "none": F.col("is_file"),
    }[dirs]
    return reduce(DataFrame.unionByName, rounds).filter(wanted).select(
        F.lit(root).alias("base_dir"), "entry_name", "is_file", "file_size",
        F.when(~F.col("is_marker"), F.col("mtime_s").cast("timestamp")).alias("mtime"),
        *(["owner", "grp", "permission"] if attributes else []),
    )


def file_sizes(paths: DataFrame, tasks: int | None = None) -> DataFrame:
    """``path, size`` of files by ``path``; the size is null where there is no such file or it cannot be looked up."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for path in batch["path"]:
                try:
                    exists, is_file, size = fs.stat(path)
                except (OSError, ValueError):
                    exists, is_file, size = False, False, 0
                sizes.append(size if exists and is_file else None)
            yield pd.DataFrame({"path": batch["path"], "size": pd.array(sizes, dtype="Int64")})

    tasks = tasks or 4 * paths.sparkSession.sparkContext.defaultParallelism
    return paths.select("path").repartition(tasks, "path").mapInPandas(run, "path string, size bigint")
