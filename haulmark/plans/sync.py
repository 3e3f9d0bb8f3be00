"""Incremental sync: what to copy, delete and fix so that a target equals its sources."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.operators.attributes import apply_attributes
from haulmark.operators.layout import assign_groups
from haulmark.operators.listing import parents_of
from haulmark.operators.sync import (
    attr_drift, budget_admit, copy_action, duplicate_dests, extraneous, select_updates,
)
from haulmark.operators.transfer import CopyConf, copy_files, delete_files
from haulmark.session import pin
from haulmark.sources.files import list_files
from haulmark.sources.logs import failures

_ATTRIBUTES = {"owner", "grp", "permission"}


@dataclass(frozen=True)
class SyncPlan:
    """``todo``: PAIR with ``action``; ``delete``: topmost target entries; ``drift``: attribute changes, or None.

    ``delete_files``: every target file that goes, those below a topmost directory included.
    """

    todo: DataFrame
    delete: DataFrame | None
    drift: DataFrame | None
    delete_files: DataFrame | None = None


@dataclass(frozen=True)
class SyncResult:
    """``copied``: RESULT rows; ``deleted``: one row per file and per topmost directory, told apart by ``is_file``, or None."""

    copied: DataFrame
    deleted: DataFrame | None


def plan_sync(src: DataFrame, dst: DataFrame, dest_root: str, overwrite: bool = False, update: bool = False,
              delete: bool = False, max_files: int | None = None, max_bytes: int | None = None,
              attrs: frozenset[str] | None = None) -> SyncPlan:
    """Plan from two listings (``src`` may come from ``union_sources``); nothing is copied yet.

    Raises if two sources claim one target.  Deleting looks at the whole source list, so files left out by ``update``
    or a limit stay.
    """
    if overwrite and update:
        raise ValueError("overwrite and update exclude each other")
    lacking = _ATTRIBUTES - (set(src.columns) & set(dst.columns)) if attrs is not None else set()
    if lacking:
        raise ValueError(f"both listings need the columns {sorted(lacking)} to compare attributes")
    if delete and not (overwrite or update):
        raise ValueError("delete needs overwrite or update")
    clashes = duplicate_dests(src.select(F.col("entry_name").alias("dest_file"),
                                         F.concat("base_dir", F.lit("/"), "entry_name").alias("src_file")))
    clash = clashes.orderBy("dest_file").first()
    if clash:
        raise ValueError(f"{clash.first_source} and {clash.last_source} would both become {clash.dest_file}")

    chosen = src
    if update:
        chosen = select_updates(src, dst).select(src.columns).unionByName(src.filter("not is_file"))
    if max_files is not None or max_bytes is not None:
        chosen = budget_admit(chosen, max_files, max_bytes)
    acted = copy_action(chosen, dst, overwrite=overwrite, update=update)
    todo = acted.select(
        F.concat("base_dir", F.lit("/"), "entry_name").alias("src_file"),
        F.concat(F.lit(dest_root.rstrip("/") + "/"), "entry_name").alias("dest_file"),
        "is_file", "file_size", "action",
    )
    gone = files = None
    if delete:
        names = src.select("entry_name", "is_file").unionByName(parents_of(src))
        # The listing of the target may leave out directories that hold something.
        gone = extraneous(names, dst.select("entry_name", "is_file").unionByName(parents_of(dst)))
        files = dst.filter("is_file").select("entry_name", "file_size").join(src.select("entry_name"), "entry_name", "left_anti")
    drift = attr_drift(src, dst, attrs) if attrs is not None else None
    return SyncPlan(todo, gone, drift, files)


def run_sync(plan: SyncPlan, dest_root: str, groups: int = 200, conf: CopyConf | None = None,
             dry_run_deletes: bool = True, delete_after_failures: bool = False) -> SyncResult:
    """Carry a plan out: copy ``todo``, balanced over ``groups`` work groups, then delete.

    Groups are balanced by bytes, and one of small files has far more of them than the others; it is several tasks, as of
    ``copy_files``.  What to do and the groups are stored, because both are read several times.
    If a pair failed nothing is deleted (``deleted`` is None), unless ``delete_after_failures``.  Files go first, each a row of some task; what is left of the topmost directories is then empty and goes with them.
    """
    grouped = pin(assign_groups(pin(plan.todo, "todo"), groups), "groups")
    copied = copy_files(grouped, replace(conf or CopyConf(), tasks=None))
    if plan.delete is None or not (delete_after_failures or failures(copied).isEmpty()):
        return SyncResult(copied, None)
    path = F.concat(F.lit(dest_root.rstrip("/") + "/"), "entry_name").alias("path")
    files = delete_files(plan.delete_files.select(path, "file_size"), dry_run_deletes)
    dirs = delete_files(plan.delete.filter("not is_file").select(path, F.lit(0).cast("bigint").alias("file_size"), "is_file"),
                        dry_run_deletes)
    # A file may be empty, so sizes do not tell the two apart.
    deleted = files.withColumn("is_file", F.lit(True)).unionByName(dirs.withColumn("is_file", F.lit(False)))
    return SyncResult(copied, deleted)


def keep_attributes(src: DataFrame, dest_root: str, attrs: frozenset[str]) -> DataFrame:
    """After the copies: give what is below ``dest_root`` the owner, group or permission that ``src`` has for its name.

    ``src`` is a listing with ``owner, grp, permission``, such as ``list_files(..., dirs="all", attributes=True)``.  The target
    is listed anew, so files that were just copied are taken in.  Rows as of ``apply_attributes``.
    """
    there = list_files(src.sparkSession, dest_root, dirs="all", attributes=True)
    return apply_attributes(attr_drift(src, there, attrs), dest_root)
