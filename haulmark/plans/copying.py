"""Copy a tree, or what a manifest names."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.operators.layout import assign_groups
from haulmark.operators.listing import make_pairs
from haulmark.operators.routing import route
from haulmark.operators.transfer import CopyConf, copy_files
from haulmark.sources.files import list_files
from haulmark.sources.tables import read_manifest


def routed(pairs: DataFrame) -> DataFrame:
    """Pairs with ``action`` (``FAIL`` if the route is not supported) and ``may_grow``.

    Within one kind of file system a source may be a log that is still written; downloads must have the planned size.
    """
    return route(pairs).withColumn("action", F.when(F.col("route") == "UNSUPPORTED", "FAIL").otherwise("COPY")).withColumn(
        "may_grow", F.col("route") == "INTERNAL_COPY").drop("route")


def copy_pairs(pairs: DataFrame, groups: int, conf: CopyConf | None = None) -> DataFrame:
    """Route every pair, balance the supported ones over ``groups`` tasks, copy; others come back as ``FAILED``."""
    return copy_files(assign_groups(routed(pairs), groups), replace(conf or CopyConf(), tasks=groups))


def copy_tree(spark: SparkSession, src_root: str, dst_root: str, groups: int = 200,
              conf: CopyConf | None = None) -> DataFrame:
    """Copy every file and empty directory below ``src_root``."""
    return copy_pairs(make_pairs(list_files(spark, src_root), dst_root), groups, conf)


def copy_manifest(spark: SparkSession, path: str, groups: int = 200,
                  conf: CopyConf | None = None) -> tuple[DataFrame, DataFrame]:
    """Copy what a manifest names: ``(results, rejected lines)``."""
    pairs, rejects = read_manifest(spark, path)
    return copy_pairs(pairs, groups, conf), rejects
