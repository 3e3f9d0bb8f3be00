"""Giving the entries of a target tree the owner, group and permission they should have."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.session import pin
from haulmark.sources import filesystem as fs

_CHANGES = ["new_owner", "new_grp", "new_permission"]
_RESULT = "path string, depth int, status string, error string"


def _changer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        errors = []
        for row in batch.itertuples():
            wanted = [None if pd.isna(value) else value for value in (row.new_owner, row.new_grp, row.new_permission)]
            try:
                fs.set_attributes(row.path, *wanted)
                errors.append(None)
            except (OSError, ValueError, LookupError) as error:
                errors.append(f"{type(error).__name__}: {error}")
        yield pd.DataFrame({
            "path": batch["path"], "depth": batch["depth"],
            "status": ["CHANGED" if e is None else "FAILED" for e in errors], "error": pd.array(errors, dtype="string"),
        })


def apply_attributes(drift: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """Make the changes of ``attr_drift`` below ``root``: ``path, depth, status, error``, ``CHANGED`` or ``FAILED``.

    The deepest entries come first, one job for each depth, so a directory is closed only after all that lies in it has
    been reached.  A null change leaves the attribute as it is; rows that change nothing, or have no name, are left out.
    Changes may be made twice, so a task may run again.
    """
    spark = drift.sparkSession
    name = F.regexp_replace("entry_name", "/$", "")
    waiting = pin(
        drift.filter(F.coalesce(*_CHANGES).isNotNull() & F.col("entry_name").isNotNull()).select(
            F.concat(F.lit(root.rstrip("/") + "/"), name).alias("path"), *_CHANGES, F.size(F.split(name, "/")).alias("depth"),
        ), "attributes", by="depth",
    )
    # As many rows as a path has components at most.
    depths = [row.depth for row in waiting.select("depth").distinct().orderBy(F.desc("depth")).collect()]
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    done = [
        pin(waiting.filter(F.col("depth") == depth).repartition(tasks, "path").mapInPandas(_changer, _RESULT), "changed")
        for depth in depths
    ]
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], _RESULT)
