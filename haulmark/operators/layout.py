"""Spreading work: balanced groups, contiguous splits, number of tasks."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.operators.ordered import ROWS_PER_BIN, row_position, running_sum

# What a file or a directory weighs on top of its bytes.
FILE_WEIGHT = 1000
DIR_WEIGHT = 1000

# Bytes one sync task should copy, and most tasks per node.
BYTES_PER_TASK = 256 * 1024 * 1024
TASKS_PER_NODE = 20

#: Files one task should copy: many small ones take their time by number, not by bytes.
FILES_PER_TASK = 4_000

#: An item above one such part of a group's share of the weight is placed by itself.
_PIECES = 20


def with_weight(pairs: DataFrame) -> DataFrame:
    """Add ``weight``; an unknown size weighs nothing by itself."""
    size = F.coalesce("file_size", F.lit(0))
    return pairs.withColumn("weight", F.when(F.col("is_file"), size + FILE_WEIGHT).otherwise(DIR_WEIGHT).cast("bigint"))


def _size_order(name_col: str) -> list:
    """Files before directories, large before small (an unknown size last), names ascending."""
    return [~F.col("is_file"), -F.coalesce("file_size", F.lit(0)), F.col(name_col)]


def _longest_first(weights: Sequence[int], groups: int) -> tuple[list[int], list[int]]:
    """Give each weight in turn to the lightest group (lowest id on ties): group per weight, and final loads."""
    heap = [(0, g) for g in range(groups)]
    chosen = []
    for weight in weights:
        load, group = heap[0]
        heapq.heapreplace(heap, (load + weight, group))
        chosen.append(group)
    loads = [0] * groups
    for load, group in heap:
        loads[group] = load
    return chosen, loads


def _water_level(loads: Sequence[int], amount: int) -> int:
    """Smallest level up to which the groups can be filled to take ``amount`` in all."""
    ordered = sorted(loads)
    below = 0
    for i, load in enumerate(ordered, start=1):
        below += load
        level = -(-(amount + below) // i)
        if i == len(ordered) or level <= ordered[i]:
            return level
    return 0


def assign_groups(pairs: DataFrame, n: int, name_col: str = "src_file", rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Add ``group_id`` (0 to n-1) so that the groups weigh about the same.

    One rule at every size.  An item (``name_col`` identifies one) is heavy above 1/(20 n) of the total weight, so fewer
    than 20 n are, and their weights are all the driver sees: longest first, each goes to the lightest group.  The light
    items fill what is missing in each group up to a common level: laid end to end they form one line, the gaps another,
    and an item goes to the gap its start falls in.  A group then ends at most one light item, a twentieth of its share,
    above the level.

    The line of the gaps is cut into as many cells as there are groups; an item meets the few gaps of its own cell, so the
    work per item does not depend on ``n``.
    """
    weighted = with_weight(pairs)
    total = weighted.agg(F.sum("weight")).first()[0]
    if not total:
        return pairs.withColumn("group_id", F.lit(0))
    heavy = F.col("weight") * (n * _PIECES) > F.lit(total)
    order = _size_order(name_col)

    head = weighted.filter(heavy)
    # Fewer than 20 n rows, so one window task and one collect are bounded.
    ranked = head.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    weights = [row.weight for row in ranked.select("weight", "_rank").sort("_rank").collect()]
    chosen, loads = _longest_first(weights, n)
    table = pairs.sparkSession.createDataFrame(
        [(i, g) for i, g in enumerate(chosen, start=1)], "_rank int, group_id int"
    )
    placed = ranked.join(F.broadcast(table), "_rank").select(*pairs.columns, "group_id")
    if total == sum(weights):
        return placed

    level = _water_level(loads, total - sum(weights))
    starts, position = [], 0
    groups = [g for g in range(n) if loads[g] < level]
    for g in groups:
        starts.append(position)
        position += level - loads[g]
    tail = running_sum(weighted.filter(~heavy), F.col("weight"), order, name="_end", rows_per_bin=rows_per_bin)
    width, cells = _gap_cells(starts, groups, position)
    # One row per cell, at most as many as groups, and each gap in one or as its cells' first.
    table = pairs.sparkSession.createDataFrame(cells, "_cell bigint, _starts array<bigint>, _groups array<int>")
    before = F.col("_end") - F.col("weight")
    met = tail.withColumn("_cell", F.expr(f"(_end - weight) div {width}L")).join(F.broadcast(table), "_cell")
    group_id = F.element_at("_groups", F.size(F.filter("_starts", lambda s: s <= before)))
    return placed.unionByName(met.withColumn("group_id", group_id).select(*pairs.columns, "group_id"))


def _gap_cells(starts: Sequence[int], groups: Sequence[int], length: int) -> tuple[int, list[tuple]]:
    """Width of a cell, and of each cell its number and the gaps that begin before or in it and end in or after it."""
    width = max(1, -(-length // len(starts)))
    cells, first = [], 0
    for cell in range(-(-length // width)):
        while first + 1 < len(starts) and starts[first + 1] <= cell * width:
            first += 1
        last = first
        while last + 1 < len(starts) and starts[last + 1] < (cell + 1) * width:
            last += 1
        cells.append((cell, list(starts[first:last + 1]), list(groups[first:last + 1])))
    return width, cells


def group_summary(grouped: DataFrame) -> DataFrame:
    """Files, directories, bytes and weight of each group."""
    return with_weight(grouped).groupBy("group_id").agg(
        F.count_if("is_file").alias("files"),
        F.count_if(~F.col("is_file")).alias("dirs"),
        F.sum("file_size").alias("bytes"),
        F.sum("weight").alias("weight"),
    )


def number_plan(grouped: DataFrame, name_col: str = "src_file", rows_per_bin: int = ROWS_PER_BIN,
                in_order: bool = False) -> DataFrame:
    """Add ``row_no``: position within the group from 0, in work order; with ``in_order`` rows come out that way."""
    numbered = row_position(grouped, _size_order(name_col), ["group_id"], "_nth", rows_per_bin=rows_per_bin, in_order=in_order)
    return numbered.withColumn("row_no", F.col("_nth") - 1).drop("_nth")


def split_plan(rows: DataFrame, num_splits: int, order_col: str, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Add ``split_id`` (0 to num_splits-1): contiguous stretches along ``order_col`` of about equal bytes.

    A split exceeds total/num_splits by at most one file.
    """
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("file_size"), F.lit(0))).first()
    if not total:
        return rows.withColumn("split_id", F.lit(0))
    summed = running_sum(rows, F.col("file_size"), [order_col], name="_end", rows_per_bin=rows_per_bin, rows=count)
    before = (F.col("_end") - F.col("file_size")).cast("decimal(20,0)")
    # Empty files at the very end start where the bytes end.
    split = F.floor(before * F.lit(num_splits).cast("decimal(10,0)") / F.lit(total).cast("decimal(20,0)"))
    return summed.withColumn("split_id", F.least(split, F.lit(num_splits - 1)).cast("int")).drop("_end")


def task_count(pairs: DataFrame, nodes: int, bytes_per_task: int = BYTES_PER_TASK,
               per_node: int = TASKS_PER_NODE, files_per_task: int | None = None) -> DataFrame:
    """One row: bytes in all and the number of tasks worth starting, at most ``per_node`` for each of ``nodes``.

    With ``files_per_task`` the number of pairs asks for tasks as well, and the larger number counts.
    """
    total = F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint")
    wanted = F.floor(F.col("total_bytes") / bytes_per_task)
    if files_per_task is not None:
        wanted = F.greatest(wanted, F.ceil(F.col("pairs") / files_per_task))
    return pairs.agg(total.alias("total_bytes"), F.count("*").alias("pairs")).withColumn(
        "tasks",
        F.greatest(F.lit(1), F.least(wanted, F.lit(nodes * per_node))).cast("bigint"),
    ).drop("pairs")
