"""What an incremental sync has to do: copy, skip, delete, fix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from haulmark.operators.ordered import ROWS_PER_BIN, literal_key, previous_row, row_position, with_bins
from haulmark.operators.skew import one_per_key
from haulmark.session import pin


def _target_side(dst: DataFrame) -> DataFrame:
    checksum = F.col("checksum") if "checksum" in dst.columns else F.lit(None).cast("string")
    return one_per_key(dst.select(
        "entry_name", F.col("is_file").alias("dst_is_file"), F.col("file_size").alias("dst_size"),
        checksum.alias("dst_checksum"),
    ), "entry_name")


def _same_file(src: DataFrame) -> Column:
    checksum = F.col("checksum") if "checksum" in src.columns else F.lit(None).cast("string")
    return (F.col("file_size") == F.col("dst_size")) & F.coalesce(checksum == F.col("dst_checksum"), F.lit(True))


def select_updates(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Source files that the target lacks or has differently.

    Same means equal length and, where both sides have a ``checksum``, equal checksums.
    """
    joined = src.filter("is_file").join(_target_side(dst), "entry_name", "left")
    missing = F.col("dst_size").isNull()
    return joined.filter(missing | ~_same_file(src)).select(
        *src.columns, F.when(missing, "MISSING").otherwise("DIFFERS").alias("reason")
    )


def copy_action(src: DataFrame, dst: DataFrame, overwrite: bool = False, update: bool = False) -> DataFrame:
    """Add ``action`` to every source entry: ``COPY``, ``OVERWRITE``, ``SKIP``, ``MKDIR`` or ``FAIL``."""
    if overwrite and update:
        raise ValueError("overwrite and update exclude each other")
    joined = src.join(_target_side(dst), "entry_name", "left")
    exists = F.col("dst_is_file").isNotNull()
    differs = ~F.coalesce(_same_file(src), F.lit(False))
    replace = F.lit(True) if overwrite else (differs if update else F.lit(False))
    for_dir = F.when(exists & F.col("dst_is_file"), "FAIL").otherwise("MKDIR")
    for_file = (
        F.when(exists & ~replace, "SKIP")
        .when(exists & ~F.col("dst_is_file"), "FAIL")
        .when(exists, "OVERWRITE")
        .otherwise("COPY")
    )
    return joined.select(*src.columns, F.when(F.col("is_file"), for_file).otherwise(for_dir).alias("action"))


def duplicate_dests(pairs: DataFrame) -> DataFrame:
    """Targets that more than one source would write, with two of the sources by name.

    Targets are counted by hash; names, which would be sorted, are looked at only for those that clash.
    """
    counted = pairs.groupBy("dest_file").agg(F.count("*").alias("sources")).filter("sources > 1")
    named = pairs.select("dest_file", "src_file").join(counted.select("dest_file"), "dest_file", "left_semi")
    names = named.groupBy("dest_file").agg(F.min("src_file").alias("first_source"), F.max("src_file").alias("last_source"))
    return counted.join(names, "dest_file").select("dest_file", "sources", "first_source", "last_source")


def prev_dest(pairs: DataFrame, **kwargs: int) -> DataFrame:
    """Every pair whose target was already claimed, with the source right before it in sorted order."""
    return previous_row(pairs, ["src_file"], ["dest_file"], "src_file", "prev_src", **kwargs).filter(
        F.col("prev_src").isNotNull()
    )


def extraneous(src: DataFrame, dst: DataFrame, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Target entries that the source does not have, without those below another such entry.

    ``src`` must be the whole source list, including entries an update or a limit left out.  The two trees are compared by
    one shuffle of names.  What is only in the target is swept in the order of path components, in which all that lies
    below a directory follows it directly: an entry is covered if the furthest end of a directory seen so far lies behind
    it.  Bins of that order hand on one row each, so a directory with most of the files is swept by many tasks.
    """
    def named(df: DataFrame, is_src: bool) -> DataFrame:
        return df.select(
            F.regexp_replace("entry_name", "/$", "").alias("entry_name"),
            F.lit(is_src).alias("in_src"), F.lit(not is_src).alias("in_dst"),
            F.when(F.lit(not is_src), F.col("is_file")).alias("is_file"),
        )

    both = named(src, True).unionByName(named(dst, False)).groupBy("entry_name").agg(
        F.max("in_src").alias("in_src"), F.max("in_dst").alias("in_dst"), F.max("is_file").alias("is_file"),
    )
    # The character before all others between components: "a/c" comes before "a.b".
    key = F.replace("entry_name", F.lit("/"), F.lit("\0"))
    gone = pin(both.filter("in_dst and not in_src").select("entry_name", "is_file", key.alias("_key")), "gone")
    binned, bins = with_bins(gone.withColumn("_end", F.concat("_key", F.lit("\1"))), ["_key"], rows_per_bin)
    earlier = Window.partitionBy("_bin").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    swept = binned.withColumn("_reach", F.max("_end").over(earlier))
    if bins > 1:
        # One row per bin.
        ends = binned.groupBy("_bin").agg(F.max("_end").alias("_top"))
        handed = ends.select("_bin", F.max("_top").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
        swept = swept.join(F.broadcast(handed), "_bin").withColumn("_reach", F.greatest("_reach", "_carry"))
    return swept.filter(F.coalesce(F.col("_reach") <= F.col("_key"), F.lit(True))).select("entry_name", "is_file")


_DRIFT = {"USER": "owner", "GROUP": "grp", "PERMISSION": "permission"}


def attr_drift(src: DataFrame, dst: DataFrame, attrs: frozenset[str]) -> DataFrame:
    """Entries on both sides whose owner, group or permission must change; null where nothing changes."""
    watched = [column for attr, column in _DRIFT.items() if attr in attrs]
    old = one_per_key(dst.select("entry_name", *[F.col(c).alias(f"dst_{c}") for c in _DRIFT.values()]), "entry_name")
    changes = [
        F.when(~F.col(c).eqNullSafe(F.col(f"dst_{c}")) & F.lit(c in watched), F.col(c)).alias(f"new_{c}")
        for c in _DRIFT.values()
    ]
    return src.join(old, "entry_name").select("entry_name", *changes).filter(
        F.coalesce(*[F.col(f"new_{c}") for c in _DRIFT.values()]).isNotNull()
    )


def budget_admit(files: DataFrame, max_files: int | None = None, max_bytes: int | None = None,
                 order: Sequence[str] = ("entry_name",), rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Entries a sync with limits takes: in order, every file that still fits; later smaller files may follow.

    Directories always pass.  ``order`` must identify a file.  The rule is sequential, but runs in at most 64 phases: with
    ``rest`` bytes left and ``t`` the power of two at or below it, all files smaller than ``t`` are taken until one does
    not fit (the rest is then below ``t``) or until a larger one fits (so it is too).  Bins of the order are summed by
    the power of two of the size, at most 64 rows for each of at most 1,024 bins.  The driver walks these sums, which tell
    exactly which bins a phase passes whole; only a bin in which one ends is read again, alone.  Whatever the limit, the
    files are read three times: counted, sampled, and stored by bin.
    """
    chosen = files.filter("is_file")
    if max_bytes is not None:
        chosen = chosen.filter(_within_budget(chosen, max_bytes, order, rows_per_bin))
    if max_files is not None:
        # Files taken before the count runs out do not depend on the count, so it can be applied afterwards.
        chosen = row_position(chosen, order, name="_nth", rows_per_bin=rows_per_bin).filter(
            F.col("_nth") <= max_files
        ).drop("_nth")
    return chosen.unionByName(files.filter("not is_file"))


def _size_class(size: Column) -> Column:
    """Number of binary digits: 0 for 0, else sizes of class ``c`` lie in ``[2**(c-1), 2**c)``."""
    return F.when(size == 0, 0).otherwise(F.length(F.bin(size)))


def _budget_table(files: DataFrame, budget: int, order: Sequence[str], rows_per_bin: int) -> tuple[DataFrame, list[str], list]:
    """Files that may fit, stored by bin, with the class of their size and ``need``; the key columns and their types.

    ``need``: the file's size and all sizes of lower classes before it in its bin.
    """
    names = [f"k{i}" for i in range(len(order))]
    sized = files.filter(F.col("file_size") <= budget).select(
        *[F.col(c).alias(n) for c, n in zip(order, names, strict=True)], F.col("file_size").alias("size")
    )
    binned, bins = with_bins(sized, names, rows_per_bin)
    in_bin = Window.partitionBy("_bin").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lower = [F.sum(F.when(F.col("class") < c, F.col("size"))).over(in_bin) for c in range(1, max(1, budget.bit_length()) + 1)]
    before = F.element_at(F.array(*lower), F.greatest(F.col("class"), F.lit(1)))
    needed = binned.repartitionById(bins, "_bin").withColumn("class", _size_class(F.col("size"))).withColumn(
        "need", F.col("size") + F.coalesce(before, F.lit(0).cast("bigint"))
    )
    return pin(needed, "budget", by="_bin"), names, [sized.schema[n].dataType for n in names]


def _within_budget(files: DataFrame, budget: int, order: Sequence[str], rows_per_bin: int) -> Column:
    table, names, types = _budget_table(files, budget, order, rows_per_bin)
    # At most MAX_BINS bins of 64 classes each.
    summary: dict[int, dict[int, tuple[int, int]]] = {}
    for row in table.groupBy("_bin", "class").agg(F.sum("size").alias("bytes"), F.min("need").alias("need")).collect():
        summary.setdefault(row["_bin"], {})[row["class"]] = (row["bytes"], row["need"])
    inner = F.struct(*names)
    outer = F.struct(*[F.col(c).alias(n) for c, n in zip(order, names, strict=True)])

    def beyond(key: Column, limit: Column | None) -> Column:
        return F.lit(True) if limit is None else key > limit

    def first_event(number: int, step: int, rest: int, last: Column | None) -> Row:
        """Of one bin beyond ``last``: the first row that ends the phase, and the bytes of all small files."""
        in_order = Window.partitionBy("_bin").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        is_small = F.col("size") < step
        live = table.filter((F.col("_bin") == number) & (is_small | (F.col("size") <= rest)) & beyond(inner, last))
        summed = live.withColumn("small", F.when(is_small, F.col("size")).otherwise(F.lit(0).cast("bigint"))).withColumn(
            "used", F.sum("small").over(in_order)
        )
        ends = (is_small & (F.col("used") > rest)) | (~is_small & (F.col("size") + F.col("used") <= rest))
        event = F.when(ends, F.struct(inner.alias("key"), "size", "used"))
        return summed.agg(F.min(event).alias("event"), F.coalesce(F.sum("small"), F.lit(0)).alias("bytes")).first()

    def step_of(rest: int) -> int:
        return 1 << (rest.bit_length() - 1) if rest else 1

    taken, rest, last, step = F.lit(False), budget, None, step_of(budget)

    def small_file() -> Column:
        return beyond(outer, last) & (F.col("file_size") < step) & (F.col("file_size") <= budget)

    for number in sorted(summary):
        classes, top = summary[number], step.bit_length()
        small = sum(size for c, (size, _) in classes.items() if c < top)
        if small <= rest and (top not in classes or classes[top][1] > rest):
            rest -= small
            continue
        while (found := first_event(number, step, rest, last)).event is not None:
            event = found.event
            here = literal_key(tuple(event.key), types)
            # Below the event every small file was taken.
            taken = taken | (small_file() & (outer < here))
            if event.size < step:
                rest -= event.used - event.size
            else:
                taken = taken | (outer == here)
                rest -= event.used + event.size
            last, step = here, step_of(rest)
        rest -= found.bytes
    return taken | small_file()
