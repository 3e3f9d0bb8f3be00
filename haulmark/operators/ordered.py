"""Running sums and previous rows over a global order, without a one-task window.

A window with no (or one very large) partition sorts everything in one task.  Here the order keys are cut into
*bins*: contiguous key ranges of about ``rows_per_bin`` rows, taken from a sample.  A row's bin depends on nothing but
its key and the boundaries, which are constants of the plan, so a task that is run again puts its rows into the same
bins.  Where sums restart per key and no key is large, an ordinary window does.  Each bin is windowed on its own; what one bin hands to the next is one row per bin (at most ``MAX_BINS``),
small enough to broadcast whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper limit for the number of bins, and with it for every hand-over table and literal in this module.
MAX_BINS = 1024
ROWS_PER_BIN = 200_000
_SAMPLE_PER_BIN = 48
_LARGE_SAMPLE = 0.01

_RUNNING = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def _key_columns(df: DataFrame, order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _key_struct(keys: Sequence[Column]) -> Column:
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])


def literal_key(values: Sequence[object], types: Sequence[T.DataType]) -> Column:
    """A key struct made of constants."""
    return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types))])


def boundaries(df: DataFrame, order: Sequence[Column | str], rows_per_bin: int = ROWS_PER_BIN,
               rows: int | None = None) -> tuple[list[tuple], list[T.DataType]]:
    """Ascending lower key limits of all bins but the first, and the key types.

    Runs a count (unless ``rows`` is given) and, above ``rows_per_bin`` rows, a sample of at most about
    ``MAX_BINS * 48`` keys.  The sample only decides how even the bins are, never the result.
    """
    keys = df.select(_key_struct(_key_columns(df, order)).alias("key")).select("key.*")
    types = [f.dataType for f in keys.schema.fields]
    rows = keys.count() if rows is None else rows
    bins = min(MAX_BINS, ceil(rows / rows_per_bin))
    if bins <= 1:
        return [], types
    sampled = keys.sample(fraction=min(1.0, bins * _SAMPLE_PER_BIN / rows), seed=17)
    # Sorted by one task: a global sort would read its input twice, once to find ranges of its own.
    sample = sampled.repartition(1).sortWithinPartitions(*keys.columns).collect()
    cuts = [tuple(sample[len(sample) * i // bins]) for i in range(1, bins)] if len(sample) >= bins else []
    return list(dict.fromkeys(cuts)), types


def bin_of(keys: Sequence[Column], cuts: Sequence[tuple], types: Sequence[T.DataType]) -> Column:
    """Number of boundaries not above the key, found in two steps of about sqrt(bins) comparisons."""
    if not cuts:
        return F.lit(0)
    step = isqrt(len(cuts)) + 1
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    firsts = F.array(*[literal_key(b[0], types) for b in blocks])
    inner = F.array(*[F.array(*[literal_key(c, types) for c in b]) for b in blocks])

    def not_above(limits: Column, key: Column) -> Column:
        return F.size(F.filter(limits, lambda limit: limit <= key))

    def within(key: Column) -> Column:
        return bound_once(not_above(firsts, key), lambda block: F.when(block == 0, 0).otherwise(
            (block - 1) * step + not_above(F.element_at(inner, F.greatest(block, F.lit(1))), key)
        ))

    return bound_once(_key_struct(keys), within)


def bound_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_bins(df: DataFrame, order: Sequence[Column | str], rows_per_bin: int = ROWS_PER_BIN,
              rows: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with an int column ``_bin`` that never decreases along the order, and the number of bins."""
    cuts, types = boundaries(df, order, rows_per_bin, rows)
    return df.withColumn("_bin", bin_of(_key_columns(df, order), cuts, types)), len(cuts) + 1


def has_large_group(df: DataFrame, by: Sequence[str], rows_per_bin: int = ROWS_PER_BIN) -> bool:
    """Whether some value of ``by`` seems to have more than ``rows_per_bin`` rows, from a 1 % sample.

    If none has, a plain window over ``by`` gives every task a bounded sort.  Either way results are the same.
    """
    sampled = df.select(F.xxhash64(*by).alias("h")).sample(fraction=_LARGE_SAMPLE, seed=23)
    counts = sampled.groupBy("h").count()
    return not counts.filter(F.col("count") >= max(1, int(rows_per_bin * _LARGE_SAMPLE))).isEmpty()


def running_sum(df: DataFrame, value: Column, order: Sequence[Column | str], by: Sequence[str] = (),
                name: str = "running", rows_per_bin: int = ROWS_PER_BIN, rows: int | None = None,
                in_order: bool = False) -> DataFrame:
    """Add ``name``: sum of ``value`` over the rows up to and including this one.

    With ``in_order`` the rows come out along ``by`` and ``order``: each bin becomes the partition of its own number, so the
    shuffle and the sort that the sums need are also those of the result.

    ``order`` must be ascending keys (negate numbers to descend) that identify a row within ``by``.  With ``by`` the
    sum starts again for each of its values; a value holding most of the rows is spread over many bins.
    """
    by = list(by)
    if by and not in_order and not has_large_group(df, by, rows_per_bin):
        plain = Window.partitionBy(*by).orderBy(*_key_columns(df, order)).rowsBetween(*_RUNNING)
        return df.withColumn(name, F.sum(value).over(plain))
    keys = [F.col(c) for c in by] + _key_columns(df, order)
    binned, bins = with_bins(df.withColumn("_value", value), keys, rows_per_bin, rows)
    window = Window.partitionBy("_bin", *by).orderBy(*_key_columns(df, order)).rowsBetween(*_RUNNING)
    local = F.sum("_value").over(window)
    placed = binned.repartitionById(bins, "_bin") if in_order else binned

    def finished(result: DataFrame) -> DataFrame:
        # As the window has left them; a sort only where nobody asks for the sums.
        result = result.sortWithinPartitions("_bin", *by, *_key_columns(df, order)) if in_order else result
        return result.drop("_bin", "_value", "_local", "_owner", "_carry")

    if bins == 1:
        return finished(placed.withColumn(name, local))

    totals = binned.groupBy("_bin", *by).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_bin").rowsBetween(*_BEFORE)
    # Keys are ordered by ``by`` first, so only the smallest ``by`` of a bin can have begun in an earlier bin: the
    # hand-over has at most one row per bin.
    carried = (
        totals.withColumn("_carry", F.sum("_total").over(earlier))
        .filter(F.col("_carry").isNotNull())
        .select("_bin", F.struct(F.lit(1), *by).alias("_owner"), "_carry")
    )
    carry = F.when(F.struct(F.lit(1), *by).eqNullSafe(F.col("_owner")), F.col("_carry"))
    return finished(
        placed.withColumn("_local", local)
        .join(F.broadcast(carried), "_bin", "left")
        .withColumn(name, F.col("_local") + F.coalesce(carry, F.lit(0).cast("bigint")))
    )


def row_position(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), name: str = "position",
                 **kwargs: int | bool | None) -> DataFrame:
    """Add ``name``: 1-based position along the order."""
    return running_sum(df, F.lit(1).cast("bigint"), order, by, name, **kwargs)


def previous_row(df: DataFrame, order: Sequence[Column | str], by: Sequence[str], take: str, name: str,
                 rows_per_bin: int = ROWS_PER_BIN, rows: int | None = None) -> DataFrame:
    """Add ``name``: value of column ``take`` in the row before this one with the same ``by``, else null."""
    by = list(by)
    order_columns = _key_columns(df, order)
    if by and not has_large_group(df, by, rows_per_bin):
        return df.withColumn(name, F.lag(take).over(Window.partitionBy(*by).orderBy(*order_columns)))
    keys = [F.col(c) for c in by] + order_columns
    binned, bins = with_bins(df, keys, rows_per_bin, rows)
    here = F.lag(take).over(Window.partitionBy("_bin", *by).orderBy(*order_columns))
    if bins == 1:
        return binned.withColumn(name, here).drop("_bin")

    # The row before the first one of a bin is the last one of the bin before: one row per bin again.
    last = binned.groupBy("_bin").agg(
        F.max(F.struct(_key_struct(keys).alias("key"), F.struct(F.lit(1), *by).alias("owner"),
                       F.col(take).alias("taken"))).alias("_last")
    )
    handed = last.withColumn("_last", F.lag("_last").over(Window.orderBy("_bin")))
    first = F.row_number().over(Window.partitionBy("_bin", *by).orderBy(*order_columns)) == 1
    carry = F.when(F.struct(F.lit(1), *by).eqNullSafe(F.col("_last.owner")), F.col("_last.taken"))
    return (
        binned.withColumn("_here", here).withColumn("_first", first)
        .join(F.broadcast(handed), "_bin", "left")
        .withColumn(name, F.when(F.col("_first"), carry).otherwise(F.col("_here")))
        .drop("_bin", "_here", "_first", "_last")
    )
