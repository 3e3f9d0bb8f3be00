"""Listing the keys of a store: flat prefixes of any size, without directories to divide the work."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringStartsWith

from haulmark.session import pin
from haulmark.sources.stores import TRIES, Store, Stored, between, retried

PAGE_KEYS = 1_000

#: Pages a task lists of one interval before it hands the rest back.
TASK_PAGES = 20

#: Requests spent on finding a place to split an interval; what they found out stays if they are not enough.
_PROBES = 64
_END = chr(0x10FFFF)
_FOUND = "key string, size bigint, mtime_s double, after string, until string"
_COLUMNS = ["key", "size", "mtime_s", "after", "until"]


def _end_of(prefix: str) -> str:
    """Nothing that starts with ``prefix`` lies behind this."""
    return prefix + _END * 2


def _pages(store: Store, prefix: str, after: str, until: str, page_keys: int, tries: int) -> Iterator[tuple[list[Stored], bool]]:
    """Pages of the keys in ``(after, until]``, each with whether more may follow."""
    more = True
    while more:
        page = retried(lambda: store.page(prefix, after, page_keys), tries)
        inside = [found for found in page if found.key <= until]
        more = len(inside) == page_keys
        yield inside, more
        if inside:
            after = inside[-1].key


def split_interval(store: Store, prefix: str, after: str, until: str, tries: int = TRIES) -> list[tuple[str, str]]:
    """``(after, until]`` in two parts that both hold keys; in one where no place is found, in none where there is no key.

    What is found to be empty at the end is left out.
    """
    def next_key(place: str) -> str | None:
        page = retried(lambda: store.page(prefix, place, 1), tries)
        return page[0].key if page and page[0].key <= until else None

    first, high = next_key(after), until
    if first is None:
        return []
    for _ in range(_PROBES):
        middle = between(first, high)
        if middle is None:
            break
        following = next_key(middle)
        if following is not None and following <= high:
            return [(after, middle), (middle, high)]
        high = middle
    return [(after, high)]


def _lister(store: Store, prefix: str, page_keys: int, task_pages: int, tries: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for after, until in zip(batch["after"], batch["until"]):
                last = after
                for number, (page, more) in enumerate(_pages(store, prefix, after, until, page_keys, tries), 1):
                    yield pd.DataFrame([(*found, None, None) for found in page], columns=_COLUMNS)
                    last = page[-1].key if page else last
                    if more and number == task_pages:
                        rest = split_interval(store, prefix, last, until, tries)
                        yield pd.DataFrame([(None, None, None, *part) for part in rest], columns=_COLUMNS)
                        break

    return run


def _as_listing(found: DataFrame, root: str, skip: int) -> DataFrame:
    return found.select(
        F.lit(root).alias("base_dir"), F.expr(f"substring(key, {skip + 1})").alias("entry_name"),
        (~F.col("key").endswith("/")).alias("is_file"), F.col("size").alias("file_size"),
        F.col("mtime_s").cast("timestamp").alias("mtime"),
    )


def _below(root: str) -> str:
    root = root.strip("/")
    return root + "/" if root else ""


def list_keys(spark: SparkSession, store: Store, root: str = "", page_keys: int = PAGE_KEYS, task_pages: int = TASK_PAGES,
              tries: int = TRIES) -> DataFrame:
    """LISTING (with ``mtime``) of all keys of a store below ``root``; ``dir`` does not take in ``dir2``.

    Keys ending in ``/`` are markers (``is_file`` is false); the marker of ``root`` itself is left out.  The work is
    divided by intervals of keys, not by directories: a task lists ``task_pages`` pages of its interval and hands the rest
    back in two halves, split where the store says that keys follow, so a flat prefix with most of the keys doubles its
    tasks from round to round.  Each round is stored, so no page is listed again after a lost executor has been
    replaced.  A page that fails is asked for ``tries`` times; then the task fails, and Spark runs it again.
    """
    prefix = _below(root)
    frontier, waiting, rounds = spark.createDataFrame([(prefix, _end_of(prefix))], "after string, until string"), 1, []
    while waiting:
        tasks = min(waiting, 4 * spark.sparkContext.defaultParallelism)
        found = pin(
            frontier.repartition(tasks, "after").mapInPandas(_lister(store, prefix, page_keys, task_pages, tries), _FOUND),
            "keys",
        )
        rounds.append(found)
        frontier = found.filter("key IS NULL").select("after", "until")
        waiting = frontier.count()
    return _as_listing(reduce(DataFrame.unionByName, rounds).filter("key IS NOT NULL"), prefix.rstrip("/"), len(prefix))


class _Interval(InputPartition):
    def __init__(self, after: str, until: str):
        super().__init__((after, until))
        self.after, self.until = after, until


class _KeysReader(DataSourceReader):
    def __init__(self, store: Store, prefix: str, partitions: int, page_keys: int, tries: int):
        self.store, self.prefix, self.wanted = store, prefix, partitions
        self.page_keys, self.tries = page_keys, tries

    def partitions(self) -> list[InputPartition]:
        """Split at places where keys follow, breadth first, without listing anything."""
        # The key that is the prefix itself comes after nothing that starts with it.
        waiting, whole = [("", _end_of(self.prefix))], []
        while waiting and len(waiting) + len(whole) < self.wanted:
            parts = split_interval(self.store, self.prefix, *waiting.pop(0), self.tries)
            if len(parts) == 1:
                whole += parts
            else:
                waiting += parts
        return [_Interval(*part) for part in waiting + whole]

    def read(self, partition: _Interval | None) -> Iterator[tuple]:
        # Without partitions Spark makes one of its own.
        if partition is None:
            return
        for page, _ in _pages(self.store, self.prefix, partition.after, partition.until, self.page_keys, self.tries):
            for found in page:
                yield found.key, found.size, found.mtime


class _FilteredReader(_KeysReader):
    """Filters on ``key`` or its beginning narrow what is listed."""

    nothing = False

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for asked in filters:
            by_key = isinstance(asked, StringStartsWith | EqualTo) and asked.attribute == ("key",)
            if by_key:
                self._narrow(asked.value)
            # Longer keys start like the one that is asked for, so Spark has to look as well.
            if not by_key or isinstance(asked, EqualTo):
                yield asked

    def _narrow(self, beginning: str) -> None:
        if beginning.startswith(self.prefix):
            self.prefix = beginning
        elif not self.prefix.startswith(beginning):
            self.nothing = True

    def partitions(self) -> list[InputPartition]:
        return [] if self.nothing else super().partitions()


def register_keys(spark: SparkSession, name: str, store: Store, page_keys: int = PAGE_KEYS, tries: int = TRIES) -> None:
    """Make ``spark.read.format(name)`` list a store: ``key, size, mtime_s``.

    Options: ``prefix`` (as it is; nothing is added), ``partitions`` (four per core) and ``pushdown`` (false).  With
    ``pushdown`` filters by ``key = ...`` and by its beginning reach the store, so a filter on a subtree lists that subtree
    only (``spark.sql.python.filterPushdown.enabled`` is set here).  Load anew for each query then: Spark 4.1 keeps what a
    filter left of a source for later queries without a filter on the same ``load()``.  ``prefix`` has no such trap.
    """
    cores = spark.sparkContext.defaultParallelism

    class Keys(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "key string, size bigint, mtime_s double"

        def reader(self, schema) -> DataSourceReader:
            wanted = int(self.options.get("partitions", 4 * cores))
            kind = _FilteredReader if self.options.get("pushdown", "false").lower() == "true" else _KeysReader
            return kind(store, self.options.get("prefix", ""), wanted, page_keys, tries)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Keys)
