"""Stores listed by key, as jobs and as a data source, and objects with metadata."""

from __future__ import annotations

import json
import os
from bisect import bisect_left, bisect_right

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulmark.operators import objects
from haulmark.operators.objects import download_files, upload_files, verify_store
from haulmark.sources.keys import _KeysReader, list_keys, register_keys, split_interval
from haulmark.sources import stores
from haulmark.sources.stores import FolderStore, Stored, between, retried

MILLION = 1_000_000


class Numbered:
    """``count`` keys below one flat prefix, made as they are asked for; requests are written down in files.

    Every ``fails``-th page of a task fails the first time.
    """

    def __init__(self, count, log=None, fails=0):
        self.count, self.log, self.fails, self.calls, self.failed = count, log, fails, 0, set()

    def page(self, prefix, after, limit):
        assert limit <= 1000
        self.calls += 1
        if self.fails and self.calls % self.fails == 0 and after not in self.failed:
            self.failed.add(after)
            raise ConnectionResetError(after)
        first = max(bisect_right(range(self.count), after, key=lambda i: f"flat/k{i:09d}"),
                    bisect_left(range(self.count), prefix, key=lambda i: f"flat/k{i:09d}"))
        found = [Stored(f"flat/k{i:09d}", i % 7, 0.0) for i in range(first, min(first + limit, self.count))]
        found = [s for s in found if s.key.startswith(prefix)]
        if self.log and limit > 1:
            with open(f"{self.log}/{os.getpid()}", "a", encoding="utf-8") as out:
                out.write(json.dumps([after, len(found)]) + "\n")
        return found


class Listed:
    """Keys in a list."""

    def __init__(self, keys):
        self.keys = sorted(keys)

    def page(self, prefix, after, limit):
        return [Stored(k, len(k), 0.0) for k in self.keys if k > after and k.startswith(prefix)][:limit]


def requests(folder):
    return [json.loads(line) for path in folder.iterdir() for line in path.read_text().splitlines()]


keys_text = st.text(st.characters(codec="utf-8"), max_size=6)


@given(keys_text, keys_text)
def test_between_is_between(a, b):
    low, high = sorted([a, b])
    middle = between(low, high)
    if middle is not None:
        assert low < middle < high
        middle.encode()


@settings(max_examples=200)
@given(st.sets(keys_text, max_size=30), keys_text, keys_text)
def test_split_loses_nothing(keys, a, b):
    low, high = sorted([a, b])
    parts = split_interval(Listed(keys), "", low, high)
    inside = {k for k in keys if low < k <= high}
    assert [sum(lo < k <= hi for lo, hi in parts) for k in inside] == [1] * len(inside)
    assert len(parts) == 1 or all(any(lo < k <= hi for k in keys) for lo, hi in parts)


def test_a_million_keys_below_one_prefix(spark, tmp_path):
    store = Numbered(MILLION, str(tmp_path), fails=50)
    listed = list_keys(spark, store, "flat", tries=3)
    got = listed.agg(F.count("*"), F.count_distinct("entry_name"), F.min("entry_name"), F.max("entry_name"),
                     F.sum("file_size")).first()
    assert tuple(got) == (MILLION, MILLION, "k000000000", "k000999999", sum(i % 7 for i in range(MILLION)))
    asked = requests(tmp_path)
    # Hardly more pages than there are, none twice, by several workers, each with little.
    assert len(asked) < 1.15 * MILLION / 1000 and len({after for after, n in asked if n}) == len([n for _, n in asked if n])
    assert len(list(tmp_path.iterdir())) > 1


def test_a_page_that_keeps_failing_is_an_error():
    calls = []

    def broken():
        calls.append(1)
        raise TimeoutError("no answer")

    with pytest.raises(TimeoutError):
        retried(broken, 3, 0.0)
    assert len(calls) == 3
    with pytest.raises(FileNotFoundError):
        retried(lambda: open("/nonexistent/x", encoding="utf-8"), 3, 0.0)


ODD = ["a", "a b/c", "dir/", "dir/x", "dir/x\n", "dir/é", "dir/\U0001f600/z", "dir2/y", "dir.a", "dir/sub/deep/1", "dir/sub.1", "dir0"]


@pytest.mark.parametrize("page_keys", [1, 2, 100])
def test_odd_keys_and_boundaries(spark, page_keys):
    def names(root):
        return sorted(r[0] for r in list_keys(spark, Listed(ODD), root, page_keys, task_pages=1).select("entry_name").collect())

    assert names("dir") == sorted(k[4:] for k in ODD if k.startswith("dir/") and k != "dir/")
    assert names("/dir2/") == ["y"] and names("nothing") == []
    if page_keys > 1:
        assert names("") == sorted(ODD)


def test_folder_store_needs_a_mounted_folder():
    with pytest.raises(ValueError, match="mounted"):
        FolderStore("hdfs://nn/backup")


def test_folder_store_lists_in_key_order(spark, tmp_path):
    store = FolderStore(f"file:{tmp_path}/objects")
    keys = [k for k in ODD if not k.endswith("/")]
    for key in keys:
        store.put(key, [key.encode()], {})
    os.makedirs(f"{tmp_path}/objects/void")
    keys.append("void/")
    for limit in (1, 3, 100):
        got, after = [], ""
        while page := store.page("", after, limit):
            got += [s.key for s in page]
            after = got[-1]
        assert got == sorted(keys)
    assert [s.key for s in store.page("dir/", "dir/sub", 2)] == sorted(k for k in keys if k.startswith("dir/") and k > "dir/sub")[:2]


def pages_of(store, limit, prefix=""):
    found, after = [], ""
    while page := store.page(prefix, after, limit):
        found += [s.key for s in page]
        after = found[-1]
    return found


def test_pages_do_not_each_read_their_directory(tmp_path, monkeypatch):
    store = FolderStore(f"{tmp_path}/objects")
    for i in range(600):
        store.put(f"flat/k{i:03d}", [b"x"], {})
    monkeypatch.setattr(stores, "_SETTLED_S", 0.0)
    read, scan = [], os.scandir
    monkeypatch.setattr(stores.os, "scandir", lambda path: read.append(path) or scan(path))
    assert pages_of(store, 20) == [f"flat/k{i:03d}" for i in range(600)]
    assert len(read) <= 2
    # What changes is seen by the next page.
    store.put("flat/k0005", [b"x"], {})
    os.unlink(f"{tmp_path}/objects/flat/k001")
    assert [s.key for s in store.page("flat/", "flat/k000", 2)] == ["flat/k0005", "flat/k002"]


@pytest.mark.parametrize("kept", [10, 1 << 20])
def test_remembered_names_give_the_same_pages(tmp_path, monkeypatch, kept):
    store = FolderStore(f"{tmp_path}/objects")
    for key in (k for k in ODD if not k.endswith("/")):
        store.put(key, [b"x"], {})
    os.makedirs(f"{tmp_path}/objects/dir/void")
    asked = [(p, a, n) for p in ("", "dir", "dir/", "dir/s", "dir/sub/", "x") for a in ("", *ODD, "dir/sub/\U0010ffff") for n in (1, 3, 50)]
    fresh = [store.page(*a) for a in asked]
    monkeypatch.setattr(stores, "_SETTLED_S", 0.0)
    monkeypatch.setattr(stores, "NAMES_KEPT", kept)
    assert [store.page(*a) for a in asked] == fresh


def test_refused_objects_wait_together(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(objects.time, "sleep", waits.append)

    def refused(i):
        calls.append(i)
        raise objects._Refused("NO_CHECKSUM", f"{i}")

    def second_time(i):
        calls.append(i)
        if calls.count(i) == 1:
            raise OSError("busy")
        return i, "md5"

    def missing(i):
        raise FileNotFoundError(i)

    kinds = [refused, second_time, missing, lambda i: (i, "md5")]
    found = objects._tried([lambda i=i: kinds[i % 4](i) for i in range(400)], 3)
    assert waits == [0.05, 0.1]
    assert found[:4] == [("NO_CHECKSUM", 3, None, None, "0"), (None, 2, 1, "md5", None), ("OPEN_FAILED", 1, None, None, "2"), (None, 1, 3, "md5", None)]
    assert calls.count(0) == 3 and calls.count(1) == 2 and len(found) == 400


def test_source_lists_only_the_subtree(spark, tmp_path):
    register_keys(spark, "numbered_keys", Numbered(200_000, str(tmp_path)))

    def load():
        return spark.read.format("numbered_keys").option("partitions", 8).option("pushdown", True).load()

    below = load().filter(F.col("key").startswith("flat/k00001"))
    assert below.rdd.getNumPartitions() == 8
    assert below.count() == 10_000
    # A page may reach over the end of its interval, never over the end of the subtree.
    assert 10_000 <= sum(n for _, n in requests(tmp_path)) <= 10_000 + 8 * 1000
    assert load().filter("key = 'flat/k000000005'").select("key", "size").collect() == [("flat/k000000005", 5)]
    assert load().filter(F.col("key").startswith("other")).count() == 0
    assert load().count() == 200_000


@pytest.mark.parametrize("pushdown", [False, True])
def test_source_finds_odd_keys(spark, pushdown):
    register_keys(spark, "odd_keys", Listed(ODD), page_keys=2)

    def names(condition, prefix=""):
        rows = spark.read.format("odd_keys").option("pushdown", pushdown).option("prefix", prefix).load()
        return sorted(r.key for r in rows.filter(condition).collect())

    assert names("true") == sorted(ODD)
    assert names("key = 'dir/x'") == ["dir/x"]
    assert names("startswith(key, 'dir/')") == sorted(k for k in ODD if k.startswith("dir/"))
    assert names("key = 'a' and key = 'dir0'") == [] and names("key is null") == []
    assert names("startswith(key, 'd') and size < 5", "dir") == sorted(k for k in ODD if k.startswith("dir") and len(k) < 5)


def test_one_load_serves_many_queries_without_pushdown(spark):
    register_keys(spark, "odd_keys_again", Listed(ODD))
    rows = spark.read.format("odd_keys_again").load()
    assert rows.filter("startswith(key, 'zzz')").count() == 0
    assert rows.count() == len(ODD)
    joined = rows.filter("startswith(key, 'dir/')").join(rows.withColumnRenamed("size", "other"), "key")
    assert joined.count() == len([k for k in ODD if k.startswith("dir/")])


def test_partitions_are_found_without_listing():
    store = Numbered(MILLION)
    parts = sorted((p.after, p.until) for p in _KeysReader(store, "flat/", 16, 1000, 2).partitions())
    assert store.calls < 500
    assert len(parts) == 16 and all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))
    names = [f"flat/k{i:09d}" for i in range(MILLION)]
    held = [bisect_right(names, until) - bisect_right(names, after) for after, until in parts]
    assert sum(held) == MILLION and min(held) > 0 and max(held) < MILLION / 5


class Changing(FolderStore):
    """Spoils the file that is sent, once it is sent, as long as ``marks`` has fewer than ``times`` entries."""

    def __init__(self, root, path, marks, times):
        super().__init__(root)
        self.path, self.marks, self.times = path, marks, times

    def put(self, key, content, user_metadata):
        done = len(os.listdir(self.marks))
        if done < self.times:
            open(f"{self.marks}/{done}", "w", encoding="utf-8").close()
            with open(self.path, "a", encoding="utf-8") as out:
                out.write("more")
        super().put(key, content, user_metadata)


@pytest.mark.parametrize(("times", "status", "attempts"), [(1, "UPLOADED", 2), (99, "CHECKSUM_MISMATCH", 3)])
def test_a_file_that_changes_is_not_stored(spark, tmp_path, times, status, attempts):
    source = tmp_path / "f"
    source.write_text("x" * 10)
    (tmp_path / "marks").mkdir()
    store = Changing(str(tmp_path / "objects"), str(source), str(tmp_path / "marks"), times)
    pairs = spark.createDataFrame([(str(source), "k"), (str(tmp_path / "none"), "n")], "src_file string, key string")
    rows = {r.key: r for r in upload_files(pairs, store, tries=3).collect()}
    assert (rows["k"].status, rows["k"].attempts) == (status, attempts)
    assert (rows["n"].status, rows["n"].attempts) == ("OPEN_FAILED", 1)
    assert (tmp_path / "objects" / "k").exists() == (status == "UPLOADED")
    assert list((tmp_path / "objects.promised.writing").iterdir()) == []


def test_round_trip_and_refusal(spark, tmp_path):
    store = FolderStore(str(tmp_path / "objects"))
    (tmp_path / "src").mkdir()
    contents = {"empty": b"", "plain": b"abc", "large": bytes(range(256)) * 20_000}
    for name, data in contents.items():
        (tmp_path / "src" / name).write_bytes(data)
    pairs = spark.createDataFrame([(f"{tmp_path}/src/{n}", f"a/{n}") for n in contents], "src_file string, key string")
    assert {r.status for r in upload_files(pairs, store).collect()} == {"UPLOADED"}
    listing = list_keys(spark, store, "a")
    assert {r.status for r in verify_store(listing, store).collect()} == {"OK"}
    spoiled = bytearray(contents["large"])
    spoiled[-1] ^= 1
    (tmp_path / "objects/a/large").write_bytes(spoiled)
    objects = spark.createDataFrame([(f"a/{n}", f"{tmp_path}/dst/{n}") for n in contents], "key string, dest_file string")
    got = {r.key: r.status for r in download_files(objects, store, tries=1).collect()}
    assert got == {"a/empty": "DOWNLOADED", "a/plain": "DOWNLOADED", "a/large": "CHECKSUM_MISMATCH"}
    assert sorted(os.listdir(tmp_path / "dst")) == ["empty", "plain"]
    assert {r.status for r in download_files(objects, store, verify=False).collect()} == {"DOWNLOADED"}
    assert (tmp_path / "dst/large").read_bytes() == bytes(spoiled)
    nothing = listing.limit(0)
    assert verify_store(nothing, store).count() == 0
    assert upload_files(pairs.limit(0), store).count() == 0
