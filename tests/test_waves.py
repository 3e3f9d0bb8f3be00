"""Copies that are lost and go on: the journal of waves, and files copied in ranges."""

from __future__ import annotations

import os
import random
import threading
import tracemalloc
from collections import namedtuple

import pandas as pd
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from haulmark.operators import transfer
from haulmark.operators.listing import make_pairs
from haulmark.operators.transfer import CopyConf, copy_files
from haulmark.plans import Journal, copy_in_waves, waves
from haulmark.plans.sync import SyncPlan, run_sync
from haulmark.queries import QUERIES, fixtures
from haulmark.sources import filesystem as fs
from haulmark.sources.files import list_files
from tests.conftest import SF
from tests.test_oracle import rows_of
from tests.test_real_files import b64, harvest, plant

FILES = {f"d{i % 3}/f{i:02d}": bytes([i]) * (100 * (i % 7)) for i in range(40)}
PER_WAVE = sum(map(len, FILES.values())) // 5 + 1


@pytest.fixture
def pairs(spark, tmp_path):
    return make_pairs(list_files(spark, plant(tmp_path / "tree", FILES, ["hollow"])), str(tmp_path / "copy"))


def test_a_stopped_job_copies_what_is_left(spark, tmp_path, pairs):
    journal, target = str(tmp_path / "journal"), tmp_path / "copy"
    first = copy_in_waves(spark, journal, pairs, PER_WAVE, max_waves=2)
    waved = {r.wave for r in first.collect()}
    record = Journal(spark, journal)
    assert waved == {0, 1} and record.pending() == [2, 3, 4]
    done = harvest(target)
    assert 0 < len(done) < len(FILES)
    # What is done is not copied again: the files could even be gone.
    gone = sorted(done)[0]
    (target / gone).unlink()
    results = copy_in_waves(spark, journal)
    assert harvest(target) == {n: d for n, d in FILES.items() if n != gone}
    assert (target / "hollow").is_dir()
    assert results.count() == len(FILES) + 1 and results.select("src_file").distinct().count() == len(FILES) + 1
    assert record.pending() == [] and record.commits().count() == 5
    totals = record.commits().agg(F.sum("pairs"), F.sum("failed"), F.sum("bytes_copied")).first()
    assert tuple(totals) == (len(FILES) + 1, 0, sum(map(len, FILES.values())))
    sizes = record.plan().groupBy("wave").agg(F.sum("file_size").alias("b"), F.max("file_size").alias("m")).collect()
    assert all(r.b <= PER_WAVE + r.m for r in sizes)


def test_a_job_lost_inside_a_wave(spark, tmp_path, pairs, monkeypatch):
    journal = str(tmp_path / "journal")
    calls = []

    def failing(rows, conf):
        calls.append(conf.tasks)
        result = copy_files(rows, conf)
        if len(calls) == 3:
            raise RuntimeError("the driver is lost")
        return result

    monkeypatch.setattr(waves, "copy_files", failing)
    with pytest.raises(RuntimeError, match="lost"):
        copy_in_waves(spark, journal, pairs, PER_WAVE)
    record = Journal(spark, journal)
    # The third wave was copied, but nobody wrote that down.
    assert record.pending() == [2, 3, 4] and {r.wave for r in record.results().collect()} == {0, 1}
    results = copy_in_waves(spark, journal)
    assert len(calls) == 6 and calls == [1] * 6
    assert results.count() == len(FILES) + 1 and harvest(tmp_path / "copy") == FILES


def test_a_plan_half_written_is_written_again(spark, tmp_path, pairs):
    journal = str(tmp_path / "journal")
    with pytest.raises(ValueError, match="no plan"):
        copy_in_waves(spark, journal)
    pairs.limit(3).withColumn("wave", F.lit(7)).write.partitionBy("wave").parquet(f"{journal}/plan")
    copy_in_waves(spark, journal, pairs, PER_WAVE)
    assert harvest(tmp_path / "copy") == FILES and 7 not in {r.wave for r in Journal(spark, journal).results().collect()}


def test_failed_pairs_get_a_wave_of_their_own(spark, tmp_path, pairs):
    journal, source = str(tmp_path / "journal"), tmp_path / "tree" / "d1" / "f01"
    source.rename(tmp_path / "away")
    results = copy_in_waves(spark, journal, pairs, PER_WAVE)
    assert [os.path.basename(r.src_file) for r in results.filter("status = 'OPEN_FAILED'").collect()] == ["f01"]
    assert Journal(spark, journal).commits().agg(F.sum("failed")).first()[0] == 1
    (tmp_path / "away").rename(source)
    again = copy_in_waves(spark, journal, retry_failed=True)
    assert again.count() == results.count() + 1 and harvest(tmp_path / "copy") == FILES
    assert copy_in_waves(spark, journal, retry_failed=True).count() == again.count()


def test_waves_of_nothing(spark, tmp_path, pairs):
    assert copy_in_waves(spark, str(tmp_path / "journal"), pairs.limit(0)).collect() == []


# --- ranges --------------------------------------------------------------------------------------------------------


def test_no_task_reads_more_than_a_range(spark, tmp_path):
    """One large file over many tasks; without the digest of the whole nothing reads it from start to end."""
    data = random.Random(4).randbytes(1_000_003)
    tree, target = plant(tmp_path / "tree", {"big": data, "small": b"s"}), tmp_path / "copy"
    log = tmp_path / "reads"
    log.mkdir()
    kept = fs.blocks

    def counted(stream, begin=0, length=None):
        for block in kept(stream, begin, length):
            with open(log / f"{os.getpid()}-{begin}-{id(stream)}", "ab") as out:
                out.write(b"." * len(block))
            yield block

    def logging_fetcher(conf):
        def run(batches):
            transfer.fs.blocks = counted
            yield from fetcher(conf)(batches)

        return run

    fetcher = transfer._fetcher
    conf = CopyConf(ranged_from=10_000, chunk_bytes=65_536, whole_md5=False)
    try:
        transfer._fetcher = logging_fetcher
        result = copy_files(make_pairs(list_files(spark, tree), str(target)), conf)
    finally:
        transfer._fetcher = fetcher
    rows = {os.path.basename(r.src_file): r for r in result.collect()}
    assert harvest(target) == {"big": data, "small": b"s"}
    assert rows["big"].status == "COPIED" and rows["big"].bytes_copied == len(data) and rows["big"].src_md5 is None
    assert rows["small"].src_md5 == b64(b"s")
    reads = [p.stat().st_size for p in log.iterdir()]
    assert len(reads) >= 16 and max(reads) <= 65_536


def test_a_range_is_committed_only_if_all_are_there(spark, tmp_path):
    data = random.Random(5).randbytes(50_000)
    tree, target = plant(tmp_path / "tree", {"big": data}), tmp_path / "copy"
    plan, conf = make_pairs(list_files(spark, tree), str(target)), CopyConf(ranged_from=1000, chunk_bytes=10_000)
    # The source loses its tail between the listing and the copy: the last ranges cannot be read.
    (tmp_path / "tree" / "big").write_bytes(data[:25_000])
    elsewhere = make_pairs(list_files(spark, tree), str(tmp_path / "other")).withColumn("file_size", F.lit(50_000).cast("bigint"))
    large = elsewhere.withColumn("temp", F.lit(None).cast("string")).withColumn("parts", F.lit(0))
    assert [r.parts for r in transfer._fetch_ranges(large, conf, 4).collect()] == [0]
    assert [r.status for r in copy_files(plan, conf).collect()] == ["SIZE_CHANGED"] and harvest(target) == {}


def test_a_source_that_grew_meanwhile_is_copied_whole(spark, tmp_path):
    data = random.Random(6).randbytes(50_000)
    tree, target = plant(tmp_path / "tree", {"big": data}), tmp_path / "copy"
    plan = make_pairs(list_files(spark, tree), str(target)).withColumn("may_grow", F.lit(True))
    (tmp_path / "tree" / "big").write_bytes(data + b"more")
    result = copy_files(plan, CopyConf(ranged_from=1000, chunk_bytes=10_000))
    assert [(r.status, r.error) for r in result.collect()] == [("SIZE_CHANGED", None)]
    assert harvest(target) == {"big": data + b"more"}


def test_a_commit_that_runs_again(tmp_path):
    source, temp, dest = tmp_path / "s", tmp_path / "t", tmp_path / "d"
    source.write_bytes(b"abc")
    temp.write_bytes(b"abc")

    class Row:
        src_file, dest_file = str(source), str(dest)

    Row.temp = str(temp)
    for _ in range(2):
        assert transfer._commit(Row, 3, None, CopyConf()) == ("COPIED", b64(b"abc"), 3)
    assert dest.read_bytes() == b"abc" and not temp.exists()


# --- queries and deletions -----------------------------------------------------------------------------------------


def test_file_queries_do_not_disturb_each_other(spark):
    """Each twice, and in either order."""
    names = ["compare_file", "run_sync", "copy_files", "list_files", "copy_waves"]
    seen = {}
    for name in [*names, *reversed(names)]:
        df = QUERIES[name](spark, SF)
        rows = rows_of(df.columns, df.collect())
        assert seen.setdefault(name, rows) == rows


def test_nothing_is_deleted_after_failures(spark, tmp_path):
    target = tmp_path / "target"
    plant(target, {"old": b"1"})
    todo = spark.createDataFrame([(str(tmp_path / "none"), str(target / "none"), True, 1, "COPY")],
                                 "src_file string, dest_file string, is_file boolean, file_size bigint, action string")
    names = spark.createDataFrame([("old", True)], "entry_name string, is_file boolean")
    sizes = spark.createDataFrame([("old", 1)], "entry_name string, file_size bigint")
    plan = SyncPlan(todo, names, None, sizes)
    assert run_sync(plan, str(target), 1, dry_run_deletes=False).deleted is None and (target / "old").exists()
    run_sync(plan, str(target), 1, dry_run_deletes=False, delete_after_failures=True)
    assert not (target / "old").exists()


def test_a_wave_of_many_files_has_many_tasks(spark, pairs, tmp_path, monkeypatch):
    asked, copy = [], waves.copy_files
    monkeypatch.setattr(waves, "FILES_PER_TASK", 10, raising=False)
    monkeypatch.setattr(waves, "copy_files", lambda plan, conf: asked.append(conf.tasks) or copy(plan, conf))
    result = copy_in_waves(spark, f"{tmp_path}/journal", pairs)
    assert asked == [5] and result.count() == len(FILES) + 1
    assert harvest(tmp_path / "copy") == harvest(tmp_path / "tree")


def test_a_large_group_is_several_tasks(spark, pairs, monkeypatch):
    plan = pairs.withColumn("group_id", F.lit(2))
    monkeypatch.setattr(transfer, "FILES_PER_TASK", 10, raising=False)
    result = copy_files(plan)
    assert result.filter("status IN ('COPIED', 'MKDIR')").count() == len(FILES) + 1
    assert result.select(F.input_file_name().alias("f")).distinct().count() > 1
    # A number of tasks that was asked for stays.
    assert copy_files(plan, CopyConf(tasks=4)).select(F.input_file_name().alias("f")).distinct().count() == 1


def test_small_local_files_need_no_threads(tmp_path, monkeypatch):
    row = namedtuple("row", "src_file dest_file is_file file_size")
    rows = [row("/a", "/b", True, 5), row("/a", "", True, 5), row("/a", "/b", True, 5 << 20), row("s3://x/a", "/b", True, 5),
            row(None, "/b/", False, None), row("/a", "hdfs://x/b", True, 5)]
    monkeypatch.setattr(transfer, "_copy_row", lambda r, conf: (r.src_file, r.dest_file, threading.current_thread().name, *range(6)))
    [found] = transfer._copier(CopyConf())(iter([pd.DataFrame(rows)]))
    here = threading.current_thread().name
    assert [name == here for name in found["status"]] == [True, True, False, False, True, False]
    assert found["dest_file"].tolist() == [r.dest_file for r in rows]


def test_a_tree_is_written_few_contents_at_a_time(tmp_path):
    names = [f"d/{i}" for i in range(3000)] + ["hollow/"]
    batch = pa.RecordBatch.from_pydict({"entry_name": names, "c": ["x" * 10_000] * 3000 + [""]})
    tracemalloc.start()
    written = [name for out in fixtures._tree_writer(str(tmp_path))(iter([batch])) for name in out["entry_name"].to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert written == names and peak < 10_000_000
    assert len(list((tmp_path / "d").iterdir())) == 3000 and (tmp_path / "hollow").is_dir()
    assert (tmp_path / "d/2999").read_bytes() == b"x" * 10_000


def test_sync_copies_a_large_group_by_several_tasks(spark, pairs, monkeypatch, tmp_path):
    """However many groups are asked for: one of many small files is not the work of one task."""
    monkeypatch.setattr(transfer, "FILES_PER_TASK", 10, raising=False)
    plan = SyncPlan(pairs.withColumn("action", F.lit("COPY")), None, None)
    copied = run_sync(plan, f"{tmp_path}/copy", groups=1).copied
    assert copied.filter("status IN ('COPIED', 'MKDIR')").count() == len(FILES) + 1
    assert copied.select(F.input_file_name().alias("f")).distinct().count() > 1
    assert harvest(tmp_path / "copy") == harvest(tmp_path / "tree")


def test_each_group_has_tasks_for_its_own_files(spark, monkeypatch):
    monkeypatch.setattr(transfer, "FILES_PER_TASK", 10, raising=False)
    rows = spark.range(0, 60).selectExpr("concat('/a/', id) AS src_file", "concat('/b/', id) AS dest_file",
                                         "CASE WHEN id < 45 THEN 7 WHEN id < 55 THEN -1 END AS group_id")
    task, total = transfer._task_of_group(rows)
    numbered = rows.select("group_id", task.alias("task")).distinct().collect()
    assert total == 5 + 1 + 1
    of = {g: {r.task for r in numbered if r.group_id == g} for g in (7, -1, None)}
    assert len(of[-1]) == len(of[None]) == 1 and 2 <= len(of[7]) <= 5
    assert sum(map(len, of.values())) == len(set().union(*of.values())) and set().union(*of.values()) <= set(range(7))
    empty, one = transfer._task_of_group(rows.limit(0))
    assert one == 1 and rows.select(empty.alias("task")).distinct().collect() == [(0,)]


def test_a_replaced_file_is_freed_after_its_place_is_taken(tmp_path, monkeypatch):
    old, new = tmp_path / "old", tmp_path / "new"
    kept = fs._Replaced()
    kept._on_disk[str(tmp_path)] = True
    monkeypatch.setattr(fs, "_replaced", kept)
    seen, free = [], fs._Replaced.free
    monkeypatch.setattr(fs._Replaced, "free", lambda self, handle: seen.append((old.read_bytes(), os.fstat(handle).st_nlink, handle)))
    old.write_bytes(b"old")
    new.write_bytes(b"new")
    fs.move(str(new), str(old))
    assert [row[:2] for row in seen] == [(b"new", 0)]
    # In the background while there is room, here if there is none.
    free(kept, seen[0][2])
    kept._pool.shutdown()
    with pytest.raises(OSError):
        os.fstat(seen[0][2])
    handles = [kept.hold(str(old)) for _ in range(3)]
    kept._room = threading.BoundedSemaphore(1)
    kept._room.acquire()
    for handle in handles:
        free(kept, handle)
        with pytest.raises(OSError):
            os.fstat(handle)
    # Nothing to hold, or no disk of this machine.
    assert kept.hold(str(new)) is None
    kept._on_disk[str(tmp_path)] = False
    assert kept.hold(str(old)) is None
    # Code that was used here still travels.
    assert cloudpickle.loads(cloudpickle.dumps(kept))._pool is None


def test_a_tree_makes_a_directory_once(tmp_path, monkeypatch):
    made, make = [], fs.make_dir
    monkeypatch.setattr(fs, "make_dir", lambda path: made.append(path) or make(path))
    batch = pa.RecordBatch.from_pydict({"entry_name": [f"d{i % 3}/{i}" for i in range(30)], "c": ["x"] * 30})
    list(fixtures._tree_writer(str(tmp_path))(iter([batch, batch])))
    assert made == [f"{tmp_path}/d{i}" for i in range(3)] and len(list(tmp_path.glob("*/*"))) == 30
