"""Paths taken only on large or skewed data, forced on small fixtures and checked against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from haulmark.operators import layout, listing, ordered, skew, sync


def hot_rows(count: int, seed: int = 1) -> list[tuple]:
    """``(worker, ts, bytes)``; worker 7 has a third of the rows."""
    rng = random.Random(seed)
    return [(7 if i % 3 == 0 else rng.randrange(40), i * 7919 % count, rng.randrange(1000)) for i in range(count)]


def test_running_sum_with_a_hot_key(spark):
    rows = hot_rows(5000)
    df = spark.createDataFrame(rows, "worker int, ts int, bytes bigint")
    assert ordered.with_bins(df, ["worker", "ts"], 200)[1] > 10
    got = ordered.running_sum(df, F.col("bytes"), ["ts"], ["worker"], rows_per_bin=200)
    want, totals = set(), {}
    for worker, ts, size in sorted(rows):
        totals[worker] = totals.get(worker, 0) + size
        want.add((worker, ts, size, totals[worker]))
    assert {tuple(r) for r in got.select("worker", "ts", "bytes", "running").collect()} == want


def test_bins_split_a_hot_key_evenly(spark):
    df = spark.createDataFrame(hot_rows(6000), "worker int, ts int, bytes bigint")
    binned, bins = ordered.with_bins(df, ["worker", "ts"], 300)
    largest = binned.groupBy("_bin").count().agg(F.max("count")).first()[0]
    assert bins == 20 and largest < 900


def test_global_position_equals_sorting(spark):
    names = [f"n{i * 7919 % 3000:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = ordered.row_position(df, ["name"], rows_per_bin=100).collect()
    assert {(r.name, r.position) for r in got} == {(n, i) for i, n in enumerate(sorted(names), start=1)}


def test_keys_with_nulls_are_placed(spark):
    rows = [(None if i % 5 == 0 else f"k{i % 3}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, i int")
    got = ordered.running_sum(df, F.lit(1).cast("bigint"), ["i"], ["k"], rows_per_bin=50).collect()
    want, seen = set(), {}
    for k, i in sorted(rows, key=lambda r: r[1]):
        seen[k] = seen.get(k, 0) + 1
        want.add((k, i, seen[k]))
    assert {(r.k, r.i, r.running) for r in got} == want


def test_previous_row_across_bins(spark):
    rng = random.Random(3)
    rows = [(f"d{0 if i % 3 == 0 else rng.randrange(50)}", f"s{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "dest_file string, src_file string")
    got = sync.prev_dest(df, rows_per_bin=100).collect()
    want, last = set(), {}
    for dest, src in sorted(rows):
        if dest in last:
            want.add((dest, src, last[dest]))
        last[dest] = src
    assert {(r.dest_file, r.src_file, r.prev_src) for r in got} == want


def sequential_budget(sizes: list[int], budget: int, max_files: int | None = None) -> list[int]:
    taken, used = [], 0
    for i, size in enumerate(sizes):
        if (max_files is None or len(taken) < max_files) and used + size <= budget:
            taken.append(i)
            used += size
    return taken


@pytest.mark.parametrize("seed", range(6))
def test_budget_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, rng.randrange(10), rng.randrange(1000), rng.randrange(10**6)]) for _ in range(400)]
    budget = rng.choice([0, 1, 5000, 10**6, sum(sizes)])
    max_files = rng.choice([None, 10, 150])
    df = spark.createDataFrame([(f"f{i:04d}", True, s) for i, s in enumerate(sizes)],
                               "entry_name string, is_file boolean, file_size bigint")
    got = sync.budget_admit(df, max_files, budget, rows_per_bin=rng.choice([60, 100_000]))
    assert sorted(r.entry_name for r in got.collect()) == [
        f"f{i:04d}" for i in sequential_budget(sizes, budget, max_files)
    ]


def test_budget_that_shrinks_slowly(spark):
    """Each second file just does not fit: a round per file would need hundreds of rounds."""
    sizes = [x for i in range(150) for x in (1, 1000 - i)]
    df = spark.createDataFrame([(f"f{i:04d}", True, s) for i, s in enumerate(sizes)] + [("dir/", False, 0)],
                               "entry_name string, is_file boolean, file_size bigint")
    got = sync.budget_admit(df, None, 1000)
    assert sorted(r.entry_name for r in got.collect()) == ["dir/"] + [
        f"f{i:04d}" for i in sequential_budget(sizes, 1000)
    ]


def stages_of(spark, group: str) -> list:
    """Task counts of all stages that the jobs of a group have run."""
    tracker, counts = spark.sparkContext.statusTracker(), []
    for job in tracker.getJobIdsForGroup(group):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            if info is not None and info.numCompletedTasks:
                counts.append(info.numTasks)
    return counts


@pytest.mark.parametrize(("budget", "scans"), [(3, 2), (70_000, 3), (3_000_000, 3), (10**12, 3)])
def test_budget_reads_the_files_three_times(spark, budget, scans):
    """The source has 37 tasks and nothing else has; bins of 100 rows.  What fits one bin needs no sample."""
    size = "id * 7919 % 100003 % (1 + id * 31 % 9973)"
    files = spark.range(0, 4000, 1, 37).selectExpr("lpad(id, 6, '0') AS entry_name", "true AS is_file", f"{size} AS file_size")
    sizes = [i * 7919 % 100003 % (1 + i * 31 % 9973) for i in range(4000)]
    group = f"budget-{budget}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = sync.budget_admit(files, None, budget, rows_per_bin=100)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages_of(spark, group).count(37) == scans
    assert sorted(int(r.entry_name) for r in got.collect()) == sequential_budget(sizes, budget)


def test_budget_with_false_hopes_in_every_bin(spark):
    """Each bin ends with a file that the budget left at its start would hold, but not what is left when it comes."""
    sizes = [x for i in range(60) for x in (*[1] * 9, 1000 - 9 * i)]
    df = spark.createDataFrame([(f"f{i:04d}", True, s) for i, s in enumerate(sizes)],
                               "entry_name string, is_file boolean, file_size bigint")
    for rows_per_bin in (10, 37):
        got = sync.budget_admit(df, None, 1008, rows_per_bin=rows_per_bin)
        assert sorted(r.entry_name for r in got.collect()) == [f"f{i:04d}" for i in sequential_budget(sizes, 1008)]


def test_budget_of_files_without_size_or_with_none(spark):
    schema = "entry_name string, is_file boolean, file_size bigint"
    empty = spark.createDataFrame([], schema)
    assert sync.budget_admit(empty, None, 10).count() == 0
    odd = spark.createDataFrame([("a", True, None), ("b", True, 0), ("c", True, 11), ("d", True, 10), ("e", True, 0), ("f/", False, None)], schema)
    assert sorted(r.entry_name for r in sync.budget_admit(odd, None, 10).collect()) == ["b", "d", "e", "f/"]


def pairs_of(spark, sizes: list[int], dirs: int = 0):
    rows = [(f"/s/{i:05d}", f"/d/{i:05d}", True, s) for i, s in enumerate(sizes)]
    rows += [(f"/s/dir{i:05d}/", f"/d/dir{i:05d}/", False, 0) for i in range(dirs)]
    return spark.createDataFrame(rows, "src_file string, dest_file string, is_file boolean, file_size bigint")


def test_groups_are_balanced(spark):
    rng = random.Random(5)
    sizes = [int(rng.paretovariate(1.1) * 1000) for _ in range(3000)]
    pairs = pairs_of(spark, sizes, dirs=50)
    summary = layout.group_summary(layout.assign_groups(pairs, 12, rows_per_bin=200)).collect()
    assert sum(r.files for r in summary) == 3000 and sum(r.dirs for r in summary) == 50
    total, largest = sum(r.weight for r in summary), max(sizes) + layout.FILE_WEIGHT
    assert max(r.weight for r in summary) <= max(largest, total / 12) + total / (12 * 20)
    # The same rule however the light items are cut into bins.
    plain = layout.assign_groups(pairs, 12).select("src_file", "group_id")
    assert plain.exceptAll(layout.assign_groups(pairs, 12, rows_per_bin=90).select("src_file", "group_id")).count() == 0


def test_groups_of_the_larger_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr(
        "concat('/s/', doc_id) AS src_file", "true AS is_file", "CAST(octet_length(text) AS bigint) AS file_size")
    weights = [r.weight for r in layout.group_summary(layout.assign_groups(documents, 50)).collect()]
    assert len(weights) == 50 and max(weights) <= 1.05 * sum(weights) / 50


def test_groups_with_few_items(spark):
    assert layout.assign_groups(pairs_of(spark, []), 4).count() == 0
    assert sorted(r.group_id for r in layout.assign_groups(pairs_of(spark, [5, 3]), 4).collect()) == [0, 1]
    heavy = layout.assign_groups(pairs_of(spark, [10**6] * 30), 40)
    assert heavy.select("group_id").distinct().count() == 30


def test_unknown_sizes_stay_in_the_plan(spark):
    pairs = pairs_of(spark, list(range(50)) * 10)
    unknown = pairs.withColumn("file_size", F.expr("nullif(file_size, 7)"))
    grouped = layout.assign_groups(unknown, 3)
    assert grouped.count() == 500 and grouped.filter("file_size IS NULL").count() == 10


def test_task_count_follows_the_nodes(spark):
    pairs = spark.createDataFrame([(10**15,)], "file_size bigint")
    assert [layout.task_count(pairs, n).first().tasks for n in (1, 50)] == [20, 1000]


def test_task_count_follows_the_files(spark):
    pairs = spark.range(95).selectExpr("1L AS file_size")
    assert layout.task_count(pairs, 1).first().tasks == 1
    assert [layout.task_count(pairs, n, files_per_task=f).first().tasks for n, f in ((1, 10), (1, 1), (5, 1))] == [10, 20, 95]
    assert layout.task_count(pairs.limit(0), 1, files_per_task=10).first().tasks == 1


def test_splits_are_contiguous_and_even(spark):
    rng = random.Random(8)
    sizes = [rng.randrange(1000) for _ in range(2000)] + [0, 0]
    rows = [(f"n{i:05d}", s) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "entry_name string, file_size bigint")
    got = layout.split_plan(df, 16, "entry_name", rows_per_bin=150).sort("entry_name").collect()
    ids = [r.split_id for r in got]
    assert ids == sorted(ids) and set(ids) == set(range(16))
    for split in range(16):
        assert sum(r.file_size for r in got if r.split_id == split) <= sum(sizes) / 16 + 1000
    empty = layout.split_plan(df.withColumn("file_size", F.lit(0).cast("bigint")), 16, "entry_name")
    assert {r.split_id for r in empty.collect()} == {0}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_hot_keys(spark, how):
    left = spark.createDataFrame([(0 if i % 3 == 0 else (None if i % 10 == 1 else i % 50), i) for i in range(2000)],
                                 "k int, i int")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 50, 2)], "k int, v string")
    hot = skew.hot_keys(left, "k", fraction=1.0, min_sampled=200)
    assert hot == [0]
    got = skew.lookup_join(left, right, "k", how, hot)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_first_of_a_hot_name(spark, monkeypatch):
    rows = [("hot" if i % 3 == 0 else f"n{i % 400}", i * 7919 % 3000) for i in range(3000)]
    df = spark.createDataFrame(rows, "entry_name string, file_size bigint").repartition(16)
    plain = listing.dedupe_listing(df, ["file_size"])
    monkeypatch.setattr(listing, "hot_keys", lambda d, k: skew.hot_keys(d, k, fraction=1.0, min_sampled=300))
    sliced = listing.dedupe_listing(df, ["file_size"])
    first = {}
    for name, size in rows:
        first[name] = min(size, first.get(name, size))
    for kept, rejected in (plain, sliced):
        assert {(r.entry_name, r.file_size) for r in kept.collect()} == set(first.items())
        assert kept.count() == len(first) and kept.count() + rejected.count() == 3000


def test_extraneous_with_a_hot_directory(spark):
    src = [("keep", False), ("keep/a", True)]
    dst = src + [("big", False), ("keep/b", True), ("a", False), ("a.b", True), ("a/c", True), ("a/d", False),
                 ("a/d/e", True)]
    dst += [(f"big/f{i}", True) for i in range(700)] + [("big/sub", False), ("big/sub/x", True)]
    schema = "entry_name string, is_file boolean"
    wanted = {("big", False), ("keep/b", True), ("a", False), ("a.b", True)}
    args = spark.createDataFrame(src, schema), spark.createDataFrame(dst, schema)
    assert {tuple(r) for r in sync.extraneous(*args).collect()} == wanted
    for rows_per_bin in (1, 7, 100):
        assert {tuple(r) for r in sync.extraneous(*args, rows_per_bin=rows_per_bin).collect()} == wanted


def test_sweep_equals_all_ancestors(spark):
    """Against every strict ancestor of every entry, with characters that sort before and after the separator."""
    source = random.Random(12)
    names = {"/".join(source.choice(["a", "b", "a.b", "a-", "a\x01", "é"]) for _ in range(source.randint(1, 5))) for _ in range(400)}
    keep = {n for n in names if source.random() < 0.3}
    gone = names - keep
    want = {n for n in gone if not any("/".join(n.split("/")[:i]) in gone for i in range(1, n.count("/") + 1))}
    schema = "entry_name string, is_file boolean"
    src = spark.createDataFrame([(n, False) for n in sorted(keep)], schema)
    dst = spark.createDataFrame([(n + "/", False) for n in sorted(names)] * 2, schema)
    for rows_per_bin in (3, 1000):
        assert sorted(r.entry_name for r in sync.extraneous(src, dst, rows_per_bin).collect()) == sorted(want)
    assert sync.extraneous(src, dst.limit(0)).collect() == []


def test_rows_come_out_in_order(spark):
    source = random.Random(13)
    rows = [(f"n{source.randrange(10**6):06d}-{i}", source.randrange(50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "src_file string, file_size bigint").repartition(7)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    for rows_per_bin in (90, 10**6):
        ranked = ordered.row_position(df, [-F.col("file_size"), F.col("src_file")], rows_per_bin=rows_per_bin, in_order=True)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and plan.count("shufflepartitionidpassthrough") == (rows_per_bin == 90)
        assert [tuple(r) for r in ranked.collect()] == [(*r, i) for i, r in enumerate(want, 1)]
        # Also where nobody looks at the position.
        assert [r.src_file for r in ranked.select("src_file").collect()] == [n for n, _ in want]


def test_items_meet_the_gaps_of_their_cell_only():
    source = random.Random(14)
    for _ in range(200):
        lengths = [source.choice([1, 2, 3, 1000]) for _ in range(source.randint(1, 40))]
        starts = [sum(lengths[:i]) for i in range(len(lengths))]
        width, cells = layout._gap_cells(starts, range(len(starts)), sum(lengths))
        assert len(cells) <= len(starts) and sum(len(c[1]) for c in cells) <= 2 * len(starts) + 1
        for at in range(sum(lengths)):
            _, begins, groups = cells[at // width]
            assert groups[sum(b <= at for b in begins) - 1] == max(i for i, s in enumerate(starts) if s <= at)
