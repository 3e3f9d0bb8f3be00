"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from haulmark.operators import diff, layout, sync, uploads
from haulmark.operators.digest import content_part_md5, file_md5
from haulmark.operators.ordered import row_position
from haulmark.queries import QUERIES
from haulmark.queries import fixtures as fx
from tests.conftest import SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries whose own job is an action on files or a stored table leave no plan to look at.
LAZY = sorted(set(QUERIES) - {
    "compare_file", "run_sync", "keep_attributes", "file_md5", "part_md5", "copy_files", "copy_waves", "copy_ranges", "create_markers", "failure_log", "list_files",
    "list_empty_dirs", "read_manifest", "read_uri_list", "write_plan", "bandwidth_monitor",
    "list_keys", "keys_source", "upload_files", "verify_store", "download_files",
})


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name != "reassemble":
        assert "Python" not in plan and "MapInPandas" not in plan and "ArrowEval" not in plan


def test_diff_is_one_shuffle_of_numbers(spark):
    src, dst = fx.src_listing(spark, SF, True), fx.dst_listing(spark, SF, True)
    for df in (diff.dir_diff(src, dst), diff.content_diff(src, dst)):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1
        assert "SortAggregate" not in plan and "Join" not in plan and "Sort " not in plan
    shuffled = re.search(r"Exchange.*?\n(.*HashAggregate.*)", plan_of(diff.dir_diff(src, dst))).group(1)
    assert "text" not in shuffled


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(uploads.stale_uploads(fx.uploads(spark, SF), datetime(1998, 8, 31), 91))
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate", plan)
    assert "o_totalprice" not in plan
    plan = plan_of(QUERIES["upload_sizes"](spark, SF))
    assert "l_extendedprice" not in plan and re.search(r"ReadSchema: struct<l_orderkey:bigint,l_quantity:double>", plan)
    assert "text:string" not in plan_of(QUERIES["presence"](spark, SF))


def test_digests_are_taken_once(spark):
    plan = plan_of(content_part_md5(fx.src_content(spark, SF), "entry_name", "c", 1000))
    assert plan.count("md5(") == 1


def test_windows_over_data_are_partitioned(spark):
    """Small bins: windows without partitions only see one row per bin."""
    rows = fx.src_listing(spark, SF).select("entry_name", "is_file", "file_size")
    for df in (row_position(rows, ["entry_name"], rows_per_bin=100),
               layout.split_plan(rows, 8, "entry_name", rows_per_bin=100),
               sync.prev_dest(fx.grouped_pairs(spark, SF).withColumn("dest_file", F.lit("same")), rows_per_bin=100)):
        plan = plan_of(df)
        for single in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
            assert "HashAggregate(keys=[_bin" in single or "SortAggregate(key=[_bin" in single


def test_file_jobs_keep_one_task_per_group(spark, tmp_path):
    rows = [(str(tmp_path / f"f{i}"), 1, i % 5) for i in range(40)]
    files = spark.createDataFrame(rows, "path string, file_size bigint, group_id int")
    for df in (file_md5(files), file_md5(files, 5)):
        tasks = df.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert sorted(r["count"] for r in tasks) == [8] * 5
