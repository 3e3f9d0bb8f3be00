"""Column helpers at their edges."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from haulmark.functions import attributes, bounds, paths, sizes


def values(spark, column, inputs, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r[0] for r in df.select(column.alias("r"), "i").sort("i").collect()]


def test_fs_type(spark):
    cases = {
        None: "UNKNOWN", "/a/b": "HDFS", "a b": "HDFS", "hdfs://nn:8020/a": "HDFS", "WEBHDFS://h/x": "HDFS",
        "s3://b/k": "S3", "S3N://b/k": "S3", "s3a://b/k": "S3", "file:///tmp/x": "LOCAL", "file:/tmp/x": "LOCAL",
        "ftp://h/x": "UNKNOWN",
    }
    assert values(spark, paths.fs_type("v"), cases) == list(cases.values())


def test_split_uri(spark):
    cases = {
        "s3n://bucket/test/tdir/file": ("bucket", "test/tdir/file"), "s3n://bucket": ("bucket", ""),
        "s3n://bucket/test/tdir/": ("bucket", "test/tdir/"), "/user/x": (None, "user/x"),
        "file:///tmp/d": (None, "tmp/d"), "hdfs://nn:8020/a b": ("nn:8020", "a b"),
    }
    assert [tuple(r) for r in values(spark, paths.split_uri("v"), cases)] == list(cases.values())


def test_relative_path(spark):
    cases = {
        "/r/a/b": "a/b", "/r": ".", "/r/": ".", "/r//a/": "a", "/r2/a": None, "/x/r/a": None,
        "hdfs://nn/r/a/r/b": "a/r/b", "/": None,
    }
    assert values(spark, paths.relative_path("v", "/r/"), cases) == list(cases.values())
    assert values(spark, paths.relative_path("v", "/"), ["/a/b", "/"]) == ["a/b", "."]


def test_parents(spark):
    assert values(spark, paths.parent("v"), ["a", "a/b", "a/b/c/", "a/"]) == ["", "a", "a/b", ""]
    assert values(spark, paths.ancestors("v"), ["a", "a/b", "a/b/c/"]) == [[], ["a"], ["a", "a/b"]]


def test_is_ancestor(spark):
    assert values(spark, paths.is_ancestor(F.lit("a/b"), "v"), ["a/b", "a/b/c", "a/bc", "a"]) == [
        True, True, False, False]


def test_suffixes(spark):
    cases = {"a.txt": "txt", "a.tar.gz": "gz", "plain": "", "end.": "", ".x": "x", "a.b..": "b", "...": "", "": ""}
    assert values(spark, paths.suffix("v"), cases) == list(cases.values())
    renamed = {"a.txt": "a.n", "a.b.c": "a.b.n", "plain": "plain.n", "end.": "end..n", "a.b..": "a.b..n"}
    assert values(spark, paths.replace_suffix("v", ".n"), renamed) == list(renamed.values())


def test_sizes(spark):
    cases = {
        "1230k": 1259520, "891g": 956703965184, "12": 12, " 7 ": 7, "0": None, "-5": None, "5x": None, "k": None,
        "8E": None, "7e": 7 * 1024**6, "12 k": None, "": None, None: None, "99999999999999999999": None,
    }
    assert values(spark, sizes.parse_size("v"), cases) == list(cases.values())
    texts = {0: "0 bytes (0.0)", 1536: "1536 bytes (1.5k)", 1048576: "1048576 bytes (1.0m)",
             5 * 1024**3: "5368709120 bytes (5.0g)", 1023: "1023 bytes (1023.0)"}
    assert values(spark, sizes.human_bytes("v"), texts, "bigint") == list(texts.values())


def test_bounds(spark):
    cases = {
        "2014-09-29-24-00-00-000": 1411948800000, "2014-09-29-00-00-00-000": 1411948800000,
        "2014-09-29-13-05-06-007": 1411995906007, "2014-02-30-01-00-00-000": None, "2014-09-29-25-00-00-000": None,
        "nonsense": None, None: None,
    }
    assert values(spark, bounds.parse_bound("v"), cases) == list(cases.values())
    summer, winter = "2024-07-01-12-00-00-000", "2024-01-01-12-00-00-000"
    local = values(spark, bounds.parse_bound("v", "America/New_York"), [summer, winter])
    assert local == [bounds.bound_millis(summer, "America/New_York"), bounds.bound_millis(winter, "America/New_York")]
    assert local[0] - bounds.bound_millis(summer) == 4 * 3600 * 1000
    with pytest.raises(ValueError):
        bounds.bound_millis("2024-01-01")


def test_moments_do_not_depend_on_the_session_zone(spark):
    moments = [datetime(2024, 7, 1, 12, 0, 0, 123456), datetime(1969, 12, 31, 23, 59, 59, 999900)]
    text = [m.isoformat(sep=" ") for m in moments]
    expected = [1719835200123, -1]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(t,) for t in text], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        assert sorted(r[0] for r in df.select(bounds.epoch_millis(df, "t")).collect()) == sorted(expected)
        assert df.filter(F.col("t") < bounds.moment(df, "t", datetime(2024, 1, 1))).count() == 1
        zoned = df.select(F.timestamp_millis(F.lit(1719835200123)).alias("t"))
        assert zoned.select(bounds.epoch_millis(zoned, "t")).first()[0] == 1719835200123
        assert zoned.filter(F.col("t") < bounds.moment(zoned, "t", datetime(2024, 7, 1, 12, 0, 1))).count() == 2
        assert zoned.filter(F.col("t") < bounds.moment(zoned, "t", datetime(2024, 7, 1, 12))).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_attribute_letters():
    assert attributes.parse_attrs("ug") == {"USER", "GROUP"}
    assert len(attributes.parse_attrs("")) == len(attributes.parse_attrs(None)) == 5
    for bad in ("uu", "x"):
        with pytest.raises(ValueError):
            attributes.parse_attrs(bad)


def test_names(spark):
    assert values(spark, paths.part_name("filegroup", "v"), [3, 1234], "int") == ["filegroup-003", "filegroup-1234"]
    assert values(spark, paths.join_path("v", F.lit("n")), ["/a/", "/a"]) == ["/a/n", "/a/n"]
    entry = paths.format_entry(F.lit("b"), F.lit("d/"), F.lit(False), F.lit(0))
    assert values(spark, entry, [""]) == ["b | d/ | dir | 0"]
