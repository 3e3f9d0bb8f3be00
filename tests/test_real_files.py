"""Jobs on real trees: listing, digests, copies, comparison, deletion."""

from __future__ import annotations

import base64
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from haulmark.operators import digest, diff, transfer
from haulmark.operators.attributes import apply_attributes
from haulmark.operators.layout import assign_groups
from haulmark.operators.listing import make_pairs, union_sources
from haulmark.operators.sync import copy_action
from haulmark.operators.transfer import CopyConf, copy_files
from haulmark.plans import (
    cleanup_dir, compare_file, compare_pairs, compare_trees, copy_manifest, copy_tree, keep_attributes, plan_sync, run_sync,
)
from haulmark.queries.sync import run_sync_query
from haulmark.sources import logs
from haulmark.sources.files import list_files
from haulmark.sources.plan_store import read_plan, write_plan
from haulmark.sources.tables import check_sources, read_uri_list
from haulmark.streaming import bandwidth_monitor, start_monitor

TREE = {
    "a": b"1", "a.b": b"22", "dir/one.txt": b"one", "dir/.hidden": b"h", "dir/_SUCCESS": b"",
    "dir/with blank.txt": b"blank", "dir/é/ü.txt": b"accent", "dir2/deep/deeper/deepest/x": b"x" * 5000,
    ".archive/t1/r1/d/0f3a": b"cells", "wals/rs%2C60020%2C1411803631037.1412021673465": b"wal",
}
EMPTY_DIRS = ["void", "dir2/hollow/inner"]


def b64(data: bytes) -> str:
    return base64.b64encode(hashlib.md5(data).digest()).decode()


def plant(root, files=TREE, dirs=()):
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    for name in dirs:
        (root / name).mkdir(parents=True)
    return str(root)


def harvest(root) -> dict[str, bytes]:
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def statuses(df, name="entry_name"):
    return {r[name]: r.status for r in df.collect()}


@pytest.fixture
def tree(tmp_path):
    return plant(tmp_path / "tree", dirs=EMPTY_DIRS)


def test_listing_sees_everything(spark, tree):
    rows = list_files(spark, tree + "/").collect()
    assert {r.base_dir for r in rows} == {tree}
    assert {r.entry_name: r.file_size for r in rows if r.is_file} == {n: len(d) for n, d in TREE.items()}
    assert {r.entry_name for r in rows if not r.is_file} == {d + "/" for d in EMPTY_DIRS}
    every_dir = {r.entry_name for r in list_files(spark, "file://" + tree, dirs="all").collect() if not r.is_file}
    assert every_dir == {os.path.relpath(os.path.join(d, s), tree) for d, subs, _ in os.walk(tree) for s in subs}
    assert list_files(spark, tree, dirs="none").count() == len(TREE)
    shallow = {r.entry_name for r in list_files(spark, tree, max_depth=1).collect()}
    assert shallow == {"a", "a.b"}
    two_levels = {r.entry_name for r in list_files(spark, tree, max_depth=2, dirs="all").collect()}
    assert {"dir", "dir/one.txt", "dir/é", "dir2/deep", "void"} <= two_levels and "dir/é/ü.txt" not in two_levels


def test_listing_in_many_rounds(spark, tmp_path, monkeypatch):
    """Tasks hand directories back almost at once."""
    files = {f"d{i % 7}/e{i % 5}/f{i % 3}/x{i}": b"x" * i for i in range(300)}
    root = plant(tmp_path / "wide", files, ["void/deep"])
    monkeypatch.setattr("haulmark.sources.files._TASK_DIRS", 2)
    monkeypatch.setattr("haulmark.sources.files._TASK_ENTRIES", 5)
    rows = list_files(spark, root, dirs="all").collect()
    assert sorted((r.entry_name, r.file_size) for r in rows if r.is_file) == sorted((n, len(d)) for n, d in files.items())
    assert sum(not r.is_file for r in rows) == sum(len(subs) for _, subs, _ in os.walk(root))


def test_listing_a_single_file_and_nothing(spark, tree):
    [row] = list_files(spark, tree + "/dir/one.txt").collect()
    assert (row.base_dir, row.entry_name, row.is_file, row.file_size) == (tree + "/dir", "one.txt", True, 3)
    with pytest.raises(FileNotFoundError):
        list_files(spark, tree + "/nowhere")


def test_digests_of_files_and_parts(spark, tree):
    files = list_files(spark, tree, dirs="none").withColumn("path", F.concat("base_dir", F.lit("/"), "entry_name"))
    got = {os.path.relpath(r.path, tree): r.md5 for r in digest.file_md5(files).collect()}
    assert got == {n: b64(d) for n, d in TREE.items()}
    parts = digest.part_md5(digest.range_plan(files, 1024, 2048))
    big = TREE["dir2/deep/deeper/deepest/x"]
    found = {r.part_no: r.md5 for r in parts.filter("path like '%deepest/x'").collect()}
    assert found == {i: b64(big[i * 1024:(i + 1) * 1024]) for i in range(5)}


def test_digest_reports_what_it_cannot_read(spark, tmp_path, tree):
    rows = [(tree + "/a", 1), (tree + "/a", 7), (tree + "/gone", 3)]
    got = {(r.path, r.file_size): r for r in digest.file_md5(
        spark.createDataFrame(rows, "path string, file_size bigint")).collect()}
    assert got[(tree + "/a", 1)].md5 == b64(b"1") and got[(tree + "/a", 1)].attempts == 1
    short = got[(tree + "/a", 7)]
    assert short.md5 is None and short.bytes_read == 1 and short.attempts == digest.TRIES and "1 of 7" in short.error
    assert got[(tree + "/gone", 3)].md5 is None


def test_copy_then_compare(spark, tmp_path, tree):
    target = tmp_path / "copy"
    result = copy_tree(spark, tree, str(target), groups=3)
    assert harvest(target) == TREE
    assert all((target / d).is_dir() for d in EMPTY_DIRS)
    assert logs.failures(result).isEmpty()
    assert set(compare_trees(spark, tree, str(target)).select("status").distinct().collect()) == {("SAME",)}

    (target / "dir/one.txt").write_bytes(b"onf")
    checked = statuses(compare_trees(spark, tree, str(target), checksum=True, tasks=2))
    assert checked.pop("dir/one.txt") == "CHECKSUM_MISMATCH" and set(checked.values()) == {"SAME"}

    (target / "a").unlink()
    (target / "new").write_bytes(b"n")
    (target / "a.b").write_bytes(b"longer")
    gated = statuses(compare_trees(spark, tree, str(target), checksum=True))
    assert gated["dir/one.txt"] == "SAME"
    open_gate = statuses(compare_trees(spark, tree, str(target), checksum=True, gate=False))
    assert open_gate == gated | {"dir/one.txt": "CHECKSUM_MISMATCH"}
    assert (gated["a"], gated["new"], gated["a.b"]) == ("MISSING_AT_DEST", "MISSING_AT_SRC", "SIZE_MISMATCH")
    mirrored = statuses(compare_trees(spark, str(target), tree))
    swap = {"MISSING_AT_DEST": "MISSING_AT_SRC", "MISSING_AT_SRC": "MISSING_AT_DEST"}
    assert mirrored == {n: swap.get(s, s) for n, s in gated.items()}


def test_copy_in_ranges(spark, tmp_path):
    rng = random.Random(2)
    files = {f"f{i}": rng.randbytes(rng.randrange(1, 50_000)) for i in range(12)}
    tree, target = plant(tmp_path / "big", files), tmp_path / "copy"
    plan = make_pairs(list_files(spark, tree), str(target))
    result = copy_files(plan, CopyConf(ranged_from=10_000, chunk_bytes=4096))
    assert {r.status for r in result.collect()} == {"COPIED"}
    assert harvest(target) == files
    assert {os.path.basename(r.src_file): r.src_md5 for r in result.collect()} == {n: b64(d) for n, d in files.items()}


def test_copy_failures_are_rows(spark, tmp_path, tree):
    target = tmp_path / "copy"
    (target / "isdir").mkdir(parents=True)
    rows = [
        (f"{tree}/a", f"{target}/ok", True, 1, None), (f"{tree}/gone", f"{target}/gone", True, 1, None),
        (f"{tree}/a.b", f"{target}/grown", True, 1, None), (f"{tree}/a", f"{target}/isdir", True, 1, None),
        (f"{tree}/a", f"{target}/wrong", True, 1, b64(b"2")), (f"{tree}/a", "", True, 1, b64(b"1")),
    ]
    plan = spark.createDataFrame(
        rows, "src_file string, dest_file string, is_file boolean, file_size bigint, expected_md5 string")
    result = copy_files(plan)
    got = {os.path.basename(r.dest_file): r for r in result.collect()}
    assert {n: r.status for n, r in got.items()} == {
        "ok": "COPIED", "gone": "OPEN_FAILED", "grown": "SIZE_CHANGED", "isdir": "FAILED",
        "wrong": "CHECKSUM_MISMATCH", "": "READ",
    }
    assert harvest(target) == {"ok": b"1"}
    assert got["wrong"].attempts == digest.TRIES
    counters = transfer.copy_counters(result).first()
    assert (counters.copy, counters.skip, counters.fail) == (2, 0, 4)
    assert transfer.unfinished(plan, result).count() == 4
    with pytest.raises(RuntimeError, match="4 pairs"):
        transfer.raise_on_failure(result)
    lines = {r.value for r in logs.render_log(result).collect()}
    assert len(lines) == 4 and all(line.startswith("FAIL ") for line in lines)

    grown = copy_files(plan.filter("dest_file like '%grown'"), CopyConf(allow_size_change=True))
    assert [r.status for r in grown.collect()] == ["SIZE_CHANGED"]
    assert logs.failures(grown).isEmpty() and (target / "grown").read_bytes() == b"22"


def test_looking_at_results_does_not_copy_again(spark, tmp_path, tree):
    target = tmp_path / "copy"
    result = copy_files(make_pairs(list_files(spark, tree), str(target)))
    (target / "a").unlink()
    assert result.count() == len(TREE) + len(EMPTY_DIRS)
    assert not (target / "a").exists()


def test_speculation_is_refused(spark, tree, tmp_path, monkeypatch):
    plan = make_pairs(list_files(spark, tree), str(tmp_path / "x"))
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: "true")
    with pytest.raises(RuntimeError):
        copy_files(plan)


def test_sync(spark, tmp_path, tree):
    target = tmp_path / "target"
    plant(target, {"a": b"1", "a.b": b"xx", "dir/one.txt": b"other", "old/x": b"", "old/y/z": b"", "stray": b"s"})
    src = list_files(spark, tree)
    dst = list_files(spark, str(target), dirs="all")
    plan = plan_sync(src, dst, str(target), update=True, delete=True)
    todo = {r.src_file[len(tree) + 1:]: r.action for r in plan.todo.collect()}
    assert "a" not in todo and "a.b" not in todo and todo["dir/one.txt"] == "OVERWRITE"
    assert todo["dir2/hollow/inner/"] == "MKDIR" and todo["dir/_SUCCESS"] == "COPY"
    assert {r.entry_name for r in plan.delete.collect()} == {"old", "stray"}
    copy_files(assign_groups(plan.todo, 4))
    got = harvest(target)
    assert {n: got[n] for n in TREE} == TREE | {"a.b": b"xx"}

    limited = plan_sync(src, dst, str(target), update=True, max_files=2).todo.filter("is_file")
    assert sorted(r.src_file[len(tree) + 1:] for r in limited.collect()) == [
        ".archive/t1/r1/d/0f3a", "dir/.hidden"]
    for bad in ({"overwrite": True, "update": True}, {"delete": True}):
        with pytest.raises(ValueError):
            plan_sync(src, dst, str(target), **bad)


def test_sync_refuses_two_sources_of_one_target(spark, tmp_path):
    one, two = plant(tmp_path / "one", {"d/x": b"1"}), plant(tmp_path / "two", {"d/x": b"2"})
    both = [list_files(spark, one), list_files(spark, two)]
    src = union_sources(both, [one, two], root_at_source=True)
    with pytest.raises(ValueError, match="d/x"):
        plan_sync(src, list_files(spark, one), "/t")
    kept_apart = union_sources(both, [one, two])
    assert {r.entry_name for r in kept_apart.collect()} == {"one/d/x", "two/d/x"}
    plan_sync(kept_apart, list_files(spark, one), "/t")


def test_copy_actions(spark):
    schema = "base_dir string, entry_name string, is_file boolean, file_size bigint"
    src = spark.createDataFrame([("/s", "n", True, 1), ("/s", "same", True, 1), ("/s", "diff", True, 1),
                                 ("/s", "d", False, 0), ("/s", "clash", True, 1), ("/s", "filedir", False, 0)], schema)
    dst = spark.createDataFrame([("/d", "same", True, 1), ("/d", "diff", True, 2), ("/d", "clash", False, 0),
                                 ("/d", "filedir", True, 3)], schema)
    def actions(**mode):
        return {r.entry_name: r.action for r in copy_action(src, dst, **mode).collect()}
    assert actions() == {"n": "COPY", "same": "SKIP", "diff": "SKIP", "d": "MKDIR", "clash": "SKIP", "filedir": "FAIL"}
    assert actions(update=True) == {"n": "COPY", "same": "SKIP", "diff": "OVERWRITE", "d": "MKDIR", "clash": "FAIL",
                                    "filedir": "FAIL"}
    assert actions(overwrite=True) == actions(update=True) | {"same": "OVERWRITE"}


def test_manifest_copy(spark, tmp_path, tree):
    target = tmp_path / "copy"
    manifest = tmp_path / "manifest.txt"
    manifest.write_text(f"{tree}/a {target}/x 1\n{tree}/a.b {target}/y 2 \nbad line\n{tree}/a  {target}/z 1\n"
                        f"{tree}/a {target}/w 1x\n\n{tree}/a gs://b/k 1\n")
    result, rejects = copy_manifest(spark, str(manifest), groups=2)
    assert {os.path.basename(r.dest_file): r.status for r in result.collect()} == {
        "x": "COPIED", "y": "COPIED", "k": "FAILED"}
    assert harvest(target) == {"x": b"1", "y": b"22"}
    assert sorted(r.reason for r in rejects.collect()) == ["BAD_FIELD_COUNT"] * 3 + ["BAD_SIZE"]


def test_missing_sources_are_named_together(spark, tmp_path, tree):
    uris = tmp_path / "uris.txt"
    uris.write_text(f"{tree}/a\n{tree}/gone1\n{tree}/gone2\n{tree}/gone1\n")
    present = list_files(spark, tree).select(F.concat("base_dir", F.lit("/"), "entry_name").alias("uri"))
    with pytest.raises(FileNotFoundError, match="2 missing sources, listed in ") as caught:
        check_sources(read_uri_list(spark, str(uris)), present)
    assert {r.uri for r in caught.value.table.collect()} == {f"{tree}/gone1", f"{tree}/gone2"}
    many = spark.range(500).selectExpr("concat('/none/', id) AS uri")
    with pytest.raises(FileNotFoundError, match="500 missing") as caught:
        check_sources(many, present)
    assert caught.value.table.count() == 500
    check_sources(present, present)


def test_compare_single_files(spark, tree, tmp_path):
    (tmp_path / "none-in-it").write_bytes(b"")
    (tmp_path / "empty-too").write_bytes(b"")
    (tmp_path / "other").write_bytes(b"2")
    empty, missing = f"{tmp_path}/none-in-it", f"{tree}/none"
    expected = {
        (f"{tree}/a", f"{tree}/a"): "MATCH", (f"{tree}/a", f"{tree}/a.b"): "SIZE_MISMATCH", (f"{tree}/a", missing): "MISSING",
        (empty, f"{tree}/a"): "SIZE_MISMATCH", (empty, missing): "MISSING", (empty, f"{tmp_path}/empty-too"): "MATCH",
        (missing, empty): "MISSING_SOURCE", (f"{tree}/a", f"{tmp_path}/other"): "MISMATCH", (f"{tree}/a", None): "READABLE",
        (empty, None): "READABLE", (missing, None): "MISSING_SOURCE", (f"{tree}/a", "webhdfs://h/x"): "MISSING",
    }
    for (src, dst), status in expected.items():
        assert [r.status for r in compare_file(spark, src, dst).collect()] == [status], (src, dst)


def test_compare_by_ranges(spark, tmp_path):
    data = bytes(range(256)) * 40
    changed = data[:5000] + b"!" + data[5001:]
    for name, content in (("big", data), ("same", data), ("changed", changed)):
        (tmp_path / name).write_bytes(content)
    pairs = spark.createDataFrame([(f"{tmp_path}/big", f"{tmp_path}/{n}") for n in ("same", "changed")],
                                  "src_file string, dest_file string")
    found = {os.path.basename(r.dest_file): (r.parts, r.bad_parts, r.status) for r in
             compare_pairs(pairs, chunk_bytes=100).collect()}
    assert found == {"same": (103, 0, "MATCH"), "changed": (103, 1, "MISMATCH")}


def test_repeated_names_are_not_mixed(spark):
    schema = "entry_name string, is_file boolean, file_size bigint, md5 string"
    a, b, c = (b64(x) for x in (b"a", b"b", b"c"))
    src = spark.createDataFrame([("x", True, 1, a), ("x", True, 1, b), ("y", True, 1, a), ("y", True, 1, a)], schema)
    dst = spark.createDataFrame([("x", True, 1, c), ("y", True, 1, a)], schema)
    assert statuses(diff.content_diff(src, dst)) == {"x": "DUPLICATE_NAME", "y": "SAME"}
    sizes = spark.createDataFrame([("x", True, 1, a), ("x", True, 2, a)], schema)
    assert statuses(diff.dir_diff(sizes, dst)) == {"x": "DUPLICATE_NAME", "y": "MISSING_AT_SRC"}


def test_monitor_goes_on_where_it_ended(spark, tmp_path):
    def day(n: int) -> None:
        spark.range(0, 24 * 60).selectExpr(
            f"timestamp_seconds(1700000000 + {n} * 86400 + id * 60) AS ts", "1048576 AS bytes",
        ).write.mode("append").parquet(f"{tmp_path}/in")

    counts = []
    for n in range(3):
        day(n)
        stream = spark.readStream.schema("ts timestamp, bytes bigint").parquet(f"{tmp_path}/in")
        start_monitor(bandwidth_monitor(stream, 3_600_000, 0.01), f"{tmp_path}/out").awaitTermination()
        found = spark.read.parquet(f"{tmp_path}/out")
        counts.append(found.count())
        assert found.select("interval_start").distinct().count() == counts[-1]
    assert counts[0] > 20 and counts[1] - counts[0] == counts[2] - counts[1] == 24


def test_sync_reports_deleted_empty_files(spark, tmp_path):
    """Beside ``.extra`` files of some bytes, the target alone holds an empty one."""
    rows = [(1, "en", "web", "one"), (17, "en", "web", "new"), (19, "de", "web", ""), (38, "en", "books", "more")]
    spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    found = run_sync_query(spark, str(tmp_path)).collect()
    assert sorted((r.entry_name, r.file_size) for r in found if r.state == "DELETED") == [
        ("de/web/doc19.txt.extra", 0), ("en/books/doc38.txt.extra", 4)]
    assert sorted(r.file_size for r in found if r.state == "THERE") == [0, 3, 3, 4]


def test_sync_is_carried_out(spark, tmp_path, tree):
    target = tmp_path / "target"
    plant(target, {"a": b"9", "gone/x": b"1", "gone/deep/y": b"22", "a.b": b"22", "dir/old": b"o"}, ["gone/empty"])
    plan = plan_sync(list_files(spark, tree), list_files(spark, str(target)), str(target), overwrite=True, delete=True)
    assert {r.entry_name for r in plan.delete.collect()} == {"gone", "dir/old"}
    dry = run_sync(plan, str(target), groups=3)
    assert {r.status for r in dry.deleted.collect()} == {"WOULD_DELETE"} and (target / "gone" / "x").exists()
    done = run_sync(plan, str(target), groups=3, dry_run_deletes=False)
    assert {r.status for r in done.deleted.collect()} == {"DELETED"}
    assert harvest(target) == TREE and not (target / "gone").exists()
    with pytest.raises(ValueError, match="owner"):
        plan_sync(list_files(spark, tree).drop("owner"), list_files(spark, tree), str(target), attrs=frozenset({"USER"}))


def test_links_have_the_size_of_their_target(spark, tmp_path):
    (tmp_path / "t" / "d").mkdir(parents=True)
    (tmp_path / "t" / "data").write_bytes(b"x" * 24)
    (tmp_path / "t" / "d" / "link").symlink_to(tmp_path / "t" / "data")
    sizes = {r.entry_name: r.file_size for r in list_files(spark, f"{tmp_path}/t").filter("is_file").collect()}
    assert sizes == {"data": 24, "d/link": 24}
    copied = copy_tree(spark, f"{tmp_path}/t", f"{tmp_path}/u", groups=2)
    assert {r.status for r in copied.collect()} == {"COPIED"}


def test_unknown_file_systems_are_result_rows(spark, tmp_path):
    pairs = spark.createDataFrame([("webhdfs://h/x", f"{tmp_path}/x", True, 3)],
                                  "src_file string, dest_file string, is_file boolean, file_size bigint")
    assert [r.status for r in copy_files(pairs, CopyConf(tries=1)).collect()] == ["FAILED"]


def test_cleanup(spark, tmp_path):
    names = {"x.1412021673465": b"old!", "x.1712021673465": b"new", "x.1412021673465.tmp": b"t",
             "x.99999999999999999999": b"far", "sub/y.1000": b"old"}
    tree = tmp_path / "wals"
    plant(tree, names)
    bound = "2020-01-01-00-00-00-000"
    dry = cleanup_dir(spark, str(tree), bound)
    assert {(os.path.relpath(r.path, tree), r.status) for r in dry.collect()} == {
        ("x.1412021673465", "WOULD_DELETE"), ("sub/y.1000", "WOULD_DELETE")}
    assert harvest(tree) == names
    real = cleanup_dir(spark, str(tree), bound, dry_run=False)
    assert [r.status for r in real.collect()] == ["DELETED"] * 2
    assert set(harvest(tree)) == set(names) - {"x.1412021673465", "sub/y.1000"}
    with pytest.raises(ValueError):
        cleanup_dir(spark, str(tree), "2020-01-01")


def test_stored_plan(spark, tmp_path, tree):
    grouped = assign_groups(make_pairs(list_files(spark, tree), "/d"), 3)
    path = str(tmp_path / "plan")
    write_plan(grouped, path)
    assert {d for d in os.listdir(path) if not d.startswith(("_", "."))} == {f"filegroup-{i:03d}".join(
        ["file_group=", ""]) for i in range(3)}
    stored = read_plan(spark, path)
    assert sorted(map(tuple, stored.select(grouped.columns).collect())) == sorted(map(tuple, grouped.collect()))
    for group in range(3):
        rows = stored.filter(F.col("group_id") == group).sort("row_no").collect()
        assert [r.row_no for r in rows] == list(range(len(rows)))
        assert [r.file_size for r in rows] == sorted((r.file_size for r in rows), reverse=True)


def test_reassembly_in_any_order(spark):
    rng = random.Random(4)
    files = {f"f{i}": [rng.randbytes(rng.randrange(200)) for _ in range(rng.randrange(1, 30))] for i in range(20)}
    chunks = [(name, no, data) for name, parts in files.items() for no, data in enumerate(parts)]
    for _ in range(2):
        rng.shuffle(chunks)
        df = spark.createDataFrame(chunks, "f string, no int, data binary").repartition(5)
        got = {r.f: (r.parts, r.bytes, r.md5) for r in digest.reassemble(df, "f", "no", "data").collect()}
        assert got == {n: (len(p), len(b"".join(p)), b64(b"".join(p))) for n, p in files.items()}


def test_lost_part_is_noticed(spark):
    listing = spark.createDataFrame([("x", True, 10_000), ("y", True, 50), ("z", True, 9000)],
                                    "entry_name string, is_file boolean, file_size bigint")
    done = digest.range_plan(listing, 1000, 0)
    def complete(df):
        return {r.entry_name: r.complete for r in digest.range_coverage(listing, df).collect()}
    assert complete(done) == complete(done.unionByName(done)) == {"x": True, "y": True, "z": True}
    assert complete(done.filter("not (entry_name = 'x' and part_no = 9)")) == {"x": False, "y": True, "z": True}
    shifted = done.withColumn("end", F.expr("if(entry_name = 'z' and part_no = 3, `end` + 5, `end`)"))
    short = shifted.withColumn("end", F.expr("if(entry_name = 'z' and part_no = 4, `end` - 5, `end`)"))
    assert complete(short) == {"x": True, "y": True, "z": False}
    claims = spark.createDataFrame([("x", 0, 0, 99), ("x", 0, 9900, 9999)], done.select("entry_name", "part_no", "begin", "end").schema)
    assert complete(claims)["x"] is False


def test_verification_rules(spark):
    listing = spark.createDataFrame([(n, True, 4) for n in "abcdefgh"],
                                    "entry_name string, is_file boolean, file_size bigint")
    meta = spark.createDataFrame([
        ("a", 4, "m", {}), ("b", 4, "m", {"contentlength": "5"}), ("c", 0, None, {}), ("d", 4, None, {}),
        ("e", 4, "m", {"contentmd5": "u"}), ("f", 4, "m", {}), ("g", 4, "m", {}),
    ], "entry_name string, content_length bigint, content_md5 string, user_metadata map<string,string>")
    digests = spark.createDataFrame([(n, "m", 3 if n == "f" else 4) for n in "abcdef"],
                                    "entry_name string, md5 string, bytes_read bigint")
    assert statuses(diff.verify_objects(listing, meta, digests)) == {
        "a": "OK", "b": "LENGTH_CONFLICT", "c": "OK", "d": "NO_CHECKSUM", "e": "CHECKSUM_MISMATCH",
        "f": "SHORT_READ", "g": "UNREADABLE", "h": "NO_METADATA"}
    unchecked = statuses(diff.verify_objects(listing, meta, digests, verify=False))
    assert unchecked["d"] == unchecked["e"] == "OK" and unchecked["b"] == "LENGTH_CONFLICT"


def test_attributes_are_kept_with_a_read_only_directory(spark, tmp_path):
    """Links are left alone, unknown names fail as rows, and a directory is closed after what lies in it."""
    modes = {"a": 0o555, "a/b": 0o500, "a/b/f": 0o400, "a/g": 0o640, "top": 0o604, "same": 0o644}
    for side in ("src", "dst"):
        (tmp_path / side / "a" / "b").mkdir(parents=True)
        for name in ("a/b/f", "a/g", "top", "same", "extra" if side == "dst" else "lost"):
            (tmp_path / side / name).write_text(name)
            (tmp_path / side / name).chmod(0o644)
        (tmp_path / side / "link").symlink_to("top")
    for name in sorted(modes, reverse=True):
        (tmp_path / "src" / name).chmod(modes[name])
    src = list_files(spark, str(tmp_path / "src"), dirs="all", attributes=True)
    listed = {r.entry_name: r.permission for r in src.collect()}
    assert {k: v for k, v in listed.items() if k in modes} == {k: f"{v:04o}" for k, v in modes.items()}
    assert listed["link"] is None
    try:
        done = keep_attributes(src, str(tmp_path / "dst"), frozenset({"USER", "GROUP", "PERMISSION"}))
        rows = {r.path.removeprefix(f"{tmp_path}/dst/"): (r.depth, r.status) for r in done.collect()}
        assert rows == {n: (n.count("/") + 1, "CHANGED") for n in modes if n != "same"}
        assert {n: (tmp_path / "dst" / n).stat().st_mode & 0o7777 for n in modes} == modes
        assert (tmp_path / "dst" / "extra").stat().st_mode & 0o7777 == 0o644
        # Nothing is left to do, and nothing is done.
        assert keep_attributes(src, str(tmp_path / "dst"), frozenset({"PERMISSION"})).count() == 0
    finally:
        for side in ("src", "dst"):
            (tmp_path / side / "a").chmod(0o755)
            (tmp_path / side / "a" / "b").chmod(0o755)


def test_attribute_changes_that_fail_or_are_empty(spark, tmp_path):
    (tmp_path / "f").write_text("x")
    (tmp_path / "link").symlink_to("f")
    (tmp_path / "f").chmod(0o600)
    changes = spark.createDataFrame(
        [("f", None, None, None), (None, None, None, "0777"), ("gone", None, None, "0600"), ("link", None, None, "0777"),
         ("f", "no such user at all", None, None), ("f", None, None, "rwx")],
        "entry_name string, new_owner string, new_grp string, new_permission string",
    )
    rows = apply_attributes(changes, str(tmp_path)).collect()
    assert sorted((r.path.rpartition("/")[2], r.status, r.error.partition(":")[0]) for r in rows) == [
        ("f", "FAILED", "KeyError"), ("f", "FAILED", "ValueError"), ("gone", "FAILED", "FileNotFoundError"),
        ("link", "FAILED", "ValueError")]
    assert (tmp_path / "f").stat().st_mode & 0o7777 == 0o600
    assert apply_attributes(changes.limit(0), str(tmp_path)).collect() == []
