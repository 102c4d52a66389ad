import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from ferrywright import CopyFailedError, InvalidInputError, MigrationError, SyncOptions
from ferrywright.functions import paths
from ferrywright.operators import copyjob, reconcile, totals
from ferrywright.sources import config, listing, manifest, patterns, reports

OVERWRITE = SyncOptions(overwrite=True)
UPDATE = SyncOptions(update=True, append=True)


def write(path, data=b""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture
def tree(tmp_path):
    """Seven directories and two files of 1024 bytes."""
    root = tmp_path / "src"
    for d in ("1", "2/3/4", "5", "7/8"):
        (root / d).mkdir(parents=True)
    write(root / "5/6", os.urandom(1024))
    write(root / "7/8/9", os.urandom(1024))
    return root


def list_one(spark, root, **options):
    rows, _ = listing.list_tree(spark, [str(root)], **options)
    return rows


def status_of(spark, root):
    rows = list_one(spark, root, replace_content=True)
    return rows.join(copyjob.file_checksums(rows), "rel_path").withColumn("block_size", F.lit(1))


def plan_copy(spark, src_root, dst_root, options):
    src = status_of(spark, src_root)
    tgt = status_of(spark, dst_root) if dst_root.exists() else src.limit(0)
    plan = reconcile.reconcile(src, tgt, options, prefixes=copyjob.file_prefixes)
    return plan.withColumns(
        {"target_uri": paths.target_uri(F.lit(str(dst_root)), "rel_path"), "split_id": F.pmod(F.hash("rel_path"), F.lit(3))}
    )


def run(spark, src_root, dst_root, options):
    return copyjob.copy_files(plan_copy(spark, src_root, dst_root, options), options, pause=0.01)


def count(result):
    return totals.counters(result).first()


def test_list_tree(spark, tree):
    rows = list_one(spark, tree)
    got = {r.rel_path: (r.is_dir, r.length) for r in rows.collect()}
    dirs = ["", "/1", "/2", "/2/3", "/2/3/4", "/5", "/7", "/7/8"]
    assert got == {d: (True, 0) for d in dirs} | {"/5/6": (False, 1024), "/7/8/9": (False, 1024)}
    assert "" not in {r.rel_path for r in list_one(spark, tree, replace_content=True).collect()}
    first = rows.filter("rel_path = '/5/6'").first()
    stat = (tree / "5/6").stat()
    assert (first.perm, first.mtime, first.sticky) == (stat.st_mode & 0o777, stat.st_mtime_ns // 10**6, False)
    assert first.owner and first.group


def test_list_roots(spark, tree):
    one = list_one(spark, tree / "5/6")
    assert [r.rel_path for r in one.collect()] == [""]
    rows, _ = listing.list_tree(spark, [str(tree / "5"), str(tree / "7/8/9")])
    assert {r.rel_path for r in rows.collect()} == {"/5", "/5/6", "/9"}
    with pytest.raises(InvalidInputError, match="missing"):
        listing.list_tree(spark, [str(tree), str(tree / "missing")])
    with pytest.raises(InvalidInputError):
        listing.list_tree(spark, [])


def test_hidden_names_are_listed(spark, tmp_path):
    for name in ("_SUCCESS", ".hidden/x", "_tmp/y"):
        write(tmp_path / "t" / name)
    names = {r.rel_path for r in list_one(spark, tmp_path / "t", replace_content=True).collect()}
    assert names == {"/_SUCCESS", "/.hidden", "/.hidden/x", "/_tmp", "/_tmp/y"}
    fast = listing.list_files_fast(spark, str(tmp_path / "t"))
    assert fast.columns == ["path", "uri_path", "is_dir", "length", "mtime"] and fast.count() == 0


def test_unreadable_directories_are_reported(spark, tree, monkeypatch):
    rows = listing._lister(False, 0.0)
    calls = []

    def broken(root, path, only_self):
        calls.append(path)
        raise PermissionError("denied")

    monkeypatch.setattr(listing, "_entries", broken)
    import pandas as pd

    out = pd.concat(rows([pd.DataFrame({"root": ["/s"], "path": ["/s"]})]))
    assert len(calls) == listing.MAX_RETRIES + 1
    assert out[["path", "error"]].values.tolist() == [["/s", "denied"]]


def test_a_repeated_attempt_gives_nothing_twice(spark, monkeypatch):
    """Nothing of a failed attempt stays, however many entries it gave before."""
    import pandas as pd

    calls = []

    def entries(root, path, only_self):
        calls.append(path)
        for i in range(200_000):
            if len(calls) == 1 and i == 150_000 or path == "/bad" and i == 3:
                raise OSError("mid-way")
            yield (root, f"{path}/{i}", False, i, *[None] * 7)

    monkeypatch.setattr(listing, "_entries", entries)
    out = pd.concat(listing._lister(False, 0.0)([pd.DataFrame({"root": ["/s", "/s"], "path": ["/good", "/bad"]})]))
    assert len(out) == 350_000 + 1 + (listing.MAX_RETRIES + 1) * (3 + 1) + 1 and len(calls) == 2 + listing.MAX_RETRIES + 1
    frame = spark.createDataFrame(out[["path", "error", "reading", "void"]].astype(object).where(lambda x: x.notna(), None), "path string, error string, reading string, void boolean")
    stored, seen = listing._settled(frame, "t", rows=F.count(F.lit(1)))
    assert stored.columns == ["path", "error"] and seen["rows"] == 200_001 == stored.distinct().count()
    assert [tuple(r) for r in stored.filter("error is not null").collect()] == [("/bad", "mid-way")]


def test_unreadable_matches_raise(spark, tree, monkeypatch):
    settled = listing._settled

    def denied(df, name, **metrics):
        table, seen = settled(df, name, **metrics)
        if name == "sources":
            table = table.withColumn("error", F.when(F.col("path").endswith("/5"), "denied").otherwise(F.col("error")))
        return table, seen

    monkeypatch.setattr(listing, "_settled", denied)
    assert listing.expand_sources(spark, [f"{tree}/7/*"]).count() == 1
    with pytest.raises(MigrationError, match="denied"):
        listing.expand_sources(spark, [f"{tree}/*"])


def test_one_file_system_for_spark_and_tasks():
    from types import SimpleNamespace

    from ferrywright import files, scratch

    assert files.qualified("/a", "file:///") == "/a" and files.qualified("file:/a", "hdfs://nn") == "file:/a"
    assert files.qualified("/a", "hdfs://nn/") == "hdfs://nn/a" and files.qualified("s3a://b/a", "hdfs://nn") == "s3a://b/a"
    home = SimpleNamespace(hadoopConfiguration=lambda: {"fs.defaultFS": "hdfs://nn:1"})
    context = SimpleNamespace(applicationId="app", master="yarn", _jsc=home)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: "/scratch"), sparkContext=context)
    assert scratch.scratch_dir(fake) == "hdfs://nn:1/scratch/ferrywright-app"


def test_links_to_nothing_hide_no_files(spark, tree):
    os.symlink(tree / "none", tree / "5" / "0-dangling")
    names = {r.rel_path for r in list_one(spark, tree / "5", replace_content=True).collect()}
    assert names == {"/6"}


def test_strict_listing_raises(spark, tree, monkeypatch):
    """A directory that is a file by the time it is listed cannot be read."""
    original = listing._list

    def swapped(frame, n_paths, only_self, tasks, pause):
        if not only_self and (tree / "1").is_dir():
            (tree / "1").rmdir()
            os.symlink(tree / "1", tree / "1")
        return original(frame, n_paths, only_self, tasks, 0.0)

    monkeypatch.setattr(listing, "_list", swapped)
    with pytest.raises(MigrationError):
        list_one(spark, tree)
    rows, errors = listing.list_tree(spark, [str(tree)], strict=False)
    assert [os.path.basename(r.path) for r in errors.collect()] == ["src"]


def test_list_and_filter_files(spark, tmp_path):
    write(tmp_path / "list", b"/a/b\r\n/c*\n")
    assert [r.path for r in patterns.read_list_file(spark, str(tmp_path / "list")).collect()] == ["/a/b", "/c*"]
    assert patterns.read_filters(spark, str(tmp_path / "list")) == ["/a/b", "/c*"]
    write(tmp_path / "long", b"".join(b"/x%d\n" % i for i in range(10_001)))
    assert patterns.read_filters(spark, str(tmp_path / "long")) == [f"/x{i}" for i in range(10_001)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        patterns.read_filters(spark, str(tmp_path / "none"))


@pytest.mark.parametrize(
    "glob,found",
    [
        ("*", {"1", "2", "5", "7"}),
        ("?/[68]", {"5/6", "7/8"}),
        ("{5/6,7/*/9,none}", {"5/6", "7/8/9"}),
        ("2/3/4", {"2/3/4"}),
        ("*/3/4", {"2/3/4"}),
        ("5/*/*", set()),
        ("9", set()),
    ],
)
def test_expand_sources(spark, tree, glob, found):
    if not found:
        with pytest.raises(InvalidInputError, match="doesn't exist"):
            listing.expand_sources(spark, [f"{tree}/*", f"{tree}/{glob}"])
        return
    rows = listing.expand_sources(spark, [f"{tree}/{glob}"]).collect()
    assert {os.path.relpath(r.path, tree) for r in rows} == found and len(rows) == len(found)


def test_nothing_to_expand(spark):
    with pytest.raises(InvalidInputError):
        listing.expand_sources(spark, [])
    assert patterns.expand_braces(r"/{a,b{c,d}}/\{x") == ["/a/\\{x", "/bc/\\{x", "/bd/\\{x"]
    assert patterns.split_fixed("hdfs://nn:1/a/b*/c") == ("hdfs://nn:1/a", ["b*", "c"])


def test_boxes(spark, tmp_path):
    boxes = [
        {"boxDns": "one.example", "accountKey": "k", "sizeInBytes": 10, "container": ""},
        {"boxDns": "two.example", "accountKey": "k", "sizeInBytes": -1, "container": "own"},
        {"boxDns": "file:/three"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"container": "c", "boxes": boxes}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(boxes))
    got = [tuple(r) for r in config.read_boxes(spark, str(tmp_path / "a.json")).orderBy("box_id").collect()]
    assert got == [
        (0, "one.example", "c", 10, "wasb://c@one.example/"),
        (1, "two.example", "own", None, "wasb://own@two.example/"),
        (2, "file:/three", "c", None, "file:/three"),
    ]
    bare = config.read_boxes(spark, str(tmp_path / "b.json")).orderBy("box_id").collect()
    assert [r.container for r in bare] == [None, "own", None]
    assert config.single_box(spark, "file:/x").first().target_uri == "file:/x"
    for bad in ('{"container": "c", "boxes": [{"boxDns": "a"},, {"boxDns": "b"}]}', '[{"boxDns": "a"}', '{"container": "c"}', "[]", ""):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(InvalidInputError):
            config.read_boxes(spark, str(tmp_path / "bad.json")).collect()


def test_identity_files(spark, tmp_path):
    ids = spark.createDataFrame([("u1", "c1"), ("u2", None)], "local_identity string, cloud_identity string")
    config.write_identities(ids, str(tmp_path / "ids"))
    text = "".join(p.read_text() for p in (tmp_path / "ids").glob("*.json"))
    assert '"cloudIdentity":null' in text
    assert {tuple(r) for r in config.read_identities(spark, str(tmp_path / "ids")).collect()} == {("u1", "c1"), ("u2", None)}
    rows = [{"localIdentity": "a", "cloudIdentity": "b"}, {"localIdentity": "c"}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=2))
    read = config.read_identities(spark, str(tmp_path / "array.json"))
    assert {tuple(r) for r in read.collect()} == {("a", "b"), ("c", None)}
    (tmp_path / "twice.json").write_text(json.dumps([*rows, rows[0]]))
    with pytest.raises(InvalidInputError, match="Duplicate identity a"):
        config.read_identities(spark, str(tmp_path / "twice.json"))


def test_manifest_round_trip(spark, tmp_path):
    row = ("/d/f", 4344, 2, 512 << 20, 1234, 5678, 0o512, "dingo", "yaks", b"v")
    frame = spark.createDataFrame(
        [row], "path string, length bigint, replication int, block_size bigint, mtime bigint, atime bigint, perm int,"
        "owner string, `group` string, x binary",
    ).withColumn("xattrs", F.create_map(F.lit("user.a"), "x", F.lit("user.b"), F.lit(None).cast("binary")))
    from ferrywright.schema import as_manifest

    manifest.write_manifest(as_manifest(frame), str(tmp_path / "m"))
    manifest.write_manifest(as_manifest(frame), str(tmp_path / "m"))
    stored = manifest.read_manifest(spark, str(tmp_path / "m")).collect()
    assert len(stored) == 1
    got = stored[0]
    assert (got.path, got.length, got.replication, got.block_size, got.mtime, got.atime, got.perm) == row[:7]
    assert (got.owner, got.group, got.xattrs) == ("dingo", "yaks", {"user.a": bytearray(b"v"), "user.b": None})


def test_copy_and_rerun(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    first = run(spark, tree, dst, UPDATE)
    done = count(first)
    assert (done.copy, done.dir_copy, done.bytes_copied, done.fail) == (2, 7, 2048, 0)
    assert (dst / "7/8/9").read_bytes() == (tree / "7/8/9").read_bytes()
    assert not [p for p in dst.rglob("*") if "_copying_" in p.name]
    sums = {r.rel_path: r.checksum for r in first.filter("not isnull(checksum)").collect()}
    assert sums["/5/6"] == hashlib.md5((tree / "5/6").read_bytes()).hexdigest()
    again = count(run(spark, tree, dst, UPDATE))
    assert (again.copy, again.skip, again.bytes_skipped) == (0, 2, 2048)


def test_append(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    run(spark, tree, dst, UPDATE)
    for name in ("5/6", "7/8/9"):
        with open(tree / name, "ab") as f:
            f.write(os.urandom(2048))
    plan = plan_copy(spark, tree, dst, UPDATE).cache()
    assert {r.action for r in plan.filter("not is_dir").collect()} == {"APPEND"}
    done = count(copyjob.copy_files(plan, UPDATE))
    assert (done.copy, done.bytes_copied, done.bytes_expected) == (2, 4096, 2 * 3072)
    assert (dst / "5/6").read_bytes() == (tree / "5/6").read_bytes()
    # A repeated attempt finds the target complete and adds nothing.
    done = count(copyjob.copy_files(plan, UPDATE))
    assert done.bytes_copied == 4096 and (dst / "5/6").stat().st_size == 3072


def test_append_to_damaged_target_fails(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    run(spark, tree, dst, UPDATE)
    with open(tree / "5/6", "ab") as f:
        f.write(b"more")
    plan = plan_copy(spark, tree, dst, UPDATE).cache()
    plan.count()
    (dst / "5/6").write_bytes(os.urandom(1024))
    bad = copyjob.failures(copyjob.copy_files(plan, UPDATE, pause=0.0)).first()
    assert (bad.rel_path, bad.error_class, bad.attempts) == ("/5/6", "write", 3)


def test_conflicts_and_failure_policy(spark, tree, tmp_path):
    dst = tmp_path / "dst"
    write(dst / "5", b"a file where a directory should be")
    write(dst / "7/8/9/x", b"a directory where a file should be")
    result = run(spark, tree, dst, SyncOptions(update=True))
    bad = {r.rel_path: r.error_class for r in copyjob.failures(result).collect()}
    assert bad["/5"] == "conflict" and bad["/7/8/9"] == "conflict"
    with pytest.raises(CopyFailedError):
        copyjob.enforce_failures(result, SyncOptions(ignore_failures=True))
    copyjob.enforce_failures(result, SyncOptions(ignore_failures=True), all_io=True)


def test_vanished_source_is_a_read_failure(spark, tree, tmp_path):
    plan = plan_copy(spark, tree, tmp_path / "dst", OVERWRITE).cache()
    plan.count()
    (tree / "5/6").unlink()
    result = copyjob.copy_files(plan, OVERWRITE, pause=0.0)
    bad = copyjob.failures(result).collect()
    assert [(r.rel_path, r.error_class, r.attempts) for r in bad] == [("/5/6", "read", copyjob.ATTEMPTS)]
    copyjob.enforce_failures(result, SyncOptions(ignore_failures=True))
    with pytest.raises(CopyFailedError):
        copyjob.enforce_failures(result, SyncOptions())
    placed = spark.createDataFrame([("/a", None), ("/b", 1)], "path string, box_id int")
    lines = sorted(r.line for r in reports.skipped_report(placed, copyjob.failures(result)).collect())
    assert lines[0].startswith("/a - cannot locate") and "5/6 - " in lines[1] and len(lines) == 2


def test_action_log(spark, tmp_path):
    rows = [
        ("/s", "/src/s", "t:/s", "SKIP", "OK", 3, 4, None),
        ("/c", "/src/c", "t:/c", "OVERWRITE", "OK", 3, None, None),
        ("/f", "/src/f", "t:/f", "OVERWRITE", "FAIL", 3, None, "broken"),
        ("/d", "/src/d", "t:/d", "MKDIR", "OK", 0, None, None),
    ]
    frame = spark.createDataFrame(
        rows, "rel_path string, path string, target_uri string, action string, status string, length bigint, tgt_length bigint, error string"
    )
    plain = {r.line for r in reports.action_log(frame).collect()}
    assert plain == {"SKIP: /src/s", "FAIL: /src/f - broken"}
    verbose = {r.line for r in reports.action_log(frame, verbose=True).collect()} - plain
    assert verbose == {
        "FILE_SKIPPED: source=/src/s, size=3 --> target=t:/s, size=4",
        "FILE_COPIED: source=/src/c, size=3 --> target=t:/c, size=0",
    }
    reports.write_action_log(frame, str(tmp_path / "log"), verbose=True)
    assert {p.name for p in (tmp_path / "log").iterdir() if p.is_dir()} == {"action=SKIP", "action=OVERWRITE"}
    reports.write_lines(reports.action_log(frame), str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 2


def test_chunks_add_up(spark, tree, tmp_path):
    files = spark.createDataFrame([(str(tree / "5/6"), str(tmp_path / "out/6"), 1024)], "path string, target_uri string, length bigint")
    parts = copyjob.copy_chunks(files, 300, SyncOptions(), 4).orderBy("chunk_offset").collect()
    assert [r.bytes_copied for r in parts] == [300, 300, 300, 124]
    joined = b"".join(open(r.part_uri, "rb").read() for r in parts)
    assert joined == (tree / "5/6").read_bytes()


class Clock:
    def __init__(self):
        self.now = 0.0

    def monotonic(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


def test_bandwidth_limit(monkeypatch):
    import io

    clock = Clock()
    monkeypatch.setattr(copyjob, "time", clock)
    options = SyncOptions(bandwidth_mb=1, buffer_bytes=1 << 20)
    copied = copyjob._transfer(io.BytesIO(bytes(5 << 20)), io.BytesIO(), None, options, hashlib.md5())
    assert copied == 5 << 20 and 3.5 < clock.now < 5.5
    monkeypatch.setattr(copyjob, "time", Clock())
    assert copyjob._transfer(io.BytesIO(b"abcdef"), io.BytesIO(), 4, SyncOptions(), hashlib.md5()) == 4


def test_retry_recovers(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    attempts = []

    def flaky(row, options):
        attempts.append(1)
        if len(attempts) < 3:
            raise copyjob.ReadError("not yet")
        return 5, "sum"

    monkeypatch.setattr(copyjob, "_overwrite", flaky)
    row = SimpleNamespace(rel_path="/a", path="/a", target_uri="/b", action="OVERWRITE", length=5, tgt_length=None, split_id=0)
    out = copyjob._carry_out(row, OVERWRITE, 0.0)
    assert (out["status"], out["attempts"], out["bytes_copied"]) == ("OK", 3, 5)
