import pytest
from pyspark.sql import functions as F

from ferrywright.errors import InvalidInputError
from ferrywright import SyncOptions
from ferrywright.operators import identity, metadata, reconcile, totals
from ferrywright.plans import derived

STATUS = "rel_path string, is_dir boolean, length bigint, block_size bigint, checksum string"
ACL = "array<struct<scope:string,type:string,name:string,perm:string>>"


def status(spark, rows):
    return spark.createDataFrame(rows, STATUS)


def actions(spark, options, src, tgt, prefixes=None):
    known = spark.createDataFrame(prefixes or [], "rel_path string, prefix_checksum string")
    given = (lambda rows: known) if prefixes else None
    rows = reconcile.reconcile(status(spark, src), status(spark, tgt), options, prefixes=given)
    return {r.rel_path: r.action for r in rows.collect()}


SRC = [
    ("new", False, 5, 1, "n"),
    ("same", False, 5, 1, "s"),
    ("grown", False, 9, 1, "g"),
    ("grown_other", False, 9, 1, "g"),
    ("shrunk", False, 3, 1, "h"),
    ("changed", False, 5, 1, "c"),
    ("unknown", False, 5, 1, None),
    ("blocks", False, 5, 2, "b"),
    ("dir", True, 0, 0, None),
    ("dir_file", True, 0, 0, None),
    ("file_dir", False, 5, 1, "x"),
]
TGT = [
    ("same", False, 5, 1, "s"),
    ("grown", False, 4, 1, "pre"),
    ("grown_other", False, 4, 1, "pre"),
    ("shrunk", False, 5, 1, "h"),
    ("changed", False, 5, 1, "C"),
    ("unknown", False, 5, 1, "u"),
    ("blocks", False, 5, 1, "b"),
    ("dir", True, 0, 0, None),
    ("dir_file", False, 1, 1, None),
    ("file_dir", True, 0, 0, None),
    ("extra", False, 1, 1, None),
]


def test_actions(spark):
    fixed = {"dir": "MKDIR", "dir_file": "CONFLICT", "file_dir": "CONFLICT", "new": "OVERWRITE"}
    files = [r[0] for r in SRC if r[0] not in fixed]
    assert actions(spark, SyncOptions(), SRC, TGT) == fixed | dict.fromkeys(files, "SKIP")
    assert actions(spark, SyncOptions(overwrite=True), SRC, TGT) == fixed | dict.fromkeys(files, "OVERWRITE")
    update = fixed | dict.fromkeys(files, "OVERWRITE") | dict.fromkeys(("same", "unknown", "blocks"), "SKIP")
    assert actions(spark, SyncOptions(update=True), SRC, TGT) == update
    assert actions(spark, SyncOptions(update=True, strict_checksums=True), SRC, TGT) == update | {"unknown": "OVERWRITE"}
    assert actions(spark, SyncOptions(update=True, skip_crc=True), SRC, TGT) == update | {"changed": "SKIP"}
    assert actions(spark, SyncOptions(update=True, preserve="b"), SRC, TGT) == update | {"blocks": "OVERWRITE"}
    prefixes = [("grown", "pre"), ("grown_other", "other"), ("shrunk", "h")]
    append = SyncOptions(update=True, append=True)
    assert actions(spark, append, SRC, TGT, prefixes) == update | {"grown": "APPEND"}


def test_append_candidates_read_little(spark):
    found = reconcile.append_candidates(status(spark, SRC), status(spark, TGT), SyncOptions(update=True, append=True))
    assert {r.rel_path for r in found.collect()} == {"grown", "grown_other"}
    text = spark.createDataFrame([("grown", "abcdefghi"), ("same", "x")], "rel_path string, content string")
    row = reconcile.prefix_checksums(found, text).collect()
    import hashlib

    assert [tuple(r) for r in row] == [("grown", hashlib.md5(b"abcd").hexdigest())]


def test_reference_counts_of_sync_run(spark):
    from ferrywright.plans.queries import planned_sync

    rows = planned_sync(spark, "/root/testdata/sf0.01").groupBy("action").agg(F.count("*"), F.sum("length")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {
        "APPEND": (92, 250_602),
        "CONFLICT": (9, 16_568),
        "OVERWRITE": (274, 625_564),
        "SKIP": (625, 1_517_136),
    }


def test_counters(spark):
    rows = [
        ("OVERWRITE", "OK", 10, 10),
        ("APPEND", "OK", 10, 4),
        ("SKIP", "OK", 7, 0),
        ("MKDIR", "OK", 0, 0),
        ("OVERWRITE", "FAIL", 3, 0),
    ]
    frame = spark.createDataFrame(rows, "action string, status string, length bigint, bytes_copied bigint")
    assert totals.counters(frame).first().asDict() == {
        "copy": 2,
        "dir_copy": 1,
        "skip": 1,
        "fail": 1,
        "bytes_copied": 14,
        "bytes_expected": 20,
        "bytes_failed": 3,
        "bytes_skipped": 7,
    }


def test_verify(spark):
    src = status(spark, [*SRC, ("empty", False, 0, 1, "a")])
    tgt = status(spark, [*TGT, ("empty", False, 0, 1, "b")])
    got = {r.rel_path: r.verdict for r in reconcile.verify(src, tgt).collect()}
    assert got == {
        "new": "MISSING",
        "same": "OK",
        "grown": "LENGTH",
        "grown_other": "LENGTH",
        "shrunk": "LENGTH",
        "changed": "CHECKSUM",
        "unknown": "OK",
        "blocks": "OK",
        "file_dir": "TYPE",
        "empty": "OK",
    }
    strict = {r.rel_path: r.verdict for r in reconcile.verify(src, tgt, strict=True).collect()}
    assert strict == got | {"unknown": "CHECKSUM"}
    loose = {r.rel_path: r.verdict for r in reconcile.verify(src, tgt, skip_crc=True).collect()}
    assert loose == got | {"changed": "OK"}
    parts = src.filter("rel_path = 'grown'").selectExpr("*", "4L as chunk_length", "0L as chunk_offset")
    assert reconcile.verify(parts, tgt).first().verdict == "OK"


def test_delete_missing(spark):
    src = status(spark, [(n, False, 1, 1, None) for n in "1345789"])
    tgt = status(spark, [(n, False, 1, 1, None) for n in "24579A"])
    extra = reconcile.extraneous_targets(src, tgt)
    assert {r.rel_path for r in extra.collect()} == {"2", "A"}
    sides = {(r.rel_path, r.only_in) for r in reconcile.in_sync(src, tgt).collect()}
    assert sides == {(n, "left") for n in "138"} | {(n, "right") for n in "2A"}
    assert reconcile.in_sync(src, src.unionByName(src)).isEmpty()


def test_snapshot_diff(spark):
    schema = "file_id bigint, rel_path string, is_dir boolean, length bigint, mtime bigint"
    old = [
        (1, "/foo", True, 0, 1), (2, "/foo/d1", True, 0, 1), (3, "/foo/d1/f3", False, 1, 1), (4, "/foo/f1", False, 1, 1),
        (5, "/bar", True, 0, 1), (6, "/bar/d2", True, 0, 1), (7, "/bar/d2/f4", False, 1, 1), (8, "/bar/f2", False, 1, 1),
    ]
    new = [
        (1, "/foo", True, 0, 9), (6, "/foo/d2", True, 0, 1), (7, "/foo/d2/f4", False, 1, 1),
        (5, "/bar", True, 0, 9), (2, "/bar/d1", True, 0, 1), (8, "/bar/f2", False, 2, 9), (9, "/bar/f1", False, 2, 9),
    ]
    old, new = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    diff = reconcile.snapshot_diff(old, new, file_id="file_id")
    got = {(r.change, r.source, r.target) for r in diff.collect()}
    assert got == {
        ("RENAME", "/foo/d1", "/bar/d1"),
        ("RENAME", "/bar/d2", "/foo/d2"),
        ("RENAME", "/bar/d2/f4", "/foo/d2/f4"),
        ("DELETE", "/foo/d1/f3", None),
        ("DELETE", "/foo/f1", None),
        ("MODIFY", None, "/bar/f2"),
        ("CREATE", None, "/bar/f1"),
    }
    assert {r.rel_path for r in reconcile.copy_list(diff).collect()} == {"/bar/f1", "/bar/f2"}
    order = [r.source for r in reconcile.replay_order(diff).collect()]
    assert order == sorted(order, reverse=True)
    by_path = {r.change for r in reconcile.snapshot_diff(old, new).collect()}
    assert by_path == {"CREATE", "DELETE", "MODIFY"}


def people(spark, rows):
    schema = f"rel_path string, is_dir boolean, owner string, `group` string, perm int, sticky boolean, acl {ACL}"
    return spark.createDataFrame(rows, schema)


IDENTITIES = [("u0", "cloud-u0"), ("u3", None), ("p1", "cloud-p1")]


def test_translate_identities(spark):
    ids = spark.createDataFrame(IDENTITIES, "local_identity string, cloud_identity string")
    acl = [("ACCESS", "USER", "p1", "r--"), ("ACCESS", "GROUP", None, "rwx"), ("DEFAULT", "USER", "p2", "---")]
    rows = [
        ("a", False, "u0", "u3", 0o644, False, acl),
        ("b", False, "u5", "p1", 0o644, False, acl),
        ("c", False, None, "", 0o644, False, None),
        ("d", False, "u3", "g", 0o644, False, []),
    ]
    out = {r.rel_path: r for r in identity.translate_identities(people(spark, rows), ids).collect()}
    assert (out["a"].owner, out["a"].group) == ("cloud-u0", "u3")
    assert (out["b"].owner, out["b"].group) == ("u5", "cloud-p1")
    assert (out["c"].owner, out["c"].group, out["c"].acl) == (None, "", None)
    assert out["d"].acl == []
    assert [(e.scope, e.type, e.name, e.perm) for e in out["a"].acl] == [("ACCESS", "USER", "cloud-p1", "r--"), *acl[1:]]
    assert out["a"].acl == out["b"].acl
    found = identity.collect_identities(people(spark, rows))
    assert {r[0] for r in found.collect()} == {"u0", "u3", "u5", "p1", "p2", "", "g", None}
    merged = {r[0]: r[1] for r in identity.merge_identities(found.na.drop(), ids).collect()}
    assert merged["u0"] == "cloud-u0" and merged["p2"] is None
    assert {r[0] for r in identity.unmapped_identities(found.na.drop(), ids).collect()} == {"u3", "u5", "p2", "", "g"}


def test_one_translation_at_any_size(spark, monkeypatch):
    """A shuffled map gives what a broadcast one gives; repeated identities raise and blank names stay."""
    src = derived.source_with_acl(spark, "/root/testdata/sf0.001").select("rel_path", "owner", "group", "acl")
    ids = derived.identity_map(spark, "/root/testdata/sf0.001")
    blank = ids.union(spark.createDataFrame([("", "blank"), (" ", "blank")], ids.schema))
    few = sorted(map(str, identity.translate_identities(src, ids).collect()))
    assert few == sorted(map(str, identity.translate_identities(src, blank).collect()))
    monkeypatch.setattr(identity, "lookup_table", lambda df, name: df)
    assert few == sorted(map(str, identity.translate_identities(src, ids).collect()))
    with pytest.raises(InvalidInputError):
        identity.translate_identities(src, ids.union(spark.createDataFrame([("u1", "x"), ("u1", "y")], ids.schema)))


def test_acl_in_another_order_is_not_set_again(spark):
    ids = spark.createDataFrame([("a", "z"), ("b", "y"), ("c", "y")], "local_identity string, cloud_identity string")
    schema = f"rel_path string, is_dir boolean, owner string, `group` string, perm int, sticky boolean, acl {ACL}"
    own = [("ACCESS", "USER", n, "r--") for n in "abc"]
    there = [("ACCESS", "USER", n, "r--") for n in "yz"]
    row = ("f", False, "u", "g", 0o640, False)
    got = identity.acl_transfer_plan(spark.createDataFrame([(*row, own)], schema), spark.createDataFrame([(*row, there)], schema), ids)
    assert got.first().setters == []


def test_acl_transfer_plan(spark):
    ids = spark.createDataFrame(IDENTITIES, "local_identity string, cloud_identity string")
    acl = [("ACCESS", "USER", "p1", "r--")]
    done = [("ACCESS", "USER", "cloud-p1", "r--")]
    src = [(n, n == "d", "u0", "g", 0o644, n == "sticky", acl) for n in ("done", "acl", "sticky", "gone", "d")]
    tgt = [
        ("done", False, "cloud-u0", "g", 0o644, False, done),
        ("acl", False, "u0", "g", 0o644, False, None),
        ("sticky", False, "cloud-u0", "g", 0o644, False, done),
        ("d", False, "cloud-u0", "g", 0o644, False, done),
    ]
    rows = identity.acl_transfer_plan(people(spark, src), people(spark, tgt), ids).collect()
    assert {r.rel_path: (r.status, r.setters) for r in rows} == {
        "done": ("OK", []),
        "acl": ("OK", ["acl", "owner"]),
        "sticky": ("OK", ["permission"]),
        "gone": ("MISSING", []),
        "d": ("CONFLICT", []),
    }


def test_preserve_plan(spark):
    schema = (
        f"rel_path string, is_dir boolean, owner string, `group` string, perm int, sticky boolean, replication int, acl {ACL},"
        "xattrs map<string,binary>"
    )
    acl = [("ACCESS", "USER", "p1", "r--")]
    src = [
        ("same", False, "u", "g", 0o644, False, 3, acl, {"user.a": b"1", "raw.b": b"2"}),
        ("all", False, "u", "g", 0o644, True, 3, acl, {"user.a": b"1", "raw.b": b"2"}),
        ("dir", True, "u", "g", 0o644, False, 3, None, None),
        ("gone", False, "u", "g", 0o644, False, 3, None, None),
    ]
    tgt = [
        ("same", False, "u", "g", 0o644, False, 3, acl, {"raw.b": b"2", "user.a": b"1"}),
        ("all", False, "v", "g", 0o600, False, 1, None, {"user.a": None}),
        ("dir", True, "u", "h", 0o644, False, 1, [], {"user.z": b""}),
    ]
    src, tgt = spark.createDataFrame(src, schema), spark.createDataFrame(tgt, schema)

    def plan(letters, **options):
        rows = metadata.preserve_plan(src, tgt, SyncOptions(preserve=letters).preserve, **options).collect()
        return {r.rel_path: r.setters for r in rows}

    assert plan("rbugpct") == {
        "same": ["times"],
        "all": ["permission", "replication", "owner", "times"],
        "dir": ["owner", "times"],
    }
    assert plan("a") == {"same": [], "all": ["acl", "permission"], "dir": []}
    assert plan("x") == {"same": [], "all": ["xattr"], "dir": []}
    assert plan("u") == {"same": [], "all": ["owner"], "dir": []}
    assert plan("", raw_xattrs=True) == {"same": [], "all": ["xattr"], "dir": []}
    assert plan("") == {"same": [], "all": [], "dir": []}


def test_xattrs_of_other_namespaces_do_not_count(spark):
    schema = "rel_path string, is_dir boolean, xattrs map<string,binary>"
    src = [("user", False, {"raw.a": b"1", "user.b": b"2"}), ("raw", False, {"raw.a": b"1", "user.b": b"2"})]
    tgt = [("user", False, {"raw.a": b"1", "user.b": b"3"}), ("raw", False, {"user.b": b"2"})]
    src, tgt = spark.createDataFrame(src, schema), spark.createDataFrame(tgt, schema)
    for attributes, raw, want in (((), True, ["raw"]), (("xattr",), False, ["user"]), (("xattr",), True, ["raw", "user"])):
        rows = metadata.preserve_plan(src, tgt, attributes, raw_xattrs=raw).collect()
        assert sorted(r.rel_path for r in rows if r.setters == ["xattr"]) == want
