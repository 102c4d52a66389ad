import pytest
from pyspark.sql import functions as F

from ferrywright import DuplicateTargetError, InvalidInputError, SyncOptions, pack_attributes, parse_preserve
from ferrywright.errors import CapabilityError
from ferrywright.functions import access, paths, values
from ferrywright.operators import filters, ordering, totals
from ferrywright.schema import MANIFEST, as_manifest
from ferrywright.sources import patterns

FILTER_PATHS = ["/user/bar", "/user/foo/_SUCCESS", "/hive/test_data", "test", "/user/foo/bar", "/mapred/.staging_job"]


def column(spark, values_, expression, kind="string"):
    frame = spark.createDataFrame([(v,) for v in values_], f"v {kind}")
    return [r[0] for r in frame.select(expression).collect()]


def paths_frame(spark, values_):
    return spark.createDataFrame([(v,) for v in values_], "path string")


@pytest.mark.parametrize(
    "given,kept",
    [
        ([".*test.*", "/user/b.*", ".*_SUCCESS"], 2),
        ([".*"], 0),
        (["user"], 6),
        ([], 6),
        ([r"/(u)ser/.*", r"(?i)TEST", r"(.)\1x|/hive/.*"], 1),
    ],
)
def test_exclude_paths(spark, given, kept):
    assert filters.exclude_paths(paths_frame(spark, FILTER_PATHS), given).count() == kept
    assert filters.exclude_paths(paths_frame(spark, FILTER_PATHS), given[::-1]).count() == kept


def test_whole_value_must_match(spark):
    assert filters.exclude_paths(paths_frame(spark, ["a\nb", "a"]), ["a"]).count() == 1
    assert filters.exclude_paths(paths_frame(spark, ["a", "b", None]), predicate=F.col("path") == "a").count() == 2


def test_relative_path(spark):
    rows = [("/", "/a"), ("/tmp/abc", "/tmp/abc/xyz/file"), ("/f", "/f"), ("hdfs://nn:8020/tmp", "hdfs://nn:8020/tmp/x")]
    frame = spark.createDataFrame(rows, "root string, path string")
    got = [r[0] for r in frame.select(paths.relative_path("root", "path")).collect()]
    assert got == ["/a", "/xyz/file", "", "/x"]


@pytest.mark.parametrize(
    "path,is_dir,n,replace,root",
    [
        ("/a/f", False, 1, False, "/a/f"),
        ("/a/f", False, 1, True, "/a/f"),
        ("/a/d", True, 1, False, "/a/d"),
        ("/a/d", True, 2, False, "/a"),
        ("/a/d", True, 2, True, "/a/d"),
        ("/a/f", False, 2, True, "/a"),
        ("/f", False, 2, False, "/"),
        ("hdfs://nn/", True, 2, False, "hdfs://nn/"),
        ("hdfs://nn/d", True, 2, False, "hdfs://nn/"),
    ],
)
def test_source_root(spark, path, is_dir, n, replace, root):
    frame = spark.createDataFrame([(path, is_dir)], "path string, is_dir boolean")
    assert frame.select(paths.source_root("path", "is_dir", n, replace)).first()[0] == root


def test_suppress_roots(spark):
    rows = [("/r", "/r", True), ("/r/f", "/r", False), ("/f", "/f", False)]
    frame = spark.createDataFrame(rows, "path string, root string, is_dir boolean")
    assert filters.suppress_roots(frame, False).count() == 3
    assert {r.path for r in filters.suppress_roots(frame, True).collect()} == {"/r/f", "/f"}


def test_targets_and_boxes(spark):
    frame = spark.createDataFrame([("file:/b/", "/x"), ("file:/b", "")], "base string, rel string")
    assert [r[0] for r in frame.select(paths.target_uri("base", "rel")).collect()] == ["file:/b/x", "file:/b"]
    frame = spark.createDataFrame([("d", "k", "c"), ("u://d", " ", "c"), ("u://d", None, None)], "d string, k string, c string")
    got = [r[0] for r in frame.select(paths.box_uri("d", "k", "c")).collect()]
    assert got == ["wasb://c@d/", "u://d", "u://d"]
    assert column(spark, ["/a", "s3://b/c"], paths.qualify("v", "hdfs://nn/")) == ["hdfs://nn/a", "s3://b/c"]


def test_human_bytes(spark):
    given = [0, 1, 1023, 1024, 1536, 10 * 1024**2, 1024**3, 5 * 1024**4, 3 * 1024**5, 1024 + 256, 1024 + 768]
    want = ["0.0B", "1.0B", "1023.0B", "1.0K", "1.5K", "10.0M", "1.0G", "5.0T", "3.0P", "1.2K", "1.8K"]
    assert column(spark, given, values.human_bytes("v"), "bigint") == want


def test_rates_and_progress(spark):
    frame = spark.createDataFrame([(1000, 500), (1000, 1999), (1000, 3000)], "n bigint, ms bigint")
    assert [r[0] for r in frame.select(values.bytes_per_second("n", "ms")).collect()] == [1000, 1000, 333]
    frame = spark.createDataFrame([(1, 3), (0, 0), (5, 5)], "n bigint, total bigint")
    assert [r[0] for r in frame.select(values.percent("n", "total")).collect()] == [33.3, None, 100.0]


def test_checksums_equal(spark):
    frame = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "l string, r string")
    both = frame.select(values.checksums_equal("l", "r"), values.checksums_equal("l", "r", strict=True)).collect()
    assert [tuple(r) for r in both] == [(True, True), (False, False), (True, False), (True, False)]


def test_attributes(spark):
    names = ["", "R", "RB", "RBUC", "RBUGC", "RBUGPC", "RBUGPCT", "RBUGPCAXT"]
    assert [pack_attributes(parse_preserve(n)) for n in names] == names
    assert pack_attributes(parse_preserve("RCBUGPAXT")) == "RBUGPCAXT"
    assert parse_preserve("rbugpct") == parse_preserve("RBUGPCT") and parse_preserve(None) == frozenset()
    with pytest.raises(InvalidInputError):
        parse_preserve("RZ")
    assert column(spark, ["ra", ""], values.attribute_letters(values.attribute_names("v"))) == ["RA", ""]
    with pytest.raises(Exception, match="No attribute for Z"):
        column(spark, ["rz"], values.attribute_names("v"))


@pytest.mark.parametrize(
    "bad",
    [
        dict(overwrite=True, update=True),
        dict(skip_crc=True),
        dict(append=True),
        dict(update=True, append=True, skip_crc=True),
        dict(diff=("s1", "s2")),
        dict(update=True, diff=("s1", " ")),
        dict(verbose=True),
        dict(max_maps=0),
        dict(preserve="q"),
    ],
)
def test_option_matrix(bad):
    with pytest.raises(InvalidInputError):
        SyncOptions(**bad)


def test_options_and_exit_codes():
    options = SyncOptions(update=True, append=True, diff=("a", "b"), verbose=True, log_path="/l", preserve="rb")
    assert options.preserve == {"replication", "blocksize"}
    assert (InvalidInputError.exit_code, DuplicateTargetError.exit_code) == (-1, -2)
    assert (CapabilityError("no").exit_code, CapabilityError("no", "xattr").exit_code) == (-3, -4)


def test_logical_acl(spark):
    entry = "array<struct<scope:string,type:string,name:string,perm:string>>"
    rows = [
        (0o640, None),
        (0o750, [("ACCESS", "USER", "diana", "r--"), ("DEFAULT", "USER", "bruce", "rwx")]),
        (0o700, [("DEFAULT", "USER", "bruce", "rwx")]),
    ]
    frame = spark.createDataFrame(rows, f"perm int, acl {entry}").select(access.logical_acl("perm", "acl").alias("acl"))
    got = [[(e.scope[0], e.type, e.name, e.perm) for e in r.acl] for r in frame.collect()]
    assert got[0] == [("A", "USER", None, "rw-"), ("A", "GROUP", None, "r--"), ("A", "OTHER", None, "---")]
    assert got[1] == [
        ("A", "USER", None, "rwx"),
        ("A", "USER", "diana", "r--"),
        ("A", "MASK", None, "r-x"),
        ("A", "OTHER", None, "---"),
        ("D", "USER", "bruce", "rwx"),
    ]
    assert got[2][1] == ("A", "GROUP", None, "---") and got[2][3] == ("D", "USER", "bruce", "rwx")


@pytest.mark.parametrize("raw,regular,kept", [(True, True, 2), (True, False, 1), (False, True, 1), (False, False, 0)])
def test_filter_xattrs(spark, raw, regular, kept):
    frame = spark.createDataFrame([({"raw.a1": b"1", "user.a1": None},)], "x map<string,binary>")
    assert len(frame.select(access.filter_xattrs("x", raw=raw, regular=regular)).first()[0]) == kept


def test_manifest_defaults(spark):
    frame = spark.createDataFrame([("/f", None, None), ("/d", True, None)], "path string, is_dir boolean, owner string")
    rows = as_manifest(frame, {"length": F.lit(7)}).collect()
    assert rows[0].asDict().keys() == {f.name for f in MANIFEST}
    assert [(r.is_dir, r.perm, r.owner, r.group, r.chunk_length) for r in rows] == [
        (False, 0o666, "", "", 7),
        (True, 0o777, "", "", 7),
    ]


def test_totals_and_duplicates(spark):
    rows = [("in/1", "/1", False, 3), ("in/2", "/2", False, 3), ("in2/2", "/2", False, 4)]
    frame = spark.createDataFrame(rows, "path string, rel_path string, is_dir boolean, length bigint")
    assert tuple(totals.totals(frame).first()) == (10, 3, 0)
    assert [tuple(r) for r in totals.duplicates(frame).collect()] == [("/2", 2, "in/2", "in2/2")]
    with pytest.raises(DuplicateTargetError):
        totals.assert_unique(frame)
    assert totals.assert_unique(frame.filter("path <> 'in2/2'")).count() == 2
    assert tuple(totals.totals(frame.limit(0)).first()) == (0, 0, 0)


def test_order_depends_only_on_seed(spark):
    frame = spark.range(50).selectExpr("concat('/d', id % 25, '/f', id) as path")
    orders = [
        [r.path for r in ordering.randomize(f, seed, block_rows=20).orderBy("seq").collect()]
        for f, seed in ((frame, 1), (frame.orderBy(F.desc("path")), 1), (frame, 2))
    ]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2])
    numbered = ordering.number_rows(frame, "path", block_rows=20).orderBy("path").collect()
    assert [r.seq for r in numbered] == list(range(50))
    assert [r.path for r in ordering.sort_manifest(frame, "path").collect()] == [r.path for r in numbered]


@pytest.mark.parametrize(
    "glob,hits,misses",
    [
        ("in/*/*", ["in/src1/1.txt"], ["in/a", "in/a/b/c"]),
        ("/a?c", ["/abc"], ["/a/c", "/abbc"]),
        ("/[a-c]x[!0-9]", ["/bxz"], ["/dxz", "/bx1"]),
        ("/{aa,b*}/c", ["/aa/c", "/bcd/c"], ["/a/c"]),
        (r"/a\*b.c", ["/a*b.c"], ["/axb.c", "/a*bxc"]),
    ],
)
def test_globs(spark, glob, hits, misses):
    frame = paths_frame(spark, hits + misses)
    assert {r.path for r in patterns.expand_globs(frame, [glob]).collect()} == set(hits)


def test_globs_without_match(spark):
    frame = paths_frame(spark, ["/a/b"])
    with pytest.raises(InvalidInputError, match="/x/"):
        patterns.expand_globs(frame, ["/a/*", "/x/*"])
    with pytest.raises(InvalidInputError):
        patterns.expand_globs(frame, [])
    for broken in ("/[a", "/{a"):
        with pytest.raises(InvalidInputError):
            patterns.glob_to_regex(broken)
