"""Digests on demand, placement in stretches, parts of files, many patterns and joined ACL entries against plain versions."""

import hashlib
import io
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrywright import SyncOptions
from ferrywright.errors import InvalidInputError
from ferrywright.functions import access
from ferrywright.operators import copyjob, place, reconcile, splits
from ferrywright.sources import patterns
from tests import sequential

STATUS = "rel_path string, is_dir boolean, length bigint, block_size bigint, checksum string, path string"


def md5(data):
    return hashlib.md5(data).hexdigest()


@pytest.fixture
def trees(spark, tmp_path):
    """A source of which only those files exist whose content decides something, and the status of a target."""
    text = {"same": b"abcd", "other": b"abcX", "grown": b"abcdefgh", "grown_other": b"abcdefgh"}
    for name, data in text.items():
        (tmp_path / name).write_bytes(data)
    src = [(n, False, len(d)) for n, d in text.items()]
    src += [("new", False, 5), ("shrunk", False, 2), ("unknown", False, 4), ("dir", True, 0), ("conflict", False, 4), ("blocks", False, 4)]
    tgt = {"same": (False, 4, 1, md5(b"abcd")), "other": (False, 4, 1, md5(b"abcd")), "grown": (False, 4, 1, md5(b"abcd")), "grown_other": (False, 4, 1, md5(b"abXd"))}
    tgt |= {"shrunk": (False, 9, 1, "x"), "unknown": (False, 4, 1, None), "dir": (True, 0, 1, None), "conflict": (True, 0, 1, None), "blocks": (False, 4, 2, "x")}
    left = spark.createDataFrame([(n, d, k, 1, None, str(tmp_path / n)) for n, d, k in src], STATUS)
    return left, spark.createDataFrame([(n, d, k, b, c, "") for n, (d, k, b, c) in tgt.items()], STATUS)


def test_only_deciding_content_is_read(trees):
    """All other files don't exist, and digests are asked for candidates alone."""
    options, asked = SyncOptions(update=True, append=True, preserve="b"), []

    def digests(few):
        asked.extend(r.rel_path for r in few.collect())
        return copyjob.file_digests(few)

    got = {r.rel_path: r.action for r in reconcile.reconcile(*trees, options, digests=digests).collect()}
    assert sorted(asked) == ["grown", "grown_other", "other", "same"]
    want = {"same": "SKIP", "other": "OVERWRITE", "grown": "APPEND", "grown_other": "OVERWRITE", "new": "OVERWRITE", "shrunk": "OVERWRITE"}
    assert got == want | {"unknown": "SKIP", "dir": "MKDIR", "conflict": "CONFLICT", "blocks": "OVERWRITE"}
    found = {r.rel_path: r for r in copyjob.file_digests(reconcile.digest_candidates(reconcile.match_target(*trees), options)).collect()}
    assert (found["grown"].prefix_checksum, found["grown"].checksum) == (md5(b"abcd"), md5(b"abcdefgh"))


@pytest.mark.parametrize("options", [SyncOptions(), SyncOptions(overwrite=True), SyncOptions(update=True, skip_crc=True)])
def test_no_content_is_read_where_none_decides(trees, options):
    assert reconcile.digest_candidates(reconcile.match_target(*trees), options).count() == 0


def test_digests_on_demand_equal_checksums_known_before(spark, sf):
    from ferrywright.plans import derived

    src, tgt, content = derived.source_manifest(spark, sf), derived.target_manifest(spark, sf), derived.content(spark, sf)
    for options in (SyncOptions(update=True), SyncOptions(update=True, append=True), SyncOptions(update=True, strict_checksums=True)):
        lazy = reconcile.reconcile(src.drop("checksum"), tgt, options, digests=lambda few: reconcile.content_digests(few, content))
        eager = reconcile.reconcile(src, tgt, options, prefixes=lambda few: reconcile.prefix_checksums(few, content))
        assert sorted(lazy.select("rel_path", "action").collect()) == sorted(eager.select("rel_path", "action").collect())


def test_an_unreadable_candidate_counts_as_different(spark, trees):
    src, tgt = trees
    src = src.withColumn("path", F.when(F.col("rel_path") == "same", "/nowhere/same").otherwise(F.col("path")))
    out = reconcile.reconcile(src, tgt, SyncOptions(update=True), digests=copyjob.file_digests)
    assert {r.rel_path: r.action for r in out.collect()}["same"] == "OVERWRITE"


class Counting(io.BytesIO):
    total = 0

    def read(self, n=-1):
        data = super().read(n)
        Counting.total += len(data)
        return data


def test_digests_at_several_lengths_take_one_pass():
    data = os.urandom(3 << 20)
    lengths = [0, 1, 1 << 20, (1 << 20) + 5, 3 << 20]
    assert copyjob.stream_digests(Counting(data), lengths) == [md5(data[:n]) for n in lengths] + [md5(data)]
    assert Counting.total == len(data)
    assert copyjob.stream_digests(io.BytesIO(b"ab"), [5]) == [md5(b"ab")] * 2


@pytest.mark.parametrize("seed", range(8))
def test_fit_in_order_equals_one_row_at_a_time(seed):
    rng = random.Random(seed)
    caps = [rng.choice([0, 5, 100, 1000, 50_000]) + rng.randrange(50) for _ in range(6)] + ([place.UNLIMITED] if seed % 2 else [])
    caps.sort()
    sizes = [rng.choice([0, 1, rng.randrange(200), int(rng.paretovariate(0.7)) * 10]) for _ in range(5000)]
    left = np.array(caps, dtype="int64")
    got = np.concatenate([place.fit_in_order(np.array(sizes[a : a + 700]), left) for a in range(0, 5000, 700)])
    want = sequential.first_fit(sizes, [(i, None if c == place.UNLIMITED else c) for i, c in enumerate(caps)])
    assert [None if g < 0 else int(g) for g in got] == want


def test_a_long_block_is_placed_in_few_steps(monkeypatch):
    calls = []
    monkeypatch.setattr(place.np, "flatnonzero", lambda x, f=np.flatnonzero: calls.append(1) or f(x))
    sizes = np.random.default_rng(1).integers(1, 1000, 1_000_000)
    left = np.array([10**7, 5 * 10**7, 10**8], dtype="int64")
    place.fit_in_order(sizes, left)
    assert len(calls) < 2000


def test_each_box_has_a_task_of_its_own(spark):
    rng = random.Random(2)
    sizes = [rng.randrange(1000) for _ in range(2500)]
    rows = spark.createDataFrame([(i, n, i % 25) for i, n in enumerate(sizes)], "seq bigint, length bigint, box_id int")
    boxes = spark.createDataFrame([(b, 10**6 + b) for b in range(25)], "box_id int, size_bytes bigint")
    plan = place.plan_splits(boxes, tasks=4, max_splits=100)
    got = {r.seq: r.split_id for r in splits.balance(rows, plan, block_rows=500).collect()}
    first = {r.box_id: r.first_split for r in plan.collect()}
    for b in range(25):
        mine = [i for i in range(2500) if i % 25 == b]
        want = sequential.largest_first([sizes[i] for i in mine], 4)
        assert [got[i] - first[b] for i in mine] == want


def test_too_many_chunks_raise(spark):
    rows = spark.range(100).selectExpr("id as seq")
    with pytest.raises(InvalidInputError):
        splits.deal_chunks(rows, 300, ratio=2)
    assert splits.deal_chunks(rows, 300, ratio=2, tolerable=600).count() == 100


def plain_coverage(length, parts):
    if not parts:
        return "MISSING", 0
    parts, repeated, overlap, gap, upto = sorted(parts), None, None, None, 0
    for i, (o, n) in enumerate(parts):
        if i and parts[i - 1] == (o, n):
            repeated = o if repeated is None and n else repeated
        elif o < upto:
            overlap = o if overlap is None else overlap
        if o > upto and gap is None:
            gap = upto
        upto = max(upto, o + n)
    if gap is None and upto < length:
        gap = upto
    beyond = length if upto > length else None
    return next(((v, at) for v, at in (("REPEATED", repeated), ("OVERLAP", overlap), ("GAP", gap), ("BEYOND", beyond)) if at is not None), ("OK", None))


def test_part_coverage_tells_each_fault(spark):
    files = {"ok": (10, [(0, 4), (4, 4), (8, 2)]), "gap": (10, [(0, 4), (5, 5)]), "head": (10, [(4, 6)]), "tail": (10, [(0, 4)]), "twice": (8, [(0, 4), (0, 4), (4, 4)])}
    files |= {"over": (8, [(0, 5), (4, 4)]), "inside": (8, [(0, 8), (2, 3)]), "beyond": (8, [(0, 4), (4, 5)]), "none": (5, []), "empty": (0, [(0, 0)]), "same begin": (8, [(0, 3), (0, 8)])}
    rng = random.Random(6)
    for k in range(80):
        length = rng.randrange(1, 20)
        cuts = sorted({0, *(rng.randrange(length + 1) for _ in range(3))})
        parts = [(a, b - a) for a, b in zip(cuts, [*cuts[1:], length])]
        if rng.random() < 0.7:
            parts = [p for p in parts if rng.random() < 0.8] + [rng.choice(parts)] * rng.randrange(2) + [(rng.randrange(12), rng.randrange(12))] * rng.randrange(2)
        files[f"r{k}"] = (length, parts)
    left = spark.createDataFrame([(p, n) for p, (n, _) in files.items()], "path string, length bigint")
    right = spark.createDataFrame([(p, o, n) for p, (_, ps) in files.items() for o, n in ps], "path string, chunk_offset bigint, chunk_length bigint").repartition(4)
    got = {r.path: (r.verdict, r["at"]) for r in splits.part_coverage(left, right).collect()}
    assert got == {p: plain_coverage(n, ps) for p, (n, ps) in files.items()}
    assert [got[p][0] for p in ("ok", "gap", "twice", "over", "beyond", "none")] == ["OK", "GAP", "REPEATED", "OVERLAP", "BEYOND", "MISSING"]
    ranges = {(r.path, r.first_byte, r.end_byte) for r in splits.merged_ranges(right).collect()}
    for p, (_, ps) in files.items():
        held = {b for o, n in ps for b in range(o, o + n)}
        assert {b for q, a, e in ranges if q == p for b in range(a, e)} == held


def test_chunks_are_assembled_or_told(spark, tmp_path):
    rng, rows, data = random.Random(3), [], {}
    for name, size in (("a", 2500), ("b", 1000), ("c", 3001), ("d", 0)):
        data[name] = rng.randbytes(size)
        (tmp_path / name).write_bytes(data[name])
        rows.append((str(tmp_path / name), str(tmp_path / "out" / name), size))
    files = spark.createDataFrame(rows, "path string, target_uri string, length bigint")
    parts = copyjob.copy_chunks(files, 1000, SyncOptions(), 4)
    assert not list(tmp_path.rglob("*_copying_*"))
    lost = parts.filter(~(F.col("path").endswith("/c") & (F.col("chunk_offset") == 1000)))
    got = {os.path.basename(r.path): r for r in copyjob.assemble_chunks(files, lost, SyncOptions()).collect()}
    assert (got["c"].status, got["c"].error) == ("FAIL", "GAP at 1000")
    assert not (tmp_path / "out" / "c").exists()
    for name in "abd":
        assert (got[name].status, got[name].bytes_copied, got[name].checksum) == ("OK", len(data[name]), md5(data[name]))
        assert (tmp_path / "out" / name).read_bytes() == data[name]
    again = {os.path.basename(r.path): r.status for r in copyjob.assemble_chunks(files.filter("path not like '%/c'"), parts, SyncOptions()).collect()}
    assert set(again.values()) == {"OK"}
    whole = copyjob.assemble_chunks(files.filter("path like '%/c'"), parts, SyncOptions()).first()
    assert whole.status == "OK" and (tmp_path / "out" / "c").read_bytes() == data["c"]
    assert {p.name for p in (tmp_path / "out").iterdir()} == set("abcd")


def test_twenty_thousand_patterns(spark):
    files = [f"/data/d{i % 200}/f{i}.txt" for i in range(20_000)]
    rows = spark.createDataFrame([(p,) for p in files], "path string").repartition(8)
    globs = [p[:-3] + "t?t" if i % 2 else p[:-4] + "nothing*" for i, p in enumerate(files)]
    index = patterns.pattern_index(spark.createDataFrame([(g,) for g in globs], "glob string"))
    found = patterns.match_many(rows, index)
    assert {(r.glob, r.path) for r in found.collect()} == {(g, p) for i, (g, p) in enumerate(zip(globs, files)) if i % 2}
    assert patterns.exclude_many(rows, index).count() == 10_000


GLOBS = ["/a/b/*", "/a/{b,c/d}/x?", "*", "/a", "/a/b/", "/*/b/x1", "/a/b/x[12]", "/a\\*/q", "rel/*", "/z/{p,}/r", "/a/b/x1"]
PATHS = ["/a/b/x1", "/a/c/d/x2", "/a", "/a/b", "/a*/q", "/ab/q", "rel/f", "/z/p/r", "/z//r", "x", "/a/b/x1/y"]


def test_pattern_index_equals_one_pattern_at_a_time(spark):
    rows = spark.createDataFrame([(p,) for p in PATHS], "path string")
    index = patterns.pattern_index(spark.createDataFrame([(g,) for g in GLOBS], "glob string"))
    got = {(r.glob, r.path) for r in patterns.match_many(rows, index).collect()}
    assert got == {(g, p) for g in GLOBS for p in PATHS if re.fullmatch(patterns.glob_to_regex(g), p)}
    regexes = ["/a/b/.*", ".*/q", "/a|/z/.*", "/a/b/x1?", "/a/b+/x1", r"/a\*/q", "/a/b/x{1}1", "(/a)/b", "/a/b/x1", "/a/[bc].*"]
    index = patterns.pattern_index(spark.createDataFrame([(g,) for g in regexes], "glob string"), globs=False)
    got = {(r.glob, r.path) for r in patterns.match_many(rows, index).collect()}
    assert got == {(g, p) for g in regexes for p in PATHS if re.fullmatch(g, p)}
    none = patterns.pattern_index(spark.createDataFrame([], "glob string"))
    assert patterns.match_many(rows, none).count() == 0 and patterns.exclude_many(rows, none).count() == len(PATHS)


def test_entries_of_one_identity_are_joined(spark):
    entries = [("ACCESS", "USER", None, "rw-"), ("ACCESS", "USER", "x", "r--"), ("ACCESS", "GROUP", "x", "-w-"), ("ACCESS", "USER", "x", "--x")]
    entries += [("ACCESS", "MASK", None, "r--"), ("ACCESS", "OTHER", None, "---"), ("DEFAULT", "USER", "x", "r--"), ("DEFAULT", "MASK", None, "---")]
    schema = "array<struct<scope:string,type:string,name:string,perm:string>>"
    rows = spark.createDataFrame([(1, entries), (2, []), (3, None)], f"id int, acl {schema}")
    got = {r.id: r.acl and [tuple(e) for e in r.acl] for r in rows.select("id", access.merge_entries("acl").alias("acl")).collect()}
    want = [("ACCESS", "USER", None, "rw-"), ("ACCESS", "USER", "x", "r-x"), ("ACCESS", "GROUP", "x", "-w-"), ("ACCESS", "MASK", None, "rwx")]
    want += [("ACCESS", "OTHER", None, "---"), ("DEFAULT", "USER", "x", "r--"), ("DEFAULT", "MASK", None, "---")]
    assert got[1] == want and not got[2] and got[3] is None


def test_a_path_meets_only_patterns_that_begin_as_it_does(spark):
    """Patterns of one directory: what they begin with goes up to the first wildcard, also within a name."""
    files = [f"/data/d/{i}.txt" for i in range(300)]
    rows = spark.createDataFrame([(p,) for p in files], "path string")
    globs = [p[:-4] + "*.t?t" for p in files] + ["/data/d/*7.txt", "/data/d/é𝄞?", "/data/d/[12]5.txt"]
    index = patterns.pattern_index(spark.createDataFrame([(g,) for g in globs], "glob string"))
    assert {r.glob: r.base for r in index.collect()} == {g: re.split(r"[*?\[]", g)[0] for g in globs}
    rows = rows.union(spark.createDataFrame([("/data/d/é𝄞x",), ("/data/d/",), (None,)], "path string"))
    got = {(r.glob, r.path) for r in patterns.match_many(rows, index).collect()}
    assert got == {(g, p) for g in globs for p in [*files, "/data/d/é𝄞x"] if re.fullmatch(patterns.glob_to_regex(g), p)}
    bases = {"/a/bc*": "/a/b", "/a/b.c": "/a/b", r"/a\.b": "/a.b", "/a|/b": "", "a/(b)": "a/", r"/a\d": "/a", "/a/b/": "/a/b/", "/ab{2}": "/a", "(?i)/a": "", "": ""}
    assert {r: patterns.fixed_prefix(r) for r in bases} == bases


def test_many_patterns_are_not_sent_to_all_tasks(spark, monkeypatch):
    """Few patterns are sent once, without a copy per salt; of more, copies are never sent, however small they are stored."""
    files = [f"/data/d/{i}.txt" for i in range(50)]
    rows = spark.createDataFrame([(p,) for p in files], "path string")
    index = patterns.pattern_index(spark.createDataFrame([(p[:-3] + "*",) for p in files], "glob string"))
    for limit, join in ((50, "BroadcastHashJoin"), (49, "SortMergeJoin")):
        monkeypatch.setattr(patterns, "BROADCAST_ROWS", limit)
        found = patterns.match_many(rows, index)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert join in plan
        assert {(r.glob, r.path) for r in found.collect()} == {(p[:-3] + "*", p) for p in files}
