"""Root checks, outcome classes and the way of options to the planners."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferrywright import SyncOptions
from ferrywright.errors import CapabilityError, CopyFailedError
from ferrywright.operators import copyjob, metadata, place
from ferrywright.operators.strategy import assign_splits
from ferrywright.sources import listing

PLAN = "rel_path string, path string, target_uri string, action string, is_dir boolean, length bigint, tgt_length bigint, split_id int"


def test_check_roots(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    (tmp_path / "file").write_text("abc")
    names = [str(tmp_path / n) for n in ("folder", "file", "none", "file")]
    got = listing.check_roots(spark, spark.createDataFrame([(n,) for n in names], "path string"), pause=0.01).collect()
    told = sorted((r.path.rsplit("/", 1)[1], r.is_dir, r.error) for r in got)
    assert told == [("file", False, None), ("file", False, None), ("folder", True, None), ("none", False, "not found")]
    assert listing.check_roots(spark, spark.createDataFrame([], "path string")).count() == 0


@pytest.mark.parametrize("letters, feature, code", [("a", "acl", -3), ("x", "xattr", -4)])
def test_manifest_without_a_feature(spark, letters, feature, code):
    plain = spark.createDataFrame([("/a", False, 1)], "rel_path string, is_dir boolean, length bigint")
    wanted = SyncOptions(preserve=letters).preserve
    with pytest.raises(CapabilityError, match=feature) as told:
        metadata.preserve_plan(plain, plain, wanted)
    assert told.value.exit_code == code
    other = plain.withColumn("acl", F.array()).withColumn("xattrs", F.create_map())
    with pytest.raises(CapabilityError, match="target"):
        metadata.preserve_plan(other, plain, wanted)
    with pytest.raises(CapabilityError):
        metadata.preserve_plan(plain, plain, (), raw_xattrs=True)


def test_what_a_store_does_not_support_is_a_failed_row(spark, tmp_path, monkeypatch):
    """Such an error comes at every attempt, so it is told after the first."""
    row = type("Row", (), dict(rel_path="/a", path="/p", target_uri="/t", action="OVERWRITE", length=3, tgt_length=None, split_id=0))

    def refuse(row, options):
        raise pa.ArrowNotImplementedError("no such call")

    monkeypatch.setattr(copyjob, "_overwrite", refuse)
    out = copyjob._carry_out(row, SyncOptions(), 0.01)
    assert (out["status"], out["error_class"], out["attempts"], out["error"]) == ("FAIL", "write", 1, "no such call")


def test_unreadable_sources_by_policy(spark, tmp_path):
    (tmp_path / "there").write_text("abc")
    rows = [(f"/{n}", str(tmp_path / n), str(tmp_path / "out" / n), "OVERWRITE", False, 3, None, i) for i, n in enumerate(("there", "lost"))]
    done = copyjob.copy_files(spark.createDataFrame(rows, PLAN), SyncOptions(), pause=0.01)
    assert {(r.rel_path, r.status, r.error_class, r.attempts) for r in done.collect()} == {("/there", "OK", None, 1), ("/lost", "FAIL", "read", 3)}
    with pytest.raises(CopyFailedError, match="lost"):
        copyjob.enforce_failures(done, SyncOptions())
    assert copyjob.enforce_failures(done, SyncOptions(ignore_failures=True)).count() == 2


def test_options_reach_the_planners(spark):
    rows = spark.createDataFrame([(i, 10) for i in range(60)], "seq bigint, length bigint").withColumn("chunk_length", F.col("length"))
    boxes = spark.createDataFrame([(0, 10_000)], "box_id int, size_bytes bigint")
    for options in (SyncOptions(max_maps=3), SyncOptions(max_maps=12, tasks_per_box=5)):
        planned = place.plan_splits(boxes, options.tasks_per_box, options.max_maps).first().n_splits
        assert planned == min(options.max_maps, options.tasks_per_box)
        used = assign_splits(rows, boxes=boxes, options=options).select("split_id").distinct().count()
        assert used == planned
        assert assign_splits(rows, "uniform", size="chunk_length", options=options).select("split_id").distinct().count() == options.max_maps
    assert assign_splits(rows, "uniform", size="chunk_length", max_maps=2, options=SyncOptions(max_maps=5)).select("split_id").distinct().count() == 2
