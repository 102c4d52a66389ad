import os

import pytest

from ferrywright import scratch
from ferrywright.errors import InvalidInputError


def test_tables_and_lookups(spark):
    table, rows = scratch.cut_counted(spark.range(10).toDF("n"), "t")
    assert rows == 10 and table.count() == 10
    assert "broadcast" in scratch.lookup_table(table, "l")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in scratch.lookup_table(table, "l", 9)._jdf.queryExecution().logical().toString()
    small = scratch.small_table(spark, [(1, [{"a": 2}])], "x int, y array<struct<a:bigint>>")
    assert small.first().y[0].a == 2 and scratch.small_table(spark, [], "x int").count() == 0


def test_scratch_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or scratch.scratch_dir(spark).startswith(base)
    monkeypatch.setattr(scratch, "scratch_dir", lambda session: f"{tmp_path}/own")
    assert scratch.cut(spark.range(3).toDF("n"), "t").count() == 3
    (tmp_path / "other").write_text("stays")
    scratch.drop_scratch(spark)
    assert os.listdir(tmp_path / "own") == [] and (tmp_path / "other").exists()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None),
        sparkContext=SimpleNamespace(applicationId="app", master="yarn"),
    )
    with pytest.raises(InvalidInputError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(fake)
