"""Shapes of physical plans that matter at scale."""

import re

import pytest

from ferrywright import SyncOptions
from ferrywright.operators import filters, identity, place, reconcile, totals
from ferrywright.plans import derived


@pytest.fixture
def plan_of(spark):
    """The physical plan without adaptive execution or automatic broadcasts, as for large tables."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


def read_columns(plan):
    return [set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_filters_read_names_only(spark, sf, plan_of):
    plan = plan_of(filters.exclude_paths(derived.source_manifest(spark, sf), ["/src/src1/.*"]).select("path"))
    assert shuffles(plan) == 0
    assert read_columns(plan) == [{"doc_id", "source", "lang"}]


def test_comparison_is_one_join_of_narrow_rows(spark, sf, plan_of):
    src, tgt = derived.source_manifest(spark, sf), derived.target_manifest(spark, sf)
    plan = plan_of(reconcile.reconcile(src, tgt, SyncOptions(update=True)).select("rel_path", "action"))
    assert shuffles(plan) == 2 and plan.count("SortMergeJoin") == 1
    # Contents are hashed below the shuffles.
    for part in plan.split("Exchange")[1:]:
        assert "md5" in part.split("FileScan")[0] or "Union" in part.split("FileScan")[0]


def test_lengths_suffice_without_checksums(spark, sf, plan_of):
    src, tgt = derived.source_manifest(spark, sf), derived.target_manifest(spark, sf)
    plan = plan_of(reconcile.reconcile(src, tgt, SyncOptions(update=True, skip_crc=True)).select("rel_path", "action"))
    assert not any("text" in columns for columns in read_columns(plan))


def test_duplicates_and_set_comparison_aggregate_before_the_shuffle(spark, sf, plan_of):
    src, tgt = derived.source_manifest(spark, sf), derived.target_manifest(spark, sf)
    for frame in (totals.duplicate_keys(src), reconcile.in_sync(src, tgt)):
        plan = plan_of(frame)
        assert shuffles(plan) == 1
        assert re.search(r"Exchange.*\n.*HashAggregate.*partial_", plan)
        assert "SortAggregate" not in plan


def test_translation_carries_no_map_in_its_rows(spark, sf, plan_of):
    """Owners and groups find a small map by broadcast; it is not copied into the rows as an array."""
    src = derived.source_with_acl(spark, sf).select("rel_path", "owner", "group")
    plan = plan_of(identity.translate_identities(src, derived.identity_map(spark, sf)))
    assert shuffles(plan) == shuffles(plan_of(src)) and plan.count("BroadcastHashJoin") == 2
    assert "array<map" not in plan and "NestedLoop" not in plan


def test_placement_is_read_from_blocks(spark, sf, plan_of):
    src = derived.source_manifest(spark, sf)
    boxes = spark.createDataFrame([(0, 10**12)], "box_id int, size_bytes bigint")
    plan = plan_of(place.first_fit(src, boxes, block_rows=50).select("seq", "box_id"))
    assert shuffles(plan) == 0 and plan.count("BroadcastHashJoin") == 2
    assert all("text" not in columns for columns in read_columns(plan))
