import random

import pytest

from ferrywright.errors import InvalidInputError
from ferrywright.functions.paths import chunk_path, is_chunk, size_to_copy
from ferrywright.operators import place, splits
from ferrywright.options import check_chunk_count, split_ratio
from ferrywright.plans import derived
from tests import sequential

BOXES = "box_id int, size_bytes bigint"


def manifest(spark, sizes, name="length"):
    return spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], f"seq bigint, {name} bigint")


def boxes_of(spark, capacities):
    return spark.createDataFrame(list(enumerate(capacities)), BOXES)


def placement(frame):
    return [r.box_id for r in frame.orderBy("seq").collect()]


def sizes_of(kind, n, rnd):
    if kind == "heavy tail":
        return [int(rnd.paretovariate(0.7)) for _ in range(n)]
    if kind == "ties and zeros":
        return [rnd.choice([0, 0, 1, 5, 5, 7]) for _ in range(n)]
    # One row in two is just too large for what is left: the worst case for placement by prefixes.
    room = 3 * n
    return [1 if i % 2 == 0 else room - i // 2 for i in range(n)]


@pytest.mark.parametrize("kind", ["heavy tail", "ties and zeros", "adversarial"])
@pytest.mark.parametrize("seed", [1, 2])
def test_first_fit_equals_sequential(spark, kind, seed):
    rnd = random.Random(seed)
    sizes = sizes_of(kind, 150, rnd)
    total = sum(sizes)
    capacities = [3 * 150, total // 5, total // 9, total // 7] if seed == 1 else [total // 20, total // 3, 4]
    ranked = sorted(enumerate(capacities), key=lambda b: (b[1], b[0]))
    for block_rows in (40, 1000):
        got = place.first_fit(manifest(spark, sizes), boxes_of(spark, capacities), block_rows=block_rows)
        assert placement(got) == sequential.first_fit(sizes, ranked)


def test_unsized_boxes_take_the_rest(spark):
    sizes = [600_000, 300_000, 100_000, 500_000, 900_000, 0]
    capacities = [500_000, 800_000, -1]
    got = place.first_fit(manifest(spark, sizes), boxes_of(spark, capacities), block_rows=2)
    assert placement(got) == [1, 0, 0, 2, 2, 0]
    got = place.first_fit(manifest(spark, sizes), boxes_of(spark, capacities[:2]), block_rows=2)
    assert placement(got) == [1, 0, 0, None, None, 0]


def test_no_boxes_and_no_rows(spark):
    assert placement(place.first_fit(manifest(spark, [1, 2]), boxes_of(spark, []).limit(0))) == [None, None]
    assert placement(place.first_fit(manifest(spark, [1]).limit(0), boxes_of(spark, [5]))) == []


def test_previous_placement_is_kept(spark):
    sizes = [4, 4, 4, 4]
    previous = spark.createDataFrame([(3, 0), (0, 1)], "seq bigint, box_id int")
    got = place.first_fit(manifest(spark, sizes), boxes_of(spark, [8, 9]), previous=previous)
    assert placement(got) == [1, 0, 1, 0]


@pytest.mark.parametrize("bad", [None, -1])
def test_sizes_are_checked(spark, bad):
    rows = spark.createDataFrame([(0, 1), (1, bad)], "seq bigint, length bigint")
    with pytest.raises(InvalidInputError):
        place.first_fit(rows, boxes_of(spark, [5]))


def test_running_total(spark):
    from ferrywright.operators.blocks import running_total

    sizes = [3, 0, 5, 1, 1, 7]
    got = running_total(manifest(spark, sizes), "seq", "length", "upto", block_rows=2).orderBy("seq").collect()
    assert [r.upto for r in got] == [3, 3, 8, 9, 10, 17]


def test_one_size_shared_by_most_rows(spark):
    """A hot size is spread over blocks: no lookup key holds more rows than a block."""
    sizes = [4096] * 900 + list(range(100))
    rows = spark.createDataFrame([(i, n, 0) for i, n in enumerate(sizes)], "seq bigint, length bigint, box_id int")
    plan = place.plan_splits(boxes_of(spark, [10**9]), tasks=7)
    got = {r.seq: r.split_id for r in splits.balance(rows, plan, block_rows=100).collect()}
    assert [got[i] for i in range(1000)] == sequential.largest_first(sizes, 7)


def test_any_number_of_boxes(spark):
    boxes = place.collect_boxes(spark.range(1_001).selectExpr("cast(id as int) box_id", "1000 - id size_bytes"))
    assert [b.box_id for b in boxes] == list(range(1_000, -1, -1))


TIB = 2**40


def test_plan_splits(spark):
    def plan(capacities, **options):
        rows = place.plan_splits(boxes_of(spark, capacities), **options).orderBy("box_rank").collect()
        return [(r.box_id, r.n_splits, r.first_split) for r in rows]

    assert plan([80 * TIB, 100 * TIB]) == [(0, 6, 0), (1, 6, 6)]
    assert plan([200 * TIB, 100 * TIB], max_splits=100) == [(1, 6, 0), (0, 24, 6)]
    # 30 splits would be ideal; 20 are allowed.
    assert plan([200 * TIB, 100 * TIB]) == [(1, 4, 0), (0, 16, 4)]
    assert plan([-1, 10], tasks=1, max_splits=1) == [(1, 1, 0), (0, 1, 1)]
    observed = dict(factors="observed", max_splits=1000)
    assert plan([40, 48, 49, 224, 225], **observed) == [(0, 24, 0), (1, 24, 24), (2, 6, 48), (3, 6, 54), (4, 24, 60)]


@pytest.mark.parametrize("seed", range(3))
def test_balance_equals_sequential(spark, seed):
    rnd = random.Random(seed)
    pool = [0, 1, 2, 3, 3, 10, 50, 1000] if seed else [7] * 3 + [0]
    sizes = [rnd.choice(pool) for _ in range(300)] + [rnd.randint(0, 5000) for _ in range(60)]
    box = [rnd.choice([0, 0, 0, 1, None]) for _ in sizes]
    rows = spark.createDataFrame(list(zip(range(len(sizes)), sizes, box)), "seq bigint, length bigint, box_id int")
    plan = place.plan_splits(boxes_of(spark, [10_000, 20_000]), tasks=5)
    got = splits.balance(rows, plan, block_rows=40).collect()
    first = {r.box_id: r.first_split for r in plan.collect()}
    want = {}
    for b in (0, 1):
        mine = [i for i in range(len(sizes)) if box[i] == b]
        for i, s in zip(mine, sequential.largest_first([sizes[i] for i in mine], 5)):
            want[i] = (b, first[b] + s)
    assert {r.seq: (r.box_id, r.split_id) for r in got} == want


def test_equal_sizes_become_few_patterns():
    loads = splits._SplitLoads(7)
    loads.run(1_000_000, 3)
    phases = loads.run(10, 5_000_000)
    assert sum(rows for _, rows, _ in phases) == 5_000_000
    assert sum(len(cycle) for _, _, cycle in phases) < 200


@pytest.mark.parametrize("n", [1, 3, 19])
def test_uniform_split_equals_sequential(spark, n):
    rnd = random.Random(n)
    sizes = [rnd.choice([0, 1, rnd.randint(1024, 2048), int(rnd.paretovariate(0.6)) * 100]) for _ in range(200)]
    rows = manifest(spark, sizes, "chunk_length")
    for block_rows in (50, 1000):
        got = splits.uniform_split(rows, n, block_rows=block_rows).orderBy("seq").collect()
        assert [r.split_id for r in got] == sequential.next_fit(sizes, n)


def test_uniform_split_edges(spark):
    rows = manifest(spark, [0, 0, 0], "chunk_length")
    assert {r.split_id for r in splits.uniform_split(rows, 4).collect()} == {0}
    rows = manifest(spark, [9, 0, 1, 1], "chunk_length")
    got = splits.uniform_split(rows, 11, block_rows=1).orderBy("seq").collect()
    assert [r.split_id for r in got] == sequential.next_fit([9, 0, 1, 1], 11)
    with pytest.raises(InvalidInputError):
        splits.uniform_split(rows, 0)


@pytest.mark.parametrize("records,maps,ratio", [(1000, 7, 15), (101, 7, 2), (320, 16, 2), (517, 9, 5), (5, 7, 2), (47, 47, 1)])
def test_deal_chunks_equals_sequential(spark, records, maps, ratio):
    rows = spark.range(records).selectExpr("id * 3 as seq")
    got = splits.deal_chunks(rows, maps, ratio, block_rows=100).orderBy("seq").collect()
    assert [r.idx for r in got] == list(range(records))
    assert [r.chunk_id for r in got] == sequential.deal(records, maps, ratio)


def test_split_ratio_table():
    assert split_ratio(1, 1_000_000_000) == 1
    assert split_ratio(11_000_000, 10) == 2
    assert split_ratio(30, 700) == 4
    assert split_ratio(30, 200) == 2
    assert split_ratio(30, 700, ideal=-1, min_records=-1, ratio=-1) == 4
    assert split_ratio(3, 200, ideal=30, min_records=10, ratio=53) == 53
    check_chunk_count(2, 200)
    with pytest.raises(InvalidInputError):
        check_chunk_count(3, 200)


def test_chunk_files(spark):
    rows = spark.createDataFrame([("/a", 2500), ("/b", 0), ("/c", 1000)], "path string, length bigint")
    parts = splits.chunk_files(rows, 1000)
    named = parts.select("path", "chunk_offset", "chunk_length", is_chunk().alias("part"), size_to_copy().alias("n"))
    assert sorted(tuple(r) for r in named.collect()) == [
        ("/a", 0, 1000, True, 1000),
        ("/a", 1000, 1000, True, 1000),
        ("/a", 2000, 500, True, 500),
        ("/b", 0, 0, False, 0),
        ("/c", 0, 1000, False, 1000),
    ]
    name = parts.filter("path = '/a' and chunk_offset = 2000").select(chunk_path("path", "chunk_offset", "chunk_length"))
    assert name.first()[0] == "/a.____split____2000.500"
    with pytest.raises(InvalidInputError):
        splits.chunk_files(rows, 0)


def test_orders_are_placed_and_balanced_as_by_one_pass(spark, sf):
    """The registered query against the literal loops over the whole table."""
    from ferrywright.plans.queries import QUERIES

    rows = derived.order_manifest(spark, sf).orderBy("seq").collect()
    boxes = derived.order_boxes(spark, sf)
    ranked = [(b.box_id, None if b.capacity == place.UNLIMITED else b.capacity) for b in place.collect_boxes(boxes)]
    box = sequential.first_fit([r.length for r in rows], ranked)
    plan = {r.box_id: r for r in place.plan_splits(boxes).collect()}
    want = {}
    for b in plan.values():
        mine = [r for r, x in zip(rows, box) if x == b.box_id]
        for r, s in zip(mine, sequential.largest_first([r.length for r in mine], b.n_splits)):
            want[r.seq] = (b.box_id, b.first_split + s)
    got = QUERIES["placement_orders"](spark, sf).collect()
    assert {r.seq: (r.box_id, r.split_id) for r in got} == want


def test_uniform_split_of_orders_as_by_one_pass(spark, sf):
    from ferrywright.plans.queries import QUERIES

    rows = derived.order_manifest(spark, sf).orderBy("seq").collect()
    want = {}
    for r, s in zip(rows, sequential.next_fit([r.length for r in rows], 50)):
        n, total, first = want.get(s, (0, 0, r.seq))
        want[s] = (n + 1, total + r.length, first)
    got = QUERIES["uniform_split_orders"](spark, sf).collect()
    assert {r.split_id: (r.records, r.bytes, r.first_seq) for r in got} == want


def test_strategies(spark):
    from ferrywright.operators.strategy import assign_splits

    rows = manifest(spark, [5, 50, 5, 5, 5])
    boxes = boxes_of(spark, [20])
    got = {r.seq: (r.box_id, r.split_id) for r in assign_splits(rows, boxes=boxes, tasks_per_box=2).collect()}
    assert got == {0: (0, 0), 1: (None, None), 2: (0, 1), 3: (0, 1), 4: (0, 0)}
    uniform = assign_splits(rows, "uniform", max_maps=2).orderBy("seq").collect()
    assert [r.split_id for r in uniform] == [0, 1, 2, 2, 2]
    dynamic = assign_splits(rows, "dynamic", max_maps=2).orderBy("seq").collect()
    assert [r.split_id for r in dynamic] == sequential.deal(5, 2, 2)
    for bad in (dict(strategy="other"), dict(strategy="first_fit")):
        with pytest.raises(InvalidInputError):
            assign_splits(rows, **bad)
