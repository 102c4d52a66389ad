"""What rules links of odd nodes out never rules out one that is there."""

import numpy as np
from pyspark.sql import functions as F

from ferrywright.llm import near


def variant(rng, shingles, weights):
    """Some of a hub's shingles lost, some heavier or lighter, some new, all perhaps repeated."""
    keep = rng.random(len(shingles)) > rng.choice([0.0, 0.03, 0.1, 0.3])
    w = weights.copy()
    odd = rng.random(len(w)) < rng.choice([0.0, 0.05, 0.3])
    w[odd] = np.maximum(1, w[odd] + rng.integers(-3, 4, odd.sum()))
    new = rng.choice(40, rng.integers(0, 8), replace=False).astype(np.uint64) + np.uint64(1000)
    s, w = np.concatenate([shingles[keep], new]), np.concatenate([w[keep], rng.integers(1, 5, len(new))]) * rng.integers(1, 3)
    order = np.argsort(s)
    return s[order], w[order]


def test_links_are_possible(spark):
    rng, rows = np.random.default_rng(5), []
    for _ in range(1500):
        hub = np.arange(60, dtype=np.uint64), rng.choice([1, 1, 1, 2, 4, 9], 60)
        x, y = variant(rng, *hub), variant(rng, *hub)
        sides = []
        for s, w in (x, y):
            only, numbers = near._apart(s, w, *hub)
            sides += [only.view(np.int64).tolist(), *[float(n) for n in numbers]]
        rows.append((float(near.similarity(*x, *y)), *sides))
    names = ["like", *["apart", *near.NUMBERS], *[f"_{c}" for c in ("apart", *near.NUMBERS)]]
    types = ["double", *["array<bigint>", *["double"] * len(near.NUMBERS)] * 2]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types))).repartition(4)
    for least in (0.6, 0.8, 0.9):
        told = df.withColumn("possible", near._possible(least)).groupBy("possible", (F.col("like") >= least).alias("linked")).count().collect()
        counts = {(r.possible, r.linked): r["count"] for r in told}
        assert (False, True) not in counts  # no link is ruled out
        assert counts[True, True] > 50 and counts[False, False] > 50  # and some of what isn't one is


def test_apart_without_common_shingles():
    x, hub = (np.array([1, 2], np.uint64), np.array([3, 1])), (np.array([5], np.uint64), np.array([2]))
    only, numbers = near._apart(*x, *hub)
    assert only.tolist() == [1, 2, 5] and dict(zip(near.NUMBERS, numbers)) == {
        "fresh": 4, "gone": 2, "top_fresh": 3, "top_gone": 2, "mass": 4, "scale": 0, "under": 0, "ratio": 0,
    }


def test_nodes_far_apart_do_not_meet(spark):
    """Forty nodes that lack the same passage of their hub, and each much else: hardly a pair has its shingles compared, and no link is lost."""
    rng, nodes = np.random.default_rng(9), {}
    hub = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64)), rng.choice([1, 1, 1, 2, 5], 300)
    for i in range(40):
        if i % 8 == 7:  # a link of the node before
            s, w = nodes[i - 1]
            nodes[i] = s[8:], w[8:]
            continue
        keep = (np.arange(300) >= 30) & (rng.random(300) > 0.2)
        s, w = np.concatenate([hub[0][keep], rng.integers(0, 2**63, 30).astype(np.uint64)]), np.concatenate([hub[1][keep], np.ones(30, int)])
        nodes[i] = s[np.argsort(s)], w[np.argsort(s)]
    name = {i: bytes([i + 1]) for i in nodes} | {"hub": bytes([0])}
    rows = [(bytearray(name[i]), s.view(np.int64).tolist(), w.tolist()) for i, (s, w) in (nodes | {"hub": hub}).items()]
    shingles = spark.createDataFrame(rows, "node binary, s array<bigint>, w array<int>")
    pairs = spark.createDataFrame([(bytearray(name[i]), bytearray(name["hub"]), True) for i in nodes], "a binary, b binary, others boolean")
    compared = near._compared(pairs, shingles, near.SIMILARITY)
    labels = spark.createDataFrame([], "id binary, label binary")
    met = {(bytes(r.a), bytes(r.b)) for r in near._meeting(compared.filter(F.col("like") < near.SIMILARITY), labels).collect()}
    linked = {(name[i], name[j]) for i in nodes for j in nodes if i < j and near.similarity(*nodes[i], *nodes[j]) >= near.SIMILARITY}
    assert linked == {(name[i - 1], name[i]) for i in range(7, 40, 8)}
    assert linked <= met and len(met) < 100  # of 780 pairs
    assert [len(near._parity(hub[0], n)) for n in (0, 1, 64, 65, 128, 300)] == [1, 1, 1, 2, 2, 8]
