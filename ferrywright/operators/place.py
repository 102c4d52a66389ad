"""Placement of rows on capacity-limited boxes, and planning of splits per box."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidInputError
from ..options import DEFAULT_MAX_MAPS, DEFAULT_TASKS_PER_BOX
from ..scratch import cut, small_table, store
from .blocks import build_blocks

UNLIMITED = 2**63 - 1
SCAN_BLOCKS = 32

# Throughput factor by the smallest listed capacity that holds a box. ``intended``
# follows the documented sizes (100 TiB, 1 PiB); ``observed`` is what the original arithmetic yields.
SIZE_FACTORS = {
    "intended": ((100 * 2**40, 1), (2**50, 4), (UNLIMITED, 4)),
    "observed": ((48, 4), (224, 1), (UNLIMITED, 4)),
}


@dataclass(frozen=True)
class Box:
    box_id: int
    capacity: int
    rank: int


def collect_boxes(boxes: DataFrame) -> list[Box]:
    """Boxes from smallest to largest, ties by ``box_id``; unsized ones last.

    Boxes come from a hand-written configuration, a record per box.
    """
    rows = boxes.select("box_id", "size_bytes").collect()
    sized = sorted((UNLIMITED if r.size_bytes is None or r.size_bytes < 0 else r.size_bytes, r.box_id) for r in rows)
    return [Box(box_id, capacity, rank) for rank, (capacity, box_id) in enumerate(sized)]


def plan_splits(
    boxes: DataFrame,
    tasks: int = DEFAULT_TASKS_PER_BOX,
    max_splits: int = DEFAULT_MAX_MAPS,
    factors: str = "intended",
) -> DataFrame:
    """Splits per box: proportional to its factor, scaled down together to ``max_splits``, at least one.

    Returns ``box_id, capacity, box_rank, n_splits, first_split``; a record per box.
    """
    table = SIZE_FACTORS[factors]
    ranked = collect_boxes(boxes)
    # An unsized box (capacity 2**63-1) finds its factor in the last, open-ended entry.
    factor = [next(f for bound, f in table if box.capacity <= bound) for box in ranked]
    ideal = sum(tasks * f for f in factor)
    scale = 1.0 if ideal <= max_splits else max_splits / ideal
    out, first = [], 0
    for box, f in zip(ranked, factor):
        n = max(1, int(float(tasks) * f * scale))
        out.append((box.box_id, box.capacity, box.rank, n, first))
        first += n
    schema = "box_id int, capacity bigint, box_rank int, n_splits int, first_split int"
    return small_table(boxes.sparkSession, out, schema)


FIRST_STEP, LAST_STEP = 1 << 8, 1 << 16


def fit_in_order(sizes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each size in turn, the first of the rooms ``left`` that holds it, -1 for none; the rooms shrink, but for unlimited ones.

    A stretch of rows is placed at once by the rooms at its begin, and holds up to the first row that its box has no room for
    any more, by the running sum of what the box took. Such a row is the first of the next stretch. Stretches
    grow while they hold, so steps go with the boxes that fill up rather than with the rows.
    """
    out = np.full(len(sizes), -1, np.int64)
    at, step = 0, FIRST_STEP
    while at < len(sizes):
        part = sizes[at : at + step]
        rising = np.flatnonzero(left > np.concatenate([[-1], np.maximum.accumulate(left)[:-1]]))
        limits = left[rising]
        tried = np.searchsorted(limits, part)
        good, taken = len(part), []
        for k in np.unique(tried[tried < len(limits)]):
            if limits[k] == UNLIMITED:
                continue
            mine = np.flatnonzero(tried == k)
            used = np.cumsum(part[mine])
            fits = int(np.searchsorted(used, limits[k], side="right"))
            if fits < len(mine):
                good = min(good, int(mine[fits]))
            taken.append((k, mine, used))
        for k, mine, used in taken:
            held = int(np.searchsorted(mine, good))
            left[rising[k]] -= used[held - 1] if held else 0
        some = tried[:good] < len(limits)
        out[at : at + good][some] = rising[tried[:good][some]]
        at += good
        step = min(2 * step, LAST_STEP) if good == len(part) else max(FIRST_STEP, step // 2)
    return out


def _walk_block(size: str, box_ids: list[int], rooms: list[int]):
    """Rows of one block, in order: each to the first box whose room, at that moment, holds it."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = np.array(rooms, dtype="int64")
        ids = np.array([*box_ids, 0])
        for pdf in batches:
            found = fit_in_order(pdf[size].to_numpy(dtype="int64"), left)
            yield pdf.assign(box_id=pd.Series(pd.array(ids[found], dtype="Int32"), index=pdf.index).mask(pd.Series(found < 0, index=pdf.index)))

    return walk


def _rising(limits: list[int]) -> list[tuple[int, int]]:
    """Box index and limit of the boxes that are first to hold some size: those above all before them."""
    out, top = [], -1
    for i, limit in enumerate(limits):
        if limit > top:
            out.append((i, limit))
            top = limit
    return out


def _one_class(block, rooms: list[int]) -> int | None:
    """The box that all rows of a block try first, -1 if none can hold any of them, None if they differ."""
    tried = next((i for i, room in enumerate(rooms) if block.low <= room), -1)
    return tried if tried < 0 or block.high <= rooms[tried] else None


def first_fit(
    df: DataFrame,
    boxes: DataFrame,
    *,
    order: str = "seq",
    size: str = "length",
    keep: tuple[str, ...] = (),
    previous: DataFrame | None = None,
    with_blocks: bool = False,
    **block_options,
) -> DataFrame:
    """Each row, in ``order``, goes to the first box (smallest first) that still has room; exact.

    Returns ``order, size, *keep, box_id``; ``box_id`` is null where no box had room. Null or
    negative sizes raise.

    Blocks are taken in bulk as far as possible. With the rooms at some block given, call *candidates* of
    a box the rows whose size is at most its room but above the rooms of all boxes before it. Rooms only
    shrink, so no box before it can take them; and while the candidates of every box sum up to no more than
    its room, each of them fits when its turn comes. So all blocks up to the first at which some sum
    exceeds its room are placed by comparing sizes with fixed limits, from sums per block and box. That
    one block is walked in stretches (``fit_in_order``) by a task that streams it, and bulk placement goes on after it with
    the rooms it left. Each round finishes at least a block, whatever the sizes are.

    ``previous`` (``order, box_id``) pins rows to boxes chosen by an earlier run; their size is deducted
    first. ``with_blocks`` keeps the block number as ``pid``, which spares ``balance`` to build blocks again;
    pinned rows have none, so it goes without ``previous``.
    """
    if with_blocks and previous is not None:
        raise InvalidInputError("with_blocks goes without previous")
    spark = df.sparkSession
    ranked = collect_boxes(boxes)
    columns = [order, size, *keep]
    pinned = None
    if previous is not None:
        known = previous.filter(F.col("box_id").isNotNull()).select(order, "box_id")
        pinned = cut(df.select(*columns).join(known, order), "pinned")
        used = {r.box_id: r.used for r in pinned.groupBy("box_id").agg(F.sum(size).alias("used")).collect()}
        ranked = [
            b if b.capacity == UNLIMITED else Box(b.box_id, max(0, b.capacity - used.get(b.box_id, 0)), b.rank)
            for b in ranked
        ]
        df = df.join(known.select(order), order, "left_anti")

    blocks = build_blocks(df.select(*columns), order, **block_options)
    stats = blocks.stats(size)
    box_ids, rooms = [b.box_id for b in ranked], [b.capacity for b in ranked]
    unlimited = [room == UNLIMITED for room in rooms]
    walked: list[str] = []
    rounds: list[list[int]] = []  # limits of each round, in box order
    round_of: list[tuple[int, int]] = []  # (pid, round) of blocks placed in bulk

    def scan(at: int, window: int) -> dict[int, dict[int, int]]:
        """Bytes of the candidates of each box in the next blocks that statistics do not decide."""
        wanted = [b.pid for b in stats[at : at + window] if _one_class(b, rooms) is None]
        rising = _rising(rooms)
        limits = F.array(*[F.lit(limit).cast("bigint") for _, limit in rising])
        rows = blocks.table.filter(F.col("pid").between(wanted[0], wanted[-1])).select("pid", size)
        tried = F.array_position(F.transform(limits, lambda r: F.col(size) <= r), True) - 1
        sums = rows.groupBy("pid", tried.alias("at")).agg(F.sum(size).alias("total"))
        out: dict[int, dict[int, int]] = {pid: {} for pid in wanted}
        for r in sums.collect():  # a number per block and box
            if r.pid in out and r["at"] >= 0:
                out[r.pid][rising[r["at"]][0]] = r.total
        return out

    at = 0
    while at < len(stats) and box_ids:
        limits, window, sums = list(rooms), SCAN_BLOCKS, {}
        rounds.append(limits)
        left = list(rooms)
        while at < len(stats):
            block = stats[at]
            only = _one_class(block, limits)
            if only is not None:
                need = {} if only < 0 else {only: block.total}
            else:
                if block.pid not in sums:
                    sums, window = scan(at, window), 2 * window
                need = sums[block.pid]
            if any(n > left[i] for i, n in need.items()):
                break
            for i, n in need.items():
                left[i] -= 0 if unlimited[i] else n
            round_of.append((block.pid, len(rounds) - 1))
            at += 1
        rooms = left
        if at == len(stats):
            break
        rows = blocks.table.filter(F.col("pid") == stats[at].pid).select("pid", *columns)
        in_order = rows.coalesce(1).sortWithinPartitions(order)
        schema = T.StructType([*rows.schema.fields, T.StructField("box_id", T.IntegerType())])
        taken = {f"b{i}": F.sum(F.when(F.col("box_id") == box_id, F.col(size))) for i, box_id in enumerate(box_ids)}
        path, seen = store(in_order.mapInPandas(_walk_block(size, box_ids, rooms), schema), "walked", **taken)
        walked.append(path)
        rooms = [r if unlimited[i] else r - (seen[f"b{i}"] or 0) for i, r in enumerate(rooms)]
        at += 1

    choices = [
        (n, [{"limit": limit, "box": box_ids[i]} for i, limit in _rising(limits)]) for n, limits in enumerate(rounds)
    ]
    bulk = (
        blocks.table.join(small_table(spark, round_of, "pid int, _round int"), "pid")
        .join(small_table(spark, choices, "_round int, _steps array<struct<limit:bigint,box:int>>"), "_round")
        .withColumn("_step", F.try_element_at(F.filter("_steps", lambda s: F.col(size) <= s["limit"]), F.lit(1)))
        .select("pid", *columns, F.col("_step.box").alias("box_id"))
    )
    if not box_ids:
        bulk = blocks.table.select("pid", *columns, F.lit(None).cast("int").alias("box_id"))
    placed = bulk
    if walked:
        placed = placed.unionByName(spark.read.schema(bulk.schema).parquet(*walked))
    if not with_blocks:
        placed = placed.drop("pid")
    return placed if pinned is None else placed.unionByName(pinned.select(*columns, "box_id"))
