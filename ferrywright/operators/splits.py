"""Division of manifest rows into splits, chunks and byte ranges."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidInputError
from ..functions.values import int_div
from ..options import MAX_CHUNKS_TOLERABLE, check_chunk_count, split_ratio
from ..scratch import small_table
from .blocks import build_blocks, index_blocks

# Fixed value: chunks that are filled side by side.
CHUNK_BATCH = 16


def uniform_split(
    df: DataFrame,
    n: int,
    *,
    order: str = "seq",
    size: str = "chunk_length",
    total: int | None = None,
    keep: tuple[str, ...] = (),
    **block_options,
) -> DataFrame:
    """Contiguous splits of about ``total / n`` bytes: a row that would exceed the limit opens the next one.

    Returns ``order, size, *keep, split_id``. ``total`` is the byte count the limit is derived from, by
    default the sum of ``size``. Blocks in which no split starts are passed by their byte total; in the
    others the starts are found by a task that streams that block, and only they come back.
    """
    if n < 1:
        raise InvalidInputError("n must be positive")
    blocks = build_blocks(df.select(order, size, *keep), order, **block_options)
    stats = blocks.stats(size)
    total = sum(r.total for r in stats) if total is None else total
    limit = -(-total // n)
    order_type = blocks.table.schema[order].dataType
    found_schema = T.StructType(
        [
            T.StructField("batch", T.IntegerType()),
            T.StructField("starts", T.ArrayType(order_type)),
            T.StructField("open_bytes", T.LongType()),
        ]
    )

    def find_starts(opened: int, at_begin: bool):
        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            open_bytes = opened
            for number, pdf in enumerate(batches):
                sizes = pdf[size].to_numpy(dtype="int64")
                upto = np.cumsum(sizes)
                starts, at = [], 0
                if at_begin and number == 0:
                    open_bytes, upto, at = int(sizes[0]), upto - sizes[0], 1
                # ``base``: running total at which the open split began; it holds ``open_bytes`` already.
                base = -open_bytes
                while (at := max(int(np.searchsorted(upto, base + limit, side="right")), at)) < len(upto):
                    starts.append(at)
                    base = int(upto[at]) - int(sizes[at])
                    at += 1
                open_bytes = int(upto[-1]) - base
                found = pdf[order].iloc[starts].tolist()
                yield pd.DataFrame({"batch": [number], "starts": [found], "open_bytes": [open_bytes]})

        return find

    opened, base_id, per_block = 0, 0, []
    for i, block in enumerate(stats):
        starts = []
        if opened + block.total > limit:
            rows = blocks.table.filter(F.col("pid") == block.pid).select(order, size)
            in_order = rows.coalesce(1).sortWithinPartitions(order)
            # Only starts come back: there are at most about two per split in all.
            found = sorted(in_order.mapInPandas(find_starts(opened, i == 0), found_schema).collect())
            starts, opened = [s for r in found for s in r.starts], found[-1].open_bytes
        else:
            opened += block.total
        per_block.append((block.pid, base_id, starts))
        base_id += len(starts)

    starts_schema = T.StructType(
        [
            T.StructField("pid", T.IntegerType()),
            T.StructField("_base", T.IntegerType()),
            T.StructField("_starts", T.ArrayType(order_type)),
        ]
    )
    small = small_table(df.sparkSession, per_block, starts_schema)
    inside = F.size(F.filter("_starts", lambda s: s <= F.col(order)))
    return blocks.table.join(small, "pid").select(order, size, *keep, (F.col("_base") + inside).alias("split_id"))


def deal_chunks(
    df: DataFrame,
    maps: int,
    ratio: int | None = None,
    *,
    order: str = "seq",
    keep: tuple[str, ...] = (),
    tolerable: int = MAX_CHUNKS_TOLERABLE,
    **block_options,
) -> DataFrame:
    """Deal rows round robin over chunks, a batch of 16 chunks at a time; the last batch takes the remainder.

    Returns ``order, *keep, idx, chunk_id``; the chunk follows from the position of a row. More than ``tolerable`` chunks raise.
    """
    blocks = build_blocks(df.select(order, *keep), order, **block_options)
    records = blocks.rows
    ratio = split_ratio(maps, records) if ratio is None else ratio
    check_chunk_count(ratio, maps, tolerable)
    entries = max(1, -(-records // (ratio * maps)))
    chunks = max(1, -(-records // entries))
    full_batches = max(0, chunks // CHUNK_BATCH - 1)
    per_batch = CHUNK_BATCH * entries
    last_first = CHUNK_BATCH * full_batches
    i = F.col("idx")
    batch = int_div("idx", per_batch)
    early = batch * CHUNK_BATCH + (i - batch * per_batch) % CHUNK_BATCH
    late = F.lit(last_first) + (i - F.lit(full_batches * per_batch)) % F.lit(chunks - last_first)
    return index_blocks(blocks).withColumn("chunk_id", F.when(i < full_batches * per_batch, early).otherwise(late).cast("int"))


def chunk_files(df: DataFrame, chunk_bytes: int, *, length: str = "length") -> DataFrame:
    """One row per byte range of at most ``chunk_bytes``; an empty file or a directory stays one row."""
    if chunk_bytes < 1:
        raise InvalidInputError("chunk_bytes must be positive")
    last = F.greatest(F.col(length), F.lit(1).cast("bigint")) - 1
    step = F.lit(chunk_bytes).cast("bigint")
    return df.withColumn("chunk_offset", F.explode(F.sequence(F.lit(0).cast("bigint"), last, step))).withColumn(
        "chunk_length", F.least(step, F.col(length) - F.col("chunk_offset"))
    )


def part_coverage(files: DataFrame, parts: DataFrame, key: str = "path") -> DataFrame:
    """``key, verdict, at, parts`` per file: do its parts (``key, chunk_offset, chunk_length``) make up its ``length``?

    MISSING (no part), REPEATED (one range twice), OVERLAP, GAP, BEYOND (parts go on after its end) or OK; ``at`` is the byte at which the first such
    fault, in this order, is seen. A file's parts are followed in order of their offsets.
    """
    own = parts.select(key, "chunk_offset", "chunk_length", (F.col("chunk_offset") + F.col("chunk_length")).alias("_end"))
    order = Window.partitionBy(key).orderBy("chunk_offset", "chunk_length")
    upto = F.coalesce(F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    again = F.struct("chunk_offset", "chunk_length").eqNullSafe(F.lag(F.struct("chunk_offset", "chunk_length")).over(order))
    rows = own.withColumn("_upto", upto).withColumn("_again", again)
    first = lambda test, at: F.min(F.when(test, at))
    seen = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("parts"),
        F.max("_end").alias("_last"),
        first(F.col("_again") & (F.col("chunk_length") > 0), F.col("chunk_offset")).alias("_repeated"),
        first(~F.col("_again") & (F.col("chunk_offset") < F.col("_upto")), F.col("chunk_offset")).alias("_overlap"),
        first(F.col("chunk_offset") > F.col("_upto"), F.col("_upto")).alias("_gap"),
    )
    both = files.select(key, "length").join(seen, key, "left")
    short = F.when(F.col("_last") < F.col("length"), F.col("_last"))
    faults = {"REPEATED": F.col("_repeated"), "OVERLAP": F.col("_overlap"), "GAP": F.coalesce("_gap", short)}
    faults["BEYOND"] = F.when(F.col("_last") > F.col("length"), F.col("length"))
    verdict, at = F.when(F.col("parts").isNull(), "MISSING"), F.when(F.col("parts").isNull(), F.lit(0))
    for name, where in faults.items():
        verdict, at = verdict.when(where.isNotNull(), name), at.when(where.isNotNull(), where)
    return both.select(key, verdict.otherwise("OK").alias("verdict"), at.cast("bigint").alias("at"), F.coalesce("parts", F.lit(0)).cast("bigint").alias("parts"))


def merged_ranges(parts: DataFrame, key: str = "path") -> DataFrame:
    """``key, first_byte, end_byte, parts``: the stretches without a gap that parts make up together."""
    own = parts.select(key, "chunk_offset", (F.col("chunk_offset") + F.col("chunk_length")).alias("_end"))
    order = Window.partitionBy(key).orderBy("chunk_offset", "_end")
    before = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = own.withColumn("_new", F.coalesce((F.col("chunk_offset") > before).cast("int"), F.lit(1)))
    rows = rows.withColumn("_range", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(key, "_range").agg(
        F.min("chunk_offset").alias("first_byte"), F.max("_end").alias("end_byte"), F.count(F.lit(1)).alias("parts")
    ).drop("_range")


PHASES = "array<struct<start:bigint,rows:bigint,cycle:array<int>>>"


class _SplitLoads:
    """Splits of one box, least load first; the split loaded last precedes those with equal load."""

    def __init__(self, n: int):
        self.ids = list(range(n))
        self.loads = [0] * n

    def load(self, x: int) -> int:
        """Give one row of size ``x`` to the first split and restore the order, found by bisection."""
        split, load = self.ids.pop(0), self.loads.pop(0) + x
        at = bisect_left(self.loads, load)
        self.ids.insert(at, split)
        self.loads.insert(at, load)
        return split

    def run(self, x: int, count: int) -> list[tuple[int, int, list[int]]]:
        """Give ``count`` rows of equal size; the answer is a few repeating patterns, not a list of rows.

        The first ``m`` splits are those that lie less than one row apart. They are loaded in turn, and
        after two turns (one reverses ties, the next restores them) their order is as before, as long as
        none of them falls below the split after them.
        """
        phases, done, single = [], 0, []

        def flush():
            if single:
                phases.append((done - len(single), len(single), list(single)))
                single.clear()

        while done < count:
            if x == 0:
                flush()
                phases.append((done, count - done, [self.ids[0]]))
                return phases
            m = bisect_left(self.loads, self.loads[0] + x)
            turns = (count - done) // (2 * m)
            if turns and m < len(self.ids):
                turns = min(turns, (self.loads[m] - self.loads[m - 1]) // (2 * x))
            if turns > 1:
                flush()
                cycle = [self.load(x) for _ in range(2 * m)]
                for i in range(m):
                    self.loads[i] += 2 * x * (turns - 1)
                phases.append((done, 2 * m * turns, cycle))
                done += 2 * m * turns
            else:
                single.append(self.load(x))
                done += 1
        flush()
        return phases


def _lpt_phases(n_splits: dict[int, int]):
    """Stream (box, size, rows) runs, largest size first; the state is one number per split.

    A run of one row gets its split, longer ones get their patterns.
    """

    def phases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        box, loads = None, None
        for pdf in batches:
            single, patterns = [], []
            for box_id, size, rows in zip(pdf["box_id"].tolist(), pdf["_size"].tolist(), pdf["_rows"].tolist()):
                if box_id != box:
                    box, loads = box_id, _SplitLoads(n_splits[box_id])
                if rows == 1:
                    single.append(loads.load(size))
                    patterns.append(None)
                else:
                    single.append(None)
                    patterns.append([{"start": s, "rows": r, "cycle": c} for s, r, c in loads.run(size, rows)])
            yield pdf[["box_id", "_size"]].assign(_split=pd.array(single, dtype="Int32"), _phases=patterns)

    return phases


def balance(
    df: DataFrame,
    plan: DataFrame,
    *,
    order: str = "seq",
    size: str = "length",
    keep: tuple[str, ...] = (),
    **block_options,
) -> DataFrame:
    """Spread the rows of each box over its splits: largest first, each to the split with most space; exact.

    ``plan`` is the result of ``plan_splits``. Returns ``order, size, *keep, box_id, split_id`` for rows
    that have a box.

    Largest-first scheduling is sequential by nature, but only sizes matter to it. So the rows are first
    counted by (box, size), which Spark does before any shuffle; the sequential part streams these
    counts, a run of equal sizes in one step, and answers with repeating patterns. Each row then finds
    its split from its rank among the rows of its box and size. Ranks are taken inside blocks and moved
    by the counts of earlier blocks, so a size that a third of all rows share is still spread. Blocks that
    ``first_fit`` left in ``pid`` are used again.
    """
    splits = {r.box_id: (r.n_splits, r.first_split) for r in plan.collect()}  # a record per box
    n_splits = {box_id: n for box_id, (n, _) in splits.items()}
    blocked = ["pid"] if "pid" in df.columns else []
    rows = df.filter(F.col("box_id").isNotNull()).select(*blocked, order, F.col(size).alias("_size"), *keep, "box_id")
    table = rows if blocked else build_blocks(rows, order, **block_options).table

    counts = table.groupBy("pid", "box_id", "_size").agg(F.count("*").alias("_rows"))
    runs = counts.groupBy("box_id", "_size").agg(F.sum("_rows").alias("_rows"))
    # A task per box; ``mapInPandas`` reads its partition as sorted here, batch by batch.
    rank = small_table(df.sparkSession, [(b, i) for i, b in enumerate(splits)], "box_id int, _rank int")
    dealt = runs.join(rank, "box_id").repartitionById(max(1, len(splits)), "_rank")
    sequence = dealt.sortWithinPartitions("box_id", F.desc("_size"))
    phases = sequence.mapInPandas(_lpt_phases(n_splits), f"box_id int, _size bigint, _split int, _phases {PHASES}")

    earlier = Window.partitionBy("box_id", "_size").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    lookup = (
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
        .join(phases, ["box_id", "_size"])
    )
    inside = Window.partitionBy("pid", "box_id", "_size").orderBy(order)
    position = F.col("_before") + F.col("_rn") - 1
    phase = F.try_element_at(
        F.filter("_phases", lambda p: (p["start"] <= F.col("_pos")) & (F.col("_pos") < p["start"] + p["rows"])), F.lit(1)
    )
    cycle = F.col("_phase")["cycle"]
    local = F.element_at(cycle, ((F.col("_pos") - F.col("_phase")["start"]) % F.size(cycle)).cast("int") + 1)
    first = small_table(df.sparkSession, [(b, f) for b, (_, f) in splits.items()], "box_id int, _first int")
    return (
        table.withColumn("_rn", F.row_number().over(inside))
        .join(lookup, ["pid", "box_id", "_size"])
        .withColumn("_pos", position)
        .withColumn("_phase", phase)
        .join(first, "box_id")
        .withColumn("split_id", F.col("_first") + F.coalesce("_split", local))
        .select(order, F.col("_size").alias(size), *keep, "box_id", "split_id")
    )
