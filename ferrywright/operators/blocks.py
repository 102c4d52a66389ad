"""Ordered blocks: the base of every operator that depends on manifest order.

A global ``Window.orderBy`` would send all rows to one task. Instead the rows are range-partitioned on
the order column, every partition becomes a *block* of bounded size, and the blocked table is stored,
so that later passes see the same blocks and read only those they need. What crosses block borders is
a handful of numbers per block.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidInputError
from ..scratch import cut, cut_counted, small_table

BLOCK_ROWS = 1_000_000
MIN_BLOCK_ROWS = 100_000


@dataclass
class Blocks:
    """A stored table with a ``pid`` column that rises with ``order``; one directory per block."""

    table: DataFrame
    order: str
    rows: int
    _stats: dict = field(default_factory=dict)

    def stats(self, size: str) -> list:
        """Rows, bytes, smallest and largest size of each block, in order: one small record per block."""
        if size not in self._stats:
            rows = (
                self.table.groupBy("pid")
                .agg(
                    F.count("*").alias("n"),
                    F.count(size).alias("sized"),
                    F.sum(size).alias("total"),
                    F.min(size).alias("low"),
                    F.max(size).alias("high"),
                )
                .orderBy("pid")
                .collect()
            )
            if any(r.sized < r.n or r.low < 0 for r in rows):
                raise InvalidInputError(f"{size} must not be null or negative")
            self._stats[size] = rows
        return self._stats[size]

    def per_block(self, rows: list, schema: str) -> DataFrame:
        """A broadcastable frame with at most a few values per block."""
        return small_table(self.table.sparkSession, rows, f"pid int, {schema}")


def build_blocks(df: DataFrame, order: str, block_rows: int | None = None, min_blocks: int = 1) -> Blocks:
    """Store ``df`` as blocks of rows that follow each other in ``order``, whose values must be unique.

    By default a block has at most about ``BLOCK_ROWS`` rows, and there are as many blocks as the cluster
    runs tasks unless they would get smaller than ``MIN_BLOCK_ROWS``.
    """
    narrow, rows = cut_counted(df, "unordered")
    if block_rows:
        n_blocks = -(-rows // block_rows)
    else:
        spread = min(df.sparkSession.sparkContext.defaultParallelism, rows // MIN_BLOCK_ROWS)
        n_blocks = max(-(-rows // BLOCK_ROWS), spread)
    n_blocks = max(n_blocks, min(min_blocks, rows))
    if n_blocks <= 1:
        tagged = narrow.withColumn("pid", F.lit(0))
    else:
        tagged = narrow.repartitionByRange(n_blocks, order).withColumn("pid", F.spark_partition_id())
    return Blocks(cut(tagged, "blocks", partition_by=["pid"]), order, rows)


def index_blocks(blocks: Blocks, name: str = "idx") -> DataFrame:
    """Rows of a blocked table with their 0-based position in its order."""
    counts = blocks.table.groupBy("pid").agg(F.count("*").alias("n")).orderBy("pid").collect()
    start, offsets = 0, []
    for row in counts:
        offsets.append((row["pid"], start))
        start += row["n"]
    inside = Window.partitionBy("pid").orderBy(blocks.order)
    return (
        blocks.table.withColumn("_rn", F.row_number().over(inside))
        .join(blocks.per_block(offsets, "_start bigint"), "pid")
        .withColumn(name, F.col("_start") + F.col("_rn") - F.lit(1))
        .drop("pid", "_rn", "_start")
    )


def with_index(df: DataFrame, order: str, name: str = "idx", **block_options) -> DataFrame:
    """Add the 0-based position of each row in ``order``; options as for ``build_blocks``."""
    return index_blocks(build_blocks(df, order, **block_options), name)


def running_total(df: DataFrame, order: str, size: str, name: str, **block_options) -> DataFrame:
    """Add the inclusive running sum of ``size`` in ``order``."""
    blocks = build_blocks(df, order, **block_options)
    start, offsets = 0, []
    for row in blocks.stats(size):
        offsets.append((row["pid"], start))
        start += row["total"]
    inside = Window.partitionBy("pid").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total: Column = F.sum(size).over(inside) + F.col("_start")
    return (
        blocks.table.join(blocks.per_block(offsets, "_start bigint"), "pid").withColumn(name, total).drop("pid", "_start")
    )
