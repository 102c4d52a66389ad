"""Choice of how rows become splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInputError
from ..options import SyncOptions
from . import place, splits


def assign_splits(
    df: DataFrame,
    strategy: str = "first_fit",
    *,
    boxes: DataFrame | None = None,
    tasks_per_box: int | None = None,
    max_maps: int | None = None,
    options: SyncOptions | None = None,
    order: str = "seq",
    size: str = "length",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``split_id`` by one of three strategies.

    ``first_fit`` places rows on ``boxes`` and balances each box over its splits; rows without a box have
    null ``box_id`` and ``split_id``. ``uniform`` cuts the manifest into ranges of equal bytes, ``dynamic``
    deals it into small chunks for workers to pick up. ``max_maps`` and ``tasks_per_box`` are those of ``options`` unless given.
    """
    options = options or SyncOptions()
    max_maps = options.max_maps if max_maps is None else max_maps
    tasks_per_box = options.tasks_per_box if tasks_per_box is None else tasks_per_box
    if strategy == "uniform":
        return splits.uniform_split(df, max_maps, order=order, size=size, keep=keep)
    if strategy == "dynamic":
        dealt = splits.deal_chunks(df, max_maps, order=order, keep=(size, *keep))
        return dealt.withColumnRenamed("chunk_id", "split_id").drop("idx")
    if strategy != "first_fit" or boxes is None:
        raise InvalidInputError(f"Unknown strategy {strategy!r}, or first_fit without boxes")
    plan = place.plan_splits(boxes, tasks_per_box, max_maps)
    placed = place.first_fit(df, boxes, order=order, size=size, keep=keep, with_blocks=True)
    unplaced = placed.filter(F.col("box_id").isNull()).drop("pid").withColumn("split_id", F.lit(None).cast("int"))
    return splits.balance(placed, plan, order=order, size=size, keep=keep).unionByName(unplaced)
