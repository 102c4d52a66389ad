"""Order of manifests, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import with_index


def union_manifests(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_manifest(df: DataFrame, key: str = "rel_path") -> DataFrame:
    """Range-partitioned sort by key."""
    return df.orderBy(key)


def number_rows(df: DataFrame, order: str = "rel_path", name: str = "seq", **block_options) -> DataFrame:
    """Give rows their 0-based position in ``order``, which must be unique."""
    return with_index(df.drop(name), order, name, **block_options)


def randomize(
    df: DataFrame, seed: int, *, path: str = "path", name: str = "seq", **block_options
) -> DataFrame:
    """Number rows in a random order that depends only on ``seed`` and the paths.

    Neighbouring paths end up far apart, so no part of the store becomes a hot spot; a re-run gives the
    same order, so placements are repeatable.
    """
    shuffled = df.drop(name).withColumn("_order", F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col(path))), F.col(path)))
    return with_index(shuffled, "_order", name, **block_options).drop("_order")
