"""Totals, counters and checks over manifests and copy results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DuplicateTargetError
from ..functions.paths import file_system, size_to_copy
from ..functions.values import bytes_per_second, int_div
from ..scratch import lookup_table


def _sum(value) -> F.Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def totals(df: DataFrame) -> DataFrame:
    """One row: bytes of all files, paths, directories."""
    size = size_to_copy() if "chunk_length" in df.columns else F.col("length")
    return df.agg(
        _sum(F.when(~F.col("is_dir"), size)).alias("bytes"),
        F.count("*").alias("paths"),
        F.count_if("is_dir").alias("dirs"),
    )


def counters(result: DataFrame) -> DataFrame:
    """One row of run counters from ``action, status, length, bytes_copied``.

    A planned result without status and copied bytes is counted as if it went well.
    """
    ok = F.col("status") == "OK" if "status" in result.columns else F.col("action") != "CONFLICT"
    copied = F.col("bytes_copied") if "bytes_copied" in result.columns else F.when(
        F.col("action") == "APPEND", F.col("length") - F.col("tgt_length")
    ).otherwise(F.col("length"))
    is_copy = ok & F.col("action").isin("APPEND", "OVERWRITE")
    skipped = ok & (F.col("action") == "SKIP")
    return result.agg(
        F.count_if(is_copy).alias("copy"),
        F.count_if(ok & (F.col("action") == "MKDIR")).alias("dir_copy"),
        F.count_if(skipped).alias("skip"),
        F.count_if(~ok).alias("fail"),
        _sum(F.when(is_copy, copied)).alias("bytes_copied"),
        _sum(F.when(is_copy, F.col("length"))).alias("bytes_expected"),
        _sum(F.when(~ok, F.col("length"))).alias("bytes_failed"),
        _sum(F.when(skipped, F.col("length"))).alias("bytes_skipped"),
    )


def duplicate_keys(df: DataFrame, key: str = "rel_path") -> DataFrame:
    """``key, copies`` of keys that several rows map to: counts, taken before the shuffle by a hash table."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def duplicates(df: DataFrame, key: str = "rel_path", path: str = "path") -> DataFrame:
    """Keys that several rows map to, with their number and the first and last path.

    Smallest and largest strings need sorted aggregation, so they are taken of the rows of repeated keys
    only. Their state is of constant size: a key that a third of all rows share costs no more than others.
    """
    repeated = lookup_table(duplicate_keys(df, key), "duplicates")
    rows = df.select(key, path).join(repeated, key)
    return rows.groupBy(key, "copies").agg(F.min(path).alias("first_path"), F.max(path).alias("last_path"))


def assert_unique(df: DataFrame, key: str = "rel_path", path: str = "path") -> DataFrame:
    clash = duplicate_keys(df, key).first()
    if clash is not None:
        first, last = df.filter(F.col(key) == clash[key]).agg(F.min(path), F.max(path)).first()
        raise DuplicateTargetError(f"{first} and {last} would cause duplicates")
    return df


def distinct_filesystems(df: DataFrame, path: str = "path") -> DataFrame:
    """Scheme and authority of every file system that occurs; each needs one capability check."""
    return df.select(file_system(path).alias("file_system")).distinct()


def placement_report(placed: DataFrame, plan: DataFrame, size: str = "length") -> DataFrame:
    """Records, bytes and space left of each split, of each box (``split_id`` null) and in all (both null).

    The space of a split is its share of the box. Rows without a box are left out; unsized boxes have no
    space figure.
    """
    used = (
        placed.filter(F.col("box_id").isNotNull())
        .groupBy("box_id", "split_id")
        .agg(F.count("*").alias("records"), F.sum(size).alias("bytes"))
    )
    splits = plan.select(
        "box_id",
        F.explode(F.sequence(F.col("first_split"), F.col("first_split") + F.col("n_splits") - 1)).alias("split_id"),
        F.when(F.col("capacity") < F.lit(2**63 - 1), F.col("capacity")).alias("capacity"),
        F.col("n_splits"),
        "first_split",
    )
    # From here on there is one record per split.
    per_split = splits.join(F.broadcast(used), ["box_id", "split_id"], "left").select(
        "box_id",
        "split_id",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        int_div("capacity", "n_splits").alias("share"),
        F.when(F.col("split_id") == F.col("first_split"), F.col("capacity")).alias("capacity"),
    )
    level = F.grouping_id()
    return (
        per_split.rollup("box_id", "split_id")
        .agg(
            F.sum("records").cast("bigint").alias("records"),
            F.sum("bytes").cast("bigint").alias("bytes"),
            (F.when(level == 0, F.sum("share")).otherwise(F.sum("capacity")) - F.sum("bytes")).cast("bigint").alias(
                "space_left"
            ),
        )
    )


def throughput_report(result: DataFrame, by: str = "split_id") -> DataFrame:
    """Bytes, elapsed milliseconds and bytes per whole second of each ``by`` from timed copy results."""
    grouped = result.groupBy(by).agg(
        _sum("bytes_copied").alias("bytes"), (F.max("finished_ms") - F.min("started_ms")).alias("elapsed_ms")
    )
    return grouped.withColumn("bytes_per_sec", bytes_per_second("bytes", "elapsed_ms"))
