"""Text reports of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import skip_line


def skipped_report(placed: DataFrame, failed: DataFrame | None = None, path: str = "path", line_format: str | None = None) -> DataFrame:
    """``line`` for each row without a box, and for each failed one of a copy result."""
    unplaced = placed.filter(F.col("box_id").isNull())
    lines = unplaced.select((skip_line(path, line_format) if line_format else skip_line(path)).alias("line"))
    if failed is None:
        return lines
    return lines.unionByName(failed.select(F.concat_ws(" - ", "path", "error").alias("line")))


def action_log(result: DataFrame, verbose: bool = False) -> DataFrame:
    """``line`` of each logged row: skips and failures, and with ``verbose`` the sizes of skips and copies."""
    tgt = F.coalesce(F.col("tgt_length"), F.lit(0)).cast("string")
    sizes = F.concat(
        F.lit("source="), "path", F.lit(", size="), F.col("length").cast("string"),
        F.lit(" --> target="), "target_uri", F.lit(", size="), tgt,
    )
    failed = F.col("status") == "FAIL"
    skipped = ~failed & (F.col("action") == "SKIP")
    copied = ~failed & F.col("action").isin("APPEND", "OVERWRITE")
    lines = [
        F.when(skipped, F.concat(F.lit("SKIP: "), "path")),
        F.when(failed, F.concat(F.lit("FAIL: "), "path", F.lit(" - "), F.coalesce("error", F.lit("")))),
    ]
    if verbose:
        lines += [
            F.when(skipped, F.concat(F.lit("FILE_SKIPPED: "), sizes)),
            F.when(copied, F.concat(F.lit("FILE_COPIED: "), sizes)),
        ]
    return result.select("rel_path", "action", F.explode(F.array_compact(F.array(*lines))).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def write_action_log(result: DataFrame, path: str, verbose: bool = False) -> None:
    """The log as text, one folder per action."""
    action_log(result, verbose).select("action", F.col("line").alias("value")).write.mode("overwrite").partitionBy(
        "action"
    ).text(path)
