"""Row filters over manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import lookup_table


def full_match(value: str | Column, pattern: str) -> Column:
    """Does the pattern match the whole value? Line breaks inside the value are part of it."""
    value = F.col(value) if isinstance(value, str) else value
    return value.rlike(rf"\A(?:{pattern})\z")


def exclude_paths(
    df: DataFrame, patterns: list[str] = (), *, path: str = "path", predicate: Column | None = None
) -> DataFrame:
    """Drop rows whose whole path matches any pattern, or for which ``predicate`` holds.

    Patterns stay separate: joined into one alternation, their back-references and flags would clash.
    """
    for pattern in patterns:
        df = df.filter(~full_match(path, pattern))
    return df if predicate is None else df.filter(~F.coalesce(predicate, F.lit(False)))


def suppress_roots(df: DataFrame, replace_content: bool, *, path: str = "path", root: str = "root") -> DataFrame:
    """Update and overwrite runs copy the content of a root directory, not the directory itself."""
    if not replace_content:
        return df
    return df.filter(~(F.col("is_dir") & (F.col(path) == F.col(root))))


def exclude_keys(df: DataFrame, keys: DataFrame, *, key: str = "path") -> DataFrame:
    """Drop rows whose key is listed in ``keys``."""
    return df.join(lookup_table(keys.select(key).distinct(), "excluded"), key, "left_anti")
