"""Path patterns, list files and filter files."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidInputError
from ..operators.filters import full_match
from ..scratch import BROADCAST_ROWS, cut, small_table


def glob_to_regex(glob: str) -> str:
    """File-system glob (``* ? [..] {a,b} \\x``) to a regular expression; ``*`` and ``?`` stop at ``/``."""
    out, depth, i = [], 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[":
            close = glob.find("]", i + 2)
            if close < 0:
                raise InvalidInputError(f"Unclosed [ in {glob}")
            body = glob[i + 1 : close]
            negated = body[0] in "^!"
            out.append("[" + ("^" if negated else "") + body[negated:].replace("\\", "\\\\").replace("[", "\\[") + "]")
            i = close
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        elif c == "\\" and i + 1 < len(glob):
            i += 1
            out.append(re.escape(glob[i]))
        else:
            out.append(re.escape(c))
        i += 1
    if depth:
        raise InvalidInputError(f"Unclosed {{ in {glob}")
    return "".join(out)


def expand_braces(glob: str) -> list[str]:
    """The patterns without ``{}`` that a pattern stands for; alternatives may contain ``/``."""
    depth, begin, commas, i = 0, -1, [], 0
    while i < len(glob):
        c = glob[i]
        if c == "\\":
            i += 1
        elif c == "{":
            depth += 1
            if depth == 1:
                begin = i
        elif c == "," and depth == 1:
            commas.append(i)
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                marks = [begin, *commas, i]
                parts = [glob[a + 1 : b] for a, b in zip(marks, marks[1:])]
                return [e for part in parts for e in expand_braces(glob[:begin] + part + glob[i + 1 :])]
        i += 1
    if depth:
        raise InvalidInputError(f"Unclosed {{ in {glob}")
    return [glob]


def take_fixed(components: list[str]) -> tuple[str, list[str]]:
    """Leading components without wildcards, as one path suffix, and the others."""
    n = next((i for i, c in enumerate(components) if re.search(r"[*?\[\\]", c)), len(components))
    return "".join(f"/{c}" for c in components[:n]), components[n:]


def split_fixed(glob: str) -> tuple[str, list[str]]:
    """The directory a brace-free pattern starts from, and the components to match below it."""
    scheme = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", glob)
    base = scheme.group(0) if scheme else ""
    fixed, rest = take_fixed([c for c in glob[len(base) :].split("/") if c])
    return base + (fixed or "/"), rest


def match_globs(df: DataFrame, globs: list[str], path: str = "path") -> DataFrame:
    """``glob, path`` for every row and every pattern it matches.

    The patterns are expressions of one pass over the rows: no join, and rows without a match are dropped
    where they are read.
    """
    if not globs:
        raise InvalidInputError("Nothing to process: no source paths")
    hits = F.array(*[F.when(full_match(path, glob_to_regex(g)), F.lit(g)) for g in dict.fromkeys(globs)])
    return df.withColumn("glob", F.explode(F.array_compact(hits)))


def unmatched_globs(df: DataFrame, globs: list[str], path: str = "path") -> DataFrame:
    """``glob`` of patterns that match no row."""
    hits = match_globs(df.select(path), globs, path).select("glob").distinct()
    wanted = small_table(df.sparkSession, [(g,) for g in dict.fromkeys(globs)], "glob string")
    return wanted.join(hits, "glob", "left_anti")


def expand_globs(df: DataFrame, globs: list[str], path: str = "path") -> DataFrame:
    """Rows matched by the patterns, once per matching pattern; a pattern without a match raises."""
    lost = unmatched_globs(df, globs, path).first()
    if lost is not None:
        raise InvalidInputError(f"{lost.glob} doesn't exist")
    return match_globs(df, globs, path)


def fixed_prefix(regex: str) -> str:
    """What every path matching the whole ``regex`` begins with; ``''`` if nothing is certain."""
    if "|" in regex:
        return ""
    out, i = "", 0
    while i < len(regex):
        c, width = regex[i], 1
        if c == "\\" and i + 1 < len(regex) and not regex[i + 1].isalnum():
            c, width = regex[i + 1], 2
        elif c in "\\.^$*+?{}[]()":
            break
        if i + width < len(regex) and regex[i + width] in "*+?{":
            break
        out += c
        i += width
    return out


def pattern_index(patterns: DataFrame, column: str = "glob", globs: bool = True) -> DataFrame:
    """``column, regex, base`` of a table of patterns, stored: what a path has to match, and what it has to begin with.

    A pattern with braces has a row per alternative. Patterns are translated by tasks, so their number isn't limited by the driver.
    """

    def index(batches):
        for pdf in batches:
            rows = []
            for pattern in pdf[column]:
                for regex in [glob_to_regex(g) for g in expand_braces(pattern)] if globs else [pattern]:
                    rows.append((pattern, rf"\A(?:{regex})\z", fixed_prefix(regex)))
            yield pd.DataFrame(rows, columns=[column, "regex", "base"])

    wanted = patterns.select(column).distinct()
    return cut(wanted.mapInPandas(index, f"`{column}` string, regex string, base string"), "patterns")


def match_many(df: DataFrame, index: DataFrame, path: str = "path", column: str = "glob", salts: int = 16) -> DataFrame:
    """``column, path`` for every path of ``df`` and every pattern of a ``pattern_index`` it matches, once each.

    A path meets only the patterns whose fixed beginning (up to the first wildcard, within a name, too) it has, by a hash join on that
    beginning, so the work goes with those and not with all patterns of a directory. At most ``BROADCAST_ROWS`` patterns go to all tasks; of
    more, paths of one hot beginning are dealt over ``salts`` parts.
    """
    counts = index.groupBy(F.length("base").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy("n").collect()  # no more than a path is long
    few = sum(r.rows for r in counts) <= BROADCAST_ROWS
    salts = 1 if few else salts
    each = F.explode(F.array([F.lit(r.n) for r in counts]).cast("array<int>")).alias("_n")
    rows = df.select(F.col(path).alias("_path"), F.pmod(F.xxhash64(path), F.lit(salts)).alias("_salt"), each)
    rows = rows.filter(F.col("_n") <= F.length("_path"))
    rows = rows.select("_path", "_salt", F.xxhash64(F.substring("_path", F.lit(1), F.col("_n"))).alias("_key"))
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt")
    spread = index.select(column, "regex", F.xxhash64("base").alias("_key"), salt)
    spread = F.broadcast(spread) if few else spread.hint("merge")  # its stored size doesn't tell that of its copies
    met = rows.join(spread, ["_key", "_salt"]).filter(F.regexp("_path", F.col("regex")))  # this tells equal hashes apart, too
    return met.select(column, F.col("_path").alias(path)).distinct()


def exclude_many(df: DataFrame, index: DataFrame, path: str = "path", column: str = "glob") -> DataFrame:
    """Rows of ``df`` whose path no pattern of the index matches."""
    return df.join(match_many(df.select(path).distinct(), index, path, column).select(path).distinct(), path, "left_anti")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", r"\r$", "").alias("line"))


def read_list_file(spark: SparkSession, path: str) -> DataFrame:
    """``path`` per line of a UTF-8 list of sources, each of which may be a pattern."""
    return _lines(spark, path).select(F.col("line").alias("path"))


def read_filters(spark: SparkSession, path: str) -> list[str]:
    """Patterns of a filter file, one per line; a missing file raises. The file is written by hand; for
    files of any length use ``read_list_file`` with ``pattern_index`` and ``exclude_many``."""
    return [r.line for r in _lines(spark, path).collect()]
