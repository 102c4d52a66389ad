"""Listing of file trees by tasks, level by level."""

from __future__ import annotations

import os
import re
import stat
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidInputError, MigrationError
from ..files import local_path, open_fs, qualified
from ..functions.paths import qualify, relative_path, source_root, uri_path
from ..operators.filters import suppress_roots
from ..scratch import default_fs, lookup_table, store
from .patterns import expand_braces, glob_to_regex, split_fixed, take_fixed

# Retries per directory and the first pause between them, doubled each time.
MAX_RETRIES = 3
FIRST_PAUSE_SEC = 2.0
BATCH_ROWS = 5_000

FOUND = (
    "root string, path string, is_dir boolean, length bigint, mtime bigint, atime bigint, perm int, sticky boolean, "
    "owner string, `group` string, error string, reading string, void boolean"
)
COLUMNS = ["root", "path", "is_dir", "length", "mtime", "atime", "perm", "sticky", "owner", "group", "error", "reading", "void"]


def _names():
    """Owner and group names of numeric ids, with the id as a fallback."""
    import grp
    import pwd
    from functools import cache

    @cache
    def user(n):
        try:
            return pwd.getpwuid(n).pw_name
        except KeyError:
            return str(n)

    @cache
    def group(n):
        try:
            return grp.getgrgid(n).gr_name
        except KeyError:
            return str(n)

    return user, group


def _local_row(root, path, info, user, group):
    is_dir = stat.S_ISDIR(info.st_mode)
    return (
        root,
        path,
        is_dir,
        0 if is_dir else info.st_size,
        info.st_mtime_ns // 1_000_000,
        info.st_atime_ns // 1_000_000,
        stat.S_IMODE(info.st_mode) & 0o777,
        bool(info.st_mode & stat.S_ISVTX),
        user(info.st_uid),
        group(info.st_gid),
        None,
    )


def _entries(root: str, path: str, only_self: bool) -> Iterator[tuple]:
    """Status rows of one path or of its children, from a mounted or a remote file system."""
    local = local_path(path)
    if local is not None:
        user, group = _names()
        if only_self:
            yield _local_row(root, path, os.stat(local), user, group)
            return
        with os.scandir(local) as found:
            for entry in found:
                try:
                    info = entry.stat()
                except FileNotFoundError:  # deleted meanwhile, or a link to nothing
                    continue
                yield _local_row(root, f"{path.rstrip('/')}/{entry.name}", info, user, group)
        return
    from pyarrow import fs

    store, name = open_fs(path)
    infos = [store.get_file_info(name)] if only_self else store.get_file_info(fs.FileSelector(name))
    for info in infos:
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        is_dir = info.type == fs.FileType.Directory
        full = path if only_self else f"{path.rstrip('/')}/{info.base_name}"
        mtime = None if info.mtime_ns is None else info.mtime_ns // 1_000_000
        yield (root, full, is_dir, 0 if is_dir else info.size, mtime, None, None, False, None, None, None)


def _attempts(read: Callable[[], Iterator], pause: float) -> Iterator:
    """Items of ``read()``, which is tried again after an I/O error, each with the name of its attempt.

    Nothing is held back: an attempt that fails after some items gives its name with None, and ``_settled``
    leaves out its items.
    """
    for attempt in range(MAX_RETRIES + 1):
        if attempt:
            time.sleep(pause * 2 ** (attempt - 1))
        reading, begun = uuid.uuid4().hex, False
        try:
            for item in read():
                begun = True
                yield reading, item
            return
        except OSError as e:
            if begun:
                yield reading, None
            if attempt == MAX_RETRIES or isinstance(e, (FileNotFoundError, NotADirectoryError)):
                raise


def _lister(only_self: bool, pause: float):
    """Task that lists directories, retrying each; what stays unreadable becomes an error row."""

    def listed(root, path):
        try:
            for reading, row in _attempts(lambda: _entries(root, path, only_self), pause):
                void = row is None
                yield (*((root, path, *[None] * 9) if void else row), reading, void)
        except FileNotFoundError:
            if only_self:
                yield (root, path, False, 0, None, None, None, None, None, None, "not found", None, False)
        except OSError as e:
            yield (root, path, True, 0, None, None, None, None, None, None, str(e), None, False)

    def run(batches):
        for pdf in batches:
            rows = []
            for root, path in zip(pdf["root"], pdf["path"]):
                for row in listed(root, path):
                    rows.append(row)
                    if len(rows) >= BATCH_ROWS:
                        yield pd.DataFrame(rows, columns=COLUMNS)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS)

    return run


def _settled(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df`` without the rows of failed attempts, stored, and the aggregates; attempts seldom fail, so one write is the rule."""
    spark = df.sparkSession
    path, seen = store(df, name, _void=F.count_if("void"), **metrics)
    if seen["_void"]:
        stored = spark.read.schema(df.schema).parquet(path)
        failed = lookup_table(stored.filter("void").select("reading"), "failed")
        df = stored.filter("not void").join(failed, "reading", "left_anti")
        path, seen = store(df, name, **metrics)
    return spark.read.schema(df.schema).parquet(path).drop("reading", "void"), seen


def _list(paths: DataFrame, n_paths: int, only_self: bool, tasks: int, pause: float) -> tuple[DataFrame, dict]:
    """Rows of one round, stored, with the numbers of paths and of directories to go on with."""
    spread = paths.select("root", "path").repartition(max(1, min(tasks, n_paths)))
    listed = spread.mapInPandas(_lister(only_self, pause), FOUND)
    to_open = F.count_if(F.col("is_dir") & F.col("error").isNull())
    return _settled(listed, "listing", paths=F.count(F.lit(1)), dirs=to_open)


def list_tree(
    spark: SparkSession,
    roots: list[str] | DataFrame,
    *,
    replace_content: bool = False,
    tasks: int | None = None,
    strict: bool = True,
    pause: float = FIRST_PAUSE_SEC,
) -> tuple[DataFrame, DataFrame]:
    """List every root recursively; returns the listing and the directories that could not be read.

    Roots that do not exist raise. With ``strict`` an unreadable directory raises too. The directories of
    one level are listed by tasks in parallel; there are as many rounds as the tree is deep. Each row has
    ``path, rel_path, root`` and its status; root rows follow the rules of update and overwrite runs.
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    if not isinstance(roots, DataFrame):
        roots = spark.createDataFrame([(r,) for r in roots], "path string")
    if not (home := default_fs(spark)).startswith("file:"):
        roots = roots.select(qualify("path", home).alias("path"))
    roots = roots.select(F.col("path").alias("root"), "path")
    level, seen = _list(roots, tasks, True, tasks, pause)
    missing = missing_roots(level).first()
    if missing is not None:
        raise InvalidInputError(f"{missing.path} doesn't exist")
    n_sources = seen["paths"]
    if n_sources == 0:
        raise InvalidInputError("Nothing to process: no source paths")
    # The root travels with the rows from here on, so none has to be looked up again.
    level = level.withColumn("root", source_root("path", "is_dir", n_sources, replace_content))
    levels = [level]
    while seen["dirs"]:
        frontier = level.filter(F.col("is_dir") & F.col("error").isNull())
        level, seen = _list(frontier, seen["dirs"], False, tasks, pause)
        levels.append(level)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    errors = found.filter(F.col("error").isNotNull()).select("path", "error")
    if strict and (first := errors.first()) is not None:
        raise MigrationError(f"Cannot list {first.path}: {first.error}")
    listing = found.filter(F.col("error").isNull()).drop("error")
    listing = listing.withColumn("rel_path", relative_path("root", "path"))
    return suppress_roots(listing, replace_content), errors


def check_roots(spark: SparkSession, roots: DataFrame, *, tasks: int | None = None, pause: float = FIRST_PAUSE_SEC) -> DataFrame:
    """``path, is_dir, length, error`` of each ``path`` in ``roots``, looked up by tasks; none raises.

    ``error`` is ``not found`` for a path that does not exist, the reason for one that stays unreadable, else null.
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    given = roots.select(qualify("path", default_fs(spark)).alias("_at"), "path")
    level, _ = _list(given.select(F.col("path").alias("root"), F.col("_at").alias("path")), tasks, True, tasks, pause)
    return level.select(F.col("root").alias("path"), "is_dir", "length", "error")


def missing_roots(level: DataFrame) -> DataFrame:
    """Rows of a root check whose path does not exist."""
    return level.filter(F.col("error") == "not found").select("path")


def list_files_fast(spark: SparkSession, root: str) -> DataFrame:
    """Files only, by Spark's own lister: no directories, no hidden names, no owners or permissions."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(
        "path",
        uri_path("path").alias("uri_path"),
        F.lit(False).alias("is_dir"),
        "length",
        F.unix_millis("modificationTime").alias("mtime"),
    )


def expand_sources(
    spark: SparkSession, globs: list[str] | DataFrame, *, tasks: int | None = None, pause: float = FIRST_PAUSE_SEC
) -> DataFrame:
    """``glob, path`` of everything in the file systems that matches the patterns; one without a match raises.

    All patterns advance together, one path component per round: tasks list the directories reached so far
    and keep the children whose names match. Fixed components are not listed. A directory or match that cannot be
    read raises.
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    if isinstance(globs, DataFrame):
        given = globs.select(F.col("path").alias("glob"))
    else:
        given = spark.createDataFrame([(g,) for g in dict.fromkeys(globs)], "glob string")
    schema, home = "glob string, path string, rest array<string>, reading string, void boolean", default_fs(spark)

    names = ["glob", "path", "rest", "reading", "void"]

    def start(batches):
        for pdf in batches:
            rows = [(g, *split_fixed(qualified(each, home)), None, False) for g in pdf["glob"] for each in expand_braces(g)]
            yield pd.DataFrame(rows, columns=names)

    def advance(batches):
        for pdf in batches:
            rows = []
            for glob, path, rest in pdf.itertuples(index=False):
                if len(rest) == 0:
                    rows.append((glob, path, [], None, False))
                    continue
                name = re.compile(glob_to_regex(rest[0]))
                fixed, after = take_fixed(list(rest[1:]))
                try:
                    for reading, entry in _attempts(lambda: _entries("", path, False), pause):  # noqa: B023
                        if entry is None:
                            rows.append((glob, path, [], reading, True))
                        elif name.fullmatch(entry[1].rsplit("/", 1)[1]):
                            rows.append((glob, entry[1] + fixed, after, reading, False))
                        if len(rows) >= BATCH_ROWS:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except (FileNotFoundError, NotADirectoryError):
                    pass
            yield pd.DataFrame(rows, columns=names)

    counts = {"rows": F.count(F.lit(1)), "open": F.count_if(F.size("rest") > 0)}
    reached, seen = _settled(given.mapInPandas(start, schema), "globs", **counts)
    while seen["open"]:
        spread = reached.select("glob", "path", "rest").repartition(max(1, min(tasks, seen["rows"])))
        reached, seen = _settled(spread.mapInPandas(advance, schema), "globs", **counts)
    checked = reached.select(F.col("glob").alias("root"), "path").repartition(tasks)
    found, _ = _settled(checked.mapInPandas(_lister(True, pause), FOUND), "sources")
    unread = found.filter(F.col("error") != "not found").first()
    if unread is not None:
        raise MigrationError(f"Cannot read {unread.path}: {unread.error}")
    found = found.filter(F.col("error").isNull()).select(F.col("root").alias("glob"), "path")
    lost = given.join(found, "glob", "left_anti").first()
    if lost is not None:
        raise InvalidInputError(f"{lost.glob} doesn't exist")
    if found.isEmpty():
        raise InvalidInputError("Nothing to process: no source paths")
    return found
