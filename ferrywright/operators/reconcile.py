"""Comparison of a source manifest with a target manifest.

Both sides meet in one equi-join on the key, each projected to the few columns that the comparison
reads. A target lists a key at most once, so a join never multiplies rows; a hot range of keys is left
to adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import checksums_equal
from ..options import SyncOptions
from ..scratch import cut, lookup_table

TARGET_COLUMNS = ("is_dir", "length", "block_size", "checksum")


def match_target(
    src: DataFrame, tgt: DataFrame, key: str = "rel_path", columns: tuple[str, ...] = TARGET_COLUMNS
) -> DataFrame:
    """Each source row with the status of its target as ``tgt_*`` columns, and ``tgt_exists``."""
    found = tgt.select(key, *[F.col(c).alias(f"tgt_{c}") for c in columns if c in tgt.columns], F.lit(True).alias("_hit"))
    return src.join(found, key, "left").withColumn("tgt_exists", F.col("_hit").isNotNull()).drop("_hit")


def _same_size(options: SyncOptions) -> Column:
    same = F.col("tgt_length") == F.col("length")
    if "blocksize" in options.preserve:
        same = same & F.col("block_size").eqNullSafe(F.col("tgt_block_size"))
    return same


def _same_content(options: SyncOptions) -> Column:
    same = _same_size(options)
    if not options.skip_crc:
        same = same & checksums_equal("checksum", "tgt_checksum", options.strict_checksums)
    return F.coalesce(same, F.lit(False))


def _appendable(rows: DataFrame, options: SyncOptions) -> DataFrame:
    shorter = F.col("tgt_exists") & ~F.col("is_dir") & ~F.col("tgt_is_dir") & (F.col("tgt_length") < F.col("length"))
    return rows.filter(shorter & ~_same_content(options))


def append_candidates(src: DataFrame, tgt: DataFrame, options: SyncOptions, key: str = "rel_path") -> DataFrame:
    """Files whose target is a shorter file: only their content has to be hashed up to the target length."""
    return _appendable(match_target(src, tgt, key), options)


def prefix_checksums(
    candidates: DataFrame, content: DataFrame, key: str = "rel_path", value: str = "content"
) -> DataFrame:
    """``key, prefix_checksum``: md5 of the first ``tgt_length`` characters of each candidate's content.

    Candidates are stored and counted; when few, they are broadcast and the content is not shuffled.
    """
    few = lookup_table(candidates.select(key, "tgt_length"), "candidates")
    prefix = F.substring(F.col(value), F.lit(1), F.col("tgt_length").cast("int"))
    return content.join(few, key).select(key, F.md5(prefix).alias("prefix_checksum"))


def digest_candidates(rows: DataFrame, options: SyncOptions) -> DataFrame:
    """Of the rows of ``match_target``, those files whose content decides the action.

    With equal length (and block size, where that counts) it is the whole content, with a shorter target the part up to the
    target's length, if APPEND is possible. All other actions follow from the status alone.
    """
    both = F.col("tgt_exists") & ~F.col("is_dir") & ~F.col("tgt_is_dir") & F.lit(options.update and not options.overwrite)
    equal = F.lit(not options.skip_crc) & _same_size(options)
    shorter = F.lit(options.append) & (F.col("tgt_length") < F.col("length"))
    return rows.filter(both & F.col("tgt_checksum").isNotNull() & (equal | shorter))


def content_digests(candidates: DataFrame, content: DataFrame, key: str = "rel_path", value: str = "content") -> DataFrame:
    """``key, checksum, prefix_checksum`` of candidates, from a table of contents that is read once.

    Candidates are stored and counted; when few, they are broadcast and the content is not shuffled.
    """
    few = lookup_table(candidates.select(key, "length", "tgt_length"), "candidates")
    whole = F.col("length") == F.col("tgt_length")
    prefix = F.substring(F.col(value), F.lit(1), F.col("tgt_length").cast("int"))
    found = content.join(few, key)
    return found.select(key, F.when(whole, F.md5(value)).alias("checksum"), F.when(~whole, F.md5(prefix)).alias("prefix_checksum"))


def action_column(options: SyncOptions, with_prefixes: bool = False) -> Column:
    """The action of a row that ``match_target`` produced.

    Cheap tests stand before checksums. APPEND needs the column ``prefix_checksum``.
    """
    appendable = F.lit(False)
    if options.append and with_prefixes:
        shorter = F.col("tgt_length") < F.col("length")
        appendable = F.coalesce(shorter & (F.col("prefix_checksum") == F.col("tgt_checksum")), appendable)
    return (
        F.when(F.col("tgt_exists") & (F.col("is_dir") != F.col("tgt_is_dir")), "CONFLICT")
        .when(F.col("is_dir"), "MKDIR")
        .when(~F.col("tgt_exists") | F.lit(options.overwrite), "OVERWRITE")
        .when(F.lit(True) if not options.update else _same_content(options), "SKIP")
        .when(appendable, "APPEND")
        .otherwise("OVERWRITE")
    )


def reconcile(
    src: DataFrame,
    tgt: DataFrame,
    options: SyncOptions,
    *,
    key: str = "rel_path",
    prefixes: Callable[[DataFrame], DataFrame] | None = None,
    digests: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``action`` to each source row: MKDIR, SKIP, APPEND, OVERWRITE or CONFLICT.

    ``prefixes`` enables APPEND: it gets the append candidates and returns ``key, prefix_checksum``. The
    joined status rows are stored before, so that neither side is read or joined twice.

    ``digests`` does without checksums in ``src``: it gets the ``digest_candidates``, the only files whose content matters,
    and returns ``key, checksum, prefix_checksum``, as ``content_digests`` and ``copyjob.file_digests`` do with one read of each.
    A candidate without a digest (it could not be read) counts as different, so that the copy reports it.
    """
    rows = match_target(src, tgt, key)
    if digests is not None:
        rows = cut(rows.drop("checksum"), "matched")
        found = digests(digest_candidates(rows, options))
        found = found.select(key, *[F.coalesce(c, F.lit("")).alias(c) for c in ("checksum", "prefix_checksum")])
        return rows.join(found, key, "left").withColumn("action", action_column(options, options.append))
    appending = options.append and prefixes is not None
    if appending:
        rows = cut(rows, "matched")
        found = prefixes(_appendable(rows, options)).select(key, "prefix_checksum")
        rows = rows.join(found, key, "left")
    return rows.withColumn("action", action_column(options, appending))


def vanished_sources(listed: DataFrame, fresh: DataFrame, key: str = "path") -> DataFrame:
    """Rows that a fresh listing no longer has; copying them is a read failure."""
    return listed.join(fresh.select(key), key, "left_anti")


def verify(
    src: DataFrame, tgt: DataFrame, *, key: str = "rel_path", skip_crc: bool = False, strict: bool = False
) -> DataFrame:
    """``key, verdict`` of every source file: OK, MISSING, TYPE, LENGTH or CHECKSUM.

    Empty files and parts of files are not compared by checksum, parts not by length either.
    """
    rows = match_target(src.filter(~F.col("is_dir")), tgt, key)
    whole = F.lit(True)
    if {"chunk_length", "chunk_offset"} <= set(src.columns):
        whole = (F.col("chunk_length") == F.col("length")) | (F.col("chunk_length") == F.lit(2**63 - 1))
    differs = ~checksums_equal("checksum", "tgt_checksum", strict) & F.lit(not skip_crc) & (F.col("length") != 0)
    verdict = (
        F.when(~F.col("tgt_exists"), "MISSING")
        .when(F.col("tgt_is_dir"), "TYPE")
        .when(whole & (F.col("length") != F.col("tgt_length")), "LENGTH")
        .when(whole & differs, "CHECKSUM")
        .otherwise("OK")
    )
    return rows.select(key, "length", "tgt_length", verdict.alias("verdict"))


def extraneous_targets(src: DataFrame, tgt: DataFrame, key: str = "rel_path") -> DataFrame:
    """Target rows that the source lacks: what a mirror run would delete."""
    return tgt.join(src.select(key), key, "left_anti")


def in_sync(left: DataFrame, right: DataFrame, key: str = "rel_path") -> DataFrame:
    """Keys found on one side only, as ``key, only_in``; empty when both sides list the same keys.

    One shuffle of partial aggregates, so repeated keys collapse before they travel.
    """
    sides = left.select(key, F.lit(1).alias("_side")).unionByName(right.select(key, F.lit(2).alias("_side")))
    seen = sides.groupBy(key).agg(F.bit_or("_side").alias("_sides"))
    return seen.filter(F.col("_sides") != 3).select(
        key, F.when(F.col("_sides") == 1, "left").otherwise("right").alias("only_in")
    )


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    *,
    key: str = "rel_path",
    file_id: str | None = None,
    compare: tuple[str, ...] = ("length", "mtime", "checksum"),
) -> DataFrame:
    """``change, source, target, length`` between two snapshots: CREATE, MODIFY, DELETE, and RENAME.

    Renames need a stable ``file_id`` in both snapshots, which then is the join key. A renamed file
    whose content changed as well gives a RENAME and a MODIFY row. ``length`` is that of the new row.
    """
    on = file_id or key
    state = [c for c in compare if c in old.columns and c in new.columns]
    names = list(dict.fromkeys([on, key, "length", "is_dir", *state]))

    def side(df, prefix):
        return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in names])

    both = side(old, "o").join(side(new, "n"), F.col(f"o_{on}") == F.col(f"n_{on}"), "full_outer")
    created, deleted = F.col(f"o_{on}").isNull(), F.col(f"n_{on}").isNull()
    changed = F.lit(False)
    for c in state:
        changed = changed | ~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    renamed = F.col(f"o_{key}") != F.col(f"n_{key}")
    changes = F.when(created, F.array(F.lit("CREATE"))).when(deleted, F.array(F.lit("DELETE")))
    changes = changes.otherwise(
        F.array_compact(
            F.array(
                F.when(renamed, F.lit("RENAME")),
                F.when(changed & ~F.col("n_is_dir"), F.lit("MODIFY")),
            )
        )
    )
    rows = both.withColumn("change", F.explode(changes))
    return rows.select(
        "change",
        F.when(F.col("change").isin("CREATE", "MODIFY"), F.lit(None)).otherwise(F.col(f"o_{key}")).alias("source"),
        F.when(F.col("change") != "DELETE", F.col(f"n_{key}")).alias("target"),
        F.col("n_length").alias("length"),
    )


def replay_order(diff: DataFrame) -> DataFrame:
    """Rename and delete operations of a diff, children before parents, deletions before renames."""
    return diff.filter(F.col("change").isin("DELETE", "RENAME")).orderBy(F.desc("source"), F.asc_nulls_first("target"))


def copy_list(diff: DataFrame) -> DataFrame:
    """Paths that a differential copy has to transfer."""
    return diff.filter(F.col("change").isin("CREATE", "MODIFY")).select(F.col("target").alias("rel_path"), "length")
