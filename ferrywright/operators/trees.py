"""Whole directory trees: replay of a snapshot difference, content of created directories, smallest sets of deletions.

A path meets its ancestors by equality: rows are exploded to the ancestors at those depths at which marks exist, and joined with the
marks by hash. Rows below one hot ancestor are dealt over ``SALTS`` parts of the join, and partial maxima leave
one row per path, so neither a large directory nor a deep tree ends in one task.

Paths begin with a slash and don't end with one; listings hold every directory above their files unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import depth, directory, upto
from ..scratch import cut, lookup_table

SALTS = 16


def marked_ancestors(rows: DataFrame, marks: DataFrame, *, key: str = "rel_path", own: bool = True, nearest: bool = True) -> DataFrame:
    """``key`` of the ``rows`` that lie below a mark, with that mark's columns: the nearest one or, else, the topmost.

    ``marks`` has ``key``, unique, and other columns; with ``own`` a row that is a mark itself counts as below it.
    """
    more = [c for c in marks.columns if c != key]
    depths = [r[0] for r in marks.select(depth(key).alias("d")).distinct().orderBy("d").collect()]  # one per level of the tree
    level = F.explode(F.array([F.lit(d) for d in depths]).cast("array<int>")).alias("_depth")
    above = rows.select(F.col(key).alias("_path"), level, F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("_salt"))
    above = above.filter(F.col("_depth") <= depth("_path") - (0 if own else 1))
    above = above.select("_path", "_depth", "_salt", upto("_path", "_depth").alias(key))
    spread = marks.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    order = F.col("_depth") if nearest else -F.col("_depth")
    found = above.join(spread, [key, "_salt"]).groupBy("_path").agg(F.max_by(F.struct(key, *more), order).alias("_mark"))
    return found.select(F.col("_path").alias(key), F.col(f"_mark.{key}").alias("mark"), *[F.col(f"_mark.{c}").alias(c) for c in more])


def replay_plan(old: DataFrame, new: DataFrame, *, key: str = "rel_path", file_id: str = "file_id", staging: str = "/.staging") -> DataFrame:
    """Steps (phase, wave, op, source, target) that turn the tree ``old`` into ``new`` without copying.

    Both have ``file_id``, ``key`` and ``is_dir``. Phase 1 puts everything that moves or goes aside, under a name of its own
    below ``staging`` (STASH), children before their parents. Phase 2 deletes what goes (REMOVE), makes directories that are new
    (MKDIR), and moves the rest to its place (PLACE), parents before their children. So names can be swapped, passed on in a circle or
    reused. Steps are taken by phase and wave; those of one wave are independent of each other and can run side by side.

    A move is left out if that of the parent directory implies it, a deletion if the parent is deleted. What stays at its path
    while its parent goes elsewhere is moved, too. Files that are new or changed are not part of the plan: they are copied.
    """
    side = lambda df, p: df.select(F.col(file_id).alias("id"), F.col(key).alias(p), F.col("is_dir").alias(f"{p}_dir"))
    both = cut(side(old, "was").join(side(new, "now"), "id", "full_outer"), "trees")
    stays = F.col("was").eqNullSafe(F.col("now"))
    changed = both.filter(F.col("was_dir") & ~stays).select(F.col("was").alias("_dir"), F.col("now").alias("_to"), F.lit(True).alias("_moved"))
    kept = both.filter("was is not null")
    kept = kept.join(lookup_table(changed, "changed"), directory("was") == F.col("_dir"), "left")
    name = F.substring_index("was", "/", -1)
    carried = F.when(F.col("_moved"), F.concat("_to", F.lit("/"), name)).otherwise(F.col("was"))  # null if the parent goes
    moves = kept.withColumn("_carried", carried).filter(~F.col("now").eqNullSafe(F.col("_carried")))
    aside = F.concat(F.lit(staging.rstrip("/") + "/"), F.md5("was"))
    moves = moves.select("was", "now", aside.alias("aside"))

    def steps(rows: DataFrame, phase: int, wave: Column, op: str, source, target) -> DataFrame:
        return rows.select(F.lit(phase).alias("phase"), wave.cast("int").alias("wave"), F.lit(op).alias("op"), source.alias("source"), target.alias("target"))

    none = F.lit(None).cast("string")
    made = both.filter("was is null and now_dir")
    return (
        steps(moves, 1, -depth("was"), "STASH", F.col("was"), F.col("aside"))
        .unionByName(steps(moves.filter("now is null"), 2, F.lit(0), "REMOVE", F.col("aside"), none))
        .unionByName(steps(made, 2, depth("now"), "MKDIR", none, F.col("now")))
        .unionByName(steps(moves.filter("now is not null"), 2, depth("now"), "PLACE", F.col("aside"), F.col("now")))
    )


def created_content(new: DataFrame, plan: DataFrame, *, key: str = "rel_path") -> DataFrame:
    """Rows of ``new`` that have to be copied because a directory above them, or they themselves, were created; with that ``root``.

    ``plan`` is a ``replay_plan``: its MKDIR steps name the created directories. What a PLACE step moved into one of
    them isn't copied, nor is anything below it, unless another created directory lies between.
    """
    marks = plan.filter(F.col("op").isin("MKDIR", "PLACE")).select(F.col("target").alias(key), (F.col("op") == "MKDIR").alias("_made"))
    nearest = marked_ancestors(new, cut(marks, "marks"), key=key).filter("_made").select(key, F.col("mark").alias("root"))
    return new.join(nearest, key)


def deletion_roots(src: DataFrame, tgt: DataFrame, *, key: str = "rel_path") -> DataFrame:
    """The fewest recursive deletions that free the target of what the source lacks: key, is_dir, entries, bytes.

    A directory goes as a whole only if the source has nothing below it, even where the source doesn't list the directory itself.
    ``entries`` and ``bytes`` count the root and all below it.
    """
    keys = src.select(key)
    above = F.explode(F.transform(F.sequence(F.lit(1), depth(key)), lambda d: upto(key, d)))
    needed = keys.filter(depth(key) > 0).select(above.alias(key)).distinct()  # kept paths and all above them, as partial distinct sets
    gone = cut(tgt.select(key, "is_dir", "length").join(needed, key, "left_anti"), "gone")
    dirs = gone.filter("is_dir").select(key)
    below = marked_ancestors(gone, dirs, key=key, own=True, nearest=False).select(key, F.col("mark").alias("_root"))
    rows = gone.join(below, key, "left").withColumn("_root", F.coalesce("_root", key))
    sums = rows.groupBy("_root").agg(
        F.max(F.when(F.col(key) == F.col("_root"), F.col("is_dir"))).alias("is_dir"),
        F.count(F.lit(1)).alias("entries"),
        F.sum("length").alias("bytes"),
    )
    return sums.withColumnRenamed("_root", key)
