"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, a source's rate is its target over its size, and
each document is taken floor(rate) times and once more if a hash of seed and id falls below the fraction.

Sources by code point, null last, weigh ``weights`` in turn. Targets share the total size by weight and stop at
``ceiling`` times the source's size; what is above is shared again by weight among the others until none is above.
Nulls in ``text`` count as empty; rows with equal ids share one draw. Sources without words have target 0 and are
taken with rate 0. Empty tables give empty results; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import with_index
from ..scratch import cut, lookup_table

WEIGHTS = (5, 2, 1)
CEILING = 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on seed and id only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(2.0**32)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """Per source of ``sizes`` (_source, _size): its target.

    One row per source is stored; sharing again is one aggregate of two numbers over these rows a round.
    """
    ranked = sizes.withColumn("_order", F.struct(F.col("_source").isNull().alias("last"), "_source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = cut(with_index(ranked, "_order", "_rank").withColumn("_weight", weight).drop("_order", "_rank"), "sources")
    top = F.col("_size") * ceiling
    total = table.agg(F.sum("_size")).first()[0] or 0
    left, shares = total, table.agg(F.sum("_weight")).first()[0] or 1
    while True:
        share = F.lit(float(left)) * F.col("_weight") / F.lit(float(shares))
        seen = table.agg(F.sum(F.when(top < share, top)), F.sum(F.when(top >= share, F.col("_weight")))).first()
        again = (total - (seen[0] or 0), seen[1] or shares)
        if again == (left, shares):
            return table.withColumn("_target", F.least(top.cast("double"), share))
        left, shares = again


def rated(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """``docs`` with _words, _size and _target of its source, and _copies, the number of times to take it."""
    sized = docs.withColumn("_words", n_words(docs["text"]))
    sizes = docs.select(docs["source"].alias("_source"), n_words(docs["text"]).alias("_words")).groupBy("_source")
    plan = lookup_table(targets(sizes.agg(F.sum("_words").alias("_size")), weights, ceiling).drop("_weight"), "targets")
    rate = F.when(F.col("_size") > 0, F.col("_target") / F.col("_size")).otherwise(F.lit(0.0))
    extra = (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("int")
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["_source"]), "left").drop("_source")
    return joined.withColumn("_copies", (F.floor(rate) + extra).cast("int"))


def report(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken and copies."""
    rows = rated(docs.select("doc_id", "text", "source"), seed)
    return rows.select(
        "doc_id",
        F.col("_words").alias("size"),
        F.col("_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_words") * F.col("_copies")).cast("long").alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Each document as often as it is taken, with ``copy`` counting from 1 (``mix_copy`` if that name is in use)."""
    number = "copy" if "copy" not in docs.columns else "mix_copy"
    names = [f"_c{i}" for i in range(len(docs.columns))]  # columns of any name go by their places
    needed = [F.col(names[docs.columns.index(c)]).alias(c) for c in ("doc_id", "text", "source")]
    rows = rated(docs.toDF(*names).select(*names, *needed), seed).filter("_copies > 0")
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)], F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias(number))
