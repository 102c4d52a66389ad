"""Exact deduplication by skew-safe combining.

Equal texts are first combined inside each task, then per salt in groups of equal digest and text, then over the
salts. Every grouping compares the whole texts; the digest only makes comparing and dealing out cheap. However
often one text occurs, a task that merges salts reads a row per task and salt of it, never a row per copy.

Nulls in ``text`` count as empty. Among equal texts the largest ``doc_id`` stays; a null id is smaller than any other.
Repeated rows are copies like others: ``deduplicate`` returns one row per distinct text, ``classify`` one row per
input row, where all rows with the winning id are marked as kept. Empty tables give empty results; other columns
may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _texts(docs: DataFrame, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    own = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"), *more)
    return own.withColumn("_digest", digest(F.col("_text")))


def _combine(texts: DataFrame, best: str, salts: int) -> DataFrame:
    """One row per distinct text: its largest ``best`` and the number of rows."""
    salted = texts.withColumn("_salt", F.spark_partition_id() % salts)
    local = salted.groupBy("_digest", "_text", "_salt").agg(F.max(best).alias("_best"), F.count(F.lit(1)).alias("_n"))
    return local.groupBy("_digest", "_text").agg(F.max("_best").alias("_best"), F.sum("_n").alias("_n"))


def classify(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256.

    The rows find their group by digest, length and a second hash, spread over salts; texts don't travel for it.
    """
    key = ["_digest", "_length", "_check"]
    marks = lambda df: df.withColumn("_length", F.octet_length("_text")).withColumn("_check", F.xxhash64("_text"))
    found = marks(_combine(_texts(docs, digest), "_id", salts)).filter("_n > 1").select(*key, "_best", "_n")
    groups = found.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = marks(_texts(docs, digest)).select(
        "_id",
        *key,
        F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_part"),
        (F.col("_digest") if digest is sha256 else sha256(F.col("_text"))).alias("text_sha256"),
    )
    joined = rows.join(groups, [*key, "_part"], "left")
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_best"))
    return joined.select(
        F.col("_id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def _comparable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType))


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """The kept row of each distinct text, with the columns of ``docs``.

    Between rows of equal text and id, the columns with plain values decide, so that reruns agree.
    """
    columns = docs.columns  # of any name: they go by their places
    names = ["doc_id" if c == "doc_id" else "text" if c == "text" else f"_c{i}" for i, c in enumerate(columns)]
    docs = docs.toDF(*names)
    plain = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and _comparable(f.dataType)]
    order = F.struct("doc_id", F.xxhash64(F.lit(0), *plain), F.col("text").isNotNull())
    rest = F.struct(*[F.col(n).alias(f"_r{i}") for i, n in enumerate(names) if n != "text"], F.col("text").isNull().alias("_null"))
    texts = _texts(docs, digest, order.alias("_order"), rest.alias("_rest"))
    salted = texts.withColumn("_salt", F.spark_partition_id() % salts)
    best = lambda df, *by: df.groupBy(*by).agg(F.max_by("_rest", "_order").alias("_rest"), F.max("_order").alias("_order"))
    won = best(best(salted, "_digest", "_text", "_salt"), "_digest", "_text")
    text = F.when(~F.col("_rest._null"), F.col("_text"))
    return won.select(*[(text if n == "text" else F.col(f"_rest._r{i}")).alias(c) for i, (n, c) in enumerate(zip(names, columns))])
