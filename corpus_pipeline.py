"""The corpus pipeline: language, exact copies, near copies, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.llm import exact, langid, leakage, mixing, near
from ferrywright.llm.queries import remainder
from ferrywright.scratch import scratch_path
from ferrywright.session import ship_package

LEAST_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those in which no language reaches ``LEAST_SCORE``."""
    ship_package(spark)
    net = langid.train(docs, remainder(F.col("doc_id"), 5) != 0)
    out = langid.predict(docs, net, tuple(docs.columns))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    named = out.toDF(*names, "_pred", "_score")
    good = named.filter((F.col("_pred") != langid.UNKNOWN) & (F.col("_score") >= LEAST_SCORE))
    return good.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the smallest id stays."""
    ship_package(spark)
    return near.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a benchmark item go."""
    return leakage.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as often as its source's rate asks for."""
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
]

# The network's floating-point decisions have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
