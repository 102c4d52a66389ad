"""Connected components of an edge table, by passing on smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..scratch import BROADCAST_ROWS, cut, cut_counted, scratch_path


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every id in ``edges`` (a, b); the label is the smallest id that can be reached.

    A round takes each id's smallest neighbouring label, then the label of its label, so that long chains shorten by
    halves. Hot ids only ever meet partial minima or a join that Spark can split. The labels of few edges (at most
    ``BROADCAST_ROWS``, counted) are written as one file, which changes no label.
    """
    links, n = cut_counted(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    packed = lambda df: df.coalesce(1) if n <= BROADCAST_ROWS else df
    labels = cut(packed(links.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label"))), "labels")
    while True:
        near = links.join(labels, links["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("_near"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "_near").alias("_low"))
        parent = labels.select(F.col("id").alias("_p"), F.col("label").alias("_root"))
        seen, path = Observation(), scratch_path(edges.sparkSession, "labels")
        moved = lower.join(parent, lower["_low"] == parent["_p"], "left").select("id", "label", F.least("_low", F.coalesce("_root", "_low")).alias("_new"))
        moved = moved.observe(seen, F.sum((F.col("label") != F.col("_new")).cast("long")).alias("moved"))
        packed(moved.select("id", F.col("_new").alias("label"))).write.parquet(path)
        labels = edges.sparkSession.read.schema(labels.schema).parquet(path)
        if not seen.get["moved"]:
            return labels
