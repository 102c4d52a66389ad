"""Target configurations and identity maps, both JSON."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidInputError
from ..functions.paths import box_uri

IDENTITY_SCHEMA = "localIdentity string, cloudIdentity string"


def parse_boxes(config: DataFrame) -> DataFrame:
    """``box_id, dns, container, size_bytes, target_uri`` from ``value``, the text of a configuration.

    The configuration is an object with a default ``container`` and one list of boxes under any name, or
    the bare list. A box has ``container``, ``sizeInBytes``, ``accountKey`` and a key that ends in ``Dns``.
    ``box_id`` is the position in the list; a missing size or -1 is kept as null (unlimited).
    """
    text = F.trim("value")
    top = F.from_json(F.when(text.startswith("{"), text), "map<string,string>", {"mode": "FAILFAST"})
    listed = F.element_at(F.filter(F.map_values(top), lambda v: v.startswith("[")), 1)
    boxes = F.from_json(F.coalesce(listed, text), "array<map<string,string>>", {"mode": "FAILFAST"})
    rows = config.select(
        F.try_element_at(top, F.lit("container")).alias("default_container"), F.posexplode(boxes).alias("box_id", "box")
    )

    def field(name):
        return F.try_element_at("box", F.lit(name))

    dns = F.element_at(F.map_values(F.map_filter("box", lambda k, _: F.lower(k).endswith("dns"))), 1)
    container = F.coalesce(F.nullif(field("container"), F.lit("")), F.col("default_container"))
    size = F.coalesce(field("sizeInBytes").cast("bigint"), F.lit(-1))
    named = rows.select(
        "box_id",
        dns.alias("dns"),
        container.alias("container"),
        F.when(size >= 0, size).alias("size_bytes"),
        field("accountKey").alias("_key"),
    )
    return named.withColumn("target_uri", box_uri("dns", "_key", "container")).drop("_key")


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """The boxes of a configuration file; malformed JSON and a configuration without boxes raise."""
    boxes = parse_boxes(spark.read.text(path, wholetext=True))
    try:
        found = not boxes.isEmpty()
    except (Py4JJavaError, PySparkException) as error:
        raise InvalidInputError(f"{path} is not a list of boxes in JSON") from error
    if not found:
        raise InvalidInputError(f"No boxes in {path}")
    return boxes


def single_box(spark: SparkSession, uri: str) -> DataFrame:
    """One unsized box whose name is its URI."""
    schema = "box_id int, dns string, container string, size_bytes bigint, target_uri string"
    return spark.createDataFrame([(0, uri, None, None, uri)], schema)


def write_identities(identities: DataFrame, path: str) -> None:
    """``localIdentity, cloudIdentity`` as JSON, empty translations kept as nulls to be filled in."""
    named = identities.select(
        F.col("local_identity").alias("localIdentity"), F.col("cloud_identity").alias("cloudIdentity")
    )
    named.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_identities(spark: SparkSession, path: str) -> DataFrame:
    """An identity map: JSON lines or one JSON array. A repeated local identity raises."""
    first = spark.read.text(path).filter(F.trim("value") != "").first()
    is_array = first is not None and first.value.lstrip().startswith("[")
    raw = spark.read.schema(IDENTITY_SCHEMA).option("multiLine", is_array).option("mode", "FAILFAST").json(path)
    out = raw.select(F.col("localIdentity").alias("local_identity"), F.col("cloudIdentity").alias("cloud_identity"))
    clash = out.groupBy("local_identity").count().filter("count > 1").first()
    if clash is not None:
        raise InvalidInputError(f"Duplicate identity {clash.local_identity}")
    return out
