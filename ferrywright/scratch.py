"""Shared scratch tables and size-checked broadcasts.

Lineage is cut by writing a table into the folder that ``spark.checkpoint.dir`` names, so the
result survives the loss of executors and later stages can prune it by column and partition.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .errors import InvalidInputError
from .files import open_fs, qualified

BROADCAST_ROWS = 200_000
_local_dirs: dict[str, str] = {}


def default_fs(spark: SparkSession) -> str:
    """The file system on which Spark looks for paths that name none."""
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")


def scratch_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise InvalidInputError("Set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="ferrywright-")
        base = _local_dirs[app]
    else:
        base = qualified(base, default_fs(spark))  # the same folder for Spark and for ``open_fs``
    return f"{base.rstrip('/')}/ferrywright-{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application, once no result that reads them is needed any more."""
    store_, name = open_fs(scratch_dir(spark))
    store_.delete_dir_contents(name, missing_dir_ok=True)


def store(df: DataFrame, name: str, partition_by: list[str] | None = None, **metrics: Column) -> tuple[str, dict]:
    """Write ``df`` to a new scratch table; returns its path and the aggregates observed while writing.

    The aggregates are taken in the stage that writes, whose tasks count once even if they are repeated.
    """
    path = scratch_path(df.sparkSession, name)
    if not metrics:
        df.write.parquet(path, partitionBy=partition_by)
        return path, {}
    seen = Observation()
    df.observe(seen, *[m.alias(n) for n, m in metrics.items()]).write.parquet(path, partitionBy=partition_by)
    return path, seen.get


def cut(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return the stored table."""
    path, _ = store(df, name, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Like ``cut``, with the number of rows written."""
    path, seen = store(df, name, rows=F.count(F.lit(1)))
    return df.sparkSession.read.schema(df.schema).parquet(path), seen["rows"]


def lookup_table(df: DataFrame, name: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Store the narrow rows of ``df`` and mark them for broadcast when there are at most ``limit``.

    Larger ones are left to a shuffle join, where adaptive skew handling splits hot keys of the other side.
    """
    stored, rows = cut_counted(df, name)
    return F.broadcast(stored) if rows <= limit else stored


def small_table(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A broadcast table of driver-side records, such as a few values per block, box or split."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    # The Arrow path makes this a relation inside the plan, with no job to produce it.
    return F.broadcast(spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow)))
