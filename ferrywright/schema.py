"""The manifest contract and the helper that brings any table into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACL_ENTRY = T.StructType([T.StructField(name, T.StringType()) for name in ("scope", "type", "name", "perm")])
NO_CHUNK_LIMIT = 2**63 - 1
# Permission bits given to rows that carry none.
DEFAULT_DIR_PERM = 0o777
DEFAULT_FILE_PERM = 0o666

MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("rel_path", T.StringType()),
        T.StructField("root", T.StringType()),
        T.StructField("is_dir", T.BooleanType()),
        T.StructField("length", T.LongType()),
        T.StructField("replication", T.ShortType()),
        T.StructField("block_size", T.LongType()),
        T.StructField("mtime", T.LongType()),
        T.StructField("atime", T.LongType()),
        T.StructField("perm", T.IntegerType()),
        T.StructField("sticky", T.BooleanType()),
        T.StructField("owner", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("acl", T.ArrayType(ACL_ENTRY)),
        T.StructField("xattrs", T.MapType(T.StringType(), T.BinaryType())),
        T.StructField("chunk_offset", T.LongType()),
        T.StructField("chunk_length", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)


def as_manifest(df: DataFrame, mapping: dict[str, str | Column] | None = None) -> DataFrame:
    """Project any table onto the manifest columns.

    ``mapping`` gives the source column or expression of a manifest column; a column that is neither
    mapped nor present becomes null. Missing owner and group turn into ``''``, a missing permission
    into the default of its kind, a missing chunk into the whole file.
    """
    mapping = mapping or {}

    def source(field: T.StructField) -> Column:
        given = mapping.get(field.name, field.name if field.name in df.columns else None)
        if given is None:
            return F.lit(None).cast(field.dataType)
        return (F.col(given) if isinstance(given, str) else given).cast(field.dataType)

    raw = df.select(*[source(f).alias(f.name) for f in MANIFEST])
    is_dir = F.coalesce("is_dir", F.lit(False))
    length = F.coalesce("length", F.lit(0).cast("bigint"))
    return raw.withColumns(
        {
            "is_dir": is_dir,
            "length": length,
            "perm": F.coalesce("perm", F.when(is_dir, DEFAULT_DIR_PERM).otherwise(DEFAULT_FILE_PERM)),
            "sticky": F.coalesce("sticky", F.lit(False)),
            "owner": F.coalesce("owner", F.lit("")),
            "group": F.coalesce("group", F.lit("")),
            "chunk_offset": F.coalesce("chunk_offset", F.lit(0).cast("bigint")),
            "chunk_length": F.coalesce("chunk_length", length),
        }
    )
