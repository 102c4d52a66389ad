"""Manifests, boxes and identity maps derived from the given tables.

A document is a file, its length in characters the file length, its source and language the directories.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import open_fs
from ..functions.access import acl_entry
from ..functions.values import int_div
from ..scratch import cut, scratch_path

MB = 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(n: int):
    return F.col("doc_id") % n


def doc_name():
    return F.concat(F.lit("/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def _access_columns(users: int, other_perm: int) -> dict:
    return {
        "owner": F.concat(F.lit("u"), _mod(users).cast("string")),
        "group": F.concat(F.lit("g"), _mod(5).cast("string")),
        "perm": F.when(_mod(3) == 0, 420).otherwise(other_perm),
        "sticky": F.lit(False),
    }


def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a source file."""
    docs = table(spark, sf_dir, "documents")
    columns = {
        "seq": F.col("doc_id"),
        "path": F.concat(F.lit("/src"), doc_name()),
        "rel_path": doc_name(),
        "root": F.lit("/src"),
        "is_dir": F.lit(False),
        "length": F.col("n_chars"),
        "chunk_length": F.col("n_chars"),
        "replication": (_mod(3) + 1).cast("smallint"),
        "block_size": F.when(_mod(4) == 0, F.lit(64 * MB)).otherwise(F.lit(128 * MB)).cast("bigint"),
        "mtime": F.lit(1_700_000_000_000).cast("bigint") + F.col("doc_id") * 1000,
        "checksum": F.md5("text"),
        **_access_columns(17, 384),
    }
    return docs.select(*[c.alias(n) for n, c in columns.items()])


def with_dirs(files: DataFrame) -> DataFrame:
    """A manifest and the directories its files lie in, except the root itself."""
    rel = F.col("rel_path")
    above = F.array(F.regexp_extract(rel, r"^(/[^/]+)/", 1), F.regexp_extract(rel, r"^(/[^/]+/[^/]+)/", 1))
    dirs = files.select("root", F.explode(above).alias("rel_path")).filter(rel != "").distinct()
    dirs = dirs.select(
        F.concat("root", "rel_path").alias("path"),
        "rel_path",
        "root",
        F.lit(True).alias("is_dir"),
        F.lit(0).cast("bigint").alias("length"),
    )
    return files.select("path", "rel_path", "root", "is_dir", "length").unionByName(dirs)


def target_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partly filled target: one file in five missing, some shorter, some damaged, some of unknown
    checksum, some replaced by a directory, and rows that the source does not have."""
    docs = table(spark, sf_dir, "documents")
    shorter = (_mod(7) == 0) & (F.col("n_chars") > 100)
    kept = docs.filter(_mod(5) != 0).withColumn(
        "tlen", F.when(shorter, F.col("n_chars") - 100).otherwise(F.col("n_chars"))
    )
    known = F.when(_mod(11) == 0, F.md5(F.concat("text", F.lit("!")))).otherwise(
        F.md5(F.substring("text", F.lit(1), F.col("tlen").cast("int")))
    )
    columns = {
        "rel_path": doc_name(),
        "is_dir": _mod(97) == 1,
        "length": F.col("tlen"),
        "replication": F.lit(3).cast("smallint"),
        "block_size": F.lit(128 * MB).cast("bigint"),
        "mtime": F.lit(1_700_000_000_000).cast("bigint") + F.col("doc_id") * 1000,
        "checksum": F.when(_mod(13) != 0, known),
        **_access_columns(16, 416),
    }
    present = kept.select("doc_id", *[c.alias(n) for n, c in columns.items()])
    stale = docs.filter(_mod(19) == 0).select(
        "doc_id",
        F.concat(F.lit("/old/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("rel_path"),
        F.lit(False).alias("is_dir"),
        F.col("n_chars").alias("length"),
        F.lit(3).cast("smallint").alias("replication"),
        F.lit(128 * MB).cast("bigint").alias("block_size"),
        F.lit(1_700_000_000_000).cast("bigint").alias("mtime"),
        F.md5("text").alias("checksum"),
        F.lit("u0").alias("owner"),
        F.lit("g0").alias("group"),
        F.lit(420).alias("perm"),
        F.lit(False).alias("sticky"),
    )
    return present.unionByName(stale)


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(doc_name().alias("rel_path"), F.col("text").alias("content"))


def acl_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq, acl``: ten consecutive events make the extended ACL of one document."""
    events = table(spark, sf_dir, "events")
    entry = acl_entry(
        F.when(F.col("event_id") % 2 == 0, "ACCESS").otherwise("DEFAULT"),
        F.when(F.col("event_type").isin("view", "click"), "USER").otherwise("GROUP"),
        F.when(F.col("event_id") % 10 < 8, F.concat(F.lit("p"), (F.col("user_id") % 23).cast("string"))),
        F.when(F.col("event_type") == "error", "---").when(F.col("event_type") == "view", "r--").otherwise("rwx"),
    )
    numbered = F.struct(F.col("event_id").alias("n"), entry.alias("e"))
    return (
        events.groupBy(int_div("event_id", 10).alias("seq"))
        .agg(F.transform(F.array_sort(F.collect_list(numbered)), lambda x: x["e"]).alias("acl"))
        .select("seq", "acl")
    )


def source_with_acl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_manifest(spark, sf_dir).join(acl_lists(spark, sf_dir), "seq", "left")


def identity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of the owners (one null, one absent) and of every other ACL name."""
    docs = table(spark, sf_dir, "documents").select(_mod(17).alias("n")).distinct().filter("n < 16 and n <> 5")
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 23).alias("n")).distinct().filter("n % 2 = 0")

    def named(df, letter, empty):
        local = F.concat(F.lit(letter), F.col("n").cast("string"))
        return df.select(
            local.alias("local_identity"), F.when(F.col("n") != empty, F.concat(F.lit("cloud-"), local)).alias("cloud_identity")
        )

    return named(docs, "u", 3).unionByName(named(events, "p", -1))


def xattr_columns(target: bool):
    """Attributes of a document; those of the target differ for some documents."""
    lang = F.when(_mod(4) == 0, F.lit("xx")).otherwise(F.col("lang")) if target else F.col("lang")
    marked = F.when(_mod(6) != 0, F.encode("source", "utf-8"))
    return F.create_map(
        F.lit("user.lang"), F.encode(lang, "utf-8"),
        F.lit("trusted.source"), marked,
        F.lit("raw.chars"), F.encode(F.col("n_chars").cast("string"), "utf-8"),
    )


def xattr_manifest(spark: SparkSession, sf_dir: str, target: bool = False) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", doc_name().alias("rel_path"), F.lit(False).alias("is_dir"), xattr_columns(target).alias("xattrs")
    )


def region_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per region; together they hold three quarters of all documents."""
    total = table(spark, sf_dir, "documents").agg(F.sum("n_chars").alias("total"))  # one row
    regions = table(spark, sf_dir, "region")
    share = int_div("total", 20) * (F.col("r_regionkey") + 1)
    return regions.join(F.broadcast(total)).select(
        F.col("r_regionkey").cast("int").alias("box_id"), share.alias("size_bytes"), F.col("r_name").alias("dns")
    )


def nation_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per nation, of 100 TiB where it has as many customers as the average; one has no size."""
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    counts = customers.agg(F.count("*").alias("n"))
    every = table(spark, sf_dir, "customer").agg(F.count("*").alias("n_all"))  # one row
    nations = table(spark, sf_dir, "nation").join(counts, "n_nationkey", "left").join(F.broadcast(every))
    average = int_div(F.coalesce("n", F.lit(0)) * F.lit(25 * 1000), "n_all")
    size = F.when(F.col("n_nationkey") == 7, F.lit(-1)).otherwise(average * F.lit(100 * 1024**4 // 1000))
    return nations.select(
        F.col("n_nationkey").cast("int").alias("box_id"), "n_name", F.coalesce("n", F.lit(0)).alias("n_customers"),
        size.cast("bigint").alias("size_bytes"),
    )


def order_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per region for orders; the largest has no size limit."""
    total = table(spark, sf_dir, "orders").agg(F.sum(F.col("o_totalprice").cast("bigint")).alias("total"))  # one row
    key = F.col("r_regionkey").cast("bigint")
    share = int_div("total", 12) * (key + 1)
    return table(spark, sf_dir, "region").join(F.broadcast(total)).select(
        key.cast("int").alias("box_id"), F.when(key < 4, share).otherwise(F.lit(-1)).cast("bigint").alias("size_bytes")
    )


def order_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_totalprice").cast("bigint").alias("length")
    )


def old_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents some time ago: some not there yet, some shorter, some under another name, some since deleted."""
    docs = table(spark, sf_dir, "documents")
    name = F.when(_mod(10) == 3, F.concat(F.lit("/former"), doc_name())).otherwise(doc_name())
    length = F.when(_mod(8) == 0, int_div("n_chars", 2)).otherwise(F.col("n_chars"))
    kept = docs.filter(_mod(9) != 0).select(
        F.col("doc_id").alias("file_id"), name.alias("rel_path"), F.lit(False).alias("is_dir"), length.alias("length")
    )
    gone = docs.filter(_mod(21) == 0).select(
        (-F.col("doc_id") - 1).alias("file_id"),
        F.concat(F.lit("/gone"), doc_name()).alias("rel_path"),
        F.lit(False).alias("is_dir"),
        F.col("n_chars").alias("length"),
    )
    return kept.unionByName(gone)


def new_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"),
        doc_name().alias("rel_path"),
        F.lit(False).alias("is_dir"),
        F.col("n_chars").alias("length"),
    )


def _tree(tops: DataFrame, seconds: DataFrame, files: DataFrame, *more: DataFrame) -> DataFrame:
    """``file_id, rel_path, is_dir, length`` of directories (id, path) and files (id, path, n_chars)."""
    out = files.select(F.col("id").alias("file_id"), F.col("path").alias("rel_path"), F.lit(False).alias("is_dir"), F.col("n_chars").alias("length"))
    for dirs in (tops, seconds, *more):
        out = out.unionByName(dirs.select(F.col("id").alias("file_id"), F.col("path").alias("rel_path"), F.lit(True).alias("is_dir"), F.lit(0).cast("bigint").alias("length")))
    return out


def _top_id():
    return F.concat(F.lit("d:"), "source")


def _second_id():
    return F.concat(F.lit("d:"), "source", F.lit("/"), "lang")


def old_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their directories, before the moves of ``new_tree``; one in nine isn't there yet."""
    docs = table(spark, sf_dir, "documents")
    tops = docs.select("source").distinct().select(_top_id().alias("id"), F.concat(F.lit("/"), "source").alias("path"))
    seconds = docs.select("source", "lang").distinct()
    seconds = seconds.select(_second_id().alias("id"), F.concat(F.lit("/"), "source", F.lit("/"), "lang").alias("path"))
    files = docs.filter(_mod(9) != 0).select(F.concat(F.lit("f:"), F.col("doc_id")).alias("id"), doc_name().alias("path"), "n_chars")
    return _tree(tops, seconds, files)


def new_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``old_tree`` after moves: two directories swapped, circles of three, a name passed on from a deleted directory, a
    directory replaced by a new one that keeps its content, files moved into new directories, others deleted or new."""
    docs = table(spark, sf_dir, "documents")

    def renamed(column: str, names: dict[str, str]):
        out = F.col(column)
        for name, to in names.items():
            out = F.when(F.col(column) == name, to).otherwise(out)
        return out

    top = F.concat(F.lit("/"), renamed("source", {"src1": "src2", "src2": "src1", "src3": "src4", "src4": "src5", "src5": "src3", "src7": "src6"}))
    lang = F.when(F.col("source") == "src0", renamed("lang", {"en": "fr", "fr": "de", "de": "en"})).otherwise(F.col("lang"))
    second = F.when((F.col("source") == "src9") & (F.col("lang") == "en"), "/moved/en-of-9").otherwise(F.concat(top, F.lit("/"), lang))
    last = F.concat(F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    gone = F.col("source") == "src6"
    path = F.when(gone, F.concat(F.lit("/rescued"), last)).when(_mod(10) == 3, F.concat(F.lit("/moved/files"), last)).otherwise(F.concat(second, last))
    tops = docs.select("source").distinct()
    made = tops.filter("source = 'src8'").select(F.explode(F.array(*[F.lit(p) for p in ("/moved", "/moved/files", "/rescued", "/src8")])).alias("path"))
    seconds = docs.select("source", "lang").distinct().filter(~gone).select(_second_id().alias("id"), second.alias("path"))
    files = docs.filter((_mod(21) != 0) & (~gone | (_mod(2) == 0)))
    files = files.select(F.concat(F.lit("f:"), F.col("doc_id")).alias("id"), path.alias("path"), "n_chars")
    tops = tops.filter(~gone & (F.col("source") != "src8")).select(_top_id().alias("id"), top.alias("path"))
    return _tree(tops, seconds, files, made.select(F.concat(F.lit("n:"), "path").alias("id"), "path"))


def write_files(spark: SparkSession, sf_dir: str) -> str:
    """The texts as files that Spark writes, in a folder per source and language; returns the folder of all."""
    root = scratch_path(spark, "files")
    docs = table(spark, sf_dir, "documents").select("source", "lang", F.coalesce("text", F.lit("")).alias("value"))
    docs.write.partitionBy("source", "lang").text(root)
    return root


def write_halves(files: DataFrame) -> None:
    """The first half of each file at ``path`` as a file at ``target_uri``, as a run that was broken off leaves it."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, target, n in zip(pdf["path"], pdf["target_uri"], pdf["length"]):
                (source_store, source), (store, name), left = open_fs(path), open_fs(target), int(n) // 2
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with source_store.open_input_file(source) as given, store.open_output_stream(name) as sink:
                    while left and (data := given.read(min(left, MB))):
                        sink.write(data)
                        left -= len(data)
            yield pdf[["path"]]

    cut(files.select("path", "target_uri", "length").mapInPandas(write, "path string"), "halves")


def write_tree(spark: SparkSession, sf_dir: str) -> str:
    """Write every document as a file below a new scratch folder, from tasks, and return the folder."""
    root = scratch_path(spark, "tree")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = set()
        for pdf in batches:
            for rel_path, text in zip(pdf["rel_path"], pdf["content"]):
                store, name = open_fs(root + rel_path)
                folder = name.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(name) as sink:
                    sink.write(text.encode("utf-8"))
            yield pdf[["rel_path"]]

    rows = content(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    cut(rows.mapInPandas(write, "rel_path string"), "tree-files")
    return root
