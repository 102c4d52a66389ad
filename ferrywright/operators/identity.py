"""Owners, groups and ACL names: collection, translation, and the transfer plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInputError
from ..functions.access import acl_entry, logical_acl
from ..scratch import lookup_table
from .reconcile import match_target


def collect_identities(df: DataFrame) -> DataFrame:
    """``local_identity``: every owner, group and non-blank ACL name. Duplicates vanish before the shuffle."""
    names = F.array(F.col("owner"), F.col("group"))
    if "acl" in df.columns:
        named = F.filter(F.transform("acl", lambda e: e["name"]), lambda n: F.trim(n) != "")
        names = F.concat(names, F.coalesce(named, F.array().cast("array<string>")))
    return df.select(F.explode(F.array_distinct(names)).alias("local_identity")).distinct()


def merge_identities(found: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``local_identity, cloud_identity`` of the identities found, keeping translations already filled in."""
    if known is None:
        return found.select("local_identity", F.lit(None).cast("string").alias("cloud_identity"))
    return found.join(known.select("local_identity", "cloud_identity"), "local_identity", "left")


def _translate_by_joins(df: DataFrame, table: DataFrame) -> DataFrame:
    """Translate by joins: broadcast if the map is small, else with adaptive skew handling that splits hot owners.

    ACLs are translated once per distinct list, because directory trees repeat them: only distinct lists are
    opened and put together again, and rows get theirs back by one join. A list that a third of all rows
    share is one row there.
    """

    def translated(frame: DataFrame, column: str) -> DataFrame:
        hit = table.select(F.col("local_identity").alias(column), F.col("cloud_identity").alias("_cloud"))
        return frame.join(hit, column, "left").withColumn(column, F.coalesce("_cloud", column)).drop("_cloud")

    out = translated(translated(df, "owner"), "group")
    if "acl" not in df.columns:
        return out
    has_names = F.exists("acl", lambda e: F.trim(e["name"]) != "")
    lists = df.filter(has_names).select(F.col("acl").alias("_acl")).distinct()
    entries = lists.select("_acl", F.posexplode("_acl").alias("_pos", "_entry")).withColumn("name", F.col("_entry.name"))
    entry = F.struct("_pos", acl_entry(F.col("_entry.scope"), F.col("_entry.type"), F.col("name"), F.col("_entry.perm")))
    # A list holds a few dozen entries by the limits of file systems.
    mapped = (
        translated(entries, "name")
        .groupBy("_acl")
        .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["col2"]).alias("_mapped"))
    )
    return (
        out.join(mapped, F.col("acl") == F.col("_acl"), "left")
        .withColumn("acl", F.coalesce("_mapped", "acl"))
        .drop("_acl", "_mapped")
    )


def translate_identities(df: DataFrame, identities: DataFrame) -> DataFrame:
    """Replace owner, group and ACL names by their cloud identity; unmapped ones, nulls and blank names stay as they are.

    A local identity that the map holds twice raises.
    """
    named = identities.filter(F.trim("local_identity") != "").select("local_identity", "cloud_identity")
    clash = named.groupBy("local_identity").count().filter("count > 1").first()
    if clash is not None:
        raise InvalidInputError(f"Duplicate identity {clash.local_identity}")
    table = lookup_table(named.filter(F.col("cloud_identity").isNotNull()), "identities")
    return _translate_by_joins(df, table).select(*df.columns)


def unmapped_identities(found: DataFrame, identities: DataFrame) -> DataFrame:
    """Identities that the map lacks or leaves empty."""
    known = identities.filter(F.col("cloud_identity").isNotNull()).select("local_identity")
    return found.select("local_identity").join(known, "local_identity", "left_anti")


def _merged(acl: str) -> Column:
    """An ACL as a file system holds it: sorted, equal entries once."""
    return F.array_sort(F.array_distinct(acl))


def acl_transfer_plan(src: DataFrame, tgt: DataFrame, identities: DataFrame, key: str = "rel_path", merge: bool = False) -> DataFrame:
    """What to set on each target so that it has the translated owner, group and full ACL of its source.

    With ``merge``, entries whose names translate to one identity are joined (``access.merge_entries``), as a store that holds
    an identity once needs it.

    Returns ``key, status, owner, group, acl, setters``. ``status`` is OK, MISSING (no target) or CONFLICT
    (directory against file); only OK rows have setters.
    """
    full = src.withColumn("acl", logical_acl("perm", "acl"))
    want = translate_identities(full.select(key, "is_dir", "owner", "group", "acl", "sticky"), identities)
    if merge:
        want = want.withColumn("acl", merge_entries("acl"))
    have = tgt.withColumn("acl", logical_acl("perm", "acl"))
    rows = match_target(want, have, key, ("is_dir", "owner", "group", "acl", "sticky"))
    status = (
        F.when(~F.col("tgt_exists"), "MISSING").when(F.col("is_dir") != F.col("tgt_is_dir"), "CONFLICT").otherwise("OK")
    )
    setters = F.array_compact(
        F.array(
            F.when(~_merged("acl").eqNullSafe(_merged("tgt_acl")), F.lit("acl")),
            F.when(~F.col("sticky").eqNullSafe(F.col("tgt_sticky")), F.lit("permission")),
            F.when(
                ~(F.col("group").eqNullSafe(F.col("tgt_group")) & F.col("owner").eqNullSafe(F.col("tgt_owner"))),
                F.lit("owner"),
            ),
        )
    )
    empty = F.array().cast("array<string>")
    return rows.withColumn("status", status).select(
        key,
        "status",
        "owner",
        "group",
        "acl",
        F.when(F.col("status") == "OK", setters).otherwise(empty).alias("setters"),
    )

