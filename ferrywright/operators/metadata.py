"""Plans of metadata changes: which attributes of a target have to be set, and to what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import CapabilityError
from ..functions.access import comparable_map, filter_xattrs
from ..options import SyncOptions
from .reconcile import match_target


def preserve_plan(
    src: DataFrame,
    tgt: DataFrame,
    attributes,
    *,
    key: str = "rel_path",
    raw_xattrs: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``key, setters`` for every source row with a target: the calls needed to carry ``attributes`` over.

    Setters, in call order: acl (else permission), permission for the sticky bit, xattr, replication
    (files only), owner (user or group differ), times (whenever asked for). Identities are expected to be
    translated already. Columns of attributes not asked for are not read. A manifest without ``acl`` or ``xattrs`` is
    that of a store without them: asking for these raises ``CapabilityError``.
    """
    attributes = set(attributes)
    for name, column, asked in (("acl", "acl", "acl" in attributes), ("xattr", "xattrs", "xattr" in attributes or raw_xattrs)):
        for side, df in (("source", src), ("target", tgt)):
            if asked and column not in df.columns:
                raise CapabilityError(f"The {side} has no column {column}", name)
    names = ["is_dir"]
    tests = []

    def differs(*columns):
        names.extend(columns)
        out = F.lit(False)
        for c in columns:
            out = out | ~F.col(c).eqNullSafe(F.col(f"tgt_{c}"))
        return out

    if "acl" in attributes:
        names.append("acl")
        missing = F.array().cast("array<struct<scope:string,type:string,name:string,perm:string>>")
        tests.append(("acl", ~F.coalesce("acl", missing).eqNullSafe(F.coalesce("tgt_acl", missing))))
        tests.append(("permission", differs("sticky")))
    elif "permission" in attributes:
        tests.append(("permission", differs("perm", "sticky")))
    if "xattr" in attributes or raw_xattrs:
        names.append("xattrs")
        # Names of namespaces that aren't asked for neither count as a difference nor hide one.
        own, other = (filter_xattrs(c, raw=raw_xattrs, regular="xattr" in attributes) for c in ("xattrs", "tgt_xattrs"))
        has_any = F.size(F.coalesce(F.map_keys(own), F.array().cast("array<string>"))) > 0
        unequal = ~comparable_map(own).eqNullSafe(comparable_map(other))
        tests.append(("xattr", unequal & has_any))
    if "replication" in attributes:
        tests.append(("replication", differs("replication") & ~F.col("tgt_is_dir")))
    owner = [c for c, a in (("group", "group"), ("owner", "user")) if a in attributes]
    if owner:
        tests.append(("owner", differs(*owner)))
    if "times" in attributes:
        tests.append(("times", F.lit(True)))

    columns = list(dict.fromkeys(names))
    rows = match_target(src.select(key, *dict.fromkeys([*columns, *keep])), tgt, key, tuple(columns)).filter("tgt_exists")
    setters = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(test, F.lit(name)) for name, test in tests]))
    return rows.select(key, *keep, setters.alias("setters"))


def create_attributes(df: DataFrame, options: SyncOptions, *, replication: int, block_size: int) -> DataFrame:
    """Add ``want_replication`` and ``want_block_size``, with which a copy creates each file.

    They are those of the source if to be preserved, else the given defaults of the target. Preserving the
    checksum type needs equal block sizes too.
    """
    keep_blocks = bool(options.preserve & {"blocksize", "checksumtype"})
    return df.withColumns(
        {
            "want_replication": (
                F.col("replication") if "replication" in options.preserve else F.lit(replication).cast("smallint")
            ),
            "want_block_size": F.col("block_size") if keep_blocks else F.lit(block_size).cast("bigint"),
        }
    )
