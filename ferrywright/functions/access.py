"""ACL and extended-attribute expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import _col

# Symbolic form of the eight permission triples, by octal digit.
TRIPLES = ("---", "--x", "-w-", "-wx", "r--", "r-x", "rw-", "rwx")


def _triple(perm: Column, shift: int) -> Column:
    digit = F.shiftright(perm, shift).bitwiseAND(F.lit(7))
    return F.element_at(F.array(*[F.lit(t) for t in TRIPLES]), digit + 1)


def acl_entry(scope, type_, name, perm) -> Column:
    def value(v):
        return v if isinstance(v, Column) else F.lit(v).cast("string")

    return F.struct(
        value(scope).alias("scope"), value(type_).alias("type"), value(name).alias("name"), value(perm).alias("perm")
    )


def logical_acl(perm: str | Column, acl: str | Column) -> Column:
    """Permission bits and extended entries as one full entry list.

    Without extended entries: owner, group and other taken from the bits. With them the group bits are
    the mask, so the list is owner, the access entries, the mask, other, then the default entries.
    """
    perm = _col(perm)
    acl = F.coalesce(_col(acl), F.array().cast("array<struct<scope:string,type:string,name:string,perm:string>>"))
    owner = acl_entry("ACCESS", "USER", None, _triple(perm, 6))
    group = acl_entry("ACCESS", "GROUP", None, _triple(perm, 3))
    mask = acl_entry("ACCESS", "MASK", None, _triple(perm, 3))
    other = acl_entry("ACCESS", "OTHER", None, _triple(perm, 0))
    access = F.filter(acl, lambda e: e["scope"] == "ACCESS")
    default = F.filter(acl, lambda e: e["scope"] == "DEFAULT")
    minimal = F.array(owner, group, other)
    extended = F.concat(F.array(owner), access, F.array(mask, other))
    return F.concat(F.when(F.size(access) == 0, minimal).otherwise(extended), default)


def _joined_perm(entries: Column) -> Column:
    """The permissions that any of ``entries`` gives."""
    bit = lambda i, letter: F.when(F.exists(entries, lambda e: e["perm"].substr(i, 1) == letter), letter).otherwise("-")
    return F.concat(bit(1, "r"), bit(2, "w"), bit(3, "x"))


def merge_entries(acl: str | Column) -> Column:
    """An entry list in which no identity stands twice: entries of one scope, type and name become one, with all their permissions.

    An entry stays where its first one stood. The mask of a scope in which entries were joined is computed anew, from named users
    and all groups, so that it doesn't cut what was joined. Lists have a few dozen entries at most.
    """
    acl = _col(acl)
    key = lambda e: F.struct(e["scope"].alias("scope"), e["type"].alias("type"), e["name"].alias("name"))
    keys = F.array_distinct(F.transform(acl, key))
    same = lambda e, k: (e["scope"] == k["scope"]) & (e["type"] == k["type"]) & e["name"].eqNullSafe(k["name"])
    masked = lambda e, scope: (e["scope"] == scope) & ((e["type"] == "GROUP") | ((e["type"] == "USER") & e["name"].isNotNull()))
    count = lambda entries, scope: F.size(F.filter(entries, lambda e: e["scope"] == scope))

    def merged(k):
        perm = _joined_perm(F.filter(acl, lambda e: same(e, k)))
        mask = _joined_perm(F.filter(acl, lambda e: masked(e, k["scope"])))
        anew = (k["type"] == "MASK") & (count(acl, k["scope"]) > count(keys, k["scope"]))
        return F.struct(k["scope"].alias("scope"), k["type"].alias("type"), k["name"].alias("name"), F.when(anew, mask).otherwise(perm).alias("perm"))

    return F.transform(keys, merged)


def filter_xattrs(xattrs: str | Column, *, raw: bool, regular: bool, prefix: str = "raw") -> Column:
    """Keep ``raw*`` names only with ``raw``, the others only with ``regular``."""
    xattrs = _col(xattrs)
    if raw and regular:
        return xattrs
    return F.map_filter(
        xattrs,
        lambda name, _: F.when(name.startswith(prefix), F.lit(raw)).otherwise(F.lit(regular)),
    )


def comparable_map(m: str | Column) -> Column:
    """Maps cannot be compared; a sorted entry list can. A null map equals an empty one."""
    return F.coalesce(
        F.array_sort(F.map_entries(_col(m))), F.array().cast("array<struct<key:string,value:binary>>")
    )
