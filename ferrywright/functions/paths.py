"""Path expressions. All run inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URI_PREFIX = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def uri_path(path: str | Column) -> Column:
    """The path part of a URI: scheme and authority removed."""
    return F.regexp_replace(_col(path), URI_PREFIX, "")


def file_system(path: str | Column) -> Column:
    """Scheme and authority of a path, ``''`` for an unqualified one."""
    return F.regexp_extract(_col(path), URI_PREFIX, 1)


def qualify(path: str | Column, default_fs: str) -> Column:
    """Prefix paths that have no scheme with the default file system."""
    path = _col(path)
    return F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), path).otherwise(
        F.concat(F.lit(default_fs.rstrip("/")), path)
    )


def parent(path: str | Column) -> Column:
    cut = F.regexp_replace(_col(path), r"/[^/]+/?$", "")
    return F.when(uri_path(cut) == "", F.concat(cut, F.lit("/"))).otherwise(cut)


def relative_path(root: str | Column, path: str | Column) -> Column:
    """``path`` below ``root``: ``''`` for the root itself, else starting with ``/``."""
    root_path, child = uri_path(root), uri_path(path)
    return F.when(root_path == "/", child).otherwise(F.substr(child, F.length(root_path) + 1))


def source_root(path: str | Column, is_dir: str | Column, n_sources: int | Column, replace_content: bool) -> Column:
    """The root that relative paths of one source are taken from.

    ``replace_content`` is true for update and overwrite runs.
    """
    path, is_dir = _col(path), _col(is_dir)
    single = (n_sources if isinstance(n_sources, Column) else F.lit(n_sources)) == 1
    own = (single & ~is_dir) | ((single | F.lit(replace_content)) & is_dir) | (uri_path(path) == "/")
    return F.when(own, path).otherwise(parent(path))


def target_uri(base: str | Column, rel_path: str | Column) -> Column:
    """Target of a row: the box base with its relative path appended; an empty one is the base."""
    return F.concat(F.regexp_replace(_col(base), "/+$", ""), _col(rel_path))


def box_uri(dns: str | Column, key: str | Column, container: str | Column) -> Column:
    """A box without an account key names its URI directly; otherwise a blob-store URI is built."""
    no_key = F.coalesce(F.trim(_col(key)), F.lit("")) == ""
    built = F.concat(F.lit("wasb://"), _col(container), F.lit("@"), _col(dns), F.lit("/"))
    return F.when(no_key, _col(dns)).otherwise(built)


def is_chunk(length: str | Column = "length", chunk_length: str | Column = "chunk_length") -> Column:
    """Does a row stand for only a part of its file?"""
    return (_col(chunk_length) != F.lit(2**63 - 1)) & (_col(chunk_length) != _col(length))


def size_to_copy(length: str | Column = "length", chunk_length: str | Column = "chunk_length") -> Column:
    return F.when(is_chunk(length, chunk_length), _col(chunk_length)).otherwise(_col(length))


def chunk_path(path: str | Column, offset: str | Column, length: str | Column, marker: str = ".____split____") -> Column:
    """Temporary name of one chunk of a file."""
    return F.concat(_col(path), F.lit(marker), _col(offset).cast("string"), F.lit("."), _col(length).cast("string"))


def depth(path: str | Column) -> Column:
    """Number of names in an absolute path."""
    path = _col(path)
    return F.length(path) - F.length(F.replace(path, F.lit("/")))


def upto(path: str | Column, names: str | Column) -> Column:
    """The first ``names`` names of an absolute path."""
    return F.call_function("substring_index", _col(path), F.lit("/"), _col(names) + 1)


def directory(path: str | Column) -> Column:
    """The directory of an absolute path; ``''`` for one at the top."""
    return upto(path, depth(path) - 1)
