"""Access to file systems from inside tasks."""

from __future__ import annotations

import re


def local_path(uri: str) -> str | None:
    """The local form of an unqualified or ``file:`` path, else None."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return None if "://" in uri else uri


def qualified(uri: str, default_fs: str) -> str:
    """``uri`` on the default file system if it names none; paths of local disks stay as they are."""
    if default_fs.startswith("file:") or re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", uri):
        return uri
    return default_fs.rstrip("/") + uri


def open_fs(uri: str):
    """File system and path of a URI."""
    from pyarrow import fs

    local = local_path(uri)
    return fs.FileSystem.from_uri(uri) if local is None else (fs.LocalFileSystem(), local)


def length_of(store, name: str) -> int | None:
    """Length of a file, None where there is none."""
    from pyarrow import fs

    info = store.get_file_info(name)
    return None if info.type == fs.FileType.NotFound else info.size
