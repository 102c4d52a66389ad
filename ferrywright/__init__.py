"""Spark-native planning, execution and checking of bulk data migrations."""

from .errors import (
    CapabilityError,
    CopyFailedError,
    DuplicateTargetError,
    InvalidInputError,
    MigrationError,
)
from .options import SyncOptions, pack_attributes, parse_preserve

__all__ = [
    "CapabilityError",
    "CopyFailedError",
    "DuplicateTargetError",
    "InvalidInputError",
    "MigrationError",
    "SyncOptions",
    "pack_attributes",
    "parse_preserve",
]
