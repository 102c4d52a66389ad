"""Options of a run, validated when they are built."""

from __future__ import annotations

from dataclasses import dataclass, field

from .errors import InvalidInputError

# Attribute letters and defaults that users of a copy run know.
ATTRIBUTES = {
    "R": "replication",
    "B": "blocksize",
    "U": "user",
    "G": "group",
    "P": "permission",
    "C": "checksumtype",
    "A": "acl",
    "X": "xattr",
    "T": "times",
}
DEFAULT_PRESERVE = "rbugpct"
DEFAULT_MAX_MAPS = 20
DEFAULT_TASKS_PER_BOX = 6
DEFAULT_BANDWIDTH_MB = 100
DEFAULT_BUFFER_BYTES = 8 * 1024
MAX_CHUNKS_TOLERABLE = 400
MAX_CHUNKS_IDEAL = 100
MIN_RECORDS_PER_CHUNK = 5
SPLIT_RATIO = 2


def parse_preserve(letters: str | None) -> frozenset[str]:
    """Attribute letters to a set of names; ``None`` is "nothing", unknown letters raise."""
    names = set()
    for letter in letters or "":
        name = ATTRIBUTES.get(letter.upper())
        if name is None:
            raise InvalidInputError(f"No attribute for {letter!r}")
        names.add(name)
    return frozenset(names)


def pack_attributes(names) -> str:
    """The inverse of :func:`parse_preserve`, in the fixed order of ``ATTRIBUTES``."""
    wanted = set(names)
    unknown = wanted - set(ATTRIBUTES.values())
    if unknown:
        raise InvalidInputError(f"Unknown attributes {sorted(unknown)}")
    return "".join(letter for letter, name in ATTRIBUTES.items() if name in wanted)


@dataclass(frozen=True)
class SyncOptions:
    update: bool = False
    overwrite: bool = False
    append: bool = False
    skip_crc: bool = False
    strict_checksums: bool = False
    ignore_failures: bool = False
    verbose: bool = False
    log_path: str | None = None
    diff: tuple[str, str] | None = None
    preserve: frozenset[str] = field(default_factory=frozenset)
    max_maps: int = DEFAULT_MAX_MAPS
    tasks_per_box: int = DEFAULT_TASKS_PER_BOX
    bandwidth_mb: int = DEFAULT_BANDWIDTH_MB
    buffer_bytes: int = DEFAULT_BUFFER_BYTES

    def __post_init__(self):
        def need(ok, message):
            if not ok:
                raise InvalidInputError(message)

        if isinstance(self.preserve, str):
            object.__setattr__(self, "preserve", parse_preserve(self.preserve))
        need(not (self.overwrite and self.update), "overwrite and update exclude each other")
        need(self.update or not self.skip_crc, "skip_crc needs update")
        need(self.update or not self.append, "append needs update")
        need(not (self.skip_crc and self.append), "append cannot be used with skip_crc")
        need(self.update or self.diff is None, "diff needs update")
        need(
            self.diff is None or (len(self.diff) == 2 and all(name and name.strip() for name in self.diff)),
            "diff needs a start and an end snapshot name",
        )
        need(self.log_path is not None or not self.verbose, "verbose needs log_path")
        for name in ("max_maps", "tasks_per_box", "bandwidth_mb", "buffer_bytes"):
            need(getattr(self, name) > 0, f"{name} must be positive")


def split_ratio(
    maps: int,
    records: int,
    *,
    ideal: int = MAX_CHUNKS_IDEAL,
    min_records: int = MIN_RECORDS_PER_CHUNK,
    ratio: int = SPLIT_RATIO,
) -> int:
    """How many chunks each of ``maps`` workers should get; non-positive settings fall back to defaults."""
    ideal = ideal if ideal > 0 else MAX_CHUNKS_IDEAL
    min_records = min_records if min_records > 0 else MIN_RECORDS_PER_CHUNK
    ratio = ratio if ratio > 0 else SPLIT_RATIO
    if maps == 1:
        return 1
    if maps > ideal:
        return ratio
    pickups = -(-ideal // maps)
    per_chunk = -(-records // (maps * pickups))
    return ratio if per_chunk < min_records else pickups


def check_chunk_count(ratio: int, maps: int, tolerable: int = MAX_CHUNKS_TOLERABLE) -> None:
    tolerable = tolerable if tolerable > 0 else MAX_CHUNKS_TOLERABLE
    if ratio * maps > tolerable:
        raise InvalidInputError(
            f"Too many chunks: {ratio} x {maps} > {tolerable}. Use fewer maps or a smaller ratio."
        )
