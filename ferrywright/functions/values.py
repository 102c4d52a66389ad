"""Checksums, sizes, times and attribute sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import ATTRIBUTES
from .paths import _col

# Unit letters of human-readable sizes, one per power of 1024.
UNITS = "BKMGTP"


def checksums_equal(left: str | Column, right: str | Column, strict: bool = False) -> Column:
    """Unknown checksums count as equal; with ``strict`` they count as different."""
    return F.coalesce(_col(left) == _col(right), F.lit(not strict))


def prefix_md5(text: str | Column, length: str | Column) -> Column:
    """Checksum of the first ``length`` characters."""
    return F.md5(F.substring(_col(text), F.lit(1), _col(length).cast("int")))


def human_bytes(n: str | Column) -> Column:
    """``1536`` -> ``1.5K``; one decimal, halves to even."""
    n = _col(n).cast("bigint")
    out = None
    for power in reversed(range(len(UNITS))):
        scaled = n.cast("double") / F.lit(float(1024**power))
        text = F.concat(F.bround(scaled, 1).cast("decimal(20,1)").cast("string"), F.lit(UNITS[power]))
        out = text if out is None else out
        if power < len(UNITS) - 1:
            out = F.when(n < F.lit(1024 ** (power + 1)), text).otherwise(out)
    return out


def percent(done: str | Column, total: str | Column) -> Column:
    """Progress with one decimal, halves to even; null when the total is zero."""
    done, total = _col(done).cast("double"), _col(total).cast("double")
    return F.bround(done * 100.0 / F.nullif(total, F.lit(0.0)), 1)


def int_div(n: str | Column, by: str | Column | int) -> Column:
    """Integer division, exact for large numbers."""
    return F.call_function("div", _col(n), F.lit(by) if isinstance(by, int) else _col(by))


def bytes_per_second(n: str | Column, millis: str | Column) -> Column:
    """Bytes per whole second; below one second the bytes themselves."""
    return int_div(n, F.greatest(int_div(millis, 1000), F.lit(1)))


def timestamp_millis(ms: str | Column) -> Column:
    return F.timestamp_millis(_col(ms))


def attribute_names(letters: str | Column) -> Column:
    """Column form of attribute parsing: letters to an array of names, unknown letters raise."""
    table = F.create_map(*[F.lit(v) for pair in ATTRIBUTES.items() for v in pair])
    each = F.filter(F.split(F.upper(_col(letters)), ""), lambda c: c != "")
    names = F.transform(
        each,
        lambda c: F.coalesce(
            F.try_element_at(table, c), F.raise_error(F.concat(F.lit("No attribute for "), c)).cast("string")
        ),
    )
    return F.array_distinct(names)


def attribute_letters(names: str | Column) -> Column:
    """Array of names back to letters in the fixed order."""
    names = _col(names)
    return F.concat(
        *[F.when(F.array_contains(names, name), F.lit(letter)).otherwise(F.lit("")) for letter, name in ATTRIBUTES.items()]
    )


def skip_line(path: str | Column, line_format: str = "%s - cannot locate on any target box") -> Column:
    """One line of the report on rows that no box could hold."""
    return F.format_string(line_format, _col(path))


def padded_id(n: str | Column, width: int = 5) -> Column:
    return F.lpad(_col(n).cast("string"), width, "0")
