"""Fill-in-middle: a text's middle goes last, behind sentinels, by rotations inside one buffer.

The text's UTF-8 bytes are scanned for the two cuts, which are counted in code points. Sentinels are inserted at the cuts, so the
buffer reads ``<P>`` prefix ``<M>`` middle ``<S>`` suffix; then neighbouring segments change places by three reversals (each segment, then both together):
middle and suffix for the form ``psm``, suffix and all before it for ``spm``. ``restore`` finds the sentinels, does the same
rotations backwards and takes the sentinels out, which gives the text byte by byte. A reversal swaps blocks of ``BLOCK`` bytes from
both ends, and a scan looks at one block at a time, so a text needs little more than its own size however long it is.

Cuts and form come from a hash of ``seed`` and the document's id, so any task, and any later run, decides alike: equal ids cut
alike, also where texts differ; a null id counts as the empty string. A text is left as it is (form ``plain``; character
columns null) if it is null (taken as empty) or empty, holds a sentinel, or falls into the plain share. Very long texts are
cut like others. Repeated rows give repeated results, empty tables empty ones, and other columns, of any name, are passed over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # no sentinel can begin inside another
PLAIN_FROM, SPM_BELOW = 90, 20  # percent
BLOCK = 1 << 16

_P, _S, _M = (s.encode() for s in (PREFIX, SUFFIX, MIDDLE))


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Turn ``buffer[start:end]`` round in place, a block from either end at a time."""
    while end - start > 1:
        k = min(BLOCK, (end - start) // 2)
        low, high = buffer[start : start + k], buffer[end - k : end]
        low.reverse()
        high.reverse()
        buffer[start : start + k], buffer[end - k : end] = high, low
        start, end = start + k, end - k


def exchange(buffer: bytearray, start: int, border: int, end: int) -> None:
    """Let the segments ``start:border`` and ``border:end`` change places."""
    reverse(buffer, start, border)
    reverse(buffer, border, end)
    reverse(buffer, start, end)


def offsets(data: bytes | bytearray, points: tuple[int, ...]) -> list[int]:
    """Byte offsets of rising code-point positions in UTF-8 ``data``; positions at the end give its length."""
    found, seen, at, wanted = [], 0, 0, list(points)
    while wanted and at < len(data):
        first = (np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at) & 0xC0) != 0x80
        here = int(first.sum())
        if wanted[0] < seen + here:
            starts = np.flatnonzero(first)
            while wanted and wanted[0] < seen + here:
                found.append(at + int(starts[wanted.pop(0) - seen]))
        seen, at = seen + here, at + len(first)
    return found + [len(data)] * len(wanted)


def rotate(text: str, low: int, high: int, form: str) -> bytes:
    """The text in ``form`` (psm or spm) with its middle between the code points ``low`` and ``high``."""
    buffer = bytearray(text, "utf-8")
    a, b = offsets(buffer, (low, high))
    buffer[b:b] = _S
    buffer[a:a] = _M
    buffer[0:0] = _P
    middle, suffix = a + len(_P), b + len(_P) + len(_M)
    exchange(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def unrotate(output: str, form: str) -> bytes:
    """The text that ``rotate`` was given."""
    buffer = bytearray(output, "utf-8")
    if form == "plain":
        return buffer
    if form == "psm":
        start = buffer.index(_S)
        border = buffer.index(_M, start)
    else:
        start, border = 0, buffer.index(_P)
    exchange(buffer, start, border, len(buffer))  # what came last goes back before it
    a = buffer.index(_M)
    b = buffer.index(_S, a)
    del buffer[b : b + len(_S)]
    del buffer[a : a + len(_M)]
    del buffer[: len(_P)]
    return buffer


def _strings(values: list) -> pa.Array:
    return pa.array([v if isinstance(v, str) else bytes(v).decode("utf-8") for v in values], pa.string())


def transform(docs: DataFrame, seed: str = "1") -> DataFrame:
    """Per row: doc_id, n (code points), form, prefix_chars, middle_chars, output."""
    text = F.coalesce(docs["text"], F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    n = F.length(text).cast("long")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (n == 0) | marked | (h[2] % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    cuts = [F.when(~plain, f(h[0] % (n + 1), h[1] % (n + 1))) for f in (F.least, F.greatest)]
    rows = docs.select(docs["doc_id"].alias("doc_id"), n.alias("n"), form.alias("form"), cuts[0].alias("low"), cuts[1].alias("high"), text.alias("text"))

    def turn(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("form", "low", "high")]
            out = [t.as_py() if f == "plain" else rotate(t.as_py(), a, b, f) for t, f, a, b in zip(batch.column("text"), *columns)]
            kept = [batch.column(c) for c in ("doc_id", "n", "form", "low", "high")]
            yield pa.RecordBatch.from_arrays([*kept, _strings(out)], ["doc_id", "n", "form", "low", "high", "output"])

    schema = T.StructType([*rows.drop("text").schema, T.StructField("output", T.StringType())])
    out = rows.mapInArrow(turn, schema)
    return out.select("doc_id", "n", "form", F.col("low").alias("prefix_chars"), (F.col("high") - F.col("low")).alias("middle_chars"), "output")


def restore(rows: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``restored``, made from output and form alone."""

    def back(batches):
        for batch in batches:
            texts = [unrotate(o.as_py(), f) for o, f in zip(batch.column("output"), batch.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, _strings(texts)], [*batch.schema.names, "restored"])

    return rows.mapInArrow(back, T.StructType([*rows.schema, T.StructField("restored", T.StringType())]))
