"""The copy job: the planned actions carried out by tasks, one result row per planned row."""

from __future__ import annotations

import hashlib
import os
import time
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CopyFailedError
from ..files import length_of, open_fs
from ..functions.paths import chunk_path
from ..options import SyncOptions
from ..scratch import cut, store
from .splits import chunk_files, part_coverage

# Attempts, first pause and throttle pause of the retry and bandwidth policies.
ATTEMPTS = 3
FIRST_PAUSE_SEC = 0.5
THROTTLE_PAUSE_SEC = 0.05

RESULT = (
    "rel_path string, path string, target_uri string, action string, status string, length bigint, "
    "bytes_expected bigint, bytes_copied bigint, tgt_length bigint, attempts int, checksum string, "
    "error_class string, error string, split_id int, started_ms bigint, finished_ms bigint"
)
PLAN_COLUMNS = ["rel_path", "path", "target_uri", "action", "is_dir", "length", "tgt_length", "split_id"]


class ReadError(OSError):
    """The source could not be read; the failure policy may ignore it."""


class WriteError(OSError):
    """The target could not be written or differs after the copy."""


def _transfer(source, sink, limit, options, digest) -> int:
    """Copy up to ``limit`` bytes (all if None), hashing them and holding to the bandwidth of a task."""
    started, copied, cap = time.monotonic(), 0, options.bandwidth_mb * 1024 * 1024
    while limit is None or copied < limit:
        while copied / max(1.0, time.monotonic() - started) > cap:
            time.sleep(THROTTLE_PAUSE_SEC)
        want = options.buffer_bytes if limit is None else min(options.buffer_bytes, limit - copied)
        try:
            data = source.read(want)
        except OSError as e:
            raise ReadError(str(e)) from e
        if not data:
            break
        digest.update(data)
        sink.write(data)
        copied += len(data)
    return copied


def _open_source(uri: str):
    try:
        store, name = open_fs(uri)
        return store.open_input_file(name)
    except OSError as e:
        raise ReadError(str(e)) from e


def _hash_of(stream, limit: int | None):
    digest, left = hashlib.md5(), limit
    while left is None or left > 0:
        data = stream.read(1 << 20 if left is None else min(1 << 20, left))
        if not data:
            break
        digest.update(data)
        left = None if left is None else left - len(data)
    return digest


def _overwrite(row, options) -> tuple[int, str]:
    """Write to a temporary name and rename, so a task that runs twice leaves one whole file."""
    store, name = open_fs(row.target_uri)
    store.create_dir(os.path.dirname(name), recursive=True)
    partial = f"{name}._copying_{uuid.uuid4().hex}"
    digest = hashlib.md5()
    try:
        with _open_source(row.path) as source:
            expected = source.size()
            with store.open_output_stream(partial) as sink:
                copied = _transfer(source, sink, None, options, digest)
        if copied != expected:
            raise WriteError(f"Mismatch in length of {row.path} ({expected}) and {row.target_uri} ({copied})")
        if copied and not options.skip_crc:
            with store.open_input_file(partial) as written:
                if _hash_of(written, None).digest() != digest.digest():
                    raise WriteError(f"Checksum mismatch between {row.path} and {row.target_uri}")
        store.move(partial, name)
    except BaseException:
        if length_of(store, partial) is not None:
            store.delete_file(partial)
        raise
    return copied, digest.hexdigest()


def _append(row, options) -> tuple[int, str]:
    """Add what the target lacks.

    Appending twice would spoil the file: the length is read again here, and a target that a former
    attempt completed gets nothing more. The part already there must equal the source.
    """
    store, name = open_fs(row.target_uri)
    with _open_source(row.path) as source:
        expected = source.size()
        present = length_of(store, name) or 0
        digest = _hash_of(source, present)
        with store.open_input_file(name) as written:
            if _hash_of(written, None).digest() != digest.digest():
                raise WriteError(f"{row.target_uri} is not a prefix of {row.path}")
        if present < expected:
            source.seek(present)
            with store.open_append_stream(name) as sink:
                _transfer(source, sink, expected - present, options, digest)
    final = length_of(store, name)
    if final != expected:
        raise WriteError(f"Mismatch in length of {row.path} ({expected}) and {row.target_uri} ({final})")
    return expected - int(row.tgt_length), digest.hexdigest()


def _make_dir(row) -> None:
    store, name = open_fs(row.target_uri)
    store.create_dir(name, recursive=True)


def _carry_out(row, options: SyncOptions, pause: float) -> dict:
    """Do what one row asks for, with retries, and tell how it went."""
    out = {
        "rel_path": row.rel_path,
        "path": row.path,
        "target_uri": row.target_uri,
        "action": row.action,
        "status": "OK",
        "length": row.length,
        "bytes_expected": 0 if row.action == "MKDIR" else row.length,
        "bytes_copied": 0,
        "tgt_length": None if pd.isna(row.tgt_length) else int(row.tgt_length),
        "attempts": 0,
        "checksum": None,
        "error_class": None,
        "error": None,
        "split_id": row.split_id,
        "started_ms": int(time.time() * 1000),
    }
    while True:
        out["attempts"] += 1
        try:
            if row.action == "MKDIR":
                _make_dir(row)
            else:
                step = _overwrite if row.action == "OVERWRITE" else _append
                out["bytes_copied"], out["checksum"] = step(row, options)
            break
        except (OSError, pa.ArrowException) as e:  # stores raise Arrow's own errors for what they don't support
            if out["attempts"] >= ATTEMPTS or not isinstance(e, OSError):
                kind = "read" if isinstance(e, ReadError) else "write"
                out |= {"status": "FAIL", "error_class": kind, "error": str(e), "bytes_copied": 0}
                break
            time.sleep(pause * 2 ** (out["attempts"] - 1))
    out["finished_ms"] = int(time.time() * 1000)
    return out


def _settled(rows: DataFrame) -> DataFrame:
    """Results of rows that need no work: skipped ones and conflicts."""
    now = F.unix_millis(F.current_timestamp())
    conflict = F.col("action") == "CONFLICT"
    clash = F.concat(F.lit("Can't replace "), "target_uri", F.lit(": one is a directory, the other a file"))
    values = {
        "status": F.when(conflict, "FAIL").otherwise("OK"),
        "bytes_expected": F.lit(0),
        "bytes_copied": F.lit(0),
        "attempts": F.lit(0),
        "checksum": F.lit(None),
        "error_class": F.when(conflict, "conflict"),
        "error": F.when(conflict, clash),
        "started_ms": now,
        "finished_ms": now,
    }
    rows = rows.withColumns(values)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(RESULT)])


def copy_files(plan: DataFrame, options: SyncOptions, *, pause: float = FIRST_PAUSE_SEC) -> DataFrame:
    """Carry out ``plan`` and return the stored result table (see ``RESULT``).

    ``plan`` has ``rel_path, path, target_uri, action, is_dir, length, tgt_length, split_id`` and is stored
    before anything is copied. Every split is one partition, so the plan's byte balance is the balance of
    the tasks. The result is written by the same job that copies: reading it again never copies again.
    Skipped rows, most of them in a repeated run, do not pass through Python. Speculation has to be off,
    since two attempts would write the same target. The number of splits bounds
    the concurrency; the bandwidth limit holds per running task.
    """
    spark = plan.sparkSession
    if spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true":
        raise CopyFailedError("Set spark.speculation=false for jobs with side effects")
    path, seen = store(plan.select(*PLAN_COLUMNS), "copy-plan", last=F.max("split_id"))
    stored = spark.read.schema(plan.select(*PLAN_COLUMNS).schema).parquet(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([_carry_out(row, options, pause) for row in pdf.itertuples(index=False)])

    to_do = F.col("action").isin("MKDIR", "OVERWRITE", "APPEND")
    work = stored.filter(to_do).repartitionById((seen["last"] or 0) + 1, F.col("split_id").cast("int"))
    done = work.mapInPandas(run, RESULT)
    return cut(done.unionByName(_settled(stored.filter(~to_do))), "copy-result")


def file_checksums(df: DataFrame, limit: str | None = None, name: str = "checksum", key: str = "rel_path") -> DataFrame:
    """``key, name``: md5 of the file at ``path``, or of its first ``limit`` bytes; null for directories.

    Hashing reads whole files, so pass only the rows whose checksum decides something.
    """
    up_to = F.lit(None).cast("bigint") if limit is None else F.col(limit)

    def run(batches):
        for pdf in batches:
            sums = []
            for path, is_dir, n in zip(pdf["path"], pdf["is_dir"], pdf["_limit"]):
                if is_dir:
                    sums.append(None)
                    continue
                with _open_source(path) as source:
                    sums.append(_hash_of(source, None if pd.isna(n) else int(n)).hexdigest())
            yield pd.DataFrame({key: pdf[key], name: sums})

    rows = df.select(key, "path", "is_dir", up_to.alias("_limit"))
    return rows.mapInPandas(run, f"{key} string, {name} string")


def file_prefixes(candidates: DataFrame) -> DataFrame:
    """Prefix checksums of append candidates that are files, for ``reconcile``."""
    return file_checksums(candidates, "tgt_length", "prefix_checksum")


def stream_digests(stream, lengths: list[int]) -> list[str]:
    """md5 of the first bytes of a stream, one for each of the rising ``lengths``, and of all of it, in one pass.

    A length beyond the end gives the digest of all.
    """
    digest, out, done = hashlib.md5(), [], 0
    for end in [*lengths, None]:
        while end is None or done < end:
            data = stream.read(1 << 20 if end is None else min(1 << 20, end - done))
            if not data:
                break
            digest.update(data)
            done += len(data)
        out.append(digest.copy().hexdigest())
    return out


def file_digests(candidates: DataFrame, key: str = "rel_path") -> DataFrame:
    """``key, checksum, prefix_checksum, error`` of files at ``path``: of the whole and of its first ``tgt_length`` bytes, read once.

    A file that cannot be read after ``ATTEMPTS`` has null digests and the reason as ``error``; the others are not affected.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for path, n in zip(pdf["path"], pdf["tgt_length"]):
                reason = None
                for _ in range(ATTEMPTS):
                    try:
                        with _open_source(path) as source:
                            prefix, whole = stream_digests(source, [int(n)])
                        rows.append((whole, prefix, None))
                        break
                    except OSError as e:
                        reason = str(e)
                else:
                    rows.append((None, None, reason))
            out = pd.DataFrame(rows, columns=["checksum", "prefix_checksum", "error"])
            yield out.assign(**{key: pdf[key].to_numpy()})[[key, "checksum", "prefix_checksum", "error"]]

    rows = candidates.select(key, "path", F.coalesce("tgt_length", F.lit(0)).alias("tgt_length"))
    return rows.mapInPandas(run, f"{key} string, checksum string, prefix_checksum string, error string")


def copy_chunks(files: DataFrame, chunk_bytes: int, options: SyncOptions, parallelism: int) -> DataFrame:
    """Copy byte ranges of large files as separate tasks into part files next to the target.

    ``files`` has ``path, target_uri, length``. Returns ``path, part_uri, chunk_offset, chunk_length,
    bytes_copied, checksum``. Ranges are spread over all tasks, so one huge file keeps no task busy alone.
    """
    parts = chunk_files(files.select("path", "target_uri", "length"), chunk_bytes).withColumn(
        "part_uri", chunk_path("target_uri", "chunk_offset", "chunk_length")
    )

    def run(batches):
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                store, name = open_fs(row.part_uri)
                store.create_dir(os.path.dirname(name), recursive=True)
                digest, partial = hashlib.md5(), f"{name}._copying_{uuid.uuid4().hex}"
                with _open_source(row.path) as source, store.open_output_stream(partial) as sink:
                    source.seek(row.chunk_offset)
                    copied = _transfer(source, sink, row.chunk_length, options, digest)
                if copied != row.chunk_length:
                    store.delete_file(partial)
                    raise WriteError(f"Mismatch in length of {row.part_uri}")
                store.move(partial, name)
                rows.append((row.path, row.part_uri, row.chunk_offset, row.chunk_length, copied, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "part_uri", "chunk_offset", "chunk_length", "bytes_copied", "checksum"])

    schema = "path string, part_uri string, chunk_offset bigint, chunk_length bigint, bytes_copied bigint, checksum string"
    return cut(parts.repartition(parallelism, "path", "chunk_offset").mapInPandas(run, schema), "chunk-result")


def assemble_chunks(files: DataFrame, parts: DataFrame, options: SyncOptions) -> DataFrame:
    """Join the part files of ``copy_chunks`` to whole files: ``path, target_uri, status, bytes_copied, checksum, error``.

    Only files whose parts cover them exactly (``part_coverage``) are written, each by one task, under a temporary name that is renamed; then
    the parts go. The others FAIL with the fault and the byte at which it is seen, and keep their parts. A file that a
    lost task had finished is recognised by its length and taken as done.
    """
    told = part_coverage(files, parts)
    order = F.array_sort(F.collect_list(F.struct("chunk_offset", "chunk_length", "part_uri")))  # names of one file's parts
    rows = files.select("path", "target_uri", "length").join(told, "path").join(parts.groupBy("path").agg(order.alias("_parts")), "path", "left")

    def join(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row.verdict != "OK":
                    out.append((row.path, row.target_uri, "FAIL", 0, None, f"{row.verdict} at {int(row.at)}"))
                    continue
                try:
                    out.append((row.path, row.target_uri, "OK", *_assemble(row, options), None))
                except OSError as e:
                    out.append((row.path, row.target_uri, "FAIL", 0, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "target_uri", "status", "bytes_copied", "checksum", "error"])

    columns = rows.select("path", "target_uri", "length", "verdict", "at", F.transform("_parts", lambda p: p["part_uri"]).alias("parts_in_order"))
    schema = "path string, target_uri string, status string, bytes_copied bigint, checksum string, error string"
    return cut(columns.mapInPandas(join, schema), "assembled")


def _assemble(row, options) -> tuple[int, str | None]:
    store, name = open_fs(row.target_uri)
    opened = [open_fs(p) for p in row.parts_in_order]
    if length_of(store, name) == row.length and any(length_of(s, p) is None for s, p in opened):
        copied, digest = int(row.length), None  # a former attempt got as far as deleting parts
    else:
        partial, md5, copied = f"{name}._assembling_{uuid.uuid4().hex}", hashlib.md5(), 0
        with store.open_output_stream(partial) as sink:
            for part_store, part in opened:
                with part_store.open_input_file(part) as source:
                    copied += _transfer(source, sink, None, options, md5)
        if copied != row.length:
            store.delete_file(partial)
            raise WriteError(f"Mismatch in length of {row.target_uri} ({copied} of {int(row.length)})")
        store.move(partial, name)
        digest = md5.hexdigest()
    for part_store, part in opened:
        if length_of(part_store, part) is not None:
            part_store.delete_file(part)
    return copied, digest


def failures(result: DataFrame) -> DataFrame:
    return result.filter(F.col("status") == "FAIL")


def enforce_failures(result: DataFrame, options: SyncOptions, all_io: bool = False) -> DataFrame:
    """Raise unless the failures are ignorable: read failures, or any I/O failure with ``all_io``."""
    fatal = failures(result)
    if options.ignore_failures:
        fatal = fatal.limit(0) if all_io else fatal.filter(F.col("error_class") != "read")
    first = fatal.select("path", "error").first()
    if first is not None:
        raise CopyFailedError(f"{first.path}: {first.error}")
    return result
