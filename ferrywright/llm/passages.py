"""Removal of repeated passages by super-k-mers.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash among its runs of ``SEED`` words. Equal windows
have equal minimisers, so consecutive windows of one minimiser travel together, as one packed string of their words,
to the minimiser's bucket, where the windows are sorted and counted by 128 bits of hash.

A minimiser that occurs once in all texts has no repeated window, so its string stays at home. Inside a task, a string
that was met before isn't sent again: both places are known to repeat. Where a minimiser occurs more than ``HOT`` times,
its windows travel one by one, dealt by their own hash, so that no bucket grows with a frequent phrase. Every word in a
repeated window is removed; windows are judged on the texts as they came.

Null texts have no words. Repeated rows are texts of their own, hence repeats of each other. Texts shorter than a
window lose nothing. Empty tables give empty results; other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import cut
from .wordhash import Texts, mix, slices

WINDOW = 35
SEED = 8
HOT = 20_000
SALTS = 16
CHUNK_BYTES = 4 << 20


def _least(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest of each ``k`` consecutive values, and where it is first."""

    def lower(a, b):
        left = a[0] <= b[0]
        return np.where(left, a[0], b[0]), np.where(left, a[1], b[1])

    have, span = (values, np.arange(len(values))), 1
    part = lambda x, i, j: (x[0][i:j], x[1][i:j])
    while span < k:
        step = min(span, k - span)
        n = len(have[0])
        have = lower(part(have, 0, n - step), part(have, step, n))
        span += step
    return have


def super_kmers(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in it, number of windows, and minimiser of each run of windows with one minimiser."""
    none = np.zeros(0, np.int64)
    n = len(t.starts)
    if n < WINDOW:
        return none, none, none, none.astype(np.uint64)
    at, seed = t.runs(t.hashes(), SEED)
    values = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    values[at] = seed
    least, where = _least(values, WINDOW - SEED + 1)
    starts = np.flatnonzero(t.doc[: n - WINDOW + 1] == t.doc[WINDOW - 1 :])
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    # A run ends where the minimiser's place changes, so equal windows are never in one run.
    key, where, doc = least[starts], where[starts], t.doc[starts]
    new = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])]))
    return doc[new], starts[new] - t.first[doc[new]], np.diff(np.append(new, len(starts))), key[new]


def _placed(docs: DataFrame) -> DataFrame:
    def place(batches):
        for batch in batches:
            text = batch.column("_text")
            for a, b in slices(text):
                doc, start, n, key = super_kmers(Texts(text.slice(a, b - a)))
                rows = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(rows), batch.column("_version").take(rows), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key.view(np.int64))],
                    ["_id", "_version", "_s", "_n", "_key"],
                )

    schema = T.StructType([docs.schema["_id"], docs.schema["_version"], T.StructField("_s", T.IntegerType()), T.StructField("_n", T.IntegerType()), T.StructField("_key", T.LongType())])
    return cut(docs.mapInArrow(place, schema), "places")


def _sent(docs: DataFrame) -> DataFrame:
    """Rows to the buckets: strings of windows, or (with null _words) places known to repeat."""
    names = ["_id", "_version", "_s", "_n", "_route", "_words"]
    kinds = [docs.schema["_id"].dataType, T.LongType(), T.IntegerType(), T.IntegerType(), T.LongType(), T.BinaryType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def send(batches):
        seen: dict[bytes, tuple | None] = {}  # where a string was met first; None once that place is told
        rows: list[tuple] = []
        size = 0

        def scatter(version, start):  # places that are told need no bucket
            return hash((version, start))

        def packed_rows(like):
            columns = list(zip(*rows)) if rows else [[]] * 6
            types = [like.schema.field("_id").type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            lists = batch.column("_c")
            flat = lists.flatten()
            fields = [flat.field(x).to_pylist() for x in ("_s", "_n", "_key", "_hot")]
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            ids, versions = batch.column("_id").to_pylist(), batch.column("_version").to_pylist()
            at = 0
            for i, end in enumerate(map(int, ends)):
                words = batch.column("_text")[i].as_py().encode().split() if end > at else []
                told = None  # the range of windows at the end of those known to repeat
                for s, n, key, hot in sorted(tuple(f[j] for f in fields) for j in range(at, end)):
                    for first, m in ((s + x, 1) for x in range(n)) if hot else ((s, n),):
                        packed = b" ".join(words[first : first + m + WINDOW - 1])
                        digest = hashlib.blake2b(packed, digest_size=16).digest()
                        route = int.from_bytes(digest[:7], "big") if hot else key
                        place = (ids[i], versions[i], first, m, route)
                        if digest not in seen:
                            seen[digest] = place
                            rows.append((*place, packed))
                            size += len(packed) + 64
                            continue
                        if seen[digest]:
                            rows.append((*seen[digest][:4], scatter(*seen[digest][1:3]), None))
                            seen[digest] = None
                            size += 64
                        if told and first <= told[1]:
                            told = (told[0], max(told[1], first + m))
                            continue
                        if told:
                            rows.append((ids[i], versions[i], told[0], told[1] - told[0], scatter(versions[i], told[0]), None))
                            size += 64
                        told = (first, first + m)
                if told:
                    rows.append((ids[i], versions[i], told[0], told[1] - told[0], scatter(versions[i], told[0]), None))
                at = end
                if size > CHUNK_BYTES:
                    yield packed_rows(batch)
                    rows, size = [], 0
            if rows:
                yield packed_rows(batch)
                rows, size = [], 0

    return docs.mapInArrow(send, schema)


def _counted(batch: pa.Table) -> pa.RecordBatch:
    """Places of repeated windows in rows that hold all strings of their routes."""
    words = batch.column("_words").combine_chunks()
    told = np.asarray(pa.compute.is_null(words).to_numpy(zero_copy_only=False), bool)
    start, n = (batch.column(x).to_numpy() for x in ("_s", "_n"))
    rows, begin, end = [np.flatnonzero(told)], [start[told]], [start[told] + n[told] + WINDOW - 1]
    sent = np.flatnonzero(~told)
    if len(sent):
        t = Texts(words.take(pa.array(sent)).cast(pa.large_binary()).cast(pa.large_string()))
        h = t.hashes()
        at, one = t.runs(h, WINDOW)
        two = t.runs(mix(h ^ np.uint64(0xA0761D6478BD642F)), WINDOW)[1]
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        at = at[twice]
        doc = t.doc[at]
        first = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])]) if len(at) else np.zeros(0, bool)
        opens = np.flatnonzero(first)
        closes = np.append(opens[1:], len(at)) - 1 if len(at) else opens
        row = sent[doc[opens]]
        inside = at[opens] - t.first[doc[opens]]
        rows.append(row)
        begin.append(start[row] + inside)
        end.append(start[row] + inside + at[closes] - at[opens] + WINDOW)
    take = pa.array(np.concatenate(rows))
    out = [batch.column(x).combine_chunks().take(take) for x in ("_id", "_version")]
    out += [pa.array(np.concatenate(x).astype(np.int32)) for x in (begin, end)]
    return pa.RecordBatch.from_arrays(out, ["_id", "_version", "_from", "_to"])


def _repeated(sent: DataFrame) -> DataFrame:
    """(_id, _version, _from, _to): ranges of words inside repeated windows."""

    def count(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < CHUNK_BYTES:
                continue
            table = pa.Table.from_batches(held)
            route = table.column("_route").to_numpy()
            whole = int(np.searchsorted(route, route[-1]))  # the last route may go on
            if whole:
                yield _counted(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
        if held:
            yield _counted(pa.Table.from_batches(held))

    schema = T.StructType([sent.schema["_id"], sent.schema["_version"], T.StructField("_from", T.IntegerType()), T.StructField("_to", T.IntegerType())])
    return sent.repartition("_route").sortWithinPartitions("_route").mapInArrow(count, schema)


def ranges(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """_id, _version (a hash of the text), _text and _r, the ranges of words to remove, of each row of ``docs``."""
    own = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_version"), F.col("text").alias("_text"))
    places = _placed(own)
    counts = places.groupBy(F.col("_key").alias("_k")).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    counts = counts.select("_k", (F.col("_times") > hot).alias("_hot"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"))
    salted = places.withColumn("_part_", F.pmod(F.xxhash64("_id", "_version", "_s"), F.lit(SALTS)).cast("int"))
    shared = salted.join(counts, (F.col("_key") == F.col("_k")) & (F.col("_part_") == F.col("_part")))
    lists = shared.groupBy(F.col("_id").alias("_i"), F.col("_version").alias("_v")).agg(F.collect_set(F.struct("_s", "_n", "_key", "_hot")).alias("_c"))
    match = lambda right: own["_id"].eqNullSafe(right["_i"]) & (own["_version"] == right["_v"])
    sent = _sent(own.join(lists, match(lists), "left").select("_id", "_version", "_text", "_c"))
    found = _repeated(sent).groupBy(F.col("_id").alias("_i"), F.col("_version").alias("_v")).agg(F.collect_set(F.struct("_from", "_to")).alias("_r"))
    return own.join(found, match(found), "left").select("_id", "_version", "_text", "_r")


def remove(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text (kept words joined by single spaces)."""
    marked = ranges(docs, hot)

    def drop(batches):
        for batch in batches:
            for a, b in slices(batch.column("_text")):
                part = batch.slice(a, b - a)
                total, gone, kept = [], [], []
                for text, spans in zip(part.column("_text"), part.column("_r")):
                    words = (text.as_py() or "").encode().split()
                    keep = np.ones(len(words), bool)
                    for span in spans.as_py() or ():
                        keep[span["_from"] : span["_to"]] = False
                    total.append(len(words))
                    gone.append(len(words) - int(keep.sum()))
                    kept.append(b" ".join(words if not gone[-1] else [words[i] for i in np.flatnonzero(keep)]).decode())
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    schema = T.StructType([T.StructField("doc_id", marked.schema["_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return marked.mapInArrow(drop, schema)
