"""Scores of texts by a Katz backoff model of word pairs.

Counts of words and of pairs are Good-Turing discounted. The probability of a word after a history is the pair's
discounted share if the pair is in the model, else the history's backoff weight times the word's own probability; the
weights are such that the probabilities after each history sum to one, exactly, over all words and one unknown word.

All words and all pairs of all training texts are counted, stored and in the model. At most 1 / WORD_SHARE words and
1 / PAIR_SHARE pairs have these shares of the tokens: they go to the tasks as arrays of proven size. All other pairs
lie in buckets by history, or by their rare word, and travel packed: sorted, as differences and byte planes. A bucket
holds about BUCKET training tokens whatever the input; no key of it has more than its share of the rows.

Tokens are words with A-Z folded, and one end per text. Null texts count as empty: they have the end only. Very long texts are
worked on whole, one at a time. Repeated rows are trained on and scored like others. Without training texts all words are unknown, and scores are those of the
base formula, 0 per token. Empty tables give empty results; other columns may have any name.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from ..scratch import cut
from .wordhash import Texts, mix, slices

WORD_SHARE = 1e-6
PAIR_SHARE = 1e-5
DISCOUNTED = 5  # counts up to this are discounted
END = np.uint64(0x5851F42D4C957F2D)
MERGE = 2_000_000
CHUNK = 1_500_000  # tokens whose pairs are packed together
BUCKET = 1_500_000  # training tokens per bucket
SALTED = 1e-3
PAIRS, BESIDE, RARE, HISTORY, SECOND, SUMS, SOUGHT = 0, 1, 2, 3, 4, 5, 10
ALONE = np.uint64(2)
WHOLE = (np.uint64, np.uint64, np.int64)
PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int64()), ("base", pa.int64()), ("rows", pa.int64()), ("data", pa.binary())])
COUNTED = PACKED.append(pa.field("times", pa.list_(pa.int64())))


def discounts(n: list[int]) -> np.ndarray:
    """Katz's factors for counts 1..DISCOUNTED (index 0 unused) from the numbers of things seen 1..DISCOUNTED+1 times.

    Where these numbers give no factor between 0 and 1, half a count is taken off.
    """
    k, out = DISCOUNTED, np.ones(DISCOUNTED + 1)
    top = (k + 1) * n[k] / n[0] if n[0] else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * n[r] / (r * n[r - 1]) - top) / (1 - top) if n[r - 1] and top < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def _discounted(counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, factor[np.minimum(counts, DISCOUNTED)], 1.0)


def _tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each token, the end of a text after its words."""
    n = len(t.counts)
    doc = np.concatenate([t.doc, np.arange(n)])
    order = np.argsort(doc, kind="stable")
    return np.concatenate([t.hashes(fold=True), np.full(n, END)])[order], doc[order]


class Counter:
    """Counts of 64-bit keys that are merged now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > MERGE and len(self.parts) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts]) if self.parts else np.zeros(0, np.uint64)
        counts = np.concatenate([c for _, c in self.parts]) if self.parts else np.zeros(0, np.int64)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        self.parts = [(keys[new], np.add.reduceat(counts, new) if len(new) else counts)]
        self.size = len(new)
        return self.parts[0]

    def batches(self):
        """Rows of keys and counts, when few distinct keys came or at the end."""
        keys, counts = self.merge()
        self.parts, self.size = [], 0
        for a in range(0, len(keys), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + 200_000].view(np.int64)), pa.array(counts[a : a + 200_000].astype(np.int64))], ["key", "c"])


def _counts(texts: DataFrame, keys_of, name: str) -> DataFrame:
    """Stored (key, c) over the texts; ``keys_of`` gives the keys in a slice. Counts are combined inside each task."""

    def count(batches):
        held = Counter()
        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column):
                held.add(keys_of(Texts(column.slice(a, b - a))))
                if held.size > 2 * MERGE:
                    yield from held.batches()
        yield from held.batches()

    rows = texts.mapInArrow(count, "key bigint, c bigint")
    return cut(rows.groupBy("key").agg(F.sum("c").alias("c")), name)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit values, the first sorted, as differences and byte planes, compressed."""
    first = columns[0].view(np.uint64)
    planes = [np.diff(first, prepend=np.uint64(0)), *columns[1:]]
    return pa.compress(b"".join(x.view(np.uint8).reshape(-1, 8).T.tobytes() for x in planes), codec="zstd", asbytes=True)


def _unpack(data: bytes, rows: int, *kinds) -> list[np.ndarray]:
    """The columns of ``_pack``, as values of ``kinds``."""
    raw = np.frombuffer(pa.decompress(data, decompressed_size=rows * 8 * len(kinds), codec="zstd"), np.uint8).reshape(len(kinds), 8, rows)
    out = [np.ascontiguousarray(x.T).reshape(-1).view(k) for x, k in zip(raw, kinds)]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _joined(table, kind: int, *kinds) -> list[np.ndarray]:
    """The columns of all packed rows of ``kind``, in the rows' order."""
    own = [(d.as_py(), n.as_py()) for k, d, n in zip(table.column("kind").to_pylist(), table.column("data"), table.column("rows")) if k == kind]
    parts = [_unpack(d, n, *kinds) for d, n in own] or [[np.zeros(0, k) for k in kinds]]
    return [np.concatenate(x) for x in zip(*parts)]


def _packed(kind: int, bucket: np.ndarray, columns: list[np.ndarray], base: int = 0) -> list[tuple]:
    """Rows (bucket, kind, base, rows, data) of columns that are sorted by the first."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    borders = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    return [(int(bucket[x]), kind, base, y - x, _pack(*[c[x:y] for c in columns])) for x, y in zip(borders, borders[1:])]


def _batch(rows: list[tuple], schema: pa.Schema = PACKED) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _merged(first: np.ndarray, second: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct (first, second) with the sums of their counts."""
    order = np.lexsort((second, first)) if second.any() else np.argsort(first)
    first, second, c = first[order], second[order], c[order]
    if len(c):
        new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        first, second, c = first[new], second[new], np.add.reduceat(c, new)
    return [first, second, c]


class Layout:
    """Which bucket a pair belongs to, and how it is written there.

    PAIRS are those of two frequent words: a code of their numbers, and 0. BESIDE are rare words, each with a frequent
    word before (4 x its number) or after (4 x its number + 1), or by itself (``ALONE``). RARE are pairs of two rare words.
    Pairs lie by history, and those of rare words by the rare word, so that all that is known of it meets there; the
    histories that make up ``SALTED`` of the tokens, a known number at most, are spread by what follows them.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int):
        self.keys, self.size, self.buckets = keys, np.uint64(max(len(keys), 1)), max(8, total // BUCKET)
        self.spread = counts >= SALTED * total

    def of(self, kind: int, first: np.ndarray) -> np.ndarray:
        if kind == PAIRS:
            word = first // self.size
            first = word + np.where(self.spread[word.astype(np.int64)], (first % self.size + np.uint64(1)) << np.uint64(32), np.uint64(0))
        return (mix(first) % np.uint64(self.buckets)).astype(np.int64)

    def split(self, token: np.ndarray, doc: np.ndarray, at: np.ndarray, left_out: np.ndarray | None = None) -> dict:
        """kind: (first, second, text) of all occurrences. ``at`` numbers the frequent words, -1 are rare ones."""
        both, known = doc[1:] == doc[:-1], at >= 0
        before, after, code = known[:-1], known[1:], at.astype(np.uint64)
        if left_out is not None:
            both = both & ~left_out
        pair, fr, rf, rr = (np.flatnonzero(both & x) for x in (before & after, before & ~after, ~before & after, ~before & ~after))
        alone = np.flatnonzero(~known)
        one, four = np.uint64(1), np.uint64(4)
        return {
            PAIRS: (code[pair] * self.size + code[pair + 1], np.zeros(len(pair), np.uint64), doc[pair]),
            BESIDE: (
                np.concatenate([token[fr + 1], token[rf], token[alone]]),
                np.concatenate([code[fr] * four, code[rf + 1] * four + one, np.full(len(alone), ALONE)]),
                np.concatenate([doc[fr], doc[rf], doc[alone]]),
            ),
            RARE: (token[rr], token[rr + 1], doc[rr]),
        }


def _pair_counts(texts: DataFrame, layout: Layout) -> DataFrame:
    """Stored packed counts of all pairs, a row per bucket and kind, with how many pairs came 1..DISCOUNTED+1 times.

    Counts are combined inside each task and travel packed.
    """

    def rows(held):
        for kind in (PAIRS, BESIDE, RARE):
            first, second = (np.concatenate([h[kind][i] for h in held]) for i in (0, 1))
            columns = _merged(first, second, np.ones(len(first), np.int64))
            yield from _packed(kind, layout.of(kind, columns[0]), columns)

    def count(batches):
        held, size = [], 0
        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column):
                token, doc = _tokens(Texts(column.slice(a, b - a)))
                held.append(layout.split(token, doc, _find(layout.keys, token)))
                size += len(token)
                if size > CHUNK:
                    yield _batch(list(rows(held)))
                    held, size = [], 0
        if held:
            yield _batch(list(rows(held)))

    def merge(table):
        out = []
        for kind in (PAIRS, BESIDE, RARE):
            columns = _merged(*_joined(table, kind, *WHOLE))
            if len(columns[0]):
                c = columns[2] if kind != BESIDE else columns[2][columns[1] != ALONE]
                times = np.bincount(np.minimum(c, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
                out.append((table.column("bucket")[0].as_py(), kind, 0, len(columns[0]), _pack(*columns), times.tolist()))
        return pa.Table.from_batches([_batch(out, COUNTED)])

    packed = texts.mapInArrow(count, from_arrow_schema(PACKED)).repartitionById(layout.buckets, "bucket")
    return cut(packed.groupBy("bucket").applyInArrow(merge, from_arrow_schema(COUNTED)), "pairs")


def _seen(table: DataFrame) -> tuple[int, int, list[int]]:
    """Sum of counts, number of keys, numbers of keys with counts 1..DISCOUNTED+1."""
    row = table.agg(F.sum("c"), F.count(F.lit(1)), *[F.count_if(F.col("c") == r) for r in range(1, DISCOUNTED + 2)]).first()
    return row[0] or 0, row[1], list(row[2:])


def _frequent(table: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and counts of those with at least ``least``: a known number at most."""
    got = table.filter(F.col("c") >= least).toPandas()
    keys, counts = got["key"].to_numpy(np.int64).view(np.uint64), got["c"].to_numpy(np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Model:
    """Frequent words and pairs as arrays; ``words`` and ``pair_counts`` are the tables of all, ``entries`` what the buckets need to score."""

    def __init__(self, texts: DataFrame, word_share: float = WORD_SHARE, pair_share: float = PAIR_SHARE):
        self.words = _counts(texts, lambda t: _tokens(t)[0], "words")
        self.total, self.distinct, n = _seen(self.words)
        self.factor = discounts(n)
        left = sum((1 - self.factor[r]) * r * n[r - 1] for r in range(1, DISCOUNTED + 1)) / max(self.total, 1)
        scale = 1.0
        if left <= 0:  # no word is rare: half a token is left for the unknown
            left = 0.5 / (self.total + 0.5)
            scale = 1 - left
        self.unknown, self.scale = left, scale
        self.keys, counts = _frequent(self.words, word_share * self.total)
        self.counts = counts
        self.limit = word_share * self.total
        self.p = scale * _discounted(counts, self.factor) / max(self.total, 1)
        self._fit_pairs(texts, pair_share)

    def _fit_pairs(self, texts: DataFrame, share: float) -> None:
        self.layout = layout = Layout(self.keys, self.counts, self.total)
        self.packed = _pair_counts(texts, layout)
        times = self.packed.agg(*[F.sum(F.col("times")[r]) for r in range(DISCOUNTED + 1)]).first()
        self.pair_factor = factor = discounts([x or 0 for x in times])
        keys, p, p_rare = self.keys, self.p, self._probability

        def sums(batches):
            """Per history: number, discounted number and followers' own probability, but for RARE pairs."""
            for batch in batches:
                for kind, data, rows in zip(batch.column("kind").to_pylist(), batch.column("data"), batch.column("rows").to_pylist()):
                    if kind == RARE:
                        continue
                    first, second, c = _unpack(data.as_py(), rows, *WHOLE)
                    if kind == PAIRS:
                        history, follower = keys[(first // layout.size).astype(np.int64)], p[(first % layout.size).astype(np.int64)]
                    else:
                        word, at = np.unique(first, return_inverse=True)
                        alone = second == ALONE
                        own = np.zeros(len(word), np.int64)
                        own[at[alone]] = c[alone]
                        frequent, after = (second >> np.uint64(2)).astype(np.int64)[~alone], (second & np.uint64(3) == 1)[~alone]
                        first, at, c = first[~alone], at[~alone], c[~alone]
                        near = keys[frequent] if len(keys) else np.zeros(0, np.uint64)
                        history = np.where(after, first, near)
                        follower = np.where(after, p[frequent] if len(p) else 0.0, p_rare(own)[at])
                    history, at = np.unique(history, return_inverse=True)
                    columns = [np.bincount(at, x, len(history)).astype(float) for x in (c, _discounted(c, factor), follower)]
                    yield pa.RecordBatch.from_arrays([pa.array(history.view(np.int64)), *map(pa.array, columns)], ["first", "n", "held", "below"])

        rare = self._read(F.col("kind") == RARE)
        words = self.words.select(F.col("key").alias("second"), F.pow(F.lit(10.0), self.word_log(F.col("c"))).alias("p"))
        self.rare = cut(rare.join(words, "second"), "rare")
        held = (F.col("c") * self._factor(F.col("c"), factor)).alias("held")
        parts = self.packed.mapInArrow(sums, "first bigint, n double, held double, below double")
        parts = parts.unionByName(self.rare.select("first", F.col("c").cast("double").alias("n"), held, F.col("p").alias("below")))
        total = parts.groupBy("first").agg(*[F.sum(x).alias(x) for x in ("n", "held", "below")])
        # A history without rare pairs has no mass left: half an occurrence is left for the other words.
        mass = F.col("held") / F.col("n")
        kept = F.when(mass >= 1 - 1e-12, 1 - 0.5 / F.col("n")).otherwise(F.lit(1.0))
        others = F.greatest(1 - F.col("below"), F.lit(self.unknown))
        weight = F.log10((1 - mass * kept) / others).alias("_weight")
        self.histories = cut(total.select("first", F.log10(kept / F.col("n")).alias("_scale"), weight), "histories")
        # The arrays: weights and scales of frequent words, what frequent pairs of these add.
        got = self.histories.join(F.broadcast(self.frequent), "first").toPandas()
        at = _find(keys, got["first"].to_numpy(np.int64).view(np.uint64))
        self.weight_log, self.scale_log = np.zeros(len(keys)), np.zeros(len(keys))
        self.weight_log[at], self.scale_log[at] = got["_weight"].to_numpy(float), got["_scale"].to_numpy(float)
        least = max(share * self.total, 1)

        def most(batches):
            for batch in batches:
                for kind, data, rows in zip(batch.column("kind").to_pylist(), batch.column("data"), batch.column("rows").to_pylist()):
                    if kind == PAIRS:
                        first, _, c = _unpack(data.as_py(), rows, *WHOLE)
                        yield pa.RecordBatch.from_arrays([pa.array(first[c >= least].view(np.int64)), pa.array(c[c >= least])], ["key", "c"])

        self.hot, c = _frequent(self.packed.mapInArrow(most, "key bigint, c bigint"), least)
        first, second = (self.hot // self.size).astype(np.int64), (self.hot % self.size).astype(np.int64)
        with np.errstate(divide="ignore"):
            self.p_log = np.log10(self.p)
        self.hot_add = np.log10(_discounted(c, factor)) + (self.scale_log - self.weight_log)[first] - self.p_log[second]

    @property
    def frequent(self) -> DataFrame:
        return self.words.filter(F.col("c") >= self.limit).select(F.col("key").alias("first"))

    @property
    def _probability(self):
        factor, scale, total, unknown = self.factor, self.scale, max(self.total, 1), self.unknown
        return lambda c: np.where(c > 0, scale * _discounted(c, factor) / total, unknown)

    def _read(self, which: Column) -> DataFrame:
        """(first, second, c) of the packed rows ``which``."""
        keys, size = self.keys, self.size

        def rows(batches):
            for batch in batches:
                for kind, data, n in zip(batch.column("kind").to_pylist(), batch.column("data"), batch.column("rows").to_pylist()):
                    first, second, c = _unpack(data.as_py(), n, *WHOLE)
                    if kind == PAIRS:
                        first, second = keys[(first // size).astype(np.int64)], keys[(first % size).astype(np.int64)]
                    elif kind == BESIDE:
                        pair = second != ALONE
                        word, code, c = first[pair], second[pair], c[pair]
                        near = keys[(code >> np.uint64(2)).astype(np.int64)] if len(keys) else word
                        after = code & np.uint64(3) == 1
                        first, second = np.where(after, word, near), np.where(after, near, word)
                    for a in range(0, len(c), 200_000):
                        part = slice(a, a + 200_000)
                        yield pa.RecordBatch.from_arrays([pa.array(first[part].view(np.int64)), pa.array(second[part].view(np.int64)), pa.array(c[part])], ["first", "second", "c"])

        return self.packed.filter(which).mapInArrow(rows, "first bigint, second bigint, c bigint")

    @property
    def pair_counts(self) -> DataFrame:
        """(first, second, c) of all pairs."""
        return self._read(F.lit(True))

    @property
    def entries(self) -> DataFrame:
        """What the buckets need to score: packed pairs, values of rare histories, probabilities after them."""
        layout = self.layout

        def pack(kind, names, kinds):
            def rows(batches):
                for batch in batches:
                    columns = [batch.column(x).to_numpy(zero_copy_only=False).view(k) for x, k in zip(names, kinds)]
                    order = np.argsort(columns[0])
                    columns = [c[order] for c in columns]
                    if len(order):
                        yield _batch(_packed(kind, layout.of(kind, columns[0]), columns))

            return rows

        schema = from_arrow_schema(PACKED)
        histories = self.histories.join(F.broadcast(self.frequent), "first", "left_anti").select("first", "_weight", "_scale")
        histories = histories.mapInArrow(pack(HISTORY, ("first", "_weight", "_scale"), (np.uint64, float, float)), schema)
        second = self.rare.select("first", "second", "p").mapInArrow(pack(SECOND, ("first", "second", "p"), (np.uint64, np.uint64, float)), schema)
        return self.packed.drop("times").unionByName(histories).unionByName(second)

    @property
    def context(self) -> np.ndarray:
        return self.keys

    @property
    def size(self) -> np.uint64:
        return np.uint64(max(len(self.keys), 1))

    @property
    def pairs(self) -> np.ndarray:
        return self._closed[0]

    @property
    def pair_log(self) -> np.ndarray:
        return self._closed[1]

    @cached_property
    def _closed(self) -> tuple[np.ndarray, np.ndarray]:
        """To look at small models: codes and probabilities of the pairs after frequent words that only frequent words follow."""
        own = self.pair_counts.join(self.frequent, "first", "left_semi")
        opened = own.join(self.frequent.withColumnRenamed("first", "second"), "second", "left_anti")
        value = (F.log10(F.col("c") * self._factor(F.col("c"), self.pair_factor)) + F.col("_scale")).alias("_value")
        own = own.join(opened.select("first").distinct(), "first", "left_anti").join(self.histories, "first")
        got = own.select("first", "second", value).toPandas()
        first, second = (_find(self.keys, got[x].to_numpy(np.int64).view(np.uint64)).astype(np.uint64) for x in ("first", "second"))
        code = first * self.size + second
        order = np.argsort(code)
        return code[order], got["_value"].to_numpy(float)[order]

    @staticmethod
    def _factor(count: Column, factor: np.ndarray) -> Column:
        known = F.least(count, F.lit(DISCOUNTED)).cast("int")
        return F.when(count > DISCOUNTED, F.lit(1.0)).otherwise(F.element_at(F.array(*[F.lit(float(x)) for x in factor]), known + 1))

    def word_log(self, count: Column) -> Column:
        """log10 probability of a word that was counted ``count`` times; null or 0 is unknown."""
        return F.when(count > 0, F.log10(self._factor(count, self.factor) * count * F.lit(self.scale / max(self.total, 1)))).otherwise(F.lit(float(np.log10(self.unknown))))

    def base_log(self, count: Column) -> Column:
        below = self.total + 0.5 * (self.distinct + 1)
        return F.log10((F.coalesce(count, F.lit(0)) + F.lit(0.5)) / F.lit(below))


class Index:
    """Where each pair is among distinct pairs."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.firsts, self.seconds = np.unique(first), np.unique(second)
        code = (_find(self.firsts, first) << 32) | _find(self.seconds, second)
        self.order = np.argsort(code)
        self.code = code[self.order]

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 where it isn't there."""
        at, of = _find(self.firsts, first), _find(self.seconds, second)
        there = np.flatnonzero((at >= 0) & (of >= 0))
        place = _find(self.code, (at[there] << 32) | of[there])
        out = np.full(len(first), -1)
        out[there[place >= 0]] = self.order[place[place >= 0]]
        return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, base_score, score."""
    own = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    layout, hot, hot_add = model.layout, model.hot, model.hot_add
    keys, counts, p_log, scale_log, weight_log = model.keys, model.counts, model.p_log, model.scale_log, model.weight_log
    own_log = p_log + weight_log
    total = model.total + 0.5 * (model.distinct + 1)
    base_log = np.log10((counts + 0.5) / total)
    probability, factor, unknown = model._probability, model.pair_factor, np.log10(model.unknown)
    results = pa.schema([("_id", to_arrow_type(own.schema["_id"].dataType)), ("_doc", pa.int64()), ("_tokens", pa.int64()), ("_known", pa.int64()), ("_base", pa.float64()), ("_score", pa.float64())])
    everything = pa.schema([*PACKED, *results])
    settled = pa.schema([*[PACKED.field(x) for x in ("base", "rows", "data")], *results])

    def evaluate(batches):
        """A row of sums for each text, and packed occurrences of what the sums lack."""
        doc_key = start = TaskContext.get().partitionId() << 33
        held, size = [], 0

        def packed():
            rows = []
            for kind in (PAIRS, BESIDE, RARE):
                columns = [np.concatenate([h[kind][i] for h in held]) for i in range(3)]
                order = np.argsort(columns[0])
                columns = [c[order] for c in columns]
                rows += _packed(SOUGHT + kind, layout.of(kind, columns[0]), columns, start)
            full = [[*row, *[None] * len(results)] for row in rows]
            return [_batch(full, everything)] if full else []

        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column):
                token, doc = _tokens(Texts(column.slice(a, b - a)))
                n = b - a
                at = _find(keys, token)
                frequent = at >= 0
                base, score_ = np.zeros(len(token)), np.zeros(len(token))
                base[frequent], score_[frequent] = base_log[at[frequent]], own_log[at[frequent]]
                there = np.flatnonzero((doc[1:] == doc[:-1]) & frequent[1:] & frequent[:-1])
                code = _find(hot, at[there].astype(np.uint64) * layout.size + at[there + 1].astype(np.uint64))
                score_[there[code >= 0]] += hot_add[code[code >= 0]]
                done = np.zeros(max(len(doc) - 1, 0), bool)
                done[there[code >= 0]] = True
                texts = doc_key + np.arange(n)
                none = [pa.array(np.full(n, start)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
                sums = [np.bincount(doc, minlength=n).astype(np.int64), np.bincount(doc, frequent, n).astype(np.int64), np.bincount(doc, base, n), np.bincount(doc, score_, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts % layout.buckets, pa.int32()), pa.array(np.full(n, SUMS)), *none, batch.column("_id").slice(a, n).cast(results.field("_id").type), pa.array(texts), *map(pa.array, sums)],
                    schema=everything,
                )
                held.append(layout.split(token, doc + (doc_key - start), at, done))
                doc_key += n
                size += len(token)
                if size > CHUNK:
                    yield from packed()
                    held, size, start = [], 0, doc_key
        if held:
            yield from packed()

    def settle(table):
        """Sums of texts as they are, and what a bucket's pairs and rare words add to each text."""
        added = {}  # by the chunk that the texts are of

        def add(chunk, text, score_, known_=0.0, base_=0.0):
            added.setdefault(chunk, []).append((text, *[np.broadcast_to(x, len(text)) for x in (known_, base_, score_)]))

        def sought(kind):
            for k, b, d, n in zip(table.column("kind").to_pylist(), table.column("base").to_pylist(), table.column("data"), table.column("rows").to_pylist()):
                if k == SOUGHT + kind:
                    first, second, text = _unpack(d.as_py(), n, *WHOLE)
                    yield b, first, second, text

        own_scale = scale_log - weight_log
        code, _, c = _joined(table, PAIRS, *WHOLE)
        c_log = np.log10(_discounted(c, factor))
        for chunk, first, _, text in sought(PAIRS):
            at = _find(code, first)
            seen = at >= 0
            first, at = first[seen], at[seen]
            add(chunk, text[seen], c_log[at] + own_scale[(first // layout.size).astype(np.int64)] - p_log[(first % layout.size).astype(np.int64)])

        history, weight, scale = _joined(table, HISTORY, np.uint64, float, float)
        order = np.argsort(history)
        history, weight, scale = history[order], weight[order], scale[order]

        def of_history(word, values):
            at = _find(history, word)
            return np.where(at >= 0, values[at], 0.0) if len(history) else np.zeros(len(word))

        word, code, c = _joined(table, BESIDE, *WHOLE)
        alone = code == ALONE
        words, count = word[alone], c[alone]
        c_log, index = np.log10(_discounted(c, factor)), Index(word, code)
        for chunk, first, second, text in sought(BESIDE):
            at, place = _find(words, first), index.find(first, second)
            number = np.where(at >= 0, count[at], 0) if len(words) else np.zeros(len(first), np.int64)
            own_p, own_weight = np.log10(probability(number)), of_history(first, weight)
            single = second == ALONE
            x = single
            add(chunk, text[x], own_p[x] + own_weight[x], (number[x] > 0).astype(float), np.log10((number[x] + 0.5) / total))
            x = ~single & (place >= 0)
            near, after = (second[x] >> np.uint64(2)).astype(np.int64), second[x] & np.uint64(3) == 1
            before = own_scale[near] - own_p[x] if len(keys) else 0.0
            behind = of_history(first[x], scale) - own_weight[x] - (p_log[near] if len(keys) else 0.0)
            add(chunk, text[x], c_log[place[x]] + np.where(after, behind, before))

        first_, second_, c = _joined(table, RARE, *WHOLE)
        a, b, p = _joined(table, SECOND, np.uint64, np.uint64, float)
        c_log, index = np.log10(_discounted(c, factor)), Index(first_, second_)
        p_of = np.zeros(len(c))
        p_of[index.find(a, b)] = np.log10(p)
        for chunk, first, second, text in sought(RARE):
            place = index.find(first, second)
            x = place >= 0
            add(chunk, text[x], c_log[place[x]] + of_history(first[x], scale) - of_history(first[x], weight) - p_of[place[x]])

        rows = []
        for chunk, parts in added.items():
            text, *values = (np.concatenate(x) for x in zip(*parts))
            texts, at = np.unique(text, return_inverse=True)
            if len(texts):
                values = [np.bincount(at, x, len(texts)) for x in values]
                rows.append([chunk, len(texts), _pack(texts, *values), *[None] * len(results)])
        sums = table.filter(pa.compute.equal(table.column("kind"), SUMS)).select(settled.names).cast(settled)
        return pa.concat_tables([sums, pa.Table.from_batches([_batch(rows, settled)])])

    def finish(table):
        """The texts of a chunk with all sums."""
        packed = pa.compute.is_valid(table.column("data"))
        own, more = table.filter(pa.compute.invert(packed)).sort_by("_doc"), table.filter(packed)
        doc = own.column("_doc").to_numpy()
        known, base, score_ = (own.column(x).to_numpy().astype(float) for x in ("_known", "_base", "_score"))
        # In the order of their bytes, so that sums don't depend on the order of arrival.
        for data, n in sorted(zip(more.column("data").to_pylist(), more.column("rows").to_pylist())):
            text, *values = _unpack(data, n, np.uint64, float, float, float)
            at = np.searchsorted(doc, text.astype(np.int64) + table.column("base")[0].as_py())
            for total_, x in zip((known, base, score_), values):
                total_[at] += x
        columns = [own.column("_id"), own.column("_tokens"), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score_)]
        return pa.table(columns, schema=final)

    final = pa.schema([results.field("_id").with_name("doc_id"), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    rows = own.mapInArrow(evaluate, from_arrow_schema(everything))
    rows = rows.unionByName(model.entries, allowMissingColumns=True).repartitionById(layout.buckets, "bucket")
    found = rows.groupBy("bucket").applyInArrow(settle, from_arrow_schema(settled))
    return found.groupBy("base").applyInArrow(finish, from_arrow_schema(final))
