"""Language identification by a byte convolutional network.

Filters of several widths run over windows of ``WINDOW`` bytes, each filter's largest response in the window goes
through a rectifier into a softmax. It is trained in numpy on windows of labelled texts, at most ``PER_LABEL`` texts a
label, drawn by hash, with up to ``PER_TEXT`` windows spread over each. Texts are scored whole: their windows'
probabilities are averaged by length.

A null text, and a text without a letter, is ``und`` with score 0, as is every text if nothing is labelled. Null labels
aren't learned. Repeated rows get equal results; empty tables give empty results; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordhash import slices

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LABEL = 600
PER_TEXT = 3
UNKNOWN = "und"


def windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (padded with spaces) of the texts, the text each belongs to, and the bytes of it in the window."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    lengths = np.diff(off)
    each = -(-lengths // WINDOW)
    base = np.concatenate([[0], np.cumsum(each)])
    owner = np.repeat(np.arange(n), each)
    flat = np.full(base[-1] * WINDOW, 32, np.uint8)
    if len(flat):
        data = np.frombuffer(column.buffers()[2], np.uint8)
        for i in np.flatnonzero(lengths):
            flat[base[i] * WINDOW : base[i] * WINDOW + lengths[i]] = data[off[i] : off[i + 1]]
    filled = np.minimum(lengths[owner] - (np.arange(base[-1]) - base[owner]) * WINDOW, WINDOW)
    return flat.reshape(-1, WINDOW), owner, filled


def _sample(labelled: DataFrame, per_label: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Windows and labels for training; ``labelled`` has _text and _label."""
    sizes = {r[0]: r[1] for r in labelled.groupBy("_label").count().collect()}
    labels = sorted(sizes)
    share = F.lit(0.0)
    for label in labels:
        share = F.when(F.col("_label") == label, F.lit(per_label / sizes[label])).otherwise(share)
    drawn = F.pmod(F.xxhash64("_text", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def cut_windows(batches):
        for batch in batches:
            text = batch.column("_text")
            for a, b in slices(text):
                rows, owner, filled = windows(text.slice(a, b - a))
                rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
                each = np.bincount(owner, minlength=b - a)[owner]
                step = np.maximum(each // PER_TEXT, 1)
                take = (rank % step == 0) & (rank // step < PER_TEXT) & ((filled >= WINDOW // 2) | (each == 1))
                label = pa.array(np.asarray(batch.column("_label").to_pylist()[a:b], object)[owner[take]], pa.string())
                blob = pa.array([r.tobytes() for r in rows[take]], pa.binary())
                yield pa.RecordBatch.from_arrays([label, blob], ["label", "bytes"])

    got = labelled.filter(drawn < share).mapInArrow(cut_windows, "label string, bytes binary").orderBy("label", "bytes").toPandas()
    x = np.frombuffer(b"".join(got["bytes"]), np.uint8).reshape(-1, WINDOW)
    return labels, x, np.searchsorted(np.asarray(labels, object), got["label"].to_numpy(object)) if len(got) else np.zeros(0, int)


class Network:
    """Parameters: per width a table of responses by tap and byte, then a softmax layer."""

    def __init__(self, labels: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.taps = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.taps, self.out, self.bias]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                step += 1
                rows = order[at : at + batch]
                for p, g, m, v in zip(params, self._gradients(x[rows], y[rows]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        pooled, where = [], []
        for w, tap in zip(WIDTHS, self.taps):
            span = WINDOW - w + 1
            response = sum(tap[t][x[:, t : t + span]] for t in range(w))
            at = response.argmax(1)
            where.append(at)
            pooled.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0])
        z = np.concatenate(pooled, 1)
        active = np.maximum(z, 0)
        p = _softmax(active @ self.out + self.bias)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.out.T) * (z > 0)
        grads = []
        for i, (w, tap) in enumerate(zip(WIDTHS, self.taps)):
            g = np.zeros_like(tap)
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            for t in range(w):
                byte = np.take_along_axis(x, where[i] + t, 1)
                np.add.at(g[t], (byte, np.arange(FILTERS)[None, :]), own)
            grads.append(g)
        return [*grads, active.T @ p, p.sum(0)]

    def tables(self) -> None:
        """Responses of two neighbouring taps by byte pair: the same sums in fewer steps."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        two, three, four = self.taps
        self.fast = (pair(*two), pair(three[0], three[1]), three[2], pair(four[0], four[1]), pair(four[2], four[3]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each window."""
        two, three, last, four, end = self.fast
        out = np.empty((len(x), len(self.labels)), np.float32)
        for a in range(0, len(x), 1024):
            own = x[a : a + 1024]
            code = own[:, :-1].astype(np.int32) * 256 + own[:, 1:]
            z = [two.take(code, 0).max(1)]
            r = three.take(code[:, :-1], 0)
            r += last.take(own[:, 2:], 0)
            z.append(r.max(1))
            r = four.take(code[:, :-2], 0)
            r += end.take(code[:, 2:], 0)
            z.append(r.max(1))
            out[a : a + 1024] = _softmax(np.maximum(np.concatenate(z, 1), 0) @ self.out + self.bias)
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, learn_from: Column, per_label: int = PER_LABEL) -> Network:
    """A network for the languages in ``lang`` of the rows where ``learn_from`` holds."""
    own = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    labels, x, y = _sample(own.select(F.col("text").alias("_text"), F.col("lang").alias("_label")), per_label)
    net = Network(labels)
    if len(labels) > 1:
        net.fit(x, y)
    net.tables()
    return net


def predict(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred and score."""
    from pyspark.sql import types as T

    own = docs.select(
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("_text"),
        *[docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)],
    )
    kept = [f"_k{i}" for i in range(len(keep))]

    def score(batches):
        for batch in batches:
            text = batch.column("_text")
            for a, b in slices(text):
                x, owner, filled = windows(text.slice(a, b - a))
                total = np.zeros((b - a, max(len(net.labels), 1)))
                if net.labels and len(x):
                    edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                    total[owner[edge]] = np.add.reduceat(net.predict(x) * filled[:, None], edge, axis=0)
                weight = total.sum(1)
                best = total.argmax(1)
                known = weight > 0
                value = np.where(known, total.max(1) / np.where(known, weight, 1), 0.0)
                label = [net.labels[j] if k else UNKNOWN for j, k in zip(best, known)]
                rest = [batch.column(c).slice(a, b - a) for c in kept]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(label, pa.string()), pa.array(np.clip(value, 0, 1), pa.float64())], [*kept, "_pred", "_value"])

    schema = T.StructType([*[own.schema[c] for c in kept], T.StructField("_pred", T.StringType()), T.StructField("_value", T.DoubleType())])
    out = own.mapInArrow(score, schema)
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, keep)], F.col("_pred").alias("lang_pred"), F.col("_value").alias("score"))
