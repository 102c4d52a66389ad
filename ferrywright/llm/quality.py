"""A quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins; boosting goes round the features, fitting a shallow tree on one feature's
bins at a time, so that each feature ends up with one lookup table; then the same for the pairs with the largest gain on
what is left. A score is the logistic function of the sum of table entries.

It is fitted on at most about ``SAMPLE`` labelled rows, drawn by hash. Null labels aren't learned; of several labels of
one document the largest counts. Null texts count as empty and get a score like others; without labels (or with
one label value) every score is the share of label 1, 0.5 if there is none. Repeated rows get equal results; empty tables
give empty results; other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import cut

SAMPLE = 20_000
BINS = 32
COARSE = 8
FEATURES = (
    "words", "word_length", "distinct_words", "top_word", "repeated_triples", "distinct_lines", "line_length", "ended_lines",
    "upper", "lower", "digits", "spaces", "marks", "symbols", "beyond_ascii", "short_words", "long_words", "plain_words",
)
_GROUPS = np.zeros((256, 7))
for _i, _set in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32), b".,;:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~", range(128, 256))):
    _GROUPS[list(_set), _i] = 1


def features(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n = len(words)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    shares = (raw @ _GROUPS) / max(raw.sum(), 1)
    if not n:
        return [0.0] * 8 + shares.tolist() + [0.0] * 3
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    triples = n - 2
    return [
        np.log1p(n),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if triples > 0 else 0.0,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text) / max(len(lines), 1)),
        sum(x[-1] in ".!?" for x in lines) / max(len(lines), 1),
        *shares.tolist(),
        sum(len(w) <= 3 for w in words) / n,
        sum(len(w) >= 12 for w in words) / n,
        sum(map(str.isalpha, words)) / n,
    ]


def _cuts(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The best cut of a row of bins, and its gain."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0, 0.0
    G, H = g.sum(), h.sum()
    gain = gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1)
    gain[(hl < 1) | (H - hl < 1)] = 0
    at = int(gain.argmax())
    return at + 1, float(gain[at])


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a tree over ordered bins."""
    at, gain = _cuts(g, h) if depth else (0, 0.0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values, and gain, of the best tree over a grid of bins that cuts one axis and then each part on the other."""
    best, value = 0.0, np.zeros_like(g)
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        for at in range(1, len(gg)):
            parts, gain = [], 0.0
            for a, b in ((0, at), (at, len(gg))):
                gs, hs = gg[a:b].sum(0), hh[a:b].sum(0)
                row = _tree(gs, hs, 1)
                gain += float((row * gs).sum())
                parts.append(np.broadcast_to(row, (b - a, len(row))))
            if gain > best:
                out = np.concatenate(parts)
                best, value = gain, (out.T if turn else out)
    return value, best


class Additive:
    """Bin borders, a table per feature and a table per chosen pair of features."""

    def __init__(self):
        self.start, self.edges, self.tables, self.pairs, self.grids = 0.0, [], [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 6, rate: float = 0.1):
        if not len(y):
            return self
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        if y.min() == y.max():
            return self
        bins = self._bins(x)
        total = np.full(len(y), self.start)
        for _ in range(rounds):
            for j, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-total))
                step = rate * _tree(np.bincount(bins[j], y - p, len(table)), np.bincount(bins[j], p * (1 - p), len(table)))
                table += step
                total += step[bins[j]]
        coarse = self._coarse(bins)
        cell = lambda a, b: coarse[a] * COARSE + coarse[b]
        grid = lambda at, v: np.bincount(at, v, COARSE * COARSE).reshape(COARSE, COARSE)
        p = 1 / (1 + np.exp(-total))
        ranked = sorted(((_pair_tree(grid(cell(a, b), y - p), grid(cell(a, b), p * (1 - p)))[1], a, b) for a, b in combinations(range(len(bins)), 2)), reverse=True)
        self.pairs = [(a, b) for gain, a, b in ranked[:n_pairs] if gain > 0]
        self.grids = [np.zeros((COARSE, COARSE)) for _ in self.pairs]
        for _ in range(pair_rounds):
            for (a, b), table in zip(self.pairs, self.grids):
                p = 1 / (1 + np.exp(-total))
                at = cell(a, b)
                step = rate * _pair_tree(grid(at, y - p), grid(at, p * (1 - p)))[0]
                table += step
                total += step.ravel()[at]
        return self

    def _bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)]

    def _coarse(self, bins: list[np.ndarray]) -> list[np.ndarray]:
        return [b * COARSE // (len(e) + 1) for b, e in zip(bins, self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        if self.edges:
            bins = self._bins(x)
            for table, b in zip(self.tables, bins):
                total += table[b]
            coarse = self._coarse(bins)
            for (a, b), table in zip(self.pairs, self.grids):
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the features of each text, in one stored table."""
    own = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))

    def measure(batches):
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column("_text")]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), values], ["_id", "_x"])

    schema = T.StructType([own.schema["_id"], T.StructField("_x", T.ArrayType(T.DoubleType()))])
    return cut(own.mapInArrow(measure, schema), "features")


def train(table: DataFrame, labels: DataFrame, label: str, learn_from: Column, sample: int = SAMPLE) -> Additive:
    """Fit to column ``label`` of ``labels``; ``table`` is from ``measured``, ``learn_from`` a condition on _id."""
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max(label).alias("_y")).filter("_y is not null")
    rows = table.filter(learn_from).join(marks, "_id")
    n = rows.count()
    drawn = F.pmod(F.xxhash64(F.col("_id"), F.lit(23)), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / max(n, 1)) * (1 << 30)))
    got = rows.filter(drawn).select("_id", "_x", "_y").orderBy("_id").toPandas()
    return Additive().fit(np.array(got["_x"].tolist(), float).reshape(-1, len(FEATURES)), got["_y"].to_numpy(float))


def score(table: DataFrame, model: Additive) -> DataFrame:
    """doc_id and score of each row of a ``measured`` table."""

    def add_up(batches):
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    return table.mapInArrow(add_up, T.StructType([T.StructField("doc_id", table.schema["_id"].dataType), T.StructField("score", T.DoubleType())]))
