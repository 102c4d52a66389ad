"""N-gram Jaccard join by parity sketches: bit sketches of XORed shingles, joined part by part, then verified.

A text's set is its distinct runs of ``SHINGLE`` words (A-Z folded; with fewer words, all of them as one). Each shingle flips one bit of
a sketch, so bits that differ between two sketches are at most the shingles that only one of two sets has: the Hamming distance never exceeds
the symmetric difference. With 100 * intersection >= percent * union, two sets of a and b shingles differ in at most
d = (a + b) * (100 - percent) / (100 + percent) shingles, and the smaller has at least percent hundredths of the larger.

Sizes are cut into bands such that linked sets lie in the same band or in neighbouring ones. For each band the sketch has more
parts (64-bit words) than the largest d there, so two linked sets have parts that none of their differences touches (pigeonhole), at
least ``1 + spare`` of them. A set is sketched for its own band and for the next one; sets meet by band, part, the part's word and an XOR of whole hashes, which
untouched parts share too. Parts of few shingles say little and would bring strangers together: a set with at most ``spare`` such parts leaves
them out, which loses nothing, as one more part is untouched in any case. Identical sets are one node before that.

In each meeting a *hub* is compared with all others: by Hamming distance, then by the sets. After ``ROUNDS`` hubs, meetings of up to
``ROUNDS`` + 1 nodes are settled. In larger ones, further links matter
only if a node is too far from the first hub. Write e(x) for the shingles that only one of x and the hub has; x and y differ in
|e(x)| + |e(y)| - 2 |e(x) & e(y)|, so a link asks for a least number of common shingles in e(x) and e(y), which also bounds the
place at which the first common one comes in a fixed order (see ``edits``). Such nodes meet by hub and shingle within these prefixes, and pairs are
compared by Hamming distance and sets again. So no link between components is lost, and no group is expanded into all its pairs.

Texts that are null or have no words have an empty set, linked with nothing, however many there are. Identical sets are linked.
Very long texts are one set each, worked on alone. Rows repeating an id are separate documents; a null id is a component's id
only if all its ids are null. Empty tables give empty results; other columns, of any name, are passed over. Shingles count as equal if 64-bit
hashes are, sets if 128 bits are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import cut, cut_counted, lookup_table
from .graph import components
from .near import _joined, _labelled
from .wordhash import Texts, mix, slices

SHINGLE, PERCENT = 3, 90
ROUNDS = 3
SALTS = 16
LARGEST = 1 << 40  # sizes beyond which no band is needed


def bands(percent: int) -> np.ndarray:
    """First sizes of the bands; a set is linked only with sets of its band and of those next to it."""
    first = [1]
    while first[-1] < LARGEST:
        first.append(100 * first[-1] // percent + 1)
    return np.array(first, np.int64)


def parts(first: np.ndarray, band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For bands: parts of a sketch, spare ones among them, and the shingles up to which a part says little.

    Without the spare ones, there is one more part than shingles in which two linked sets can differ whose larger one is in the band.
    """
    needed = 2 * (first[band + 1] - 1) * (100 - percent) // (100 + percent) + 1
    spare = np.where(needed > 1, 1 + needed // 12, 0)  # with one part only identical sets are linked
    few = np.maximum(first[np.maximum(band - 1, 0)] // (needed + spare) // 2 - 1, 0)
    return needed + spare, spare, few


def shingle_sets(t: Texts, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle, sorted by both."""
    h = t.hashes(fold=True)
    doc, shingle = [], []
    for size in range(1, k + 1):
        at, run = t.runs(h, size)
        mine = t.counts[t.doc[at]] >= k if size == k else t.counts[t.doc[at]] == size
        doc.append(t.doc[at][mine])
        shingle.append(run[mine])
    doc, shingle = np.concatenate(doc), np.concatenate(shingle)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    if not len(doc):
        return doc, shingle
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])])
    return doc[new], shingle[new]


def places(doc: np.ndarray, shingle: np.ndarray, n_parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts with ``n_parts`` parts each: each shingle's part (those of all texts counted on), its bit, and the borders between texts."""
    border = np.concatenate([[0], np.cumsum(n_parts)])
    spread = mix(shingle)
    slot = border[doc] + (spread % np.maximum(n_parts, 1).astype(np.uint64)[doc]).astype(np.int64)
    return slot, (mix(spread) >> np.uint64(58)).astype(np.int64), border


def sketch(slot: np.ndarray, bit: np.ndarray, size: int) -> np.ndarray:
    """Words of sketches: a bit is set if an odd number of shingles flip it."""
    flips = np.bincount(slot << 6 | bit, minlength=size << 6) & 1
    return np.packbits(flips.astype(bool), bitorder="little").view(np.uint64)


def keys(doc: np.ndarray, shingle: np.ndarray, n: np.ndarray, band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """What texts with ``n`` shingles meet by under ``band``: keys, and how many there are for each text."""
    n_parts, spare, few = parts(bands(percent), band, percent)
    n_parts = np.where((n > 0) & (spare > 0), n_parts, 0)
    slot, bit, border = places(doc, shingle, n_parts)
    own = n_parts[doc] > 0
    slot, bit, whole, size = slot[own], bit[own], mix(shingle[own] ^ np.uint64(0x632BE59BD9B4E019)), int(border[-1])
    held = np.bincount(slot, minlength=size)
    total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(whole[np.argsort(slot, kind="stable")])])
    end = np.cumsum(held)
    text = np.repeat(np.arange(len(n)), n_parts)
    at = np.arange(size) - border[text]
    key = mix(mix((band[text] << 40 | at).astype(np.uint64)) ^ sketch(slot, bit, size)) + (total[end] ^ total[end - held])
    poor = held <= few[text]
    kept = ~poor | (np.bincount(text[poor], minlength=len(n)) > spare)[text]
    return mix(key[kept]), np.bincount(text[kept], minlength=len(n))


def digests(doc: np.ndarray, shingle: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each text's set."""
    out = []
    for constant in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingle ^ np.uint64(constant)), dtype=np.uint64)])
        at = np.searchsorted(doc, np.arange(n + 1))
        out.append(mix(total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def edits(a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """What tells node ``a`` from hub ``b``: shingles, how many follow each (itself included), a's excess, and is it far.

    With lo = 100 - percent, hi = 100 + percent and the excess s(x) = hi |e(x)| - lo |x|, x and y are linked if
    2 hi |e(x) & e(y)| >= s(x) + s(y), and x and the hub if s(x) <= lo |hub|. As |y| <= |hub| + |e(y)|, s(y) >=
    (hi - lo) |e(y)| - lo |hub|; a far node (not linked to the hub) thus shares at least (s - lo |hub|) / (hi + lo) with any y, and any node at least
    (s + lo |hub| + 1) / (2 hi) with a far one. Only pairs with a far node are wanted. Shingles that the hub lacks come first, as they are
    rarer; of these, only those in which the first common one can be are given.
    """
    lo, hi = 100 - percent, 100 + percent
    items = np.concatenate([np.setdiff1d(a, b, assume_unique=True), np.setdiff1d(b, a, assume_unique=True)])
    s = hi * len(items) - lo * len(a)
    far = s > lo * len(b)
    common = -(-(s + lo * len(b) + 1) // (2 * hi))
    if far:
        common = min(common, -(-(s - lo * len(b)) // (hi + lo)))
    first = max(0, len(items) - max(1, common) + 1)
    return items[:first], len(items) - np.arange(first), s, far


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row, stored: _id, _n (set size), _hi and _lo (digest of the set), _keys and _part."""
    first = bands(percent)

    def make(batches):
        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column):
                doc, shingle = shingle_sets(Texts(column.slice(a, b - a)))
                n = np.bincount(doc, minlength=b - a)
                band = np.searchsorted(first, np.maximum(n, 1), side="right") - 1
                both = [keys(doc, shingle, n, band + k, percent) for k in (0, 1)]
                key, counts = np.concatenate([k for k, _ in both]), [c for _, c in both]
                key = key[np.argsort(np.concatenate([np.repeat(np.arange(b - a), c) for c in counts]), kind="stable")]
                border = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(border), pa.array(key.view(np.int64)))
                columns = [batch.column("_id").slice(a, b - a), *map(pa.array, (n, *digests(doc, shingle, b - a))), lists]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_n", "_hi", "_lo", "_keys"])

    own = docs.select(docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    longs = [T.StructField(c, T.LongType()) for c in ("_n", "_hi", "_lo")]
    rows = own.mapInArrow(make, T.StructType([own.schema["_id"], *longs, T.StructField("_keys", T.ArrayType(T.LongType()))]))
    return cut(rows.withColumn("_part", (F.monotonically_increasing_id() % SALTS).cast("int")), "sketches")


def meetings(sketch: DataFrame) -> DataFrame | None:
    """(key, node, first, _centre), stored, of keys that several nodes share; None if there are none.

    ``first`` is the node's smallest id; ``_centre`` tells how much company a node has in all its meetings.
    """
    rows = sketch.select(F.col("_hi").alias("hi"), F.explode("_keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("hi").alias("_a"), F.max("hi").alias("_b")).filter("_a != _b")
    shared, n = cut_counted(shared.select("key"), "shared")
    if not n:
        return None
    members = cut(rows.join(shared, "key").distinct(), "members")
    crowd = members.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    centre = members.join(crowd, "key").groupBy("hi").agg(F.sum("_n").alias("_centre"))
    nodes = sketch.join(centre, sketch["_hi"] == centre["hi"]).groupBy("hi", "_lo", "_centre").agg(F.min("_id").alias("first"))
    nodes = nodes.select("hi", _node("hi", "_lo").alias("node"), "first", "_centre")
    return cut(members.join(nodes, "hi").select("key", "node", "first", "_centre"), "members")


def _node(hi: str, lo: str):
    return F.unhex(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) of nodes that neither sizes nor Hamming distance rule out."""
    side = lambda x: sets.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "band", "own", "next")])
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    step = F.col("band_a") - F.col("band_b")
    words = F.when(step < 0, F.col("next_a")).otherwise(F.col("own_a")), F.when(step > 0, F.col("next_b")).otherwise(F.col("own_b"))
    distance = F.aggregate(F.zip_with(*words, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    few = (100 + percent) * distance <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return rows.filter((F.abs(step) <= 1) & few).select("a", "b")


def _sets(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """One row per node, stored: node, s (its set), n, band, own and next (sketches for its band and the next one)."""
    first = bands(percent)
    nodes = members.select("node", "first").distinct()
    own = docs.select(docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    wanted = lookup_table(nodes.select("first").distinct(), "firsts")  # broadcast if few: no text travels
    own = own.join(wanted, F.col("_id").eqNullSafe(F.col("first")), "left_semi").select("_text")

    def make(batches):
        seen = set()  # 16 bytes for each text of this task
        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column):
                doc, shingle = shingle_sets(Texts(column.slice(a, b - a)))
                names = [int(x).to_bytes(8, "big", signed=True) + int(y).to_bytes(8, "big", signed=True) for x, y in zip(*digests(doc, shingle, b - a))]
                keep = []
                for i, name in enumerate(names):
                    if name not in seen:
                        seen.add(name)
                        keep.append(i)
                n = np.bincount(doc, minlength=b - a)
                band = np.searchsorted(first, np.maximum(n, 1), side="right") - 1
                lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32)), pa.array(shingle.view(np.int64)))]
                for k in (0, 1):
                    slot, bit, border = places(doc, shingle, np.where(n > 0, parts(first, band + k, percent)[0], 0))
                    lists.append(pa.ListArray.from_arrays(pa.array(border.astype(np.int32)), pa.array(sketch(slot, bit, int(border[-1])).view(np.int64))))
                columns = [pa.array(names, pa.binary()), *map(pa.array, (n, band)), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "band", "s", "own", "next"]).take(pa.array(keep, pa.int64()))

    schema = "node binary, n bigint, band bigint, s array<bigint>, own array<bigint>, next array<bigint>"
    found, n = cut_counted(own.mapInArrow(make, schema), "sets")
    once, each = cut_counted(nodes.select("node").distinct().join(found.select("node"), "node", "left_semi"), "set-nodes")
    if n == each:
        return found
    return cut(found.join(once, "node", "left_semi").dropDuplicates(["node"]), "sets")  # other texts of these ids, or tasks that met the same set


def _pairs_of(batch: pa.RecordBatch):
    lists = []
    for name in ("sa", "sb"):
        c = batch.column(name)
        off = c.offsets.to_numpy()
        lists.append((c.flatten().to_numpy().view(np.uint64), off - off[0] if len(off) else off))
    for i in range(batch.num_rows):
        yield tuple(values[off[i] : off[i + 1]] for values, off in lists)


def _with_sets(pairs: DataFrame, sets: DataFrame, *more: str) -> DataFrame:
    side = lambda x: sets.select(F.col("node").alias(x), F.col("s").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(pairs.select("a", "b").join(side("b"), "b"), ["a", "b"]).select("a", "b", *more, "sa", "sb")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` that are linked by their whole sets."""

    def test(batches):
        for batch in batches:
            good = []
            for a, b in _pairs_of(batch):
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return _with_sets(pairs, sets).mapInArrow(test, "a binary, b binary")


def _apart(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For pairs of node and hub: the node's edits."""

    def tell(batches):
        for batch in batches:
            told = [edits(a, b, percent) for a, b in _pairs_of(batch)]
            lists = [pa.array([t[k].view(np.int64) for t in told], pa.list_(pa.int64())) for k in (0, 1)]
            more = [pa.array([t[2] for t in told], pa.int64()), pa.array([t[3] for t in told], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *lists, *more], ["a", "b", "items", "rest", "s", "far"])

    return _with_sets(pairs, sets).mapInArrow(tell, "a binary, b binary, items array<bigint>, rest array<bigint>, s bigint, far boolean")


def _meeting(told: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components, one of them far from a common hub, that may be linked by their edits from it."""
    rows = _labelled(told, "a", labels)
    each = F.explode(F.arrays_zip("items", "rest")).alias("_e")
    rows = rows.select("a", "label", "far", "s", F.col("b").alias("hub"), each)
    rows = cut(rows.select(F.xxhash64("hub", "_e.items").alias("met"), "a", "label", "far", "s", F.col("_e.rest").alias("rest")), "edits")
    kinds = rows.groupBy("met").agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.max("far").alias("_far"))
    rows = cut(rows.join(kinds.filter("_low != _high and _far").select("met"), "met"), "met")
    other = rows.select("met", *[F.col(c).alias(f"_{c}") for c in ("a", "label", "far", "s", "rest")])
    enough = 2 * (100 + percent) * F.least("rest", "_rest") >= F.col("s") + F.col("_s")
    pairs = rows.filter("far").join(other, "met").filter((F.col("label") != F.col("_label")) & enough & (~F.col("_far") | (F.col("a") < F.col("_a"))))
    return pairs.select(F.least("a", "_a").alias("a"), F.greatest("a", "_a").alias("b")).distinct()


def links(docs: DataFrame, sketch: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(id, label) of the nodes that are linked with another node; None if there are none."""
    members = meetings(sketch)
    if members is None:
        return None
    sets = _sets(docs, members, percent)
    labels, tested, hubs = None, None, None
    for _ in range(ROUNDS):
        hub = members.groupBy("key").agg(F.max(F.struct("_centre", "node")).alias("_hub")).select("key", F.col("_hub.node").alias("hub"))
        placed = cut(members.join(hub, "key"), "hubs")
        hubs = placed.select("key", "hub").distinct() if hubs is None else hubs
        apart = placed.filter("node != hub")
        if labels is not None:
            apart = _labelled(_labelled(apart, "node", labels), "hub", labels, "_own").filter("label != _own")
        pairs = apart.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = verified(lookup_table(possible(pairs, sets, percent), "few"), sets, percent)
        labels = components(cut(found, "found")) if labels is None else _joined(labels, found)
        left = _labelled(placed.filter("node != hub").drop("hub"), "node", labels)
        kinds = left.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low != _high")
        members, n = cut_counted(left.join(kinds.select("key"), "key").drop("label"), "open")
        if not n:
            return labels
    around = members.select("key", F.col("node").alias("a")).join(hubs, "key").select("a", F.col("hub").alias("b")).distinct()
    told = cut(_apart(lookup_table(around, "around"), sets, percent), "told")
    pairs = cut(_meeting(told, labels, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
    return _joined(labels, verified(lookup_table(possible(pairs, sets, percent), "few"), sets, percent))


def link(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest id that links lead to."""
    sketch = sketches(docs, percent)
    labels = links(docs, sketch, percent)
    filled = sketch.filter("_n > 0")
    nodes = filled.groupBy("_hi", "_lo").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")).withColumn("_node", _node("_hi", "_lo"))
    if labels is None:
        nodes = nodes.withColumn("_label", F.col("_node"))
    else:
        nodes = nodes.join(labels, nodes["_node"] == labels["id"], "left").withColumn("_label", F.coalesce("label", "_node"))
    classes = nodes.groupBy("_label").agg(F.min("_first").alias("_class"), F.sum("_rows").alias("_size")).filter("_size > 1")
    known = nodes.join(classes, "_label").select("_hi", "_lo", "_class", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"))
    rows = sketch.select("_id", "_n", "_hi", "_lo", "_part")
    rest, rows = rows.filter("_n = 0"), rows.filter("_n > 0").join(known, ["_hi", "_lo", "_part"], "left")
    own = rows.select("_id", "_n", F.when(F.col("_class").isNull(), F.col("_id")).otherwise(F.col("_class")).alias("_class"))
    out = own.unionByName(rest.select("_id", "_n", F.col("_id").alias("_class")))
    return out.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_class").alias("component_id"))
