"""Near-duplicates by ProbMinHash: signatures of weighted shingles, banding, verification, components.

A shingle is a run of ``SHINGLE`` words (A-Z folded), or all words of a shorter text; its weight is the number of times it
occurs. Each shingle sends a Poisson process of that rate into the components of a signature, and a component holds
the shingle that arrives first, so two signatures agree in a component with the probability Jaccard similarity. A
shingle stops as soon as its next arrival is later than a bound by which all components are filled; where one isn't, the
bound is widened and the text is done again.

Equal texts are one node. Nodes that share a band are candidates. A link needs an exact probability Jaccard
similarity of at least ``SIMILARITY``. In each bucket one node, the hub, is compared with all others. Any other
link between components must be between a node that is far from the hub and a node with which it shares some of its
*edits*, the shingles that only one of node and hub has: where common shingles weigh the same, similarity is a function of
the two masses and of the mass of the edits that only one of the two nodes has. So nodes meet by hub and edit, and a pair is
tested only if the edits that follow the one they meet in can still suffice (see ``edits``) and if the parities of their
shingles do not differ in too many bits (see ``_meeting``). Nodes whose common
shingles weigh differently from the hub's ("odd") are compared with all nodes of other components in their buckets,
a few at a time, unless their distances from the hub, or the shingles that only one of either and hub has, rule a link
out (see ``_possible``). So all links between components are found without listing all pairs of a group.

Null texts count as empty. Texts without words are near only to equal texts. Rows repeating an id and text go together;
a null id is never a class id unless all ids of the class are null. Empty tables give empty results; other columns
may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import cut, cut_counted, lookup_table
from .graph import components
from .wordhash import Texts, mix, slices

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
SALTS = 16
SLICE_TEXTS = 512  # texts whose arrivals are worked on together
SLACK = 1e-6  # allowed for rounding where pairs are left out
NUMBERS = ["fresh", "gone", "top_fresh", "top_gone", "mass", "scale", "under", "ratio"]
HUBS = 64  # odd nodes of a bucket that are compared with the others in the first such round; twice as many in each later one


def weighted(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight of each distinct shingle, sorted by text and shingle."""
    h = t.hashes(fold=True)
    at, shingle = t.runs(h, SHINGLE)
    doc = t.doc[at]
    for k in range(1, SHINGLE):
        short = np.flatnonzero(t.counts == k)
        if len(short):
            at, own = t.runs(h, k)
            mine = np.isin(t.doc[at], short)
            doc, shingle = np.concatenate([doc, t.doc[at][mine]]), np.concatenate([shingle, own[mine]])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])])) if len(doc) else np.zeros(0, int)
    return doc[new], shingle[new], np.diff(np.append(new, len(doc)))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, size: int = BANDS * ROWS) -> np.ndarray:
    """The signature of each of ``n`` texts; zeros for those without shingles."""
    out = np.zeros((n, size), np.uint64)
    mass = np.bincount(doc, weight, n)
    bound = size * (np.log(size) + 6) / np.maximum(mass, 1)
    todo = mass > 0
    while todo.any():
        own = np.flatnonzero(todo[doc])
        best, key = np.full(n * size, np.inf), np.zeros(n * size, np.uint64)
        elapsed, k = np.zeros(len(own)), 0
        while len(own):
            k += 1
            random = mix(shingle[own] ^ mix(np.array([k * 0x2545F4914F6CDD1D & (2**64 - 1)], np.uint64))[0])
            elapsed = elapsed - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[own]
            on = elapsed < bound[doc[own]]
            own, elapsed = own[on], elapsed[on]
            slot = doc[own] * size + (mix(random[on] + np.uint64(0x632BE59BD9B4E019)) % np.uint64(size)).astype(np.int64)
            np.minimum.at(best, slot, elapsed)
            first = elapsed == best[slot]
            key[slot[first]] = shingle[own[first]]
        full = np.isfinite(best.reshape(n, size)).all(1) & todo
        out[full] = key.reshape(n, size)[full]
        todo &= ~full
        bound = bound * 2
    return out


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two sorted sets with weights: the sum over common x of
    1 / sum over y of max(a(y)/a(x), b(y)/b(x))."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    u, v = wa[i].astype(float), wb[j].astype(float)
    only_a, only_b = wa.sum() - u.sum(), wb.sum() - v.sum()
    if (wa == 1).all() and (wb == 1).all():
        return len(both) / (len(a) + len(b) - len(both))
    order = np.argsort(u / v)
    u, v = u[order], v[order]
    ratio = u / v
    below = np.concatenate([[0], np.cumsum(v)])  # elements with a smaller ratio count with b's weight
    above = u.sum() - np.concatenate([[0], np.cumsum(u)])
    at = np.searchsorted(ratio, ratio)
    return float((1 / ((only_a + above[at]) / u + (only_b + below[at]) / v)).sum())


def edits(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, near: bool, least: float):
    """What a node (a, wa) tells of itself by its difference from a hub (b, wb); None if it is odd.

    With v the weight of a shingle in all nodes that aren't odd, t = ``least`` and r = (1-t) / (1+t), x and y are linked
    if v(x ^ y) <= r (v(x) + v(y)). For the edits e = x ^ hub this means v(e(x) & e(y)) >= (s(x) + s(y)) / 2 with
    s(x) = v(e(x)) - r v(x). If x isn't linked to the hub, s(x) > r v(hub); for any y, s(y) >= (1-r) v(e(y)) - r v(hub). So with
    such an x the common mass is over (s(y) + r v(hub)) / 2, thus positive, and at least (s(x) - r v(hub)) / (1+r).
    Returned are the edits among which the first common one must be (those the hub lacks come first, as they are
    rarer), the mass from each on, and s.
    """
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    own, lost = np.ones(len(a), bool), np.ones(len(b), bool)
    own[i], lost[j] = False, False
    if (wa[i] != wb[j]).any() or (wa[own] != 1).any():
        return None
    items, mass = np.concatenate([a[own], b[lost]]), np.concatenate([wa[own], wb[lost]])
    r, hub = (1 - least) / (1 + least), wb.sum()
    s, rest = mass.sum() - r * wa.sum(), mass.sum() - np.cumsum(mass) + mass
    common = (s + r * hub) / 2
    if not near:
        common = min(common, (s - r * hub) / (1 + r))
    first = rest >= common - SLACK
    return items[first], rest[first], s


def _bands(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2])
    for r in range(ROWS):
        key = mix(key ^ parts[:, :, r]) * np.uint64(0xD6E8FEB86659FD93)
    return key


def _node(text):
    return F.unhex(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 32))


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: _id, _node (a digest of the text) and _bands, stored."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").alias("_id"), _node(text).alias("_node"), text.alias("_text"))

    def sketch(batches):
        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column, rows=SLICE_TEXTS):
                t = Texts(column.slice(a, b - a))
                bands = _bands(signatures(*weighted(t), b - a))
                each = np.where(t.counts > 0, BANDS, 0)
                flat = bands[t.counts > 0].reshape(-1).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
                column_bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), batch.column("_node").slice(a, b - a), column_bands], ["_id", "_node", "_bands"])

    schema = T.StructType([own.schema["_id"], own.schema["_node"], T.StructField("_bands", T.ArrayType(T.LongType()))])
    return cut(own.mapInArrow(sketch, schema), "sketches")


def _shingles(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles, weights) of the texts whose digest and id are in ``nodes`` (_node, _first), stored."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").alias("_id"), _node(text).alias("_node"), text.alias("_text"))
    wanted = lookup_table(nodes.select(F.col("_node").alias("_want"), "_first"), "wanted")  # broadcast if few: no text travels
    own = own.join(wanted, (F.col("_node") == F.col("_want")) & F.col("_id").eqNullSafe(F.col("_first")), "left_semi")

    def cut_up(batches):
        for batch in batches:
            column = batch.column("_text")
            for a, b in slices(column):
                doc, shingle, weight = weighted(Texts(column.slice(a, b - a)))
                offsets = pa.array(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (shingle.view(np.int64), weight.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column("_node").slice(a, b - a), *lists], ["node", "s", "w"])

    return cut(own.select("_node", "_text").mapInArrow(cut_up, "node binary, s array<bigint>, w array<int>"), "shingles")


def _with_shingles(pairs: DataFrame, shingles: DataFrame, *more: str) -> DataFrame:
    """``pairs`` from ``lookup_table``: if they are few, only the shingles of these pairs travel."""
    side = lambda x: shingles.select(F.col("node").alias(x), F.col("s").alias(f"s{x}"), F.col("w").alias(f"w{x}"))
    return pairs.join(side("a"), "a").join(pairs.select("a", "b").join(side("b"), "b"), ["a", "b"]).select("a", "b", *more, "sa", "wa", "sb", "wb")


def _weighted_pairs(batch: pa.RecordBatch):
    """For each row of a batch: shingles and weights of both sides."""
    lists = []
    for name, kind in (("sa", np.uint64), ("wa", np.int64), ("sb", np.uint64), ("wb", np.int64)):
        c = batch.column(name)
        flat, off = c.flatten().to_numpy(), c.offsets.to_numpy()
        lists.append((flat.view(kind) if kind is np.uint64 else flat.astype(kind), off - off[0] if len(off) else off))
    for i in range(batch.num_rows):
        yield tuple(values[off[i] : off[i + 1]] for values, off in lists)


def _verified(pairs: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    def test(batches):
        for batch in batches:
            good = [similarity(*x) >= least for x in _weighted_pairs(batch)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return _with_shingles(pairs, shingles).mapInArrow(test, "a binary, b binary")


def _compared(pairs: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    """Node a and hub b (``others``: the bucket has more nodes): their similarity, is a odd, and its edits if others are there.

    ``apart`` and the columns of ``NUMBERS`` are what ``_possible`` asks for (see ``_apart``), ``parity`` is what ``_meeting`` does.
    """

    def test(batches):
        for batch in batches:
            like, odd, items, rest, s, apart, numbers, parity = [], [], [], [], [], [], [], []
            for x, others in zip(_weighted_pairs(batch), batch.column("others").to_pylist()):
                like.append(similarity(*x))
                told = edits(*x, like[-1] >= least, least) if others else ((), (), 0.0)
                odd.append(told is None)
                told = told or ((), (), 0.0)
                items.append(np.asarray(told[0], np.uint64).view(np.int64))
                rest.append(np.asarray(told[1], np.int64))
                s.append(float(told[2]))
                parity.append(_parity(x[0], len(x[2])) if len(told[0]) else ())
                only, told = _apart(*x) if others else (np.zeros(0, np.uint64), (0.0,) * len(NUMBERS))
                apart.append(only.view(np.int64))
                numbers.append(told)
            rows = [like, odd, pa.array(items, pa.list_(pa.int64())), pa.array(rest, pa.list_(pa.int64())), pa.array(s, pa.float64())]
            rows[:2] = [pa.array(like, pa.float64()), pa.array(odd, pa.bool_())]
            rows += [pa.array(apart, pa.list_(pa.int64())), *[pa.array(c, pa.float64()) for c in (np.array(numbers, float).reshape(-1, len(NUMBERS)).T)]]
            rows.append(pa.array(parity, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *rows], ["a", "b", "like", "odd", "items", "rest", "s", "apart", *NUMBERS, "parity"])

    return _with_shingles(pairs, shingles, "others").mapInArrow(
        test, "a binary, b binary, like double, odd boolean, items array<bigint>, rest array<bigint>, s double, apart array<bigint>, " + "".join(f"{c} double, " for c in NUMBERS) + "parity array<bigint>"
    )


def _parity(shingles: np.ndarray, size: int) -> np.ndarray:
    """Is the number of shingles that fall on each bit odd? As many bits as a hub of ``size`` shingles has or more, a power of two, in words."""
    bits = 64 << max(0, (size - 1).bit_length() - 6)
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _apart(sa, wa, sb, wb):
    """Shingles that only node a or only hub b has, and numbers in the order of ``NUMBERS``.

    These are the masses of a's own shingles and of those gone (by the hub's weights), the heaviest of each, the mass of a, and
    what tells the mass that a has on any of the hub's shingles that it shares: at least ``ratio`` times the hub's, and at
    least ``scale`` times the hub's less ``under``.
    """
    _, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    fresh, gone = np.delete(np.arange(len(sa)), ia), np.delete(np.arange(len(sb)), ib)
    own, hub = wa[ia].astype(float), wb[ib].astype(float)
    scale = own.sum() / hub.sum() if len(ia) else 0.0
    told = (
        wa[fresh].sum(), wb[gone].sum(), wa[fresh].max(initial=0), wb[gone].max(initial=0), wa.sum(),
        scale, np.maximum(scale * hub - own, 0).sum(), (own / hub).min() if len(ia) else 0.0,
    )
    return np.concatenate([sa[fresh], sb[gone]]), told


def _possible(least: float):
    """Can two nodes, compared with the same hub, be linked? By what is apart between each and the hub (``_``: the other's).

    If the shares a and b of their masses lie on common shingles, their similarity is at most 1 / (1 + (1 - a) / a + (1 - b) / b),
    whatever the weights: with p and q for the distributions on common shingles, each term of the similarity is at most
    f(p, q) = 1 / (max(1 / p, 1 / q) + (1 - a) / a / p + (1 - b) / b / q), which is concave and of degree one, so the terms sum up to
    at most f(1, 1). Shingles that are apart from the hub in one node only are apart between the nodes; those that are apart
    in both, of which only the number is known, count as the heaviest.
    """
    zero = F.lit(0.0)

    def inverse(own: str, other: str, shared):
        """1 / a, at least, for the node whose columns begin with ``own``."""
        column = lambda name: F.col(own + name)
        fresh = F.greatest(column("fresh") - shared * column("top_fresh"), zero)
        lacks = F.greatest(F.col(f"{other}gone") - shared * F.col(f"{other}top_gone"), zero)
        apart = fresh + F.greatest(column("scale") * lacks - column("under"), column("ratio") * lacks)
        return column("mass") / F.greatest(column("mass") - apart, F.lit(1e-9))

    shared = F.array(F.size(F.array_intersect("apart", "_apart")))  # taken once for each pair, by the lambda
    return F.exists(shared, lambda n: inverse("", "_", n) + inverse("_", "", n) <= 1 / least + 1 + SLACK)


def _meeting(compared: DataFrame, labels: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of different components that may be linked by what their edits from a common hub tell.

    Each shingle that only one of two nodes has turns one bit of its parity, so they differ by at least as much mass as their parities
    differ in bits; linked nodes that aren't odd differ by at most (1-t) / (1+t) of their masses (see ``edits``).
    """
    told = compared.filter("size(items) > 0").withColumn("words", F.size("parity"))
    rows = _labelled(_labelled(told, "a", labels), "b", labels, "_own")
    each = F.explode(F.arrays_zip("items", "rest")).alias("_e")
    rows = rows.select("a", "label", (F.col("label") != F.col("_own")).alias("far"), "s", "words", F.col("b").alias("hub"), each)
    met = F.xxhash64("hub", "_e.items").alias("met")
    rows = cut(rows.select(met, "a", "label", "far", "s", "words", F.col("_e.rest").alias("rest")), "edits")
    shared = rows.groupBy("met").agg(F.count(F.lit(1)).alias("_n"), F.max("far").alias("_far")).filter("_n > 1 and _far").select("met")
    parities = told.select("a", "words", "mass", "parity").dropDuplicates(["a", "words"])  # those of a node are equal
    rows = cut(rows.join(shared, "met").join(parities, ["a", "words"]).drop("words"), "met")
    other = rows.select("met", *[F.col(c).alias(f"_{c}") for c in ("a", "label", "far", "s", "rest", "mass", "parity")])
    may = F.least("rest", "_rest") >= (F.col("s") + F.col("_s")) / 2 - SLACK
    turned = F.zip_with("parity", "_parity", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    may &= F.aggregate(turned, F.lit(0), lambda n, x: n + x) <= (1 - least) / (1 + least) * (F.col("mass") + F.col("_mass")) + SLACK
    pairs = rows.filter("far").join(other, "met").filter((F.col("label") != F.col("_label")) & (~F.col("_far") | (F.col("a") < F.col("_a"))) & may)
    return pairs.select(F.least("a", "_a").alias("a"), F.greatest("a", "_a").alias("b")).distinct()


def links(docs: DataFrame, sketch: DataFrame, least: float = SIMILARITY) -> DataFrame | None:
    """(id, label) of the texts that are near another text, both as digests; None if there are none."""
    nodes = sketch.groupBy("_node").agg(F.min("_id").alias("_first"), F.first("_bands").alias("_bands"))
    rows = nodes.select(F.col("_node").alias("id"), "_first", F.explode("_bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    members, n = cut_counted(rows.join(shared, "key").select("key", "id", "_first", "_n"), "members")
    if not n:
        return None
    shingles = _shingles(docs, members.select(F.col("id").alias("_node"), "_first").distinct())
    # The node that shares most with others is the hub: one of which the others are variants links them all.
    centre = members.groupBy("id").agg(F.sum("_n").alias("_centre"))
    members = cut(members.join(centre, "id").select("key", "id", "_n", "_centre"), "members")
    hub = members.groupBy("key").agg(F.max(F.struct("_centre", "id")).alias("_hub")).select("key", F.col("_hub.id").alias("hub"))
    members = cut(members.join(hub, "key").filter("id != hub").select("key", "id", "hub", "_n", "_centre"), "members")
    pairs = members.groupBy(F.col("id").alias("a"), F.col("hub").alias("b")).agg((F.max("_n") > 2).alias("others"))
    compared = cut(_compared(lookup_table(pairs, "few"), shingles, least), "compared")
    labels, tested = components(compared.filter(F.col("like") >= least)), compared.select("a", "b")

    pairs = lookup_table(_meeting(compared, labels, least), "pairs")
    tested = tested.unionByName(pairs)
    labels = _joined(labels, _verified(pairs, shingles, least))

    to_hub = compared.select(F.col("a").alias("id"), F.col("b").alias("hub"), "odd", "like")
    some = members.join(to_hub.filter("odd"), ["id", "hub"], "left_semi").select("key").distinct()
    members = members.join(some, "key", "left_semi").join(to_hub, ["id", "hub"])
    members, hubs = cut(members.select("key", "id", "hub", "_centre", "odd", "like"), "members"), HUBS
    apart = compared.select(F.col("a").alias("id"), F.col("b").alias("hub"), "apart", *NUMBERS)
    while True:
        placed = _labelled(members, "id", labels)
        kinds = placed.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.max("odd").alias("_odd"))
        open_, n = cut_counted(placed.join(kinds.filter("_low != _high and _odd").select("key"), "key"), "open")
        if not n:
            return labels
        first = Window.partitionBy("key").orderBy(F.desc("_centre"), "id")
        told = open_.join(apart, ["id", "hub"])
        chosen = told.filter("odd").withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= hubs)
        chosen = chosen.select("key", F.col("id").alias("_hub"), F.col("label").alias("_own"), F.col("like").alias("_like"), *[F.col(c).alias(f"_{c}") for c in ("apart", *NUMBERS)])
        # One minus similarity is a distance: by their distances from the bucket's hub, two nodes can be too far apart.
        may = (F.col("label") != F.col("_own")) & (F.abs(F.col("like") - F.col("_like")) <= 1 - least + SLACK) & _possible(least)
        pairs = told.join(chosen, "key").filter(may).select(F.least("id", "_hub").alias("a"), F.greatest("id", "_hub").alias("b"))
        pairs = lookup_table(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        labels = _joined(labels, _verified(pairs, shingles, least))
        gone = chosen.select("key", F.col("_hub").alias("id"))
        members = cut(open_.select("key", "id", "hub", "_centre", "odd", "like").join(gone, ["key", "id"], "left_anti"), "members")
        hubs = 2 * hubs


def _labelled(rows: DataFrame, column: str, labels: DataFrame, name: str = "label") -> DataFrame:
    """``rows`` with the label of ``column``, its own value where it has none."""
    own = labels.select(F.col("id").alias("_i"), F.col("label").alias("_l"))
    return rows.join(own, rows[column] == own["_i"], "left").withColumn(name, F.coalesce("_l", column)).drop("_i", "_l")


def _joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after adding edges: components of the edges between the labels so far."""
    found, n = cut_counted(edges, "edges")
    if not n:
        return labels
    ends = _labelled(_labelled(found, "a", labels, "_a"), "b", labels, "_b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    merged = components(ends.filter("a != b").distinct())
    moved = _labelled(labels, "label", merged, "_new").select("id", F.col("_new").alias("label"))
    fresh = merged.join(labels.select("id"), "id", "left_anti")
    return cut(moved.unionByName(fresh), "labels")


def classify(docs: DataFrame, least: float = SIMILARITY, salts: int = SALTS) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (smallest id of its class), class_size, kept (is it that id), node."""
    sketch = sketches(docs)
    labels = links(docs, sketch, least)
    nodes = sketch.groupBy("_node").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    if labels is None:
        nodes = nodes.withColumn("_label", F.col("_node"))
    else:
        nodes = nodes.join(labels, nodes["_node"] == labels["id"], "left").withColumn("_label", F.coalesce("label", "_node"))
    classes = nodes.groupBy("_label").agg(F.min("_first").alias("_class"), F.sum("_rows").alias("_size")).filter("_size > 1")
    known = nodes.select("_node", "_label").join(classes, "_label").select("_node", "_class", "_size")
    spread = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = sketch.select("_id", "_node", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("_part"))
    out = rows.join(spread, ["_node", "_part"], "left")
    own = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_class"))
    return out.select(
        F.col("_id").alias("doc_id"),
        own.alias("class_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("class_size"),
        F.col("_id").eqNullSafe(own).alias("kept"),
        F.lower(F.hex("_node")).alias("node"),
    )


def deduplicate(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` but for those of which another one in their class stays."""
    dropped = classify(docs, least).filter("not kept").select(F.col("doc_id").alias("_drop"), F.unhex("node").alias("_node")).distinct()
    names = [f"_c{i}" for i in range(len(docs.columns))]  # columns of any name go by their places
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    out = docs.toDF(*names).withColumn("_key", _node(F.coalesce(text, F.lit(""))))
    out = out.join(dropped, doc_id.eqNullSafe(F.col("_drop")) & (F.col("_key") == F.col("_node")), "left_anti")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
