"""Spelling variants: words one edit apart, found by pivotal bigrams, and the more frequent form each leads to.

All bigrams are ranked from rare to frequent. A word's *prefix* is its three rarest bigrams (all that rank like the third, if there are
ties); among them two that don't overlap, the *pivots*, are chosen by dynamic programming so that they are the rarest pair. One edit
touches at most one of two disjoint bigrams. So of two words one edit apart, the one whose third rank is lower (or
equal) has a pivot that the other one holds unchanged, and holds within its prefix. The edit is before that pivot, and then both words
are equal from it to their ends, or behind it, and they are equal up to it: so its place, counted from the end or from the
start, is the same in both. Pivots therefore meet prefixes by one hash join on the bigram with all that stands on that side of it, and the length,
which differs by one at most. Words that meet are compared by edit distance. Keys that very many prefixes share are dealt
over parts, so no task holds all of one key.

A word's form is its near word of largest count (ties: the smallest in code-point order) if that count is at least ``RATIO`` times
its own; roots follow forms by pointer doubling. Counts rise along forms, so there are no circles.

Null texts have no words. Empty texts and tables give no rows. Very long texts are split into runs where they lie; a word
of any length is one word; those of over ``SHORT`` code points travel as numbers until two of them are compared. Repeated rows count each time; a null id counts as the empty
string. Other columns, of any name, are passed over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import cut, cut_counted, lookup_table
from .wordhash import mix

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
SLOTS = 1 << 16  # bigrams of Latin letters have a slot each, others may share one, which only adds candidates
HOT_ROWS = 20_000  # prefixes of one key that a part of it holds
SHORT = 64  # words up to so many code points go with their keys
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, damage: int | None = None, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, of a least length and count.

    With ``damage``, a run loses one code point where that number divides the crc32 ``h`` of ``<doc_id>:<run>``: that at ``h`` modulo its length.
    """
    ascii_only = F.length("text") == F.octet_length("text")
    lowered = F.when(ascii_only, F.lower("text")).otherwise(F.translate("text", UPPER, LOWER))
    run = F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("word")
    rows = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"), docs["text"].alias("text")).select("id", run)
    if damage:
        at = (F.col("h") % F.length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        rows = rows.select(F.when(F.col("h") % damage == 0, less).otherwise(F.col("word")).alias("word"))
    long_enough = rows.select("word").filter(F.length("word") >= least_chars)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _by_length(column: pa.Array):
    """For each length in a column of words: row numbers and a matrix of code points."""
    texts = column.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        yield int(n), own, points[starts[own][:, None] + np.arange(n)].astype(np.int64)


def _slots(points: np.ndarray) -> np.ndarray:
    return (points[:, :-1] * 256 + points[:, 1:]) % SLOTS


def pivotal(slots: np.ndarray, rank: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length (rows of bigram ``slots``): which bigrams are in the prefix, which two are pivots, and the third rank."""
    m, g = slots.shape
    order = rank[slots]
    third = np.partition(order, 2, axis=1)[:, 2]
    prefix = order <= third[:, None]
    cost = np.where(prefix, weight[slots], np.inf)
    # best[i]: the cheapest bigram at or before place i; two[i]: the cheapest pair whose second one is at or before i.
    best, best_at = cost[:, 0].copy(), np.zeros(m, np.int64)
    two, pair = np.full(m, np.inf), np.zeros((m, 2), np.int64)
    held, held_at = [best.copy()], [best_at.copy()]
    for i in range(1, g):
        if i >= 2:
            both = held[0] + cost[:, i]
            better = both < two
            two[better] = both[better]
            pair[better] = np.stack([held_at[0], np.full(m, i)], 1)[better]
            held, held_at = held[1:], held_at[1:]
        cheaper = cost[:, i] < best
        best[cheaper], best_at[cheaper] = cost[cheaper, i], i
        held.append(best.copy())
        held_at.append(best_at.copy())
    return prefix, pair, third


def sides(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bigram of words of one length: a hash of the word through it, and of the word from it on."""
    codes = mix(points.astype(np.uint64) + np.uint64(1))
    powers = np.cumprod(np.full(points.shape[1], 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    heads = np.cumsum(codes * powers, axis=1, dtype=np.uint64)[:, 1:]
    tails = np.cumsum(codes[:, ::-1] * powers, axis=1, dtype=np.uint64)[:, :0:-1]
    return mix(heads), mix(tails ^ np.uint64(0xD6E8FEB86659FD93))


def _key(side: np.ndarray, chars: int) -> np.ndarray:
    return mix(side + np.uint64(chars * 0xA24BAED4963EE407 & 2**64 - 1)).view(np.int64)


def _indexed(table: DataFrame, counts: np.ndarray) -> DataFrame:
    """Per word: id, third, word (null if it isn't short), and the keys of its prefix (held) and of its pivots (asked)."""
    rank = np.empty(SLOTS, np.int64)
    rank[np.lexsort((np.arange(SLOTS), counts))] = np.arange(SLOTS)
    weight = counts.astype(float) + 1

    def index(batches):
        for batch in batches:
            for n, own, points in _by_length(batch.column("word")):
                prefix, pair, third = pivotal(_slots(points), rank, weight)
                both = sides(points)
                held = np.stack([_key(x, n) for x in both], 2)[prefix].reshape(-1)
                asked = np.stack([_key(np.take_along_axis(x, pair, 1), n + d) for x in both for d in (-1, 0, 1)], 2).reshape(-1)
                borders = np.concatenate([[0], np.cumsum(2 * prefix.sum(1))]), np.arange(len(own) + 1) * 12
                lists = [pa.ListArray.from_arrays(pa.array(x.astype(np.int32)), pa.array(k)) for x, k in zip(borders, (held, asked))]
                words = batch.column("word").take(pa.array(own)) if n <= SHORT else pa.nulls(len(own), pa.string())
                ids = batch.column("id").take(pa.array(own))
                yield pa.RecordBatch.from_arrays([ids, pa.array(third.astype(np.int32)), words, *lists], ["id", "third", "word", "held", "asked"])

    return table.select("id", "word").mapInArrow(index, "id long, third int, word string, held array<long>, asked array<long>")


def _bigram_counts(table: DataFrame) -> np.ndarray:
    """How many words' bigrams fall into each of the ``SLOTS`` slots: a table of bounded size."""

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, _, points in _by_length(batch.column("word")):
                total += np.bincount(_slots(points).reshape(-1), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    rows = table.select("word").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.int64)
    for r in rows:
        counts[r.slot] = r.n
    return counts


def near_words(table: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
    """(a, b) of ids of ``table`` (id, word) whose words are exactly one edit apart, in both directions. Words have four code points or more."""
    indexed = cut(_indexed(table, _bigram_counts(table)), "indexed")
    side = ("id", "third", "word")
    held = indexed.select(*side, F.explode("held").alias("key"))
    crowd = held.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot)
    crowd = lookup_table(crowd.select("key", F.ceil(F.col("_n") / hot).cast("int").alias("parts")), "crowded")
    parts = F.coalesce("parts", F.lit(1))
    held = held.join(crowd, "key", "left").select("key", *side, F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    asked = indexed.select(F.explode("asked").alias("key"), *[F.col(c).alias(f"_{c}") for c in side])
    asked = asked.join(crowd, "key", "left").select("key", *[f"_{c}" for c in side], F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    near = F.levenshtein("word", "_word", 1) == 1  # unknown for words that aren't short
    may = (F.col("third") >= F.col("_third")) & (F.col("id") != F.col("_id")) & F.coalesce(near, F.lit(True))
    met = held.join(asked, ["key", "part"]).filter(may)
    met = cut(met.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"), near.isNotNull().alias("near")).distinct(), "met")
    named = lambda x: table.filter(F.length("word") >= SHORT).select(F.col("id").alias(x), F.col("word").alias(f"w{x}"))
    long = met.filter("not near").join(named("a"), "a").join(named("b"), "b").filter(F.levenshtein("wa", "wb", 1) == 1)
    near = cut(met.filter("near").select("a", "b").unionByName(long.select("a", "b")), "near-words")
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) for each row of ``forms`` (id, form): the end of the chain of forms."""
    roots = cut(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        moved = roots.join(step, F.col("root") == F.col("_id"), "left")
        further, n = cut_counted(moved.filter("_root is not null").select("id", F.col("_root").alias("root")), "further")
        if not n:
            return roots
        roots = cut(roots.join(further.select("id"), "id", "left_anti").unionByName(further), "roots")


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per row of ``words`` (word, n; each word once, four code points or more): word, form, root, n, n_near, form_n."""
    table = cut(words.select(words["word"].alias("word"), words["n"].alias("n")).withColumn("id", F.monotonically_increasing_id()), "words")
    other = table.select(F.col("id").alias("b"), F.struct((-F.col("n")).alias("less"), F.col("word"), F.col("id")).alias("best"))
    best = near_words(table).join(other, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    rows = cut(table.join(best, F.col("id") == F.col("a"), "left").drop("a"), "forms")
    leads = -F.col("best.less") >= ratio * F.col("n")
    roots = _roots(rows.filter(leads).select("id", F.col("best.id").alias("form")))
    roots = roots.join(table.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return rows.join(roots, "id", "left").select(
        "word",
        F.when(leads, F.col("best.word")).alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, -F.col("best.less")).alias("form_n"),
    )
