"""The parity join, spelling variants and fill-in-middle against plain versions, with nulls, long input, repeated rows and clashing columns."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ferrywright.llm import parity, rotation, variants

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = "text string, doc_id bigint, _id string, _n string, _text int, `a.b` int, key int, node int, word int, form int"


def table(spark, rows, partitions=5):
    return spark.createDataFrame([(t, i, "x", "y", 1, 2, 3, 4, 5, 6) for i, t in rows], NAMES).repartition(partitions)


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([" ".join(w)] if w else [])


def plain_links(rows, percent=90):
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(x)] = root(y)
    ids = defaultdict(list)
    for x, (i, _) in enumerate(sets):
        ids[root(x)] += [i] if i is not None else []
    return Counter((i, len(s), min(ids[root(x)], default=None) if s else i) for x, (i, s) in enumerate(sets))


def family(rng, base, n, most):
    """Texts that differ from ``base`` by one to ``most`` replaced words each."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(1, most)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def linked(df, **options):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in parity.link(df, **options).collect())


def test_parity_join_equals_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \t", "one", "One", "one two", "ONE TWO", "a b c", "A b  c", "x " * 400, "x " * 500, "a b c d e f g h i j k l", "a b c d e f g h i j k m"]
    for size, n, most in ((12, 12, 2), (30, 25, 2), (60, 40, 3), (150, 60, 9), (400, 40, 25), (1500, 12, 60)):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        texts += [" ".join(base), *family(rng, base, n, most)]
        step = base  # a chain whose ends are far from each other
        for k in range(8):
            step = [f"c{k}", *step[: -max(1, size // 40)]]
            texts.append(" ".join(step))
    texts += [texts[20]] * 3
    rows = list(enumerate(texts)) + [(7, texts[30]), (7, texts[30]), (None, texts[31]), (None, "alone by itself"), (None, None)]
    rng.shuffle(rows)
    assert linked(table(spark, rows)) == plain_links(rows)


def test_parity_join_without_a_hub(spark):
    """Many nodes share a part, none of them is near the hub, and links are between some of them only."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for k in range(25):  # 25 groups of two or three, all about 0.8 from the common base
        own = list(base)
        own[k * 8 : k * 8 + 20] = [f"g{k}x{j}" for j in range(20)]
        texts += [" ".join(own), *family(rng, own, rng.randint(1, 2), 2)]
    rows = list(enumerate(texts))
    want = plain_links(rows)
    assert linked(table(spark, rows)) == want
    assert len({c for _, _, c in want}) > 10


def test_parity_join_other_thresholds_and_empty_tables(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    rows = list(enumerate(family(rng, base, 30, 8)))
    for percent in (70, 95):
        assert linked(table(spark, rows), percent=percent) == plain_links(rows, percent)
    assert parity.link(table(spark, [])).count() == 0
    assert linked(table(spark, [(1, None), (2, "")])) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})


def test_sketch_distance_never_exceeds_symmetric_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        both = rng.integers(0, 2**63, 80).astype(np.uint64)
        a, b = np.unique(both[:60]), np.unique(both[20:])
        words = []
        for x in (a, b):
            slot, bit, border = parity.places(np.zeros(len(x), int), x, np.array([7]))
            words.append(parity.sketch(slot, bit, int(border[-1])))
        distance = int(np.unpackbits((words[0] ^ words[1]).view(np.uint8)).sum())
        assert distance <= len(np.setxor1d(a, b))


def test_linked_sizes_lie_in_neighbouring_bands():
    first = parity.bands(90)
    band = np.searchsorted(first, np.arange(5000), side="right") - 1
    for a in range(1, 4000, 7):
        b = a * 100 // 90
        assert band[b] - band[a] <= 1
        assert parity.parts(first, band[b : b + 1], 90)[0][0] > (a + b) * 10 // 190


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_forms(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], [ord(c) for c in v]), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def grouped(spark, counts, **options):
    df = spark.createDataFrame([(1, n, w) for w, n in counts.items()], "id int, n bigint, word string").repartition(3)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.group(df, **options).collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(4)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 12)))
        counts[word] = rng.randint(3, 200)
        for _ in range(8):
            k, c = rng.randrange(len(word)), rng.choice("abcdeéÿ")
            near = rng.choice([word[:k] + word[k + 1 :], word[:k] + c + word[k:], word[:k] + c + word[k + 1 :], word[:k] + c + word[k + 2 :]])
            if len(near) >= 5:
                counts[near] = rng.choice([3, 3, 5, 50])
    counts |= {"aaaaa": 9, "aaaaaa": 9, "aaaaaaa": 40, "ababab": 4, "bababa": 4, "abababa": 8, "babababa": 3}
    long = "".join(rng.choice("xyz") for _ in range(64))
    counts |= {long: 5, long + "x": 11, long[1:]: 3, long + "xx": 30, "q" * 63 + "r": 4, "q" * 64 + "r": 9}
    assert grouped(spark, counts) == plain_forms(counts)


def test_crowded_keys_are_dealt_over_parts(spark):
    counts = {f"zz{a}{b}{c}" + d: 3 + len(d) for a in "abcd" for b in "abcd" for c in "abcd" for d in ("", "x")}
    df = spark.createDataFrame([(k, w) for k, w in enumerate(counts)], "id bigint, word string")
    few, many = (sorted(map(tuple, variants.near_words(df, hot=h).collect())) for h in (3, 10_000))
    assert few == many
    assert len(few) == sum(one_edit(a, b) for a in counts for b in counts)


def test_a_very_long_word(spark):
    long = "a" * 100_000
    rows = [(1, f"{long} {long} {long} {long}b {long}b {long}b"), (None, None), (2, ""), (2, "12 34")]
    got = variants.words(table(spark, rows))
    assert sorted((len(r.word), r.n) for r in got.collect()) == [(100_000, 3), (100_001, 3)]
    assert {(len(r.word), r.n_near, r.form) for r in variants.group(got).collect()} == {(100_000, 1, None), (100_001, 1, None)}


def test_words_and_damage(spark):
    import zlib

    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), " ".join(rng.choice(["Straße", "ÉTAT", "window's", "lower", "Upper", "x1yzzzz"]) for _ in range(30))) for _ in range(200)]
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 7 == 0 else run] += 1
    want = {(w, n) for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert {tuple(r) for r in variants.words(table(spark, rows), damage=7).select("word", "n").collect()} == want
    assert variants.group(variants.words(table(spark, []))).count() == 0


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(1)
    weight = rng.random(variants.SLOTS)
    rank = np.empty(variants.SLOTS, np.int64)
    rank[np.argsort(weight)] = np.arange(variants.SLOTS)
    slots = rng.integers(0, 40, (300, 9))
    prefix, pair, third = variants.pivotal(slots, rank, weight)
    for row, held, two, last in zip(slots, prefix, pair, third):
        assert last == sorted(rank[row])[2]
        mine = np.flatnonzero(held)
        assert set(mine) == {i for i in range(9) if rank[row[i]] <= last}
        cheapest = min(weight[row[i]] + weight[row[j]] for i in mine for j in mine if j - i >= 2)
        assert two[1] - two[0] >= 2 and held[two[0]] and held[two[1]]
        assert abs(weight[row[two[0]]] + weight[row[two[1]]] - cheapest) < 1e-12


LONG = "Ünï😀 " * 60_000
TEXTS = [None, "", "a", "ab", "has <P> inside", "x<S>y", "z<M>", "<", "<<P", "P>S>M>", "<P", "😀😀é", "tail <", "ab<S", LONG, "word " * 50_000]


def plain_parts(i, text):
    import hashlib

    text, x = text or "", hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h, n = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)], len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (i, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    spm = h[3] % 100 < 20
    return (i, n, "spm" if spm else "psm", a, b - a, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_equals_plain_cuts_and_restores(spark):
    rows = [(i, t) for k, t in enumerate(TEXTS) for i in range(20 * k, 20 * k + (3 if t and len(t) > 10_000 else 20))] + [(3, "ab"), (3, "ab"), (None, "no id here"), (None, "nor here")]
    got = rotation.restore(rotation.transform(table(spark, rows))).collect()
    want = [plain_parts(i, t) for i, t in rows]
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.restored) for r in got) == Counter((i, t or "") for i, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert rotation.restore(rotation.transform(table(spark, []))).count() == 0


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_rotations_at_every_cut(monkeypatch, block):
    monkeypatch.setattr(rotation, "BLOCK", block)
    text = "aé😀<S P<Mb"
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            p, m, s = text[:a], text[a:b], text[b:]
            for form, want in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
                assert rotation.rotate(text, a, b, form).decode() == want
                assert rotation.unrotate(want, form).decode() == text
    data = bytearray(range(200))
    rotation.reverse(data, 3, 190)
    assert bytes(data) == bytes([*range(3), *range(189, 2, -1), *range(190, 200)])
