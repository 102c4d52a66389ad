"""Very long texts and words, null and repeated ids, clashing column names, later mentions of persons."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ferrywright.llm import exact, langid, leakage, mixing, near, secret_scan, surrogates

ODD = "doc_id bigint, text string, lang string, source string, _words int, _copies int, _size string, _source string, _key string, _found int, `a.b` int, _c0 int, _node string, _id string"


def odd(spark, rows):
    """``rows`` (doc_id, text) among columns whose names operators might use themselves."""
    full = [(i, t, "en", "s1", 60, 61, "big", "far", "k", 9, 4, 5, "n", "x") for i, t in rows]
    return spark.createDataFrame(full, ODD).repartition(3)


def extras(df):
    return {tuple(r[c] for c in ("_words", "_copies", "_size", "_source", "_key", "_found", "a.b", "_c0", "_node", "_id")) for r in df.collect()}


KEPT = {(60, 61, "big", "far", "k", 9, 4, 5, "n", "x")}
ITEM = "seven brown foxes jump over nine lazy dogs near the old river bank at noon"


def test_user_columns_stay_as_they_are(spark):
    words = " ".join(f"w{i}" for i in range(60))
    df = odd(spark, [(1, words), (2, words), (3, words + " more"), (4, f"so {ITEM} then"), (None, None), (5, "")])
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    net = langid.train(df, F.lit(True))
    for out in (mixing.mix(df), near.deduplicate(df), exact.deduplicate(df), leakage.decontaminate(df, bench)):
        assert out.columns[: len(df.columns)] == df.columns
        assert extras(out) == KEPT
    assert langid.predict(df, net, tuple(df.columns)).columns[: len(df.columns)] == df.columns
    assert extras(langid.predict(df, net, tuple(df.columns))) == KEPT
    assert sorted(r.doc_id for r in near.deduplicate(df).filter("doc_id < 4").collect()) == [1]
    assert sorted(r.doc_id for r in exact.deduplicate(df).filter("doc_id < 4").collect()) == [2, 3]


def test_rows_without_id_are_searched(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "two plus two")], "item_id bigint, text string")
    rows = [(None, f"see: {ITEM}."), (None, "clean text of some words"), (None, None), (7, ITEM.upper()), (8, "clean"), (None, "say two plus two now")]
    found = leakage.contaminated(odd(spark, rows), bench)
    assert Counter((r.doc_id, r.item_id) for r in found.collect()) == Counter([(None, 1), (7, 1), (None, 2)])
    left = leakage.decontaminate(odd(spark, rows), bench)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([rows[1], rows[2], rows[4]])


def test_repeated_rows_and_ids(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    rows = [(1, ITEM), (1, "other text"), (2, "fine"), (2, "fine")]
    assert sorted(r.doc_id for r in leakage.decontaminate(odd(spark, rows), bench).collect()) == [2, 2]
    replaced = surrogates.replace(odd(spark, [(1, "mail a@b.org"), (1, "mail a@b.org"), (1, "no"), (None, "mail a@b.org")]), "k").collect()
    assert Counter(r.n_entities for r in replaced) == Counter({1: 3, 0: 1})
    assert len({r.text for r in replaced}) == 2


DOTS = "x@" + "a." * 10_000 + "b"
HEX = "0123456789abcdef" * 62_500


@pytest.mark.parametrize("text", [DOTS, HEX, "password: " + HEX, "." * 200_000 + "x1", "A" * 300_000, "-7" * 100_000, "Dr. " * 50_000])
def test_long_words_take_time_in_proportion(spark, text):
    df = odd(spark, [(1, text), (2, f"{text} tail"), (3, "call 555-123-4567")])
    got = {r.doc_id: r for r in surrogates.replace(df, "key").collect()}
    assert got[3].n_entities == 1 and len(got) == 3
    found = secret_scan.candidates(df)
    described = secret_scan.described(found, spark.createDataFrame([("word",)], "word string"))
    described.withColumn("label", secret_scan.evidence(described)).collect()


def test_more_entities_than_surrogates_of_their_length(spark):
    numbers = [("phone", str(n), "neutral") for n in range(100, 400)]
    names = [("person", f"Имя{n}", "male") for n in range(50)]
    table = surrogates.assign(spark.createDataFrame(numbers + names, "kind string, canon string, gender string"), "key").collect()
    assert len({(r.kind, r.surrogate) for r in table}) == 350
    assert not {(r.kind, r.surrogate) for r in table} & {(r.kind, r.canon) for r in table}


def test_later_mentions_of_a_person(spark):
    text = "Dr. Anna Lee signed. Anna Lee then left; Lee agreed, unlike Leeds. Mr. Tom Lee and Frau Berg came, Berg first. Anna stayed."
    r = surrogates.replace(odd(spark, [(1, text), (2, "Lee and Berg are no persons here, nor is Anna Lee"), (3, "Mrs. Anna Lee")]), "key").collect()
    got = {x.doc_id: x for x in r}
    out = got[1].text
    assert got[2].text.startswith("Lee and Berg") and got[2].n_entities == 0
    assert "Leeds" in out and "Anna stayed" in out
    assert "Anna Lee" not in out and " Lee " not in out and "Berg" not in out
    full = out[len("Dr. ") : out.index(" signed")]
    assert f"{full} then left; {full.split(' ')[1]} agreed" in out
    assert got[3].text == f"Mrs. {full}"  # one entity, one surrogate
    assert got[1].n_entities == 6


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    """Each stage on what the one before kept, compared with a literal version of its decision."""
    words = [f"word{i}" for i in range(80)]
    english = "the weather is fine and the people of this town are happy with what they have "
    german = "das wetter ist gut und die leute in dieser stadt sind froh mit dem was sie haben "
    texts = [english * 3 + " ".join(words[k : k + 12]) for k in range(0, 60, 12)] + [german * 3 + " ".join(words[k : k + 12]) for k in range(0, 60, 12)]
    near_copy = " ".join(words * 2)
    rows = [(i, t, "de" if "wetter" in t else "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(20, texts[0], "en", "s1"), (21, near_copy + " a b c", "en", "s1"), (22, near_copy + " d e f", "en", "s2"), (23, english + ITEM, "en", "s1")]
    rows += [(24, "12345 67890", None, "s1"), (25, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, ids = docs, None
    for name, stage in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = stage(spark, kept, str(tmp_path)).cache()
        ids = Counter(r.doc_id for r in kept.collect())
        if name == "language":
            want = {r.doc_id for r in before if r.text and any(c.isalpha() for c in r.text)}
            assert set(ids) <= want and {24, 25}.isdisjoint(ids) and len(want - set(ids)) <= 3
        elif name == "exact_copies":
            best = {}
            for r in before:
                best[r.text] = max(best.get(r.text, -1), r.doc_id)
            assert set(ids) == set(best.values())
        elif name == "near_copies":
            def shingles(t):
                w = t.lower().split()
                return Counter(" ".join(w[i : i + 5]) for i in range(len(w) - 4))

            def alike(a, b):  # probability Jaccard, literally
                return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in a | b) for x in a & b)

            sets = {r.doc_id: shingles(r.text) for r in before}
            dropped = {i for i in sets for j in sets if j < i and alike(sets[i], sets[j]) >= 0.8}  # classes are pairs here
            assert set(ids) == set(sets) - dropped
        elif name == "benchmark_leaks":
            assert set(ids) == {r.doc_id for r in before if ITEM not in r.text}
        else:
            sizes = Counter()
            for r in before:
                sizes[r.source] += len(r.text.split())
            want = {r.doc_id: r.copies for r in mixing.report(spark.createDataFrame(before)).collect()}
            assert ids == Counter({i: n for i, n in want.items() if n})
            assert all(n <= 4 for n in ids.values()) and sum(sizes.values()) > 0
