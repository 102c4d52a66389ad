"""Secret findings with a random forest that removes false positives.

A candidate is a word of at least ``SHORTEST`` characters with a digit or after a credential word, taken without quotes,
closing marks and a leading ``name=``. Its features are its length, transitions between kinds of characters, how much of it dictionary words
cover, signs of a path or address, and the words next to it. The forest is trained on labelled findings.

Null texts have no candidates. Each occurrence is a finding of its own, so repeated rows repeat findings. If the labelled
findings have one label value, each score is 1 or 0 accordingly; if there are none, 0. The sample keeps a rare label whole up to half of it. Empty tables give empty results;
other columns may have any name. Very long texts and words are searched whole, in time that goes with their length.

Words under ``SHORTEST`` characters, keys that go over several lines, and words without a digit that no credential word precedes are no candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import cut, lookup_table, scratch_path

SHORTEST = 8
SAMPLE = 50_000
TREES, DEPTH = 20, 6
CREDENTIAL = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?-?key|access_?-?key|auth|credential)s?"
EXAMPLE = r"(?i)(?:example|sample|dummy|placeholder|changeme|xxxx|test)"
ISSUED = (
    r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|github_pat_\w{20,}|glpat-[\w-]{16,}|xox[abeprs]-[0-9A-Za-z-]{10,}|npm_[0-9A-Za-z]{30,}"
    r"|[sr]k_(?:live|test)_[0-9A-Za-z]{16,}|sk-[\w-]{20,}|AIza[\w-]{35}|SG\.[\w-]{16,}\.[\w-]{16,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*)$"
)
GIVEN = CREDENTIAL + r"\W*(?:(?:bearer|basic|is|was)\W*)?$"
HARMLESS = (
    r"^(?:[\d.,:/+-]+(?:th|st|nd|rd|[ap]m|Z|%)?|\p{Sc}[\d.,]+|[\w.+-]++@[\w-]++(?:\.[\w-]++)++|\d{4}-\d\d-\d\dT[\d:.+-]+Z?"
    r"|(?:[a-z]+://|www\.)[^@\s]+|\.{0,2}/[\w./-]+|\p{L}+-?\d{1,4})$"
)
WORD_SHARE = 1e-5
FEATURES = [
    "length", "transitions", "distinct", "digits", "uppers", "others", "hexadecimal", "covered", "slashes", "dots", "at_sign",
    "named", "credential_near", "example_near", "word_before", "word_after",
]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, position (of the word in its text, from 0), value, name, before, after."""
    own = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).filter(F.col("_text").rlike(r"\d") | F.col("_text").rlike(CREDENTIAL))
    words = own.select("_id", F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_w"))
    numbered = words.select("_id", "_w", F.transform("_w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))).alias("_all"))
    given = lambda x: x["w"].rlike(rf"{CREDENTIAL}[=:]") | F.array_join(F.slice("_w", F.greatest(x["i"] - 1, F.lit(1)), F.least(x["i"], F.lit(2))), " ").rlike(GIVEN)
    likely = F.filter("_all", lambda x: (F.length(x["w"]) >= SHORTEST) & (x["w"].rlike(r"\d") | given(x)))
    # The three words before and the two after are all that travels on.
    near = F.transform(
        likely,
        lambda x: F.struct(
            x["i"].alias("position"),
            x["w"].alias("word"),
            F.array_join(F.slice("_w", F.greatest(x["i"] - 2, F.lit(1)), F.least(x["i"], F.lit(3))), " ").alias("before"),
            F.array_join(F.slice("_w", x["i"] + 2, F.lit(2)), " ").alias("after"),
        ),
    )
    rows = numbered.select(F.col("_id").alias("doc_id"), F.explode(near).alias("_c")).select("doc_id", "_c.*")
    name = F.regexp_extract("word", r"^([\p{L}_.-]{2,40})[=:](?!//)", 1)
    value = F.regexp_replace(F.regexp_replace("word", r"^(?:[\p{L}_.-]{2,40}[=:](?!//))?[\"'(\[<]*", ""), r"(?<![\"')\]>.,;!?#$%&*])[\"')\]>.,;!?#$%&*]++$", "")
    rows = rows.select("doc_id", "position", value.alias("value"), name.alias("name"), "before", "after")
    return rows.filter((F.length("value") >= SHORTEST) & (F.col("value").rlike(r"\d") | F.concat_ws(" ", "before", "name").rlike(GIVEN)))


def frequent_words(docs: DataFrame) -> DataFrame:
    """word: those of letters only with at least ``WORD_SHARE`` of the texts' words, so a bounded number, that occur five times."""
    each = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<!\S)(\p{L}{3,})[.,;:!?]*(?!\S)"), F.lit(1))).alias("word"))
    counts = cut(each.groupBy("word").count(), "words")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.filter(F.col("count") >= max(WORD_SHARE * total, 5)).select("word")


def evidence(found: DataFrame) -> Column:
    """A label for ``described`` findings: 1 by issuer's format or a credential word right before, 0 by a harmless format or examples, else null."""
    value, near = F.col("value"), F.concat_ws(" ", "before", "name")
    bare = value.rlike("^[0-9A-Za-z+/_-]{12,}$") & (value.rlike(r"\d") | ((F.col("covered") < 0.5) & ((F.col("name") != "") | near.rlike(r"[:=]\W*$"))))
    harmless = value.rlike(HARMLESS) | (F.col("example_near") > 0) | (F.col("covered") >= 0.8)
    return F.when(value.rlike(ISSUED), 1).when(near.rlike(GIVEN) & bare, 1).when(harmless, 0)


def _count(column: Column, pattern: str) -> Column:
    return F.regexp_count(column, F.lit(pattern)).cast("double")


def described(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``candidates`` with the features; ``dictionary`` has column word."""
    value = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"\p{Lu}", "A"), r"\p{Ll}", "a"), r"\p{N}", "0"), "[^Aa0]", ".")
    parts = F.array_distinct(F.regexp_extract_all(F.lower(value), F.lit(r"(\p{L}{3,})"), F.lit(1)))
    words = lookup_table(dictionary.select(F.lower("word").alias("_word")).filter(F.col("_word").rlike(r"^\p{L}{3,}$")).distinct(), "dictionary")
    pieces = found.select("value").distinct().select("value", F.explode(parts).alias("_part"))
    covered = pieces.join(words, F.col("_part") == F.col("_word"), "left_semi").groupBy("value").agg(F.sum(F.length("_part")).alias("_covered"))
    rows = found.join(covered.withColumnRenamed("value", "_value"), value == F.col("_value"), "left")
    near = F.concat_ws(" ", "before", "name")
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    length = F.length(value).cast("double")
    return rows.withColumns(
        {
            "length": length,
            "transitions": F.length(F.regexp_replace(kinds, r"(.)\1*", "x")).cast("double") - 1,
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / length,
            "digits": _count(value, r"\p{N}") / length,
            "uppers": _count(value, r"\p{Lu}") / length,
            "others": _count(value, r"[^\p{L}\p{N}]") / length,
            "hexadecimal": flag(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
            "covered": F.least(F.coalesce("_covered", F.lit(0)) / length, F.lit(1.0)),
            "slashes": _count(value, "[/\\\\]"),
            "dots": _count(value, r"\."),
            "at_sign": flag(value.contains("@")),
            "named": flag(F.col("name") != ""),
            "credential_near": flag(near.rlike(CREDENTIAL)),
            "example_near": flag(F.concat_ws(" ", near, "value", "after").rlike(EXAMPLE)),
            "word_before": F.length(F.substring_index("before", " ", -1)).cast("double"),
            "word_after": F.length(F.substring_index("after", " ", 1)).cast("double"),
        }
    ).drop("_value", "_covered")


def train(labelled: DataFrame, sample: int = SAMPLE, seed: int = 5):
    """A forest from described findings with ``label`` (0 or 1; nulls aren't learned), or the one label there is."""
    from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = labelled.filter("label is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return float(max(sizes, default=0))
    # The rarer label first: what it leaves of the bound is the other's.
    rare, other = sorted(sizes, key=sizes.get)
    room = min(sizes[rare], sample // 2)
    share = F.when(F.col("label") == rare, room / sizes[rare]).otherwise(min(1.0, (sample - room) / sizes[other]))
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id", "position", "value"), F.lit(1 << 30)) < share * F.lit(1 << 30))
    # Fitting reads its input several times: the sample is stored, so that the texts are searched once for it.
    drawn = cut(drawn.select(F.col("label").cast("double").alias("label"), *FEATURES), "sample")
    left = [r[0] for r in drawn.select("label").distinct().collect()]
    if len(left) < 2:  # the draw is by hash: few distinct findings, much repeated, can all be in or out
        return float(left[0] if left else rare)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(drawn)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, labelCol="label")
    path = scratch_path(rows.sparkSession, "forest")
    forest.fit(vectors.select("label", "features")).save(path)
    return RandomForestClassificationModel.load(path)  # without the training summary, which tasks can't be sent


def score(found: DataFrame, model) -> DataFrame:
    """``described`` findings with score, the forest's share of votes for a secret, and is_secret."""
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
        scored = out.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*[F.col(c) for c in found.columns], "score", (F.col("score") >= 0.5).alias("is_secret"))
