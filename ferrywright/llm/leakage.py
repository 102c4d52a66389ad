"""Benchmark decontamination by templates.

Numbers, names (capitalised words inside a sentence) and units after numbers become typed placeholders; the rest is
lower-cased without marks. As names are told by letter case and marks, which copies may change, each text is searched in a
second form too, lower-cased before, in which names are words. Windows of the items' templates are joined by hash with every ``stride``-th window of the
documents' templates; window and stride are such that a common run of ``RUN`` tokens (or a whole item, if shorter) always
contains a joined window. For each item and shift between item and document the common runs are then measured token by
token, and the slots in them are compared: a re-parameterised question fills all slots of one value with one other value.

A document is contaminated by an item if a common run has at least ``RUN`` tokens, or all the item's, and either so many of
them in a row are the item's with all values, or at least ``LITERAL`` of them aren't slots and the slots of all runs at
that shift are consistent. Items of fewer than ``SHORTEST`` tokens are looked for as they are, all tokens in a row. Nulls in any text count
as empty. Rows repeating an id are judged together, so that they stay or go together; rows with null id are judged by their
text, and reported with null id. Very long texts are searched whole. Empty tables give empty results; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import BROADCAST_ROWS, cut, cut_counted, lookup_table

RUN = 13
SHORTEST = 5
LITERAL = 4
UNITS = "kilometers|kilograms|minutes|percent|seconds|dollars|meters|pounds|euros|grams|hours|miles|weeks|years|days|feet|kmh|mph|km|kg|cm|mm|mg|ml|lb|oz|ft|min|h|m|g|l|s"


def _marked(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """Columns ``keep`` with _m: tokens joined by single spaces, names and units marked by a leading control character.

    Steps that concern digits or marks are skipped in texts without any, which gives the same in less time.
    """
    name = F.regexp_replace(F.coalesce(text, F.lit("")), r"\p{Lu}(?<=[\p{Ll}\p{N},;:] \p{Lu})(?=\p{Ll})", "\u0001$0")
    out = docs.select(*keep, F.trim(F.regexp_replace(name, r"[^\p{L}\p{M}\p{N}\x01]+", " ")).alias("_m"))
    apart = F.regexp_replace("_m", r"\p{N}(?=\p{L})", "$0 ")
    units = F.regexp_replace(apart, rf"\p{{N}} (?=(?:{UNITS})(?: |$))", "$0\u0002")
    return out.withColumn("_m", F.when(F.col("_m").rlike(r"\p{N}"), units).otherwise(F.col("_m")))


def _forms(table: DataFrame, text: str) -> DataFrame:
    """Each row twice, by _form: ``text`` as it is, and lower-cased so that it has no names."""
    own = F.coalesce(text, F.lit(""))
    both = F.explode(F.array(F.struct(F.lit(0).alias("_form"), own.alias("_own")), F.struct(F.lit(1).alias("_form"), F.lower(own).alias("_own"))))
    return table.select("*", both.alias("_both")).select(*[c for c in table.columns if c != text], "_both.*")


def _template(marked: str) -> Column:
    m = F.col(marked)
    out = F.when(m.contains("\u0001") | m.contains("\u0002"), F.regexp_replace(m, r"([\x01\x02])[\p{L}\p{M}]+", "$1")).otherwise(m)
    return F.lower(F.when(m.rlike(r"\p{N}"), F.regexp_replace(out, r"\p{N}+", "0")).otherwise(out))


def _tokens(joined: Column) -> Column:
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, " "))


def _key(doc_id: Column, text: Column) -> Column:
    by_text = F.concat(F.lit("?"), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    return F.when(doc_id.isNull(), by_text).otherwise(F.concat(F.lit("="), doc_id.cast("string")))


def _keyed(docs: DataFrame) -> DataFrame:
    """_id, what rows are judged together by (the id, or the text where that is null), and _text."""
    return docs.select(_key(F.col("doc_id"), F.col("text")).alias("_id"), F.col("text").alias("_text"))


def _windows(tokens: Column, size: int, stride: int) -> Column:
    starts = F.when(F.size(tokens) >= size, F.sequence(F.lit(1), F.size(tokens) - (size - 1), F.lit(stride)))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(tokens, i, size)).alias("hash")))


def _short(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """The result's rows for items of fewer than ``SHORTEST`` tokens, if there are any: lower-cased, they are joined whole."""
    plain = lambda table, text, name: _marked(table.select(F.col(name), F.lower(text).alias("_own")), "_own", name).select(
        name, _tokens(F.regexp_replace("_m", "\u0002", "")).alias("_w")
    )
    items = plain(benchmark, "text", "item_id").filter(F.size("_w").between(1, SHORTEST - 1))
    items, rows = cut_counted(items.select("item_id", F.size("_w").alias("_n"), F.array_join("_w", " ").alias("_whole")), "short")
    sizes = sorted(r[0] for r in items.select("_n").distinct().collect())
    if not sizes:
        return None
    own = plain(docs, "_text", "_id")
    whole = lambda n: F.when(F.size("_w") >= n, F.transform(F.sequence(F.lit(1), F.size("_w") - (n - 1)), lambda i: F.array_join(F.slice("_w", i, n), " ")))
    every = F.array_distinct(F.flatten(F.array(*[F.coalesce(whole(n), F.array().cast("array<string>")) for n in sizes])))
    items = F.broadcast(items) if rows <= BROADCAST_ROWS else items
    found = own.select("_id", F.explode(every).alias("_whole")).join(items, "_whole")
    slots = F.size(F.filter(F.split("_whole", " "), lambda w: w.rlike(r"^\p{N}"))).cast("long")
    return found.select("_id", "item_id", F.col("_n").cast("long").alias("tokens"), F.col("_n").alias("item_tokens"), slots.alias("slots"), F.lit(True).alias("exact")).distinct()


def _items(benchmark: DataFrame) -> DataFrame:
    marked = _marked(_forms(benchmark.select("item_id", "text"), "text"), "_own", "item_id", "_form").withColumn("_t", _template("_m"))
    cut_up = marked.select("item_id", "_form", _tokens(F.col("_m")).alias("_raw"), _tokens(F.col("_t")).alias("_tpl"))
    return cut(cut_up.filter(F.size("_tpl") >= SHORTEST), "items")


def contaminated(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, tokens: longest common run, item_tokens, slots, exact: are all slots' values the item's)."""
    found = _contaminated(_keyed(docs.select("doc_id", "text")), benchmark, run)
    kind = docs.schema["doc_id"].dataType
    doc_id = F.when(F.col("_id").startswith("="), F.substring("_id", F.lit(2), F.length("_id"))).cast(kind)
    return found.select(doc_id.alias("doc_id"), *[c for c in found.columns if c != "_id"])


def _contaminated(docs: DataFrame, benchmark: DataFrame, run: int) -> DataFrame:
    items = _items(benchmark)
    shortest = items.agg(F.min(F.size("_tpl"))).first()[0] or run
    need = min(run, shortest)
    stride = max(1, (need - 1) // 2)
    size = need - stride + 1
    keys = items.select("item_id", "_form", F.explode(_windows(F.col("_tpl"), size, 1)).alias("_w")).select("item_id", "_form", F.col("_w.at").alias("_q"), F.col("_w.hash").alias("_hash"))
    keys = lookup_table(keys, "windows")
    own = _marked(_forms(docs, "_text"), "_own", "_id", "_form").select("_id", "_form", _template("_m").alias("_t")).withColumn("_tokens", _tokens(F.col("_t")))
    probes = own.select("_id", "_form", F.explode(_windows(F.col("_tokens"), size, stride)).alias("_w"))
    hits = probes.select("_id", "_form", F.col("_w.at").alias("_p"), F.col("_w.hash").alias("_hash")).join(keys, ["_hash", "_form"])
    places = cut(hits.select("_id", "_form", "item_id", (F.col("_p") - F.col("_q")).alias("_shift")).distinct(), "shifts")
    judged = _judged(docs, items, places, run)
    short = _short(docs, benchmark)
    return judged if short is None else judged.unionByName(short)


def _judged(docs: DataFrame, items: DataFrame, places: DataFrame, run: int) -> DataFrame:
    wanted = docs.join(places.select("_id").distinct(), "_id", "left_semi")
    forms = _forms(wanted.withColumn("_version", F.xxhash64("_text")), "_text")
    marked = _marked(forms, "_own", "_id", "_version", "_form").withColumn("_t", _template("_m"))
    cut_up = marked.select("_id", "_version", "_form", _tokens(F.col("_m")).alias("_draw"), _tokens(F.col("_t")).alias("_dtpl"))
    start, length = F.greatest(F.col("_shift") + 1, F.lit(1)), F.size("_tpl")
    aligned = (
        places.join(cut_up, ["_id", "_form"])
        .join(items, ["item_id", "_form"])
        .select("_id", "_version", "_form", "item_id", "_shift", "_tpl", "_raw", F.slice("_dtpl", start, length).alias("_there"), F.slice("_draw", start, length).alias("_draw"))
    )
    place = ["_id", "_version", "_form", "item_id", "_shift", "_n"]
    each = aligned.select(*place[:-1], length.alias("_n"), "_raw", "_there", "_draw", F.posexplode("_tpl").alias("_j", "_token"))
    at = F.col("_j") + F.least(F.col("_shift"), F.lit(0))
    same = each.filter((at >= 0) & (F.get("_there", at) == F.col("_token")))
    is_slot = F.substring("_token", 1, 1).isin("\u0001", "\u0002", "0")
    pair = F.when(is_slot, F.struct(F.lower(F.get("_raw", F.col("_j"))).alias("was"), F.lower(F.get("_draw", at)).alias("now")))
    same = same.select(*place, "_j", pair.alias("_pair")).distinct()
    number = lambda *by: F.col("_j") - F.row_number().over(Window.partitionBy(*place, *by).orderBy("_j"))
    same = same.withColumn("_alike", F.coalesce(F.col("_pair.was") == F.col("_pair.now"), F.lit(True)))
    same = same.withColumn("_run", number()).withColumn("_stretch", number("_alike"))
    # Of each run the stretches with all values equal and the tokens with another value, then the run.
    stretches = same.groupBy(*place, "_run", "_alike", "_stretch").agg(
        F.count(F.lit(1)).alias("_part"), F.count("_pair").alias("_slots"), F.collect_set("_pair").alias("_pairs")
    )
    runs = stretches.groupBy(*place, "_run").agg(
        F.sum("_part").alias("_length"), F.sum("_slots").alias("_slots"), F.max(F.when(F.col("_alike"), F.col("_part"))).alias("_alike"),
        F.array_distinct(F.flatten(F.collect_list("_pairs"))).alias("_pairs"),
    )
    runs = runs.filter(F.col("_length") >= F.least(F.lit(run), F.col("_n")))
    whole = runs.groupBy(*place).agg(
        F.max("_length").alias("_longest"),
        F.max("_alike").alias("_alike"),
        F.sum("_slots").alias("_slots"),
        F.sum(F.col("_length") - F.col("_slots")).alias("_literal"),
        F.array_distinct(F.flatten(F.collect_list("_pairs"))).alias("_pairs"),
    )
    consistent = F.size("_pairs") == F.size(F.array_distinct(F.transform("_pairs", lambda p: p["was"])))
    exact = F.forall("_pairs", lambda p: p["was"] == p["now"])
    verbatim = F.coalesce(F.col("_alike") >= F.least(F.lit(run), F.col("_n")), F.lit(False))
    good = whole.filter(verbatim | ((F.col("_literal") >= LITERAL) & consistent)).withColumn("_exact", exact)
    return good.groupBy("_id", "item_id").agg(
        F.max("_longest").alias("tokens"), F.max("_n").alias("item_tokens"), F.max("_slots").alias("slots"), F.max("_exact").alias("exact")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, by id or, where that is null, by text."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # columns of any name go by their places
    rows = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    keyed = _keyed(rows.select(doc_id.alias("doc_id"), text.alias("text")))
    found = lookup_table(_contaminated(keyed, benchmark, run).select(F.col("_id").alias("_found")).distinct(), "contaminated")
    out = rows.withColumn("_id", _key(doc_id, text)).join(found, F.col("_id") == F.col("_found"), "left_anti")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
