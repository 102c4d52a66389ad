"""Personal data replaced by surrogates of the same kind.

Mail addresses, phone, card and social security numbers, IBANs, IP addresses and persons after a title are replaced. A
surrogate is a keyed function of the kind and the canonical value, so one entity has one surrogate everywhere, however it
is written; layout, letter case of names, script and, by title, gender stay. Distinct entities keep distinct surrogates:
all entities of all texts are collected and those whose surrogate is another's, or is somebody's real value, are
keyed anew until none is left. Names and numbers grow with each such attempt, so there are always enough.

Within a text, a person's full name without title, and the surname alone, count as that person from then on or before; a surname
that two persons of a text share goes by the first of their full names.

Null texts stay null. Repeated rows get equal results. Very long texts and words are searched whole, in time that goes with their
length. Empty tables give empty results; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import cut, lookup_table

_NAME = r"\p{Lu}[\p{Ll}']+(?:-\p{Lu}\p{Ll}+)?"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Господин"
NEUTRAL = "Dr|Prof"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "person": rf"(?<!\p{{L}})(?:{FEMALE}|{MALE}|{NEUTRAL})\.? {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MENTION = rf"{ANY}|(?<!\p{{L}}){_NAME}(?!\p{{L}})"
HINT = rf"\d|@|(?:{FEMALE}|{MALE}|{NEUTRAL})\.? "
FIRST = {
    "female": "Anna Clara Elena Eva Irene Julia Laura Lea Maria Marta Nina Nora Olivia Paula Rosa Sara Sofia Vera".split(),
    "male": "Adam Bruno Carl David Emil Felix Hugo Jan Leo Lukas Marco Martin Oscar Paul Peter Simon Tomas Victor".split(),
    "neutral": "Alex Andrea Charlie Chris Dana Jamie Jo Jules Kim Lou Max Nico Noa Robin Sam Sascha Toni Yael".split(),
}
FIRST_CYRILLIC = {
    "female": "Анна Вера Елена Ирина Мария Нина Ольга Софья".split(),
    "male": "Андрей Борис Виктор Иван Лев Олег Павел Юрий".split(),
    "neutral": "Саша Женя Валя Слава".split(),
}
SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu na ne ni no nu ra re ri ro ru sa se si so su ta te ti to tu".split()
SYLLABLES_CYRILLIC = "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то".split()


def kind_of(value: Column) -> Column:
    out = F.lit("person")
    for kind in ("iban", "card", "phone", "ssn", "ip", "email"):
        out = F.when(value.rlike(rf"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def canonical(kind: Column, value: Column) -> Column:
    """What makes two spellings the same entity."""
    person = F.trim(F.regexp_replace(value, rf"^(?:{FEMALE}|{MALE}|{NEUTRAL})\.? ", ""))
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind == "ip", value)
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "person", person)
        .otherwise(F.regexp_replace(value, r"[^0-9]", ""))
    )


def _number(digest: Column, at: Column | int, n: int, below: int) -> Column:
    """A number below ``below`` from ``n`` hexadecimal digits of a digest."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.pmod(F.conv(digest.substr(F.pmod(at, F.lit(60)) + 1, F.lit(n)), 16, 10).cast("long"), F.lit(below)).cast("int")


def _like(value: Column, digest: Column, keep: Column) -> Column:
    """``value`` with each digit and letter after the first ``keep`` characters replaced by one of its kind."""

    def swap(c, i):
        at = i * 3
        return (
            F.when(i < keep, c)
            .when(c.rlike("[0-9]"), _number(digest, at, 4, 10).cast("string"))
            .when(c.rlike("[A-Z]"), F.char(_number(digest, at, 4, 26) + 65))
            .when(c.rlike("[a-z]"), F.char(_number(digest, at, 4, 26) + 97))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), swap), "")


def _pick(words: list[str], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), _number(digest, at, 4, len(words)) + 1)


def _grown(words: list[str], digest: Column, attempt: Column) -> Column:
    """A word more for each attempt."""
    each = F.transform(F.sequence(F.lit(1), attempt), lambda i: F.element_at(F.array(*map(F.lit, words)), _number(digest, i * 5 + 30, 4, len(words)) + 1))
    return F.when(attempt > 0, F.array_join(each, "")).otherwise("")


def _gendered(names: dict[str, list[str]], gender: Column, digest: Column) -> Column:
    pick = lambda g: _pick(names[g], digest, 0)
    return F.when(gender == "female", pick("female")).when(gender == "male", pick("male")).otherwise(pick("neutral"))


def _person(canon: Column, gender: Column, digest: Column, attempt: Column) -> Column:
    cyrillic = canon.rlike(r"\p{IsCyrillic}")
    more = lambda words: _grown(words, digest, attempt)
    latin_last = F.initcap(F.concat(*[_pick(SYLLABLES, digest, at) for at in (8, 14, 20, 26)], more(SYLLABLES), F.lit("n")))
    stem = F.initcap(F.concat(*[_pick(SYLLABLES_CYRILLIC, digest, at) for at in (8, 14, 20, 26)], more(SYLLABLES_CYRILLIC)))
    cyrillic_last = F.concat(stem, F.when(gender == "female", "нова").otherwise("нов"))
    last = F.when(cyrillic, cyrillic_last).otherwise(latin_last)
    first = F.when(cyrillic, _gendered(FIRST_CYRILLIC, gender, digest)).otherwise(_gendered(FIRST, gender, digest))
    return F.when(canon.contains(" "), F.concat(first, F.lit(" "), last)).otherwise(last)


def canonical_surrogate(kind: Column, canon: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The surrogate of a canonical value, itself canonical."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 256)
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index(canon, "@", -1)), 256)
    local = _like(F.substring_index(canon, "@", 1), digest, F.lit(0))
    email = F.concat(local, F.lit("."), digest.substr(57, 6), F.lit("@d"), domain.substr(1, 10), F.lit(".example"))
    ip = F.concat_ws(".", *[(_number(digest, at, 4, 254) + 1).cast("string") for at in (0, 4, 8, 12)])
    iban = F.concat(canon.substr(1, 2), _like(canon.substr(F.lit(3), F.length(canon)), digest, F.lit(0)))
    numbers = _like(canon, digest, F.when(kind.isin("phone", "card"), 1).otherwise(0))
    # Numbers of one length can be used up: from the third attempt on they are longer.
    numbers = F.concat(numbers, _grown(list("0123456789"), digest, F.greatest(attempt - 2, F.lit(0))))
    iban = F.concat(iban, _grown(list("0123456789"), digest, F.greatest(attempt - 2, F.lit(0))))
    body = numbers.substr(F.lit(1), F.length(numbers) - 1)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "iban", iban)
        .when(kind == "person", _person(canon, gender, digest, attempt))
        .when(kind == "card", F.concat(body, _luhn_digit(body)))
        .otherwise(numbers)
    )


def _luhn_digit(body: Column) -> Column:
    """The digit that makes a card number valid."""
    digits = F.transform(F.reverse(F.split(body, "")), lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10))
    return F.pmod(-F.aggregate(digits, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")), F.lit(10)).cast("string")


def _written(kind: Column, value: Column, canon: Column) -> Column:
    """A canonical surrogate in the layout of ``value``."""
    title = F.regexp_extract(value, rf"^((?:{FEMALE}|{MALE}|{NEUTRAL})\.? )", 1)
    rest = lambda keep: canon.substr(F.length(F.regexp_replace(value, f"[^{keep[1:-1]}]", "")) + 1, F.length(canon))
    into = lambda keep: F.concat(F.array_join(
        F.transform(
            F.split(value, ""),
            lambda c, i: F.when(c.rlike(keep), canon.substr(F.length(F.regexp_replace(value.substr(F.lit(1), i + 1), f"[^{keep[1:-1]}]", "")), F.lit(1))).otherwise(c),
        ),
        "",
    ), rest(keep))
    return F.when(kind.isin("email", "ip"), canon).when(kind == "person", F.concat(title, canon)).when(kind == "iban", into("[A-Z0-9]")).otherwise(into("[0-9]"))


def _gender(value: Column) -> Column:
    by = lambda titles: value.rlike(rf"^(?:{titles})\.? ")
    return F.when(by(FEMALE), "female").when(by(MALE), "male").otherwise("neutral")


def _found(docs: DataFrame) -> DataFrame:
    """Per row with entities, stored: _id, _version and the texts of its entities in order."""
    own = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_version"), F.col("text").alias("_text"))
    some = own.filter(F.col("_text").rlike(HINT)).select("_id", "_version", F.regexp_extract_all("_text", F.lit(ANY), F.lit(0)).alias("_values"))
    return cut(some.filter(F.size("_values") > 0), "found")


def _entities(found: DataFrame) -> DataFrame:
    """Distinct entities: kind, canon, gender."""
    values = found.select(F.explode("_values").alias("_value")).distinct()
    kinds = values.withColumn("kind", kind_of(F.col("_value")))
    return kinds.groupBy("kind", canonical(F.col("kind"), F.col("_value")).alias("canon")).agg(F.min(_gender(F.col("_value"))).alias("gender"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, gender, attempt, surrogate), with distinct surrogates that are nobody's value, stored."""
    made = lambda df: df.withColumn("surrogate", canonical_surrogate(F.col("kind"), F.col("canon"), F.col("gender"), key, F.col("attempt")))
    table = cut(made(entities.withColumn("attempt", F.lit(0))), "entities")
    real = table.select(F.col("kind").alias("_k"), F.col("canon").alias("_real"))
    while True:
        first = table.groupBy(F.col("kind").alias("_kind"), F.col("surrogate").alias("_s")).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("attempt", "canon")).alias("_first"))
        clash = first.filter("_n > 1").select("_kind", "_s", F.col("_first.canon").alias("_keeps"))
        taken = table.join(clash, (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_s"))).filter("canon != _keeps").select("kind", "canon")
        own = table.join(real, (F.col("kind") == F.col("_k")) & (F.col("surrogate") == F.col("_real"))).select("kind", "canon")
        again = cut(taken.union(own).distinct(), "clashes")
        if again.isEmpty():
            return table
        hit = again.select(F.col("kind").alias("_k"), F.col("canon").alias("_c"))
        moved = table.join(hit, (F.col("kind") == F.col("_k")) & (F.col("canon") == F.col("_c")), "left")
        table = cut(made(moved.select("kind", "canon", "gender", (F.col("attempt") + F.col("_k").isNotNull().cast("int")).alias("attempt"))), "entities")


def _mentions(told: DataFrame) -> DataFrame:
    """Per text of ``told`` (_id, _version, _value, kind, _canon, surrogate): further names of its persons and what they become.

    ``_full`` has each full name; ``_last`` each surname that isn't itself the name of a person of the text.
    """
    persons = told.filter("kind = 'person'").select("_id", "_version", "_canon", "surrogate").distinct()
    both = F.col("_canon").contains(" ")
    last = F.struct(F.substring_index("_canon", " ", -1).alias("name"), (~both).cast("int").alias("alone"), F.col("_canon").alias("of"), F.substring_index("surrogate", " ", -1).alias("to"))
    names = F.array_sort(F.collect_set(last))
    grouped = persons.groupBy(F.col("_id").alias("_i"), F.col("_version").alias("_v")).agg(
        F.map_from_entries(F.collect_set(F.when(both, F.struct("_canon", "surrogate")))).alias("_full"), names.alias("_names")
    )
    # Of equal surnames, a person called by it alone comes first, then the first full name.
    ranked = F.array_sort("_names", lambda x, y: F.when(x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).when(x["alone"] != y["alone"], y["alone"] - x["alone"]).when(x["of"] < y["of"], -1).otherwise(1))
    first = F.filter(ranked, lambda x, i: (i == 0) | (F.get(ranked, i - 1)["name"] != x["name"]))
    return grouped.select("_i", "_v", "_full", F.map_from_entries(F.transform(first, lambda x: F.struct(x["name"], x["to"]))).alias("_last"))


def replace(docs: DataFrame, key: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_entities, text with surrogates."""
    found = _found(docs)
    table = assign(_entities(found), key)
    value, kind = F.col("_value"), F.col("kind")
    each = found.select("_id", "_version", F.explode(F.array_distinct("_values")).alias("_value")).distinct().withColumn("kind", kind_of(value))
    each = each.withColumn("_canon", canonical(kind, value))
    names = lookup_table(table.select(F.col("kind").alias("_k"), F.col("canon").alias("_c"), "surrogate"), "surrogates")
    told = cut(each.join(names, (kind == F.col("_k")) & (F.col("_canon") == F.col("_c"))), "told")
    new = F.struct("_value", _written(kind, value, F.col("surrogate")).alias("_new"))
    maps = told.groupBy(F.col("_id").alias("_i"), F.col("_version").alias("_v")).agg(F.map_from_entries(F.collect_set(new)).alias("_map"))
    others = _mentions(told).withColumnsRenamed({"_i": "_i2", "_v": "_v2"})
    maps = maps.join(others, F.col("_i").eqNullSafe(F.col("_i2")) & (F.col("_v") == F.col("_v2")), "left").drop("_i2", "_v2")
    maps = lookup_table(maps, "maps")  # by broadcast if few: no text travels

    own = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_version"), F.col("text").alias("_text"))
    both = own.join(maps, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_version") == F.col("_v")), "left")
    busy, named = F.col("_map").isNotNull(), F.col("_last").isNotNull()
    by = lambda cut_up: F.when(busy & named, cut_up(MENTION)).when(busy, cut_up(ANY))  # noqa: E731  texts without entities aren't searched again
    values, pieces = by(lambda p: F.regexp_extract_all("_text", F.lit(p), F.lit(0))), by(lambda p: F.split("_text", p, -1))
    rows = both.select("_id", "_text", "_map", "_full", "_last", values.alias("_values"), pieces.alias("_pieces"))
    at = lambda i: F.get("_values", i)
    pair = lambda i: F.when(F.get("_pieces", i + 1) == " ", F.element_at("_full", F.concat_ws(" ", at(i), at(i + 1))))

    def renamed(v, i):
        as_first = F.substring_index(pair(i), " ", 1)
        as_last = F.when(i > 0, F.substring_index(pair(i - 1), " ", -1))
        return F.coalesce(F.element_at("_map", v), F.when(F.col("_last").isNotNull(), F.coalesce(as_first, as_last, F.element_at("_last", v))))

    told = rows.withColumn("_new", F.transform("_values", renamed))
    changed = F.array_join(F.zip_with("_pieces", F.zip_with("_values", "_new", lambda v, n: F.coalesce(n, v)), lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    ends = lambda v, i: (i > 0) & F.element_at("_map", v).isNull() & pair(i - 1).isNotNull()  # noqa: E731  the surname of a full name
    found = F.filter("_values", lambda v, i: F.get("_new", i).isNotNull() & ~F.coalesce(F.col("_last").isNotNull() & ends(v, i), F.lit(False)))
    count = F.when(busy, F.size(found)).otherwise(0).cast("long")
    return told.select(F.col("_id").alias("doc_id"), count.alias("n_entities"), F.when(busy, changed).otherwise(F.col("_text")).alias("text"))
