"""Registered queries of the pipeline operators, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut
from ..session import ship_package
from . import exact, katz, langid, leakage, mixing, near, parity, passages, quality, rotation, secret_scan, surrogates, variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id, n: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op1_secrets(spark, sf_dir):
    """The tables have no labelled findings: formats label those that give evidence in the documents whose remainder by 5 isn't 1."""
    docs = table(spark, sf_dir, "documents")
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", r"[^\p{L}]+")).alias("word"))
    found = cut(secret_scan.candidates(docs), "candidates")  # stored, as is what describes them: texts are searched once
    found = cut(secret_scan.described(found, words.unionByName(secret_scan.frequent_words(docs))), "findings")
    labelled = found.filter(remainder(F.col("doc_id"), 5) != 1).withColumn("label", secret_scan.evidence(found))
    out = secret_scan.score(found, secret_scan.train(labelled))
    held = (remainder(F.col("doc_id"), 5) == 1).alias("held_out")
    return out.select("doc_id", "position", "value", held, "score", "is_secret")


def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    measured = quality.measured(docs)
    model = quality.train(measured, table(spark, sf_dir, "labels"), "quality", remainder(F.col("_id"), 3) != 1)
    held = (remainder(F.col("doc_id"), 3) == 1).alias("held_out")
    return quality.score(measured, model).select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_katz(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 5) == 1
    model = katz.Model(docs.filter(~held).select(F.col("text").alias("_text")))
    out = katz.score(docs, model)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op4_exact_dedup(spark, sf_dir):
    return exact.classify(table(spark, sf_dir, "documents"))


def op5_decontamination(spark, sf_dir):
    return leakage.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_passages(spark, sf_dir):
    out = passages.remove(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op7_surrogates(spark, sf_dir):
    return surrogates.replace(table(spark, sf_dir, "documents"), key="registered query")


def op8_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs, remainder(F.col("doc_id"), 5) != 0)
    out = langid.predict(docs, net)
    return out.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op10_near_dedup(spark, sf_dir):
    return near.classify(table(spark, sf_dir, "documents")).drop("node")


def op11_ngram_join(spark, sf_dir):
    return parity.link(table(spark, sf_dir, "documents"))


def op12_spelling(spark, sf_dir):
    return variants.group(variants.words(table(spark, sf_dir, "documents"), damage=97))


def op13_fill_in_middle(spark, sf_dir):
    out = rotation.restore(rotation.transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_secrets, op2_quality, op3_katz, op4_exact_dedup, op5_decontamination, op6_passages, op7_surrogates, op8_mixing,
        op9_language_id, op10_near_dedup, op11_ngram_join, op12_spelling, op13_fill_in_middle,
    )
}

ORACLE = {
    "op4_exact_dedup": """
        with d as (select doc_id, coalesce(text, '') as text from documents),
        g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id is not distinct from g.keep_id as kept, sha256(d.text) as text_sha256
        from d join g on d.text = g.text
    """,
    "op6_passages": r"""
        with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
        v as (select doc_id, unnest(range(1, greatest(len(w) - 33, 1))) as i from d),
        k as (select v.doc_id, i, list_slice(w, i, i + 34) as win from v join d using (doc_id)),
        r as (select doc_id, i from (select doc_id, i, count(*) over (partition by win) as n from k) where n > 1),
        g as (select distinct doc_id, unnest(range(i, i + 35)) as p from r),
        c as (select doc_id, list(p) as ps, count(*) as n from g group by doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(c.n, 0) as bigint) as n_removed,
               sha256(coalesce(array_to_string(case when c.n is null then w else list_filter(w, lambda x, p: not list_contains(c.ps, p)) end, ' '), '')) as kept_sha256
        from d left join c using (doc_id)
    """,
    "op8_mixing": r"""
        with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
        s as (select source, cast(sum(size) as bigint) as n from d group by source),
        r as (select *, case (row_number() over (order by encode(source) nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w from s),
        o as (select *, cast(sum(3 * n) over up - 3 * n as bigint) as capped, cast(sum(w) over up as bigint) as below, (select cast(sum(n) as bigint) from r) as total, (select cast(sum(w) as bigint) from r) as weights
              from r window up as (order by 3.0 * n / w, source rows between unbounded preceding and current row)),
        c as (select *, 3 * n < cast(total - capped as double) * w / cast(weights - below + w as double) as is_capped from o),
        l as (select any_value(total) - coalesce(sum(case when is_capped then 3 * n end), 0) as rest, coalesce(sum(case when not is_capped then w end), any_value(weights)) as shares from c),
        t as (select source, n, least(cast(3 * n as double), cast(rest as double) * w / cast(shares as double)) as target from c, l),
        x as (select doc_id, size, n, target, case when n > 0 then target / n else 0.0 end as rate,
                     cast('0x' || substr(md5('7:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) / 4294967296.0 as u
              from d join t on d.source is not distinct from t.source),
        k as (select *, cast(floor(rate) as int) + cast(u < rate - floor(rate) as int) as copies from x)
        select doc_id, cast(size as bigint) as size, n as source_size, target, cast(size * copies as bigint) as taken, copies from k
    """,
    "op11_ngram_join": r"""
        with recursive d as (select row_number() over () as r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w from documents),
        q as (select r, len(w) as l, unnest(w) as w1, unnest(range(len(w))) as i from d),
        v as (select r, l, i, w1, lead(w1) over o as w2, lead(w1, 2) over o as w3 from q window o as (partition by r order by i)),
        y as (select distinct r, case when l < 3 then concat_ws(' ', w1, w2) else w1 || ' ' || w2 || ' ' || w3 end as h from v where i < greatest(l - 2, 1)),
        g as (select d.r, doc_id, coalesce(list(h order by h) filter (where h is not null), []) as s from d left join y using (r) group by all),
        u as (select s, min(r) as k from g where len(s) > 0 group by s),
        x as (select k, len(s) as n, unnest(s) as h from u),
        p as (select a.k as a, b.k as b, any_value(a.n) + any_value(b.n) as sizes, count(*) as c from x a join x b on a.h = b.h and a.k < b.k and b.n * 90 <= a.n * 100 and a.n * 90 <= b.n * 100 group by a.k, b.k),
        e as (select a, b from p where 100 * c >= 90 * (sizes - c)),
        z as (select a, b from e union select b, a from e),
        t as (select k as a, k as b from u union select t.a, z.b from t join z on t.b = z.a),
        m as (select g.r, g.doc_id, u.k from g join u on g.s = u.s),
        o as (select t.a, min(m.doc_id) as c from t join m on m.k = t.b group by t.a)
        select g.doc_id, cast(len(g.s) as bigint) as n_shingles, coalesce(o.c, g.doc_id) as component_id
        from g left join m using (r) left join o on o.a = m.k
    """,
    "op12_spelling": r"""
        with recursive v as (select i, i as c, 0 as step from range(256) t(i) union all
                select i, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from v where step < 8),
        tab as (select list(c order by i) as tab from v where step = 8),
        runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as w from documents),
        k as (select coalesce(cast(doc_id as varchar), '') || ':' || w as k, w, count(*) as n from runs group by all),
        h as (select w, n, xor(list_reduce(list_transform(range(1, octet_length(encode(k)) + 1), lambda i: cast(('0x' || substr(hex(encode(k)), 2 * i - 1, 2)) as bigint)),
                     lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1]), 4294967295), 4294967295) as h from k, tab),
        o as (select case when h % 97 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from h),
        words as (select word, cast(sum(n) as bigint) as n from o where length(word) >= 5 group by word having sum(n) >= 3),
        cuts as (select word, unnest(range(1, length(word) + 1)) as i from words),
        less as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as short from cuts),
        e as (select a.word as a, b.word as b from less a join less b on a.short = b.short and a.i = b.i and a.word <> b.word
              union select l.word, w.word from less l join words w on l.short = w.word
              union select w.word, l.word from less l join words w on l.short = w.word),
        f as (select a as word, count(*) as n_near, max(w.n) as top, arg_min(b, (-w.n, encode(b))) as best from e join words w on w.word = e.b group by a),
        g as (select w.word, w.n, coalesce(f.n_near, 0) as n_near, case when top >= 2 * w.n then best end as form, case when top >= 2 * w.n then top end as form_n from words w left join f using (word)),
        roots as (select word, form as goal from g where form is not null union all select r.word, g.form from roots r join g on g.word = r.goal where g.form is not null),
        ends as (select word, goal from roots r where not exists (select 1 from g where g.word = r.goal and g.form is not null))
        select g.word, form, coalesce(ends.goal, g.word) as root, n, cast(n_near as bigint) as n_near, cast(form_n as bigint) as form_n from g left join ends using (word)
    """,
    "op13_fill_in_middle": """
        with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as x from documents),
        h as (select doc_id, t, length(t) as n, cast('0x' || substr(x, 1, 8) as bigint) as h1, cast('0x' || substr(x, 9, 8) as bigint) as h2,
                     cast('0x' || substr(x, 17, 8) as bigint) as h3, cast('0x' || substr(x, 25, 8) as bigint) as h4 from d),
        f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi,
                     case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                          when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
        s as (select *, substr(t, 1, lo) as p, substr(t, lo + 1, hi - lo) as m, substr(t, hi + 1) as z from f)
        select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then lo end as prefix_chars, case when form <> 'plain' then hi - lo end as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || z || '<M>' || m else '<S>' || z || '<P>' || p || '<M>' || m end) as output_sha256,
               sha256(t) as restored_sha256 from s
    """,
}
