"""Queries of the operators on texts: (spark, folder) -> DataFrame, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, divergence, fim, langid, licenses, mixing, passages, quality, sharding, simhash, tokenfile, urls
from tidemark.llm.common import prepare
from tidemark.session import write_and_reread

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _read(spark, folder, table):
    prepare(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_curriculum(spark, folder):
    return mixing.mixed(_read(spark, folder, "documents"))


def op2_language(spark, folder):
    return langid.identify(_read(spark, folder, "documents"))


def op3_quality(spark, folder):
    docs = _read(spark, folder, "documents")
    counted = write_and_reread(quality.with_counts(docs.select("doc_id", "lang", "source", "text")).drop("text"), "counted")
    return quality.judge(counted).select(
        "doc_id", *[f"counts.{c}" for c in quality.COUNTS[:5]], "base_failed", "kept", "distance")


def op4_token_file(spark, folder):
    path = tokenfile.write(_read(spark, folder, "documents"), VOCABULARY, end_id=2)
    return tokenfile.summary(spark, path)


def op5_bpe(spark, folder):
    return bpe.digests(_read(spark, folder, "documents"), VOCABULARY)


def op6_simhash(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    prints = write_and_reread(simhash.with_fingerprint(docs, shingle=3).drop("text"), "prints")
    groups = simhash.near_duplicates(prints, distance=2).drop("root")
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(groups, "fingerprint").select("doc_id", text.alias("fingerprint"), "component_id")


def op7_hilbert(spark, folder):
    return sharding.shard(_read(spark, folder, "documents"))


def op8_licenses(spark, folder):
    return licenses.scan(_read(spark, folder, "documents"))


def op9_nearest(spark, folder):
    return ann.nearest(_read(spark, folder, "embeddings"), lambda key: key % 20 == 0)


def op10_urls(spark, folder):
    """The list holds the canonical addresses that were fetched more than once."""
    pages = _read(spark, folder, "pages")
    address = urls.canonical(F.col("url")).alias("canonical")
    listed = pages.select(address).filter("canonical is not null").groupBy("canonical").agg(
        F.count("*").alias("n")).filter("n > 1").select("canonical")
    return urls.judge(pages, listed).drop("canonical")


def op11_passages(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return passages.cut_repeats(docs).select(
        "doc_id", "cut.n_words", "cut.n_removed", F.sha2(F.col("cut.text").cast("binary"), 256).alias("kept_sha256"))


def op12_divergence(spark, folder):
    return divergence.divergences(_read(spark, folder, "documents"))


def op13_fill_in_middle(spark, folder):
    cut = fim.transform(_read(spark, folder, "documents").select("doc_id", "text"))
    made = F.col("fim")

    def digest(text):
        return F.sha2(text.cast("binary"), 256)

    return cut.select(
        "doc_id", *[made[c].alias(c) for c in ("n", "form", "prefix_chars", "middle_chars")],
        digest(made["output"]).alias("output_sha256"),
        digest(fim.restored(made["output"], made["form"])).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_curriculum, op2_language, op3_quality, op4_token_file, op5_bpe, op6_simhash, op7_hilbert, op8_licenses,
    op9_nearest, op10_urls, op11_passages, op12_divergence, op13_fill_in_middle)}

_TEMPLATES = ", ".join(
    f"({i}, '{k}', [{', '.join(repr(w) for w in licenses.template_bigrams(v))}])"
    for i, (k, v) in enumerate(sorted(licenses.TEMPLATES.items())))

SQL = {
    "op8_licenses": rf"""
        with template(place, license, pairs) as (values {_TEMPLATES}),
        lines as (
            select doc_id, unnest(generate_series(0, len(parts) - 1)) as line, unnest(parts) as content
            from (select doc_id, string_split(text, chr(10)) as parts from documents where text is not null)),
        words as (
            select doc_id, line, list_filter(regexp_split_to_array(lower(content), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') as words
            from lines),
        pairs as (
            select doc_id, line, list_distinct(list_transform(
                generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1])) as pairs
            from words where len(words) > 1),
        scored as (
            select doc_id, line, license, place, len(p.pairs) as n_bigrams,
                2.0::double * len(list_intersect(p.pairs, t.pairs)) / (len(p.pairs) + len(t.pairs)) as dice
            from pairs p, template t where len(p.pairs) < 100)
        select doc_id, line::int as line, license, dice, n_bigrams::int as n_bigrams
        from (select *, row_number() over (partition by doc_id, line order by dice desc, place) as best from scored)
        where best = 1 and dice >= 0.8""",
    "op10_urls": r"""
        with parts as (
            select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path,
                list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
                    lambda f: f <> '' and not regexp_matches(f, '(?i)^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) as fields
            from pages),
        address as (
            select page_id, host, path, case when host <> '' then regexp_replace(host, '^www\.', '')
                || regexp_replace(path, '/+$', '')
                || case when len(fields) > 0 then '?' || array_to_string(fields, '&') else '' end end as canonical
            from parts),
        listed as (select canonical from address where canonical is not null group by 1 having count(*) > 1),
        rules(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
            ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        fits as (
            select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as v
            from address, rules
            where (host = h or suffix(host, '.' || h)) and prefix(path, p) group by 1)
        select a.page_id, a.host, a.path, f.rule,
            coalesce(f.v, case when a.canonical in (select canonical from listed) then 'block' end, 'allow') as verdict
        from address a left join fits f using (page_id)""",
    "op11_passages": r"""
        with words as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
        placed as (select doc_id, words, unnest(generate_series(1, len(words))) as place from words),
        windows as (
            select doc_id, place, words[place] as word,
                case when place + 19 <= len(words) then array_to_string(words[place:place + 19], ' ') end as content
            from placed),
        judged as (
            select doc_id, place, word, content is not null
                and row_number() over (partition by content order by doc_id, place) > 1 as again
            from windows),
        covered as (
            select doc_id, place, word,
                bool_or(again) over (partition by doc_id order by place rows between 19 preceding and current row) as removed
            from judged),
        cut as (
            select doc_id, count(*) filter (removed) as n_removed, string_agg(word, ' ' order by place) filter (not removed) as kept
            from covered group by 1)
        select doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from words left join cut using (doc_id)""",
    "op12_divergence": r"""
        with docs as (
            select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
            from documents),
        occurring as (
            select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
        kept as (select lang, term, count(*) as n from occurring group by 1, 2 having count(distinct doc) >= 10),
        counts as (
            select lang, source, term, count(*) as n from occurring semi join kept using (lang, term) group by 1, 2, 3),
        langs as (select lang, count(*) as v, sum(n) as n from kept group by 1),
        sums as (select lang, source, sum(n) as n from counts group by 1, 2),
        parts as (
            select lang, source, coalesce(langs.v, 0) as v, coalesce(sums.n, 0) + 2 * coalesce(langs.v, 0) as whole,
                coalesce(langs.n, 0) + 2 * coalesce(langs.v, 0) as lang_whole
            from (select distinct lang, source from docs) left join langs using (lang) left join sums using (lang, source)),
        shares as (
            select lang, source, term, coalesce(counts.n, 0) as n,
                (1 + 1000000000::hugeint * (coalesce(counts.n, 0) + 2) // whole)::bigint as p,
                (1 + 1000000000::hugeint * (kept.n + 2) // lang_whole)::bigint as q
            from parts join kept using (lang) left join counts using (lang, source, term)),
        pairs as (
            select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
            group by 1, 2, 3),
        listed as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pairs.value, 0)::bigint as value
            from parts a join parts b on a.lang = b.lang and a.source <> b.source
                left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
            union all
            select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from shares where n > 0 and p > q),
        ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from listed)
        select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10""",
    "op13_fill_in_middle": r"""
        with drawn as (
            select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
                sha256('1:' || coalesce(doc_id::varchar, '')) as hex
            from documents),
        numbers as (
            select doc_id, text, n, ('0x' || substr(hex, 1, 8))::bigint % (n + 1) as x, ('0x' || substr(hex, 9, 8))::bigint % (n + 1) as y,
                ('0x' || substr(hex, 17, 8))::bigint % 100 as h3, ('0x' || substr(hex, 25, 8))::bigint % 100 as h4
            from drawn),
        formed as (
            select doc_id, text, n, least(x, y) as a, greatest(x, y) as b,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 90 then 'plain'
                     when h4 < 20 then 'spm' else 'psm' end as form
            from numbers),
        parts as (
            select *, substr(text, 1, a) as p, substr(text, a + 1, b - a) as m, substr(text, b + 1) as s from formed)
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
            case when form <> 'plain' then b - a end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
            sha256(text) as restored_sha256
        from parts""",
}
