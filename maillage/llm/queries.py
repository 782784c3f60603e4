"""Registered queries of the folder, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from maillage.llm import (
    attention, curve_packing, divergence, html_blocks, importance, near_duplicates, ogg, pieces, quality, rule_cascade, token_counts, toxicity, url_rules,
)
from maillage.llm.columns import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.media_features(table(spark, sf_dir, "documents"))


def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score_documents(table(spark, sf_dir, "documents"))


def op4_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.code_documents(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_recurrent_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = html_blocks.extract_blocks(table(spark, sf_dir, "pages"))
    text = F.array_join("blocks", "\n")
    return blocks.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op7_url_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op8_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.find_near_duplicates(table(spark, sf_dir, "documents")).drop("text_md5")


def op9_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.judge(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ogg_media, op2_subword_quality, op3_attention_scores, op4_suffix_array_pieces, op5_curve_packing, op6_recurrent_blocks, op7_url_expressions, op8_minhash_components, op9_factorization_toxicity,
        op10_rule_cascade, op11_importance_resampling, op12_source_divergence, op13_token_counts, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op7_url_expressions": r"""
        with parts as (
          select page_id, strpos(coalesce(url, ''), '://') as p, coalesce(url, '') as url from pages
        ), rest as (
          select page_id, case when p > 0 then substr(url, p + 3) else '' end as rest from parts
        ), cut as (
          select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
          from rest
        ), rules(verdict, host_part, path_part) as (
          values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), fits as (
          select page_id, verdict, host_part || path_part as rule,
                 row_number() over (partition by page_id order by length(host_part || path_part) desc, length(host_part) desc) as n
          from cut join rules on ends_with('.' || host, '.' || host_part) and starts_with(path, path_part)
        )
        select cut.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
        from cut left join fits on fits.page_id = cut.page_id and n = 1
    """,
    "op10_rule_cascade": r"""
        with base as (
          select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                 list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
          from documents
        ), windows as (
          select doc_id, i, list_slice(w, i, i + 7) as s from base, unnest(range(1, len(w) - 6)) as u(i) where len(w) >= 8
        ), twice as (
          select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as n from windows) where n > 1
        ), steps as (
          select doc_id, least(8, coalesce(i - lag(i) over (partition by doc_id order by i), 8)) as step from twice
        ), repeats as (
          select doc_id, sum(step) as n from steps group by doc_id
        ), echoes as (
          select doc_id, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_echoed from base
        ), counted as (
          select base.doc_id, n_echoed, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
                 coalesce(repeats.n, 0)::bigint as n_repeat_words, len(l) as n_lines, length(regexp_replace(t, '[^!]+', '', 'g')) as n_exclaims
          from base join echoes using (doc_id) left join repeats using (doc_id)
        ), judged as (
          select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted
        )
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not (base_failed or 100 * n_symbols > 30 * n_words or 100 * n_exclaims > 30 * n_words or 100 * n_echoed > 30 * n_words or 100 * n_dup_lines > 50 * n_lines
                    or word_chars < 2 * n_words or word_chars > 16 * n_words) as kept
        from judged
    """,
    # crc32 of the distinct features, byte by byte: the table of one byte's effect, then a fold over each feature's bytes.
    "op11_importance_resampling": r"""
        with recursive effect(byte, value, step) as (
          select range, range, 0 from range(256)
          union all
          select byte, case when value & 1 = 1 then xor(value >> 1, 3988292384) else value >> 1 end, step + 1 from effect where step < 8
        ), bytes as materialized (
          select list(value order by byte) as effects from effect where step = 8
        ), texts as (
          select 's' as side, doc_id as id, text from documents union all select 't', item_id, text from benchmark
        ), split as (
          select side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
        ), features as materialized (
          select side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as feature from split
        ), distinct_features as (
          select distinct feature from features
        ), codes as (
          select feature, list_transform(range(0, octet_length(encode(feature))), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::bigint) as b from distinct_features
        ), hashed as (
          select feature, xor(list_reduce(list_prepend(4294967295, b), lambda crc, x: xor(crc >> 8, effects[1 + (xor(crc, x) & 255)])), 4294967295) % 10000 as bucket
          from codes, bytes
        ), counts as (
          select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t from features join hashed using (feature) group by bucket
        ), gains as (
          select bucket, floor(1000 * ln((t + 1)::double * (select sum(s) + 10000 from counts)::double / ((s + 1)::double * (select sum(t) + 10000 from counts)::double)))::bigint as gain from counts
        ), weights as (
          select id, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight from features join hashed using (feature) join gains using (bucket) where side = 's' group by id
        ), scored as (
          select doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0)
                 + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score, coalesce(weight, 0) as weight
          from documents left join weights on id = doc_id
        ), placed as (
          select *, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 39
        )
        select doc_id, scored.n_features, scored.weight, scored.score, place as rank
        from scored left join (select * from placed where place <= 25 * n // 100) as drawn using (doc_id)
    """,
    "op12_source_divergence": r"""
        with docs as (
          select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
          from documents
        ), tokens as materialized (
          select id, lang, source, unnest(w) as term from docs
        ), terms as materialized (
          select lang, term, count(*)::hugeint as n from tokens group by lang, term having count(distinct id) >= 3
        ), langs as (
          select lang, count(*)::hugeint as v, sum(n)::hugeint as n from terms group by lang
        ), counts as materialized (
          select lang, source, term, count(*)::hugeint as n from tokens join terms using (lang, term) group by lang, source, term
        ), sizes as (
          select lang, source, sum(n)::hugeint as n from counts group by lang, source
        ), groups as (
          select g.lang, g.source, coalesce(sizes.n, 0) + coalesce(v, 0) as total from (select distinct lang, source from docs) as g left join sizes using (lang, source) left join langs using (lang)
        ), shares as materialized (
          select g.lang, g.source, term, coalesce(c.n, 0) as n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // total as p
          from groups as g join terms using (lang) left join counts as c using (lang, source, term)
        ), summed as (
          select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from shares as a join shares as b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ), pairs as (
          select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
          from groups as a join groups as b on a.lang = b.lang and a.source <> b.source left join summed as s on s.lang = a.lang and s.source = a.source and s.item = b.source
        ), best as (
          select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value
          from (select s.lang, source, term, s.n, p, 1 + 1000000000 * (terms.n + 1) // (langs.n + v) as q from shares as s join terms using (lang, term) join langs on langs.lang = s.lang)
          where n > 0 and p > q
        ), ranked as (
          select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
          union all
          select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from best
        )
        select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 200
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
