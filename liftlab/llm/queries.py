"""Registered queries of the text operators, with DuckDB texts where SQL can express them."""

from __future__ import annotations

from liftlab.llm import (
    bpe, divergence, fingerprint, language, lines, packing, ranked, secrets, simhash, substring, tokencount, topk, toxicity)
from liftlab.llm.common import table, vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(substring.remove_repeats(table(spark, sf_dir, "documents")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.digests(fingerprint.fingerprints(table(spark, sf_dir, "documents")))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.usable(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % topk.QUERY_EVERY == 0))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_toxicity, op3_substring_dedup, op4_packing, op5_simhash, op6_bpe,
    op7_line_dedup, op8_language, op9_fingerprints, op10_top_k, op11_token_counts, op12_ranked_search,
    op13_source_divergence)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op3_substring_dedup": """
with words as (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
    from documents),
windows as (
    select doc_id, i, array_to_string(w[i:i + 12], ' ') as win
    from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words)),
firsts as (select win, min(doc_id) as first_id from windows group by win),
cut as (
    select doc_id, list(distinct p) as gone
    from (select doc_id, i + unnest(range(0, 13)) as p from windows join firsts using (win) where first_id < doc_id)
    group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: gone is null or not list_contains(gone, i)), ' ')) as kept_sha256
from words left join cut using (doc_id)""",
    "op10_top_k": """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5""",
    "op12_ranked_search": f"""
with docs as (
    select row_number() over () as r, doc_id,
           unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from documents),
items as (
    select item_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from (select distinct item_id, text from benchmark)),
counted as (select r, doc_id, term, count(*) as tf from docs group by all),
lengths as (select r, count(*) as n from docs group by r),
corpus as (select count(*) as docs, sum(n)::bigint as terms from lengths),
weights as (
    select term, floor(1000 * ln((2 * any_value(corpus.docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from counted cross join corpus group by term),
scored as (
    select item_id, r, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * corpus.docs) // corpus.terms))))::bigint as score
    from items join counted using (term) join weights using (term) join lengths using (r) cross join corpus
    group by item_id, r, doc_id)
select item_id, rank::integer as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
where rank <= 20""",
    "op13_source_divergence": f"""
with docs as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
    from documents),
used as (select r, lang, source, unnest(w) as term from docs),
kept as (select lang, term, count(*) as total from used group by lang, term having count(distinct r) >= 3),
counts as (select lang, source, term, count(*) as c from used semi join kept using (lang, term) group by all),
langs as (
    select lang, count(term) as v, coalesce(sum(total), 0)::hugeint as n
    from (select distinct lang from docs) left join kept using (lang) group by lang),
groups as (
    select lang, source, coalesce(sum(c), 0)::hugeint as n
    from (select distinct lang, source from docs) left join counts using (lang, source) group by lang, source),
shares as (
    select groups.lang, groups.source, kept.term, coalesce(c, 0) as c,
           1 + 1000000000::hugeint * (coalesce(c, 0) + 1) // (groups.n + langs.v) as p,
           1 + 1000000000::hugeint * (total + 1) // (langs.n + langs.v) as q
    from groups join langs using (lang) join kept using (lang)
    left join counts on counts.lang = groups.lang and counts.source = groups.source and counts.term = kept.term),
apart as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
both_parts as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source
    union all
    select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares where c > 0 and p > q)
select lang, source, part, item, value, rank::integer as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from both_parts)
where part = 'pair' or rank <= 200""",
}
