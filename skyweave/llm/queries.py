"""Queries over whole tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweave.llm import alignment, centroids, chat_format, decontamination, html_text, language_quality, license_scan, minhash, mixing, pii, quality_rules, simhash, token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(chat_format.render(chat_format.with_control_case(_table(spark, sf_dir, "conversations"))))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op8_language_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_token_counts, op3_html_text, op4_chat_format, op5_decontamination, op6_minhash, op7_pii, op8_language_quality, op9_quality_rules, op10_license_scan, op11_centroids, op12_alignment, op13_simhash)}

_POSTINGS = ", ".join(f"({t}, '{label}', '{w}', {i}, {str(at <= i < at + len(need)).lower()})" for t, (label, words, need, at) in enumerate(license_scan._notices()) for i, w in enumerate(words))

def _rounds(n: int) -> str:
    """The assignments and means of op11's rounds, a query a round."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    near = lambda r: f"a{r} as materialized (select row, arg_min(k, away * 64 + k) as k, min(away) as away from (select v.row, c.k, cast({distance} as hugeint) as away from vectors v cross join c{r} c) group by row)"
    mean = lambda r: f"""c{r + 1} as materialized (select k, coalesce(m.x, c.x) as x from c{r} c left join (select k, list(cast(m as bigint) order by d) as x from (
      select k, d, floor(sum(v) / count(*)) as m from (select k, unnest(x) as v, unnest(range(64)) as d from vectors join a{r} using (row)) group by k, d) group by k) m using (k))"""  # noqa: E731
    return ",\n".join(f"{near(r)},\n{mean(r)}" for r in range(n)) + f",\n{near(n)}"


SQL = {
    "op11_centroids": f"""
with vectors as materialized (select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (select row_number() over (order by sha256('2:' || vec_id), x) - 1 as k, x from vectors where vec_id is not null order by k limit 40),
{_rounds(5)}
select vec_id, cast(k as integer) as cluster, cast(away as bigint) as distance, cast(sum(away) over (partition by k) as bigint) as cluster_inertia, cast(sum(away) over () as bigint) as inertia,
       sha256(array_to_string(c5.x, ',')) as centroid_sha256
from vectors join a5 using (row) join c5 using (k)
""",
    "op10_license_scan": rf"""
with docs as (select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
index(template, label, word, place, mandatory) as (values {_POSTINGS}),
found as (select * from (select id, unnest(words) as word, unnest(range(len(words))) as spot from docs) w where word in (select word from index)),
frequency as (select word, count(distinct id) as df from found group by word),
idf as (select i.word, ln((1 + (select count(*) from docs)) / (1 + coalesce(df, 0))) as idf from (select distinct word from index) i left join frequency f on f.word = i.word),
whole as (select template, sum(idf) as total, count(*) filter (mandatory) as needed from index join idf using (word) group by template),
met as (select id, template, label, spot - place as start, sum(idf) as got, count(*) filter (mandatory) as n from found join index using (word) join idf using (word) group by all),
passed as (select *, case when total > 0 then got / total else 1 end as score from met join whole using (template) where n = needed),
by_doc as (select id, count(*) filter (template < {len(license_scan.BASE)}) as n_base, min(start) filter (template < {len(license_scan.BASE)}) as first_word, max(start) filter (template < {len(license_scan.BASE)}) as last_word,
  string_agg(distinct label, ',' order by label) filter (template < {len(license_scan.BASE)}) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(score) as score from passed group by id)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, round(least(coalesce(score, 0), 1), 6) as score
from docs left join by_doc using (id)
""",
    "op4_chat_format": """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
written as (
  select *, length(text) + case when contains(text, '<|im_start|>') or contains(text, '<|im_end|>') or regexp_matches(text, '<\\\\+\\|')
    then len(regexp_extract_all(text, '<\\\\*\\|')) else 0 end as text_chars from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('<|im_start|>') + length(role) + 1 + text_chars + length('<|im_end|>') + 1) as bigint) as formatted_chars
from written group by conv_id
""",
}
