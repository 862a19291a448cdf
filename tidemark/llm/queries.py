"""The text operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, mixing, pii, quality, rules, sharding, simhash, substrings, toxicity
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.schedule(table(spark, sf_dir, "documents"), repetition_limit=2.0)
    return out.select("doc_id", "source", F.col("_words").alias("n_words"), F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_place").alias("place"), F.round("_weight", 9).alias("weight"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 0.8)


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), 2)
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.size("_entities").cast("long").alias("n_entities"), F.col("_entities.kind").alias("kinds"), F.col("_entities.surrogate").alias("surrogates"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.formatted(chat.planted(table(spark, sf_dir, "conversations"))))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(table(spark, sf_dir, "documents"), 13)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


#: The grid of exponents that PASSES refinements end on, and the mixing query's own parameters.
OP2_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as n_words,
    ('0x' || left(md5('17|' || coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 15))::bigint as key
  from documents),
s as (select coalesce(source, chr(0)) as src, count(*) as n_rows, sum(n_words)::bigint as n_words, greatest(ceil(count(*) / 4096.0), 1)::bigint as blocks from d group by 1),
g as (select sum(n_words)::double as total, max(n_words)::double as most, (min(n_words) filter (where n_words > 0))::double as least from s),
a as (select *, case when most / least <= 2 then 0.0 else ceil((1 - ln(2.0) / ln(most / least)) * 16777216) / 16777216 end::double as alpha from g),
z as (select a.*, (select sum(pow(n_words / total, alpha)) from s, a where n_words > 0) as norm from a),
w as (select src, n_words as total_words, blocks, case when n_words > 0 then pow(n_words / total, alpha) / norm else 0 end as weight, most / (pow(most / total, alpha) / norm) as budget from s, z),
p as (select *, round(weight * budget)::bigint as budget_words from w),
r as (select d.*, p.*, key % blocks as b from d join p on coalesce(d.source, chr(0)) = p.src),
k as (select src, b, sum(n_words)::bigint as in_block, max(total_words) as tw, max(budget_words) as bw from r group by 1, 2),
o as (select src, b, row_number() over t as turn, case when tw > 0 then bw % tw else 0 end - sum(in_block) over t + in_block as left_words from k window t as (partition by src order by md5('17|block|' || b))),
x as (select r.*, turn, left_words, row_number() over v as place, sum(n_words) over (partition by src, b order by key, doc_id rows between unbounded preceding and current row) - n_words as spent
  from r join o using (src, b) window v as (partition by src, b order by key, doc_id)),
y as (select *, case when total_words > 0 then budget_words // greatest(total_words, 1) else 1 end + case when left_words > 0 and spent < left_words then 1 else 0 end as passes from x)
select doc_id, source, n_words, unnest(range(passes))::int as epoch, turn::int as block, place::int as place, round(weight, 9) as weight from y where passes > 0
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": OP2_SQL}
