"""The registered queries of the operators, over whole tables, and their answers in SQL where SQL can give them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockyard.llm import bpe, conversations, fingerprint, html, language, lm, near_duplicates, negatives, neighbours, packing, passages, quality, toxicity
from stockyard.llm.common import shipped


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.groups(_table(spark, sf_dir, "documents"))


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 20 = 0"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(_table(spark, sf_dir, "pages"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(_table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(conversations.damaged(_table(spark, sf_dir, "conversations")), present="present")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), "id % 50 = 0")


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_repeated_passages": op1_repeated_passages,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_nearest_vectors": op4_nearest_vectors,
        "op5_main_text": op5_main_text,
        "op6_language": op6_language,
        "op7_fingerprints": op7_fingerprints,
        "op8_quality": op8_quality,
        "op9_toxicity": op9_toxicity,
        "op10_packing": op10_packing,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_language_model": op13_language_model,
    }


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+')"
NEAR_DUPLICATES = f"""
with recursive w as (select doc_id, {WORDS} as w from documents),
sets as (
    select doc_id, list_distinct(case when len(w) < 5 then (case when len(w) = 0 then [] else [array_to_string(w, ' ')] end)
        else [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] end) as s
    from w
),
items as (select doc_id, len(s) as n, unnest(s) as item from sets),
common as (
    select x.doc_id as a, y.doc_id as b, any_value(x.n) as na, any_value(y.n) as nb, count(*) as same
    from items x join items y on x.item = y.item and x.doc_id <> y.doc_id group by 1, 2
),
links as (select a, b from common where 100 * same >= 75 * (na + nb - same)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select doc_id, len(s) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id, doc_id <= coalesce(m, doc_id) as kept
from sets left join (select a, min(b) as m from reach group by a) on a = doc_id
"""
REPEATED_PASSAGES = f"""
with w as (select doc_id, {WORDS} as w from documents),
windows as (
    select doc_id, unnest(range(0, len(w) - 49)) as pos, unnest([array_to_string(w[i : i + 49], ' ') for i in range(1, len(w) - 48)]) as passage
    from w where len(w) >= 50
),
owned as (select doc_id, pos, min(doc_id) over (partition by passage) as owner from windows),
covered as (select doc_id, pos, pos - lag(pos) over (partition by doc_id order by pos) as gap from owned where owner <> doc_id),
marked as (select doc_id, pos, sum(case when gap is null or gap > 50 then 1 else 0 end) over (partition by doc_id order by pos) as island from covered),
spans as (select doc_id, min(pos) as b, max(pos) + 50 as e from marked group by doc_id, island),
told as (select doc_id, sum(e - b) as n, string_agg(b || '-' || e, ',' order by b) as p from spans group by doc_id)
select doc_id, len(w) as n_words, coalesce(n, 0)::bigint as n_repeated, coalesce(p, '') as passages from w left join told using (doc_id)
"""


HARD_NEGATIVES = """
with v as (
    select vec_id, label, any_value(v) as v from (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ) group by vec_id, label
),
s as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
),
p as (
    select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, row_number() over w::int as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id) qualify row_number() over w <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_repeated_passages": REPEATED_PASSAGES,
        "op3_near_duplicates": NEAR_DUPLICATES,
        "op12_hard_negatives": HARD_NEGATIVES,
    }
