"""The registered queries op1 to op13: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import (
    best_fit_packing,
    conversation_repair,
    decontamination,
    hard_negatives,
    language_id,
    lm_score,
    pii,
    piece_codec,
    secret_scan,
    simhash,
    token_counts,
    topk_search,
    toxicity,
)
from aerolith.llm.common import learnable, remainder_is, table, written
from aerolith.llm.registry import query


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def rank_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = token_counts.rank_encoder(tokenizer_path("byte_bpe_50k.tiktoken"), rank_pattern())
    histogram = token_counts.length_histogram(table(spark, sf_dir, "documents"), make)
    return token_counts.suffix_sums(written(histogram, "lengths"))  # read twice, encoded once


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secret_scan.train(secret_scan.identifier_samples(docs))
    return secret_scan.digest(secret_scan.find_secrets(docs, model))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, learnable("doc_id", 3, 1))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", remainder_is("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


OP4_SQL = """
with v as (
    select row_number() over () as rid, vec_id, [floor(64 * x::double) for x in embedding] as q from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
    select a.rid, a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id % 20 = 0 and a.rid <> b.rid),
ranked as (
    select *, cast(row_number() over (partition by rid order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@query("op4_topk_search", OP4_SQL)
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=4))


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")))


PIECES = "piece_bpe_32k.model"


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = piece_codec.digests(docs, tokenizer_path(PIECES))
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_differing")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> dict:
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), learnable("doc_id", 4, 2))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_texts(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        remainder_is("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


OP9_SQL = """
with doc_words as (
    select doc_id, row_number() over () as rid,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
item_words as (
    select item_id, row_number() over () as iid,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark),
items as (select *, least(5, len(w)) as size from item_words where len(w) > 0),
sizes as (select distinct size from items),
item_shingles as (
    select distinct iid, item_id, size, array_to_string(w[i:i + size - 1], ' ') as s
    from (select *, unnest(range(1, len(w) - size + 2)) as i from items)),
doc_shingles as (
    select distinct rid, doc_id, size, array_to_string(w[i:i + size - 1], ' ') as s
    from (select *, unnest(range(1, len(w) - size + 2)) as i from doc_words, sizes)),
totals as (select iid, count(*) as n_shingles from item_shingles group by iid),
common as (
    select rid, doc_id, iid, item_id, count(*) as n_shared
    from doc_shingles join item_shingles using (size, s) group by rid, doc_id, iid, item_id)
select doc_id, item_id, n_shingles, n_shared from common join totals using (iid) where n_shared >= 0.8 * n_shingles
"""


@query("op9_decontamination", OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least=0.8
    )


@query("op10_lm_scores")
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, words = lm_score.fit(docs.where(learnable("doc_id", 7, 2)))
    scored = lm_score.score(docs, model, words)
    return scored.select("doc_id", remainder_is("doc_id", 7, 2).alias("held_out"), *scored.columns[1:])


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.reports(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


OP12_SQL = """
with v as (
    select row_number() over () as rid, vec_id, [floor(256 * x::double) for x in embedding] as q,
        case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
    select a.rid as anchor, a.vec_id as anchor_id, b.rid as other, b.vec_id, a.label = b.label as same,
        cast(list_inner_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id % 100 = 0 and a.rid <> b.rid),
positives as (
    select *, row_number() over (partition by anchor order by score desc, vec_id) as turn from pairs where same),
found as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score,
        n.score as negative_score,
        cast(row_number() over (partition by p.anchor, p.other order by n.score desc, n.vec_id) as integer) as rank
    from positives p join pairs n on p.anchor = n.anchor and p.turn <= 5 and not n.same
        and 80 * p.score <= 100 * n.score and n.score <= p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 5
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = best_fit_packing.pack(docs, tokenizer_path("word_bpe_49k.json"))
    return made.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
