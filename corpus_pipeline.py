"""A training corpus from raw documents, in five stages over whole tables.

A stage takes (spark, docs, sf_dir) and returns a table that is written and read
again as the next one's docs. All but the last return the columns of documents.

  toxicity        documents with a toxicity score of 0.3 or more go
  simhash         one document of each group of near-duplicates stays
  decontaminate   documents that contain a benchmark item go
  pii             personal data is replaced by its kind in brackets, n_chars follows
  sentencepiece   texts become token ids, checked by decoding them again

Null texts count as empty: they pass the filters, one of them stays after the
second stage, and a null text stays null until it is encoded.

Rows go to Python `BATCH_ROWS` at a time, so that long texts and shingle sets take
little of an executor's memory; the session keeps this setting.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import decontamination, near_copies, pii, piece_codec, toxicity
from aerolith.llm.common import table, written
from aerolith.llm.queries import PIECES, tokenizer_path, toxicity_model
from aerolith.session import configure

TOXIC = 0.3
CONTAINED = 0.8
BATCH_ROWS = 1000


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that applies the session settings first, whoever calls it."""

    @wraps(fn)
    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return fn(spark, docs, sf_dir)

    return apply


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold, by a model fitted on the labels of these documents."""
    scored = toxicity.score_texts(docs, toxicity_model(spark, sf_dir, docs), out="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).select(*docs.columns)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    return near_copies.keep_one(docs)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), least=CONTAINED)


@stage
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    clean = pii.redacted(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token ids, their number, and whether decoding them gives the text again."""
    made = piece_codec.encoded(docs, tokenizer_path(PIECES), with_text=True)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit(piece_codec.MARK), F.lit(" "))
    return made.select("doc_id", "lang", "source", "n_tokens", "ids", (F.col("decoded") == plain).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = written(apply(spark, docs, sf_dir), f"stage-{name}")
    return docs
