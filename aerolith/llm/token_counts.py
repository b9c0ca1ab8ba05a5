"""Token counts: an exact histogram of encoded lengths and what its suffix sums answer.

Documents are encoded once and only their lengths are kept. The histogram has
one row per length that occurs; sums over the lengths at or above a limit give
totals, quantiles and truncated totals for any context limit.

A null or empty text has length 0. Repeated rows count each time. An empty
table gives an empty histogram. Only the text column is read, so further
columns, whatever their names, play no part.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import add_columns

SPAN = 1024


def rank_encoder(path: str, pattern: str):
    """A factory for the token counter of a byte-level vocabulary in rank form (base64 token, rank)."""

    def make():
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [[len(encoding.encode_ordinary(t)) for t in texts]]

    return make


def encoded_lengths(df: DataFrame, make, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """df with the number of tokens of each text."""
    return add_columns(df, text_col, [(out, "long")], make)


def length_histogram(df: DataFrame, make, text_col: str = "text") -> DataFrame:
    """(length, n_docs): documents by encoded length."""
    lengths = encoded_lengths(df.select(F.col(text_col).alias("text")), make, "text", "length")
    return lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame, length: str = "length", docs: str = "n_docs") -> DataFrame:
    """Answers for every length L of a histogram taken as context limit.

    docs_at_least, tokens_at_least: documents of L or more tokens and their tokens;
    docs_at_most: documents of L or fewer; truncated_tokens: the total if each
    document is cut to L tokens; total_docs, total_tokens: of all documents.

    Sums run within spans of lengths, and over the few totals of spans, so that
    no task holds the whole histogram.
    """
    h = histogram.select(
        F.col(length).cast("long").alias("length"),
        F.col(docs).cast("long").alias("n_docs"),
        F.floor(F.col(length) / SPAN).alias("span"),
    ).withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    spans = h.groupBy("span").agg(F.sum("n_docs").alias("span_docs"), F.sum("n_tokens").alias("span_tokens"))
    above = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    spans = spans.select(
        "span",
        F.coalesce(F.sum("span_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("span_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("span_docs").over(all_rows).alias("total_docs"),
        F.sum("span_tokens").over(all_rows).alias("total_tokens"),
    )
    down = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    sums = h.join(spans, "span").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.sum("n_docs").over(down) + F.col("docs_above")).alias("docs_at_least"),
        (F.sum("n_tokens").over(down) + F.col("tokens_above")).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )
    return sums.select(
        "*",
        (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias(
            "truncated_tokens"
        ),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents does not exceed."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    reached = sums.select("length", "docs_at_most", "total_docs", wanted).where(
        F.col("docs_at_most") >= F.col("share") * F.col("total_docs")
    )
    return reached.groupBy("share").agg(F.min("length").alias("length"))


def totals_at(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_over, truncated_tokens) for context limits that need not occur as lengths."""
    each = sums.select("length", "n_docs", F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("limit"))
    return each.groupBy("limit").agg(
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "limit") * F.col("n_docs")).alias("truncated_tokens"),
    )
