"""One row per key, latest state, and incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order.

    The rank filter is planned as a group limit that runs before the shuffle as
    well, so each map task sends at most one row per key however hot a key is.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def upsert_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Target with the batch merged in: one row per key, the batch's newest wins.

    ``target`` holds one row per key already, so only the batch is reduced; the
    target is filtered by an anti join and never shuffled for ranking.
    """
    newest = first_per_key(batch, keys, order)
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


def replace_snapshot(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Upsert, then drop target rows whose key the snapshot no longer has."""
    merged = upsert_latest(target, batch, keys, order)
    present = batch.select(*keys).distinct()
    return merged.join(present, list(keys), "left_semi").select(*target.columns)


def drop_stale(
    df: DataFrame, snapshot: Column, position: Column, max_age: int = 60, stamp: str = "last_seen"
) -> DataFrame:
    """Keep rows positioned within ``max_age`` seconds of the snapshot and stamp them."""
    fresh = position.isNotNull() & (snapshot - position <= max_age)
    return df.filter(fresh).withColumn(stamp, snapshot)


def newer_than(
    df: DataFrame, ts: str, mark, tie_break: Sequence[Column | str], feed: Sequence[str] = ()
) -> DataFrame:
    """Rows past the high-water mark, one per time value (and feed, if given).

    The mark moves with every row sent, so rows sharing a time with an earlier
    one are skipped; ``tie_break`` says which of them comes first. On a stream the
    mark is kept in its state from ``mark`` on and ``tie_break`` names columns.
    """
    above = df.filter(F.col(ts) > mark)
    if df.isStreaming:
        from aerolith.streaming.stateful import above_mark

        return above_mark(above, ts, list(tie_break), feed)
    return first_per_key(above, [*feed, ts], [F.asc(c) if isinstance(c, str) else c for c in tie_break])


def first_seen(df: DataFrame, key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """First occurrence per id; on a stream the watermark bounds the memory of ids."""
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark([key])
    return first_per_key(df, [key], order or [F.col(key)])


def latest_window(df: DataFrame, end_col: str = "window_end", bounded: bool = False) -> DataFrame:
    """Rows of the newest window.

    ``bounded`` says that a window has a bounded number of rows (cells, countries).
    The input is then worked out once: a rank limit leaves each task the rows of its
    newest window before these meet. Otherwise the newest end is a subquery.
    """
    if not bounded:
        return df.filter(F.col(end_col) == df.agg(F.max(end_col)).scalar())
    timed = df.filter(F.col(end_col).isNotNull())
    ranked = timed.withColumn("_rank", F.rank().over(Window.orderBy(F.desc(end_col))))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def recent(df: DataFrame, ts: str, interval: str, as_of: Column) -> DataFrame:
    """Rows at or after ``as_of - interval``."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"interval {interval}"))


def top_k(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """Ordered rows, cut to the best ``k`` when given."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def hashed_sample(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows in a pseudo-random order fixed by the seed.

    Ordering by a digest of the key instead of ``rand()`` gives the same sample
    when a lost task is computed again.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(digest, F.col(key)).limit(k)
