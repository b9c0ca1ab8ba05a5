"""Tumbling windows, one function for batch and streaming input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = "5 minutes"


def whole_windows(
    df: DataFrame, ts: str, size: str, span: str | None = None, as_of: Column | None = None, newest: bool = True,
    lead: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Rows of the windows that end at ``as_of - span`` or later, and of the ``newest`` window.

    Filtering before the aggregation lets the bound reach the scan, which a filter on
    the window does not. All rows of those windows are kept; an earlier window may be
    kept in part, so the result is for readers that go on to take the span or the
    newest window. ``lead`` is the (table, time column) whose newest window counts,
    if it is not the table itself.
    """
    since = [] if span is None else [as_of - F.expr(f"interval {span}") - F.expr(f"interval {size}")]
    if not newest:
        return df.filter(F.col(ts) >= since[0])
    table, time = lead or (df, ts)
    first = F.max(time) - F.expr(f"interval {size}")
    bound = table.agg(F.least(first, *since) if since else first).scalar()
    return df.filter(F.col(ts) >= bound)


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[Column | str],
    aggs: Sequence[Column],
    watermark: str | None = None,
) -> DataFrame:
    """Aggregate per tumbling window and keys; the window stays a struct column.

    The built-in aggregates are combined before the shuffle, so a hot key costs
    one row per map task. On a stream the state is one row per open window and key.
    """
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    return df.groupBy(F.window(F.col(ts), size), *keys).agg(*aggs)


def flatten_window(df: DataFrame) -> DataFrame:
    """Window struct as two leading columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def tumbling_agg(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[Column | str],
    aggs: Sequence[Column],
    watermark: str | None = None,
) -> DataFrame:
    """Tumbling aggregate with ``window_start`` and ``window_end`` columns."""
    return flatten_window(windowed(df, ts, size, keys, aggs, watermark))
