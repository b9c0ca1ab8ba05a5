"""Look-backs from a time tree of partial aggregates.

A tree keeps the mergeable parts of some measures per key for slots of five minutes,
for hours and for days; each level is added up from the one below. A span of time is
then covered by the fewest nodes: whole days, the hours that stick out at either end,
then the slots. Only what sticks out of the slots, less than one slot at either end, is
read from the events. The figures equal those of a direct aggregate of the span, up to the
order in which doubles are added.

The stored tree is partitioned by level and day, so a look-back opens a few folders. Its size follows
the number of keys and slots, not of events. Events without a time are in no node. An
empty table gives a tree without rows, and a look-back over all keys one row, as an aggregate does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.operators.profiles import Measure

# Level name and length in seconds, coarsest first; each length divides the one above.
LEVELS = (("day", 86400), ("hour", 3600), ("slot", 300))

_LEVEL, _DAY, _START = "node_level", "node_day", "node_start"


def floor_to(ts: Column, seconds: int) -> Column:
    """Start of the span of that length, counted from the epoch, that holds the time."""
    return F.timestamp_seconds(F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)) * seconds)


def ceil_to(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.ceil(F.unix_micros(ts) / F.lit(seconds * 1_000_000)) * seconds)


def _parts(measures: Sequence[Measure]) -> dict:
    return {name: spec for m in measures for name, spec in m.partial.items()}


def _raw_nodes(events: DataFrame, ts: str, keys: Sequence[str], measures: Sequence[Measure], seconds: int) -> DataFrame:
    parts = [value.alias(name) for name, (value, _) in _parts(measures).items()]
    timed = events.filter(F.col(ts).isNotNull()).withColumn(_START, floor_to(F.col(ts), seconds))
    return timed.groupBy(*keys, _START).agg(*parts)


def _merged(nodes: DataFrame, keys: Sequence[Column | str], measures: Sequence[Measure]) -> DataFrame:
    return nodes.groupBy(*keys).agg(*[merge(name).alias(name) for name, (_, merge) in _parts(measures).items()])


def store_tree(
    events: DataFrame, ts: str, keys: Sequence[str], measures: Sequence[Measure], path: str, levels=LEVELS
) -> DataFrame:
    """The tree of the events, written below ``path``. The events are read once, for the lowest level."""
    spark = events.sparkSession
    below = None
    for level, seconds in reversed(levels):
        if below is None:
            nodes = _raw_nodes(events, ts, keys, measures, seconds)
        else:
            upper = below.withColumn(_START, floor_to(F.col(_START), seconds))
            nodes = _merged(upper, [*keys, _START], measures)
        target = f"{path}/{_LEVEL}={level}"
        dated = nodes.withColumn(_DAY, F.to_date(_START))
        dated.repartition(_DAY).sortWithinPartitions(_DAY, _START).write.mode("overwrite").partitionBy(_DAY).parquet(target)
        below = spark.read.schema(dated.schema).parquet(target).drop(_DAY)
    return read_tree(events, ts, keys, measures, path, levels)


def read_tree(
    events: DataFrame, ts: str, keys: Sequence[str], measures: Sequence[Measure], path: str, levels=LEVELS
) -> DataFrame:
    """A stored tree; the other arguments say what it was built from."""
    shape = _raw_nodes(events, ts, keys, measures, levels[-1][1]).schema
    shape = shape.add(_LEVEL, "string").add(_DAY, "date")
    return events.sparkSession.read.schema(shape).parquet(path)


def cover(
    tree: DataFrame,
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    since: Column,
    until: Column,
    levels=LEVELS,
) -> DataFrame:
    """Nodes that make up the times from ``since`` to before ``until``: keys, start and partial results.

    ``levels`` may leave out coarse levels, where nodes must lie within an hour.
    Both bounds should be literals, so that they choose folders.
    """
    pieces, inner = [], None
    for level, seconds in levels:
        low, high = ceil_to(since, seconds), floor_to(until, seconds)
        start = F.col(_START)
        taken = (start >= low) & (start < high)
        days = F.col(_DAY).between(F.to_date(low), F.to_date(high))
        if inner is not None:
            taken = taken & ~((start >= inner[0]) & (start < inner[1]))
        pieces.append(tree.filter((F.col(_LEVEL) == level) & days & taken))
        inner = (low, high)
    time = F.col(ts)
    edges = events.filter((time >= since) & (time < until) & ((time < inner[0]) | (time >= inner[1])))
    nodes = _raw_nodes(edges, ts, keys, measures, levels[-1][1])
    return reduce(DataFrame.unionByName, [p.select(*nodes.columns) for p in pieces], nodes)


def look_back(
    tree: DataFrame,
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    since: Column,
    until: Column,
) -> DataFrame:
    """Measures per key over the times from ``since`` to before ``until``."""
    nodes = cover(tree, events, ts, keys, measures, since, until)
    return nodes.groupBy(*keys).agg(*[m.final.alias(m.name) for m in measures])


def hourly(
    tree: DataFrame,
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    since: Column,
    until: Column,
) -> DataFrame:
    """Measures per key and hour of the span; hours at its ends count the part inside."""
    nodes = cover(tree, events, ts, keys, measures, since, until, LEVELS[1:])
    hour = F.date_trunc("hour", F.col(_START)).alias("hour")
    return nodes.groupBy(*keys, hour).agg(*[m.final.alias(m.name) for m in measures])
