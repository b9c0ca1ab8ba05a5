"""Joins: dimension lookups, window and cell joins, lateral top-1, substring join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from aerolith.operators.keyed import first_per_key
from aerolith.session import fresh_path

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows in memory: fixed widths plus the real text lengths."""
    width = F.lit(_ROW_OVERHEAD + 8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(field.name)))), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only after the side has been measured.

    Meant for reduced dimensions (aggregates, distinct keys), whose size the
    optimizer cannot tell. A larger side is returned unhinted: the join then
    shuffles and adaptive execution splits its hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit_bytes else df


def settled(df: DataFrame, name: str) -> DataFrame:
    """A reduced side written to the shared folder and read back.

    For sides that are costly to work out: they are computed once, and the
    optimizer then broadcasts them or not by the size of their files.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    cols: dict[str, str] | None = None,
    how: str = "left",
    small: bool = False,
) -> DataFrame:
    """Equi join of a fact with selected, renamed columns of a dimension.

    ``small`` asks for a measured broadcast. Without it Spark decides from the
    file sizes. Duplicate dimension keys fan out, as a join does.
    """
    if cols is not None:
        dim = dim.select(*on, *[F.col(source).alias(name) for name, source in cols.items()])
    return fact.join(broadcast_if_small(dim) if small else dim, list(on), how)


def lookup_union(dim: DataFrame, codes: Sequence[str], key: str) -> DataFrame:
    """One keyed row per record: its first code that is present, others unused.

    Equal to a union of one branch per code where a branch only takes records
    without any earlier code, but reads the dimension once.
    """
    chosen = F.coalesce(*[F.col(c) for c in codes])
    return dim.withColumn(key, chosen).filter(F.col(key).isNotNull())


def top1_lateral(
    left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Left join with the first right row per key (LATERAL ... LIMIT 1)."""
    return left.join(first_per_key(right, on, order), list(on), "left")


def window_grid_join(
    facts: DataFrame,
    sides: Sequence[DataFrame],
    keys: Sequence[str] = ("window", "grid_lat", "grid_lon"),
    fill: dict | None = None,
) -> DataFrame:
    """Left join of per-window, per-cell aggregates; missing sides take ``fill``.

    Every input is reduced to one row per key first, so no key is hot here.
    """
    out = facts
    for side in sides:
        out = out.join(side, list(keys), "left")
    for name, value in (fill or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def _substrings(text: Column, lengths: Sequence[int], needed: Column) -> Column:
    """Distinct substrings of those lengths that some code needs; '' is the anchor of bare wildcards."""
    size, none = F.length(text), F.array().cast("array<string>")
    parts = [F.when(F.array_contains(needed, 0), F.array(F.lit(""))).otherwise(none)]
    for n in lengths:
        starts = F.when(size >= n, F.sequence(F.lit(1), size - (n - 1))).otherwise(F.array().cast("array<int>"))
        parts.append(F.when(F.array_contains(needed, n), F.transform(starts, _cut(text, n))).otherwise(none))
    return F.array_distinct(F.concat(*parts))


def _cut(text: Column, n: int):
    return lambda start: F.substring(text, start, F.lit(n))


def contains_join(
    left: DataFrame, text: str, right: DataFrame, code: str, lengths: Sequence[int] = (1, 2, 3)
) -> DataFrame:
    """Pairs with ``text LIKE '%' || code || '%'``, as an equi join.

    Each code gets an anchor: the start of its longest run without wildcards, cut
    to the longest of ``lengths``. Each text offers its substrings of those
    lengths, the pairs meet on the anchor, and LIKE settles the rest. Exact for
    any code, with or without wildcards; plain short codes need no second test. A
    backslash in a code stands for itself. Only anchor lengths that occur among
    the codes are offered.
    """
    longest = max(lengths)
    runs = F.split(F.col(code), r"[%_\\]+")
    best = F.reduce(runs, F.lit(""), lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a))
    anchor = F.substring(best, 1, longest)
    if set(lengths) != set(range(1, longest + 1)):
        # only whole lengths are offered: fall back to the longest one that fits
        fitting = [F.when(F.length(anchor) >= n, F.substring(anchor, 1, n)) for n in sorted(lengths, reverse=True)]
        anchor = F.coalesce(*fitting, F.lit(""))
    codes = right.filter(F.col(code).isNotNull()).withColumn("_anchor", anchor)
    needed = codes.agg(F.collect_set(F.length("_anchor"))).scalar()
    texts = left.filter(F.col(text).isNotNull()).withColumn(
        "_anchor", F.explode(_substrings(F.col(text), lengths, needed))
    )
    joined = texts.join(codes, "_anchor")
    plain = F.replace(F.col(code), F.lit("\\"), F.lit("\\\\"))
    pattern = F.concat(F.lit("%"), plain, F.lit("%"))
    whole = F.col("_anchor") == F.col(code)
    return joined.filter(whole | F.like(F.col(text), pattern)).drop("_anchor")


def contains_counts(
    left: DataFrame, text: str, right: DataFrame, code: str, lengths: Sequence[int] = (1, 2, 3)
) -> DataFrame:
    """Number of left rows containing each code, without emitting the pairs.

    Equal texts are counted first, so a text shared by a third of all rows costs
    one probe. The distinct codes are settled, as they are read twice.
    """
    texts = left.filter(F.col(text).isNotNull()).groupBy(text).agg(F.count(F.lit(1)).alias("_weight"))
    codes = settled(right.select(code).distinct(), "codes")
    pairs = contains_join(texts, text, codes, code, lengths)
    return pairs.groupBy(code).agg(F.sum("_weight").alias("matches"))
