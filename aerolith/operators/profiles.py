"""Most frequent and highest values, distinct counts and plain measures in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def mode_of(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value per key; ties go to the lowest value.

    Counting per (key, value) first keeps every step mergeable, so a key holding
    most rows, or very many values, never sits in one task's memory.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.col(value)).alias("_n"))
    best = F.min(F.when(F.col("_n") > 0, F.struct((-F.col("_n")).alias("_r"), F.col(value).alias("_v"))))
    return counts.groupBy(*keys).agg(best["_v"].alias(name))


# Names of the working columns of a profile.
_ROWS, _FIELD, _VALUE = "_profile_rows", "_profile_field", "_profile_value"


@dataclass(frozen=True)
class Measure:
    """A mergeable measure: partial columns with their merge, and the final value."""

    name: str
    partial: dict[str, tuple[Column, Callable]]
    final: Column


def _single(name: str, value: Column, merge: Callable, finish: Callable) -> Measure:
    part = f"_part_{name}"
    return Measure(name, {part: (value, merge)}, finish(merge(part)))


def _same(value: Column) -> Column:
    return value


def counted(name: str, condition: Column | None = None) -> Measure:
    number = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return _single(name, number, F.sum, lambda total: F.coalesce(total, F.lit(0)))


def summed(name: str, value: Column, finish: Callable = _same) -> Measure:
    return _single(name, F.sum(value), F.sum, finish)


def highest(name: str, value: Column, finish: Callable = _same) -> Measure:
    return _single(name, F.max(value), F.max, finish)


def lowest(name: str, value: Column, finish: Callable = _same) -> Measure:
    return _single(name, F.min(value), F.min, finish)


def averaged(name: str, value: Column, finish: Callable = _same) -> Measure:
    total, n = f"_part_{name}_total", f"_part_{name}_n"
    parts = {total: (F.sum(value), F.sum), n: (F.count(value), F.sum)}
    return Measure(name, parts, finish(F.sum(total) / F.nullif(F.sum(n), F.lit(0))))


def sketched(name: str, value: Column, lg_k: int = 12) -> Measure:
    """Approximate distinct count of non-null values, for where the exact one is too costly.

    The partial result is a sketch of at most 2^lg_k + 40 bytes, whatever the number of
    values; sketches of windows, cells or roll-up nodes merge. The relative standard
    error is about 1.04 / sqrt(2^lg_k), which is 1.6 % by default. No value gives 0.
    """
    part = f"_part_{name}"
    merged = F.hll_sketch_estimate(F.hll_union_agg(part))
    return Measure(name, {part: (F.hll_sketch_agg(value, lg_k), F.hll_union_agg)}, F.coalesce(merged, F.lit(0)))


def profile(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    modes: dict[str, str] | None = None,
    distinct: dict[str, str] | None = None,
    tops: dict[str, str] | None = None,
) -> DataFrame:
    """Measures, modes, distinct counts and highest texts per key from a single scan.

    ``modes``, ``distinct`` and ``tops`` map an output name to a column. Modes and
    tops need text columns, as values are compared in text order. Step one
    groups by the keys and all those columns (combined before the shuffle). Step
    two turns each column into (field, value) rows of the reduced data and adds
    up their counts; the measures travel on one extra row per group. Step three
    picks the winners. All steps merge partial results, none collects a group.
    """
    modes, distinct, tops = modes or {}, distinct or {}, tops or {}
    fields = sorted({*modes.values(), *distinct.values(), *tops.values()})
    other = [f for f in (*modes.values(), *tops.values()) if df.schema[f].dataType != StringType()]
    if other:
        raise TypeError(f"a profile takes modes and tops of text columns only, not of {other}")
    parts = {name: spec for m in measures for name, spec in m.partial.items()}

    tuples = df.groupBy(*keys, *fields).agg(
        F.count(F.lit(1)).alias(_ROWS), *[value.alias(name) for name, (value, _) in parts.items()]
    )

    types = dict(tuples.dtypes)
    no_text = F.lit(None).cast("string")
    carried = F.struct(no_text.alias(_FIELD), no_text.alias(_VALUE), *parts)
    blank = [F.lit(None).cast(types[p]).alias(p) for p in parts]
    entries = [
        F.struct(F.lit(f).alias(_FIELD), F.col(f).cast("string").alias(_VALUE), *blank) for f in fields
    ]
    long = tuples.select(*keys, _ROWS, F.inline(F.array(carried, *entries))).filter(
        F.col(_FIELD).isNull() | F.col(_VALUE).isNotNull()
    )
    merged = long.groupBy(*keys, _FIELD, _VALUE).agg(
        F.sum(_ROWS).alias(_ROWS), *[merge(name).alias(name) for name, (_, merge) in parts.items()]
    )

    def winner(field: str) -> Column:
        ranked = F.struct((-F.col(_ROWS)).alias("r"), F.col(_VALUE).alias("v"))
        return F.min(F.when(F.col(_FIELD) == field, ranked))["v"]

    return merged.groupBy(*keys).agg(
        *[m.final.alias(m.name) for m in measures],
        *[winner(f).alias(name) for name, f in modes.items()],
        *[F.count_if(F.col(_FIELD) == f).alias(name) for name, f in distinct.items()],
        *[F.max(F.when(F.col(_FIELD) == f, F.col(_VALUE))).alias(name) for name, f in tops.items()],
    )
