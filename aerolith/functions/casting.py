"""Tolerant casts, decimal rounding and epoch conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NOISE_DIGITS = 6


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding of a double, ties away from zero.

    Spark rounds the decimal form of a double. Rounding to six digits first takes
    away the noise that the order of a sum leaves behind, so a tie stays a tie.
    """
    settled = F.round(value.cast("double"), NOISE_DIGITS)
    return settled if digits >= NOISE_DIGITS else F.round(settled, digits)


def round_once(value: Column, digits: int) -> Column:
    """Decimal rounding of a single value, ties away from zero, in one step."""
    return F.round(value.cast("double"), digits)


def rounded(digits: int):
    """Rounding to some decimals, as a function of the value."""
    return lambda value: round_half_up(value, digits)


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def safe_cast(value: Column, to: str, default) -> Column:
    """Cast that falls back to ``default`` on NULL or unreadable input.

    A fractional number cast to an integer truncates, a fractional *string*
    does not parse and gives the default. NaN stays NaN for floats.
    """
    return F.coalesce(value.try_cast(to), F.lit(default).cast(to))


def truthy(value: Column, is_text: bool = False) -> Column:
    """Boolean of any value: NULL, zero and '' are false, every other text is true."""
    zero = F.lit("") if is_text else F.lit(0)
    if not is_text:
        value = value.cast("double")
    return F.coalesce(value != zero, F.lit(False))


def coerce_numeric(value: Column, fill: float) -> Column:
    """Numeric reading of any column, with unreadable, NULL and NaN replaced."""
    return F.coalesce(F.nanvl(value.try_cast("double"), F.lit(None).cast("double")), F.lit(float(fill)))


def nan_to_null(value: Column) -> Column:
    """NaN would poison averages, so it is treated as missing."""
    return F.when(~F.isnan(value), value)


def epoch_to_ts(value: Column, unit: str = "s", zero_is_null: bool = False) -> Column:
    """Epoch seconds or milliseconds to a timestamp."""
    if unit not in ("s", "ms"):
        raise ValueError(f"unknown epoch unit {unit!r}")
    seconds = value.cast("bigint")
    ts = F.timestamp_seconds(seconds) if unit == "s" else F.timestamp_millis(seconds)
    return F.when(seconds != 0, ts) if zero_is_null else ts


def ts_label(ts: Column) -> Column:
    """Readable UTC label of a timestamp."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
