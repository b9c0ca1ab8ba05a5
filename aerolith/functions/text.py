"""Text rules: the four ways a place string names its region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REGION_VARIANTS = ("first_comma", "last_separator", "last_comma", "greedy")


def region_of(place: Column, variant: str = "last_comma") -> Column:
    """Region part of a place such as ``'12 km N of A, B'``.

    first_comma     text after the first comma if ', ' occurs, else the place as is
    last_separator  text after the last ', ', else the place, 'unknown' if empty
    last_comma      text after the last comma if ', ' occurs, else the trimmed place
    greedy          everything up to the last comma and its blanks removed, untrimmed
    """
    listed = place.contains(", ")
    if variant == "first_comma":
        tail = F.trim(F.substring(place, F.locate(",", place) + 1, F.length(place)))
        return F.when(listed, tail).otherwise(place)
    if variant == "last_separator":
        tail = F.trim(F.substring_index(place, ", ", -1))
        return F.when(listed, tail).otherwise(F.coalesce(F.nullif(place, F.lit("")), F.lit("unknown")))
    if variant == "last_comma":
        return F.trim(F.when(listed, F.substring_index(place, ",", -1)).otherwise(place))
    if variant == "greedy":
        return F.regexp_replace(place, r"^.*,\s*", "")
    raise ValueError(f"variant must be one of {REGION_VARIANTS}")


def one_decimal(value: Column) -> Column:
    """Text with one decimal, rounded from the exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form instead, which gives 0.3
    for 0.25 and 0.2 for 0.15. Here the fraction is scaled by a power of two, so
    nothing is lost before the tenth is decided.
    """
    bits = 59
    size = F.abs(value)
    whole = F.floor(size).cast("bigint")
    scaled = ((size - whole) * float(2**bits)).cast("bigint") * 10
    tenth, rest = F.shiftright(scaled, bits), scaled.bitwiseAND(2**bits - 1)
    half = 2 ** (bits - 1)
    up = (rest > half) | ((rest == half) & (tenth % 2 == 1))
    tenths = whole * 10 + tenth + up.cast("bigint")
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def snapshot_id(lat: Column, lon: Column, epoch_s: Column) -> Column:
    """Dedupe key: first 16 hex digits of md5 over place and 15-minute slot."""
    slot = F.floor(epoch_s / 900).cast("bigint")
    key = F.concat_ws(":", one_decimal(lat), one_decimal(lon), slot.cast("string"))
    return F.substring(F.md5(key), 1, 16)
