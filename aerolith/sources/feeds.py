"""Wire forms of the three feeds to typed records.

Messages are parsed to VARIANT, which keeps the difference between a JSON
number and a JSON string: 3.7 truncates to the integer 3, "3.7" does not parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.text import snapshot_id

# Position of each field in an aircraft state array.
STATE_INDEX = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "true_track": 10,
    "category": 17,
}
SHORTEST_STATE = 11

# Weather record field and its name in the wire message.
WEATHER_FIELDS = {
    "weathercode": "weathercode",
    "interval_s": "interval",
    "windspeed_ms": "windspeed_10m",
    "winddirection_deg": "winddirection_10m",
    "windgusts_ms": "windgusts_10m",
    "precipitation_mm": "precipitation",
    "rain_mm": "rain",
    "snowfall_cm": "snowfall",
    "showers_mm": "showers",
    "snow_depth_m": "snow_depth",
    "cloudcover_pct": "cloudcover",
    "cloudcover_low_pct": "cloudcover_low",
    "temperature_c": "temperature_2m",
    "apparent_temperature_c": "apparent_temperature",
    "humidity_pct": "relativehumidity_2m",
    "visibility_m": "visibility",
    "pressure_hpa": "surface_pressure",
}
WHOLE_NUMBERS = {"weathercode", "interval_s"}


def parsed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with their body as a variant; unreadable ones are dropped."""
    return messages.withColumn("_doc", F.try_parse_json(F.col(value).cast("string"))).filter(
        F.col("_doc").isNotNull()
    )


def _get(doc: Column, path: str, to: str) -> Column:
    return F.try_variant_get(doc, path, to)


def _is_object(doc: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(_get(doc, path, "variant")).startswith("OBJECT"), F.lit(False))


def _number(doc: Column, path: str, to: str, default) -> Column:
    return F.coalesce(_get(doc, path, to), F.lit(default).cast(to))


def _text(doc: Column, path: str, if_empty: str) -> Column:
    return F.coalesce(F.nullif(_get(doc, path, "string"), F.lit("")), F.lit(if_empty))


def _boolean(doc: Column, path: str) -> Column:
    """False for null, false, zero and ''; true for anything else, also 'False'."""
    kind = F.schema_of_variant(_get(doc, path, "variant"))
    return F.coalesce(
        F.when(kind == "STRING", _get(doc, path, "string") != "")
        .when(kind == "BOOLEAN", _get(doc, path, "boolean"))
        .when(kind == "VOID", F.lit(False))
        .otherwise(_get(doc, path, "double") != 0),
        F.lit(False),
    )


def _endless(doc: Column, path: str) -> Column:
    """A numeric infinity has no integer value, so its record is dropped."""
    kind = F.schema_of_variant(_get(doc, path, "variant"))
    infinite = F.abs(_get(doc, path, "double")) == float("inf")
    return F.coalesce((kind != "STRING") & infinite, F.lit(False))


def parse_state_vectors(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per aircraft state, with the snapshot time as ``snapshot_ts``."""
    docs = parsed(messages, value)
    state = F.col("_s")
    path = {name: f"$[{i}]" for name, i in STATE_INDEX.items()}
    whole = ("time_position", "last_contact", "category")
    rows = docs.select(
        _get(F.col("_doc"), "$.time", "bigint").alias("snapshot_ts"),
        F.explode(_get(F.col("_doc"), "$.states", "array<variant>")).alias("_s"),
    ).filter(F.size(_get(state, "$", "array<variant>")) >= SHORTEST_STATE)
    for name in whole:
        rows = rows.filter(~_endless(state, path[name]))
    floats = ("longitude", "latitude", "baro_altitude", "velocity", "true_track")
    strip = r"^\s+|\s+$"
    return rows.select(
        F.coalesce(_get(state, path["icao24"], "string"), F.lit("None")).alias("icao24"),
        F.regexp_replace(_text(state, path["callsign"], ""), strip, "").alias("callsign"),
        _text(state, path["origin_country"], "unknown").alias("origin_country"),
        _number(state, path["time_position"], "bigint", 0).alias("time_position"),
        _number(state, path["last_contact"], "bigint", 0).alias("last_contact"),
        *[_number(state, path[c], "double", 0.0).alias(c) for c in floats[:3]],
        _boolean(state, path["on_ground"]).alias("on_ground"),
        *[_number(state, path[c], "double", 0.0).alias(c) for c in floats[3:]],
        _number(state, path["category"], "int", 0).alias("category"),
        _get(state, path["time_position"], "bigint").alias("position_ts"),
        "snapshot_ts",
    )


def parse_quakes(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per quake feature; features without properties or coordinates are dropped."""
    feature = F.col("_f")
    rows = parsed(messages, value).select(
        F.explode(_get(F.col("_doc"), "$.features", "array<variant>")).alias("_f")
    )
    shaped = _is_object(feature, "$.properties") & (
        F.size(_get(feature, "$.geometry.coordinates", "array<variant>")) >= 3
    )
    rows = rows.filter(shaped)
    for name in ("tsunami", "time", "sig"):
        rows = rows.filter(~_endless(feature, f"$.properties.{name}"))
    return rows.select(
        _number(feature, "$.properties.mag", "double", 0.0).alias("mag"),
        _text(feature, "$.properties.magType", "unknown").alias("mag_type"),
        _text(feature, "$.properties.place", "unknown").alias("place"),
        _number(feature, "$.properties.tsunami", "int", 0).alias("tsunami"),
        _number(feature, "$.properties.time", "bigint", 0).alias("event_time"),
        _text(feature, "$.properties.type", "unknown").alias("event_type"),
        _text(feature, "$.properties.title", "").alias("title"),
        _number(feature, "$.properties.sig", "int", 0).alias("sig"),
        _number(feature, "$.geometry.coordinates[1]", "double", 0.0).alias("lat"),
        _number(feature, "$.geometry.coordinates[0]", "double", 0.0).alias("lon"),
        _number(feature, "$.geometry.coordinates[2]", "double", 0.0).alias("depth"),
        _get(feature, "$.id", "string").alias("feature_id"),
    )


def parse_weather(
    messages: DataFrame,
    captured: Column,
    lat: str = "latitude",
    lon: str = "longitude",
    region: str = "region_name",
    value: str = "value",
) -> DataFrame:
    """Flat weather readings; place and name come with the message, the clock is ``captured``."""
    doc = F.col("_doc")
    rows = parsed(messages, value).filter(_is_object(doc, "$.current"))
    for name in WHOLE_NUMBERS:
        rows = rows.filter(~_endless(doc, f"$.current.{WEATHER_FIELDS[name]}"))
    clock = captured.cast("bigint")
    readings = [
        _number(doc, f"$.current.{wire}", *(("int", 0) if name in WHOLE_NUMBERS else ("double", 0.0))).alias(name)
        for name, wire in WEATHER_FIELDS.items()
    ]
    return rows.select(
        snapshot_id(F.col(lat), F.col(lon), clock).alias("snapshot_id"),
        F.col(region).alias("region_name"),
        F.col(lat).alias("latitude"),
        F.col(lon).alias("longitude"),
        _number(doc, "$.elevation", "double", 0.0).alias("elevation_m"),
        *readings,
        clock.alias("snapshot_ts"),
    )
