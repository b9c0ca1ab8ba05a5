"""The windowed aggregates. Every function serves batch and streaming input.

``exact`` is the event-time form, in which missing values are skipped.
``incremental`` is the variant that fills in missing values while it adds up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import geo
from aerolith.functions.casting import nan_to_null
from aerolith.functions.text import region_of
from aerolith.operators.joins import window_grid_join
from aerolith.operators.windows import WINDOW, flatten_window, tumbling_agg, windowed

# How long each feed waits for late rows.
SEISMIC_DELAY = "30 seconds"
WEATHER_DELAY = "60 seconds"
CONTEXT_DELAY = "60 seconds"


# --- one feed per window and dimension -------------------------------------------------


def flight_tumbling(
    flights: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """Traffic per country. A NULL ground flag counts as not airborne, a NULL country is a group."""
    aggs = [
        F.count(F.lit(1)).alias("flight_count"),
        F.count_if(~F.col("on_ground")).alias("airborne_count"),
        F.avg(nan_to_null(F.col("baro_altitude"))).alias("avg_altitude_m"),
        F.avg(nan_to_null(F.col("velocity"))).alias("avg_velocity_ms"),
    ]
    return tumbling_agg(flights, ts, size, ["origin_country"], aggs, watermark)


def seismic_tumbling(
    seismics: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """Quakes per region, the text after the first comma of the place."""
    aggs = [
        F.avg(nan_to_null(F.col("mag"))).alias("avg_magnitude"),
        F.max(nan_to_null(F.col("mag"))).alias("max_magnitude"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum("tsunami").alias("tsunami_count"),
        F.avg(nan_to_null(F.col("depth"))).alias("avg_depth"),
    ]
    region = region_of(F.col("place"), "first_comma").alias("region")
    return tumbling_agg(seismics, ts, size, [region], aggs, watermark)


def weather_tumbling(
    weather: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None, value=nan_to_null
) -> DataFrame:
    """Weather per region name. ``value`` says how a reading is taken before aggregation."""

    def v(name: str) -> Column:
        return value(F.col(name))

    aggs = [
        F.avg(v("temperature_c")).alias("avg_temperature_c"),
        F.min(v("temperature_c")).alias("min_temperature_c"),
        F.max(v("temperature_c")).alias("max_temperature_c"),
        F.avg(v("windspeed_ms")).alias("avg_windspeed_ms"),
        F.avg(v("windgusts_ms")).alias("avg_windgusts_ms"),
        F.avg(v("visibility_m")).alias("avg_visibility_m"),
        F.avg(v("humidity_pct")).alias("avg_humidity_pct"),
        F.sum(v("precipitation_mm")).alias("total_precip_mm"),
        F.count(F.lit(1)).alias("snapshot_count"),
    ]
    return tumbling_agg(weather, ts, size, ["region_name"], aggs, watermark)


def zero_if_missing(value: Column) -> Column:
    """NULL and NaN readings count as 0.0."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def seen_airborne(on_ground: Column) -> Column:
    """Airborne unless the flag is set; an empty flag counts as airborne."""
    return F.coalesce(~on_ground, F.lit(True))


def flight_tumbling_incremental(
    flights: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """Traffic per known country; meant for update mode, one row per changed window."""
    aggs = [
        F.count(F.lit(1)).alias("flight_count"),
        F.count_if(seen_airborne(F.col("on_ground"))).alias("airborne_count"),
        F.avg(nan_to_null(F.col("baro_altitude"))).alias("avg_altitude_m"),
        F.avg(nan_to_null(F.col("velocity"))).alias("avg_velocity_ms"),
    ]
    known = flights.filter(F.col("origin_country").isNotNull())
    return tumbling_agg(known, ts, size, ["origin_country"], aggs, watermark)


def seismic_tumbling_incremental(
    seismics: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """Quakes per region after the last ', '; missing values count as 0, the maximum starts at 0."""
    mag, depth = zero_if_missing(F.col("mag")), zero_if_missing(F.col("depth"))
    aggs = [
        F.avg(mag).alias("avg_magnitude"),
        F.greatest(F.max(mag), F.lit(0.0)).alias("max_magnitude"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.coalesce(F.col("tsunami"), F.lit(0))).alias("tsunami_count"),
        F.avg(depth).alias("avg_depth"),
    ]
    region = region_of(F.col("place"), "last_separator").alias("region")
    return tumbling_agg(seismics, ts, size, [region], aggs, watermark)


def weather_tumbling_incremental(
    weather: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None
) -> DataFrame:
    """Weather per known region name; missing readings count as 0.0."""
    known = weather.filter(F.col("region_name").isNotNull())
    return weather_tumbling(known, ts, size, watermark, value=zero_if_missing)


# --- flights in the context of quakes and weather of their window and cell ---------------


def flights_by_cell(
    flights: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None, incremental: bool = False
) -> DataFrame:
    """Located flights per window and cell."""
    located = flights.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    altitude, airborne = nan_to_null(F.col("baro_altitude")), ~F.col("on_ground")
    if incremental:
        altitude, airborne = F.when(altitude != 0, altitude), seen_airborne(F.col("on_ground"))
    aggs = [
        F.count(F.lit(1)).alias("flight_count"),
        F.count_if(airborne).alias("airborne_count"),
        F.avg(altitude).alias("avg_altitude_m"),
    ]
    return _by_cell(located, "latitude", "longitude", ts, size, aggs, watermark)


def seismics_by_cell(
    seismics: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None, incremental: bool = False
) -> DataFrame:
    mag, tsunami = nan_to_null(F.col("mag")), F.col("tsunami")
    if incremental:
        mag, tsunami = F.greatest(zero_if_missing(F.col("mag")), F.lit(0.0)), F.coalesce(tsunami, F.lit(0))
        seismics = seismics.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    aggs = [
        F.count(F.lit(1)).alias("nearby_eq_count"),
        F.max(mag).alias("max_eq_magnitude"),
        F.sum(tsunami).alias("tsunami_count"),
    ]
    return _by_cell(seismics, "lat", "lon", ts, size, aggs, watermark)


def weather_by_cell(
    weather: DataFrame, ts: str, size: str = WINDOW, watermark: str | None = None, incremental: bool = False
) -> DataFrame:
    value = nan_to_null
    if incremental:
        value = zero_if_missing
        weather = weather.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    aggs = [
        F.avg(value(F.col(name))).alias(f"avg_{name}")
        for name in ("temperature_c", "windgusts_ms", "visibility_m")
    ]
    return _by_cell(weather, "latitude", "longitude", ts, size, aggs, watermark)


def _by_cell(df, lat, lon, ts, size, aggs, watermark):
    cell_lat, cell_lon = geo.grid_cell(F.col(lat), F.col(lon))
    return windowed(df, ts, size, [cell_lat.alias("grid_lat"), cell_lon.alias("grid_lon")], aggs, watermark)


def event_or_arrival(event: Column, arrival: Column) -> Column:
    """Event time, or the arrival time for records whose event time is 0 or missing."""
    return F.coalesce(F.nullif(event, F.timestamp_seconds(F.lit(0))), arrival)


# What a window without quakes or weather shows.
QUAKE_FILL = {"nearby_eq_count": 0, "max_eq_magnitude": 0.0, "tsunami_count": 0}
WEATHER_FILL = {"avg_temperature_c": 0.0, "avg_windgusts_ms": 0.0, "avg_visibility_m": 0.0}


def flight_context(
    flights: DataFrame,
    seismics: DataFrame,
    weather: DataFrame,
    flight_ts: str,
    seismic_ts: str,
    weather_ts: str,
    size: str = WINDOW,
    watermarks: tuple[str | None, str | None, str | None] = (None, None, None),
    incremental: bool = False,
    arrivals: tuple[str | None, str | None, str | None] = (None, None, None),
) -> DataFrame:
    """Flights per window and cell, with the quakes and weather of the same window and cell.

    All three inputs are aggregated before they meet. On streams this needs a
    watermark on each input and append mode: a row appears once all three have
    passed the end of its window. The incremental form leaves missing weather NULL.
    ``arrivals`` name the arrival times of the inputs: a record whose event time
    is 0 or missing then falls into the window of its arrival.
    """
    flights, seismics, weather = (
        df.withColumn(ts, event_or_arrival(F.col(ts), F.col(arrival))) if arrival else df
        for df, ts, arrival in zip((flights, seismics, weather), (flight_ts, seismic_ts, weather_ts), arrivals)
    )
    facts = flights_by_cell(flights, flight_ts, size, watermarks[0], incremental)
    quakes = seismics_by_cell(seismics, seismic_ts, size, watermarks[1], incremental)
    readings = weather_by_cell(weather, weather_ts, size, watermarks[2], incremental)
    fill = QUAKE_FILL if incremental else {**QUAKE_FILL, **WEATHER_FILL}
    joined = flatten_window(window_grid_join(facts, [quakes, readings], fill=fill))
    return joined.select(
        "window_start", "window_end", "grid_lat", "grid_lon", "flight_count", "airborne_count",
        "avg_altitude_m", *QUAKE_FILL, *WEATHER_FILL,
    )
