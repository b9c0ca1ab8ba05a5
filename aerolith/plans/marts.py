"""Marts: flight activity, flight context, seismic activity, weather conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions import rules
from aerolith.functions.casting import round_half_up, rounded
from aerolith.operators.joins import top1_lateral
from aerolith.operators.keyed import first_per_key, latest_window, recent
from aerolith.operators.profiles import averaged, counted, highest, lowest, profile, summed
from aerolith.plans.staging import stamped


def in_phase(phase: str) -> Column:
    return F.col("flight_phase") == phase


def flight_activity(
    enriched: DataFrame, tumbling: DataFrame, as_of: Column, refreshed: Column | None = None
) -> DataFrame:
    """Live traffic per country and continent, its latest window and two hours of history.

    The window and history columns belong to the country and repeat per continent.
    """
    cell = F.concat_ws("_", F.col("grid_lat").cast("string"), F.col("grid_lon").cast("string"))
    live = profile(
        enriched.filter(F.col("origin_country").isNotNull())
        .withColumn("_cell", F.when(F.col("grid_lat").isNotNull() & F.col("grid_lon").isNotNull(), cell))
        .withColumnRenamed("current_continent", "continent"),
        ["origin_country", "continent"],
        [
            counted("live_flight_count"),
            counted("live_airborne_count", ~F.col("on_ground")),
            counted("live_on_ground_count", F.col("on_ground")),
            counted("cruising_count", in_phase("cruising")),
            counted("climb_descend_count", in_phase("climbing_descending")),
            counted("takeoff_landing_count", in_phase("takeoff_landing")),
            averaged("avg_altitude_m", F.col("baro_altitude_m"), rounded(1)),
            averaged("avg_speed_knots", F.col("velocity_knots"), rounded(1)),
            highest("max_speed_knots", F.col("velocity_knots"), rounded(1)),
            highest("max_altitude_m", F.col("baro_altitude_m"), rounded(1)),
            counted("flights_near_airport", F.col("near_airport")),
        ],
        modes={"most_common_airport": "nearest_airport_name", "most_common_city": "nearest_airport_city"},
        distinct={"active_grid_cells": "_cell"},
        tops={name: name for name in ("airline_name", "airline_iata", "airline_icao")},
    )
    share = F.col("flights_near_airport") / F.nullif(F.col("live_flight_count"), F.lit(0)) * 100
    newest = latest_window(tumbling, bounded=True).select(
        "origin_country",
        F.col("window_start").alias("last_window_start"),
        F.col("window_end").alias("last_window_end"),
        F.col("flight_count").alias("window_flight_count"),
        round_half_up(F.col("avg_velocity_ms"), 2).alias("window_avg_velocity_ms"),
    )
    history = (
        recent(tumbling, "window_end", "2 hours", as_of)
        .groupBy("origin_country")
        .agg(
            F.max("flight_count").alias("peak_flights_2h"),
            F.min("flight_count").alias("min_flights_2h"),
            round_half_up(F.avg("flight_count"), 1).alias("avg_flights_2h"),
        )
    )
    out = (
        live.withColumn("pct_near_airport", round_half_up(share, 1))
        .join(newest, "origin_country", "left")
        .join(history, "origin_country", "left")
    )
    return stamped(out, "refreshed_at", refreshed).orderBy(
        F.desc("live_flight_count"), "origin_country", "continent"
    )


def weather_by_grid(weather: DataFrame) -> DataFrame:
    """Staged weather per cell."""
    return profile(
        weather,
        ["grid_lat", "grid_lon"],
        [
            averaged("avg_visibility_m", F.col("visibility_m"), rounded(0)),
            averaged("avg_precip_mm", F.col("precipitation_mm"), rounded(2)),
            averaged("avg_temp_c", F.col("temperature_c"), rounded(2)),
            averaged("avg_windgusts_ms", F.col("windgusts_ms"), rounded(2)),
        ],
        modes={"wind_severity": "wind_severity", "weather_label": "weather_label"},
    )


def flights_by_grid(enriched: DataFrame) -> DataFrame:
    """Live flights per cell with the prevailing airport, airline and continent."""
    return profile(
        enriched,
        ["grid_lat", "grid_lon"],
        [
            counted("live_flight_count"),
            counted("cruising_count", in_phase("cruising")),
            counted("climb_descend_count", in_phase("climbing_descending")),
            counted("takeoff_landing_count", in_phase("takeoff_landing")),
            counted("near_airport_count", F.col("near_airport")),
            averaged("avg_speed_knots", F.col("velocity_knots"), rounded(1)),
            highest("max_altitude_m", F.col("baro_altitude_m"), rounded(1)),
        ],
        modes={
            "primary_airport_name": "nearest_airport_name",
            "primary_airport_iata": "nearest_airport_iata",
            "primary_airport_city": "nearest_airport_city",
            "primary_airport_country": "nearest_airport_country",
            "primary_airport_timezone": "nearest_airport_timezone",
            "continent": "current_continent",
            "dominant_airline": "airline_name",
        },
        distinct={"distinct_airlines": "airline_iata"},
    )


def quakes_by_grid(seismics: DataFrame, as_of: Column) -> DataFrame:
    """Quakes of the last 24 hours per cell."""
    return (
        recent(seismics, "event_time", "24 hours", as_of)
        .groupBy("grid_lat", "grid_lon")
        .agg(
            F.count(F.lit(1)).alias("eq_count_24h"),
            round_half_up(F.max("mag"), 2).alias("max_mag_24h"),
            F.count_if("is_tsunami_related").alias("tsunami_count_24h"),
            round_half_up(F.avg("mag"), 2).alias("avg_mag_24h"),
        )
    )


def flight_context(
    context: DataFrame,
    enriched: DataFrame,
    weather: DataFrame,
    seismics: DataFrame,
    as_of: Column,
    refreshed: Column | None = None,
) -> DataFrame:
    """Newest context window per cell with live flights, weather, quakes and a risk score.

    Every side is reduced to one row per cell before it joins. The sides leave their
    aggregation partitioned by cell, so the joins add no shuffle of their own. The
    newest window holds a row per cell of the globe at most and is worked out once; the
    mean over all cells is taken over these rows.
    """
    newest = latest_window(context, bounded=True)
    mean_flights = F.avg("flight_count").over(Window.partitionBy())
    cell = ["grid_lat", "grid_lon"]
    live = flights_by_grid(enriched).drop("live_flight_count")
    sky = weather_by_grid(weather).select(
        *cell, "wind_severity", "weather_label", "avg_precip_mm", F.col("avg_visibility_m").alias("_visibility")
    )
    quakes = quakes_by_grid(seismics, as_of).drop("avg_mag_24h")
    joined = newest.withColumn("_mean_flights", mean_flights).filter(F.col("flight_count") > 0)
    for side in (live, sky, quakes):
        joined = joined.join(side, cell, "left")
    out = (
        joined.withColumns(
            {
                "ground_count": F.col("flight_count") - F.col("airborne_count"),
                "avg_altitude_m": round_half_up(F.col("avg_altitude_m"), 1),
                "avg_temperature_c": round_half_up(F.col("avg_temperature_c"), 2),
                "avg_windgusts_ms": round_half_up(F.col("avg_windgusts_ms"), 2),
                "avg_visibility_m": round_half_up(F.col("avg_visibility_m"), 0),
                "eq_count_24h": F.coalesce("eq_count_24h", F.lit(0)),
                "max_mag_24h": F.coalesce("max_mag_24h", F.lit(0.0)),
                "tsunami_count_24h": F.coalesce("tsunami_count_24h", F.lit(0)),
            }
        )
        .withColumn(
            "risk_score",
            rules.risk_score(
                F.col("flight_count"), F.col("_mean_flights"), F.col("max_mag_24h"),
                F.col("wind_severity"), F.col("_visibility"),
            ),
        )
        .drop("_mean_flights", "_visibility")
    )
    return stamped(out, "refreshed_at", refreshed).orderBy(F.desc("airborne_count"), *cell)


# Magnitude classes counted per region, by output column.
_CLASS_COUNTS = {
    "micro_count": ["micro"],
    "minor_count": ["minor"],
    "light_count": ["light"],
    "moderate_count": ["moderate"],
    "strong_count": ["strong"],
    "major_great_count": ["major", "great"],
}


def region_stats(events: DataFrame) -> DataFrame:
    named = events.filter(F.col("region").isNotNull() & (F.col("region") != ""))
    return named.groupBy("region").agg(
        F.count(F.lit(1)).alias("event_count_24h"),
        round_half_up(F.avg("mag"), 2).alias("avg_magnitude"),
        round_half_up(F.max("mag"), 2).alias("max_magnitude"),
        round_half_up(F.min("mag"), 2).alias("min_magnitude"),
        round_half_up(F.avg("depth_km"), 2).alias("avg_depth_km"),
        F.count_if("is_tsunami_related").alias("tsunami_events"),
        *[
            F.count_if(F.col("magnitude_class").isin(classes)).alias(name)
            for name, classes in _CLASS_COUNTS.items()
        ],
    )


def seismic_hourly(events: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Events per hour and magnitude class, over all regions unless ``keys`` says so."""
    hour = F.date_trunc("hour", "event_time").alias("hour")
    return events.groupBy(*keys, hour, "magnitude_class").agg(
        F.count(F.lit(1)).alias("events"),
        round_half_up(F.max("mag"), 2).alias("peak_mag"),
        F.count_if("is_tsunami_related").alias("tsunami_count"),
    )


_TREND = ("hour", "magnitude_class", "events", "peak_mag", "tsunami_count", "repeats")


def region_trend(events: DataFrame, per_region: bool = False) -> DataFrame:
    """Hourly trend rows of every region.

    The figures of an (hour, class) are worldwide by default, or the region's own
    with ``per_region``. ``repeats`` says how many events the region had there: a
    row stands for that many equal entries.
    """
    own = events.groupBy("region", F.date_trunc("hour", "event_time").alias("hour"), "magnitude_class").agg(
        F.count(F.lit(1)).alias("repeats")
    )
    if per_region:
        figures = seismic_hourly(events, ("region",)).alias("f")
        own = own.alias("o")
        same = (
            F.col("o.region").eqNullSafe(F.col("f.region"))
            & (F.col("o.hour") == F.col("f.hour"))
            & (F.col("o.magnitude_class") == F.col("f.magnitude_class"))
        )
        return own.join(figures, same).select("o.region", "f.hour", "f.magnitude_class", *_TREND[2:])
    return own.join(seismic_hourly(events), ["hour", "magnitude_class"]).select("region", *_TREND)


def json_trend(df: DataFrame, keys: list[str], order: list[str], fields: list[str], name: str) -> DataFrame:
    """Per key, a JSON array of objects in order. For rows already bounded per key."""
    entries = F.sort_array(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    shaped = F.transform(entries, lambda e: F.struct(*[_json_value(df, e, f) for f in fields]))
    return df.groupBy(*keys).agg(
        F.to_json(shaped, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias(name)
    )


def _json_value(df: DataFrame, entry: Column, field: str) -> Column:
    if dict(df.dtypes)[field].startswith("timestamp"):
        return F.date_format(entry[field], "yyyy-MM-dd'T'HH:mm:ss").alias(field)
    return entry[field].alias(field)


def expand_trend(trend: Column) -> Column:
    """Array of trend entries with each one repeated as often as it stands for."""
    return F.flatten(F.transform(trend, lambda e: F.array_repeat(e, e["repeats"].cast("int"))))


def seismic_activity(
    seismics: DataFrame,
    tumbling: DataFrame,
    as_of: Column,
    per_region: bool = False,
    refreshed: Column | None = None,
) -> DataFrame:
    """Last 24 hours per region: counts, risk, newest window and an hourly trend.

    The trend holds one entry per hour and class with its ``repeats``, so it stays
    within 25 hours times 7 classes whatever a region's share of the events is.
    """
    events = recent(seismics, "event_time", "24 hours", as_of)
    stats = region_stats(events).withColumn(
        "risk_level",
        rules.seismic_risk_level(F.col("max_magnitude"), F.col("tsunami_events"), F.col("event_count_24h")),
    )
    windows = recent(tumbling, "window_end", "3 hours", as_of).select(
        "region",
        "window_end",
        F.col("window_start").alias("last_window_start"),
        F.col("event_count").alias("last_window_event_count"),
        F.col("max_magnitude").alias("last_window_max_mag"),
    )
    trend = json_trend(
        region_trend(events, per_region), ["region"], ["hour", "magnitude_class"], list(_TREND), "hourly_trend"
    )
    out = (
        top1_lateral(stats, windows, ["region"], [F.desc("window_end")])
        .drop("window_end")
        .join(trend, "region", "left")
    )
    return stamped(out, "refreshed_at", refreshed).orderBy(
        F.desc("max_magnitude"), F.desc("event_count_24h"), "region"
    )


def weather_conditions(
    weather: DataFrame, tumbling: DataFrame, as_of: Column, refreshed: Column | None = None
) -> DataFrame:
    """Current weather per region with its newest window, six hours of trend and a summary."""
    snapshot = [highest("latest_snapshot", F.col("snapshot_ts"))] if "snapshot_ts" in weather.columns else []
    region = profile(
        weather.filter(F.col("region_name").isNotNull()),
        ["region_name"],
        [
            counted("station_count"),
            averaged("avg_temp_c", F.col("temperature_c"), rounded(2)),
            lowest("min_temp_c", F.col("temperature_c"), rounded(2)),
            highest("max_temp_c", F.col("temperature_c"), rounded(2)),
            averaged("avg_humidity_pct", F.col("humidity_pct"), rounded(1)),
            averaged("avg_windspeed_ms", F.col("windspeed_ms"), rounded(2)),
            highest("max_windgusts_ms", F.col("windgusts_ms"), rounded(2)),
            summed("total_precip_mm", F.col("precipitation_mm"), rounded(2)),
            summed("total_snowfall_cm", F.col("snowfall_cm"), rounded(2)),
            averaged("avg_visibility_m", F.col("visibility_m"), rounded(0)),
            averaged("avg_pressure_hpa", F.col("pressure_hpa"), rounded(1)),
            averaged("avg_cloudcover_pct", F.col("cloudcover_pct"), rounded(1)),
            counted("stations_with_precip", F.col("precipitation_mm") > 0),
            counted("stations_with_snow", F.col("snowfall_cm") > 0),
            *snapshot,
        ],
        modes={"dominant_weather": "weather_label", "dominant_wind_severity": "wind_severity"},
    )
    newest = first_per_key(tumbling, ["region_name"], [F.desc("window_end")]).select(
        "region_name",
        F.col("window_start").alias("last_window_start"),
        F.col("snapshot_count").alias("last_window_snapshot_count"),
    )
    hourly = (
        recent(tumbling, "window_end", "6 hours", as_of)
        .groupBy("region_name", F.date_trunc("hour", "window_start").alias("hour"))
        .agg(
            round_half_up(F.avg("avg_temperature_c"), 2).alias("avg_temp_c"),
            round_half_up(F.avg("avg_windspeed_ms"), 2).alias("avg_wind_ms"),
            round_half_up(F.sum("total_precip_mm"), 2).alias("total_precip_mm"),
        )
    )
    fields = ["hour", "avg_temp_c", "avg_wind_ms", "total_precip_mm"]
    trend = json_trend(hourly, ["region_name"], ["hour"], fields, "hourly_trend")
    summary = rules.condition_summary(
        F.col("total_precip_mm"), F.col("total_snowfall_cm"), F.col("max_windgusts_ms"),
        F.col("avg_visibility_m"), F.col("avg_temp_c"), F.col("dominant_weather"),
    )
    out = (
        region.join(newest, "region_name", "left")
        .join(trend, "region_name", "left")
        .withColumn("condition_summary", summary)
    )
    return stamped(out, "refreshed_at", refreshed).orderBy("region_name")
