"""Cleaned tables of the landing feeds and reference files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import geo, rules
from aerolith.functions.casting import blank_to_null, round_once
from aerolith.functions.text import region_of
from aerolith.operators.joins import enrich, lookup_union

# Decimals kept per weather column.
WEATHER_DIGITS = {
    "elevation_m": 1,
    "windspeed_ms": 2,
    "winddirection_deg": 1,
    "windgusts_ms": 2,
    "precipitation_mm": 2,
    "rain_mm": 2,
    "snowfall_cm": 2,
    "showers_mm": 2,
    "snow_depth_m": 2,
    "cloudcover_pct": 1,
    "cloudcover_low_pct": 1,
    "temperature_c": 2,
    "apparent_temperature_c": 2,
    "humidity_pct": 1,
    "visibility_m": 0,
    "pressure_hpa": 2,
}


def stamped(df: DataFrame, name: str = "_loaded_at", as_of: Column | None = None) -> DataFrame:
    """Audit column with the load time."""
    return df.withColumn(name, as_of if as_of is not None else F.current_timestamp())


def stg_flights(flights: DataFrame, as_of: Column | None = None) -> DataFrame:
    lat, lon = F.col("latitude"), F.col("longitude")
    cell_lat, cell_lon = geo.grid_cell(lat, lon)
    located = flights.filter(F.col("icao24").isNotNull() & geo.on_globe(lat, lon))
    cleaned = located.withColumns(
        {
            "callsign": blank_to_null(F.col("callsign")),
            "origin_country": blank_to_null(F.col("origin_country")),
            "geog": geo.point(lon, lat),
            "baro_altitude_m": rules.non_negative(F.col("baro_altitude"), 1),
            "velocity_knots": rules.non_negative(F.col("velocity"), 1, rules.MS_TO_KNOTS),
            "continent": geo.continent_of_point("latitude", "longitude"),
            "grid_lat": cell_lat,
            "grid_lon": cell_lon,
        }
    )
    return stamped(cleaned, as_of=as_of)


def stg_weather(weather: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rounded readings with label and severity; both are judged on the raw values."""
    cell_lat, cell_lon = geo.grid_cell(F.col("latitude"), F.col("longitude"))
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    rounded = {
        name: round_once(F.col(name), digits)
        for name, digits in WEATHER_DIGITS.items()
        if name in weather.columns
    }
    cleaned = weather.filter(placed & F.col("temperature_c").between(-90, 60)).withColumns(
        {
            **rounded,
            "region_name": F.trim("region_name"),
            "weather_label": rules.weather_label("weathercode"),
            "wind_severity": rules.wind_severity(F.col("windgusts_ms")),
            "grid_lat": cell_lat,
            "grid_lon": cell_lon,
        }
    )
    return stamped(cleaned, as_of=as_of)


def stg_seismics(seismics: DataFrame, as_of: Column | None = None) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    cell_lat, cell_lon = geo.grid_cell(lat, lon)
    known = F.col("mag").isNotNull() & F.col("event_time").isNotNull() & geo.on_globe(lat, lon)
    cleaned = (
        seismics.filter(known)
        .withColumns(
            {
                "region": region_of(F.col("place"), "last_comma"),
                "magnitude_class": rules.magnitude_class(F.col("mag")),
                "is_tsunami_related": F.col("tsunami").cast("boolean"),
                "grid_lat": cell_lat,
                "grid_lon": cell_lon,
                "depth_km": round_once(F.col("depth"), 2),
                "mag": round_once(F.col("mag"), 2),
                "mag_type": F.upper(F.trim("mag_type")),
                "place": F.trim("place"),
            }
        )
        .drop("depth")
    )
    return stamped(cleaned, as_of=as_of)


def stg_airports(airports: DataFrame, as_of: Column | None = None) -> DataFrame:
    lat, lon = F.col("latitude"), F.col("longitude")
    kept = airports.filter(geo.on_globe(lat, lon) & F.col("airport_type").isin("airport", "unknown"))
    passed_on = [c for c in ("timezone_offset", "dst", "source") if c in airports.columns]
    cleaned = kept.select(
        "airport_id",
        F.trim("name").alias("airport_name"),
        F.trim("city").alias("city"),
        F.trim("country").alias("country"),
        blank_to_null(F.col("iata")).alias("iata_code"),
        blank_to_null(F.col("icao")).alias("icao_code"),
        round_once(lat, 6).alias("latitude"),
        round_once(lon, 6).alias("longitude"),
        "altitude_ft",
        round_once(F.col("altitude_ft") * rules.FEET_TO_M, 1).alias("altitude_m"),
        blank_to_null(F.col("tz_database")).alias("tz_database"),
        geo.point(lon, lat).alias("geog"),
        rules.country_continent("country").alias("continent"),
        "airport_type",
        *passed_on,
    )
    return stamped(cleaned, as_of=as_of)


def stg_airlines(airlines: DataFrame, as_of: Column | None = None) -> DataFrame:
    kept = airlines.filter(
        F.col("name").isNotNull()
        & (blank_to_null(F.col("iata")).isNotNull() | blank_to_null(F.col("icao")).isNotNull())
    )
    call = [blank_to_null(F.col("callsign")).alias("callsign")] if "callsign" in airlines.columns else []
    cleaned = kept.select(
        "airline_id",
        F.trim("name").alias("airline_name"),
        blank_to_null(F.col("alias")).alias("alias"),
        blank_to_null(F.upper("iata")).alias("iata_code"),
        blank_to_null(F.upper("icao")).alias("icao_code"),
        *call,
        F.trim("country").alias("country"),
        F.coalesce(F.col("active") == "Y", F.lit(False)).alias("is_active"),
    )
    return stamped(cleaned, as_of=as_of)


# Route columns taken from the airport at either end.
_END_COLUMNS = {
    "airport_name": "airport_name",
    "city": "city",
    "country": "country",
    "continent": "continent",
    "lat": "latitude",
    "lon": "longitude",
    "timezone": "tz_database",
}


def stg_routes(
    routes: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    as_of: Column | None = None,
    direct_only: bool = False,
) -> DataFrame:
    """Routes with their airline, both airports, distance and type.

    ``airlines`` and ``airports`` are staged. A code shared by several records
    fans out and stays so; the airlines, whose codes repeat most, come last, after
    the distance has been worked out.
    """
    kept = routes.filter(F.col("src_airport").isNotNull() & F.col("dst_airport").isNotNull())
    if direct_only:
        kept = kept.filter(F.col("stops") == 0)
    out = kept.select(
        F.col("airline").alias("airline_code"),
        F.upper("airline").alias("_airline"),
        F.col("src_airport").alias("origin_code"),
        F.col("dst_airport").alias("destination_code"),
        (F.col("codeshare") == "Y").alias("is_codeshare"),
        "stops",
        F.col("equipment").alias("aircraft_codes"),
    )
    for end in ("origin", "destination"):
        code = f"{end}_code"
        places = lookup_union(airports, ["iata_code", "icao_code"], code)
        out = enrich(out, places, [code], {f"{end}_{name}": source for name, source in _END_COLUMNS.items()})
    km = geo.haversine_km(
        F.col("origin_lat"), F.col("origin_lon"), F.col("destination_lat"), F.col("destination_lon")
    )
    same = F.col("origin_continent") == F.col("destination_continent")
    out = out.withColumns(
        {
            "distance_km": round_once(km, 1),
            "route_type": F.when(same, "domestic/regional").otherwise("international"),
        }
    )
    carriers = lookup_union(airlines, ["iata_code", "icao_code"], "_airline")
    out = enrich(
        out,
        carriers,
        ["_airline"],
        {"airline_name": "airline_name", "airline_country": "country", "airline_is_active": "is_active"},
    ).drop("_airline")
    return stamped(out, as_of=as_of)
