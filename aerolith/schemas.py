"""Record schemas. Declared once and never inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
}


def _record(fields: str) -> StructType:
    """Schema of a 'name type, name type' list; needs no session."""
    pairs = (field.split() for field in fields.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Feed records (one JSON object per message).
FLIGHT = _record(
    "icao24 string, callsign string, origin_country string, "
    "time_position bigint, last_contact bigint, longitude double, latitude double, "
    "baro_altitude double, on_ground boolean, velocity double, true_track double, "
    "category int, last_seen bigint"
)
WEATHER = _record(
    "snapshot_id string, region_name string, latitude double, longitude double, "
    "elevation_m double, weathercode int, interval_s int, windspeed_ms double, "
    "winddirection_deg double, windgusts_ms double, precipitation_mm double, "
    "rain_mm double, snowfall_cm double, showers_mm double, snow_depth_m double, "
    "cloudcover_pct double, cloudcover_low_pct double, temperature_c double, "
    "apparent_temperature_c double, humidity_pct double, visibility_m double, "
    "pressure_hpa double, snapshot_ts bigint"
)
EARTHQUAKE = _record(
    "mag double, mag_type string, place string, tsunami int, event_time bigint, "
    "event_type string, title string, sig int, lat double, lon double, depth double"
)

# Reference files (headerless CSV).
AIRPORTS = _record(
    "airport_id int, name string, city string, country string, iata string, icao string, "
    "latitude double, longitude double, altitude_ft int, timezone_offset double, "
    "dst string, tz_database string, airport_type string, source string"
)
AIRLINES = _record(
    "airline_id int, name string, alias string, iata string, icao string, "
    "callsign string, country string, active string"
)
ROUTES = _record(
    "airline string, airline_id int, src_airport string, src_airport_id int, "
    "dst_airport string, dst_airport_id int, codeshare string, stops int, equipment string"
)
PLANES = _record("name string, iata string, icao string")

REFERENCE_FILES = {
    "airports": AIRPORTS,
    "airlines": AIRLINES,
    "routes": ROUTES,
    "planes": PLANES,
}
