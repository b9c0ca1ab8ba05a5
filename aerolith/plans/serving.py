"""Queries behind the dashboard, as DataFrames.

A view returns every row unless it is given its display ``limit``.
``as_of`` stands for the current time and is a column (a literal or a scalar query).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions import geo, rules
from aerolith.functions.casting import coerce_numeric, round_half_up, round_once
from aerolith.functions.codes import country_codes
from aerolith.functions.text import region_of
from aerolith.operators.joins import broadcast_if_small, contains_counts, lookup_union, settled
from aerolith.operators.keyed import hashed_sample, latest_window, recent, top_k

# Ring scales drawn around a quake.
PULSE_RINGS = [5.0, 3.5, 2.2, 1.4, 1.0]
MAP_RINGS = [1.8, 2.8, 4.0]


def airborne() -> Column:
    return F.count_if(~F.col("on_ground"))


# --- live map ---------------------------------------------------------------------------


def flights_map(flights: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """Located flights with phase, nearest airport and airline; gaps filled for drawing."""
    extra = enriched.select("icao24", "flight_phase", "nearest_airport_name", "airline_name")
    located = flights.filter(geo.on_globe(F.col("latitude"), F.col("longitude")))
    rows = located.join(extra, "icao24", "left").select(
        "icao24",
        F.coalesce("callsign", "icao24").alias("callsign"),
        "origin_country",
        F.col("longitude").alias("lon"),
        F.col("latitude").alias("lat"),
        coerce_numeric(F.col("baro_altitude"), 0).alias("baro_altitude"),
        coerce_numeric(F.col("velocity"), 0).alias("velocity"),
        coerce_numeric(F.col("true_track"), 0).alias("true_track"),
        "on_ground",
        "time_position",
        F.coalesce("flight_phase", F.lit("unknown")).alias("flight_phase"),
        F.coalesce("nearest_airport_name", F.lit("")).alias("nearest_airport"),
        F.coalesce("airline_name", F.lit("")).alias("airline"),
    )
    return rows if limit is None else top_k(rows, [F.asc("icao24")], limit)


def seismics_map(seismics: DataFrame, as_of: Column, limit: int | None = None) -> DataFrame:
    """Newest quakes of the last 24 hours with class and drawing radius."""
    rows = (
        recent(seismics, "event_time", "24 hours", as_of)
        .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select(
            "id",
            coerce_numeric(F.col("mag"), 0).alias("mag"),
            "place", "lat", "lon", "depth", "event_time", "tsunami",
            rules.map_magnitude_class(F.col("mag")).alias("mag_class"),
        )
        .withColumn("radius", rules.quake_radius(F.col("mag")))
    )
    return rows if limit is None else top_k(rows, [F.desc("event_time"), F.desc("id")], limit)


def weather_map(weather: DataFrame, limit: int | None = None) -> DataFrame:
    """Weather points with wind and visibility weights between 0 and 1."""
    placed = weather.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    rows = placed.select(
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        coerce_numeric(F.col("windspeed_ms"), 0).alias("windspeed_ms"),
        coerce_numeric(F.col("temperature_c"), 0).alias("temperature_c"),
        coerce_numeric(F.col("visibility_m"), 10000).alias("visibility_m"),
        coerce_numeric(F.col("precipitation_mm"), 0).alias("precipitation_mm"),
    ).withColumns(
        {
            "weight": rules.clip(F.col("windspeed_ms"), 0, 40) / 40,
            "vis_weight": 1 - rules.clip(F.col("visibility_m"), 0, 10000) / 10000,
        }
    )
    return rows if limit is None else top_k(rows, [F.asc(c) for c in ("lat", "lon", "windspeed_ms", "temperature_c")], limit)


def temperature_layer(points: DataFrame) -> DataFrame:
    """Temperature weight: -30 to 50 degrees onto 0 to 1."""
    return points.withColumn("temp_weight", (rules.clip(F.col("temperature_c"), -30, 50) + 30) / 80)


def low_visibility_layer(points: DataFrame) -> DataFrame:
    return points.filter(F.col("vis_weight") > 0.1)


def rain_layer(points: DataFrame) -> DataFrame:
    """Rainy points with a drawing radius of 15 to 95 km."""
    radius = rules.clip(F.col("precipitation_mm"), 0, 20) / 20 * 80000 + 15000
    return points.filter(F.col("precipitation_mm") > 0.1).withColumn("precip_radius", radius.cast("int"))


def quake_rings(quakes: DataFrame, scales: list[float] | None = None) -> DataFrame:
    """Each quake once per ring, with the ring's radius. The ring list is fixed."""
    rings = F.array(*[F.struct(F.lit(i).alias("ring"), F.lit(s).alias("scale")) for i, s in enumerate(scales or PULSE_RINGS)])
    return quakes.select("*", F.inline(rings)).withColumn("ring_radius", F.col("radius") * F.col("scale"))


def track_lines(flights: DataFrame) -> DataFrame:
    """Airborne flights with the point they head for."""
    target_lat, target_lon = geo.project_ahead(
        F.col("lat"), F.col("lon"), F.col("velocity"), F.col("true_track")
    )
    return flights.filter(~F.col("on_ground")).withColumns({"target_lat": target_lat, "target_lon": target_lon})


def filter_flights(
    flights: DataFrame,
    callsign: str | None = None,
    country: str | None = None,
    ground: str | None = None,
    airline: str | None = None,
) -> DataFrame:
    """Optional filters of the map: callsign part, country, 'airborne' or 'ground', airline."""
    if callsign:
        flights = flights.filter(F.upper("callsign").contains(callsign))
    if country:
        flights = flights.filter(F.col("origin_country") == country)
    if ground:
        flights = flights.filter(F.col("on_ground") if ground == "ground" else ~F.col("on_ground"))
    if airline:
        flights = flights.filter(F.col("airline") == airline)
    return flights


def viewport(flights: DataFrame) -> DataFrame:
    """Centre and zoom that show all given flights; no row when there are none."""
    span = F.greatest(F.col("_lat_span"), F.col("_lon_span"))
    zoom = (
        F.when(F.col("_n") == 1, F.lit(8.0))
        .when(span > 0, rules.clip(F.log2(F.lit(360.0) / F.nullif(span, F.lit(0.0))) - 0.5, 1.5, 8.0))
        .otherwise(F.lit(6.0))
    )
    return (
        flights.agg(
            F.avg("lat").alias("latitude"),
            F.avg("lon").alias("longitude"),
            F.count(F.lit(1)).alias("_n"),
            (F.max("lat") - F.min("lat")).alias("_lat_span"),
            (F.max("lon") - F.min("lon")).alias("_lon_span"),
        )
        .filter(F.col("_n") > 0)
        .select("latitude", "longitude", zoom.alias("zoom"))
    )


def filter_options(flights: DataFrame) -> DataFrame:
    """Countries and airlines that can be picked, sorted."""
    options = F.array(
        F.struct(F.lit("country").alias("kind"), F.col("origin_country").alias("value")),
        F.struct(F.lit("airline").alias("kind"), F.nullif(F.col("airline"), F.lit("")).alias("value")),
    )
    rows = flights.groupBy("origin_country", "airline").agg(F.count(F.lit(1)).alias("_n"))
    return rows.select(F.inline(options)).filter(F.col("value").isNotNull()).distinct().orderBy("kind", "value")


def airports_map(airports: DataFrame) -> DataFrame:
    placed = airports.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return placed.select(
        "airport_name", "iata_code", "city", "country",
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
    )


def active_routes(
    routes: DataFrame, flights: DataFrame, limit: int | None = None, normalize: bool = False
) -> DataFrame:
    """Routes whose airline code occurs in the callsign of an airborne flight.

    One row per pair of airports. ``active_flights`` counts (route, flight) pairs;
    it is added up from the counts per airline code, so the pairs are never built.
    Those counts are settled first, so that routes without a match drop out early.
    Codes are compared as written unless ``normalize``. This is for staged routes that
    are stored; where they are yet to be joined, ``active_routes_of`` is far cheaper.
    """
    flying = flights.filter(~F.col("on_ground")).select(F.upper("callsign").alias("_callsign"))
    code = F.upper("airline_code") if normalize else F.col("airline_code")
    ends = ("origin_lat", "origin_lon", "destination_lat", "destination_lon")
    located = routes.dropna(subset=list(ends)).withColumn("_code", code)
    seen = settled(contains_counts(flying, "_callsign", located.select("_code"), "_code"), "code-matches")
    matched = located.join(seen, "_code")

    shown = ("airline_code", "airline_name", "origin_airport_name", "destination_airport_name")
    places = ("origin_city", "origin_lat", "origin_lon", "destination_city", "destination_lat", "destination_lon")
    pick = F.struct(*[_null_last(c) for c in shown], *places, "distance_km", "route_type")
    pairs = matched.groupBy("origin_code", "destination_code").agg(
        F.min(pick).alias("_r"), F.sum("matches").alias("active_flights")
    )
    rows = pairs.select(
        "origin_code",
        F.col("_r.origin_airport_name.v").alias("origin_airport_name"),
        F.col("_r.origin_city").alias("origin_city"),
        F.col("_r.origin_lat").alias("src_lat"),
        F.col("_r.origin_lon").alias("src_lon"),
        "destination_code",
        F.col("_r.destination_airport_name.v").alias("destination_airport_name"),
        F.col("_r.destination_city").alias("destination_city"),
        F.col("_r.destination_lat").alias("tgt_lat"),
        F.col("_r.destination_lon").alias("tgt_lon"),
        F.col("_r.distance_km").alias("distance_km"),
        F.col("_r.route_type").alias("route_type"),
        F.col("_r.airline_name.v").alias("airline_name"),
        "active_flights",
    )
    return top_k(rows, [F.asc("origin_code"), F.asc("destination_code")], limit)


def active_routes_of(
    routes: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    flights: DataFrame,
    limit: int | None = None,
    normalize: bool = False,
) -> DataFrame:
    """:func:`active_routes` over ``stg_routes`` of the same tables, without the staged rows.

    ``airlines`` and ``airports`` are staged, ``routes`` are not. The routes are added
    up per pair of codes while they hold nothing else: a code's airline is its place in
    the order of codes, so that the aggregate is over numbers. Names and positions are
    picked once per code, as both ends and the airline are independent of each other,
    and joined to the finished pairs. A shared code counts as often as it would fan out.
    """
    kept = routes.filter(F.col("src_airport").isNotNull() & F.col("dst_airport").isNotNull()).select(
        F.col("airline").alias("airline_code"),
        F.col("src_airport").alias("origin_code"),
        F.col("dst_airport").alias("destination_code"),
    )
    carriers = _matched_carriers(kept, airlines, flights, normalize)
    weights = broadcast_if_small(carriers.select("airline_code", "_place", "_weight"))
    sums = kept.join(weights, "airline_code").groupBy("origin_code", "destination_code").agg(
        F.min("_place").alias("_place"), F.sum("_weight").alias("_weight")
    )
    pairs = settled(sums, "route-pairs")
    ends = _route_ends(pairs, airports)

    rows = pairs.join(broadcast_if_small(carriers.select("_place", "airline_name")), "_place")
    for end in ("origin", "destination"):
        named = ends.select([F.col(c).alias(f"{end}_{c}") for c in ends.columns])
        rows = rows.join(broadcast_if_small(named), f"{end}_code")
    km = geo.haversine_km(
        F.col("origin_lat"), F.col("origin_lon"), F.col("destination_lat"), F.col("destination_lon")
    )
    same = F.arrays_overlap("origin_continents", "destination_continents")
    shown = rows.select(
        "origin_code",
        "origin_airport_name",
        "origin_city",
        F.col("origin_lat").alias("src_lat"),
        F.col("origin_lon").alias("src_lon"),
        "destination_code",
        "destination_airport_name",
        "destination_city",
        F.col("destination_lat").alias("tgt_lat"),
        F.col("destination_lon").alias("tgt_lon"),
        round_once(km, 1).alias("distance_km"),
        F.when(same, "domestic/regional").otherwise("international").alias("route_type"),
        "airline_name",
        (F.col("_weight") * F.col("origin_records") * F.col("destination_records")).alias("active_flights"),
    )
    return top_k(shown, [F.asc("origin_code"), F.asc("destination_code")], limit)


def _matched_carriers(kept: DataFrame, airlines: DataFrame, flights: DataFrame, normalize: bool) -> DataFrame:
    """Route codes seen in callsigns: place in the order of codes, first name, matches of all their airlines."""
    flying = flights.filter(~F.col("on_ground")).select(F.upper("callsign").alias("_callsign"))
    code = F.upper("airline_code") if normalize else F.col("airline_code")
    codes = settled(kept.select("airline_code").distinct(), "route-codes").withColumn("_code", code)
    seen = contains_counts(flying, "_callsign", codes, "_code")
    named = (
        lookup_union(airlines, ["iata_code", "icao_code"], "_airline")
        .groupBy("_airline")
        .agg(F.min(_null_last("airline_name")).alias("_first"), F.count(F.lit(1)).alias("_records"))
    )
    matched = codes.join(seen, "_code").withColumn("_airline", F.upper("airline_code")).join(named, "_airline", "left")
    weight = F.col("matches") * F.coalesce("_records", F.lit(1))
    # the ids rise with the sorted partitions, and stay as they are written
    ordered = matched.orderBy("airline_code").select(
        "airline_code",
        F.col("_first.v").alias("airline_name"),
        weight.alias("_weight"),
        F.monotonically_increasing_id().alias("_place"),
    )
    return settled(ordered, "route-carriers")


def _route_ends(pairs: DataFrame, airports: DataFrame) -> DataFrame:
    """Located airports of the pairs: the first record per code, the number of records, continents of equal firsts."""
    used = pairs.select(F.explode(F.array("origin_code", "destination_code")).alias("code")).distinct()
    places = lookup_union(airports, ["iata_code", "icao_code"], "code").dropna(subset=["latitude", "longitude"])
    records = (
        places.join(settled(used, "route-ends"), "code", "left_semi")
        .groupBy("code", "airport_name", "city", "latitude", "longitude")
        .agg(F.collect_set("continent").alias("continents"), F.count(F.lit(1)).alias("_n"))
    )
    first = F.struct(_null_last("airport_name"), "city", "latitude", "longitude", "continents")
    ends = records.groupBy("code").agg(F.min(first).alias("_r"), F.sum("_n").alias("records")).select(
        "code",
        F.col("_r.airport_name.v").alias("airport_name"),
        F.col("_r.city").alias("city"),
        F.col("_r.latitude").alias("lat"),
        F.col("_r.longitude").alias("lon"),
        F.col("_r.continents").alias("continents"),
        "records",
    )
    return settled(ends, "route-airports")


def _null_last(column: str) -> Column:
    value = F.col(column)
    return F.struct(value.isNull().alias("missing"), value.alias("v")).alias(column)


def risk_grid(context_mart: DataFrame, limit: int | None = None) -> DataFrame:
    rows = latest_window(context_mart, bounded=True).filter(F.col("risk_score") > 0).select(
        "grid_lat", "grid_lon", "risk_score", "flight_count",
        F.col("primary_airport_city").alias("city"), "continent", "wind_severity", "max_mag_24h",
    )
    return top_k(rows, [F.desc("risk_score"), F.asc("grid_lat"), F.asc("grid_lon")], limit)


# --- key figures and trends ---------------------------------------------------------------


def kpis(
    flights: DataFrame, seismics: DataFrame, weather: DataFrame, context_mart: DataFrame, as_of: Column
) -> DataFrame:
    """One row of key figures; missing figures are 0."""
    day = recent(seismics, "event_time", "24 hours", as_of)
    fresh = recent(context_mart, "window_end", "10 minutes", as_of)
    located = flights.filter(F.col("latitude").isNotNull())

    def top(df: DataFrame, column: str) -> Column:
        return F.coalesce(df.agg(F.max(column)).scalar(), F.lit(0.0))

    return located.agg(F.count(F.lit(1)).alias("flights")).withColumns(
        {
            "seismics_24h": day.agg(F.count(F.lit(1))).scalar(),
            "max_mag": top(day, "mag"),
            "max_wind": top(weather, "windgusts_ms"),
            "risk_score": top(fresh, "risk_score"),
        }
    )


def kpi_status(kpi_row: DataFrame, filtered_flights: DataFrame) -> DataFrame:
    """Status texts of the key figures and the airborne count of the filtered flights."""
    shown = filtered_flights.agg(F.struct(F.count(F.lit(1)).alias("n"), airborne().alias("flying"))).scalar()
    risk = F.col("risk_score")
    return kpi_row.withColumn("_shown", shown).select(
        "*", F.col("_shown.n").alias("shown_flights"), F.col("_shown.flying").alias("airborne_now")
    ).drop("_shown").withColumns(
        {
            "risk_status": F.when(risk > 60, "high").when(risk > 30, "elevated").otherwise("normal"),
            "wind_status": F.when(F.col("max_wind") > 25, "storm alert").otherwise("normal"),
        }
    )


def flight_trend(tumbling: DataFrame, as_of: Column) -> DataFrame:
    rows = recent(tumbling, "window_start", "2 hours", as_of)
    return (
        rows.groupBy("window_start")
        .agg(F.sum("flight_count").alias("flight_count"), F.sum("airborne_count").alias("airborne_count"))
        .orderBy("window_start")
    )


def seismic_trend(seismics: DataFrame, as_of: Column) -> DataFrame:
    rows = recent(seismics, "event_time", "24 hours", as_of)
    return (
        rows.groupBy(F.date_trunc("hour", "event_time").alias("hour"))
        .agg(F.count(F.lit(1)).alias("events"), F.max("mag").alias("max_mag"))
        .orderBy("hour")
    )


# --- rankings -------------------------------------------------------------------------------


def altitude_sample(enriched: DataFrame, k: int = 2000, seed: int = 0) -> DataFrame:
    """Random sample of moving flights in a known phase."""
    moving = (F.col("baro_altitude_m") > 0) & (F.col("velocity_ms") > 0) & (F.col("flight_phase") != "unknown")
    return hashed_sample(enriched.filter(moving), "icao24", k, seed).select(
        F.col("baro_altitude_m").alias("altitude_m"),
        F.col("velocity_ms").alias("speed_ms"),
        "flight_phase",
        "origin_country",
    )


def continent_breakdown(enriched: DataFrame) -> DataFrame:
    known = enriched.filter(F.col("current_continent").isNotNull())
    return (
        known.groupBy(F.col("current_continent").alias("continent"))
        .agg(
            F.count(F.lit(1)).alias("flights"),
            airborne().alias("airborne"),
            round_half_up(F.avg("baro_altitude_m"), 0).alias("avg_alt_m"),
        )
        .orderBy(F.desc("flights"), "continent")
    )


def top_countries(flights: DataFrame, limit: int | None = None) -> DataFrame:
    rows = (
        flights.filter(F.col("origin_country").isNotNull())
        .groupBy("origin_country")
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            airborne().alias("airborne"),
            round_half_up(F.avg("baro_altitude"), 0).alias("avg_altitude_m"),
            round_half_up(F.avg("velocity"), 1).alias("avg_speed_ms"),
        )
    )
    return top_k(rows, [F.desc("total_flights"), F.asc("origin_country")], limit)


def top_airlines(flights: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    located = flights.filter(F.col("latitude").isNotNull())
    rows = (
        located.join(enriched.select("icao24", "airline_name"), "icao24", "left")
        .groupBy(F.coalesce("airline_name", F.lit("Unknown")).alias("airline"))
        .agg(
            F.count(F.lit(1)).alias("flights"),
            airborne().alias("airborne"),
            round_half_up(F.avg("baro_altitude"), 0).alias("avg_altitude_m"),
        )
    )
    return top_k(rows, [F.desc("flights"), F.asc("airline")], limit)


def top_airports(flights: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    located = flights.filter(F.col("latitude").isNotNull()).select("icao24")
    near = enriched.filter(F.col("nearest_airport_name").isNotNull())
    name, iata, city = "nearest_airport_name", "nearest_airport_iata", "nearest_airport_city"
    rows = (
        near.select("icao24", name, iata, city)
        .join(located, "icao24")
        .groupBy(name, iata, city)
        .agg(F.count(F.lit(1)).alias("nearby_flights"))
        .select(
            F.col(name).alias("airport"),
            F.coalesce(iata, F.lit("—")).alias("iata"),
            F.coalesce(city, F.lit("")).alias("city"),
            "nearby_flights",
        )
    )
    return top_k(rows, [F.desc("nearby_flights"), F.asc("airport"), F.asc("iata"), F.asc("city")], limit)


def seismic_by_region(seismics: DataFrame, as_of: Column, limit: int | None = None) -> DataFrame:
    rows = (
        recent(seismics, "event_time", "24 hours", as_of)
        .groupBy(region_of(F.col("place"), "greedy").alias("region"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            round_once(F.max("mag"), 1).alias("max_mag"),
            round_half_up(F.avg("mag"), 2).alias("avg_mag"),
            F.sum("tsunami").alias("tsunami_events"),
        )
    )
    return top_k(rows, [F.desc("max_mag"), F.desc("events"), F.asc_nulls_last("region")], limit)


def phase_breakdown(flights: DataFrame, enriched: DataFrame) -> DataFrame:
    located = flights.filter(F.col("latitude").isNotNull()).select("icao24")
    return (
        located.join(enriched.select("icao24", "flight_phase"), "icao24", "left")
        .groupBy(F.coalesce("flight_phase", F.lit("unknown")).alias("phase"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .orderBy(F.desc("flights"), "phase")
    )


def country_counts(flights: DataFrame, limit: int | None = None) -> DataFrame:
    rows = (
        flights.filter(F.col("origin_country").isNotNull())
        .groupBy("origin_country")
        .agg(F.count(F.lit(1)).alias("flights"))
    )
    return top_k(rows, [F.desc("flights"), F.asc("origin_country")], limit)


def country_map(
    counts: DataFrame,
    names: DataFrame | None = None,
    numbers: DataFrame | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Country counts with alpha-3 and zero-padded numeric code; unknown countries are dropped.

    ``names`` (country, iso_a3) and ``numbers`` (iso_a3, number) default to the built-in table.
    """
    if names is None or numbers is None:
        default_names, default_numbers = country_codes(spark or counts.sparkSession)
        names, numbers = names or default_names, numbers or default_numbers
    coded = counts.join(names.withColumnRenamed("country", "origin_country"), "origin_country")
    padded = F.lpad(F.col("number").cast("string"), 3, "0").alias("numeric_id")
    return coded.join(numbers, "iso_a3").select("origin_country", "flights", "iso_a3", padded)


def live_samples(quakes: DataFrame, countries: DataFrame, flights: DataFrame) -> dict[str, DataFrame]:
    """The short lists beside the map: 10 newest quakes, 12 countries, 10 flights off the ground."""
    return {
        "quakes": top_k(quakes, [F.desc("event_time"), F.desc("id")], 10),
        "countries": top_k(countries, [F.desc("total_flights"), F.asc("origin_country")], 12).select(
            "origin_country", F.col("total_flights").alias("flights")
        ),
        "flights": top_k(flights.filter(F.col("flight_phase") != "on_ground"), [F.asc("icao24")], 10),
    }
