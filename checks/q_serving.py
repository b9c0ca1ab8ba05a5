"""Serving queries and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions.casting import round_half_up
from aerolith.operators import quality
from aerolith.plans import serving
from aerolith.plans.intermediate import country_airline
from checks.inputs import tables
from checks.q_tables import context_mart
from checks.registry import AS_OF, CTES, query, rnd, rnd_once

CTES["s_flights"] = """
select icao24, coalesce(f.callsign, icao24) as callsign, f.origin_country, f.longitude as lon, f.latitude as lat,
  coalesce(f.baro_altitude, 0) as baro_altitude, coalesce(f.velocity, 0) as velocity,
  coalesce(f.true_track, 0) as true_track, f.on_ground, f.time_position,
  coalesce(e.flight_phase, 'unknown') as flight_phase, coalesce(e.nearest_airport_name, '') as nearest_airport,
  coalesce(e.airline_name, '') as airline
from fx_flights f left join v_enriched e using (icao24)
where f.latitude between -90 and 90 and f.longitude between -180 and 180"""

CTES["s_day"] = f"select * from fx_seismics where event_time >= {AS_OF} - interval 24 hour"
CTES["s_seismics"] = """
select id, mag, place, lat, lon, depth, event_time, tsunami,
  case when mag >= 7 then 'Major' when mag >= 5 then 'Strong' when mag >= 3 then 'Moderate' else 'Minor' end as mag_class,
  greatest(25000, cast(trunc(pow(10.0::double, mag * 0.59::double - 2.44::double) * 1000 * 8) as bigint)) as radius
from s_day"""
CTES["s_weather"] = """
select lat, lon, windspeed_ms, temperature_c, visibility_m, precipitation_mm,
  least(40.0::double, greatest(0.0::double, windspeed_ms)) / 40 as weight,
  1 - least(10000.0::double, greatest(0.0::double, visibility_m)) / 10000 as vis_weight
from (select latitude as lat, longitude as lon, coalesce(windspeed_ms, 0) as windspeed_ms,
        coalesce(temperature_c, 0) as temperature_c, coalesce(visibility_m, 10000) as visibility_m,
        coalesce(precipitation_mm, 0) as precipitation_mm from fx_weather)"""


def flights_of(t):
    return serving.flights_map(t.fx("flights"), t.enriched(), limit=None)


@query("q01_flights_map", "select * from s_flights")
@tables
def flights_map(t):
    return flights_of(t)


@query("q02_seismics_map", "select * from s_seismics order by event_time desc, id desc limit 500")
@tables
def seismics_map(t):
    return serving.seismics_map(t.fx("seismics"), t.as_of, limit=500)


@query("q03_weather_map", "select * from s_weather")
@tables
def weather_map(t):
    return serving.weather_map(t.fx("weather"), limit=None)


CTES["s_kpis"] = f"""
select (select count(*) from fx_flights where latitude is not null) as flights,
  (select count(*) from s_day) as seismics_24h, (select coalesce(max(mag), 0) from s_day) as max_mag,
  (select coalesce(max(windgusts_ms), 0) from fx_weather) as max_wind,
  (select coalesce(max({rnd("risk_score", 4)}), 0) from m_context where window_end >= {AS_OF} - interval 10 minute) as risk_score"""


def kpi_row(t):
    row = serving.kpis(t.fx("flights"), t.fx("seismics"), t.fx("weather"), context_mart(t), t.as_of)
    return row.withColumn("risk_score", round_half_up(F.col("risk_score"), 4))


@query("q04_kpis", "select * from s_kpis")
@tables
def kpis(t):
    return kpi_row(t)


@query(
    "q05_flight_trend",
    f"""select window_start, cast(sum(flight_count) as bigint) as flight_count, cast(sum(airborne_count) as bigint) as airborne_count
        from w_flights where window_start >= {AS_OF} - interval 2 hour group by 1""",
)
@tables
def flight_trend(t):
    return serving.flight_trend(t.flight_windows(span="2 hours", newest=False), t.as_of)


@query("q06_seismic_trend", "select date_trunc('hour', event_time) as hour, count(*) as events, max(mag) as max_mag from s_day group by 1")
@tables
def seismic_trend(t):
    return serving.seismic_trend(t.fx("seismics"), t.as_of)


CTES["s_route_hits"] = """
select airline as code, count(*) as n from (select distinct airline from fx_routes) r
join fx_flights f on upper(f.callsign) like '%' || r.airline || '%' and f.on_ground = false group by 1"""


@query(
    "q07_active_routes",
    """select origin_code, origin_airport_name, origin_city, origin_lat as src_lat, origin_lon as src_lon,
         destination_code, destination_airport_name, destination_city, destination_lat as tgt_lat,
         destination_lon as tgt_lon, distance_km, route_type, airline_name, active_flights
       from (select r.*, cast(sum(h.n) over (partition by origin_code, destination_code) as bigint) as active_flights,
               row_number() over (partition by origin_code, destination_code
                 order by airline_code nulls last, airline_name nulls last, origin_airport_name nulls last,
                   destination_airport_name nulls last, origin_city, origin_lat, origin_lon, destination_city,
                   destination_lat, destination_lon) as rn
             from v_routes r join s_route_hits h on h.code = r.airline_code
             where origin_lat is not null and origin_lon is not null
               and destination_lat is not null and destination_lon is not null)
       where rn = 1""",
)
@tables
def active_routes(t):
    return serving.active_routes_of(
        t.fx("routes"), t.staged("airlines"), t.staged("airports"), t.fx("flights"), limit=None
    )


@query("q08_airports", "select airport_name, iata_code, city, country, latitude as lat, longitude as lon from v_airports")
@tables
def airports(t):
    return serving.airports_map(t.staged("airports"))


@query(
    "q09_risk_grid",
    f"""select grid_lat, grid_lon, {rnd("risk_score", 4)} as risk_score, flight_count, primary_airport_city as city, continent,
          wind_severity, max_mag_24h from m_context where risk_score > 0 order by 3 desc, 1, 2 limit 500""",
)
@tables
def risk_grid(t):
    grid = serving.risk_grid(context_mart(t), limit=500)
    return grid.withColumn("risk_score", round_half_up(F.col("risk_score"), 4))


@query(
    "q10_altitude_sample",
    """select baro_altitude_m as altitude_m, velocity_ms as speed_ms, flight_phase, origin_country from v_enriched
       where baro_altitude_m > 0 and velocity_ms > 0 and flight_phase <> 'unknown' order by md5('0|' || icao24), icao24 limit 2000""",
)
@tables
def altitude_sample(t):
    return serving.altitude_sample(t.enriched())


@query(
    "q11_continents",
    f"""select current_continent as continent, count(*) as flights, count(*) filter (where not on_ground) as airborne,
          {rnd("avg(baro_altitude_m)", 0)} as avg_alt_m from v_enriched group by 1""",
)
@tables
def continents(t):
    return serving.continent_breakdown(t.enriched())


CTES["s_countries"] = f"""
select origin_country, count(*) as total_flights, count(*) filter (where not on_ground) as airborne,
  {rnd("avg(baro_altitude)", 0)} as avg_altitude_m, {rnd("avg(velocity)", 1)} as avg_speed_ms
from fx_flights where origin_country is not null group by 1 order by total_flights desc, origin_country limit 25"""


@query("q12_top_countries", "select * from s_countries")
@tables
def top_countries(t):
    return serving.top_countries(t.fx("flights"), limit=25)


@query(
    "q13_top_airlines",
    f"""select coalesce(e.airline_name, 'Unknown') as airline, count(*) as flights,
          count(*) filter (where not f.on_ground) as airborne, {rnd("avg(f.baro_altitude)", 0)} as avg_altitude_m
        from fx_flights f left join v_enriched e using (icao24) where f.latitude is not null
        group by 1 order by flights desc, airline limit 20""",
)
@tables
def top_airlines(t):
    return serving.top_airlines(t.fx("flights"), t.enriched(), limit=20)


@query(
    "q14_top_airports",
    """select nearest_airport_name as airport, coalesce(nearest_airport_iata, '—') as iata,
         coalesce(nearest_airport_city, '') as city, count(*) as nearby_flights
       from v_enriched join fx_flights f using (icao24) where nearest_airport_name is not null and f.latitude is not null
       group by 1, 2, 3 order by nearby_flights desc, airport, iata, city limit 20""",
)
@tables
def top_airports(t):
    return serving.top_airports(t.fx("flights"), t.enriched(), limit=20)


@query(
    "q15_seismic_regions",
    f"""select regexp_replace(place, '^.*,\\s*', '') as region, count(*) as events, {rnd_once("max(mag)", 1)} as max_mag,
          {rnd("avg(mag)", 2)} as avg_mag, cast(sum(tsunami) as bigint) as tsunami_events
        from s_day group by 1 order by max_mag desc, events desc, region nulls last limit 25""",
)
@tables
def seismic_regions(t):
    return serving.seismic_by_region(t.fx("seismics"), t.as_of, limit=25)


@query(
    "q16_phases",
    """select coalesce(flight_phase, 'unknown') as phase, count(*) as flights
       from fx_flights f left join v_enriched e using (icao24) where f.latitude is not null group by 1""",
)
@tables
def phases(t):
    return serving.phase_breakdown(t.fx("flights"), t.enriched())


@query(
    "q17_country_counts",
    """select origin_country, count(*) as flights from fx_flights where origin_country is not null group by 1
       order by flights desc, origin_country limit 100""",
)
@tables
def country_counts(t):
    return serving.country_counts(t.fx("flights"), limit=100)


@query(
    "q18_filtered_flights",
    """select * from s_flights where upper(callsign) like '%B1%' and origin_country = 'NATION_11' and not on_ground
         and airline = (select airline_name from v_country_airline where country = 'NATION_11')""",
)
@tables
def filtered_flights(t):
    flights = flights_of(t)
    named = country_airline(t.staged("airlines")).filter("country = 'NATION_11'").first()
    airline = named["airline_name"] if named else "none"
    return serving.filter_flights(flights, callsign="B1", country="NATION_11", ground="airborne", airline=airline)


@query(
    "q19_viewport",
    f"""select {rnd("avg(lat)", 6)} as latitude, {rnd("avg(lon)", 6)} as longitude,
          {rnd('''case when count(*) = 1 then 8.0::double
            when greatest(max(lat) - min(lat), max(lon) - min(lon)) > 0
              then least(8.0::double, greatest(1.5::double, log2(360 / greatest(max(lat) - min(lat), max(lon) - min(lon))) - 0.5::double))
            else 6.0::double end''', 6)} as zoom
        from s_flights where upper(callsign) like '%AB%'""",
)
@tables
def viewport(t):
    view = serving.viewport(serving.filter_flights(flights_of(t), callsign="AB"))
    return view.select(*[round_half_up(F.col(c), 6).alias(c) for c in view.columns])


@query(
    "q20_tracks",
    f"""select icao24, {rnd("lat + least(3.0::double, greatest(0.3::double, velocity / 100)) * cos(radians(true_track))", 6)} as target_lat,
          {rnd("lon + least(3.0::double, greatest(0.3::double, velocity / 100)) * sin(radians(true_track))", 6)} as target_lon
        from s_flights where not on_ground""",
)
@tables
def tracks(t):
    lines = serving.track_lines(flights_of(t))
    ends = [round_half_up(F.col(c), 6).alias(c) for c in ("target_lat", "target_lon")]
    return lines.select("icao24", *ends)


@query(
    "q21_map_weights",
    """select lat, lon, 'temperature' as layer, (least(50.0::double, greatest(-30.0::double, temperature_c)) + 30) / 80 as weight from s_weather
       union all select lat, lon, 'visibility', vis_weight from s_weather where vis_weight > 0.1
       union all select lat, lon, 'rain', cast(trunc(least(20.0::double, greatest(0.0::double, precipitation_mm)) / 20 * 80000 + 15000) as integer)
         from s_weather where precipitation_mm > 0.1""",
)
@tables
def map_weights(t):
    points = serving.weather_map(t.fx("weather"), limit=None)
    layers = [
        (serving.temperature_layer(points), "temperature", "temp_weight"),
        (serving.low_visibility_layer(points), "visibility", "vis_weight"),
        (serving.rain_layer(points), "rain", "precip_radius"),
    ]
    parts = [
        df.select("lat", "lon", F.lit(name).alias("layer"), F.col(value).cast("double").alias("weight"))
        for df, name, value in layers
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "q22_quake_rings",
    """select id, ring, radius * scale as ring_radius, 'pulse' as style from s_seismics,
         (values (0, 5.0::double), (1, 3.5), (2, 2.2), (3, 1.4), (4, 1.0)) r(ring, scale)
       union all select id, ring, radius * scale, 'map' from s_seismics,
         (values (0, 1.8::double), (1, 2.8), (2, 4.0)) r(ring, scale)""",
)
@tables
def quake_rings(t):
    quakes = serving.seismics_map(t.fx("seismics"), t.as_of, limit=None)
    styles = [("pulse", serving.PULSE_RINGS), ("map", serving.MAP_RINGS)]
    parts = [
        serving.quake_rings(quakes, scales).select("id", "ring", "ring_radius", F.lit(style).alias("style"))
        for style, scales in styles
    ]
    return parts[0].unionByName(parts[1])


@query(
    "q23_country_map",
    """select country as origin_country, flights, iso_a3, lpad(cast(number as varchar), 3, '0') as numeric_id
       from (select e.nearest_airport_country as country, count(*) as flights from v_enriched e group by 1)
       join v_iso using (country)""",
)
@tables
def country_map(t):
    """The countries of the flights are no real names, so their airports' countries are mapped."""
    flights = t.enriched().select(F.col("nearest_airport_country").alias("origin_country"))
    return serving.country_map(serving.country_counts(flights))


@query(
    "q24_filter_options",
    """select distinct 'country' as kind, origin_country as value from s_flights where origin_country is not null
       union all select distinct 'airline', airline from s_flights where airline <> ''""",
)
@tables
def filter_options(t):
    return serving.filter_options(flights_of(t))


@query(
    "q25_live_samples",
    """select 'quakes' as list, cast(id as varchar) as item from (select * from s_seismics order by event_time desc, id desc limit 10)
       union all select 'countries', origin_country from (select * from s_countries order by total_flights desc, origin_country limit 12)
       union all select 'flights', icao24 from (select * from s_flights where flight_phase <> 'on_ground' order by icao24 limit 10)""",
)
@tables
def live_samples(t):
    quakes = serving.seismics_map(t.fx("seismics"), t.as_of, limit=500)
    lists = serving.live_samples(quakes, serving.top_countries(t.fx("flights")), flights_of(t))
    named = {"quakes": "id", "countries": "origin_country", "flights": "icao24"}
    parts = [
        lists[name].select(F.lit(name).alias("list"), F.col(key).cast("string").alias("item"))
        for name, key in named.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "q26_kpi_status",
    """select k.*, n as shown_flights, airborne_now,
         case when risk_score > 60 then 'high' when risk_score > 30 then 'elevated' else 'normal' end as risk_status,
         case when max_wind > 25 then 'storm alert' else 'normal' end as wind_status
       from s_kpis k, (select count(*) as n, count(*) filter (where not on_ground) as airborne_now
                       from s_flights where origin_country = 'NATION_3')""",
)
@tables
def kpi_status(t):
    shown = serving.filter_flights(flights_of(t), country="NATION_3")
    return serving.kpi_status(kpi_row(t), shown)


# --- data quality ---------------------------------------------------------------------------


@query("d01_not_null", "select count(*) filter (where origin_country is null) as failures from v_flights")
@tables
def not_null(t):
    return t.staged("flights").agg(quality.failures("origin_country", "not_null").alias("failures"))


@query("d02_non_negative", "select count(*) filter (where velocity < 0) as failures from v_flights")
@tables
def non_negative(t):
    return t.staged("flights").agg(quality.failures("velocity", "non_negative").alias("failures"))


_REPORT_ROW = "select '{t}' as table_name, '{c}' as column_name, '{k}' as check_name, {v} as failures"


def report_sql(rows) -> str:
    union = " union all ".join(_REPORT_ROW.format(t=t, c=c, k=k, v=v) for t, c, k, v in rows)
    return f"select *, failures = 0 as passed from ({union})"


@query(
    "d03_row_count",
    report_sql([("stg_flights", "*", "row_count_positive", "(select cast(case when count(*) > 0 then 0 else 1 end as bigint) from fx_flights)")]),
)
@tables
def row_count(t):
    return quality.run_checks(t.staged("flights"), "stg_flights", source=t.fx("flights"))


@query("d04_unique_key", "select latitude, longitude, count(*) as copies from fx_weather group by 1, 2 having count(*) > 1 "
       "union all select null, null, count(*) from (select code from v_airline_codes group by 1 having count(*) > 1)")  # fmt: skip
@tables
def unique_key(t):
    from aerolith.operators.joins import lookup_union

    places = quality.key_duplicates(t.fx("weather"), ["latitude", "longitude"])
    codes = quality.key_duplicates(lookup_union(t.staged("airlines"), ["iata_code", "icao_code"], "code"), ["code"])
    none = F.lit(None).cast("double")
    total = codes.agg(F.count(F.lit(1)).alias("copies"))
    return places.unionByName(total.select(none.alias("latitude"), none.alias("longitude"), "copies"))


FLIGHT_RULES = {
    "icao24": {"checks": ["not_null"]},
    "velocity": {"checks": ["non_negative"]},
    "true_track": {"check": ["non_negative"]},
    "category": {"checks": ["non_negative"]},
}


@query(
    "d05_check_report",
    report_sql(
        [
            ("stg_flights", "icao24", "not_null", "(select count(*) filter (where icao24 is null) from v_flights)"),
            *[("stg_flights", c, "non_negative", f"(select count(*) filter (where {c} < 0) from v_flights)")
              for c in ("velocity", "true_track", "category")],
            ("stg_flights", "*", "row_count_positive", "(select cast(case when count(*) > 0 then 0 else 1 end as bigint) from fx_flights)"),
            ("stg_flights", "icao24", "unique", "(select count(*) from (select icao24 from v_flights group by 1 having count(*) > 1))"),
        ]
    ),
)
@tables
def check_report(t):
    rules = quality.rules_from_spec(FLIGHT_RULES)
    return quality.run_checks(t.staged("flights"), "stg_flights", rules, key=["icao24"], source=t.fx("flights"))
