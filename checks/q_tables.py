"""Staging, intermediate and mart tables; windowed aggregates in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import geo, rules
from aerolith.functions.casting import round_half_up
from aerolith.operators.windows import flatten_window
from aerolith.plans import intermediate, marts, staging
from aerolith.plans import windows as win
from checks import views
from checks.inputs import tables
from checks.registry import AS_OF, CTES, query, rnd, rnd_once


def rounded(df, digits=4):
    """Doubles to four decimals, so that the order of summation does not show."""
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: round_half_up(F.col(n), digits) for n in doubles}) if doubles else df


def rounded_sql(select: str, plain: str, doubles: str) -> str:
    items = ", ".join(f"{rnd(c, 4)} as {c}" for c in doubles.split())
    keep = ", ".join(plain.split())
    return f"select {keep}, {items} from ({select})"


# --- staging ------------------------------------------------------------------------------


@query("p01_stg_flights", "select * from v_flights")
@tables
def stg_flights(t):
    return t.staged("flights").drop("geog", "track_id")


@query("p02_stg_weather", "select * from v_weather")
@tables
def stg_weather(t):
    return t.staged("weather")


@query("p03_stg_seismics", "select * from v_seismics")
@tables
def stg_seismics(t):
    return t.staged("seismics")


@query("p04_stg_airports", "select * from v_airports")
@tables
def stg_airports(t):
    return t.staged("airports").drop("geog")


@query("p05_stg_airlines", "select * from v_airlines")
@tables
def stg_airlines(t):
    return t.staged("airlines")


@query(
    "p06_flight_phase",
    f"""select icao24, case when velocity >= 0 then {rnd_once("velocity", 2)} end as velocity_ms,
        case when on_ground then 'on_ground' when baro_altitude is null then 'unknown'
             when baro_altitude < 300 then 'takeoff_landing' when baro_altitude < 3000 then 'climbing_descending'
             else 'cruising' end as flight_phase from v_flights""",
)
@tables
def flight_phase(t):
    return intermediate.flight_base(t.staged("flights")).select("icao24", "velocity_ms", "flight_phase")


@query(
    "p07_risk_level",
    """select region, case when max(mag) >= 7 or sum(tsunami) > 0 then 'high'
         when max(mag) >= 5 or count(*) > 10 then 'medium' else 'low' end as risk_level
       from v_seismics group by region""",
)
@tables
def risk_level(t):
    by_region = t.staged("seismics").groupBy("region")
    level = rules.seismic_risk_level(F.max("mag"), F.sum("tsunami"), F.count(F.lit(1)))
    return by_region.agg(level.alias("risk_level"))


@query(
    "p08_condition_summary",
    """select point_id, case when precipitation_mm > 10 then 'Heavy precipitation'
         when snowfall_cm > 5 then 'Significant snowfall' when windgusts_ms >= 30 then 'High wind alert'
         when visibility_m < 1000 then 'Low visibility' when temperature_c < -10 then 'Extreme cold'
         when temperature_c > 40 then 'Extreme heat' else weather_label end as condition_summary from v_weather""",
)
@tables
def condition_summary(t):
    inputs = ("precipitation_mm", "snowfall_cm", "windgusts_ms", "visibility_m", "temperature_c", "weather_label")
    summary = rules.condition_summary(*[F.col(c) for c in inputs])
    return t.staged("weather").select("point_id", summary.alias("condition_summary"))


@query(
    "p09_risk_score",
    f"""select point_id, {rnd('''least(100.0::double, least(25.0::double, (point_id % 9) / 4.0::double * 12.5::double)
          + case when (point_id % 90) / 10.0::double >= 7 then 35 when (point_id % 90) / 10.0::double >= 5 then 20
                 when (point_id % 90) / 10.0::double >= 3 then 10 else 0 end
          + case wind_severity when 'storm' then 25 when 'gale' then 18 when 'strong' then 10 when 'moderate' then 5 else 0 end
          + case when visibility_m < 500 then 15 when visibility_m < 1000 then 8 when visibility_m < 3000 then 3 else 0 end)''', 4)}
        as risk_score from v_weather""",
)
@tables
def risk_score(t):
    traffic, mag = F.col("point_id") % 9, F.col("point_id") % 90 / 10
    score = rules.risk_score(traffic, F.lit(4.0), mag, F.col("wind_severity"), F.col("visibility_m"))
    return t.staged("weather").select("point_id", round_half_up(score, 4).alias("risk_score"))


@query("p10_audit_columns", f"select airline_id, {AS_OF} as _loaded_at from v_airlines")
@tables
def audit_columns(t):
    return staging.stg_airlines(t.fx("airlines"), as_of=t.as_of).select("airline_id", "_loaded_at")


# --- intermediate and marts ----------------------------------------------------------------


@query("m01_stg_routes", "select * from v_routes")
@tables
def stg_routes(t):
    return t.staged("routes")


@query("m02_airport_grid", "select * from v_airport_grid")
@tables
def airport_grid(t):
    return t.airport_grid().drop("geog")


@query("m03_flights_enriched", "select * from v_enriched")
@tables
def flights_enriched(t):
    return t.enriched().drop("geog")


@query("m04_flight_activity", "select * from m_activity")
@tables
def flight_activity(t):
    return marts.flight_activity(t.enriched(), t.flight_windows(span="2 hours"), t.as_of).drop("refreshed_at")


@query(
    "m05_flight_context",
    f"select * replace ({rnd('max_eq_magnitude', 4)} as max_eq_magnitude, {rnd('risk_score', 4)} as risk_score) from m_context",
)
@tables
def flight_context(t):
    return rounded(context_mart(t))


def context_mart(t):
    return marts.flight_context(
        t.newest_context(), t.enriched(), t.staged("weather"), t.staged("seismics"), t.as_of
    ).drop("refreshed_at")


@query("m06_seismic_activity", views.seismic_activity("m_trend"))
@tables
def seismic_activity(t):
    return marts.seismic_activity(t.staged("seismics"), t.seismic_windows(span="3 hours"), t.as_of).drop("refreshed_at")


@query("m06_seismic_activity_per_region", views.seismic_activity("m_trend_own"))
@tables
def seismic_activity_per_region(t):
    mart = marts.seismic_activity(t.staged("seismics"), t.seismic_windows(span="3 hours"), t.as_of, per_region=True)
    return mart.drop("refreshed_at")


_TYPES = ["click", "error", "purchase", "signup", "view"]
CTES["v_weather_typed"] = f"select * replace (({_TYPES})[point_id % 5 + 1] as region_name) from v_weather"
CTES["m_weather_typed"] = CTES["m_weather_base"].replace("v_weather", "v_weather_typed")


@query(
    "m07_weather_conditions",
    """select b.*, l.window_start as last_window_start, l.snapshot_count as last_window_snapshot_count, h.hourly_trend,
         case when b.total_precip_mm > 10 then 'Heavy precipitation' when total_snowfall_cm > 5 then 'Significant snowfall'
              when max_windgusts_ms >= 30 then 'High wind alert' when b.avg_visibility_m < 1000 then 'Low visibility'
              when avg_temp_c < -10 then 'Extreme cold' when avg_temp_c > 40 then 'Extreme heat'
              else dominant_weather end as condition_summary
       from m_weather_typed b
       left join (select * from (select *, row_number() over (partition by region_name order by window_end desc) as rn
                                 from w_weather) where rn = 1) l using (region_name)
       left join (select region_name, '[' || string_agg('{"hour":"' || strftime(hour, '%Y-%m-%dT%H:%M:%S') || '","avg_temp_c":'
                    || coalesce(cast(avg_temp_c as varchar), 'null') || ',"avg_wind_ms":' || cast(avg_wind_ms as varchar)
                    || ',"total_precip_mm":' || cast(total_precip_mm as varchar) || '}', ',' order by hour) || ']' as hourly_trend
                  from m_weather_hours group by region_name) h using (region_name)""",
)
@tables
def weather_conditions(t):
    """The points take the region names of the timed readings, so that both sides meet."""
    names = F.array(*[F.lit(n) for n in _TYPES])
    points = t.staged("weather").withColumn(
        "region_name", F.element_at(names, (F.col("point_id") % 5 + 1).cast("int"))
    )
    return marts.weather_conditions(points, t.weather_windows(), t.as_of).drop("refreshed_at")


# --- windows, batch form --------------------------------------------------------------------

_FLIGHT_COLS = ("window_start window_end origin_country flight_count airborne_count", "avg_altitude_m avg_velocity_ms")
_SEISMIC_COLS = ("window_start window_end region event_count tsunami_count", "avg_magnitude max_magnitude avg_depth")
_WEATHER_COLS = (
    "window_start window_end region_name snapshot_count",
    "avg_temperature_c min_temperature_c max_temperature_c avg_windspeed_ms avg_windgusts_ms avg_visibility_m "
    "avg_humidity_pct total_precip_mm",
)
_CONTEXT_COLS = (
    "window_start window_end grid_lat grid_lon flight_count airborne_count nearby_eq_count tsunami_count",
    "avg_altitude_m max_eq_magnitude avg_temperature_c avg_windgusts_ms avg_visibility_m",
)


@query("t01_flight_tumbling", rounded_sql("select * from w_flights", *_FLIGHT_COLS))
@tables
def flight_tumbling(t):
    return rounded(t.flight_windows())


@query("t02_seismic_tumbling", rounded_sql("select * from w_seismics", *_SEISMIC_COLS))
@tables
def seismic_tumbling(t):
    return rounded(t.seismic_windows())


@query("t03_weather_tumbling", rounded_sql("select * from w_weather", *_WEATHER_COLS))
@tables
def weather_tumbling(t):
    return rounded(t.weather_windows())


@query(
    "t04a_flights_by_cell",
    rounded_sql(
        views.flights_cells("5 minute"),
        "window_start window_end grid_lat grid_lon flight_count airborne_count",
        "avg_altitude_m",
    ),
)
@tables
def flights_by_cell(t):
    return rounded(flatten_window(win.flights_by_cell(t.fx("flights"), "time_position")))


@query(
    "t04b_seismics_by_cell",
    rounded_sql(
        views.seismics_cells("5 minute"),
        "window_start window_end grid_lat grid_lon nearby_eq_count tsunami_count",
        "max_eq_magnitude",
    ),
)
@tables
def seismics_by_cell(t):
    return rounded(flatten_window(win.seismics_by_cell(t.fx("seismics"), "event_time")))


@query(
    "t04c_weather_by_cell",
    rounded_sql(
        views.weather_cells("5 minute"),
        "window_start window_end grid_lat grid_lon",
        "avg_temperature_c avg_windgusts_ms avg_visibility_m",
    ),
)
@tables
def weather_by_cell(t):
    return rounded(flatten_window(win.weather_by_cell(t.fx("weather_stream"), "snapshot_ts")))


@query("t04_flight_context", rounded_sql(views.context("5 minute"), *_CONTEXT_COLS))
@tables
def flight_context_windows(t):
    return rounded(t.context("5 minutes"))


@query("t04_flight_context_6h", rounded_sql("select * from w_context", *_CONTEXT_COLS))
@tables
def flight_context_6h(t):
    return rounded(t.context())


T05_SQL = rounded_sql(
    views.windows(
        "fx_flights", "time_position", "origin_country as origin_country",
        views.FLIGHT_AGGS.replace("(where not on_ground)", "(where on_ground is not true)"), "origin_country is not null",
    ),
    *_FLIGHT_COLS,
)
_LAST_PART = (
    "case when position(', ' in place) > 0 then trim(string_split(place, ', ')[-1]) "
    "else coalesce(nullif(place, ''), 'unknown') end"
)
T06_SQL = rounded_sql(
    views.windows(
        "fx_seismics", "event_time", f"{_LAST_PART} as region",
        "avg(coalesce(mag, 0)) as avg_magnitude, greatest(max(coalesce(mag, 0)), 0) as max_magnitude, "
        "count(*) as event_count, cast(sum(coalesce(tsunami, 0)) as bigint) as tsunami_count, "
        "avg(coalesce(depth, 0)) as avg_depth",
    ),
    *_SEISMIC_COLS,
)
_zeroed = views.WEATHER_AGGS
for _name in ("temperature_c", "windspeed_ms", "windgusts_ms", "visibility_m", "humidity_pct", "precipitation_mm"):
    _zeroed = _zeroed.replace(f"({_name})", f"(coalesce({_name}, 0))")
T07_SQL = rounded_sql(
    views.windows("fx_weather_stream", "snapshot_ts", "region_name as region_name", _zeroed, "region_name is not null"),
    *_WEATHER_COLS,
)


@query("t05_flight_tumbling_incremental", T05_SQL)
@tables
def flight_tumbling_incremental(t):
    return rounded(win.flight_tumbling_incremental(t.fx("flights"), "time_position"))


@query("t06_seismic_tumbling_incremental", T06_SQL)
@tables
def seismic_tumbling_incremental(t):
    return rounded(win.seismic_tumbling_incremental(t.fx("seismics"), "event_time"))


@query("t07_weather_tumbling_incremental", T07_SQL)
@tables
def weather_tumbling_incremental(t):
    return rounded(win.weather_tumbling_incremental(t.fx("weather_stream"), "snapshot_ts"))


_ON = "using (window_start, window_end, grid_lat, grid_lon)"
T08_SELECT = f"""
select window_start, window_end, grid_lat, grid_lon, flight_count, airborne_count, avg_altitude_m,
  coalesce(nearby_eq_count, 0) as nearby_eq_count, greatest(coalesce(max_eq_magnitude, 0), 0) as max_eq_magnitude,
  coalesce(tsunami_count, 0) as tsunami_count, avg_temperature_c, avg_windgusts_ms, avg_visibility_m
from ({views.windows("fx_flights", "time_position", views.cells("latitude", "longitude"),
        "count(*) as flight_count, count(*) filter (where on_ground is not true) as airborne_count, "
        "avg(nullif(baro_altitude, 0)) as avg_altitude_m", size="6 hour")}) f
left join ({views.seismics_cells("6 hour")}) s {_ON}
left join ({views.windows("fx_weather_stream", "snapshot_ts", views.cells("latitude", "longitude"),
        "avg(coalesce(temperature_c, 0)) as avg_temperature_c, avg(coalesce(windgusts_ms, 0)) as avg_windgusts_ms, "
        "avg(coalesce(visibility_m, 0)) as avg_visibility_m", size="6 hour")}) w {_ON}"""  # fmt: skip


@query("t08_flight_context_incremental", rounded_sql(T08_SELECT, *_CONTEXT_COLS))
@tables
def flight_context_incremental(t):
    return rounded(t.context(incremental=True))


@query("t08_flight_context_arrivals", rounded_sql(T08_SELECT, *_CONTEXT_COLS))
@tables
def flight_context_arrivals(t):
    """Flights on the ground come without an event time and count in the window of their arrival."""
    stamped = F.when(F.col("on_ground"), F.timestamp_seconds(F.lit(0))).otherwise(F.col("time_position"))
    flights = t.fx("flights").withColumn("arrived", F.col("time_position")).withColumn("time_position", stamped)
    return rounded(
        win.flight_context(
            flights, t.fx("seismics"), t.fx("weather_stream"), "time_position", "event_time", "snapshot_ts", "6 hours",
            incremental=True, arrivals=("arrived", None, None),
        )
    )


# --- geography and scalar rules ---------------------------------------------------------------


@query(
    "f_grid",
    f"select event_id, {views.cell('((event_id % 3601) / 10.0::double - 180)')} as cell_10, "
    "cast(floor(((event_id % 3601) / 10.0::double - 180) / 30) * 30 as integer) as cell_30 from events",
)
@tables
def grid(t):
    x = (F.col("event_id") % 3601) / 10 - 180
    return t.raw("events").select(
        "event_id", geo.grid_cell(x, x)[0].alias("cell_10"), geo.grid_cell(x, x, 30)[1].alias("cell_30")
    )


@query("f_haversine", f"select icao24, {rnd(views.great_circle('latitude', 'longitude', '40', '-3.5'), 1)} as km from fx_flights")
@tables
def haversine(t):
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(40.0), F.lit(-3.5))
    return t.fx("flights").select("icao24", round_half_up(km, 1).alias("km"))


@query("f_geo_point", "select icao24, longitude as lon, latitude as lat from v_flights")
@tables
def geo_point(t):
    return t.staged("flights").select("icao24", "geog.lon", "geog.lat")
