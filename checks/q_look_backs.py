"""Stored and partitioned tables, roll-ups, sketches, geodesics and binary points."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import geo
from aerolith.functions.casting import round_half_up, rounded
from aerolith.operators.profiles import averaged, counted, highest, lowest, profile, sketched
from aerolith.plans import intermediate, rollups
from aerolith.session import fresh_path
from aerolith.streaming.sinks import materialize, newest_rows_of
from checks import views
from checks.inputs import tables
from checks.registry import AS_OF, CTES, query, rnd

# --- stored tables ------------------------------------------------------------------------------


@query(
    "k08_partitioned_table",
    "select origin_country, window_end, flight_count from w_flights where window_end = (select max(window_end) from w_flights)",
)
@tables
def partitioned_table(t):
    """The newest window of a table that is stored by day: its folder alone is read."""
    folder = fresh_path(t.spark, "stored")
    dated = t.flight_windows().withColumn("end_day", F.to_date("window_end"))
    materialize(dated, "windows", folder, partition_by=["end_day"], sort_by=["window_end", "origin_country"])
    newest = newest_rows_of(t.spark, f"{folder}/windows", "end_day")
    return newest.select("origin_country", "window_end", "flight_count")


# --- roll-ups -----------------------------------------------------------------------------------

def quake_measures():
    return [
        counted("events"),
        averaged("avg_mag", F.col("mag"), rounded(2)),
        highest("max_mag", F.col("mag")),
        lowest("min_mag", F.col("mag")),
        counted("tsunami_events", F.col("is_tsunami_related")),
    ]


def quake_tree(t, keys):
    """The stored tree and what it was built from, as arguments of a look-back."""
    built = t.staged("seismics"), "event_time", keys, quake_measures()
    return rollups.store_tree(*built, fresh_path(t.spark, "quake-tree")), *built


def span(t, since: str):
    return t.as_of - F.expr(f"interval {since}"), t.as_of + F.expr("interval 1 second")


@query(
    "g12_rollup_look_back",
    f"""select region, count(*) as events, {rnd('avg(mag)', 2)} as avg_mag, max(mag) as max_mag, min(mag) as min_mag,
          count(*) filter (is_tsunami_related) as tsunami_events
        from v_seismics where event_time >= {AS_OF} - interval 200 hour group by 1""",
)
@tables
def rollup_look_back(t):
    """Figures of each region over 200 hours, from days, hours and slots."""
    return rollups.look_back(*quake_tree(t, ["region"]), *span(t, "200 hours"))


@query(
    "q06_rollup_trend",
    f"""select date_trunc('hour', event_time) as hour, count(*) as events, max(mag) as max_mag from v_seismics
        where event_time >= {AS_OF} - interval 24 hour group by 1""",
)
@tables
def rollup_trend(t):
    """Events per hour of the last day, from hours and slots."""
    hours = rollups.hourly(*quake_tree(t, []), *span(t, "24 hours"))
    return hours.select("hour", "events", "max_mag")


# --- sketches -----------------------------------------------------------------------------------

DISTINCT_ERROR = 0.05


@query(
    "g04_count_distinct_sketch",
    """select origin_country, count(distinct icao24) as aircraft, true as near from v_flights
       where origin_country is not null group by 1""",
)
@tables
def count_distinct_sketch(t):
    """Exact distinct counts, and whether the sketched ones are within three standard errors."""
    flights = t.staged("flights").filter("origin_country is not null")
    found = profile(
        flights, ["origin_country"], [sketched("about", F.col("icao24"))], distinct={"aircraft": "icao24"}
    )
    near = F.abs(F.col("about") - F.col("aircraft")) <= F.greatest(F.lit(1.0), F.col("aircraft") * DISTINCT_ERROR)
    return found.select("origin_country", "aircraft", near.alias("near"))


# --- the spheroid -------------------------------------------------------------------------------

_FLATTENING, _A, _B = "(1 / 298.257223563::double)", "6378137.0::double", "(6378137.0::double * (1 - 1 / 298.257223563::double))"


def spheroid_sql(source: str, lat1: str, lon1: str, lat2: str, lon2: str, steps: int = 12) -> str:
    """Rows of source with ``metres`` by the inverse formula, its steps written out."""
    sql = f"""select *, atan(tan(radians({lat1})) * (1 - {_FLATTENING})) as u1, atan(tan(radians({lat2})) * (1 - {_FLATTENING})) as u2,
      radians({lon2} - {lon1}) as l, radians({lon2} - {lon1}) as lam from {source}"""
    arc = """select *, atan2(ss, cs) as sg, case when ss = 0 then 0 else cos(u1) * cos(u2) * sin(lam) / ss end as sa from (select *,
      sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) as ss,
      sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) as cs from ({}))"""
    middle = """select *, case when 1 - sa * sa < 1e-15 then 0 else cs - 2 * sin(u1) * sin(u2) / (1 - sa * sa) end as cm from ({})"""
    for _ in range(steps):
        c = f"select *, {_FLATTENING} / 16 * (1 - sa * sa) * (4 + {_FLATTENING} * (4 - 3 * (1 - sa * sa))) as c from ({middle.format(arc.format(sql))})"
        after = f"l + (1 - c) * {_FLATTENING} * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1)))"
        sql = f"select * exclude (ss, cs, sg, sa, cm, c) replace ({after} as lam) from ({c})"
    last = middle.format(arc.format(sql))
    k = f"((1 - sa * sa) * ({_A} * {_A} - {_B} * {_B}) / ({_B} * {_B}))"
    series = f"""select *, 1 + {k} / 16384 * (4096 + {k} * (-768 + {k} * (320 - 175 * {k}))) as aa,
      {k} / 1024 * (256 + {k} * (-128 + {k} * (74 - 47 * {k}))) as bb from ({last})"""
    change = "bb * ss * (cm + bb / 4 * (cs * (2 * cm * cm - 1) - bb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))"
    return f"select * exclude (u1, u2, l, lam, ss, cs, sg, sa, cm, aa, bb), {_B} * aa * (sg - {change}) as metres from ({series})"


CTES["v_to_madrid"] = spheroid_sql("(select icao24, latitude, longitude from v_flights)", "latitude", "longitude", "40.5::double", "-3.5::double")
CTES["v_to_centre"] = spheroid_sql(
    f"(select *, {views.cell('latitude')} as grid_lat, {views.cell('longitude')} as grid_lon from v_airports)",
    "latitude", "longitude", "(grid_lat + 5)", "(grid_lon + 5)",
)


@query("f_geodesic", f"select icao24, {rnd('metres / 1000', 2)} as km from v_to_madrid")
@tables
def geodesic(t):
    metres = geo.geodesic_m(F.col("latitude"), F.col("longitude"), F.lit(40.5), F.lit(-3.5))
    return t.staged("flights").select("icao24", round_half_up(metres / 1000, 2).alias("km"))


@query(
    "w03_nearest_on_spheroid",
    f"""select grid_lat, grid_lon, airport_name from (select *, row_number() over (partition by grid_lat, grid_lon
          order by {rnd('metres / 1000', 6)}, airport_id) as rn from v_to_centre) where rn = 1""",
)
@tables
def nearest_on_spheroid(t):
    return intermediate.int_airport_grid(t.staged("airports"), spheroid=True).select("grid_lat", "grid_lon", "airport_name")


# --- binary points ------------------------------------------------------------------------------


def little_endian(column: str) -> str:
    """Hex digits of a double's bytes in SQL, last byte first."""
    bits = f"cast(cast({column} + 0.0 as double) as bit)::varchar"
    nibbles = [f"substr('0123456789ABCDEF', 1 + cast(strpos('{_NIBBLES}', substr({bits}, {1 + 4 * k}, 4) || ',') / 5 as integer), 1)" for k in range(16)]
    return " || ".join(nibbles[2 * k] + " || " + nibbles[2 * k + 1] for k in reversed(range(8)))


_NIBBLES = "".join(f"{n:04b}," for n in range(16))


@query(
    "f_geo_wkb",
    f"""select icao24, '0101000000' || {little_endian('longitude')} || {little_endian('latitude')} as wkb,
          longitude as lon, latitude as lat from v_flights""",
)
@tables
def geo_wkb(t):
    """Binary points in hex and what they decode to."""
    points = t.staged("flights").select("icao24", geo.point_wkb(F.col("longitude"), F.col("latitude")).alias("b"))
    decoded = points.withColumn("p", geo.wkb_point(F.col("b")))
    return decoded.select("icao24", F.hex("b").alias("wkb"), "p.lon", "p.lat")
