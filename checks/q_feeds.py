"""Sources and sinks: wire forms, reference files, keyed and append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.functions.casting import epoch_to_ts, safe_cast, truthy
from aerolith.functions.geo import with_cell
from aerolith.functions.text import snapshot_id
from aerolith.operators import keyed
from aerolith.session import fresh_path
from aerolith.sources import feeds, reference_files, topics
from aerolith.sources.weather_grid import weather_grid
from aerolith.streaming import runner, sinks
from checks import fixtures
from checks.inputs import tables
from checks.registry import AS_OF, CTES, query

# --- streams over the given tables ------------------------------------------------------------

HALF = "timestamp '2024-01-16'"


def event_stream(t, name: str) -> DataFrame:
    """A fixture over the events table read as a stream."""
    plain = t.spark.read.parquet(f"{t.sf_dir}/events.parquet").schema
    stream = t.spark.readStream.schema(plain).parquet(f"{t.sf_dir}/events.parque[t]")
    return fixtures.shape(fixtures.as_instants(stream), name)


class Replay:
    """The events table arriving in two halves, with a run of the query after each.

    The second run goes on from the first one's checkpoint, as after a restart.
    """

    def __init__(self, t, newest_first: bool = False):
        self.t = t
        self.inbox = fresh_path(t.spark, "inbox")
        self.newest_first = newest_first

    def run(self, name: str, build, **target) -> None:
        """``build`` maps the stream of a fixture to the query that is started."""
        spark, checkpoint = self.t.spark, fresh_path(self.t.spark, "checkpoint")
        events = self.t.raw("events")
        early, late = events.filter(f"ts < {HALF}"), events.filter(f"ts >= {HALF}")
        for half in (late, early) if self.newest_first else (early, late):
            half.write.mode("append").parquet(self.inbox)
            stream = fixtures.shape(spark.readStream.schema(events.schema).parquet(self.inbox), name)
            runner.run_to_end(runner.start(build(stream), checkpoint, **target))


def written(df: DataFrame, name: str) -> str:
    """Rows as a folder of text lines, one message per line."""
    path = fresh_path(df.sparkSession, name)
    df.write.text(path)
    return path


# --- topics and wire forms ----------------------------------------------------------------------


def flight_records(t) -> DataFrame:
    flights = t.fx("flights")
    return flights.withColumns(
        {
            "time_position": F.unix_seconds("time_position"),
            "last_contact": F.unix_seconds("last_contact"),
            "last_seen": F.lit(0).cast("bigint"),
        }
    ).select(*schemas.FLIGHT.names)


_RECORD_SQL = """select icao24, callsign, origin_country, epoch_us(time_position) // 1000000 as time_position,
  longitude, latitude, baro_altitude, on_ground, velocity, true_track, category from fx_flights"""
_RECORD = [c for c in schemas.FLIGHT.names if c not in ("last_contact", "last_seen")]


@query("s01_topic_json", _RECORD_SQL)
@tables
def topic_json(t):
    """Messages are written as JSON lines and read back through a stream."""
    options = {"ignoreNullFields": "false"}
    inbox = written(flight_records(t).select(F.to_json(F.struct("*"), options).alias("value")), "topic")
    stream = topics.decode(topics.read_message_files(t.spark, inbox), schemas.FLIGHT)
    out = fresh_path(t.spark, "decoded")
    runner.run_to_end(runner.start(stream, fresh_path(t.spark, "checkpoint"), path=out))
    return t.spark.read.parquet(out).select(*_RECORD)


@query("s14_drop_malformed", _RECORD_SQL + " where cast(right(icao24, 2) as integer) % 10 not in (0, 5, 7)")
@tables
def drop_malformed(t):
    """Messages ending in 0 are cut short, 5 lack a field, 7 have one too many."""
    last = F.right(F.col("icao24"), F.lit(1))
    options = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct("*"), options)
    lacking = F.to_json(F.struct(*[c for c in schemas.FLIGHT.names if c != "velocity"]), options)
    line = (
        F.when(last == "0", F.left(whole, F.lit(40)))
        .when(last == "5", lacking)
        .when(last == "7", F.concat(F.lit('{"more":1,'), F.substring(whole, F.lit(2), F.length(whole))))
        .otherwise(whole)
    )
    messages = t.spark.read.text(written(flight_records(t).select(line.alias("value")), "topic"))
    return topics.drop_malformed(messages, schemas.FLIGHT).select(*_RECORD)


PER_MESSAGE = 20


def grouped_messages(rows: DataFrame, number, item, envelope) -> DataFrame:
    """Wire messages of a few items each."""
    groups = rows.groupBy(F.floor(number / PER_MESSAGE).alias("_m")).agg(F.collect_list(item).alias("items"))
    return groups.select(F.to_json(F.struct(*envelope), {"ignoreNullFields": "false"}).alias("value"))


def state_messages(t) -> DataFrame:
    """Snapshots of positional state arrays, two minutes after the hour of the newest position."""
    number = F.substring("icao24", F.lit(2), F.length("icao24")).cast("bigint")
    fields = {
        "icao24": F.when(number % 31 != 0, F.col("icao24")),
        "callsign": F.col("callsign"),
        "origin_country": F.col("origin_country"),
        "time_position": F.when(number % 19 != 0, F.unix_seconds("time_position")),
        "last_contact": F.unix_seconds("last_contact"),
        "longitude": F.col("longitude"),
        "latitude": F.col("latitude"),
        "baro_altitude": F.col("baro_altitude"),
        "on_ground": F.col("on_ground"),
        "velocity": F.col("velocity"),
        "true_track": F.col("true_track"),
    }
    nothing = F.lit(None).cast("string").cast("variant")
    head = [c.cast("variant") for c in fields.values()]
    long_form = F.array(*head, *[nothing] * 6, F.col("category").cast("variant"))
    short_form = F.array(*head)
    stub = F.array(*head[:10])
    state = F.when(number % 23 == 0, stub).when(number % 2 == 0, short_form).otherwise(long_form)
    rows = t.fx("flights").withColumn("_n", number).withColumn("_state", state)
    groups = rows.groupBy(F.floor(F.col("_n") / PER_MESSAGE).alias("_m")).agg(
        F.max(F.unix_seconds("time_position")).alias("time"), F.collect_list("_state").alias("states")
    )
    body = F.to_json(F.struct("time", "states"), {"ignoreNullFields": "false"})
    lines = groups.select(body.alias("value"))
    junk = groups.select(F.concat(F.lit("{not json "), F.col("_m").cast("string")).alias("value"))
    return t.spark.read.text(written(lines.unionByName(junk), "states"))


CTES["x_states"] = f"""
select case when n % 31 <> 0 then icao24 else 'None' end as icao24, trim(coalesce(callsign, '')) as callsign,
  coalesce(origin_country, 'unknown') as origin_country,
  case when n % 19 <> 0 then seconds else 0 end as time_position, seconds as last_contact,
  longitude, latitude, coalesce(baro_altitude, 0) as baro_altitude, on_ground, coalesce(velocity, 0) as velocity, true_track,
  case when n % 2 = 0 then 0 else category end as category,
  case when n % 19 <> 0 then seconds end as position_ts,
  max(seconds) over (partition by n // {PER_MESSAGE}) as snapshot_ts, n
from (select *, cast(substring(icao24, 2) as bigint) as n, epoch_us(time_position) // 1000000 as seconds from fx_flights)"""


@query("s02_state_vectors", "select * exclude (n) from x_states where n % 23 <> 0")
@tables
def state_vectors(t):
    return feeds.parse_state_vectors(state_messages(t))


@query(
    "s06_drop_stale",
    """select icao24, time_position, snapshot_ts as last_seen from x_states
       where n % 23 <> 0 and position_ts is not null and snapshot_ts - position_ts <= 900""",
)
@tables
def drop_stale(t):
    rows = feeds.parse_state_vectors(state_messages(t))
    kept = keyed.drop_stale(rows, F.col("snapshot_ts"), F.col("position_ts"), max_age=900)
    return kept.select("icao24", "time_position", "last_seen")


def quake_messages(t) -> DataFrame:
    rows = t.fx("seismics")
    properties = F.struct(
        F.when(F.col("id") % 17 != 0, F.col("mag")).alias("mag"),
        F.when(F.col("id") % 3 != 0, F.col("mag_type")).alias("magType"),
        "place",
        "tsunami",
        F.unix_millis("event_time").alias("time"),
        F.col("event_type").alias("type"),
        "title",
        "sig",
    )
    coordinates = F.when(F.col("id") % 41 != 0, F.array("lon", "lat", "depth")).otherwise(F.array("lon"))
    feature = F.struct(
        F.concat(F.lit("q"), F.col("id")).alias("id"),
        F.when(F.col("id") % 43 != 0, properties).alias("properties"),
        F.struct(coordinates.alias("coordinates")).alias("geometry"),
    )
    lines = grouped_messages(rows, F.col("id"), feature, [F.col("items").alias("features")])
    return t.spark.read.text(written(lines, "quakes"))


CTES["x_quakes"] = """
select case when id % 17 <> 0 then mag else 0 end as mag, case when id % 3 <> 0 then mag_type else 'unknown' end as mag_type,
  coalesce(place, 'unknown') as place, tsunami, epoch_us(event_time) // 1000 as event_time, event_type, title, sig,
  lat, lon, depth, 'q' || id as feature_id from fx_seismics where id % 41 <> 0 and id % 43 <> 0"""


@query("s03_quakes", "select * from x_quakes")
@tables
def quakes(t):
    return feeds.parse_quakes(quake_messages(t))


_WIRE = {name: wire for name, wire in feeds.WEATHER_FIELDS.items()}
_KNOWN = [
    "weathercode", "windspeed_ms", "windgusts_ms", "precipitation_mm", "snowfall_cm", "cloudcover_pct",
    "temperature_c", "humidity_pct", "visibility_m", "pressure_hpa",
]


def weather_messages(t) -> DataFrame:
    rows = t.fx("weather")
    current = F.struct(*[F.col(c).alias(_WIRE[c]) for c in _KNOWN])
    body = F.struct(F.col("elevation_m").alias("elevation"), F.when(F.col("point_id") % 37 != 0, current).alias("current"))
    value = F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    return rows.select("latitude", "longitude", "region_name", F.col("point_id") * 1000, value).toDF(
        "latitude", "longitude", "region_name", "clock", "value"
    )


_zeros = ", ".join(f"cast(0 as {'integer' if c == 'interval_s' else 'double'}) as {c}" for c in _WIRE if c not in _KNOWN)
_read = ", ".join(f"coalesce({c}, 0) as {c}" for c in _KNOWN)


@query(
    "s04_weather",
    f"""select region_name, latitude, longitude, elevation_m, {_read}, {_zeros}, point_id * 1000 as snapshot_ts,
          substring(md5(printf('%.1f:%.1f:%d', latitude, longitude, point_id * 1000 // 900)), 1, 16) as snapshot_id
        from fx_weather where point_id % 37 <> 0""",
)
@tables
def weather(t):
    return feeds.parse_weather(weather_messages(t), F.col("clock"))


@query(
    "s05_safe_cast",
    """select event_id, cast(trunc(value) as bigint) as from_number,
         case when event_id % 3 = 0 then 0 else event_id end as from_text,
         coalesce(try_cast(event_type as double), 0.0) as from_word,
         event_id % 4 <> 0 as from_flag, event_id % 6 <> 0 as from_label from events""",
)
@tables
def safe_casts(t):
    digits = F.col("event_id").cast("string")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(digits, F.lit(".7"))).otherwise(digits)
    label = F.when(F.col("event_id") % 6 != 0, "False").otherwise("")
    return t.raw("events").select(
        "event_id",
        safe_cast(F.col("value"), "bigint", 0).alias("from_number"),
        safe_cast(text, "bigint", 0).alias("from_text"),
        safe_cast(F.col("event_type"), "double", 0.0).alias("from_word"),
        truthy(F.col("event_id") % 4).alias("from_flag"),
        truthy(label, is_text=True).alias("from_label"),
    )


@query(
    "s07_newer_than",
    f"""select minute, event_id from (select date_trunc('minute', ts) as minute, event_id,
          row_number() over (partition by date_trunc('minute', ts) order by event_id) as rn from events
          where date_trunc('minute', ts) > {HALF}) where rn = 1""",
)
@tables
def newer_than(t):
    events = t.raw("events").select(F.date_trunc("minute", "ts").alias("minute"), "event_id")
    return keyed.newer_than(events, "minute", F.expr(HALF), [F.asc("event_id")])


@query(
    "s08_seen_id",
    "select user_id, min(event_id) as event_id from events group by 1",
)
@tables
def seen_id(t):
    return keyed.first_seen(t.raw("events").select("user_id", "event_id"), "user_id", [F.asc("event_id")])


@query("s08_seen_id_stream", "select event_id, user_id from events")
@tables
def seen_id_stream(t):
    """Every feature is sent twice; the second copy is recognised within the watermark."""
    raw = event_stream(t, "fx_seismics").select("id", F.col("event_time").alias("ts"))
    twice = raw.select("id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    once = keyed.first_seen(twice.withWatermark("ts", "1 day"), "id").drop("copy")
    out = fresh_path(t.spark, "seen")
    runner.run_to_end(runner.start(once, fresh_path(t.spark, "checkpoint"), path=out))
    events = t.raw("events").select("event_id", "user_id")
    return t.spark.read.parquet(out).select(F.col("id").alias("event_id")).join(events, "event_id")


_blocks = " union all ".join(
    f"""select '{name}_' || lat || '_' || lon as name, lat::double as lat, lon::double as lon, {i} as block
        from (select unnest(range({s}, {n} + 1, {ds})) as lat) a, (select unnest(range({w}, {e} + 1, {dw})) as lon) b"""
    for i, (name, (s, n, ds), (w, e, dw)) in enumerate(
        [
            ("grid", (-60, 75, 20), (-180, 180, 20)),
            ("dense", (-50, 59, 10), (-130, -61, 10)),
            ("dense", (30, 69, 10), (-10, 39, 10)),
            ("dense", (10, 59, 10), (60, 139, 10)),
            ("polar", (-80, 80, 160), (-180, 180, 60)),
        ]
    )
)
CTES["x_grid"] = f"select name, lat, lon from (select *, row_number() over (partition by lat, lon order by block desc) as rn from ({_blocks})) where rn = 1"


@query(
    "s09_weather_grid",
    """select name, lat, lon, coalesce(flights, 0) as flights from x_grid left join
         (select grid_lat, grid_lon, count(*) as flights from v_flights group by 1, 2)
       on grid_lat = floor(lat / 10) * 10 and grid_lon = floor(lon / 10) * 10""",
)
@tables
def grid_points(t):
    """Sampling points with the number of flights in their cell."""
    points = with_cell(weather_grid(t.spark), "lat", "lon")
    traffic = t.staged("flights").groupBy("grid_lat", "grid_lon").agg(F.count(F.lit(1)).alias("flights"))
    joined = points.join(traffic, ["grid_lat", "grid_lon"], "left")
    return joined.select("name", "lat", "lon", F.coalesce("flights", F.lit(0)).alias("flights"))


@query(
    "s10_snapshot_id",
    """select event_id, substring(md5(printf('%.1f:%.1f:%d', latitude, longitude, epoch_us(snapshot_ts) // 1000000 // 900)), 1, 16)
         as snapshot_id from fx_weather_stream""",
)
@tables
def snapshot_ids(t):
    key = snapshot_id(F.col("latitude"), F.col("longitude"), F.unix_seconds("snapshot_ts"))
    return t.fx("weather_stream").select("event_id", key.alias("snapshot_id"))


# --- reference files ----------------------------------------------------------------------------


def reference_file(t, name: str, rows: DataFrame, id_column: str) -> DataFrame:
    """Rows written as the files are: latin-1, no header, some rows too short or too long."""
    path = fresh_path(t.spark, name)
    schema = schemas.REFERENCE_FILES[name]
    columns = [
        rows[f.name] if f.name in rows.columns else F.lit(None).cast("string").alias(f.name) for f in schema.fields
    ]
    number = F.col(id_column)
    kept = rows.select(*columns, number.alias("_n"))
    options = {"encoding": "ISO-8859-1", "nullValue": r"\N", "escape": '"', "header": "false", "emptyValue": ""}

    def write(part: DataFrame) -> None:
        part.write.mode("append").options(**options).csv(path)

    write(kept.filter("_n % 10 not in (3, 4)").drop("_n"))
    write(kept.filter("_n % 10 = 3").drop("_n", schema.fields[-1].name))
    write(kept.filter("_n % 10 = 4").drop("_n").withColumn("more", F.lit("extra")))
    return reference_files.read_reference(t.spark, name, path)


_FULL = "%s %% 10 <> 3"


@query(
    "s11_airports",
    f"""select cast(airport_id as integer) as airport_id, name || ' "São", é' as name, city, country, iata, icao, latitude, longitude,
          altitude_ft, nullif(tz_database, '') as tz_database, airport_type from fx_airports where {_FULL % "airport_id"}""",
)
@tables
def airports_file(t):
    rows = t.fx("airports").withColumn("name", F.concat("name", F.lit(' "São", é')))
    out = reference_file(t, "airports", rows.withColumn("source", F.lit("given")), "airport_id")
    return out.drop("timezone_offset", "dst", "source")


@query(
    "s11_airlines",
    f"""select cast(airline_id as integer) as airline_id, name, nullif(alias, '') as alias, iata, icao, country, active
        from fx_airlines where {_FULL % "airline_id"}""",
)
@tables
def airlines_file(t):
    return reference_file(t, "airlines", t.fx("airlines"), "airline_id").drop("callsign")


@query(
    "s11_routes",
    f"""select airline, src_airport, dst_airport, codeshare, case when route_id % 7 <> 0 then stops end as stops, equipment
        from fx_routes where {_FULL % "route_id"} and dst_airport is not null""",
)
@tables
def routes_file(t):
    """Every seventh route has a word where the number of stops should be."""
    stops = F.when(F.col("route_id") % 7 != 0, F.col("stops").cast("string")).otherwise("none")
    out = reference_file(t, "routes", t.fx("routes").withColumn("stops", stops), "route_id")
    return out.drop("airline_id", "src_airport_id", "dst_airport_id")


@query(
    "s11_planes",
    f"select p_name as name, p_brand as iata, case when p_partkey % 5 <> 0 then p_type end as icao from part where {_FULL % 'p_partkey'}",
)
@tables
def planes_file(t):
    rows = t.raw("part").select(
        "p_partkey",
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("iata"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("icao"),
    )
    return reference_file(t, "planes", rows, "p_partkey")


@query("s12_drop_missing_codes", "select route_id, src_airport, dst_airport from fx_routes where src_airport is not null and dst_airport is not null")
@tables
def missing_codes(t):
    marked = t.fx("routes").withColumn("dst_airport", F.coalesce("dst_airport", F.lit(reference_files.NULL_MARK)))
    return reference_files.drop_missing_codes(marked).select("route_id", "src_airport", "dst_airport")


@query("s13_load_once", "select s_suppkey, s_name from supplier")
@tables
def load_once(t):
    """The second load finds rows and leaves them alone."""
    path = fresh_path(t.spark, "once")
    rows = t.raw("supplier").select("s_suppkey", "s_name")
    reference_files.load_once_path(t.spark, path, lambda: rows)
    return reference_files.load_once_path(t.spark, path, lambda: rows.filter("s_suppkey < 0"))


@query("s15_table_scan", "select * from nation join region on n_regionkey = r_regionkey")
@tables
def table_scan(t):
    t.raw("nation").createOrReplaceTempView("scan_nation")
    t.raw("region").createOrReplaceTempView("scan_region")
    return t.spark.sql("select * from scan_nation join scan_region on n_regionkey = r_regionkey")


# --- keyed and append-only tables -----------------------------------------------------------------

_TRACK_SQL = """select track_id, icao24, time_position, callsign from (select *, row_number() over
  (partition by track_id order by time_position desc, icao24 desc) as rn from fx_flights) where rn = 1"""
_TRACK = ["track_id", "icao24", "time_position", "callsign"]


def newest() -> list:
    return [F.desc("time_position"), F.desc("icao24")]


@query("k01_upsert_latest", _TRACK_SQL)
@tables
def upsert_latest(t):
    flights = t.fx("flights").select(*_TRACK)
    target = keyed.first_per_key(flights.filter(f"time_position < {HALF}"), ["track_id"], newest())
    return keyed.upsert_latest(target, flights.filter(f"time_position >= {HALF}"), ["track_id"], newest())


@query("k01_upsert_stream", _TRACK_SQL)
@tables
def upsert_stream(t):
    table = fresh_path(t.spark, "flights")
    sink = sinks.upsert_sink(table, ["track_id"], newest())
    Replay(t).run("fx_flights", lambda s: s.select(*_TRACK), sink=sink)
    return sinks.read_keyed(t.spark, table, ["track_id"], newest()).select(*_TRACK)


_DAY_SQL = f"""select track_id, icao24, time_position, callsign from (select *, row_number() over
  (partition by track_id order by time_position desc, icao24 desc) as rn from fx_flights
  where time_position >= date_trunc('day', {AS_OF})) where rn = 1"""


@query("k02_replace_snapshot", _DAY_SQL)
@tables
def replace_snapshot(t):
    flights = t.fx("flights").select(*_TRACK)
    today = F.date_trunc("day", t.as_of)
    target = keyed.first_per_key(flights.filter(F.col("time_position") < today), ["track_id"], newest())
    return keyed.replace_snapshot(target, flights.filter(F.col("time_position") >= today), ["track_id"], newest())


@query("k02_replace_snapshot_stream", _DAY_SQL)
@tables
def replace_snapshot_stream(t):
    """The day of a position names its snapshot."""
    table = fresh_path(t.spark, "flights")
    sink = sinks.upsert_sink(table, ["track_id"], newest())
    Replay(t).run(
        "fx_flights",
        lambda s: s.select(*_TRACK, F.date_trunc("day", "time_position").alias("last_seen")),
        sink=sink,
    )
    return sinks.read_snapshot(t.spark, table, ["track_id"], "last_seen", newest()).select(*_TRACK)


@query(
    "k03_upsert_weather",
    """select * exclude (rn) from (select *, row_number() over (partition by latitude, longitude order by point_id desc) as rn
       from fx_weather) where rn = 1""",
)
@tables
def upsert_weather(t):
    """The older half of the points is the target, the newer half the batch."""
    points, place = t.fx("weather"), ["latitude", "longitude"]
    middle = points.agg((F.max("point_id") / 2).alias("middle")).scalar()
    target = keyed.first_per_key(points.filter(F.col("point_id") <= middle), place, [F.desc("point_id")])
    return keyed.upsert_latest(target, points.filter(F.col("point_id") > middle), place, [F.desc("point_id")])


@query(
    "k04_append_events",
    """select title, mag, place, make_timestamp((epoch_us(event_time) // 1000) * 1000) as event_time, true as has_own_id
       from fx_seismics""",
)
@tables
def append_events(t):
    table = fresh_path(t.spark, "seismics")
    Replay(t).run(
        "fx_seismics",
        lambda s: s.select("title", "mag", "place", epoch_to_ts(F.unix_millis("event_time"), "ms").alias("event_time")),
        sink=sinks.append_sink(table),
    )
    rows = sinks.read_batches(t.spark, table)
    copies = rows.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    return rows.join(copies, "id").select("title", "mag", "place", "event_time", (F.col("copies") == 1).alias("has_own_id"))


@query(
    "k06_epoch_to_ts",
    """select event_id, case when event_id % 5 <> 0 then to_timestamp(event_id * 100) at time zone 'UTC' end as seconds,
         make_timestamp(event_id * 100000) as millis from events""",
)
@tables
def epochs(t):
    number = F.when(F.col("event_id") % 5 != 0, F.col("event_id") * 100).otherwise(0)
    return t.raw("events").select(
        "event_id",
        epoch_to_ts(number, zero_is_null=True).alias("seconds"),
        epoch_to_ts(F.col("event_id") * 100, "ms").alias("millis"),
    )


FLUSHED = 8


@query(
    "k07_flush",
    f"""select cast({FLUSHED} as bigint) as batches, count(*) as rows, count(distinct event_id) as ids,
          true as within_bound from events""",
)
@tables
def flush(t):
    """The events wait in many files; a micro-batch takes a bounded number of them, so none is larger than its bound."""
    inbox, table = fresh_path(t.spark, "inbox"), fresh_path(t.spark, "flushed")
    events = t.raw("events").select("event_id", "ts")
    events.repartition(2 * FLUSHED, "event_id").sortWithinPartitions("event_id").write.parquet(inbox)
    files = t.spark.read.parquet(inbox).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"))
    largest = files.agg(F.max("n")).first()[0] or 0
    stream = runner.bounded_files(t.spark, inbox, events.schema, files=2)
    sink = sinks.append_sink(table, "row_id")
    runner.run_to_end(runner.start(stream, fresh_path(t.spark, "checkpoint"), sink=sink))
    rows = sinks.read_batches(t.spark, table)
    batches = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = batches.agg(F.count(F.lit(1)).alias("batches"), F.sum("n").alias("rows"), F.max("n").alias("most"))
    ids = rows.agg(F.count_distinct("event_id")).scalar()
    return sizes.select("batches", "rows", ids.alias("ids"), (F.col("most") <= 2 * largest).alias("within_bound"))


@query(
    "k08_materialize",
    """select airline_id, airline_name, 'table' as kind from v_airlines union all
       select airport_id, airport_name, 'view' from v_airports""",
)
@tables
def materialize(t):
    as_table = sinks.materialize(t.staged("airlines"), "stg_airlines", fresh_path(t.spark, "layers"))
    as_view = sinks.materialize(t.staged("airports"), "stg_airports_view")
    return as_table.select("airline_id", "airline_name", F.lit("table").alias("kind")).unionByName(
        as_view.select(
            F.col("airport_id").alias("airline_id"), F.col("airport_name").alias("airline_name"), F.lit("view").alias("kind")
        )
    )
