"""Streaming jobs, run to the end of the given tables and compared with their batch form.

In append mode a window appears once the watermark has passed its end, so the
reference SQL leaves out windows that are still open.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import keyed
from aerolith.operators.windows import tumbling_agg
from aerolith.plans import windows as win
from aerolith.session import fresh_path
from aerolith.sources import topics
from aerolith.sources.topics import arrival_time
from aerolith.streaming import reports, runner, sinks, stateful
from checks import fixtures, views
from checks.inputs import tables
from checks.q_feeds import HALF, Replay, event_stream, written
from checks.q_tables import (
    _CONTEXT_COLS, _FLIGHT_COLS, _SEISMIC_COLS, _WEATHER_COLS, T05_SQL, T06_SQL, T07_SQL, T08_SELECT,
    rounded, rounded_sql,
)
from checks.registry import AS_OF, query


def closed(delay: str, source: str) -> str:
    """Windows of a relation that a watermark with this delay has passed."""
    return f"select * from ({source}) where window_end <= {AS_OF} - interval {delay}"


def appended(t, stream):
    """Rows a query in append mode has written."""
    out = fresh_path(t.spark, "windows")
    runner.run_to_end(runner.start(stream, fresh_path(t.spark, "checkpoint"), path=out))
    return t.spark.read.parquet(out)


@query("t01_flight_tumbling_stream", rounded_sql(closed("0 second", "select * from w_flights"), *_FLIGHT_COLS))
@tables
def flight_stream(t):
    """Windows by arrival time, here the time of the record."""
    flights = event_stream(t, "fx_flights")
    flights = flights.withColumn("arrived", arrival_time(flights, "time_position"))
    return rounded(appended(t, win.flight_tumbling(flights, "arrived", watermark="0 seconds")))


@query("t02_seismic_tumbling_stream", rounded_sql(closed("30 second", "select * from w_seismics"), *_SEISMIC_COLS))
@tables
def seismic_stream(t):
    quakes = event_stream(t, "fx_seismics")
    return rounded(appended(t, win.seismic_tumbling(quakes, "event_time", watermark=win.SEISMIC_DELAY)))


@query("t03_weather_tumbling_stream", rounded_sql(closed("60 second", "select * from w_weather"), *_WEATHER_COLS))
@tables
def weather_stream(t):
    readings = event_stream(t, "fx_weather_stream")
    return rounded(appended(t, win.weather_tumbling(readings, "snapshot_ts", watermark=win.WEATHER_DELAY)))


def context_stream(t, incremental: bool):
    return win.flight_context(
        event_stream(t, "fx_flights"),
        event_stream(t, "fx_seismics"),
        event_stream(t, "fx_weather_stream"),
        "time_position", "event_time", "snapshot_ts", "6 hours",
        watermarks=(win.CONTEXT_DELAY, win.SEISMIC_DELAY, win.WEATHER_DELAY),
        incremental=incremental,
    )


@query("t04_flight_context_stream", rounded_sql(closed("60 second", "select * from w_context"), *_CONTEXT_COLS))
@tables
def flight_context_stream(t):
    return rounded(appended(t, context_stream(t, incremental=False)))


@query("t08_flight_context_incremental_stream", rounded_sql(closed("60 second", T08_SELECT), *_CONTEXT_COLS))
@tables
def flight_context_incremental_stream(t):
    return rounded(appended(t, context_stream(t, incremental=True)))


def upserted(t, name: str, build, keys: list[str], count: str):
    """Windows kept up to date in a keyed table while the events arrive in two halves; a window's count grows."""
    table = fresh_path(t.spark, "windows")
    Replay(t).run(name, build, sink=sinks.upsert_sink(table, keys, [F.desc(count)]), mode="update")
    return rounded(sinks.read_keyed(t.spark, table, keys, [F.desc(count)]))


@query("t05_flight_tumbling_updates", T05_SQL)
@tables
def flight_updates(t):
    def build(s):
        return win.flight_tumbling_incremental(s, "time_position", watermark="0 seconds")

    return upserted(t, "fx_flights", build, ["window_start", "window_end", "origin_country"], "flight_count")


@query("t06_seismic_tumbling_updates", T06_SQL)
@tables
def seismic_updates(t):
    def build(s):
        return win.seismic_tumbling_incremental(s, "event_time", watermark=win.SEISMIC_DELAY)

    return upserted(t, "fx_seismics", build, ["window_start", "window_end", "region"], "event_count")


@query("t07_weather_tumbling_updates", T07_SQL)
@tables
def weather_updates(t):
    def build(s):
        return win.weather_tumbling_incremental(s, "snapshot_ts", watermark=win.WEATHER_DELAY)

    return upserted(t, "fx_weather_stream", build, ["window_start", "window_end", "region_name"], "snapshot_count")


@query(
    "k05_upsert_window",
    """select window_start, window_end, region_name, snapshot_count from w_weather""",
)
@tables
def upsert_window(t):
    def build(s):
        return win.weather_tumbling(s, "snapshot_ts", watermark=win.WEATHER_DELAY)

    rows = upserted(t, "fx_weather_stream", build, ["window_start", "window_end", "region_name"], "snapshot_count")
    return rows.select("window_start", "window_end", "region_name", "snapshot_count")


@query(
    "t10_late_rows",
    "select window_start, window_end, region_name, snapshot_count from ("
    + closed("60 second", views.windows("fx_weather_stream", "snapshot_ts", "region_name as region_name", "count(*) as snapshot_count",
                                        f"snapshot_ts >= {HALF}")) + ")",
)
@tables
def late_rows(t):
    """The older half arrives last, behind the watermark, and is dropped."""
    out = fresh_path(t.spark, "windows")
    Replay(t, newest_first=True).run(
        "fx_weather_stream",
        lambda s: win.weather_tumbling(s, "snapshot_ts", watermark=win.WEATHER_DELAY),
        path=out,
    )
    return t.spark.read.parquet(out).select("window_start", "window_end", "region_name", "snapshot_count")


@query(
    "t13_rekey",
    f"""select * from (select w as window_start, w + interval 6 hour as window_end, grp, count(*) as n from (
          select time_bucket(interval 6 hour, event_time) as w, id % 25 as grp from fx_seismics) group by w, grp)
        where window_end <= {AS_OF}""",
)
@tables
def rekey(t):
    """A stream grouped by a key derived from its rows is shuffled by it."""
    stream = event_stream(t, "fx_seismics").withColumn("grp", F.col("id") % 25)
    return appended(t, tumbling_agg(stream, "event_time", "6 hours", ["grp"], [F.count(F.lit(1)).alias("n")], "0 seconds"))


def longest_climb() -> stateful.Reducer:
    """The longest run of rising altitudes among a window's positions in order of time."""

    def longest(samples: list) -> tuple:
        best = run = 0
        before = None
        for _, _, altitude in sorted(samples):
            run = run + 1 if before is not None and altitude > before else 1
            best, before = max(best, run), altitude
        return best, len(samples)

    return stateful.Reducer(
        initial=list,
        add=lambda samples, row: [*samples, (row["_at"], row["icao24"], row["baro_altitude"])],
        merge=lambda a, b: a + b,
        result=longest,
        ddl="longest_climb int, positions int",
    )


_CLIMB_SQL = """select window_start, window_start + interval 6 hour as window_end, origin_country,
    cast(max(steps) as integer) as longest_climb, cast(sum(steps) as integer) as positions
  from (select window_start, origin_country, run, count(*) as steps from (
    select *, sum(case when baro_altitude > before then 0 else 1 end) over (
      partition by window_start, origin_country order by time_position, icao24 rows unbounded preceding) as run from (
        select *, lag(baro_altitude) over (partition by window_start, origin_country order by time_position, icao24) as before
        from (select *, time_bucket(interval 6 hour, time_position) as window_start from fx_flights
              where origin_country is not null and baro_altitude is not null)))
    group by all) group by all"""


def climbs(flights):
    known = flights.filter("origin_country is not null and baro_altitude is not null")
    known = known.select("time_position", "icao24", "origin_country", "baro_altitude")
    return stateful.reduce_windows(known, "time_position", "6 hours", ["origin_country"], longest_climb(), "0 seconds")


@query("g13_user_reduce", _CLIMB_SQL)
@tables
def user_reduce(t):
    return climbs(t.fx("flights"))


@query("g13_user_reduce_stream", f"select * from ({_CLIMB_SQL}) where window_end <= (select max(time_position) from fx_flights "
       "where origin_country is not null and baro_altitude is not null)")  # fmt: skip
@tables
def user_reduce_stream(t):
    """The events arrive in two halves; the second run goes on with the folded windows of the first."""
    out = fresh_path(t.spark, "climbs")
    Replay(t).run("fx_flights", climbs, path=out)
    return t.spark.read.parquet(out)


@query(
    "s07_newer_than_stream",
    f"""select minute, event_id from (select date_trunc('minute', event_time) as minute, id as event_id,
          row_number() over (partition by date_trunc('minute', event_time) order by id) as rn from fx_seismics
          where date_trunc('minute', event_time) > {HALF} - interval 7 day) where rn = 1""",
)
@tables
def newer_than_stream(t):
    """The mark of the first half is found again by the second run."""
    out = fresh_path(t.spark, "newer")

    def build(s):
        minutes = s.select(F.date_trunc("minute", "event_time").alias("minute"), F.col("id").alias("event_id"))
        return keyed.newer_than(minutes, "minute", F.expr(f"{HALF} - interval 7 days"), ["event_id"])

    Replay(t).run("fx_seismics", build, path=out)
    return t.spark.read.parquet(out)


_SIDE_CELL = "cast(floor(lat / 5) as integer) as cell_lat, cast(floor(lon / 5) as integer) as cell_lon"


@query(
    "j16_side_state",
    f"""select f.icao24, f.cell_lat, f.cell_lon, f.time_position,
      case when q.event_time >= f.time_position - interval 6 hour then q.id end as quake_id
    from (select icao24, time_position, cast(floor(latitude / 5) as integer) as cell_lat,
            cast(floor(longitude / 5) as integer) as cell_lon from fx_flights) f
    asof left join (select {_SIDE_CELL}, event_time, max(id) as id from fx_seismics group by all) q
      on f.cell_lat = q.cell_lat and f.cell_lon = q.cell_lon and f.time_position >= q.event_time""",
)
@tables
def side_state(t):
    """Each flight meets the newest quake known in its cell when it arrives, if that is six hours old at most."""
    events, inbox = t.raw("events"), fresh_path(t.spark, "inbox")
    out, checkpoint = fresh_path(t.spark, "sides"), fresh_path(t.spark, "checkpoint")

    def cell(lat: str, lon: str):
        return [F.floor(F.col(c) / 5).cast("int").alias(n) for c, n in ((lat, "cell_lat"), (lon, "cell_lon"))]

    for half in (f"ts < {HALF}", f"ts >= {HALF}"):
        events.filter(half).write.mode("append").parquet(inbox)
        stream = t.spark.readStream.schema(events.schema).parquet(inbox)
        flights = fixtures.shape(stream, "fx_flights").select("icao24", *cell("latitude", "longitude"), "time_position")
        quakes = fixtures.shape(stream, "fx_seismics").select(*cell("lat", "lon"), "id", "event_time")
        joined = stateful.with_newest_sides(
            flights, "time_position", ["cell_lat", "cell_lon"], {"quake": (quakes, "event_time", "id")}, "6 hours"
        )
        runner.run_to_end(runner.start(joined, checkpoint, path=out))
    return t.spark.read.parquet(out)


@query(
    "s14_malformed_report",
    """select 'decode' as metric, 'read' as name, count(*) as value from fx_seismics
       union all select 'decode', 'dropped', count(*) from fx_seismics where id % 7 = 0
       union all select 'rules', 'rows', count(*) from fx_seismics where id % 7 <> 0
       union all select 'rules', 'place not_null', count(*) from fx_seismics where id % 7 <> 0 and place is null
       union all select 'rules', 'depth non_negative', count(*) from fx_seismics where id % 7 <> 0 and depth < 0
       union all select 'batch', 'late', 0""",
)
@tables
def malformed_report(t):
    """Every seventh message is cut short; the listener's table has the counts of all batches."""
    schema = T.StructType.fromDDL("id long, place string, depth double")
    rows = t.fx("seismics").select("id", "place", "depth")
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    cut = rows.select(F.when(F.col("id") % 7 == 0, F.left(line, F.lit(9))).otherwise(line).alias("value"))
    inbox, report = written(cut.repartition(6), "topic"), fresh_path(t.spark, "report")
    decoded = topics.drop_malformed(topics.read_message_files(t.spark, inbox, maxFilesPerTrigger=2), schema)
    checked = reports.observe_rules(decoded, [("place", "not_null"), ("depth", "non_negative")])
    listener = reports.BatchReport(t.spark, report)
    t.spark.streams.addListener(listener)
    try:
        query_ = runner.start(checked, fresh_path(t.spark, "checkpoint"), path=fresh_path(t.spark, "decoded"))
        runner.run_to_end(query_)
        listener.wait_for(query_)
    finally:
        t.spark.streams.removeListener(listener)
    counts = reports.read_report(t.spark, report).filter("not (metric = 'batch' and name = 'rows')")
    return counts.groupBy("metric", "name").agg(F.sum("value").alias("value"))


@query("t14_restart", "select window_start, window_end, region_name, snapshot_count from w_weather "
       f"where window_end <= {AS_OF} - interval 60 second")  # fmt: skip
@tables
def restart(t):
    """Windows of both halves in append mode; the second run starts from the checkpoint."""
    out = fresh_path(t.spark, "windows")
    Replay(t).run(
        "fx_weather_stream",
        lambda s: win.weather_tumbling(s, "snapshot_ts", watermark=win.WEATHER_DELAY),
        path=out,
    )
    return t.spark.read.parquet(out).select("window_start", "window_end", "region_name", "snapshot_count")
