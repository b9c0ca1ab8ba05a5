"""Streaming runs on hand-made input: late rows, restarts, snapshots, idle inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators.keyed import first_seen, newer_than
from aerolith.operators.windows import tumbling_agg
from aerolith.plans import windows as win
from aerolith.session import fresh_path, shared_dir
from aerolith.streaming import reports, runner, sinks, stateful

def counted():
    return [F.count(F.lit(1)).alias("n")]


class Feed:
    """A folder that rows are added to, and a query that is run after each addition."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.path, self.checkpoint = fresh_path(spark, "feed"), fresh_path(spark, "checkpoint")

    def add(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        df = df.withColumns({n: F.col(n).cast("timestamp") for n, _ in df.dtypes if n.endswith("ts")})
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.columns = df.schema

    def stream(self):
        return self.spark.readStream.schema(self.columns).parquet(self.path)

    def run(self, build, **target):
        return runner.run_to_end(runner.start(build(self.stream()), self.checkpoint, **target))


def clock(minute, second=0):
    return f"2024-01-01 00:{minute:02d}:{second:02d}"


def test_a_late_row_is_dropped_and_a_slightly_late_one_counts(spark):
    feed, out = Feed(spark, "ts string, k string"), fresh_path(spark, "out")

    def build(s):
        return tumbling_agg(s, "ts", "5 minutes", ["k"], counted(), "60 seconds")

    feed.add([(clock(1), "a"), (clock(5, 50), "a")])
    feed.run(build, path=out)
    feed.add([(clock(2), "a"), (clock(12), "a")])  # 00:02 is behind 00:05:50, its window is still open
    feed.run(build, path=out)
    feed.add([(clock(3), "a"), (clock(30), "a")])  # the window of 00:03 was closed by 00:12
    feed.run(build, path=out)
    got = {(str(r.window_start)[14:16], r.n) for r in spark.read.parquet(out).collect()}
    assert got == {("00", 2), ("05", 1), ("10", 1)}


def test_updates_survive_a_repeated_batch(spark):
    feed, table = Feed(spark, "ts string, origin_country string"), fresh_path(spark, "table")
    keys = ["window_start", "window_end", "origin_country"]
    plain = sinks.upsert_sink(table, keys, [F.desc("window_end")])
    written = []

    def sink(batch, batch_id):
        plain(batch, batch_id)
        plain(batch, batch_id)  # as if the batch ran again after a failure
        written.append(batch_id)

    def build(s):
        full = s.withColumns(
            {"on_ground": F.lit(None).cast("boolean"), "baro_altitude": F.lit(float("nan")), "velocity": F.lit(2.0)}
        )
        return win.flight_tumbling_incremental(full, "ts", watermark="0 seconds")

    feed.add([(clock(1), "A"), (clock(1), None)])
    feed.run(build, sink=sink, mode="update")
    feed.add([(clock(2), "A"), (clock(7), "B")])
    feed.run(build, sink=sink, mode="update")
    rows = sinks.read_keyed(spark, table, keys, [F.desc("flight_count")]).collect()
    got = {(r.origin_country, r.flight_count, r.airborne_count, r.avg_altitude_m, r.avg_velocity_ms) for r in rows}
    assert got == {("A", 2, 2, None, 2.0), ("B", 1, 1, None, 2.0)}
    assert written == sorted(set(written)) and len(written) >= 2  # the restart went on counting


def test_a_snapshot_over_two_batches_stays_whole(spark):
    feed, table = Feed(spark, "k string, snap int, v int"), fresh_path(spark, "table")
    sink = sinks.upsert_sink(table, ["k"], [F.desc("snap"), F.desc("v")])
    for rows in ([("a", 1, 1), ("b", 1, 1)], [("a", 2, 2), ("a", 2, 3)], [("c", 2, 2)]):
        feed.add(rows)
        feed.run(lambda s: s, sink=sink)
    order = [F.desc("snap"), F.desc("v")]
    state = sinks.read_snapshot(spark, table, ["k"], "snap", order)
    assert {(r.k, r.v) for r in state.collect()} == {("a", 3), ("c", 2)}
    folded = sinks.compact(spark, table, ["k"], order)
    assert {(r.k, r.v) for r in folded.collect()} == {("a", 3), ("b", 1), ("c", 2)}
    assert sinks.read_batches(spark, table).count() == 3
    feed.add([("b", 2, 9)])
    feed.run(lambda s: s, sink=sink)
    assert {(r.k, r.v) for r in sinks.read_keyed(spark, table, ["k"], order).collect()} == {("a", 3), ("b", 9), ("c", 2)}


def test_a_late_record_and_a_new_checkpoint_lose_nothing(spark):
    table, order = fresh_path(spark, "table"), [F.desc("snap")]
    sink = sinks.upsert_sink(table, ["k"], order)
    first = Feed(spark, "k string, snap int")
    first.add([("a", 10), ("b", 10)])
    first.run(lambda s: s, sink=sink)
    first.add([("a", 5)])
    first.run(lambda s: s, sink=sink)
    state = {tuple(r) for r in sinks.read_keyed(spark, table, ["k"], order).collect()}
    assert state == {("a", 10), ("b", 10)}
    assert {r.k for r in sinks.read_snapshot(spark, table, ["k"], "snap", order).collect()} == {"a", "b"}
    second = Feed(spark, "k string, snap int")
    second.add([("c", 11)])
    second.run(lambda s: s, sink=sink)
    state = {tuple(r) for r in sinks.read_keyed(spark, table, ["k"], order).collect()}
    assert state == {("a", 10), ("b", 10), ("c", 11)}


def test_appended_ids_do_not_change_on_a_second_write(spark):
    path = fresh_path(spark, "appended")
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    sink = sinks.append_sink(path)
    sink(batch, 0)
    first = sorted(r.id for r in sinks.read_batches(spark, path).collect())
    sink(batch, 0)
    assert sorted(r.id for r in sinks.read_batches(spark, path).collect()) == first


def test_an_idle_input_holds_the_context_back(spark):
    flights = Feed(spark, "ts string, latitude double, longitude double, baro_altitude double, on_ground boolean")
    quakes = Feed(spark, "ts string, lat double, lon double, mag double, tsunami int")
    weather = Feed(spark, "ts string, latitude double, longitude double, temperature_c double, windgusts_ms double, visibility_m double")
    out = fresh_path(spark, "context")
    flights.add([(clock(1), 1.0, 1.0, 100.0, False), (clock(2), 55.0, 1.0, None, True), (clock(20), 1.0, 1.0, 5.0, False)])
    quakes.add([(clock(1), 2.0, 2.0, 4.5, 1), (clock(20), 80.0, 1.0, 1.0, 0)])
    weather.add([(clock(1), 40.0, 40.0, 10.0, 5.0, 900.0)])

    def run():
        context = win.flight_context(
            flights.stream(), quakes.stream(), weather.stream(), "ts", "ts", "ts",
            watermarks=(win.CONTEXT_DELAY, win.SEISMIC_DELAY, win.WEATHER_DELAY),
        )
        runner.run_to_end(runner.start(context, flights.checkpoint, path=out))
        return spark.read.schema(context.schema).parquet(out).collect()

    assert run() == []  # weather has not passed the first window
    # After a restart every input counts as idle until it brings a row.
    flights.add([(clock(21), 1.0, 1.0, 5.0, False)])
    quakes.add([(clock(21), 80.0, 1.0, 1.0, 0)])
    weather.add([(clock(21), 40.0, 40.0, 10.0, 5.0, 900.0)])
    got = {r.grid_lat: r for r in run()}
    assert set(got) == {0, 50}
    assert (got[0].flight_count, got[0].nearby_eq_count, got[0].max_eq_magnitude, got[0].tsunami_count) == (1, 1, 4.5, 1)
    assert (got[50].nearby_eq_count, got[50].max_eq_magnitude, got[50].avg_temperature_c) == (0, 0.0, 0.0)


def test_seen_ids_of_a_stream(spark):
    feed, out = Feed(spark, "ts string, id string"), fresh_path(spark, "seen")

    def build(s):
        return first_seen(s.withWatermark("ts", "10 minutes"), "id")

    feed.add([(clock(1), "a"), (clock(1), "a"), (clock(2), "b")])
    feed.run(build, path=out)
    feed.add([(clock(3), "a"), (clock(3), "c")])
    feed.run(build, path=out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_settings_are_restored_and_the_shared_folder_is_the_named_one(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runner.stream_conf(spark, partitions=3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert runner.flush_options("flights") == {"maxOffsetsPerTrigger": "9000"}


def test_processing_time_query_runs_until_stopped(spark):
    feed, table = Feed(spark, "id int"), fresh_path(spark, "table")
    feed.add([(1,), (2,)])
    query = runner.start(feed.stream(), feed.checkpoint, sink=sinks.append_sink(table, "key"), every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert sinks.read_batches(spark, table).count() == 2


@pytest.mark.parametrize("path", ["missing"])
def test_missing_table_reads_as_empty(spark, path):
    empty = sinks.read_or_empty(spark, f"{shared_dir(spark)}/{path}", spark.range(1).schema)
    assert empty.count() == 0


def test_a_record_without_event_time_counts_at_its_arrival(spark):
    flights = spark.createDataFrame(
        [("1970-01-01 00:00:00", "2024-01-01 00:07:00"), (None, "2024-01-01 00:08:00"), ("2024-01-01 00:01:00", "2024-01-01 00:09:00")],
        "ts string, arrived string",
    ).select(F.col("ts").cast("timestamp"), F.col("arrived").cast("timestamp"), F.lit(1.0).alias("latitude"),
             F.lit(2.0).alias("longitude"), F.lit(3.0).alias("baro_altitude"), F.lit(False).alias("on_ground"))
    quakes = spark.createDataFrame([], "ts timestamp, lat double, lon double, mag double, tsunami int")
    weather = spark.createDataFrame(
        [], "ts timestamp, latitude double, longitude double, temperature_c double, windgusts_ms double, visibility_m double"
    )
    context = win.flight_context(
        flights, quakes, weather, "ts", "ts", "ts", "5 minutes", incremental=True, arrivals=("arrived", None, None)
    )
    got = {(str(r.window_start), r.flight_count) for r in context.collect()}
    assert got == {("2024-01-01 00:00:00", 1), ("2024-01-01 00:05:00", 2)}


def test_state_partitions_can_be_set(spark):
    assert runner.state_partitions(spark) == spark.sparkContext.defaultParallelism
    spark.conf.set(runner.STATE_PARTITIONS, "37")
    try:
        assert runner.state_partitions(spark) == 37
    finally:
        spark.conf.unset(runner.STATE_PARTITIONS)


def test_a_new_checkpoint_and_a_fold_need_the_order_of_the_records(spark):
    table, order = fresh_path(spark, "table"), [F.desc("n")]
    sink = sinks.upsert_sink(table, ["k"], order)
    old = Feed(spark, "k string, n int")
    for n in (1, 2, 3):
        old.add([("a", n)])
        old.run(lambda s: s, sink=sink)
    sinks.compact(spark, table, ["k"], order)
    new = Feed(spark, "k string, n int")  # its first batch has number 0, the fold has number 2
    new.add([("a", 9)])
    new.run(lambda s: s, sink=sink)
    assert [r.n for r in sinks.read_keyed(spark, table, ["k"], order).collect()] == [9]
    with pytest.raises(ValueError, match="order"):
        sinks.read_keyed(spark, table, ["k"], [])


def test_high_water_mark_on_a_stream(spark):
    feed, out = Feed(spark, "at long, name string, source string"), fresh_path(spark, "out")

    def build(s):
        return newer_than(s, "at", F.lit(10), ["name"], ["source"])

    feed.add([(12, "b", "x"), (12, "a", "x"), (11, "c", "x"), (10, "old", "x"), (None, "no time", "x"), (5, "old", "y")])
    feed.run(build, path=out)
    feed.add([(12, "again", "x"), (11, "late", "x"), (13, "new", "x"), (11, "first", "y"), (20, "null feed", None)])
    feed.run(build, path=out)  # from the checkpoint, with the marks of the run before
    feed.add([(13, "again", "x"), (20, "again", None), (21, None, None), (21, "d", None)])
    feed.run(build, path=out)
    got = sorted((str(r.source), r.at, str(r.name)) for r in spark.read.parquet(out).collect())
    assert got == [
        ("None", 20, "null feed"), ("None", 21, "d"),
        ("x", 11, "c"), ("x", 12, "a"), ("x", 13, "new"), ("y", 11, "first"),
    ]
    with pytest.raises(ValueError):
        stateful.above_mark(spark.range(1), "id", [])


def spread():
    """Largest minus smallest value and the longest name: needs both ends, so partial results have to be merged."""
    return stateful.Reducer(
        initial=lambda: [],
        add=lambda held, row: [*held, (row["v"], row["name"] or "")],
        merge=lambda a, b: a + b,
        result=lambda held: (max(v for v, _ in held) - min(v for v, _ in held), max((len(n), n) for _, n in held)[1]),
        ddl="width double, longest string",
    )


def test_user_reduce_equals_a_plain_fold(spark):
    rng = random.Random(3)
    rows = [
        (clock(rng.randint(0, 40), rng.randint(0, 59)), rng.choice(["a", "b", None]), rng.random(), rng.choice(["x", "yy", "z" * 9, None]))
        for _ in range(300)
    ]
    feed, out = Feed(spark, "ts string, k string, v double, name string"), fresh_path(spark, "out")

    def build(s):
        return stateful.reduce_windows(s, "ts", "5 minutes", ["k"], spread(), "1 hour")

    rows.sort(key=lambda r: r[0])
    half = rows[:150], rows[150:]
    for part in half:
        feed.add(part)
        feed.run(build, path=out)
    feed.add([("2024-01-01 05:00:00", "end", 0.0, "")])  # moves the watermark past all windows
    feed.run(build, path=out)
    expected = {}
    for (start, k), own in itertools.groupby(
        sorted(((int(ts[14:16]) // 5 * 5, k or ""), (v, n or "")) for ts, k, v, n in rows), key=lambda r: r[0]
    ):
        held = [x for _, x in own]
        expected[start, k] = max(v for v, _ in held) - min(v for v, _ in held), max((len(n), n) for _, n in held)[1]
    plain = spark.createDataFrame(rows, feed.schema).withColumn("ts", F.col("ts").cast("timestamp")).repartition(4)
    batch = stateful.reduce_windows(plain, "ts", "5 minutes", ["k"], spread())
    for found in (spark.read.parquet(out), batch):
        got = {(r.window_start.minute, r.k or ""): (r.width, r.longest) for r in found.collect()}
        assert got.keys() == expected.keys()
        assert all(abs(got[k][0] - expected[k][0]) < 1e-9 and got[k][1] == expected[k][1] for k in got)


def test_side_state_is_carried_on_and_expires(spark):
    out, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "checkpoint")
    main = Feed(spark, "ts string, cell int, name string")
    side = Feed(spark, "side_ts string, cell int, id long, mag double")

    def run(flights, quakes):
        main.add(flights)
        side.add(quakes)
        joined = stateful.with_newest_sides(
            main.stream(), "ts", ["cell"], {"quake": (side.stream(), "side_ts", "id")}, "30 minutes", "1 hour"
        )
        runner.run_to_end(runner.start(joined, checkpoint, path=out))

    run([(clock(1), 1, "before"), (clock(10), 1, "with"), (clock(10), 2, "elsewhere")],
        [(clock(5), 1, 1, 4.0), (clock(10), 1, 2, 5.0), (clock(10), 1, 2**62 + 3, 6.0)])
    run([(clock(30), 1, "kept"), (clock(45), 1, "too old")], [(clock(59), 2, 9, None)])
    run([(clock(59), 2, "same time")], [(clock(8), 1, 7, 1.0)])  # an older quake does not replace a newer one
    run([(clock(20), 1, "still the newest")], [(clock(59), 3, 9, None)])
    got = {r.name: (r.quake_id, r.quake_mag) for r in spark.read.parquet(out).collect()}
    nothing = (None, None)
    assert got == {
        "before": nothing, "with": (2**62 + 3, 6.0), "elsewhere": nothing, "kept": (2**62 + 3, 6.0), "too old": nothing,
        "same time": (9, None), "still the newest": (2**62 + 3, 6.0),
    }


def test_report_of_late_rows_and_failed_rules(spark):
    feed, path = Feed(spark, "ts string, k string"), fresh_path(spark, "report")
    listener = reports.BatchReport(spark, path)
    spark.streams.addListener(listener)
    out = fresh_path(spark, "out")
    try:
        for rows in ([(clock(1), "a"), (clock(40), None)], [(clock(2), "a"), (clock(50), "b")]):
            feed.add(rows)
            checked = reports.observe_rules(feed.stream(), [("k", "not_null")])
            agg = tumbling_agg(checked, "ts", "5 minutes", ["k"], counted(), "60 seconds")
            query = runner.start(agg, feed.checkpoint, path=out)
            runner.run_to_end(query)
            listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    rows = reports.read_report(spark, path).groupBy("metric", "name").agg(F.sum("value").alias("n")).collect()
    got = {(r.metric, r.name): r.n for r in rows}
    assert got["rules", "rows"] == 4 and got["rules", "k not_null"] == 1 and got["batch", "late"] == 1


def test_a_flush_is_bounded_by_files(spark):
    feed, table = Feed(spark, "n int"), fresh_path(spark, "table")
    for k in range(6):
        feed.add([(10 * k + j,) for j in range(k + 1)])
    stream = runner.bounded_files(spark, feed.path, feed.columns, files=1)
    runner.run_to_end(runner.start(stream, feed.checkpoint, sink=sinks.append_sink(table, "row_id")))
    rows = sinks.read_batches(spark, table)
    assert sorted(r["count"] for r in rows.groupBy("batch_id").count().collect()) == [1, 2, 3, 4, 5, 6]
    assert rows.select("n").distinct().count() == 21
