"""Roll-ups, stored tables, sketches, bounded windows, geodesics and binary points."""

import math
import random
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolith.functions import geo
from aerolith.operators import keyed
from aerolith.operators.profiles import averaged, counted, highest, profile, sketched
from aerolith.operators.windows import whole_windows
from aerolith.plans import rollups
from aerolith.plans import windows as win
from aerolith.session import configure
from aerolith.streaming.sinks import materialize, newest_partition, newest_rows_of
from checks.catalog import QUERIES
from checks.inputs import Tables

SF = "/root/testdata/sf0.001"
BEGIN = datetime(2024, 3, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def at(text):
    return F.lit(text).cast("timestamp")


# --- roll-ups -----------------------------------------------------------------------------------


def measures():
    return [counted("n"), averaged("mean", F.col("x")), highest("top", F.col("x"))]


@pytest.fixture(scope="module")
def events(spark):
    configure(spark)
    rng = random.Random(5)
    made = [(BEGIN + timedelta(seconds=rng.randrange(4 * 86400)), rng.choice("aaab"), float(rng.randrange(100))) for _ in range(4000)]
    made += [(None, "a", 1.0), (BEGIN + timedelta(days=1), None, None), (BEGIN + timedelta(days=2), "a", None)]
    return spark.createDataFrame(made, "ts timestamp, k string, x double").cache()


SPANS = [
    ("2024-03-01 00:00:00", "2024-03-05 00:00:00"),
    ("2024-03-01 07:31:17", "2024-03-04 22:02:59"),
    ("2024-03-02 10:01:00", "2024-03-02 10:03:00"),
    ("2024-03-02 10:59:59", "2024-03-02 11:00:01"),
    ("2024-03-02 23:58:00", "2024-03-03 00:07:00"),
    ("2024-03-01 13:00:00", "2024-03-02 13:00:00"),
    ("2024-03-03 00:00:00", "2024-03-03 00:00:00"),
    ("2030-01-01 00:00:00", "2031-01-01 00:00:00"),
]


@pytest.mark.parametrize("since, until", SPANS)
def test_a_look_back_equals_the_direct_aggregate(spark, events, tmp_path_factory, since, until):
    tree = rollups.store_tree(events, "ts", ["k"], measures(), str(tmp_path_factory.mktemp("tree") / "t"))
    inside = events.filter((F.col("ts") >= at(since)) & (F.col("ts") < at(until)))
    direct = inside.groupBy("k").agg(F.count(F.lit(1)), F.avg("x"), F.max("x"))
    found = rollups.look_back(tree, events, "ts", ["k"], measures(), at(since), at(until))
    assert rows(found) == rows(direct)
    hours = rollups.hourly(tree, events, "ts", [], measures(), at(since), at(until))
    by_hour = inside.groupBy(F.date_trunc("hour", "ts")).agg(F.count(F.lit(1)), F.avg("x"), F.max("x"))
    assert rows(hours) == rows(by_hour)


def test_a_look_back_takes_few_nodes_and_prunes_folders(spark, events, tmp_path):
    tree = rollups.store_tree(events, "ts", [], measures(), str(tmp_path / "t"))
    nodes = rollups.cover(tree, events, "ts", [], measures(), at("2024-03-01 07:31:17"), at("2024-03-04 22:02:59"))
    assert nodes.count() <= 2 + 16 + 22 + 5 + 1 + 2  # days, hours and slots at both ends, the edges
    assert "PartitionFilters: [isnotnull(node_level" in plan(nodes)


def test_an_empty_tree(spark, events, tmp_path):
    none = events.limit(0)
    tree = rollups.store_tree(none, "ts", ["k"], measures(), str(tmp_path / "t"))
    assert rollups.look_back(tree, none, "ts", ["k"], measures(), at(SPANS[0][0]), at(SPANS[0][1])).count() == 0
    tree = rollups.store_tree(none, "ts", [], measures(), str(tmp_path / "g"))
    assert rows(rollups.look_back(tree, none, "ts", [], measures(), at(SPANS[0][0]), at(SPANS[0][1]))) == [(0, None, None)]


# --- sketches -----------------------------------------------------------------------------------


def test_sketches_are_near_and_merge_in_a_tree(spark, tmp_path):
    configure(spark)
    made = spark.range(0, 60000, 1, 4).select(
        (F.lit(BEGIN.timestamp()).cast("long") + F.col("id") % 7200).cast("timestamp").alias("ts"),
        F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 30 == 0, "small").otherwise("none").alias("k"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).when(F.col("id") % 30 == 0, (F.col("id") % 7).cast("string")).alias("v"),
    )
    exact = {r.k: r.n for r in made.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    sketch = [sketched("about", F.col("v"))]
    for found in (
        profile(made, ["k"], sketch),
        rollups.look_back(
            rollups.store_tree(made, "ts", ["k"], sketch, str(tmp_path / "t")), made, "ts", ["k"], sketch,
            at("2000-01-01 00:00:00"), at("2050-01-01 00:00:00"),
        ),
    ):
        about = {r.k: r.about for r in found.collect()}
        assert about["none"] == 0 and about["small"] == exact["small"] == 7
        assert abs(about["big"] - exact["big"]) < 0.05 * exact["big"]


# --- stored tables ------------------------------------------------------------------------------


def test_the_newest_window_is_read_from_one_partition(spark, tmp_path):
    configure(spark)
    table = spark.range(0, 1000).select(
        (F.col("id") % 5).alias("k"), F.timestamp_seconds(F.lit(1709251200) + F.col("id") * 600).alias("window_end")
    ).withColumn("day", F.to_date("window_end"))
    stored = materialize(table, "w", str(tmp_path), partition_by=["day"], sort_by=["window_end"])
    assert stored.count() == 1000 and len(stored.inputFiles()) == 7
    newest = newest_rows_of(spark, f"{tmp_path}/w", "day")
    assert rows(newest.select("k", "window_end")) == rows(keyed.latest_window(table).select("k", "window_end"))
    assert newest_partition(spark, f"{tmp_path}/w", "day") == "2024-03-07"
    day = stored.filter(F.col("day") == F.lit("2024-03-07").cast("date"))
    assert day.select(F.input_file_name()).distinct().count() == 1
    assert plan(newest).count("PartitionFilters: [isnotnull(day") == plan(newest).count("PartitionFilters:") >= 2
    salted = materialize(table, "s", str(tmp_path), partition_by=["day"], salts=3)
    assert rows(salted.select("k", "window_end")) == rows(table.select("k", "window_end"))
    assert newest_partition(spark, f"{tmp_path}/nothing", "day") is None


# --- bounded windows ----------------------------------------------------------------------------


@pytest.mark.parametrize("as_of", ["2024-03-05 00:00:00", "2024-03-02 11:13:00", "2025-01-01 00:00:00"])
def test_bounded_rows_keep_the_span_and_the_newest_window(events, as_of):
    def windows(df):
        return df.groupBy(F.window("ts", "5 minutes")["end"].alias("window_end"), "k").count()

    bounded, whole = windows(whole_windows(events, "ts", "5 minutes", "2 hours", at(as_of))), windows(events)
    assert rows(keyed.latest_window(bounded, bounded=True)) == rows(keyed.latest_window(whole))
    recent = [keyed.recent(w, "window_end", "2 hours", at(as_of)) for w in (bounded, whole)]
    assert rows(recent[0]) == rows(recent[1])
    only = windows(whole_windows(events, "ts", "5 minutes", "2 hours", at(as_of), newest=False))
    assert rows(keyed.recent(only, "window_end", "2 hours", at(as_of))) == rows(recent[1])


def test_a_bounded_newest_window_is_computed_once(spark):
    t = Tables(configure(spark), SF)
    once = keyed.latest_window(win.flight_tumbling(t.fx("flights"), "time_position"), bounded=True)
    assert plan(once).count("FileScan") == 1 and plan(once).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["m06_seismic_activity", "q05_flight_trend"])
def test_marts_with_a_span_bound_every_scan_of_events(spark, name):
    text = plan(QUERIES[name](configure(spark), SF))
    scans = [line for line in text.splitlines() if "FileScan" in line and "events.parquet" in line]
    assert scans and all("GreaterThanOrEqual(ts" in line for line in scans)


# --- the spheroid -------------------------------------------------------------------------------

# (lat, lon, lat, lon, metres): published results of the inverse problem on WGS84 or GRS80.
PUBLISHED = [
    (40.6, -73.8, 51.6, -0.5, 5551759.400),
    (-41.32, 174.81, 40.96, -5.50, 19959679.267),
    (-30.0, 0.0, 29.9, 179.8, 19989832.828),
    (0.0, 0.0, 0.5, 179.5, 19936288.579),
    (0.0, 0.0, 0.0, 179.5, 19980861.909),
    (-90.0, 0.0, 90.0, 0.0, 20003931.459),
    (30.0, 10.0, -30.0, -170.0, 20003931.459),
    (0.0, 0.0, 0.0, 90.0, 6378137 * math.pi / 2),
    (-37.951033416667, 144.424867888889, -37.652821138889, 143.926495527778, 54972.271),
]


def test_geodesics_meet_published_distances(spark):
    df = spark.createDataFrame(PUBLISHED, "a double, b double, c double, d double, m double")
    ahead = geo.geodesic_m(*[F.col(x) for x in "abcd"])
    back = geo.geodesic_m(*[F.col(x) for x in "cdab"])
    for r in df.select("m", ahead.alias("ahead"), back.alias("back")).collect():
        assert r.ahead == pytest.approx(r.m, abs=0.01) and r.back == pytest.approx(r.ahead, abs=1e-3)


def test_geodesic_edges(spark):
    made = [(1.0, 1.0, 1.0, 1.0), (10.0, 179.9, 10.0, -179.9), (None, 0.0, 0.0, 0.0), (0.0, 0.0, 91.0, 0.0), (float("nan"), 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(made, "a double, b double, c double, d double")
    found = [r.m for r in df.select(geo.geodesic_m(*[F.col(x) for x in "abcd"]).alias("m")).collect()]
    assert found[0] == 0 and found[1] == pytest.approx(21927.87, abs=0.01) and found[2:] == [None, None, None]


def test_nearly_antipodal_points_are_near_the_sphere(spark):
    rng = random.Random(3)
    made = []
    for _ in range(200):
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 0)
        made.append((lat, lon, max(-90.0, min(90.0, -lat + rng.uniform(-1, 1))), lon + 180 + rng.uniform(-1, 0)))
    df = spark.createDataFrame(made, "a double, b double, c double, d double")
    ends = [F.col(x) for x in "abcd"]
    for r in df.select(geo.geodesic_m(*ends).alias("m"), geo.haversine_km(*ends).alias("km")).collect():
        assert 0.99 < r.m / 1000 / r.km < 1.01 and r.m <= 20003931.46


# --- binary points ------------------------------------------------------------------------------


def test_binary_points_have_the_bytes_of_the_standard(spark):
    rng = random.Random(9)
    edges = [1.0, -1.0, 0.0, -180.0, 180.0, 0.1, 1 / 3, 4.0, 3.9999999999999996, 5e-324, -5e-324, 2.0**-1050, 2.2250738585072014e-308, 1e308]
    values = edges + [rng.uniform(-180, 180) for _ in range(500)]
    df = spark.createDataFrame([(v, v / 2) for v in values], "x double, y double")
    coded = df.withColumn("b", geo.point_wkb(F.col("x"), F.col("y"))).withColumn("p", geo.wkb_point(F.col("b")))
    for r in coded.collect():
        assert bytes(r.b) == struct.pack("<BIdd", 1, 1, r.x, r.y + 0.0)
        assert (r.p.lon, r.p.lat) == (r.x, r.y)


def test_binary_point_edges(spark):
    made = [(None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (1.0, None)]
    df = spark.createDataFrame(made, "x double, y double").select(geo.point_wkb(F.col("x"), F.col("y")).alias("b"))
    assert [r.b for r in df.collect()] == [None] * 4
    other = spark.createDataFrame([(b"",), (b"\x00" * 21,), (None,)], "b binary").select(geo.wkb_point(F.col("b")).alias("p"))
    assert [r.p for r in other.collect()] == [None] * 3


def test_binary_points_become_geographies(spark):
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:
        df = spark.createDataFrame([(-3.5, 40.5)], "x double, y double").select(geo.point_wkb(F.col("x"), F.col("y")).alias("b"))
        typed = df.withColumn("g", geo.geography(F.col("b")))
        assert typed.schema["g"].dataType.simpleString() == "geography(4326)"
        assert typed.select((F.st_asbinary("g") == F.col("b")).alias("same")).first().same
    finally:
        spark.conf.unset("spark.sql.geospatial.enabled")
