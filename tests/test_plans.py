"""Plans: what is scanned, pushed down, shuffled and broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import keyed
from aerolith.plans import intermediate, marts, serving, staging
from aerolith.session import configure
from checks.catalog import QUERIES
from checks.inputs import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(configure(spark), SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_reaches_the_scan(spark, t):
    df = keyed.recent(t.raw("events"), "ts", "2 hours", F.lit("2024-01-30").cast("timestamp")).select("event_id")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan(df)
    assert "GreaterThanOrEqual(ts" in plan(df)


@pytest.mark.parametrize("name", ["q02_seismics_map", "q06_seismic_trend", "q15_seismic_regions", "g12_recent"])
def test_registered_queries_read_only_their_time_span(spark, name):
    assert "GreaterThanOrEqual(ts" in plan(QUERIES[name](spark, SF))


def test_windows_read_only_their_columns(t):
    text = plan(t.flight_windows().select("window_start", "origin_country", "flight_count"))
    assert "partial_count" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


def test_enriched_flights_are_not_shuffled(t):
    text = plan(t.enriched())
    assert text.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_mart_scans_the_flights_once(t):
    live = marts.flights_by_grid(t.enriched())
    assert plan(live).count("events.parquet") == 1


def test_active_routes_never_build_pairs(t):
    text = plan(serving.active_routes(t.staged("routes"), t.fx("flights")))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_active_routes_aggregate_numbers_before_names_are_joined(spark):
    text = plan(QUERIES["q07_active_routes"](spark, SF))
    assert "SortAggregate" not in text and "lineitem.parquet" not in text and "NestedLoop" not in text


def rows_of_routes(spark, routes, airlines, airports, flights):
    return (
        spark.createDataFrame(routes, "airline string, src_airport string, dst_airport string")
        .withColumns({"codeshare": F.lit("Y"), "stops": F.lit(0), "equipment": F.lit("738")}),
        spark.createDataFrame(airlines, "airline_name string, iata_code string, icao_code string")
        .withColumns({"country": F.lit("C"), "is_active": F.lit(True)}),
        spark.createDataFrame(
            airports,
            "airport_name string, city string, continent string, latitude double, longitude double, "
            "iata_code string, icao_code string",
        ).withColumns({"country": F.lit("C"), "tz_database": F.lit(None).cast("string")}),
        spark.createDataFrame(flights, "callsign string, on_ground boolean"),
    )


def test_active_routes_pick_one_record_and_count_all(spark):
    routes, airlines, airports, flights = rows_of_routes(
        spark,
        [("BB", "O", "D"), ("AA", "O", "D"), ("AA", "O", "D"), ("ZZ", "O", "D"), (None, "O", "D"),
         ("AA", "O", "U"), ("AA", None, "D")],
        [(None, "AA", None), ("Late", "AA", "XX"), ("Early", None, "AA"), ("Other", "CC", None)],
        [(None, "A", "Asia", 1.0, 1.0, "O", None), ("Org", "B", "Asia", 2.0, 2.0, "O", None),
         ("Org", "B", "Europe", 2.0, 2.0, None, "O"), ("Dst", None, "Europe", 3.0, 2.0, "D", None),
         ("Dst", "C", "Asia", 3.0, 2.0, "D", None), ("Lost", "C", "Asia", None, 2.0, "U", None)],
        [("aa1", False), ("XAA", False), ("AABB", False), ("AA", True), ("AA", None), (None, False)],
    )
    (row,) = serving.active_routes_of(routes, airlines, airports, flights).collect()
    assert row.asDict() == {
        "origin_code": "O", "origin_airport_name": "Org", "origin_city": "B", "src_lat": 2.0, "src_lon": 2.0,
        "destination_code": "D", "destination_airport_name": "Dst", "destination_city": None,
        "tgt_lat": 3.0, "tgt_lon": 2.0, "distance_km": 111.2, "route_type": "domestic/regional",
        "airline_name": "Early", "active_flights": (2 * 3 * 3 + 1) * 3 * 2,
    }


@pytest.mark.parametrize("normalize", [False, True])
def test_active_routes_of_equal_those_of_staged_routes(spark, normalize):
    draw = random.Random(7)
    some = lambda *values: draw.choice(values)
    codes = ("A", "B", "C", "D", None)
    routes, airlines, airports, flights = rows_of_routes(
        spark,
        [(some("AA", "aa", "Ab", "B_", "C", "", None), some(*codes), some(*codes)) for _ in range(80)],
        [(some("N", "M", None), some("AA", "AB", "C", None), some("B_", "AA", None)) for _ in range(8)],
        [(some("P", "Q", None), some("X", None), some("Asia", "Europe", None), some(1.0, 2.0, None), some(3.0, 4.0),
          some(*codes), some(*codes)) for _ in range(14)],
        [(some("AA1", "aab", "BXC", "C", "ABC", "", None), some(True, False, False, None)) for _ in range(30)],
    )
    want = serving.active_routes(staging.stg_routes(routes, airlines, airports), flights, normalize=normalize)
    got = serving.active_routes_of(routes, airlines, airports, flights, normalize=normalize)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert got.collect() == want.collect() and got.count() > 1
    cut = serving.active_routes_of(routes, airlines, airports, flights, limit=1, normalize=normalize)
    assert cut.collect() == want.limit(1).collect()


def test_country_airline_limits_before_the_shuffle(t):
    text = plan(intermediate.country_airline(t.staged("airlines")))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_trend_entries_repeat_as_a_plain_join_would(spark, t):
    events = keyed.recent(t.staged("seismics"), "event_time", "24 hours", t.as_of)
    hours = marts.seismic_hourly(events)
    plain = events.select("region", F.date_trunc("hour", "event_time").alias("hour"), "magnitude_class").join(
        hours, ["hour", "magnitude_class"]
    )
    trend = marts.region_trend(events).groupBy("region").agg(
        F.collect_list(F.struct("hour", "magnitude_class", "events", "repeats")).alias("t")
    )
    expanded = trend.select("region", F.inline(marts.expand_trend(F.col("t")))).drop("repeats")
    columns = ["region", "hour", "magnitude_class", "events"]
    assert sorted(map(str, expanded.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))
    assert expanded.count() == events.count()


def test_samples_and_lists_keep_their_limits(t):
    assert serving.altitude_sample(t.enriched(), k=5).count() == 5
    assert serving.flights_map(t.fx("flights"), t.enriched(), limit=7).count() == 7
    assert "TakeOrderedAndProject" in plan(serving.country_counts(t.fx("flights"), limit=3))


def test_the_largest_magnitude_is_rounded_once(spark):
    rows = [(6.0499996, "x, A", "2024-01-01 00:00:00", 0), (6.05, "x, B", "2024-01-01 00:00:00", 1)]
    quakes = spark.createDataFrame(rows, "mag double, place string, event_time string, tsunami int")
    quakes = quakes.withColumn("event_time", F.col("event_time").cast("timestamp"))
    found = serving.seismic_by_region(quakes, F.lit("2024-01-01 01:00:00").cast("timestamp")).collect()
    assert {r.region: r.max_mag for r in found} == {"A": 6.0, "B": 6.1}
