"""Wire forms, topics and reference files on hand-made edge input."""

import json
import math

from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.sources import feeds, reference_files, topics
from aerolith.sources.weather_grid import weather_grid


def messages(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def state(**changed):
    base = ["abc", " CALL ", "Spain", 1000, 1001, 1.5, 2.5, 300.0, False, 10.0, 90.0] + [None] * 6 + [3]
    for i, v in changed.items():
        base[int(i[1:])] = v
    return base


def parsed_states(spark, *states):
    rows = feeds.parse_state_vectors(messages(spark, {"time": 1010, "states": list(states)})).collect()
    return {r.icao24: r for r in rows}


def test_state_defaults(spark):
    rows = parsed_states(
        spark,
        state(),
        state(i0="short")[:11],
        state(i0="seventeen")[:17],
        state(i0="odd", i1=None, i2="", i3="3.7", i5="x", i7=None, i8="False", i9="nan", i17="9"),
        state(i0="numeric", i3=3.7, i8=0, i2=None),
        state(i0=None, i8="", i4=None),
    )
    assert (rows["abc"].callsign, rows["abc"].category, rows["abc"].snapshot_ts) == ("CALL", 3, 1010)
    assert rows["short"].category == rows["seventeen"].category == 0
    odd = rows["odd"]
    assert (odd.callsign, odd.origin_country, odd.time_position, odd.longitude) == ("", "unknown", 0, 0.0)
    assert (odd.baro_altitude, odd.on_ground, odd.category) == (0.0, True, 9) and math.isnan(odd.velocity)
    numeric = rows["numeric"]
    assert (numeric.time_position, numeric.on_ground, numeric.origin_country) == (3, False, "unknown")
    assert (rows["None"].on_ground, rows["None"].last_contact) == (False, 0)


def test_short_endless_and_unreadable_states_are_dropped(spark):
    text = json.dumps({"time": 1, "states": [state(i0="kept"), state(i0="cut")[:10]]})
    endless = json.dumps({"time": 1, "states": [state(i0="inf")]}).replace("1000", "1e999")
    rows = feeds.parse_state_vectors(messages(spark, text, endless, "{broken", '{"time": 1, "states": null}')).collect()
    assert [r.icao24 for r in rows] == ["kept"]


def test_quake_defaults_and_bad_structure(spark):
    good = {"id": "a", "properties": {"mag": None, "place": "", "time": 5, "sig": "x"}, "geometry": {"coordinates": [1, 2, None]}}
    no_properties = {"id": "b", "properties": None, "geometry": {"coordinates": [1, 2, 3]}}
    no_depth = {"id": "c", "properties": {}, "geometry": {"coordinates": [1, 2]}}
    rows = feeds.parse_quakes(messages(spark, {"features": [good, no_properties, no_depth]}, "junk")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.mag, r.mag_type, r.place, r.event_time, r.sig, r.title) == (0.0, "unknown", "unknown", 5, 0, "")
    assert (r.lat, r.lon, r.depth) == (2.0, 1.0, 0.0)


def test_weather_reads_the_interval_if_present(spark):
    doc = {"elevation": 12, "current": {"interval": 900, "temperature_2m": "4.5", "weathercode": 61.9}}
    df = messages(spark, doc, {"elevation": 1}).withColumns(
        {"latitude": F.lit(0.25), "longitude": F.lit(-10.0), "region_name": F.lit("r"), "clock": F.lit(1800)}
    )
    rows = feeds.parse_weather(df, F.col("clock")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.elevation_m, r.interval_s, r.temperature_c, r.weathercode, r.rain_mm) == (12.0, 900, 4.5, 61, 0.0)
    import hashlib

    assert r.snapshot_id == hashlib.md5(f"{0.25:.1f}:{-10.0:.1f}:2".encode()).hexdigest()[:16]
    assert [f for f in schemas.WEATHER.names if f not in r.asDict()] == []


def test_decode_reads_declared_fields_and_nan(spark):
    good = json.dumps(dict.fromkeys(schemas.EARTHQUAKE.names)).replace('"mag": null', '"mag": NaN')
    rows = topics.decode(messages(spark, good), schemas.EARTHQUAKE).collect()
    assert math.isnan(rows[0].mag) and rows[0].place is None


def test_malformed_messages_are_dropped_and_counted(spark):
    from pyspark.sql import Observation

    good = dict.fromkeys(schemas.FLIGHT.names)
    no_optional = {k: v for k, v in good.items() if k != "last_seen"}
    lacking = {k: v for k, v in good.items() if k != "icao24"}
    df = messages(spark, good, no_optional, lacking, {**good, "more": 1}, "[1]", "{cut", "")
    observation = Observation("decode")
    out = topics.drop_malformed(df, schemas.FLIGHT, metric=observation)
    assert out.count() == 2
    assert observation.get == {"read": 7, "dropped": 5}


def test_arrival_time_prefers_the_broker(spark):
    df = spark.sql("select timestamp '2024-01-01' as timestamp, 'x' as value")
    assert str(df.select(topics.arrival_time(df)).first()[0]) == "2024-01-01 00:00:00"
    assert df.select(topics.arrival_time(df, None)).first()[0].year > 2024


AIRLINES = '''1,"Plain",\\N,"AB","ABC","CALL","Spain","Y"
2,"Quote ""and"" comma, é",,AB,\\N,"",Spain,N
3,"Too short",AB
x,"Bad id",a,b,c,d,e,f
5,"Longer",a,b,c,d,e,f,"more, still"
6,"Short, with comma",a,b,c,d,e
'''


def test_reference_file_rows(spark, tmp_path):
    path = tmp_path / "airlines.dat"
    path.write_bytes(AIRLINES.encode("latin-1"))
    df = reference_files.read_reference(spark, "airlines", str(path))
    got = {r.name: r for r in df.collect()}
    assert set(got) == {"Plain", 'Quote "and" comma, é', "Bad id", "Longer"}
    assert (got["Plain"].alias, got["Plain"].airline_id, got["Plain"].callsign) == (None, 1, "CALL")
    quoted = got['Quote "and" comma, é']
    assert (quoted.alias, quoted.icao, quoted.callsign) == (None, None, None)
    assert got["Bad id"].airline_id is None
    assert df.count() == 4 and df.select("name").count() == 4  # pruning must not let short rows in


def test_routes_without_a_code_are_dropped(spark, tmp_path):
    path = tmp_path / "routes.dat"
    path.write_text("AB,1,AAA,1,BBB,2,,0,738\nAB,1,\\N,1,BBB,2,,0,738\nAB,1,AAA,1,,2,,0,738\n")
    assert reference_files.read_reference(spark, "routes", str(path)).count() == 1


def test_load_once_leaves_a_filled_table_alone(spark):
    def rows(n):
        return lambda: spark.range(n)

    assert reference_files.load_once(spark, "loaded_once", rows(0)).count() == 0
    assert reference_files.load_once(spark, "loaded_once", rows(3)).count() == 3
    assert reference_files.load_once(spark, "loaded_once", rows(9)).count() == 3


def test_weather_grid_size_and_names(spark):
    points = weather_grid(spark)
    assert points.count() == 257
    names = {(r.lat, r.lon): r.name for r in points.collect()}
    assert names[(-60.0, -180.0)] == "grid_-60_-180" and names[(40.0, 20.0)] == "dense_40_20"
    assert names[(80.0, 0.0)] == "polar_80_0"


def test_decode_drops_what_is_no_object(spark):
    schema = "icao24 string, callsign string"
    from pyspark.sql.types import StructType

    sent = messages(spark, "not json", "5", "[1]", "", '{"icao24": "a"}', '{"icao24": "b", "callsign": "X", "more": 1}', "{}")
    got = topics.decode(sent, StructType.fromDDL(schema)).collect()
    assert sorted((r.icao24 or "", r.callsign) for r in got) == [("", None), ("a", None), ("b", "X")]
    assert topics.decode(sent.limit(0), StructType.fromDDL(schema)).count() == 0
