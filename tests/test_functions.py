"""Column expressions on hand-made edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from aerolith.functions import casting, geo, rules
from aerolith.functions.codes import COUNTRY_CODES
from aerolith.functions.text import one_decimal, region_of


def values(df):
    return [row[0] for row in df.collect()]


def column(spark, items, kind):
    return spark.createDataFrame([(i,) for i in items], f"x {kind}").coalesce(1)


def test_grid_cell_edges(spark):
    df = column(spark, [-0.5, 0.0, 9.999, 90.0, -180.0, 180.0, None], "double")
    assert values(df.select(geo.grid_cell(F.col("x"), F.col("x"))[0])) == [-10, 0, 0, 90, -180, 180, None]


PLACES = ["a, b, c", "a,b", "x", " x ", "", None]


@pytest.mark.parametrize(
    "variant, wanted",
    [
        ("first_comma", ["b, c", "a,b", "x", " x ", "", None]),
        ("last_separator", ["c", "a,b", "x", " x ", "unknown", "unknown"]),
        ("last_comma", ["c", "a,b", "x", "x", "", None]),
        ("greedy", ["c", "b", "x", " x ", "", None]),
    ],
)
def test_region_variants(spark, variant, wanted):
    assert values(column(spark, PLACES, "string").select(region_of(F.col("x"), variant))) == wanted


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError):
        region_of(F.lit("a, b"), "other")
    with pytest.raises(ValueError):
        casting.epoch_to_ts(F.lit(1), "h")


def test_decimal_ties_go_away_from_zero(spark):
    df = column(spark, [1.005, 2.675, 0.25, -0.25, 12345.5, 0.1 + 0.2], "double")
    assert values(df.select(casting.round_half_up(F.col("x"), 2))) == [1.01, 2.68, 0.25, -0.25, 12345.5, 0.3]
    assert values(df.select(casting.round_half_up(F.col("x"), 1))) == [1.0, 2.7, 0.3, -0.3, 12345.5, 0.3]


def test_noise_does_not_break_a_tie(spark):
    df = column(spark, [9.424999999999999, 9.425000000000001], "double")
    assert values(df.select(casting.round_half_up(F.col("x"), 2))) == [9.43, 9.43]


def test_one_decimal_follows_the_binary_value(spark):
    numbers = [0.25, 0.75, 0.15, 0.05, 37.25, -37.25, 9.95, 179.99, -0.04, 0.0, 12.0, 65.35, -74.65, 33.333]
    assert values(column(spark, numbers, "double").select(one_decimal(F.col("x")))) == [f"{n:.1f}" for n in numbers]


def test_safe_cast(spark):
    text = column(spark, ["7", " 12 ", "3.7", "x", "", None], "string")
    assert values(text.select(casting.safe_cast(F.col("x"), "bigint", 0))) == [7, 12, 0, 0, 0, 0]
    number = column(spark, [3.7, -3.7, float("nan"), None], "double")
    assert values(number.select(casting.safe_cast(F.col("x"), "bigint", 0))) == [3, -3, 0, 0]
    floats = values(number.select(casting.safe_cast(F.col("x"), "double", 0.0)))
    assert floats[:2] == [3.7, -3.7] and math.isnan(floats[2]) and floats[3] == 0.0


def test_truthy(spark):
    assert values(column(spark, ["False", "", None], "string").select(casting.truthy(F.col("x"), True))) == [True, False, False]
    assert values(column(spark, [0, 2, None], "int").select(casting.truthy(F.col("x")))) == [False, True, False]


def test_coerce_numeric(spark):
    assert values(column(spark, ["1.5", "x", None, "NaN"], "string").select(casting.coerce_numeric(F.col("x"), 9))) == [1.5, 9, 9, 9]


def test_zero_epoch_is_missing(spark):
    df = column(spark, [0, 60, None], "bigint").select(casting.epoch_to_ts(F.col("x"), "s", True).cast("string"))
    assert values(df) == [None, "1970-01-01 00:01:00", None]


def test_wind_severity_edges(spark):
    df = column(spark, [None, 9.9, 10.0, 20.0, 30.0, 40.0], "double")
    assert values(df.select(rules.wind_severity(F.col("x")))) == ["storm", "calm", "moderate", "strong", "gale", "storm"]


def test_missing_magnitude_is_the_top_class(spark):
    df = column(spark, [None, 1.9, 2.0, 8.0], "double")
    assert values(df.select(rules.magnitude_class(F.col("x")))) == ["great", "micro", "minor", "great"]


def test_flight_phase_order(spark):
    df = spark.createDataFrame(
        [(True, None), (False, None), (False, 299.0), (False, 300.0), (None, 3000.0)], "g boolean, a double"
    ).coalesce(1)
    wanted = ["on_ground", "unknown", "takeoff_landing", "climbing_descending", "cruising"]
    assert values(df.select(rules.flight_phase(F.col("g"), F.col("a")))) == wanted


def test_overlapping_boxes_take_the_first(spark):
    df = spark.createDataFrame([(36.5, 10.0), (50.0, 30.0), (0.0, 100.0), (89.0, 0.0), (None, 1.0)], "lat double, lon double")
    assert values(df.coalesce(1).select(geo.continent_of_point("lat", "lon"))) == ["Europe", "Europe", "Asia", "Other", "unknown"]


def test_risk_score_bounds(spark):
    def score(n, mean, mag, wind, sight):
        args = [F.lit(a).cast(t) for a, t in zip((n, mean, mag, wind, sight), ("bigint", "double", "double", "string", "double"))]
        return spark.range(1).select(rules.risk_score(*args)).first()[0]

    assert score(100, 1.0, 9.0, "storm", 100.0) == 100.0
    assert score(1, 0.0, None, None, None) == 25.0  # no mean: the missing ratio does not lower the cap
    assert score(1, 1.0, 3.0, "gale", 2999.0) == 12.5 + 10 + 18 + 3


def test_country_codes_are_unique():
    rows = COUNTRY_CODES
    assert len({r[0] for r in rows}) == len({r[1] for r in rows}) == len({r[2] for r in rows}) == len(rows)
    assert ("Albania", "ALB", 8) in rows


def test_single_values_are_rounded_once(spark):
    from aerolith.functions.casting import round_half_up, round_once

    df = spark.createDataFrame([(1.0049996, 2.3449997, 0.4999996, 16.365)], "a double, b double, c double, d double")
    got = df.select(round_once(F.col("a"), 2), round_once(F.col("b"), 2), round_once(F.col("c"), 0), round_once(F.col("d"), 2))
    assert tuple(got.first()) == (1.0, 2.34, 0.0, 16.37)
    assert df.select(round_half_up(F.col("a"), 2)).first()[0] == 1.01  # sums and averages settle first
