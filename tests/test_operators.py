"""Keyed, join, profile and quality operators against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from aerolith.operators import joins, keyed, profiles, quality


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- keyed ------------------------------------------------------------------------------------


def state(spark, items):
    return spark.createDataFrame(items, "k int, t int, v string")


def test_first_per_key_sends_one_row_per_task(spark):
    df = spark.range(0, 5000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    first = keyed.first_per_key(df, ["k"], [F.desc("id")])
    best = {}
    for i in range(5000):
        k = -1 if i % 3 == 0 else i % 50
        best[k] = max(best.get(k, 0), i)
    assert rows(first) == sorted(best.items())
    assert plan(first).count("WindowGroupLimit") >= 2  # before and after the shuffle


def test_upsert_keeps_the_newest_of_a_batch(spark):
    target = state(spark, [(1, 5, "old"), (2, 5, "kept")])
    batch = state(spark, [(1, 7, "b"), (1, 9, "c"), (3, 1, "new")])
    out = keyed.upsert_latest(target, batch, ["k"], [F.desc("t")])
    assert rows(out) == [(1, 9, "c"), (2, 5, "kept"), (3, 1, "new")]


def test_snapshot_drops_vanished_keys_and_takes_them_back(spark):
    target = state(spark, [(1, 1, "a"), (2, 1, "b")])
    second = keyed.replace_snapshot(target, state(spark, [(2, 2, "b2"), (2, 2, "b2")]), ["k"], [F.desc("t")])
    assert rows(second) == [(2, 2, "b2")]
    third = keyed.replace_snapshot(second, state(spark, [(1, 3, "a3"), (2, 3, "b3")]), ["k"], [F.desc("t")])
    assert rows(third) == [(1, 3, "a3"), (2, 3, "b3")]


def test_newer_than_is_strict_and_drops_equal_times(spark):
    df = state(spark, [(4, 10, "mark"), (3, 11, "b"), (1, 11, "a"), (2, 15, "c"), (5, 9, "old")])
    assert rows(keyed.newer_than(df, "t", 10, [F.asc("k")])) == [(1, 11, "a"), (2, 15, "c")]


def test_drop_stale_limits(spark):
    df = spark.createDataFrame([(100, 40), (100, 39), (100, None)], "s int, p int")
    assert rows(keyed.drop_stale(df, F.col("s"), F.col("p"))) == [(100, 40, 100)]


def test_sample_is_the_same_however_the_rows_lie(spark):
    a = keyed.hashed_sample(spark.range(0, 1000, 1, 2), "id", 20, seed=3)
    b = keyed.hashed_sample(spark.range(0, 1000, 1, 7), "id", 20, seed=3)
    assert rows(a) == rows(b)
    assert rows(a) != rows(keyed.hashed_sample(spark.range(1000), "id", 20, seed=4))


# --- joins ------------------------------------------------------------------------------------


@pytest.mark.parametrize("lengths", [(1, 2, 3), (2, 3), (3,)])
def test_contains_join_equals_like(spark, lengths):
    rng = random.Random(1)
    texts = ["".join(rng.choice("AB%_1") for _ in range(rng.randint(0, 6))) for _ in range(60)] + [None]
    codes = ["AB", "A_", "%", "", "B1A", "AB1A", "B_1", "_", None, "A%B", "____", "AAAA_B", "1"]
    left = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    right = spark.createDataFrame([(c,) for c in codes], "c string")
    got = joins.contains_join(left, "t", right, "c", lengths)
    like = left.join(right, F.like(F.col("t"), F.concat(F.lit("%"), F.col("c"), F.lit("%"))))
    assert rows(got.select("i", "c")) == rows(like.select("i", "c"))
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_contains_counts_weigh_equal_texts(spark):
    left = spark.createDataFrame([("AB1",)] * 40 + [("XAB",), ("ZZ",)], "t string")
    right = spark.createDataFrame([("AB",), ("AB",), ("Z",), ("Q",)], "c string")
    assert rows(joins.contains_counts(left, "t", right, "c")) == [("AB", 41), ("Z", 1)]


def test_lookup_union_prefers_the_first_code(spark):
    dim = spark.createDataFrame([("AA", "XAA", 1), (None, "XBB", 2), (None, None, 3)], "iata string, icao string, id int")
    assert rows(joins.lookup_union(dim, ["iata", "icao"], "code").select("code", "id")) == [("AA", 1), ("XBB", 2)]


def test_enrich_fans_out_and_keeps_unmatched(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, n string")
    for small in (True, False):
        out = joins.enrich(fact, dim, ["k"], {"name": "n"}, small=small)
        got = {(r.v, r.name) for r in out.collect()}
        assert got == {(1, "x"), (1, "y"), (2, None), (3, None)}
        assert out.count() == 4


def test_only_a_measured_small_side_is_broadcast(spark):
    dim = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("pad"))
    size = joins.measured_bytes(dim)
    assert size >= 1000 * 100
    fact = spark.range(10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(fact.join(joins.broadcast_if_small(dim, size), "id"))
        assert "BroadcastHashJoin" not in plan(fact.join(joins.broadcast_if_small(dim, size - 1), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top1_lateral_keeps_keys_without_rows(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 3)], "k string, t int")
    assert {(r.k, r.t) for r in joins.top1_lateral(left, right, ["k"], [F.desc("t")]).collect()} == {("a", 3), ("b", None)}


# --- profiles -----------------------------------------------------------------------------------


def test_mode_ties_and_nulls(spark):
    data = [("a", "y"), ("a", "x"), ("a", None), ("a", None), ("a", None), ("b", None), ("c", "q")]
    df = spark.createDataFrame(data, "k string, v string")
    got = {r.k: r.m for r in profiles.mode_of(df, ["k"], "v", "m").collect()}
    assert got == {"a": "x", "b": None, "c": "q"}


def test_profile_equals_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    data = []
    for _ in range(3000):
        key = "hot" if rng.random() < 0.4 else rng.choice("abc")
        data.append((key, rng.choice(["x", "y", "z", None]), rng.choice(["p", "q", None]), rng.choice([1.0, 2.5, None])))
    df = spark.createDataFrame(data, "k string, v string, w string, n double").repartition(6)
    got = profiles.profile(
        df,
        ["k"],
        [
            profiles.counted("rows"),
            profiles.counted("big", F.col("n") > 2),
            profiles.averaged("mean", F.col("n")),
            profiles.highest("top", F.col("n")),
            profiles.lowest("low", F.col("n")),
            profiles.summed("total", F.col("n")),
        ],
        modes={"mode_v": "v", "mode_w": "w"},
        distinct={"kinds": "v"},
    )
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    for r in got.collect():
        group = groups.pop(r.k)
        numbers = [g[3] for g in group if g[3] is not None]
        assert (r.rows, r.big) == (len(group), sum(n > 2 for n in numbers))
        assert r.mean == pytest.approx(sum(numbers) / len(numbers))
        assert (r.top, r.low, r.total) == (max(numbers), min(numbers), pytest.approx(sum(numbers)))
        for name, index in (("mode_v", 1), ("mode_w", 2)):
            counts = Counter(g[index] for g in group if g[index] is not None)
            assert r[name] == min(counts, key=lambda v: (-counts[v], v))
        assert r.kinds == len({g[1] for g in group if g[1] is not None})
    assert not groups


# --- quality -------------------------------------------------------------------------------------


def test_report_has_a_row_per_check(spark):
    df = spark.createDataFrame([(1, 2.0), (1, -1.0), (None, None)], "id int, v double")
    declared = {"id": {"checks": ["not_null"]}, "v": {"check": ["non_negative"]}}
    rules = quality.rules_from_spec(declared)
    report = quality.run_checks(df, "t", rules, key=["id"], source=df.filter("false"))
    got = {(r.column_name, r.check_name): (r.failures, r.passed) for r in report.collect()}
    assert got == {
        ("id", "not_null"): (1, False),
        ("v", "non_negative"): (1, False),
        ("*", "row_count_positive"): (1, False),
        ("id", "unique"): (1, False),
    }
    assert quality.run_checks(df, "t").count() == 0


def test_observed_rules_come_with_the_load(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    observed, metrics = quality.observe_rules(df, "load", [("id", "not_null")])
    observed.write.format("noop").mode("overwrite").save()
    assert metrics.get == {"id__not_null": 1}


def test_unknown_rule_is_refused():
    with pytest.raises(ValueError):
        quality.failures("x", "other")


def test_contains_join_takes_a_backslash_as_itself(spark):
    texts = spark.createDataFrame([("xA\\By",), ("AB",), ("a%b",), ("",)], "text string")
    codes = spark.createDataFrame([("A\\B",), ("\\",), ("%",), ("B",)], "code string")
    got = {tuple(r) for r in joins.contains_join(texts, "text", codes, "code").select("text", "code").collect()}
    every = {(t, "%") for t in ("xA\\By", "AB", "a%b", "")}
    assert got == every | {("xA\\By", "A\\B"), ("xA\\By", "\\"), ("xA\\By", "B"), ("AB", "B")}


def test_country_map_keeps_a_coded_country_that_ranks_last(spark):
    from aerolith.plans import serving

    rows = [(f"Nowhere {i}",) for i in range(150) for _ in range(2)] + [("France",)]
    flights = spark.createDataFrame(rows, "origin_country string")
    assert [r.origin_country for r in serving.country_map(serving.country_counts(flights)).collect()] == ["France"]
    assert serving.country_counts(flights, limit=100).count() == 100


def test_profile_takes_tops_and_refuses_numbers_as_modes(spark):
    df = spark.createDataFrame([("a", "x", 9), ("a", "y", 10), ("a", None, 9), ("b", None, 1)], "k string, t string, n int")
    got = profiles.profile(df, ["k"], [profiles.counted("rows")], distinct={"ns": "n"}, tops={"top": "t"})
    assert rows(got.select("k", "rows", "ns", "top").na.fill("-")) == [("a", 3, 2, "y"), ("b", 1, 1, "-")]
    with pytest.raises(TypeError):
        profiles.profile(df, ["k"], [], modes={"mode": "n"})


def test_country_codes_are_broadcast(spark):
    from aerolith.functions.codes import country_codes

    names, numbers = country_codes(spark)
    big = spark.range(0, 10, 1, 4).select(F.lit("France").alias("country"))
    joined = big.join(names, "country").join(numbers, "iso_a3")
    assert "SortMergeJoin" not in plan(joined)
    assert {(r.iso_a3, r.number) for r in joined.collect()} == {("FRA", 250)}
    assert names.count() == numbers.count() == 121
