"""Joins, aggregations, first-per-key, set operations and text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import rules
from aerolith.functions.casting import (
    blank_to_null, coerce_numeric, epoch_to_ts, nan_to_null, round_half_up, safe_cast, truthy, ts_label,
)
from aerolith.functions.codes import COUNTRY_CODES
from aerolith.functions.text import region_of, snapshot_id
from aerolith.operators import keyed
from aerolith.operators.joins import contains_counts, contains_join, enrich, lookup_union, settled, top1_lateral
from aerolith.operators.profiles import counted, mode_of, profile
from aerolith.plans import intermediate, marts, serving
from checks import views
from checks.inputs import tables
from checks.registry import AS_OF, CTES, query, rnd

# --- joins ----------------------------------------------------------------------------------


@query(
    "j01_flight_airport_by_cell",
    "select f.icao24, g.airport_name from v_flights f left join v_airport_grid g using (grid_lat, grid_lon)",
)
@tables
def flight_airport(t):
    cells = t.airport_grid().select("grid_lat", "grid_lon", "airport_name")
    return t.staged("flights").join(F.broadcast(cells), ["grid_lat", "grid_lon"], "left").select("icao24", "airport_name")


@query(
    "j02_flight_airline_by_country",
    "select f.icao24, c.airline_name from v_flights f left join v_country_airline c on c.country = f.origin_country",
)
@tables
def flight_airline(t):
    carriers = intermediate.country_airline(t.staged("airlines")).withColumnRenamed("country", "origin_country")
    joined = enrich(t.staged("flights"), carriers, ["origin_country"], {"airline_name": "airline_name"}, small=True)
    return joined.select("icao24", "airline_name")


@query(
    "j03_inner_with_condition",
    """select f.origin_country, a.airline_id, count(*) as flights from v_flights f
       join v_airlines a on f.origin_country = a.country and a.is_active group by 1, 2""",
)
@tables
def inner_with_condition(t):
    """Flights are counted per country before they fan out over its airlines."""
    per_country = t.staged("flights").groupBy("origin_country").agg(F.count(F.lit(1)).alias("flights"))
    active = t.staged("airlines").filter("is_active").withColumnRenamed("country", "origin_country")
    return per_country.join(active, "origin_country").select("origin_country", "airline_id", "flights")


@query(
    "j04_route_lookups",
    """select airline_code, airline_name, origin_code, origin_airport_name, count(*) as rows
       from v_routes group by all""",
)
@tables
def route_lookups(t):
    return (
        t.staged("routes")
        .groupBy("airline_code", "airline_name", "origin_code", "origin_airport_name")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "j05_country_window_history",
    f"""select c.origin_country, c.flights, l.flight_count, h.peak
        from (select origin_country, count(*) as flights from v_enriched where origin_country is not null group by 1) c
        left join (select * from w_flights where window_end = (select max(window_end) from w_flights)) l using (origin_country)
        left join (select origin_country, max(flight_count) as peak from w_flights
                   where window_end >= {AS_OF} - interval 2 hour group by 1) h using (origin_country)""",
)
@tables
def country_window_history(t):
    counts = t.enriched().filter("origin_country is not null").groupBy("origin_country").agg(
        F.count(F.lit(1)).alias("flights")
    )
    tumbling = t.flight_windows(span="2 hours")
    newest = keyed.latest_window(tumbling, bounded=True).select("origin_country", "flight_count")
    history = keyed.recent(tumbling, "window_end", "2 hours", t.as_of).groupBy("origin_country").agg(
        F.max("flight_count").alias("peak")
    )
    return counts.join(newest, "origin_country", "left").join(history, "origin_country", "left")


@query(
    "j06_region_window",
    """select region_name, stations, snapshot_count, window_start from
         (select region_name, count(*) as stations from v_weather_typed group by 1)
       left join (select region_name, snapshot_count, window_start from (select *,
           row_number() over (partition by region_name order by window_end desc) as rn from w_weather) where rn = 1)
       using (region_name)""",
)
@tables
def region_window(t):
    names = F.array(*[F.lit(n) for n in ("click", "error", "purchase", "signup", "view")])
    points = t.staged("weather").withColumn("region_name", F.element_at(names, (F.col("point_id") % 5 + 1).cast("int")))
    stations = points.groupBy("region_name").agg(F.count(F.lit(1)).alias("stations"))
    newest = keyed.first_per_key(t.weather_windows(), ["region_name"], [F.desc("window_end")])
    return stations.join(newest.select("region_name", "snapshot_count", "window_start"), "region_name", "left")


@query(
    "j07_cross_one_row",
    """select window_start, grid_lat, grid_lon, flight_count / mean as ratio from w_context
       cross join (select avg(flight_count) as mean from w_context)""",
)
@tables
def cross_one_row(t):
    """A join with a single-row aggregate, written as a scalar subquery."""
    context = t.context()
    mean = context.agg(F.avg("flight_count")).scalar()
    return context.select("window_start", "grid_lat", "grid_lon", (F.col("flight_count") / mean).alias("ratio"))


@query(
    "j08_three_cell_joins",
    """select c.window_start, grid_lat, grid_lon, l.live_flight_count, s.weather_label, q.eq_count_24h
       from w_context c left join m_live l using (grid_lat, grid_lon)
       left join m_sky s using (grid_lat, grid_lon) left join m_quakes q using (grid_lat, grid_lon)""",
)
@tables
def three_cell_joins(t):
    cell = ["grid_lat", "grid_lon"]
    out = t.context().select("window_start", *cell)
    sides = [
        marts.flights_by_grid(t.enriched()).select(*cell, "live_flight_count"),
        marts.weather_by_grid(t.staged("weather")).select(*cell, "weather_label"),
        marts.quakes_by_grid(t.staged("seismics"), t.as_of).select(*cell, "eq_count_24h"),
    ]
    for side in sides:
        out = out.join(side, cell, "left")
    return out


@query(
    "j09_lateral_top1",
    """select region, events, window_start, event_count from
         (select region, count(*) as events from v_seismics where region is not null group by 1)
       left join (select * from (select *, row_number() over (partition by region order by window_end desc) as rn
                                 from w_seismics) where rn = 1) using (region)""",
)
@tables
def lateral_top1(t):
    regions = t.staged("seismics").filter("region is not null").groupBy("region").agg(F.count(F.lit(1)).alias("events"))
    windows = t.seismic_windows().select("region", "window_start", "window_end", "event_count")
    return top1_lateral(regions, windows, ["region"], [F.desc("window_end")]).drop("window_end")


@query("j10_hour_class_join", "select region, hour, magnitude_class, events, peak_mag, tsunami_count, repeats from m_trend")
@tables
def hour_class_join(t):
    return marts.region_trend(keyed.recent(t.staged("seismics"), "event_time", "24 hours", t.as_of))


@query(
    "j11_anti_join",
    f"""select c_custkey from customer c
        where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_totalprice > 400000)""",
)
@tables
def anti_join(t):
    large = t.raw("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.raw("customer").select("c_custkey").join(large, "c_custkey", "left_anti")


CTES["v_codes"] = "select distinct airline as code from fx_routes where airline is not null"


@query(
    "j12_contains_join",
    """select f.icao24, c.code from fx_flights f join v_codes c on upper(f.callsign) like '%' || c.code || '%'
       where f.on_ground = false""",
)
@tables
def contains(t):
    flying = t.fx("flights").filter(~F.col("on_ground")).select("icao24", F.upper("callsign").alias("text"))
    codes = settled(t.fx("routes").select(F.col("airline").alias("code")).distinct(), "codes")
    return contains_join(flying, "text", codes, "code").select("icao24", "code")


@query(
    "j12_contains_counts",
    """select c.code, count(*) as matches from fx_flights f
       join v_codes c on upper(f.callsign) like '%' || c.code || '%' where f.on_ground = false group by 1""",
)
@tables
def contains_count(t):
    flying = t.fx("flights").filter(~F.col("on_ground")).select(F.upper("callsign").alias("text"))
    return contains_counts(flying, "text", t.fx("routes").select(F.col("airline").alias("code")), "code")


@query(
    "j14_raw_enriched",
    """select flight_phase, count(*) as flights, count(f.callsign) as with_callsign
       from fx_flights f left join v_enriched e using (icao24) group by 1""",
)
@tables
def raw_enriched(t):
    joined = t.fx("flights").select("icao24", "callsign").join(t.enriched().select("icao24", "flight_phase"), "icao24", "left")
    return joined.groupBy("flight_phase").agg(
        F.count(F.lit(1)).alias("flights"), F.count("callsign").alias("with_callsign")
    )


@query(
    "j15_scalar_max",
    "select origin_country, flight_count from w_flights where window_end = (select max(window_end) from w_flights)",
)
@tables
def scalar_max(t):
    return keyed.latest_window(t.flight_windows(), bounded=True).select("origin_country", "flight_count")


_codes = ", ".join(f"('{name}', '{iso3}', {number})" for name, iso3, number in COUNTRY_CODES)
CTES["v_iso"] = f"select * from (values {_codes}) v(country, iso_a3, number)"


@query(
    "j17_country_codes",
    """select country as origin_country, count(*) as flights, iso_a3, lpad(cast(number as varchar), 3, '0') as numeric_id
       from v_airports join v_iso using (country) group by country, iso_a3, number""",
)
@tables
def country_codes(t):
    counts = t.staged("airports").groupBy(F.col("country").alias("origin_country")).agg(
        F.count(F.lit(1)).alias("flights")
    )
    return serving.country_map(counts)


# --- aggregations ---------------------------------------------------------------------------


@query(
    "g01_group_aggregates",
    f"""select region_name, count(*) as n, {rnd("avg(temperature_c)", 4)} as mean, min(temperature_c) as low,
          max(temperature_c) as high, {rnd("sum(precipitation_mm)", 4)} as rain from v_weather group by 1""",
)
@tables
def group_aggregates(t):
    return t.staged("weather").groupBy("region_name").agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(F.avg("temperature_c"), 4).alias("mean"),
        F.min("temperature_c").alias("low"),
        F.max("temperature_c").alias("high"),
        round_half_up(F.sum("precipitation_mm"), 4).alias("rain"),
    )


@query(
    "g02_filtered_counts",
    """select flight_phase, count(*) filter (where on_ground = false) as airborne,
         count(*) filter (where near_airport) as near, count(*) filter (where velocity_ms > 100) as fast
       from v_enriched group by 1""",
)
@tables
def filtered_counts(t):
    return t.enriched().groupBy("flight_phase").agg(
        F.count_if(~F.col("on_ground")).alias("airborne"),
        F.count_if("near_airport").alias("near"),
        F.count_if(F.col("velocity_ms") > 100).alias("fast"),
    )


@query(
    "g03_conditional_sum",
    """select region, cast(sum(case when is_tsunami_related then 1 else 0 end) as bigint) as tsunamis,
         cast(sum(case when magnitude_class in ('major', 'great') then 1 else 0 end) as bigint) as large
       from v_seismics group by 1""",
)
@tables
def conditional_sum(t):
    return t.staged("seismics").groupBy("region").agg(
        F.sum(F.when(F.col("is_tsunami_related"), 1).otherwise(0)).alias("tsunamis"),
        F.sum(F.when(F.col("magnitude_class").isin("major", "great"), 1).otherwise(0)).alias("large"),
    )


@query(
    "g04_count_distinct",
    """select origin_country, count(distinct cast(grid_lat as varchar) || '_' || cast(grid_lon as varchar)) as cells
       from v_flights group by 1""",
)
@tables
def count_distinct(t):
    cell = F.concat_ws("_", F.col("grid_lat").cast("string"), F.col("grid_lon").cast("string"))
    return t.staged("flights").groupBy("origin_country").agg(F.countDistinct(cell).alias("cells"))


@query(
    "g05_mode",
    f"""select f.origin_country, m.airport from (select distinct origin_country from v_enriched) f
        left join ({views.mode_cte("v_enriched", "origin_country", "nearest_airport_name", "airport")}) m
          on m.origin_country is not distinct from f.origin_country""",
)
@tables
def mode(t):
    return mode_of(t.enriched(), ["origin_country"], "nearest_airport_name", "airport")


@query(
    "g05_modes_in_one_pass",
    f"select t.origin_country, n, airport, phase, cells from (select origin_country, count(*) as n, "
    "count(distinct grid_lat) as cells from v_enriched group by 1) t "
    + views.mode_joins("v_enriched", ["origin_country"], {"airport": "nearest_airport_name", "phase": "flight_phase"}, "t"),
)
@tables
def modes(t):
    return profile(
        t.enriched(),
        ["origin_country"],
        [counted("n")],
        modes={"airport": "nearest_airport_name", "phase": "flight_phase"},
        distinct={"cells": "grid_lat"},
    )


@query("g06_max_text", "select origin_country, max(airline_name) as airline from v_enriched group by 1")
@tables
def max_text(t):
    return t.enriched().groupBy("origin_country").agg(F.max("airline_name").alias("airline"))


@query(
    "g07_safe_ratio",
    f"""select origin_country, {rnd("count(*) filter (where velocity > 300) / nullif(count(*) filter (where on_ground), 0) * 100.0::double", 4)}
        as ratio from v_flights group by 1""",
)
@tables
def safe_ratio(t):
    fast, ground = F.count_if(F.col("velocity") > 300), F.count_if("on_ground")
    ratio = fast / F.nullif(ground, F.lit(0)) * 100
    return t.staged("flights").groupBy("origin_country").agg(round_half_up(ratio, 4).alias("ratio"))


@query(
    "g08_json_trend",
    """select region_name, '[' || string_agg('{"hour":"' || strftime(hour, '%Y-%m-%dT%H:%M:%S') || '","n":' || n || '}', ','
         order by hour) || ']' as trend
       from (select region_name, date_trunc('hour', snapshot_ts) as hour, count(*) as n from fx_weather_stream group by 1, 2)
       group by 1""",
)
@tables
def json_trend(t):
    hours = t.fx("weather_stream").groupBy("region_name", F.date_trunc("hour", "snapshot_ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return marts.json_trend(hours, ["region_name"], ["hour"], ["hour", "n"], "trend")


@query(
    "g09_hourly",
    "select date_trunc('hour', event_time) as hour, count(*) as events, max(mag) as peak from fx_seismics group by 1",
)
@tables
def hourly(t):
    return t.fx("seismics").groupBy(F.date_trunc("hour", "event_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"), F.max("mag").alias("peak")
    )


@query("g10_global", f"select {rnd('avg(flight_count)', 4)} as mean, count(*) as n, max(flight_count) as peak from w_flights")
@tables
def global_aggregate(t):
    return t.flight_windows().agg(
        round_half_up(F.avg("flight_count"), 4).alias("mean"),
        F.count(F.lit(1)).alias("n"),
        F.max("flight_count").alias("peak"),
    )


@query(
    "g12_recent",
    " union all ".join(
        f"select '{span}' as span, count(*) as n from events where ts >= {AS_OF} - interval {span}"
        for span in ("10 minutes", "2 hours", "3 hours", "6 hours", "24 hours")
    ),
)
@tables
def recent(t):
    """The widest span is scanned once; the shorter ones are counted within it."""
    spans = ("10 minutes", "2 hours", "3 hours", "6 hours", "24 hours")
    as_of = t.as_of
    day = keyed.recent(t.raw("events"), "ts", spans[-1], as_of)
    counts = day.agg(*[F.count_if(F.col("ts") >= as_of - F.expr(f"interval {s}")).alias(f"_{i}") for i, s in enumerate(spans)])
    rows = F.array(*[F.struct(F.lit(s).alias("span"), F.col(f"_{i}").alias("n")) for i, s in enumerate(spans)])
    return counts.select(F.inline(rows))


# --- first per key, windows, ordering, sets -----------------------------------------------------


@query(
    "w01_first_per_key",
    """select user_id, event_id, event_type, value from
         (select *, row_number() over (partition by user_id order by value desc, event_id) as rn from events) where rn = 1""",
)
@tables
def first_per_key(t):
    first = keyed.first_per_key(t.raw("events"), ["user_id"], [F.desc("value"), F.asc("event_id")])
    return first.select("user_id", "event_id", "event_type", "value")


@query(
    "w02_count_over",
    "select event_id, count(value) over (partition by user_id, event_type) as peers from events",
)
@tables
def count_over(t):
    """A whole-partition count is a grouped count joined back, so no partition is held in one task."""
    events = t.raw("events").select("event_id", "user_id", "event_type", "value")
    peers = events.groupBy("user_id", "event_type").agg(F.count("value").alias("peers"))
    joined = events.join(
        peers.withColumnsRenamed({"user_id": "_u", "event_type": "_t"}),
        F.col("user_id").eqNullSafe(F.col("_u")) & F.col("event_type").eqNullSafe(F.col("_t")),
    )
    return joined.select("event_id", "peers")


@query("w03_nearest_to_centre", "select grid_lat, grid_lon, airport_name from v_airport_grid")
@tables
def nearest_to_centre(t):
    return t.airport_grid().select("grid_lat", "grid_lon", "airport_name")


@query(
    "w04_order_by",
    "select region, event_count, max_magnitude from w_seismics order by max_magnitude desc, event_count desc, region",
)
@tables
def order_by(t):
    return t.seismic_windows().select("region", "event_count", "max_magnitude").orderBy(
        F.desc("max_magnitude"), F.desc("event_count"), "region"
    )


@query(
    "w05_top_k",
    "select user_id, count(*) as events from events group by 1 order by events desc, user_id limit 20",
)
@tables
def top_k(t):
    counts = t.raw("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return keyed.top_k(counts, [F.desc("events"), F.asc("user_id")], 20)


@query(
    "w06_display_limit",
    """select lat, lon, windspeed_ms, temperature_c from (select latitude as lat, longitude as lon, windspeed_ms, temperature_c
         from fx_weather) order by lat, lon, windspeed_ms, temperature_c limit 2000""",
)
@tables
def display_limit(t):
    return serving.weather_map(t.fx("weather"), limit=2000).select("lat", "lon", "windspeed_ms", "temperature_c")


@query(
    "w07_sample",
    """select baro_altitude_m as altitude_m, velocity_ms as speed_ms, flight_phase, origin_country from v_enriched
       where baro_altitude_m > 0 and velocity_ms > 0 and flight_phase <> 'unknown'
       order by md5('7|' || icao24), icao24 limit 800""",
)
@tables
def sample(t):
    return serving.altitude_sample(t.enriched(), 800, seed=7)


@query("w08_latest_window", "select * from w_context where window_end = (select max(window_end) from w_context)")
@tables
def latest(t):
    return keyed.latest_window(t.context(), bounded=True)


@query("u01_lookup_union", "select code, airline_id, airline_name from v_airline_codes")
@tables
def lookup(t):
    return lookup_union(t.staged("airlines"), ["iata_code", "icao_code"], "code").select(
        "code", "airline_id", "airline_name"
    )


@query("u02_distinct", "select distinct origin_country from v_flights where origin_country is not null")
@tables
def distinct(t):
    return t.staged("flights").select("origin_country").filter("origin_country is not null").distinct()


@query(
    "u03_last_wins",
    """select latitude, longitude, point_id, region_name from (select *, row_number() over
         (partition by latitude, longitude order by point_id desc) as rn from fx_weather) where rn = 1""",
)
@tables
def last_wins(t):
    last = keyed.first_per_key(t.fx("weather"), ["latitude", "longitude"], [F.desc("point_id")])
    return last.select("latitude", "longitude", "point_id", "region_name")


# --- scalar functions ---------------------------------------------------------------------------


@query(
    "f_text",
    """select event_id, trim(t) as trimmed, upper(t) as uppered, nullif(trim(t), '') as blanked,
         coalesce(nullif(trim(t), ''), 'none') as filled
       from (select event_id, case when event_id % 5 = 0 then '   ' else ' ' || event_type || ' ' end as t from events)""",
)
@tables
def text(t):
    value = F.when(F.col("event_id") % 5 == 0, "   ").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" ")))
    return t.raw("events").select("event_id", value.alias("t")).select(
        "event_id",
        F.trim("t").alias("trimmed"),
        F.upper("t").alias("uppered"),
        blank_to_null(F.col("t")).alias("blanked"),
        F.coalesce(blank_to_null(F.col("t")), F.lit("none")).alias("filled"),
    )


@query(
    "f_region",
    """select id,
         case when place like '%, %' then trim(substring(place, position(',' in place) + 1)) else place end as first_comma,
         case when place like '%, %' then trim(string_split(place, ', ')[-1]) else coalesce(nullif(place, ''), 'unknown') end as last_separator,
         case when place like '%, %' then trim(string_split(place, ',')[-1]) else trim(place) end as last_comma,
         regexp_replace(place, '^.*,\\s*', '') as greedy
       from fx_seismics""",
)
@tables
def region(t):
    variants = ("first_comma", "last_separator", "last_comma", "greedy")
    return t.fx("seismics").select("id", *[region_of(F.col("place"), v).alias(v) for v in variants])


@query(
    "f_math",
    f"""select event_id, {rnd("log2(value + 1)", 6)} as log_value, least(greatest(value, 10), 200) as clipped,
          {rnd("sqrt(value) * sin(radians(event_id % 360))", 6)} as wave from events""",
)
@tables
def math(t):
    wave = F.sqrt("value") * F.sin(F.radians(F.col("event_id") % 360))
    return t.raw("events").select(
        "event_id",
        round_half_up(F.log2(F.col("value") + 1), 6).alias("log_value"),
        rules.clip(F.col("value"), 10, 200).alias("clipped"),
        round_half_up(wave, 6).alias("wave"),
    )


@query(
    "f_time",
    """select event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) as whole_second,
         make_timestamp((epoch_us(ts) // 1000) * 1000) as whole_milli, date_trunc('hour', ts) as hour,
         ts - interval 2 hour as earlier, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') as label from events""",
)
@tables
def time(t):
    ts = F.col("ts")
    return t.raw("events").select(
        "event_id",
        epoch_to_ts(F.unix_seconds(ts)).alias("whole_second"),
        epoch_to_ts(F.unix_millis(ts), "ms").alias("whole_milli"),
        F.date_trunc("hour", ts).alias("hour"),
        (ts - F.expr("interval 2 hours")).alias("earlier"),
        ts_label(ts).alias("label"),
    )


_JSON_K = "json_extract_string(props, '$.k')"


@query(
    "f_cast",
    f"""select event_id, coalesce(try_cast({_JSON_K} as bigint), 0) as whole,
          cast(trunc(value) as bigint) as cut, coalesce(try_cast(event_type as double), -1) as coerced,
          event_id % 2 <> 0 as odd from events""",
)
@tables
def cast(t):
    return t.raw("events").select(
        "event_id",
        safe_cast(F.get_json_object("props", "$.k"), "bigint", 0).alias("whole"),
        safe_cast(F.col("value"), "bigint", 0).alias("cut"),
        coerce_numeric(F.col("event_type"), -1).alias("coerced"),
        truthy(F.col("event_id") % 2).alias("odd"),
    )


@query(
    "f_class",
    """select id, case when mag >= 7 then 'Major' when mag >= 5 then 'Strong' when mag >= 3 then 'Moderate' else 'Minor' end
         as four_way, magnitude_class as seven_way from fx_seismics join v_seismics using (id, mag)""",
)
@tables
def classes(t):
    return t.fx("seismics").select(
        "id",
        rules.map_magnitude_class(F.col("mag")).alias("four_way"),
        rules.magnitude_class(F.col("mag")).alias("seven_way"),
    )


@query(
    "f_json",
    f"""select event_id, cast({_JSON_K} as bigint) as k, '{{"id":' || event_id || ',"kind":"' || event_type || '"}}' as doc
        from events""",
)
@tables
def json(t):
    doc = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    return t.raw("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), doc.alias("doc"))


@query(
    "f_hash",
    "select p_partkey, substring(md5(printf('%.1f:%.1f:%d', latitude, longitude, cast(point_id // 900 as bigint))), 1, 16) "
    "as snapshot_id from fx_weather join part on p_partkey = point_id",
)
@tables
def hashed(t):
    key = snapshot_id(F.col("latitude"), F.col("longitude"), F.col("point_id"))
    return t.fx("weather").select(F.col("point_id").alias("p_partkey"), key.alias("snapshot_id"))


@query(
    "f_nan",
    f"select event_type, {rnd('avg(case when event_id % 7 <> 0 then value end)', 4)} as mean from events group by 1",
)
@tables
def nan(t):
    value = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return t.raw("events").groupBy("event_type").agg(round_half_up(F.avg(nan_to_null(value)), 4).alias("mean"))
