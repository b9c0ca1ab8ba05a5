"""Feed-shaped views over the given tables.

The SQL runs unchanged on Spark and on the engine of the reference SQL. Only
integer arithmetic, division of doubles and common functions are used. Codes and
keys stay as selective at any scale: a longer id gives a longer code, so joins on
them do not fan out as the tables grow.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURES = {
    "fx_flights": """
select 'a' || lpad(cast(event_id as string), cast(greatest(12, length(cast(event_id as string))) as int), '0') as icao24,
  case when event_id % 11 = 0 then '  '
       else chr(cast(65 + event_id % 5 as int)) || chr(cast(65 + user_id % 5 as int)) || cast(user_id as string) end as callsign,
  case when event_id % 97 = 0 then null else 'NATION_' || cast(user_id % 25 as string) end as origin_country,
  ts as time_position,
  ts as last_contact,
  case when event_id % 4 = 0 then cast((event_id * 7919) % 16001 as double) / 100 - 75
       else cast((event_id * 7919) % 6001 as double) / 100 end as latitude,
  case when event_id % 4 = 0 then cast((event_id * 104729) % 32001 as double) / 100 - 160
       else cast((event_id * 104729) % 8001 as double) / 100 - 20 end as longitude,
  case when event_id % 13 = 0 then null else value * 25 - 50 end as baro_altitude,
  event_type = 'error' as on_ground,
  case when event_id % 17 = 0 then null else value - 5 end as velocity,
  cast(event_id % 360 as double) as true_track,
  cast(event_id % 21 as int) as category,
  user_id as track_id
from events
""",
    "fx_seismics": """
select event_id as id,
  cast(event_id * 271 % 900 as double) / 100 as mag,
  case event_id % 3 when 0 then 'ml' when 1 then ' mw ' else 'md' end as mag_type,
  case event_id % 4 when 0 then '12 km N of A, B, NATION_' || cast(user_id % 25 as string)
                    when 1 then '3 km S of C, NATION_' || cast(user_id % 25 as string)
                    when 2 then ' Open Ocean ' else null end as place,
  cast(case when event_id % 29 = 0 then 1 else 0 end as int) as tsunami,
  ts as event_time,
  'earthquake' as event_type,
  'M ' || cast(event_id as string) as title,
  cast(event_id % 1001 as int) as sig,
  cast((event_id * 15485863) % 6001 as double) / 100 as lat,
  cast((event_id * 32452843) % 8001 as double) / 100 - 20 as lon,
  value / 3 as depth
from events
""",
    "fx_weather": """
select p_partkey as point_id,
  cast(p_partkey % 60 as double) as latitude,
  cast(floor(p_partkey / 60) % 180 as double) - 20 as longitude,
  ' ' || p_brand as region_name,
  cast(p_partkey % 3000 as double) / 7 as elevation_m,
  cast(case p_partkey % 9 when 0 then 0 when 1 then 3 when 2 then 45 when 3 then 61 when 4 then 75 when 5 then 82 when 6 then 95 when 7 then 99 else 42 end as int) as weathercode,
  p_retailprice / 60 as windspeed_ms,
  case when p_partkey % 19 = 0 then null else cast(p_partkey * 53 % 500 as double) / 10 end as windgusts_ms,
  cast(p_partkey % 7 as double) / 2 as precipitation_mm,
  cast(p_partkey % 5 as double) as snowfall_cm,
  cast(p_partkey % 101 as double) as cloudcover_pct,
  cast(p_partkey * 41 % 1800 as double) / 10 - 100 as temperature_c,
  cast(p_partkey * 7 % 101 as double) as humidity_pct,
  cast(p_partkey * 37 % 12000 as double) as visibility_m,
  cast(p_partkey % 120 as double) + 930 as pressure_hpa
from part
""",
    "fx_weather_stream": """
select event_id, event_type as region_name, ts as snapshot_ts,
  cast((event_id * 49979687) % 6001 as double) / 100 as latitude,
  cast((event_id * 67867967) % 8001 as double) / 100 - 20 as longitude,
  case when event_id % 23 = 0 then null else value / 10 - 10 end as temperature_c,
  value / 20 as windspeed_ms, value / 10 as windgusts_ms, value * 20 as visibility_m,
  cast(event_id % 101 as double) as humidity_pct, cast(event_id % 6 as double) / 4 as precipitation_mm
from events
""",
    "fx_airports": """
select c_custkey as airport_id, c_name as name, 'City ' || cast(c_custkey % 200 as string) as city,
  case c_nationkey % 8 when 0 then 'United States' when 1 then 'Brazil' when 2 then 'France' when 3 then 'Japan'
       when 4 then 'Kenya' when 5 then 'Australia' when 6 then 'Atlantis' else 'NATION_' || cast(c_nationkey as string) end as country,
  case when c_custkey % 9 = 0 then null
       else chr(cast(65 + c_custkey % 26 as int)) || chr(cast(65 + floor(c_custkey / 26) % 26 as int)) || chr(cast(65 + floor(c_custkey / 676) % 26 as int))
            || case when c_custkey >= 17576 then cast(cast(floor(c_custkey / 17576) as bigint) as string) else '' end end as iata,
  case when c_custkey % 14 = 0 then null
       else 'K' || chr(cast(65 + c_custkey % 26 as int)) || chr(cast(65 + floor(c_custkey / 26) % 26 as int)) || chr(cast(65 + floor(c_custkey / 676) % 26 as int))
            || case when c_custkey >= 17576 then cast(cast(floor(c_custkey / 17576) as bigint) as string) else '' end end as icao,
  cast((c_custkey * 7919) % 18201 as double) / 100 - 91 as latitude,
  cast((c_custkey * 104729) % 36201 as double) / 100 - 181 as longitude,
  cast(c_custkey % 9000 - 200 as int) as altitude_ft,
  case when c_custkey % 6 = 0 then '' else 'Etc/GMT' end as tz_database,
  case c_custkey % 10 when 0 then 'station' when 1 then 'unknown' else 'airport' end as airport_type
from customer
""",
    "fx_airlines": """
select s_suppkey as airline_id, s_name as name,
  case when s_suppkey % 3 = 0 then '' else 'alias' end as alias,
  case when s_suppkey % 7 = 0 then null
       else chr(cast(97 + s_suppkey % 5 as int)) || chr(cast(65 + floor(s_suppkey / 5) % 5 as int))
            || case when s_suppkey >= 100 then cast(cast(floor(s_suppkey / 100) as bigint) as string) else '' end end as iata,
  case when s_suppkey % 11 = 0 then null
       else 'X' || chr(cast(65 + s_suppkey % 5 as int)) || chr(cast(65 + floor(s_suppkey / 5) % 5 as int))
            || case when s_suppkey >= 100 then cast(cast(floor(s_suppkey / 100) as bigint) as string) else '' end end as icao,
  'NATION_' || cast(s_nationkey as string) as country,
  case when s_suppkey % 13 = 0 then null when s_acctbal > 3000 then 'Y' else 'N' end as active
from supplier
""",
    "fx_routes": """
select l_orderkey * 10 + l_linenumber as route_id,
  chr(cast(case when l_linenumber = 3 then 97 else 65 end + l_suppkey % 5 as int)) || chr(cast(65 + floor(l_suppkey / 5) % 5 as int))
    || case when l_suppkey >= 100 then cast(cast(floor(l_suppkey / 100) as bigint) as string) else '' end as airline,
  chr(cast(65 + l_orderkey % 26 as int)) || chr(cast(65 + floor(l_orderkey / 26) % 26 as int)) || chr(cast(65 + floor(l_orderkey / 676) % 26 as int)) as src_airport,
  case when l_partkey % 31 = 0 then null
       else chr(cast(65 + l_partkey % 26 as int)) || chr(cast(65 + floor(l_partkey / 26) % 26 as int)) || chr(cast(65 + floor(l_partkey / 676) % 26 as int)) end as dst_airport,
  case when l_returnflag = 'A' then 'Y' else null end as codeshare,
  cast(l_linenumber % 2 as int) as stops, '738 320' as equipment
from lineitem
""",
}

_BASE = re.compile(r"from (\w+)\s*$")


def base_table(name: str) -> str:
    """Given table a fixture is built on."""
    return _BASE.search(FIXTURES[name].rstrip()).group(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with plain times read as UTC instants."""
    return as_instants(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def as_instants(df: DataFrame) -> DataFrame:
    plain = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in plain}) if plain else df


def shape(base: DataFrame, name: str) -> DataFrame:
    """A fixture over its base rows, batch or streaming."""
    sql = FIXTURES[name]
    source = base_table(name)
    return base.sparkSession.sql(_BASE.sub(f"from {{{source}}}", sql.rstrip()), **{source: base})


def newest_time(events: DataFrame) -> Column:
    """The present of the fixtures: time of the newest event."""
    return events.agg(F.max("ts")).scalar()
