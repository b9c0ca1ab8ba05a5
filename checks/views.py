"""Reference SQL of the layered tables, shared by the reference statements."""

from __future__ import annotations

from aerolith.functions.geo import CONTINENT_BOXES
from aerolith.functions.rules import CONTINENT_COUNTRIES, WEATHER_LABELS
from checks.registry import AS_OF, CTES, rnd, rnd_once


def cell(column: str) -> str:
    return f"cast(floor({column} / 10) * 10 as integer)"


def great_circle(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"12742 * asin(sqrt(pow(sin(radians(({lat2} - {lat1}) / 2)), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians(({lon2} - {lon1}) / 2)), 2)))"
    )


_boxes = " ".join(
    f"when latitude >= {s} and latitude <= {n} and longitude >= {w} and longitude <= {e} then '{name}'"
    for name, s, n, w, e in CONTINENT_BOXES
)
_labels = " ".join(f"when {code} then '{label}'" for code, label in WEATHER_LABELS.items())
_countries = " ".join(
    f"when country in ({', '.join(repr(c) for c in names)}) then '{continent}'"
    for continent, names in CONTINENT_COUNTRIES.items()
)

CTES["v_flights"] = f"""
select icao24, nullif(trim(callsign), '') as callsign, nullif(trim(origin_country), '') as origin_country,
  time_position, last_contact, longitude, latitude, baro_altitude, on_ground, velocity, true_track, category,
  case when baro_altitude >= 0 then {rnd_once("baro_altitude", 1)} end as baro_altitude_m,
  case when velocity >= 0 then {rnd_once("velocity * 1.94384", 1)} end as velocity_knots,
  case {_boxes} else 'Other' end as continent,
  {cell("latitude")} as grid_lat, {cell("longitude")} as grid_lon
from fx_flights
where latitude between -90 and 90 and longitude between -180 and 180"""

CTES["v_weather"] = f"""
select point_id, latitude, longitude, trim(region_name) as region_name, {rnd_once("elevation_m", 1)} as elevation_m,
  weathercode, {rnd_once("windspeed_ms", 2)} as windspeed_ms, {rnd_once("windgusts_ms", 2)} as windgusts_ms,
  {rnd_once("precipitation_mm", 2)} as precipitation_mm, {rnd_once("snowfall_cm", 2)} as snowfall_cm,
  {rnd_once("cloudcover_pct", 1)} as cloudcover_pct, {rnd_once("temperature_c", 2)} as temperature_c,
  {rnd_once("humidity_pct", 1)} as humidity_pct, {rnd_once("visibility_m", 0)} as visibility_m,
  {rnd_once("pressure_hpa", 2)} as pressure_hpa,
  case weathercode {_labels} else 'Unknown' end as weather_label,
  case when windgusts_ms is null or windgusts_ms >= 40 then 'storm' when windgusts_ms >= 30 then 'gale'
       when windgusts_ms >= 20 then 'strong' when windgusts_ms >= 10 then 'moderate' else 'calm' end as wind_severity,
  {cell("latitude")} as grid_lat, {cell("longitude")} as grid_lon
from fx_weather
where temperature_c between -90 and 60"""

CTES["v_seismics"] = f"""
select id, {rnd_once("mag", 2)} as mag, upper(trim(mag_type)) as mag_type, trim(place) as place, tsunami, event_time,
  event_type, title, sig, lat, lon, {rnd_once("depth", 2)} as depth_km,
  case when place like '%, %' then trim(string_split(place, ',')[-1]) else trim(place) end as region,
  case when mag >= 8 then 'great' when mag >= 7 then 'major' when mag >= 6 then 'strong' when mag >= 5 then 'moderate'
       when mag >= 4 then 'light' when mag >= 2 then 'minor' else 'micro' end as magnitude_class,
  tsunami <> 0 as is_tsunami_related, {cell("lat")} as grid_lat, {cell("lon")} as grid_lon
from fx_seismics
where mag is not null and event_time is not null and lat between -90 and 90 and lon between -180 and 180"""

CTES["v_airports"] = f"""
select airport_id, trim(name) as airport_name, trim(city) as city, trim(country) as country,
  nullif(trim(iata), '') as iata_code, nullif(trim(icao), '') as icao_code,
  {rnd_once("latitude", 6)} as latitude, {rnd_once("longitude", 6)} as longitude, altitude_ft,
  {rnd_once("altitude_ft * 0.3048::double", 1)} as altitude_m, nullif(trim(tz_database), '') as tz_database,
  case {_countries} else 'Other' end as continent, airport_type
from fx_airports
where latitude between -90 and 90 and longitude between -180 and 180 and airport_type <> 'station'"""

CTES["v_airlines"] = """
select airline_id, trim(name) as airline_name, nullif(trim(alias), '') as alias,
  nullif(upper(trim(iata)), '') as iata_code, nullif(upper(trim(icao)), '') as icao_code,
  trim(country) as country, active is not distinct from 'Y' as is_active
from fx_airlines
where name is not null and (nullif(trim(iata), '') is not null or nullif(trim(icao), '') is not null)"""

CTES["v_airline_codes"] = """
select iata_code as code, airline_id, airline_name, country, is_active from v_airlines where iata_code is not null
union all
select icao_code, airline_id, airline_name, country, is_active from v_airlines
where iata_code is null and icao_code is not null"""

CTES["v_airport_codes"] = """
select iata_code as code, airport_id, airport_name, city, country, continent, latitude, longitude, tz_database
from v_airports where iata_code is not null
union all
select icao_code, airport_id, airport_name, city, country, continent, latitude, longitude, tz_database
from v_airports where iata_code is null and icao_code is not null"""

_km = great_circle("a.latitude", "a.longitude", "b.latitude", "b.longitude")
CTES["v_routes"] = f"""
select r.airline as airline_code, c.airline_name, c.country as airline_country, c.is_active as airline_is_active,
  r.src_airport as origin_code, a.airport_name as origin_airport_name, a.city as origin_city,
  a.country as origin_country, a.continent as origin_continent, a.latitude as origin_lat,
  a.longitude as origin_lon, a.tz_database as origin_timezone,
  r.dst_airport as destination_code, b.airport_name as destination_airport_name, b.city as destination_city,
  b.country as destination_country, b.continent as destination_continent, b.latitude as destination_lat,
  b.longitude as destination_lon, b.tz_database as destination_timezone,
  r.codeshare = 'Y' as is_codeshare, r.stops, r.equipment as aircraft_codes,
  {rnd_once(_km, 1)} as distance_km,
  case when a.continent = b.continent then 'domestic/regional' else 'international' end as route_type
from fx_routes r
left join v_airline_codes c on c.code = upper(r.airline)
left join v_airport_codes a on a.code = r.src_airport
left join v_airport_codes b on b.code = r.dst_airport
where r.src_airport is not null and r.dst_airport is not null"""

_centre = great_circle("latitude", "longitude", f"{cell('latitude')} + 5", f"{cell('longitude')} + 5")
CTES["v_airport_grid"] = f"""
select grid_lat, grid_lon, airport_name, iata_code, icao_code, city, country, continent, tz_database, altitude_m
from (
  select *, {cell("latitude")} as grid_lat, {cell("longitude")} as grid_lon,
    row_number() over (partition by {cell("latitude")}, {cell("longitude")}
                       order by {rnd(_centre, 6)}, airport_id) as rn
  from v_airports)
where rn = 1"""

CTES["v_country_airline"] = """
select country, airline_name, iata_code as airline_iata, icao_code as airline_icao
from (
  select *, row_number() over (partition by country order by airline_name, airline_id) as rn
  from v_airlines where is_active)
where rn = 1"""

CTES["v_enriched"] = f"""
select f.icao24, f.callsign, f.origin_country, f.time_position, f.last_contact, f.longitude, f.latitude,
  f.baro_altitude_m, f.on_ground,
  case when f.velocity >= 0 then {rnd_once("f.velocity", 2)} end as velocity_ms, f.velocity_knots,
  case when f.on_ground then 'on_ground' when f.baro_altitude is null then 'unknown'
       when f.baro_altitude >= 3000 then 'cruising' when f.baro_altitude >= 300 then 'climbing_descending'
       else 'takeoff_landing' end as flight_phase,
  f.continent as current_continent, f.grid_lat, f.grid_lon, f.true_track, f.category,
  g.airport_name as nearest_airport_name, g.iata_code as nearest_airport_iata, g.icao_code as nearest_airport_icao,
  g.city as nearest_airport_city, g.country as nearest_airport_country, g.continent as nearest_airport_continent,
  g.tz_database as nearest_airport_timezone, g.altitude_m as nearest_airport_altitude_m,
  g.airport_name is not null as near_airport, c.airline_name, c.airline_iata, c.airline_icao
from v_flights f
left join v_airport_grid g on g.grid_lat = f.grid_lat and g.grid_lon = f.grid_lon
left join v_country_airline c on c.country = f.origin_country"""


def tumble(ts: str, size: str = "5 minute") -> tuple[str, str]:
    start = f"time_bucket(interval {size}, {ts})"
    return start, f"{start} + interval {size}"


def windows(source: str, ts: str, dims: str, aggs: str, where: str = "true", size: str = "5 minute") -> str:
    """Windowed aggregate as a select statement; ``dims`` are '<expr> as <name>' items."""
    start, end = tumble(ts, size)
    names = [d.rsplit(" as ", 1) for d in dims.split(";")]
    listed_dims = ", ".join(f"{e} as {n}" for e, n in names)
    grouped = ", ".join(e for e, _ in names)
    return (
        f"select {start} as window_start, {end} as window_end, {listed_dims}, {aggs} "
        f"from {source} where {where} group by {start}, {grouped}"
    )


FLIGHT_AGGS = (
    "count(*) as flight_count, count(*) filter (where not on_ground) as airborne_count, "
    "avg(baro_altitude) as avg_altitude_m, avg(velocity) as avg_velocity_ms"
)
FIRST_COMMA = "case when place like '%, %' then trim(substring(place, position(',' in place) + 1)) else place end"
SEISMIC_AGGS = (
    "avg(mag) as avg_magnitude, max(mag) as max_magnitude, count(*) as event_count, "
    "cast(sum(tsunami) as bigint) as tsunami_count, avg(depth) as avg_depth"
)
WEATHER_AGGS = (
    "avg(temperature_c) as avg_temperature_c, min(temperature_c) as min_temperature_c, "
    "max(temperature_c) as max_temperature_c, avg(windspeed_ms) as avg_windspeed_ms, "
    "avg(windgusts_ms) as avg_windgusts_ms, avg(visibility_m) as avg_visibility_m, "
    "avg(humidity_pct) as avg_humidity_pct, sum(precipitation_mm) as total_precip_mm, count(*) as snapshot_count"
)

CTES["w_flights"] = windows("fx_flights", "time_position", "origin_country as origin_country", FLIGHT_AGGS)
CTES["w_seismics"] = windows("fx_seismics", "event_time", f"{FIRST_COMMA} as region", SEISMIC_AGGS)
CTES["w_weather"] = windows("fx_weather_stream", "snapshot_ts", "region_name as region_name", WEATHER_AGGS)


def cells(lat: str, lon: str) -> str:
    return f"{cell(lat)} as grid_lat;{cell(lon)} as grid_lon"


def flights_cells(size: str) -> str:
    aggs = "count(*) as flight_count, count(*) filter (where not on_ground) as airborne_count, avg(baro_altitude) as avg_altitude_m"
    return windows("fx_flights", "time_position", cells("latitude", "longitude"), aggs, size=size)


def seismics_cells(size: str) -> str:
    aggs = "count(*) as nearby_eq_count, max(mag) as max_eq_magnitude, cast(sum(tsunami) as bigint) as tsunami_count"
    return windows("fx_seismics", "event_time", cells("lat", "lon"), aggs, size=size)


def weather_cells(size: str) -> str:
    aggs = (
        "avg(temperature_c) as avg_temperature_c, avg(windgusts_ms) as avg_windgusts_ms, "
        "avg(visibility_m) as avg_visibility_m"
    )
    return windows("fx_weather_stream", "snapshot_ts", cells("latitude", "longitude"), aggs, size=size)


def context(size: str) -> str:
    on = "using (window_start, window_end, grid_lat, grid_lon)"
    return f"""
select window_start, window_end, grid_lat, grid_lon, flight_count, airborne_count, avg_altitude_m,
  coalesce(nearby_eq_count, 0) as nearby_eq_count, coalesce(max_eq_magnitude, 0) as max_eq_magnitude,
  coalesce(tsunami_count, 0) as tsunami_count, coalesce(avg_temperature_c, 0) as avg_temperature_c,
  coalesce(avg_windgusts_ms, 0) as avg_windgusts_ms, coalesce(avg_visibility_m, 0) as avg_visibility_m
from ({flights_cells(size)}) f left join ({seismics_cells(size)}) s {on} left join ({weather_cells(size)}) w {on}"""


CTES["w_context"] = context("6 hour")


def mode_cte(source: str, keys: str, value: str, name: str) -> str:
    """Most frequent non-null value, lowest on ties, as (keys, name)."""
    return (
        f"select {keys}, {value} as {name} from (select {keys}, {value}, row_number() over "
        f"(partition by {keys} order by count(*) desc, {value}) as rn from {source} "
        f"where {value} is not null group by {keys}, {value}) where rn = 1"
    )


def mode_joins(source: str, keys: list[str], modes: dict[str, str], base: str) -> str:
    """Left joins that bring the modes to a base relation."""
    out = ""
    for i, (name, value) in enumerate(modes.items()):
        on = " and ".join(f"m{i}.{k} is not distinct from {base}.{k}" for k in keys)
        out += f" left join ({mode_cte(source, ', '.join(keys), value, name)}) m{i} on {on}"
    return out


_activity_modes = {"most_common_airport": "nearest_airport_name", "most_common_city": "nearest_airport_city"}
CTES["m_activity"] = f"""
select t.*, most_common_airport, most_common_city, l.window_start as last_window_start,
  l.window_end as last_window_end, l.flight_count as window_flight_count,
  {rnd("l.avg_velocity_ms", 2)} as window_avg_velocity_ms, h.peak_flights_2h, h.min_flights_2h, h.avg_flights_2h
from (
  select origin_country, current_continent as continent, max(airline_name) as airline_name,
    max(airline_iata) as airline_iata, max(airline_icao) as airline_icao, count(*) as live_flight_count,
    count(*) filter (where not on_ground) as live_airborne_count,
    count(*) filter (where on_ground) as live_on_ground_count,
    count(*) filter (where flight_phase = 'cruising') as cruising_count,
    count(*) filter (where flight_phase = 'climbing_descending') as climb_descend_count,
    count(*) filter (where flight_phase = 'takeoff_landing') as takeoff_landing_count,
    {rnd("avg(baro_altitude_m)", 1)} as avg_altitude_m, {rnd("avg(velocity_knots)", 1)} as avg_speed_knots,
    max(velocity_knots) as max_speed_knots, max(baro_altitude_m) as max_altitude_m,
    count(*) filter (where near_airport) as flights_near_airport,
    {rnd("count(*) filter (where near_airport) / count(*)::double * 100", 1)} as pct_near_airport,
    count(distinct cast(grid_lat as varchar) || '_' || cast(grid_lon as varchar)) as active_grid_cells
  from v_enriched where origin_country is not null group by origin_country, current_continent) t
{mode_joins("(select *, current_continent as continent from v_enriched)", ["origin_country", "continent"], _activity_modes, "t")}
left join (select * from w_flights where window_end = (select max(window_end) from w_flights)) l
  on l.origin_country = t.origin_country
left join (
  select origin_country, max(flight_count) as peak_flights_2h, min(flight_count) as min_flights_2h,
    {rnd("avg(flight_count)", 1)} as avg_flights_2h
  from w_flights where window_end >= {AS_OF} - interval 2 hour group by origin_country) h
  on h.origin_country = t.origin_country"""

GRID_MODES = {
    "primary_airport_name": "nearest_airport_name",
    "primary_airport_iata": "nearest_airport_iata",
    "primary_airport_city": "nearest_airport_city",
    "primary_airport_country": "nearest_airport_country",
    "primary_airport_timezone": "nearest_airport_timezone",
    "continent": "current_continent",
    "dominant_airline": "airline_name",
}
_cell = ["grid_lat", "grid_lon"]
CTES["m_live"] = f"""
select t.*, {", ".join(GRID_MODES)} from (
  select grid_lat, grid_lon, count(*) as live_flight_count,
    count(*) filter (where flight_phase = 'cruising') as cruising_count,
    count(*) filter (where flight_phase = 'climbing_descending') as climb_descend_count,
    count(*) filter (where flight_phase = 'takeoff_landing') as takeoff_landing_count,
    count(*) filter (where near_airport) as near_airport_count,
    {rnd("avg(velocity_knots)", 1)} as avg_speed_knots, max(baro_altitude_m) as max_altitude_m,
    count(distinct airline_iata) as distinct_airlines
  from v_enriched group by grid_lat, grid_lon) t
{mode_joins("v_enriched", _cell, GRID_MODES, "t")}"""
CTES["m_sky"] = f"""
select t.*, wind_severity, weather_label from (
  select grid_lat, grid_lon, {rnd("avg(temperature_c)", 2)} as avg_temp_c,
    {rnd("avg(windgusts_ms)", 2)} as avg_windgusts_ms, {rnd("avg(visibility_m)", 0)} as avg_visibility_m,
    {rnd("avg(precipitation_mm)", 2)} as avg_precip_mm
  from v_weather group by grid_lat, grid_lon) t
{mode_joins("v_weather", _cell, {"wind_severity": "wind_severity", "weather_label": "weather_label"}, "t")}"""
CTES["m_quakes"] = f"""
select grid_lat, grid_lon, count(*) as eq_count_24h, max(mag) as max_mag_24h,
  count(*) filter (where is_tsunami_related) as tsunami_count_24h, {rnd("avg(mag)", 2)} as avg_mag_24h
from v_seismics where event_time >= {AS_OF} - interval 24 hour group by grid_lat, grid_lon"""

CTES["m_context"] = f"""
select c.window_start, c.window_end, c.grid_lat, c.grid_lon, l.continent, l.primary_airport_name,
  l.primary_airport_iata, l.primary_airport_city, l.primary_airport_country, l.primary_airport_timezone,
  l.distinct_airlines, l.dominant_airline, c.flight_count, c.airborne_count,
  c.flight_count - c.airborne_count as ground_count, {rnd("c.avg_altitude_m", 1)} as avg_altitude_m,
  l.cruising_count, l.climb_descend_count, l.takeoff_landing_count, l.near_airport_count, l.avg_speed_knots,
  l.max_altitude_m, c.nearby_eq_count, c.max_eq_magnitude, c.tsunami_count,
  coalesce(q.eq_count_24h, 0) as eq_count_24h, coalesce(q.max_mag_24h, 0) as max_mag_24h,
  coalesce(q.tsunami_count_24h, 0) as tsunami_count_24h,
  {rnd("c.avg_temperature_c", 2)} as avg_temperature_c, {rnd("c.avg_windgusts_ms", 2)} as avg_windgusts_ms,
  {rnd("c.avg_visibility_m", 0)} as avg_visibility_m, s.wind_severity, s.weather_label, s.avg_precip_mm,
  least(100.0::double, least(25.0::double, c.flight_count / nullif(g.mean_flights, 0) * 12.5::double)
    + case when q.max_mag_24h >= 7 then 35 when q.max_mag_24h >= 5 then 20 when q.max_mag_24h >= 3 then 10 else 0 end
    + case s.wind_severity when 'storm' then 25 when 'gale' then 18 when 'strong' then 10 when 'moderate' then 5 else 0 end
    + case when s.avg_visibility_m < 500 then 15 when s.avg_visibility_m < 1000 then 8
           when s.avg_visibility_m < 3000 then 3 else 0 end) as risk_score
from (select * from w_context where window_end = (select max(window_end) from w_context)) c
cross join (select avg(flight_count) as mean_flights from w_context
            where window_end = (select max(window_end) from w_context)) g
left join m_live l on l.grid_lat = c.grid_lat and l.grid_lon = c.grid_lon
left join m_sky s on s.grid_lat = c.grid_lat and s.grid_lon = c.grid_lon
left join m_quakes q on q.grid_lat = c.grid_lat and q.grid_lon = c.grid_lon"""

CTES["v_day"] = f"select * from v_seismics where event_time >= {AS_OF} - interval 24 hour"
_classes = ", ".join(
    f"count(*) filter (where magnitude_class in ({c})) as {n}_count"
    for n, c in [("micro", "'micro'"), ("minor", "'minor'"), ("light", "'light'"), ("moderate", "'moderate'"),
                 ("strong", "'strong'"), ("major_great", "'major', 'great'")]
)
CTES["m_regions"] = f"""
select region, count(*) as event_count_24h, {rnd("avg(mag)", 2)} as avg_magnitude, max(mag) as max_magnitude,
  min(mag) as min_magnitude, {rnd("avg(depth_km)", 2)} as avg_depth_km,
  count(*) filter (where is_tsunami_related) as tsunami_events, {_classes}
from v_day where region <> '' group by region"""


def trend(global_figures: bool = True) -> str:
    """Trend rows: each event of a region joined with the figures of its hour and class."""
    dims = "date_trunc('hour', event_time), magnitude_class"
    own = "" if global_figures else "region, "
    same = "true" if global_figures else "g.region is not distinct from e.region"
    return f"""
select e.region, g.hour, g.magnitude_class, g.events, g.peak_mag, g.tsunami_count, count(*) as repeats
from v_day e
join (select {own}date_trunc('hour', event_time) as hour, magnitude_class, count(*) as events,
        max(mag) as peak_mag, count(*) filter (where is_tsunami_related) as tsunami_count
      from v_day group by {own}{dims}) g
  on g.hour = date_trunc('hour', e.event_time) and g.magnitude_class = e.magnitude_class and {same}
group by all"""


CTES["m_trend"] = trend()
CTES["m_trend_own"] = trend(False)


def seismic_activity(trend_name: str) -> str:
    return f"""
select r.*, case when r.max_magnitude >= 7 or tsunami_events > 0 then 'high'
    when r.max_magnitude >= 5 or event_count_24h > 10 then 'medium' else 'low' end as risk_level,
  t.window_start as last_window_start, t.event_count as last_window_event_count,
  t.max_magnitude as last_window_max_mag, h.hourly_trend
from m_regions r
left join (
  select * from (select *, row_number() over (partition by region order by window_end desc) as rn
                 from w_seismics where window_end >= {AS_OF} - interval 3 hour)
  where rn = 1) t on t.region = r.region
left join (
  select region, '[' || string_agg(
    '{{"hour":"' || strftime(hour, '%Y-%m-%dT%H:%M:%S') || '","magnitude_class":"' || magnitude_class
    || '","events":' || events || ',"peak_mag":' || cast(peak_mag as varchar)
    || ',"tsunami_count":' || tsunami_count || ',"repeats":' || repeats || '}}',
    ',' order by hour, magnitude_class) || ']' as hourly_trend
  from {trend_name} group by region) h on h.region = r.region"""


_weather_modes = {"dominant_weather": "weather_label", "dominant_wind_severity": "wind_severity"}
CTES["m_weather_base"] = f"""
select t.*, dominant_weather, dominant_wind_severity from (
  select region_name, count(*) as station_count, {rnd("avg(temperature_c)", 2)} as avg_temp_c,
    min(temperature_c) as min_temp_c, max(temperature_c) as max_temp_c,
    {rnd("avg(humidity_pct)", 1)} as avg_humidity_pct, {rnd("avg(windspeed_ms)", 2)} as avg_windspeed_ms,
    max(windgusts_ms) as max_windgusts_ms, {rnd("sum(precipitation_mm)", 2)} as total_precip_mm,
    {rnd("sum(snowfall_cm)", 2)} as total_snowfall_cm, {rnd("avg(visibility_m)", 0)} as avg_visibility_m,
    {rnd("avg(pressure_hpa)", 1)} as avg_pressure_hpa, {rnd("avg(cloudcover_pct)", 1)} as avg_cloudcover_pct,
    count(*) filter (where precipitation_mm > 0) as stations_with_precip,
    count(*) filter (where snowfall_cm > 0) as stations_with_snow
  from v_weather where region_name is not null group by region_name) t
{mode_joins("v_weather", ["region_name"], _weather_modes, "t")}"""
CTES["m_weather_hours"] = f"""
select region_name, date_trunc('hour', window_start) as hour, {rnd("avg(avg_temperature_c)", 2)} as avg_temp_c,
  {rnd("avg(avg_windspeed_ms)", 2)} as avg_wind_ms, {rnd("sum(total_precip_mm)", 2)} as total_precip_mm
from w_weather where window_end >= {AS_OF} - interval 6 hour group by region_name, date_trunc('hour', window_start)"""
