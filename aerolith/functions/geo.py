"""Points, grid cells and distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID_STEP = 10
EARTH_RADIUS_KM = 6371

# Continent boxes, tried in this order because they overlap.
# (name, lat_min, lat_max, lon_min, lon_max), edges inclusive.
CONTINENT_BOXES = [
    ("North America", 23.5, 66.5, -130, -60),
    ("South America", -56, 13, -82, -34),
    ("Europe", 36, 71, -9, 40),
    ("Africa", -35, 37, -17, 51),
    ("Asia", -10, 55, 26, 145),
    ("Oceania", -47, -10, 112, 154),
]


def grid_cell(lat: Column, lon: Column, step: int = GRID_STEP) -> tuple[Column, Column]:
    """South-west corner of the cell holding the point, as two integers."""
    return tuple((F.floor(c / step) * step).cast("int") for c in (lat, lon))


def with_cell(df, lat: str, lon: str, step: int = GRID_STEP):
    cell_lat, cell_lon = grid_cell(F.col(lat), F.col(lon), step)
    return df.withColumns({"grid_lat": cell_lat, "grid_lon": cell_lon})


def on_globe(lat: Column, lon: Column) -> Column:
    """True for a complete coordinate pair inside the valid range."""
    return lat.between(-90, 90) & lon.between(-180, 180)


def point(lon: Column, lat: Column) -> Column:
    """Point as a (lon, lat) struct; NULL unless both parts are known."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))

    h = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    return F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_KM)


def continent_of_point(lat: str, lon: str) -> Column:
    """Continent of the point in two columns; the first matching box counts."""
    cases = " ".join(
        f"when {lat} between {south} and {north} and {lon} between {west} and {east} then '{name}'"
        for name, south, north, west, east in CONTINENT_BOXES
    )
    return F.expr(f"case when {lat} is null or {lon} is null then 'unknown' {cases} else 'Other' end")


def project_ahead(lat: Column, lon: Column, speed: Column, track: Column) -> tuple[Column, Column]:
    """Point ahead of an aircraft: 0.3 to 3 degrees along its track by speed."""
    reach = F.least(F.lit(3.0), F.greatest(F.lit(0.3), speed / 100))
    return lat + reach * F.cos(F.radians(track)), lon + reach * F.sin(F.radians(track))


# --- the WGS84 spheroid ------------------------------------------------------------------------

SPHEROID_A = 6378137.0
SPHEROID_F = 1 / 298.257223563
_SPHEROID_B = SPHEROID_A * (1 - SPHEROID_F)
_SECOND_ECCENTRICITY = (SPHEROID_A**2 - _SPHEROID_B**2) / _SPHEROID_B**2


def _bound(body, **values: Column) -> Column:
    """``body`` of the named values; each is worked out once, however often the body names it."""
    row = F.array(F.struct(*[v.alias(name) for name, v in values.items()]))
    return F.transform(row, lambda r: body(**{name: r[name] for name in values}))[0]


def _arc_metres(cos2_alpha: Column, sin_s: Column, cos_s: Column, sigma: Column, cos_2m: Column) -> Column:
    """Metres along an arc ``sigma`` whose middle has the double angle cosine ``cos_2m``."""
    u2 = cos2_alpha * _SECOND_ECCENTRICITY
    a = u2 / 16384 * (u2 * (u2 * (u2 * -175 + 320) - 768) + 4096) + 1
    b = u2 / 1024 * (u2 * (u2 * (u2 * -47 + 74) - 128) + 256)

    def length(a: Column, b: Column, twice: Column) -> Column:
        third = b / 6 * cos_2m * (sin_s * sin_s * 4 - 3) * (twice * 2 - 1)
        change = b * sin_s * (cos_2m + b / 4 * (cos_s * twice - third))
        return a * _SPHEROID_B * (sigma - change)

    return _bound(length, a=a, b=b, twice=cos_2m * cos_2m * 2 - 1)


def _longitude_gain(cos2_alpha: Column, sin_alpha: Column, sin_s: Column, cos_s: Column, sigma: Column, cos_2m: Column) -> Column:
    """Longitude on the auxiliary sphere minus longitude on the spheroid, in radians."""

    def gain(c: Column) -> Column:
        inner = sigma + c * sin_s * (cos_2m + c * cos_s * (cos_2m * cos_2m * 2 - 1))
        return (F.lit(1.0) - c) * SPHEROID_F * sin_alpha * inner

    return _bound(gain, c=cos2_alpha * (SPHEROID_F / 16) * (cos2_alpha * -3 * SPHEROID_F + 4 * SPHEROID_F + 4))


def _arc_between(sin1: Column, cos1: Column, sin2: Column, cos2: Column, lam: Column, body) -> Column:
    """``body`` of the arc between two reduced latitudes that are ``lam`` apart on the auxiliary sphere."""

    def of_angle(sin_s: Column, cos_s: Column, across: Column) -> Column:
        sin_alpha = F.when(sin_s == 0, 0.0).otherwise(cos1 * across / sin_s)
        return _bound(of_alpha, sin_s=sin_s, cos_s=cos_s, sigma=F.atan2(sin_s, cos_s), sin_alpha=sin_alpha)

    def of_alpha(sin_alpha: Column, **angle: Column) -> Column:
        return _bound(of_middle, cos2_alpha=F.lit(1.0) - sin_alpha * sin_alpha, sin_alpha=sin_alpha, **angle)

    def of_middle(cos2_alpha: Column, cos_s: Column, **rest: Column) -> Column:
        cos_2m = F.when(cos2_alpha < 1e-15, 0.0).otherwise(cos_s - sin1 * sin2 * 2 / cos2_alpha)
        return _bound(body, cos2_alpha=cos2_alpha, cos_s=cos_s, cos_2m=cos_2m, **rest)

    across, along = cos2 * F.sin(lam), cos1 * sin2 - sin1 * cos2 * F.cos(lam)
    return _bound(
        of_angle,
        sin_s=F.sqrt(across * across + along * along),
        cos_s=sin1 * sin2 + cos1 * cos2 * F.cos(lam),
        across=across,
    )


def geodesic_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, steps: int = 20, halvings: int = 60) -> Column:
    """Shortest distance on the WGS84 spheroid in metres; NULL if a part is NULL or off the globe.

    The longitude difference on the auxiliary sphere is found by ``steps`` fixed-point
    steps. Nearly antipodal points, for which they do not settle, take the start
    azimuth instead, halved ``halvings`` times: the longitude reached grows with it.
    Everything is a built-in expression with a fixed number of steps.
    """
    whole = on_globe(lat1, lon1) & on_globe(lat2, lon2)
    turn = F.abs(lon2 - lon1)
    apart = F.radians(F.when(turn > 180, F.lit(360.0) - turn).otherwise(turn))
    u1, u2 = (F.atan(F.tan(F.radians(c)) * (1 - SPHEROID_F)) for c in (lat1, lat2))

    def solve(u1: Column, u2: Column, apart: Column) -> Column:
        return _bound(
            settle, u1=u1, u2=u2, apart=apart, sin1=F.sin(u1), cos1=F.cos(u1), sin2=F.sin(u2), cos2=F.cos(u2)
        )

    def settle(u1: Column, u2: Column, apart: Column, **sides: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            after = _arc_between(**sides, lam=state["lam"], body=lambda **arc: apart + _longitude_gain(**arc))
            return F.struct(after.alias("lam"), state["lam"].alias("before"))

        def measure(last: Column) -> Column:
            usual = _arc_between(**sides, lam=last["lam"], body=lambda sin_alpha, **arc: _arc_metres(**arc))
            settled = (F.abs(last["lam"] - last["before"]) < 1e-12) & (F.abs(last["lam"]) < 3.1415)
            return F.when(settled, usual).otherwise(_antipodal_metres(u1, u2, apart, halvings))

        start = F.struct(apart.alias("lam"), F.lit(10.0).alias("before"))
        return _bound(measure, last=F.reduce(F.sequence(F.lit(1), F.lit(steps)), start, step))

    metres = F.when((lat1 == lat2) & (apart == 0), 0.0).otherwise(_bound(solve, u1=u1, u2=u2, apart=apart))
    return F.when(whole, metres)


def _antipodal_metres(u1: Column, u2: Column, apart: Column, halvings: int) -> Column:
    """Distance by the start azimuth, from the end of the wider latitude, taken as the southern one."""
    wide = F.abs(u1) >= F.abs(u2)
    first, second = F.when(wide, u1).otherwise(u2), F.when(wide, u2).otherwise(u1)
    second = F.when(first > 0, -second).otherwise(second)
    first = F.least(-F.abs(first), F.lit(-1e-12))  # a start on the equator is taken just below it

    def search(sin1: Column, cos1: Column, sin2: Column, cos2: Column) -> Column:
        def arc(azimuth: Column, body) -> Column:
            def of_ends(sin_alpha: Column, s1: Column, s2: Column) -> Column:
                sphere = F.atan2(sin_alpha * F.sin(s2), F.cos(s2)) - F.atan2(sin_alpha * F.sin(s1), F.cos(s1))
                return _bound(
                    body, cos2_alpha=F.lit(1.0) - sin_alpha * sin_alpha, sin_alpha=sin_alpha, sin_s=F.sin(s2 - s1),
                    cos_s=F.cos(s2 - s1), sigma=s2 - s1, cos_2m=F.cos(s1 + s2), sphere=sphere,
                )

            ahead1 = F.cos(azimuth) * cos1
            ahead2 = F.sqrt(F.greatest(F.lit(0.0), ahead1 * ahead1 + cos2 * cos2 - cos1 * cos1))
            return _bound(
                of_ends, sin_alpha=F.sin(azimuth) * cos1, s1=F.atan2(sin1, ahead1), s2=F.atan2(sin2, ahead2)
            )

        def halve(state: Column, _: Column) -> Column:
            def cut(low: Column, high: Column, middle: Column) -> Column:
                beyond = arc(middle, lambda sphere, **rest: sphere - _longitude_gain(**rest) > apart)
                return _bound(
                    lambda beyond: F.struct(
                        F.when(beyond, low).otherwise(middle).alias("low"),
                        F.when(beyond, middle).otherwise(high).alias("high"),
                    ),
                    beyond=beyond,
                )

            return _bound(cut, low=state["low"], high=state["high"], middle=(state["low"] + state["high"]) / 2)

        ends = F.struct(F.lit(0.0).alias("low"), F.radians(F.lit(180.0)).alias("high"))
        last = F.reduce(F.sequence(F.lit(1), F.lit(halvings)), ends, halve)
        return _bound(
            lambda last: arc(
                (last["low"] + last["high"]) / 2, lambda sin_alpha, sphere, **rest: _arc_metres(**rest)
            ),
            last=last,
        )

    return _bound(search, sin1=F.sin(first), cos1=F.cos(first), sin2=F.sin(second), cos2=F.cos(second))


# --- well-known binary -------------------------------------------------------------------------


def double_bits(x: Column) -> Column:
    """The 64 bits of a double as a long; minus zero counts as zero, NULL unless finite."""
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    high = F.when(F.pow(F.lit(2.0), guess + 1) <= size, 1).when(F.pow(F.lit(2.0), guess) > size, -1).otherwise(0)
    exponent = F.greatest(guess + high, F.lit(-1022))
    normal = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * 2.0**52)
    tiny = F.floor(size * 2.0**537 * 2.0**537)
    small = size < 2.0**-1022
    bits = F.when(small, tiny).otherwise(F.shiftleft((exponent + 1023).cast("long"), 52).bitwiseOR(normal))
    signed = F.when(x < 0, bits.bitwiseOR(F.lit(-(2**63)))).otherwise(bits)
    return F.when(x == 0, F.lit(0).cast("long")).when(size < float("inf"), signed)


def _swapped(hexes: Column, first: int) -> Column:
    """Eight bytes of a hex text from position ``first`` on, in the opposite order."""
    return F.concat(*[F.substring(hexes, first + 2 * k, 2) for k in reversed(range(8))])


# Fixed value: byte order (little endian) and geometry type (point) at the head of a binary point.
_POINT_HEAD = "0101000000"


def point_wkb(lon: Column, lat: Column) -> Column:
    """Point as well-known binary; NULL unless both parts are finite numbers."""
    sides = [_swapped(F.lpad(F.hex(double_bits(c.cast("double"))), 16, "0"), 1) for c in (lon, lat)]
    return F.unhex(F.concat(F.lit(_POINT_HEAD), *sides))


def geography(wkb: Column) -> Column:
    """Binary point as a value of the built-in geography type."""
    return F.st_geogfromwkb(wkb)


def wkb_point(wkb: Column) -> Column:
    """Struct (lon, lat) of a little-endian binary point; NULL for anything else."""
    hexes = F.hex(wkb)

    def value(first: int) -> Column:
        digits = _swapped(hexes, first)
        high, low = (F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9))
        exponent = F.shiftright(high, 20).bitwiseAND(F.lit(0x7FF))
        part = (high.bitwiseAND(F.lit(0xFFFFF)) * 2**32 + low).cast("double")
        whole = (part / 2.0**52 + 1) * F.pow(F.lit(2.0), exponent - 1023)
        size = F.when(exponent == 0, part * 2.0**-1074).otherwise(whole)
        return F.when(high >= 2**31, -size).otherwise(size)

    plain = (F.octet_length(wkb) == 21) & hexes.startswith(_POINT_HEAD)
    return F.when(plain, F.struct(value(11).alias("lon"), value(27).alias("lat")))
