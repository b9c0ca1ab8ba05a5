"""Banding rules and their fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.casting import round_once

MS_TO_KNOTS = 1.94384
FEET_TO_M = 0.3048

# WMO weather codes.
WEATHER_LABELS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Freezing fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Heavy freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    77: "Snow grains",
    80: "Slight showers",
    81: "Moderate showers",
    82: "Violent showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm w/ slight hail",
    99: "Thunderstorm w/ heavy hail",
}

# Band edges. Each pair is (edge, label).
GUST_BANDS = [(10, "calm"), (20, "moderate"), (30, "strong"), (40, "gale")]
MAGNITUDE_BANDS = [
    (2.0, "micro"),
    (4.0, "minor"),
    (5.0, "light"),
    (6.0, "moderate"),
    (7.0, "strong"),
    (8.0, "major"),
]
MAP_MAGNITUDE_BANDS = [(7, "Major"), (5, "Strong"), (3, "Moderate")]
PHASE_BANDS = [(300, "takeoff_landing"), (3000, "climbing_descending")]
MAGNITUDE_RISK = [(7, 35), (5, 20), (3, 10)]
VISIBILITY_RISK = [(500, 15), (1000, 8), (3000, 3)]
WIND_RISK = {"storm": 25, "gale": 18, "strong": 10, "moderate": 5}

# Continent of an airport by its country.
CONTINENT_COUNTRIES = {
    "North America": [
        "United States", "Canada", "Mexico", "Cuba", "Jamaica", "Dominican Republic", "Haiti", "Guatemala",
        "Honduras", "El Salvador", "Nicaragua", "Costa Rica", "Panama", "Bahamas", "Barbados",
        "Trinidad and Tobago",
    ],
    "South America": [
        "Brazil", "Argentina", "Colombia", "Chile", "Peru", "Venezuela", "Ecuador", "Bolivia", "Paraguay",
        "Uruguay", "Guyana", "Suriname", "French Guiana",
    ],
    "Europe": [
        "United Kingdom", "France", "Germany", "Spain", "Italy", "Netherlands", "Belgium", "Switzerland",
        "Austria", "Sweden", "Norway", "Denmark", "Finland", "Portugal", "Greece", "Poland",
        "Czech Republic", "Hungary", "Romania", "Ukraine", "Russia", "Turkey", "Ireland", "Croatia",
        "Serbia", "Bulgaria", "Slovakia", "Iceland", "Luxembourg", "Slovenia", "Estonia", "Latvia",
        "Lithuania", "Albania", "Bosnia and Herzegovina", "Moldova", "North Macedonia", "Montenegro",
        "Kosovo", "Belarus",
    ],
    "Asia": [
        "China", "Japan", "South Korea", "India", "Indonesia", "Thailand", "Vietnam", "Malaysia",
        "Philippines", "Pakistan", "Bangladesh", "Myanmar", "Saudi Arabia", "Iran", "Iraq",
        "United Arab Emirates", "Israel", "Jordan", "Kuwait", "Qatar", "Bahrain", "Oman", "Yemen", "Syria",
        "Lebanon", "Afghanistan", "Nepal", "Sri Lanka", "Cambodia", "Laos", "Mongolia", "Kazakhstan",
        "Uzbekistan", "Kyrgyzstan", "Tajikistan", "Turkmenistan", "Azerbaijan", "Georgia", "Armenia",
        "Singapore", "Taiwan", "Hong Kong",
    ],
    "Africa": [
        "Nigeria", "South Africa", "Kenya", "Ethiopia", "Egypt", "Tanzania", "Uganda", "Ghana",
        "Mozambique", "Angola", "Cameroon", "Ivory Coast", "Niger", "Burkina Faso", "Mali", "Senegal",
        "Guinea", "Zambia", "Zimbabwe", "Somalia", "South Sudan", "Sudan", "Libya", "Algeria", "Morocco",
        "Tunisia", "Madagascar", "Rwanda", "Burundi", "Benin", "Togo", "Sierra Leone", "Eritrea",
        "Djibouti", "Comoros", "Mauritius", "Seychelles", "Cape Verde", "Gambia",
    ],
    "Oceania": [
        "Australia", "New Zealand", "Papua New Guinea", "Fiji", "Solomon Islands", "Vanuatu", "Samoa",
        "Tonga", "Kiribati", "Micronesia", "Palau", "Marshall Islands", "Nauru", "Tuvalu",
    ],
}


def bands(value: Column, edges: Sequence[tuple], otherwise, below: bool = True) -> Column:
    """First band whose edge the value is below (or, with ``below=False``, at or above).

    NULL matches no band and takes ``otherwise``.
    """
    out = F
    for edge, label in edges:
        out = out.when((value < edge) if below else (value >= edge), label)
    return out.otherwise(otherwise)


def choose(value: Column, table: dict, otherwise) -> Column:
    """Label of a value in a small fixed table."""
    out = F
    for key, label in table.items():
        out = out.when(value == key, label)
    return out.otherwise(otherwise)


def weather_label(code: str) -> Column:
    """Label of the WMO code in a column. One SQL text builds faster than 28 nested calls."""
    cases = " ".join(f"when {number} then '{label}'" for number, label in WEATHER_LABELS.items())
    return F.expr(f"case {code} {cases} else 'Unknown' end")


def wind_severity(gust: Column) -> Column:
    return bands(gust, GUST_BANDS, "storm")


def magnitude_class(mag: Column) -> Column:
    return bands(mag, MAGNITUDE_BANDS, "great")


def map_magnitude_class(mag: Column) -> Column:
    return bands(mag, MAP_MAGNITUDE_BANDS, "Minor", below=False)


def flight_phase(on_ground: Column, altitude: Column) -> Column:
    """Ground first, then unknown height, then the height bands."""
    airborne = bands(altitude, PHASE_BANDS, "cruising")
    return F.when(on_ground, "on_ground").when(altitude.isNull(), "unknown").otherwise(airborne)


def country_continent(country: str) -> Column:
    """Continent of the country in a column."""
    cases = " ".join(
        f"when {country} in ({', '.join(repr(n) for n in names)}) then '{continent}'"
        for continent, names in CONTINENT_COUNTRIES.items()
    )
    return F.expr(f"case {cases} else 'Other' end")


def non_negative(value: Column, digits: int, factor: float = 1) -> Column:
    """Rounded value in another unit; negative readings are missing."""
    return F.when(value >= 0, round_once(value * factor if factor != 1 else value, digits))


def seismic_risk_level(max_mag: Column, tsunamis: Column, events: Column) -> Column:
    return (
        F.when((max_mag >= 7) | (tsunamis > 0), "high")
        .when((max_mag >= 5) | (events > 10), "medium")
        .otherwise("low")
    )


def condition_summary(precip, snow, gust, visibility, temp, dominant) -> Column:
    """Most urgent condition of a region, else its dominant weather."""
    ordered = [
        (precip > 10, "Heavy precipitation"),
        (snow > 5, "Significant snowfall"),
        (gust >= 30, "High wind alert"),
        (visibility < 1000, "Low visibility"),
        (temp < -10, "Extreme cold"),
        (temp > 40, "Extreme heat"),
    ]
    out = F
    for condition, label in ordered:
        out = out.when(condition, label)
    return out.otherwise(dominant)


def risk_score(flights, mean_flights, max_mag, severity, visibility) -> Column:
    """0 to 100: traffic (25), quakes (35), wind (25) and visibility (15)."""
    traffic = F.least(F.lit(25.0), flights / F.nullif(mean_flights, F.lit(0.0)) * 12.5)
    quakes = bands(max_mag, MAGNITUDE_RISK, 0, below=False)
    wind = choose(severity, WIND_RISK, 0)
    sight = bands(visibility, VISIBILITY_RISK, 0)
    return F.least(F.lit(100.0), traffic + quakes + wind + sight)


def quake_radius(mag: Column) -> Column:
    """Map radius in metres of a quake, at least 25 km."""
    return F.greatest(F.lit(25000).cast("bigint"), (F.pow(F.lit(10.0), mag * 0.59 - 2.44) * 1000 * 8).cast("bigint"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value))
