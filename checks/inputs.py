"""Staged and derived tables of the fixtures, as the queries use them."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.windows import whole_windows
from aerolith.plans import intermediate, staging
from aerolith.plans import windows as win
from checks import fixtures


def once(method):
    """Keep what a method returned per argument; lazy DataFrames can be shared."""

    @wraps(method)
    def kept(self, *args, **named):
        key = (method.__name__, *args, *sorted(named.items()))
        if key not in self._kept:
            self._kept[key] = method(self, *args, **named)
        return self._kept[key]

    return kept


class Tables:
    """Lazily built inputs of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._kept: dict = {}

    @once
    def raw(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @once
    def fx(self, name: str) -> DataFrame:
        name = f"fx_{name}"
        return fixtures.shape(self.raw(fixtures.base_table(name)), name)

    @property
    def as_of(self) -> Column:
        return self.newest()

    @once
    def newest(self) -> Column:
        """The newest event time, fixed as a literal, so that filters on it reach the scans."""
        value = self.raw("events").agg(F.max("ts").cast("string")).first()[0]
        return F.lit(value).cast("timestamp")

    @once
    def staged(self, name: str) -> DataFrame:
        if name == "routes":
            out = staging.stg_routes(self.fx("routes"), self.staged("airlines"), self.staged("airports"))
        else:
            out = getattr(staging, f"stg_{name}")(self.fx(name))
        return out.drop("_loaded_at")

    @once
    def airport_grid(self) -> DataFrame:
        return intermediate.int_airport_grid(self.staged("airports"))

    @once
    def enriched(self) -> DataFrame:
        return intermediate.int_flights_enriched(
            self.staged("flights"), self.staged("airlines"), self.airport_grid()
        ).drop("_loaded_at")

    @once
    def flight_windows(self, size: str = win.WINDOW, span: str | None = None, newest: bool = True) -> DataFrame:
        """All windows; with a span those of it, and the newest one unless told otherwise."""
        flights = self.fx("flights")
        if span is not None:
            flights = whole_windows(flights, "time_position", size, span, self.as_of, newest)
        return win.flight_tumbling(flights, "time_position", size)

    @once
    def seismic_windows(self, size: str = win.WINDOW, span: str | None = None) -> DataFrame:
        quakes = self.fx("seismics")
        if span is not None:
            quakes = whole_windows(quakes, "event_time", size, span, self.as_of, newest=False)
        return win.seismic_tumbling(quakes, "event_time", size)

    @once
    def weather_windows(self, size: str = win.WINDOW) -> DataFrame:
        return win.weather_tumbling(self.fx("weather_stream"), "snapshot_ts", size)

    def context(self, size: str = "6 hours", incremental: bool = False) -> DataFrame:
        return win.flight_context(
            self.fx("flights"), self.fx("seismics"), self.fx("weather_stream"),
            "time_position", "event_time", "snapshot_ts", size, incremental=incremental,
        )

    def newest_context(self, size: str = "6 hours") -> DataFrame:
        """The context of the flights' newest window, from the rows of that time only."""
        lead = (self.fx("flights"), "time_position")
        timed = {"flights": "time_position", "seismics": "event_time", "weather_stream": "snapshot_ts"}
        sides = [whole_windows(self.fx(name), ts, size, lead=lead) for name, ts in timed.items()]
        return win.flight_context(*sides, *timed.values(), size)


def tables(fn):
    """Let a query take its inputs as a :class:`Tables`."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run
