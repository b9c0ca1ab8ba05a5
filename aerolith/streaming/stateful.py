"""Streams with state of their own: high-water marks, reduces given by the caller, side state per key.

The state lives in RocksDB below the checkpoint and outlives executors. Rows of a
key arrive as Arrow batches; times travel as whole microseconds.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Processors travel to the executors with their code, a cluster needs no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def whole_number(df: DataFrame, column: str) -> Column:
    """A time or number column as a long that orders alike."""
    is_time = isinstance(df.schema[column].dataType, (T.TimestampType,))
    return F.unix_micros(column) if is_time else F.col(column).cast("long")


def whole_as_text(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Whole numbers as text: pandas would turn a column with NULLs into floats and lose digits."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
    casts = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, kinds) and f.name not in but}
    return df.withColumns(casts) if casts else df


def as_before(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns cast back to the types of a schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def filled(parts: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Parts that hold rows, under the columns' own names: Spark hands on others for some of them."""
    return (part.set_axis(names, axis=1) for part in parts if len(part))


# --- high-water mark ---------------------------------------------------------------------------


class HighWaterMark(StatefulProcessor):
    """Passes rows above the mark, one per time value, and moves the mark with them."""

    def __init__(self, names: list[str], columns: list[str], ties: list[str]):
        self.names, self.columns, self.ties = names, columns, ties

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = self.mark.get()[0] if self.mark.exists() else None
        best = None  # one row per time value is kept while the batches of the key pass
        for part in filled(rows, self.names):
            part = part if mark is None else part[part["_at"] > mark]
            best = part if best is None else pd.concat([best, part])
            best = best.sort_values(["_at", *self.ties], kind="stable").drop_duplicates("_at")
        if best is not None and len(best):
            self.mark.update((int(best["_at"].iloc[-1]),))
            yield best[self.columns]

    def close(self) -> None:
        pass


def above_mark(df: DataFrame, ts: str, ties: Sequence[str], feed: Sequence[str] = ()) -> DataFrame:
    """Rows of a stream whose time lies above all times passed before, one per time value and feed.

    Rows of one micro-batch are taken in order of time; of equal times the first by
    ``ties`` passes. A row at or below the mark is dropped, also after a restart.
    Each feed has a mark of its own and is read by one task, as its rows depend on each other.
    Rows without a time are dropped. ``feed`` columns are compared as given, NULL is a feed.
    """
    if df.isStreaming is False:
        raise ValueError("a batch is served by newer_than")
    sent = whole_as_text(df)
    order = [F.col(c).alias(f"_tie{k}") for k, c in enumerate(ties)]
    timed = df.select("*", *order, whole_number(df, ts).alias("_at"), F.lit(0).alias("_feed")).filter(F.col("_at").isNotNull())
    keyed = whole_as_text(timed, ["_at", "_feed", *[f"_tie{k}" for k in range(len(order))]])
    processor = HighWaterMark(keyed.columns, df.columns, [f"_tie{k}" for k in range(len(order))])
    passed = keyed.groupBy("_feed", *feed).transformWithStateInPandas(processor, sent.schema, "append", "none")
    return as_before(passed, df.schema)


# --- reduces given by the caller -----------------------------------------------------------------


@dataclass
class Reducer:
    """How the rows of a window are folded. ``initial`` starts from nothing, ``add`` takes a row as a dict,
    ``merge`` joins two partial results and ``result`` gives the values of the output columns.

    Rows come in no certain order: what depends on their order has to keep their times
    (``_at``, in microseconds). Missing numbers are NaN; whole numbers of a column that
    may be NULL come as floats.
    """

    initial: Callable[[], Any]
    add: Callable[[Any, dict], Any]
    merge: Callable[[Any, Any], Any]
    result: Callable[[Any], tuple]
    ddl: str

    def fold(self, part: pd.DataFrame, size: int) -> dict[int, Any]:
        """Partial results of a batch by window start."""
        partial: dict[int, Any] = {}
        for row in part.to_dict("records"):
            start = row["_at"] - row["_at"] % size
            if start not in partial:
                partial[start] = self.initial()
            partial[start] = self.add(partial[start], row)
        return partial


class WindowReduce(StatefulProcessor):
    """Folds rows into open windows and hands on a window when the watermark has passed its end."""

    def __init__(self, reducer: Reducer, size: int, rows: list[str], names: list[str]):
        self.reducer, self.size, self.rows, self.names = reducer, size, rows, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "folded binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in filled(rows, self.rows):
            for start, folded in self.reducer.fold(part, self.size).items():
                if self.windows.containsKey((start,)):
                    held = pickle.loads(bytes(self.windows.getValue((start,))[0]))
                    folded = self.reducer.merge(held, folded)
                else:
                    self.handle.registerTimer((start + self.size) // 1000)
                self.windows.updateValue((start,), (pickle.dumps(folded),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.size
        if not self.windows.containsKey((start,)):
            return iter(())
        folded = pickle.loads(bytes(self.windows.getValue((start,))[0]))
        self.windows.removeKey((start,))
        row = [*key, start, *self.reducer.result(folded)]
        return iter([pd.DataFrame([row], columns=self.names)])

    def close(self) -> None:
        pass


def reduce_windows(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], reducer: Reducer, watermark: str | None = None
) -> DataFrame:
    """``reducer`` per tumbling window and keys, with ``window_start`` and ``window_end``.

    A stream hands on a window once, when the watermark has passed its end; ``size`` is
    a whole number of milliseconds. A batch is folded in each partition first, so a hot key
    costs one partial result per task and window. Rows without a time are dropped.
    """
    step = microseconds(size)
    at = df.withColumn("_at", F.unix_micros(ts)).filter(F.col("_at").isNotNull())
    out = T.StructType([df.schema[k] for k in keys]).add("_start", "long")
    for field in T.StructType.fromDDL(reducer.ddl).fields:
        out = out.add(field)
    names = out.names
    if df.isStreaming:
        grouped = at.withWatermark(ts, watermark or "0 seconds").groupBy(*keys)
        made = grouped.transformWithStateInPandas(WindowReduce(reducer, step, at.columns, names), out, "append", "eventtime")
    else:
        partial = T.StructType([df.schema[k] for k in keys]).add("_start", "long").add("_folded", "binary")
        made = at.mapInPandas(partial_folds(reducer, step, list(keys)), partial)
        made = made.groupBy(*keys, "_start").applyInPandas(merged_folds(reducer, names), out)
    rest = [f.name for f in T.StructType.fromDDL(reducer.ddl).fields]
    return made.select(
        F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_start") + step).alias("window_end"),
        *keys,
        *rest,
    )


def partial_folds(reducer: Reducer, size: int, keys: list[str]):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            groups = part.groupby(keys, dropna=False, sort=False) if keys else [((), part)]
            for key, own in groups:
                key = [None if pd.isna(k) else k for k in (key if isinstance(key, tuple) else (key,))]
                rows += [[*key, start, pickle.dumps(f)] for start, f in reducer.fold(own, size).items()]
            yield pd.DataFrame(rows, columns=[*keys, "_start", "_folded"])

    return run


def merged_folds(reducer: Reducer, names: list[str]):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        folded = None
        for raw in part["_folded"]:
            more = pickle.loads(raw)
            folded = more if folded is None else reducer.merge(folded, more)
        return pd.DataFrame([[*key, *reducer.result(folded)]], columns=names)

    return run


def microseconds(size: str) -> int:
    return pd.Timedelta(size).value // 1000


# --- side state per key -----------------------------------------------------------------------------


class SideState(StatefulProcessor):
    """Keeps the newest row of each side per key; main rows take them along as they arrive."""

    def __init__(self, names: list[str], sides: dict[str, list[str]], ddls: dict[str, str], main: list[str], age: int):
        self.names, self.sides, self.ddls, self.main, self.age = names, sides, ddls, main, age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = {s: handle.getValueState(s, f"at long, {ddl}") for s, ddl in self.ddls.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(filled(rows, self.names))
        if not parts:
            return
        part = pd.concat(parts).sort_values(["_at", "_place", "_tie"], kind="stable")
        newest = {s: (state.get() if state.exists() else None) for s, state in self.state.items()}
        changed, out = set(), []
        for row in part.to_dict("records"):
            kind = row["_kind"]
            if kind in self.sides:
                if newest[kind] is None or newest[kind][0] <= row["_at"]:
                    newest[kind] = (row["_at"], *[plain(row[f"{kind}_{c}"]) for c in self.sides[kind]])
                    changed.add(kind)
                continue
            made = {c: row[c] for c in self.main}
            for side, columns in self.sides.items():
                held = newest[side]
                known = held is not None and held[0] <= row["_at"] <= held[0] + self.age
                for k, c in enumerate(columns):
                    made[f"{side}_{c}"] = held[k + 1] if known else None
            out.append(made)
        for side in changed:
            self.state[side].update(newest[side])
            self.handle.registerTimer((newest[side][0] + self.age) // 1000 + 1)
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget side rows that are too old for any row still to come."""
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        for state in self.state.values():
            if state.exists() and state.get()[0] + self.age < now:
                state.clear()
        return iter(())

    def close(self) -> None:
        pass


def plain(value):
    return None if pd.isna(value) else value.item() if hasattr(value, "item") else value


def with_newest_sides(
    main: DataFrame, ts: str, keys: Sequence[str], sides: dict[str, tuple[DataFrame, str, str]],
    max_age: str, watermark: str = "0 seconds",
) -> DataFrame:
    """Rows of a stream with the newest row of each side known for their keys at their time.

    ``sides`` maps a name to (stream, its time column, its tie column); a side's other
    columns, but for the keys, come out as name_column and are NULL where nothing is
    known or the newest is older than ``max_age``. Rows of a micro-batch meet in order
    of time, sides before main rows of the same time; of equal side rows the largest by
    the tie column counts. A side row that comes later than a main row does not change it.
    """
    columns = {s: [c for c in df.columns if c not in (*keys, at)] for s, (df, at, _) in sides.items()}
    result = T.StructType(list(main.schema.fields))
    for side, (df, _, _) in sides.items():
        for c in columns[side]:
            result = result.add(f"{side}_{c}", df.schema[c].dataType)
    texts = {s: whole_as_text(df.select(*columns[s])).schema for s, (df, _, _) in sides.items()}
    sent = whole_as_text(main, keys)
    tagged = sent.select(
        "*", F.unix_micros(ts).alias("_at"), F.col(ts).alias("_event_time"), F.lit("main").alias("_kind"),
        F.lit(1).alias("_place"), F.lit(0).cast("long").alias("_tie"),
    )
    for side, (df, at, tie) in sides.items():
        rows = df.select(
            *keys, *[F.col(c).cast(texts[side][c].dataType).alias(f"{side}_{c}") for c in columns[side]], F.unix_micros(at).alias("_at"),
            F.col(at).alias("_event_time"), F.lit(side).alias("_kind"), F.lit(0).alias("_place"),
            F.col(tie).cast("long").alias("_tie"),
        )
        tagged = tagged.unionByName(rows, allowMissingColumns=True)
    out = T.StructType(list(sent.schema.fields))
    for side, schema in texts.items():
        for f in schema:
            out = out.add(f"{side}_{f.name}", f.dataType)
    ddls = {s: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) for s, schema in texts.items()}
    processor = SideState(tagged.columns, columns, ddls, main.columns, microseconds(max_age))
    timed = tagged.filter(F.col("_at").isNotNull()).withWatermark("_event_time", watermark)
    met = timed.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "eventtime")
    return as_before(met, result)
