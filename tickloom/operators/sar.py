"""Parabolic SAR, the one indicator whose every row depends on all rows before.

A series is cut into the spans of ``operators.spans`` and each span is walked in
one task, so the walk of a span needs the state at the end of the span before.
All spans are first walked at once from a fresh state. Then every span is walked
again from its predecessor's end state, and again for as long as an end state
changes. A trend flip forgets all but the last extreme price, so a walk that
meets a flip usually ends in the same state wherever it began, and the second
round is the last; a trend without a flip takes one round for each span that it
lasts. The result is that of one walk over the whole series.

Only times, highs and lows go to Python. A walk needs so little of a row that its
spans may be longer than those of the windows: see ``RUN_SPANS``.
"""

import sys
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.spans import Spans, with_neighbours
from tickloom.session import delete_path, scratch_path, settle

# Tasks get the functions below with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The acceleration's start and step, and its limit.
ACCELERATION, LIMIT = 0.02, 0.20

# So many spans of the windows are walked by one task: some 700,000 rows of
# five numbers, and a trend that lasts long takes so many times fewer rounds.
RUN_SPANS = 16


class State(NamedTuple):
    """Where a walk stands after a row; highs and lows are of the last two rows."""

    up: bool
    sar: float
    extreme: float
    acceleration: float
    high1: float
    high2: float
    low1: float
    low2: float


STATE_FIELDS = ", ".join(
    f"{name} {'boolean' if name == 'up' else 'double'}" for name in State._fields
)
ENDS = f"symbol string, _span bigint, {STATE_FIELDS}"

DAY_SECONDS = 86_400
# The state after a row as columns: before a series, and at the last row of a day.
FROM_STATE, AT_STATE = ([f"{prefix}_{name}" for name in State._fields] for prefix in ("from", "at"))


def next_state(s: State | None, high: float, low: float) -> State:
    """The state after a row, from the state before it (None: the first row)."""
    if s is None:
        return State(True, low, high, ACCELERATION, high, high, low, low)
    moved = s.sar + s.acceleration * (s.extreme - s.sar)
    if s.up:
        sar = min(moved, s.low1, s.low2)
        flips, extends, extreme = low < sar, high > s.extreme, high
    else:
        sar = max(moved, s.high1, s.high2)
        flips, extends, extreme = high > sar, low < s.extreme, low
    rows = (high, s.high1, low, s.low1)
    if flips:
        return State(not s.up, s.extreme, low if s.up else high, ACCELERATION, *rows)
    if extends:
        return State(s.up, sar, extreme, min(s.acceleration + ACCELERATION, LIMIT), *rows)
    return State(s.up, sar, s.extreme, s.acceleration, *rows)


def walk(highs: list[float], lows: list[float], state: State | None) -> tuple[list[float | None], State | None]:
    """The value at each row of a span, None without a high or low, and the state at its end.

    The steps of ``next_state``, on plain numbers.
    """
    values: list[float | None] = []
    fresh = state is None
    up, sar, extreme, acceleration, high1, high2, low1, low2 = state or (True, *[0.0] * 7)
    for high, low in zip(highs, lows, strict=True):
        if high != high or low != low:  # NaN
            values.append(None)
            continue
        if fresh:
            fresh = False
            up, sar, extreme, acceleration, high1, low1 = True, low, high, ACCELERATION, high, low
        else:
            sar += acceleration * (extreme - sar)
            if up:
                sar = min(sar, low1, low2)
                flips, extends = low < sar, high > extreme
            else:
                sar = max(sar, high1, high2)
                flips, extends = high > sar, low < extreme
            if flips:
                sar, extreme, acceleration, up = extreme, low if up else high, ACCELERATION, not up
            elif extends:
                extreme, acceleration = high if up else low, min(acceleration + ACCELERATION, LIMIT)
        high1, high2, low1, low2 = high, high1, low, low1
        values.append(sar)
    return values, None if fresh else State(up, sar, extreme, acceleration, high1, high2, low1, low2)


def _walked(bars: pd.DataFrame, start: pd.DataFrame) -> tuple[pd.DataFrame, list[float | None], State | None]:
    bars = bars.sort_values("time")
    state = State(*start[list(State._fields)].iloc[0]) if len(start) else None
    return bars, *walk(bars["high"].tolist(), bars["low"].tolist(), state)


def _end_of_span(key: tuple, bars: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
    _, _, state = _walked(bars, start)
    # Nothing to walk: the state before the span, if any, still holds.
    return pd.DataFrame([] if state is None else [(*key, *state)], columns=["symbol", "_span", *State._fields])


def walk_days(times: list[int], highs: list[float], lows: list[float], state: State | None
              ) -> tuple[list[float | None], list[State | None]]:
    """``walk`` over rows in order of time, with the state after each day's last row, None at other rows."""
    values: list[float | None] = []
    states: list[State | None] = []
    start = 0
    while start < len(times):
        day, end = times[start] // DAY_SECONDS, start
        while end < len(times) and times[end] // DAY_SECONDS == day:
            end += 1
        found, state = walk(highs[start:end], lows[start:end], state)
        values += found
        states += [None] * (end - start - 1) + [state]
        start = end
    return values, states


def _values_of_span(key: tuple, bars: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
    bars = bars.sort_values("time")
    state = State(*start[list(State._fields)].iloc[0]) if len(start) else None
    values, states = walk_days(bars["time"].tolist(), bars["high"].tolist(), bars["low"].tolist(), state)
    at = pd.DataFrame([s or (None,) * len(State._fields) for s in states], columns=AT_STATE, index=bars.index, dtype=object)
    return pd.concat([bars[["symbol", "_span", "time"]].assign(parabolic_sar=values), at], axis=1)


def _per_span(bars: DataFrame, starts: DataFrame, step, schema) -> DataFrame:
    keys = ["symbol", "_span"]
    return bars.groupBy(*keys).cogroup(starts.groupBy(*keys)).applyInPandas(step, schema)


def _starts(ends: DataFrame, facts: DataFrame) -> DataFrame:
    """Every later span with the end state of the span before it."""
    followers = facts.select("symbol", F.col("_before_span").alias("_span"), F.col("_span").alias("_next"))
    return ends.join(followers, ["symbol", "_span"]).select(
        "symbol", F.col("_next").alias("_span"), *State._fields
    )


def _settled_starts(bars: DataFrame, begins: DataFrame | None) -> DataFrame:
    """The state each span begins with; a symbol's first one with that of ``begins``, if any."""
    spark = bars.sparkSession
    work = scratch_path(spark, "sar")
    keys = ["symbol", "_span"]
    by_span = Window.partitionBy("symbol").orderBy("_span")
    facts = with_neighbours(bars.select(*keys).distinct())
    facts = settle(facts.withColumn("_before_span", F.lag("_span").over(by_span)), "spans", work)
    # End states are needed of spans that have a successor only.
    leading = facts.where(~F.col("_last")).select(*keys)
    series = bars.join(leading, keys, "left_semi")
    same = reduce(
        lambda a, b: a & b, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, *State._fields))
    )
    starts = ends = first = spark.createDataFrame([], ENDS)
    if begins is not None:
        own = begins.select("symbol", *[F.col(a).alias(b) for a, b in zip(FROM_STATE, State._fields, strict=True)])
        starts = first = settle(
            facts.where("_first").select(*keys).join(own.where("up IS NOT NULL"), "symbol").select(*keys, *State._fields),
            "first-starts", work)
    todo = leading
    while not todo.isEmpty():
        begun = series.join(todo, keys, "left_semi")
        fresh = _per_span(begun, starts.join(todo, keys, "left_semi"), _end_of_span, ENDS)
        ends = settle(ends.join(todo, keys, "left_anti").unionByName(fresh), "ends", work)
        last_starts, starts = starts, settle(_starts(ends, facts).unionByName(first), "starts", work)
        changed = starts.alias("a").join(last_starts.alias("b"), same, "left_anti").select(*keys)
        todo = settle(changed.join(leading, keys, "left_semi"), "todo", work)
    # One row per span is left; the tables of the rounds are not needed any more.
    starts = settle(starts, "sar-starts")
    delete_path(spark, work)
    return starts


def with_sar(bars: DataFrame, reset: str = "none", spans: Spans = Spans(), begins: DataFrame | None = None,
             states: bool = False) -> DataFrame:
    """Add ``parabolic_sar``; ``reset`` as for ``with_indicators``. One row per (symbol, time).

    ``begins`` (``symbol`` and the columns ``FROM_STATE``) has the states that
    symbols' series go on from. With ``states`` the columns ``AT_STATE`` hold the
    state at the last row of every day, and sometimes of rows before it.
    """
    columns = bars.columns
    bars = bars.where(F.col("symbol").isNotNull())
    if reset == "day":
        cut = bars.withColumn("_span", F.unix_date("day").cast("bigint"))
        starts = bars.sparkSession.createDataFrame([], ENDS)
    elif reset == "none":
        cut = bars.withColumn("_span", spans.start())
        starts = _settled_starts(cut.select("symbol", "_span", "time", "high", "low"), begins)
    else:
        raise ValueError(f"reset must be 'none' or 'day', not {reset!r}")
    keys = ["symbol", "_span", "time"]
    at = ", ".join(f"{name} {'boolean' if name == 'at_up' else 'double'}" for name in AT_STATE)
    values = _per_span(cut.select(*keys, "high", "low"), starts, _values_of_span,
                       f"symbol string, _span bigint, time bigint, parabolic_sar double, {at}")
    return cut.join(values, keys, "left").select(*columns, "parabolic_sar", *(AT_STATE if states else []))
