"""Candles from ticks, and the newest version of every bar."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.clock import shifted, utc_day
from tickloom.schemas import ARRIVAL, KEY_COLUMNS

# Decimal places for a second number next to the first in one decimal.
_SECOND_PLACES = 19


def position(df: DataFrame, order: tuple[str, ...]) -> Column:
    """The order columns of a row as one number that sorts as they do.

    A single number keeps aggregates over it in hash tables; a struct would make
    them sort. One column may be of any fixed-width type. Of two, the first is a
    timestamp or a whole number of up to 18 digits, the second a whole number.
    Pack more into a DECIMAL(38, 0) column of your own.
    """
    if len(order) == 1:
        return F.col(order[0])
    if len(order) != 2:
        raise ValueError("order by one column or two")
    first, second = order
    major = F.unix_micros(first) if isinstance(df.schema[first].dataType, T.TimestampType) else F.col(first)
    return (shifted(major, _SECOND_PLACES) + F.col(second).cast("decimal(20,0)")).cast(ARRIVAL)


def _bar_start(ts: Column, width_seconds: int) -> Column:
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return seconds - F.pmod(seconds, F.lit(width_seconds).cast("bigint"))


def candle_aggregates(at: Column) -> list[Column]:
    """First, highest, lowest and last price and the traded size of a group of ticks, in order of ``at``."""
    return [
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.sum("size").cast("double").alias("volume"),
    ]


def build_candles(ticks: DataFrame, width_seconds: int, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """``symbol, ts, price, size`` ticks to one bar per symbol and ``width_seconds``.

    ``order`` decides first and last; name a tie-breaker after ``ts`` when two
    ticks of a symbol can share an instant. Every aggregate combines on the map
    side, so a symbol that owns much of the data sends one row per bar and map
    task, not its ticks.
    """
    return (
        ticks.where(F.col("symbol").isNotNull() & F.col("ts").isNotNull())
        .groupBy("symbol", _bar_start(F.col("ts"), width_seconds).alias("time"))
        .agg(*candle_aggregates(position(ticks, order)))
        .select("symbol", utc_day(F.col("time")).alias("day"), "time",
                "open", "high", "low", "close", "volume")
    )


def dedup_latest(rows: DataFrame, order: tuple[str, ...], keys: tuple[str, ...] = tuple(KEY_COLUMNS)) -> DataFrame:
    """One row per key: the one latest by ``order`` (arrival position).

    An aggregate rather than a ranking, so copies of a key collapse before the
    shuffle however many there are. Every column is taken from the latest row by
    itself, which stays a hash aggregate while they are of fixed width; copies
    that share their position must be equal.
    """
    kept = [c for c in rows.columns if c not in keys]
    at = position(rows, order)
    return rows.groupBy(*keys).agg(*[F.max_by(c, at).alias(c) for c in kept]).select(*rows.columns)


def with_final_flag(bars: DataFrame, width_seconds: int, newest_event_seconds: Column) -> DataFrame:
    """Mark bars whose interval has ended by the newest event seen."""
    return bars.withColumn("is_final", F.col("time") + width_seconds <= newest_event_seconds)
