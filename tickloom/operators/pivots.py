"""Pivot, support and resistance levels from the previous day that has bars."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def level_columns(h: Column, low: Column, c: Column) -> list[Column]:
    """The levels that a day's highest, lowest and last price give for the next day."""
    p = (h + low + c) / 3
    return [
        p.alias("pivot"),
        (2 * p - h).alias("support1"),
        (p - (h - low)).alias("support2"),
        (low - 2 * (h - p)).alias("support3"),
        (2 * p - low).alias("resistance1"),
        (p + (h - low)).alias("resistance2"),
        (h + 2 * (p - low)).alias("resistance3"),
    ]


def pivot_levels(bars: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One row per (symbol, day) with the levels that hold on that day.

    ``before`` has the highest, lowest and last price (``from_high, from_low,
    from_close``) of the day before a symbol's first one, where there is one.
    """
    days = bars.groupBy("symbol", "day").agg(
        F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "time").alias("close")
    )
    # One row per day here, so a symbol's whole calendar is a small window.
    by_day = Window.partitionBy("symbol").orderBy("day")
    last = {x: F.lag(x).over(by_day) for x in ("high", "low", "close")}
    if before is not None:
        days = days.join(before.select("symbol", *[f"from_{x}" for x in last]), "symbol", "left")
        first = F.lag("day").over(by_day).isNull()
        last = {x: F.when(first, F.col(f"from_{x}")).otherwise(value) for x, value in last.items()}
    days = days.select("symbol", "day", *[value.alias(x) for x, value in last.items()])
    return days.select("symbol", "day", *level_columns(F.col("high"), F.col("low"), F.col("close")))


def with_pivots(bars: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Add the levels of its day to every bar; ``levels`` are those of the bars
    unless given.

    Levels are fewer than bars, and a task's share of them is hashed in memory;
    a day's bars of one symbol are the largest group.
    """
    levels = pivot_levels(bars) if levels is None else levels
    return bars.join(levels.hint("shuffle_hash"), ["symbol", "day"], "left")
