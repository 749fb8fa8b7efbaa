"""Typed fields out of positional kline arrays."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import iso_utc

# 1-based positions in the array.
KLINE_POSITIONS = {"epoch_ms": 1, "open": 2, "high": 3, "low": 4, "close": 5, "volume": 6}


def _field(kline: Column, name: str, dtype: str) -> Column:
    return F.try_element_at(kline, F.lit(KLINE_POSITIONS[name])).try_cast(dtype)


def decode_klines(df: DataFrame, interval: str = "1m") -> DataFrame:
    """``symbol, kline ARRAY<STRING>`` to candle messages.

    Short arrays and unreadable numbers give NULL fields; the row stays.
    """
    kline = F.col("kline")
    epoch_ms = _field(kline, "epoch_ms", "bigint")
    return df.select(
        "symbol",
        F.lit(interval).alias("interval"),
        iso_utc(epoch_ms).alias("datetime"),
        epoch_ms.alias("epoch_ms"),
        *[_field(kline, name, "double").alias(name)
          for name in ("open", "high", "low", "close", "volume")],
    )
