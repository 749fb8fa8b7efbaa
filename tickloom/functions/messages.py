"""Candle messages: JSON text on the wire, bars in tables."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import epoch_seconds, iso_utc, message_time, utc_day
from tickloom.schemas import MESSAGE_SCHEMA, PRICE_COLUMNS


# A bar from before or after these epoch seconds (2000 and 2100) is taken for a mistake.
PLAUSIBLE = (946_684_800, 4_102_444_800)
NEEDED_PRICES = PRICE_COLUMNS[:4]


def encode_messages(bars: DataFrame, interval: str = "1m") -> DataFrame:
    """Bars to ``key, value``: one JSON message per bar, keyed by symbol.

    The key sends all messages of a symbol to one topic partition, in order.
    """
    epoch_ms = F.col("time") * 1000
    body = F.struct(
        "symbol",
        F.lit(interval).alias("interval"),
        iso_utc(epoch_ms).alias("datetime"),
        epoch_ms.alias("epoch_ms"),
        *PRICE_COLUMNS,
    )
    return bars.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))


def _carried(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("key", "value")]


def _read(df: DataFrame) -> DataFrame:
    """Unpack ``value`` next to the other columns (arrival order and the like).

    The fields come out of a generator, which filters on them stay above of:
    as plain columns, each condition would parse the text once more.
    """
    text = F.col("value").cast("string")
    fields = F.inline(F.array(F.from_json(text, MESSAGE_SCHEMA)))
    return (
        df.select(*_carried(df), text.alias("_text"), fields)
        .withColumn("_time", epoch_seconds(message_time(F.col("datetime"), F.col("epoch_ms"))))
    )


def _reason(plausible: tuple[int, int]) -> Column:
    """Why a message is no bar; NULL where it is one."""
    no_symbol, no_time = F.col("symbol").isNull(), F.col("_time").isNull()
    no_price = reduce(or_, (F.col(c).isNull() | F.isnan(c) for c in NEEDED_PRICES))
    return (
        F.when(no_symbol & no_time, "no symbol, no time")
        .when(no_symbol, "no symbol")
        .when(no_time, "no time")
        .when(~F.col("_time").between(*plausible), "implausible time")
        .when(no_price, "no price")
    )


def parse_messages(df: DataFrame, plausible: tuple[int, int] = PLAUSIBLE) -> DataFrame:
    """``value`` messages to bars; rows that ``quarantine`` takes are left out.

    Columns other than ``key`` and ``value`` are carried along; they must not be
    named like a message field.
    """
    return (
        _read(df)
        .where(_reason(plausible).isNull())
        .select(
            "symbol",
            utc_day(F.col("_time")).alias("day"),
            F.col("_time").alias("time"),
            *PRICE_COLUMNS,
            *_carried(df),
        )
    )


def quarantine(df: DataFrame, plausible: tuple[int, int] = PLAUSIBLE) -> DataFrame:
    """The rows that are no bars, with the reason.

    A bar has a symbol, a time within ``plausible`` epoch seconds, and readable
    open, high, low and close prices: one without would overwrite a good bar.
    """
    return (
        _read(df).withColumn("_reason", _reason(plausible)).where(F.col("_reason").isNotNull())
        .select(F.col("_text").alias("value"), F.col("_reason").alias("reason"), *_carried(df))
    )


def quarantine_counts(rejected: DataFrame) -> DataFrame:
    """How many messages were left out, by reason."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))
