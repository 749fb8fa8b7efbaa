"""The 39-column row of the enriched table, as consumers of it expect it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import clock_text
from tickloom.schemas import CORE_INDICATORS, EXTENDED_INDICATORS, INDICATOR_COLUMNS


def full_rows(enriched: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """All 39 columns in order, at full precision, and those of ``carry``; indicators not computed are NULL."""
    return enriched.select(*[
        F.col(c) if c in enriched.columns else F.lit(None).cast("double").alias(c)
        for c in INDICATOR_COLUMNS
    ], *carry)


def compat_rows(enriched: DataFrame) -> DataFrame:
    """The contract row: 4-byte floats, whole volumes, later indicators NULL.

    A volume that is no whole number is cut off, and NaN becomes NULL.
    """
    narrow = {c: F.col(c).cast("float") for c in ("open", "high", "low", "close", *CORE_INDICATORS)}
    narrow |= {c: F.lit(None).cast("float") for c in EXTENDED_INDICATORS}
    narrow["volume"] = F.col("volume").try_cast("bigint")
    return enriched.select(*[narrow.get(c, F.col(c)).alias(c) for c in INDICATOR_COLUMNS])


def display_rows(bars: DataFrame) -> DataFrame:
    """Bars with their time as a timestamp ``bar_ts`` and as ``HH:mm:ss`` text ``clock``."""
    return bars.withColumns({
        "bar_ts": F.timestamp_seconds("time"),
        "clock": clock_text(F.col("time")),
    })
