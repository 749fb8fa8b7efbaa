"""Time conversions between message text, epoch numbers, days and clock text.

All of them are UTC by arithmetic on epoch numbers, so the session's time zone
changes nothing.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


# The years 1 to 9999 in epoch milliseconds; numbers beyond them are no message times.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999
DAY_SECONDS = 86_400
# A text that ends in its offset from UTC, and one that is a day only.
_OFFSET = r"([Zz]|[+-]\d{2}(:?\d{2})?)$"
_DAY_TEXT = r"^\d{1,4}-\d{1,2}-\d{1,2}$"


def timestamp_of(epoch_ms: Column) -> Column:
    """Timestamp of an epoch number, NULL where it is out of range."""
    return F.when(epoch_ms.between(FIRST_MS, LAST_MS), F.timestamp_millis(epoch_ms))


def iso_utc(epoch_ms: Column) -> Column:
    """Epoch milliseconds as ISO-8601 text with a ``Z`` suffix.

    A fraction appears only when there is one, with six digits.
    """
    seconds = F.floor(epoch_ms / 1000)
    millis = F.pmod(epoch_ms, F.lit(1000).cast("bigint"))
    whole = F.concat(utc_day(seconds).cast("string"), F.lit("T"), clock_text(seconds))
    fraction = F.concat(F.lit("."), F.lpad(millis.cast("string"), 3, "0"), F.lit("000"))
    text = F.concat(whole, F.when(millis == 0, "").otherwise(fraction), F.lit("Z"))
    return F.when(epoch_ms.between(FIRST_MS, LAST_MS), text)


def message_time(text: Column, epoch_ms: Column) -> Column:
    """Message time: the ISO text, or the epoch number where the text is unreadable.

    A text without an offset is taken as UTC.
    """
    zoned = (
        F.when(text.rlike(_DAY_TEXT), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(_OFFSET), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.coalesce(F.try_to_timestamp(zoned), timestamp_of(epoch_ms))


def shifted(number: Column, places: int) -> Column:
    """A whole number with ``places`` decimal zeros behind it, as a decimal of up to 38 digits."""
    return number.cast("decimal(38,0)") * F.lit("1" + "0" * places).cast(f"decimal({places + 1},0)")


def utc_day(seconds: Column) -> Column:
    """The day of an epoch second."""
    return F.date_from_unix_date(F.floor(seconds / DAY_SECONDS).cast("int"))


def instant(local: Column) -> Column:
    """The instant of a timestamp without zone, which is taken as UTC."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), local))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def clock_text(seconds: Column) -> Column:
    """Time of day as ``HH:mm:ss``."""
    second = F.pmod(seconds, F.lit(DAY_SECONDS).cast("bigint"))
    parts = (F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
    return F.concat_ws(":", *[F.lpad(part.cast("string"), 2, "0") for part in parts])
