"""Arithmetic on columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, decimals: int) -> Column:
    """``round(value, decimals)`` of a double, which Spark makes through a decimal text.

    Where the scaled value is clearly no tie, the nearest whole number divided by
    the power of ten is the same double, at a tenth of the time; the rest, with
    NaN, infinite and very large values, goes through ``round``.
    """
    scale = F.lit(10.0**decimals)
    scaled = value * scale
    whole = F.rint(scaled)
    # The margin covers the errors of the product and of the shortest text of the value.
    clear = F.abs(scaled - whole) + F.abs(scaled) * 1e-15 < 0.499
    # Adding zero takes the sign from a zero, as a decimal has none.
    return F.when(clear, whole / scale + 0.0).otherwise(F.round(value, decimals))
