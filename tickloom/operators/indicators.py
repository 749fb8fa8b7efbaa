"""Moving averages, Bollinger bands, MACD, RSI and on-balance volume.

All averages are simple ones over rows, and the first rows of a series average
what there is. Input: bars with one row per (symbol, time).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.extended import extended_families
from tickloom.operators.pivots import pivot_levels, with_pivots
from tickloom.operators.rolling import Family, Series, rolling_means, run_families
from tickloom.operators.sar import RUN_SPANS, with_sar
from tickloom.operators.spans import Spans, over_spans, span_facts
from tickloom.schemas import CORE_INDICATORS, EXTENDED_INDICATORS

# Window sizes in rows.
MA_SIZES = (5, 10, 20, 50, 100, 200)
BOLLINGER_SIZE = 20
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
RSI_SIZE = 14

# Rows before the current one that the longest formula looks at.
REACH = max(MA_SIZES) - 1


def averages(series: Series) -> Family:
    """Moving averages and MACD, both built on means of close."""

    def name(n: int) -> str:
        return f"ma{n}" if n in MA_SIZES else f"_ma{n}"

    steps = rolling_means("close", sorted({*MA_SIZES, MACD_FAST, MACD_SLOW}), series, name)
    # The signal line averages MACD lines, so it needs them as a column first.
    steps[3] = steps[3] | {"macd_line": f"{name(MACD_FAST)} - {name(MACD_SLOW)}"}
    steps[4] = steps[4] | {"macd_signal": f"avg(macd_line) {series.last(MACD_SIGNAL)}"}
    steps[5] = steps[5] | {"macd_histogram": "macd_line - macd_signal"}
    return steps


def bollinger(series: Series) -> Family:
    """Bands two sample deviations around the 20-row mean."""
    middle = f"ma{BOLLINGER_SIZE}"
    return [
        {"_spread": f"stddev_samp(close) {series.last(BOLLINGER_SIZE)}"},
        {}, {}, {}, {},  # the mean is there after place 3
        {"bb_upper": f"{middle} + 2 * _spread", "bb_middle": middle,
         "bb_lower": f"{middle} - 2 * _spread"},
    ]


def rsi(series: Series) -> Family:
    near = series.last(RSI_SIZE)
    return [
        {"_last_price": series.lag("close")},
        # The first row has no move and counts as no gain and no loss.
        {"_gain": "CASE WHEN close > _last_price THEN close - _last_price ELSE 0D END",
         "_loss": "CASE WHEN close < _last_price THEN _last_price - close ELSE 0D END"},
        {"_mean_gain": f"avg(_gain) {near}", "_mean_loss": f"avg(_loss) {near}"},
        {"rsi14": "CASE WHEN _mean_loss = 0 THEN 100D ELSE 100 - 100 / (1 + _mean_gain / _mean_loss) END"},
    ]


def signed_volume(close: str, previous: str, volume: str) -> str:
    """Volume, counted up on a rise, down on a fall, and not at all otherwise."""
    return f"CASE WHEN {close} > {previous} THEN {volume} WHEN {close} < {previous} THEN -{volume} ELSE 0D END"


def flow(series: Series, seeded: bool = False) -> Family:
    """Running signed volume since the group's first row, as ``obv``.

    ``seeded`` rows bring their own flow in ``_seed``: rows whose OBV is known
    already pass it on to the rows after them.
    """
    signed = signed_volume("close", "_previous", "volume")
    return [
        {"_previous": series.lag("close")},
        {"_flow": f"coalesce(_seed, {signed})" if seeded else signed},
        {"obv": f"sum(_flow) {series.so_far}"},
    ]


def flow_facts(bars: DataFrame, spans: Spans, seeded: bool = False) -> DataFrame:
    """Span facts with ``_before``: what to add to a span's own running flow.

    It holds the flow of all earlier spans and the move from the previous span's
    last close to this span's first one.
    """
    seed = F.col("_seed") if seeded else F.lit(None).cast("double").alias("_seed")
    narrow = bars.select("symbol", "time", "close", "volume", seed)
    piece = Series(("symbol", "_span"))
    facts = span_facts(narrow, REACH, spans, [flow(piece, seeded)], [
        F.min_by("close", "time").alias("first_close"),
        F.min_by("volume", "time").alias("first_volume"),
        F.min_by("_seed", "time").alias("first_seed"),
        F.max_by("close", "time").alias("last_close"),
        F.max_by("obv", "time").alias("own"),
    ])
    by_span = "OVER (PARTITION BY symbol ORDER BY _span"
    step = signed_volume("first_close", "previous_close", "first_volume")
    return (
        facts.selectExpr("*", f"lag(last_close) {by_span}) AS previous_close")
        # A seed stands for all flow up to its row. NULL volumes add nothing.
        .selectExpr("*", f"CASE WHEN first_seed IS NULL THEN coalesce({step}, 0D) ELSE 0D END AS step")
        .selectExpr(
            "symbol", "_span", "_first", "_last", "_head_to", "_tail_from",
            f"""coalesce(sum(coalesce(own, 0D) + step)
                {by_span} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) + step AS _before""",
        )
    )


def bounded_families(series: Series) -> list[Family]:
    """Every core indicator that looks a bounded number of rows back."""
    return [averages(series), bollinger(series), rsi(series)]


def in_groups(bars: DataFrame, families, *group: str, seeded: bool = False) -> DataFrame:
    """``families`` and OBV over groups that are known to be small."""
    series = Series(group)
    return run_families(bars, [*families(series), flow(series, seeded)])


def in_series(
    bars: DataFrame, families, spans: Spans, facts: DataFrame, seeded: bool = False, work: str | None = None
) -> DataFrame:
    """``families`` and OBV over each symbol's series, however long; ``facts``
    are the ``flow_facts``."""
    return (
        over_spans(bars, families, REACH, spans, facts=facts,
                   per_span=lambda piece: [flow(piece, seeded)], work=work)
        .withColumn("obv", F.col("obv") + F.col("_before"))
        .drop("_before")
    )


def with_indicators(
    bars: DataFrame, reset: str = "none", spans: Spans = Spans(), extended: bool = False
) -> DataFrame:
    """Add the core indicators to ``bars``, and with ``extended`` all others too.

    ``reset="none"`` treats a symbol's bars as one series, ``reset="day"``
    starts every (symbol, day) afresh. Bars without a symbol are left out.
    ``bars`` is read more than once, so it should be a table rather than a
    long computation.
    """
    columns = bars.columns
    bars = bars.where(F.col("symbol").isNotNull())
    rows = bars
    if extended:
        # Joined to the bars first; the windows below then carry them along.
        rows = with_pivots(with_sar(bars, reset, spans.longer(RUN_SPANS)), pivot_levels(bars))

    def families(series: Series) -> list[Family]:
        return bounded_families(series) + (extended_families(series) if extended else [])

    if reset == "day":
        out = in_groups(rows, families, "symbol", "day")
    elif reset == "none":
        # The facts need nothing of what was added, so they come from the bars.
        out = in_series(rows, families, spans, flow_facts(bars, spans))
    else:
        raise ValueError(f"reset must be 'none' or 'day', not {reset!r}")
    return out.select(*columns, *CORE_INDICATORS, *(EXTENDED_INDICATORS if extended else []))
