"""Indicators for a batch of bars, given the bars stored before it."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.indicators import REACH, bounded_families, flow_facts, in_series
from tickloom.operators.spans import Spans
from tickloom.schemas import ARRIVAL, BAR_COLUMNS, CORE_INDICATORS, KEY_COLUMNS

# Rows of history that every indicator but OBV is complete with.
HISTORY_ROWS = REACH + 1


def newest(bars: DataFrame, n: int, by: Iterable[str] = ("symbol",)) -> DataFrame:
    """The newest ``n`` bars of every group.

    First within days, then over what is left: the second step sees at most
    ``n`` rows per group and day however many bars a group has.
    """
    by = list(by)
    for group in ([*by, "day"], by):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("time").desc()))
        bars = bars.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return bars


def newest_row(bars: DataFrame) -> DataFrame:
    """The newest bar of every symbol, as one aggregate over its time."""
    rest = [c for c in bars.columns if c != "symbol"]
    return bars.groupBy("symbol").agg(*[F.max_by(c, "time").alias(c) for c in rest]).select(*bars.columns)


def batch_range(batch: DataFrame) -> DataFrame:
    """Per symbol, the first and last bar of a batch."""
    return batch.where(F.col("symbol").isNotNull()).groupBy("symbol").agg(
        F.min("time").alias("_from"), F.min("day").alias("_from_day"),
        F.max("time").alias("_to"), F.max("day").alias("_to_day"),
    )


def keep_batch(enriched: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``enriched`` whose key is in ``batch``; copies there do not multiply them."""
    return enriched.join(batch.select(*KEY_COLUMNS), KEY_COLUMNS, "left_semi")


def history_before(stored: DataFrame, ranges: DataFrame, n: int = HISTORY_ROWS) -> DataFrame:
    """The newest ``n`` stored bars of every symbol before its batch begins."""
    earlier = stored.join(ranges.select("symbol", "_from"), "symbol").where(F.col("time") < F.col("_from"))
    return newest(earlier.drop("_from"), n)


def bars_between(stored: DataFrame, batch: DataFrame, ranges: DataFrame, to_end: bool) -> DataFrame:
    """Stored bars among or (``to_end``) after those of the batch, which replace their copies."""
    span = ranges.select("symbol", "_from", "_to")
    among = F.col("time") >= F.col("_from")
    if not to_end:
        among = among & (F.col("time") <= F.col("_to"))
    return (
        stored.join(span, "symbol").where(among).drop("_from", "_to")
        .join(batch.select(*KEY_COLUMNS), KEY_COLUMNS, "left_anti")
    )


def _seeds() -> Column:
    """History passes its OBV on at its newest row and adds nothing before."""
    newest_first = Window.partitionBy("symbol").orderBy(F.col("time").desc())
    return F.when(F.row_number().over(newest_first) == 1, F.coalesce("obv", F.lit(0.0))).otherwise(0.0)


def enrich(
    batch: DataFrame,
    history: DataFrame,
    between: DataFrame,
    recompute: bool = False,
    spans: Spans = Spans(),
    work: str | None = None,
) -> DataFrame:
    """Core indicators for the bars of ``batch``.

    ``history`` are stored rows before the batch with their ``obv``, ``between``
    stored bars among it. With ``recompute`` the rows of ``between`` are
    returned too, with the values the batch's bars give them. ``work`` is a
    folder for tables. ``arrival`` is carried along where rows have it.
    """
    unseeded = F.lit(None).cast("double").alias("_seed")

    def arrival(rows: DataFrame) -> Column:
        return (F.col("arrival") if "arrival" in rows.columns else F.lit(None)).cast(ARRIVAL).alias("arrival")

    series = (
        history.select(*BAR_COLUMNS, arrival(history), _seeds().alias("_seed"), F.lit(False).alias("_wanted"))
        .unionByName(between.select(*BAR_COLUMNS, arrival(between), unseeded, F.lit(recompute).alias("_wanted")))
        # The marker does the work of a join back to the batch's keys.
        .unionByName(batch.select(*BAR_COLUMNS, arrival(batch), unseeded, F.lit(True).alias("_wanted")))
        .where(F.col("symbol").isNotNull())
    )
    facts = flow_facts(series, spans, seeded=True)
    out = in_series(series, bounded_families, spans, facts, seeded=True, work=work).where("_wanted")
    carried = ["arrival"] if "arrival" in batch.columns else []
    return out.select(*BAR_COLUMNS, *CORE_INDICATORS, *carried)
