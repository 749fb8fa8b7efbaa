"""Which stored days a batch of bars needs, and its rows' indicators from just these.

Every indicator looks a bounded number of rows back, but for two that are carried
on: OBV goes on from the stored value of the row before, and the parabolic SAR
from the state after the last row of the day before, which the store keeps in a
record for every symbol and day, with the day's number of bars and its highest,
lowest and last price. So a batch needs the days it touches, as many before as
hold the look-back, and, where later rows are to be brought up to date, as many
after. Neighbouring days of a symbol make a *segment*, a stretch of its series
without gaps, and a segment is computed as a series of its own.
"""

import sys
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.extended import extended_families
from tickloom.operators.indicators import REACH, bounded_families, flow, flow_facts, in_series
from tickloom.operators.pivots import level_columns, pivot_levels, with_pivots
from tickloom.operators.rolling import Family, Series, run_families
from tickloom.operators.sar import AT_STATE, FROM_STATE, RUN_SPANS, State, walk_days, with_sar
from tickloom.operators.spans import Spans
from tickloom.schemas import BAR_COLUMNS, CORE_INDICATORS, EXTENDED_INDICATORS, INDICATOR_COLUMNS

# Tasks get the functions below with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of history that every indicator of bounded look-back is complete with.
HISTORY_ROWS = REACH + 1

# What is known of a symbol's day: its bars, their prices, and the state of the
# SAR after the last one. ``walked`` tells whether that state was worked out.
DAY_PRICES = ["high", "low", "close"]
RECORD_COLUMNS = ["bars", *DAY_PRICES, "last_time", "walked", *AT_STATE]
FROM_PRICES = [f"from_{name}" for name in DAY_PRICES]

# Columns of the rows of a segment beside the bars: the series it is, from when
# on it may change, whether a row is the batch's, and what is stored of it.
SEGMENT_COLUMNS = ["series", "since", *FROM_PRICES, *FROM_STATE]
STORED = {"obv": "_obv", "parabolic_sar": "_sar", "pivot": "_pivot"}


def touched_days(bars: DataFrame) -> DataFrame:
    """``symbol, day, first, added``: the days of a batch, their first bar and how many there are."""
    return bars.where(F.col("symbol").isNotNull()).groupBy("symbol", "day").agg(
        F.min("time").alias("first"), F.count(F.lit(1)).alias("added"))


def plan_segments(records: DataFrame, touched: DataFrame, recompute: bool, to_end: DataFrame | None = None) -> DataFrame:
    """The (symbol, day) pairs that a batch needs, each with the segment it belongs to.

    ``records`` are those of all days of the batch's symbols. With ``recompute``
    the days after a touched one count as far as the look-back reaches; symbols in
    ``to_end`` need all of them. Days without a ``walked`` record make a symbol's
    whole series up to the batch one segment, which gives them one.

    ``rows`` is an upper bound for the segment's bars, ``tail`` tells whether the
    symbol has days after it, and ``was_*`` is the stored state of the day.
    """
    by_day = Window.partitionBy("symbol").orderBy("day")
    so_far, from_here = by_day.rowsBetween(Window.unboundedPreceding, 0), by_day.rowsBetween(0, Window.unboundedFollowing)
    symbol, segment = Window.partitionBy("symbol"), Window.partitionBy("symbol", "segment")
    days = (
        records.join(touched.select("symbol").distinct(), "symbol", "left_semi")
        .join(touched, ["symbol", "day"], "full")
        .withColumn("bars", F.coalesce("bars", F.lit(0))).withColumn("added", F.coalesce("added", F.lit(0)))
        .withColumn("touched", F.col("added") > 0)
    )
    if to_end is not None:
        days = days.join(to_end.select("symbol", F.lit(True).alias("to_end")), "symbol", "left")
    else:
        days = days.withColumn("to_end", F.lit(False))
    days = (
        days.withColumn("upto", F.sum("bars").over(so_far)).withColumn("before", F.col("upto") - F.col("bars"))
        # Bars up to the last touched day, and those before the next one: both only grow.
        .withColumn("_last", F.max(F.when(F.col("touched"), F.col("upto"))).over(so_far))
        .withColumn("_next", F.min(F.when(F.col("touched"), F.col("before"))).over(from_here))
        .withColumn("_lacks", F.max(F.when((F.col("bars") > 0) & ~F.coalesce("walked", F.lit(False)), 1)).over(symbol))
    )
    needed = F.coalesce(F.col("_next") - F.col("upto") < HISTORY_ROWS, F.lit(False)) | F.col("touched")
    needed = needed | (F.col("_next").isNotNull() & F.col("_lacks").isNotNull())
    if recompute:
        needed = needed | F.coalesce(F.col("before") - F.col("_last") < REACH, F.lit(False))
        needed = needed | (F.col("_last").isNotNull() & (F.coalesce("to_end", F.lit(False)) | F.col("_lacks").isNotNull()))
    days = days.withColumn("needed", needed)
    fresh = F.col("needed") & ~F.coalesce(F.lag("needed").over(by_day), F.lit(False))
    last = F.lag(F.struct(*DAY_PRICES, *AT_STATE)).over(by_day)
    days = (
        days.withColumn("segment", F.sum(fresh.cast("int")).over(so_far)).withColumn("_from", last)
        .withColumn("tail", F.coalesce(~F.lead("needed").over(by_day), F.lit(False)))
        .where("needed")
    )
    begun = Window.partitionBy("symbol", "segment").orderBy("day")
    origin = F.first("_from").over(begun)
    return days.select(
        "symbol", "day",
        # Symbols may hold any character; the number at the end keeps names apart.
        F.concat_ws(" ", "symbol", F.col("segment").cast("string")).alias("series"),
        F.min("first").over(segment).alias("since"),
        F.sum(F.col("bars") + F.col("added")).over(segment).alias("rows"),
        (F.max("tail").over(segment) & (F.lead("day").over(begun).isNull())).alias("tail"),
        *[origin[name].alias(f"from_{name}") for name in DAY_PRICES],
        *[origin[at].alias(name) for at, name in zip(AT_STATE, FROM_STATE, strict=True)],
        *[F.col(at).alias(at.replace("at_", "was_")) for at in AT_STATE],
    )


def merged(stored: DataFrame, batch: DataFrame, plan: DataFrame, together: bool) -> DataFrame:
    """The segments' rows: of every bar the valid one of its stored versions and the batch's.

    The version of the message that arrived last is valid, then the one written
    last. A bar of the batch without ``arrival`` takes the place of the last
    version there is, so that it is valid until a later message comes.
    ``stored`` has ``written`` and the columns of ``STORED``. ``together`` puts a
    segment's rows into one partition, where its windows can go on.
    """
    def version(rows: DataFrame, fresh: bool) -> list[Column]:
        return [
            *[F.col(c) for c in BAR_COLUMNS], F.col("arrival"),
            (F.lit(None).cast("bigint") if fresh else F.col("written")).alias("_written"),
            F.lit(int(fresh)).alias("_changed"),
            *[(F.lit(None).cast("double") if fresh else F.col(c)).alias(name) for c, name in STORED.items()],
        ]

    both = stored.select(*version(stored, False)).unionByName(batch.select(*version(batch, True)))
    placed = both.join(plan.select("symbol", "day", *SEGMENT_COLUMNS), ["symbol", "day"])
    bar = Window.partitionBy("series", "time")
    place = F.coalesce("arrival", F.max("arrival").over(bar))
    newest = Window.partitionBy("series", "time").orderBy(F.desc_nulls_last("arrival"), F.desc_nulls_first("_written"))
    return (
        (placed.repartition("series") if together else placed).withColumn("arrival", place)
        .withColumn("_version", F.row_number().over(newest)).where("_version = 1").drop("_version", "_written")
    )


def nearness(series: Series) -> Family:
    """``near``: whether one of the last rows is the batch's, so that the row's indicators may differ; ``last_near``: the last such row."""
    return [
        {"near": f"max(_changed) {series.last(REACH + 1)}", "_recent": f"max(_changed) {series.last(REACH)}",
         "_left": series.lag("_changed", REACH)},
        {"last_near": "CASE WHEN _left = 1 AND _recent = 0 THEN 1 ELSE 0 END"},
    ]


def _families(series: Series) -> list[Family]:
    return [*bounded_families(series), *extended_families(series), nearness(series)]


def _walked(table: pa.Table) -> pa.Table:
    """A segment's rows with their SAR, the states at the ends of days, and the prices of the day before."""
    table = table.sort_by("time")
    times = table.column("time").to_pylist()
    highs, lows, closes = (table.column(c).to_pylist() for c in ("high", "low", "close"))
    first = {name: table.column(name)[0].as_py() for name in (*FROM_PRICES, *FROM_STATE)}
    state = None if first["from_up"] is None else State(*[first[name] for name in FROM_STATE])
    nan = float("nan")
    values, states = walk_days(times, [nan if x is None else x for x in highs], [nan if x is None else x for x in lows], state)
    prices: list[tuple] = []
    before = tuple(first[name] for name in FROM_PRICES)
    start = 0
    for end, (day, time) in enumerate(zip(days := table.column("day").to_pylist(), times, strict=True), start=1):
        prices.append(before)
        if end == len(times) or days[end] != day:
            before = (max((h for h in highs[start:end] if h is not None), default=None),
                      min((x for x in lows[start:end] if x is not None), default=None), closes[end - 1])
            start = end
    table = table.drop_columns([*FROM_PRICES, *FROM_STATE])
    for k, name in enumerate(FROM_PRICES):
        table = table.append_column(name, pa.array([p[k] for p in prices], pa.float64()))
    table = table.append_column("parabolic_sar", pa.array(values, pa.float64()))
    for k, name in enumerate(AT_STATE):
        kind = pa.bool_() if name == "at_up" else pa.float64()
        table = table.append_column(name, pa.array([None if s is None else s[k] for s in states], kind))
    return table


KEPT = ["series", "since", "arrival", "_changed", "near", "last_near", *STORED.values(), *AT_STATE]


def compute_small(rows: DataFrame) -> DataFrame:
    """All indicators of ``merged`` rows, each segment in one task: for segments of bounded length.

    One shuffle, by segment, serves all of it.
    """
    series = Series(("series",))
    first = F.row_number().over(Window.partitionBy("series").orderBy("time")) == 1
    seeded = rows.withColumn("_seed", F.when(first & (F.col("_changed") == 0), F.coalesce("_obv", F.lit(0.0))))
    windows = run_families(seeded, [*_families(series), flow(series, seeded=True)]).drop("_seed")
    fields = [f for f in windows.schema.fields if f.name not in (*FROM_PRICES, *FROM_STATE)]
    fields += [T.StructField(name, T.DoubleType()) for name in (*FROM_PRICES, "parabolic_sar")]
    fields += [T.StructField(name, T.BooleanType() if name == "at_up" else T.DoubleType()) for name in AT_STATE]
    # Plain fields: rows of several sources differ in what may be null.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    out = windows.groupBy("series").applyInArrow(_walked, schema)
    levels = level_columns(*[F.col(name) for name in FROM_PRICES])
    return out.select("*", *levels).select(*INDICATOR_COLUMNS, *KEPT)


def compute_large(rows: DataFrame, spans: Spans, work: str) -> DataFrame:
    """As ``compute_small`` for segments of any length, cut into spans. ``rows`` is read more than once."""
    rows = rows.withColumn("_symbol", F.col("symbol")).withColumn("symbol", F.col("series"))
    origins = rows.groupBy("symbol").agg(
        F.min("time").alias("_begin"), *[F.first(c).alias(c) for c in (*FROM_PRICES, *FROM_STATE)])
    first = rows.join(origins.select("symbol", "_begin"), "symbol").withColumn(
        "_seed", F.when((F.col("time") == F.col("_begin")) & (F.col("_changed") == 0), F.coalesce("_obv", F.lit(0.0))))
    seeded = first.drop("_begin", *FROM_PRICES, *FROM_STATE)
    levels = pivot_levels(rows, origins)
    walked = with_sar(seeded, spans=spans.longer(RUN_SPANS), begins=origins, states=True)
    out = in_series(with_pivots(walked, levels), _families, spans, flow_facts(seeded, spans, seeded=True),
                    seeded=True, work=work)
    return out.withColumn("symbol", F.col("_symbol")).select(*INDICATOR_COLUMNS, *KEPT)


def day_records(out: DataFrame) -> DataFrame:
    """The records of the segments' days."""
    at = F.when(F.col("at_up").isNotNull(), F.col("time"))
    found = out.groupBy("symbol", "day").agg(
        F.count(F.lit(1)).alias("bars"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "time").alias("close"), F.max("time").alias("last_time"),
        *[F.max_by(name, at).alias(name) for name in AT_STATE])
    return found.select("symbol", "day", *[F.lit(True).alias(c) if c == "walked" else F.col(c) for c in RECORD_COLUMNS])


def wanted_rows(recompute: bool) -> Column:
    """Which rows of the segments are to be written: the batch's, and with ``recompute`` those whose values it changes."""
    own = F.col("_changed") == 1
    if not recompute:
        return own
    differs = (F.col("near") == 1) | ~F.col("parabolic_sar").eqNullSafe(F.col("_sar")) | ~F.col("pivot").eqNullSafe(F.col("_pivot"))
    return own | ((F.col("time") >= F.col("since")) & differs)


def open_tails(out: DataFrame, plan: DataFrame) -> DataFrame:
    """Symbols whose SAR differs at the end of a segment that has days after it."""
    ends = day_records(out).select("symbol", "day", *AT_STATE)
    same = reduce(lambda a, b: a & b, (F.col(at).eqNullSafe(F.col(at.replace("at_", "was_"))) for at in AT_STATE))
    return plan.where("tail").join(ends, ["symbol", "day"]).where(~same).select("symbol").distinct()


def obv_shifts(out: DataFrame) -> DataFrame:
    """``symbol, series, day, time, shift``: by how much OBV differs from what is stored after the last row near a changed one.

    Rows beyond such a row differ by that much, up to the next changed row.
    """
    return out.where("last_near = 1").select(
        "symbol", "series", "day", "time", (F.col("obv") - F.coalesce("_obv", F.lit(0.0))).alias("shift"))


def obv_bases(shifts: DataFrame, plan: DataFrame) -> DataFrame:
    """``series, base``: what the changes in earlier segments of its symbol add to a segment's OBV."""
    finals = shifts.groupBy("series").agg(F.max_by("shift", "time").alias("final"))
    earlier = Window.partitionBy("symbol").orderBy("since").rowsBetween(Window.unboundedPreceding, -1)
    return plan.select("symbol", "series", "since").distinct().join(finals, "series", "left").select(
        "series", F.coalesce(F.sum("final").over(earlier), F.lit(0.0)).alias("base"))


def obv_offsets(shifts: DataFrame, bases: DataFrame, days: DataFrame) -> DataFrame:
    """``symbol, day, after, delta``: what to add to the OBV of stored rows of a day, of those later than ``after`` if given.

    One row for each day (of ``days``) after a change and one for the rest of its own day.
    """
    by_time = Window.partitionBy("symbol").orderBy("time")
    total = F.col("base") + F.col("shift")
    steps = shifts.join(bases, "series").withColumn("delta", total - F.coalesce(F.lag(total).over(by_time), F.lit(0.0)))
    own = steps.select("symbol", "day", F.col("time").alias("after"), "delta")
    each = own.groupBy("symbol", "day").agg(F.sum("delta").alias("_step"))
    listed = days.join(each.select("symbol").distinct(), "symbol", "left_semi").select("symbol", "day")
    before = Window.partitionBy("symbol").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    later = listed.join(each, ["symbol", "day"], "left").withColumn("delta", F.sum("_step").over(before)).select(
        "symbol", "day", F.lit(None).cast("bigint").alias("after"), "delta")
    return own.unionByName(later).where("delta <> 0")
