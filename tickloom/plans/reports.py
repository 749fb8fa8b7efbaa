"""The named queries: each takes a session and a folder of tables."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import utc_day
from tickloom.functions.klines import decode_klines
from tickloom.functions.messages import encode_messages, parse_messages, quarantine, quarantine_counts
from tickloom.operators.candles import build_candles, dedup_latest
from tickloom.operators.enrich import (
    HISTORY_ROWS,
    bars_between,
    batch_range,
    enrich,
    history_before,
    keep_batch,
    newest,
    newest_row,
)
from tickloom.operators.extended import channel, money_flow, stochastic, trend
from tickloom.operators.indicators import REACH, with_indicators
from tickloom.operators.pivots import with_pivots
from tickloom.operators.sar import with_sar
from tickloom.operators.spans import Spans, over_spans
from tickloom.plans.present import DECIMALS, present
from tickloom.plans.reads import day_bars, latest, multi_symbol, named_range, range_bars, run_sql
from tickloom.plans.rows import compat_rows, display_rows, full_rows
from tickloom.schemas import BAR_COLUMNS, CORE_INDICATORS, EXTENDED_INDICATORS, KEY_COLUMNS
from tickloom.session import prepare, scratch_path, settle
from tickloom.sources.messages import file_messages
from tickloom.sources.store import Store
from tickloom.sources.tables import as_ticks, read_sales, read_ticks
from tickloom.streaming.pipeline import (
    candles_to_table,
    enrich_into,
    stream_candles,
    stream_dedup,
    stream_enrich,
    table_candles,
)

HOUR = 3_600
DAY = 86_400

# The day that reads take for today.
AS_OF = date(2024, 1, 30)

PIVOT_COLUMNS = EXTENDED_INDICATORS[EXTENDED_INDICATORS.index("pivot"):]

# A year of hourly bars and some twenty of daily ones: about 5 % of the rows of longer series are edge rows.
HOURLY_SPANS = Spans(width_seconds=HOUR, rows_per_span=8_760)
DAILY_SPANS = Spans(width_seconds=DAY, rows_per_span=8_000)


# Sales prices are cents, of up to eight digits, so fewer decimals are certain.
SALES_DECIMALS = 4


# Reports whose bars are read more than once work on a stored table of them.
def stored_bars(spark: SparkSession, folder: str) -> DataFrame:
    return settle(hourly_bars(spark, folder), "bars")


def stored_sales(spark: SparkSession, folder: str) -> DataFrame:
    return settle(daily_sales_bars(spark, folder), "bars")


def hourly_bars(spark: SparkSession, folder: str) -> DataFrame:
    return build_candles(read_ticks(prepare(spark), folder), HOUR, order=("ts", "tick_id"))


def daily_sales_bars(spark: SparkSession, folder: str) -> DataFrame:
    return build_candles(read_sales(prepare(spark), folder), DAY, order=("line",))


def _indicators(*columns: str, reset: str = "none", bars=stored_bars, spans=HOURLY_SPANS,
                decimals: int = DECIMALS):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return present(
            with_indicators(bars(spark, folder), reset, spans).select(*KEY_COLUMNS, "close", *columns),
            decimals,
        )

    return query


def _extended(*columns: str, families):
    """Windowed extended indicators, each on its own."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        out = over_spans(stored_bars(spark, folder), families, REACH, HOURLY_SPANS)
        return present(out.select(*KEY_COLUMNS, *columns))

    return query


def parabolic_sar(spark: SparkSession, folder: str) -> DataFrame:
    bars = stored_bars(spark, folder)
    return present(with_sar(bars, spans=HOURLY_SPANS).select(*KEY_COLUMNS, "parabolic_sar"))


def pivots(spark: SparkSession, folder: str) -> DataFrame:
    return present(with_pivots(stored_bars(spark, folder)).select(*KEY_COLUMNS, *PIVOT_COLUMNS))


def all_indicators(spark: SparkSession, folder: str) -> DataFrame:
    bars = stored_bars(spark, folder)
    return present(full_rows(with_indicators(bars, spans=HOURLY_SPANS, extended=True)))


def indicator_row_compat(spark: SparkSession, folder: str) -> DataFrame:
    enriched = with_indicators(stored_bars(spark, folder), spans=HOURLY_SPANS)
    return compat_rows(present(enriched))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of the hourly bars, and others that are damaged in several ways."""
    bars = hourly_bars(spark, folder)
    good = encode_messages(bars, "1h").select("value")
    # The time text of one symbol is unreadable; its epoch number is not.
    damaged_time = F.regexp_replace("value", '"datetime":"[^"]*"', '"datetime":"not a time"')
    good = good.withColumn(
        "value", F.when(F.col("value").contains('"symbol":"error"'), damaged_time).otherwise(F.col("value"))
    )
    anonymous = bars.select(F.to_json(F.struct((F.col("time") * 1000).alias("epoch_ms"), "close")).alias("value"))
    timeless = bars.select(F.to_json(F.struct("symbol", "close")).alias("value"))
    prices = ["open", "high", "low"]
    # Seconds where milliseconds belong make a bar of January 1970.
    ancient = bars.select(F.to_json(F.struct("symbol", F.col("time").alias("epoch_ms"), *prices, "close")).alias("value"))
    unpriced = bars.select(F.to_json(F.struct(
        "symbol", (F.col("time") * 1000).alias("epoch_ms"), *prices, F.lit("n/a").alias("close"))).alias("value"))
    other = spark.read.parquet(f"{folder}/events.parquet").select(F.col("props").alias("value"))
    broken = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_name").alias("value"))
    return reduce(DataFrame.unionByName, [good, anonymous, timeless, ancient, unpriced, other, broken])


def report_parse_messages(spark: SparkSession, folder: str) -> DataFrame:
    return present(parse_messages(messages(spark, folder)))


def report_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine(messages(spark, folder))


def report_quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine_counts(quarantine(messages(spark, folder)))


def report_encode_messages(spark: SparkSession, folder: str) -> DataFrame:
    return encode_messages(hourly_bars(spark, folder), "1h")


def report_decode_klines(spark: SparkSession, folder: str) -> DataFrame:
    """Klines of the bars; those of one symbol lack their last two elements, and
    those of another have no readable close."""
    bars = hourly_bars(spark, folder)
    fields = [(F.col("time") * 1000).cast("string"), *[F.col(c).cast("string") for c in ("open", "high", "low")]]
    close = F.when(F.col("symbol") == "signup", "n/a").otherwise(F.col("close").cast("string"))
    kline = F.array(*fields, close, F.col("volume").cast("string"))
    kline = F.when(F.col("symbol") == "view", F.slice(kline, 1, 4)).otherwise(kline)
    return decode_klines(bars.select("symbol", kline.alias("kline")), "1h")


def report_dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Every tick re-sends its hour's bar; the last one sent stands."""
    ticks = read_ticks(prepare(spark), folder)
    second = F.unix_seconds("ts")
    sent = ticks.select(
        "symbol", utc_day(second).alias("day"), (second - F.pmod(second, F.lit(HOUR))).alias("time"),
        F.col("price").alias("close"), F.col("size").cast("double").alias("volume"), "ts", "tick_id",
    )
    return present(dedup_latest(sent, order=("ts", "tick_id")).drop("ts"))


def newest_bar(spark: SparkSession, folder: str) -> DataFrame:
    return present(newest_row(hourly_bars(spark, folder)))


def history_lookback(spark: SparkSession, folder: str) -> DataFrame:
    return present(newest(hourly_bars(spark, folder), HISTORY_ROWS))


def enrich_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The newest day of bars as a batch, all earlier ones as the stored table."""
    bars = stored_bars(spark, folder)
    batch = settle(newest(bars, 24), "batch")
    earlier = bars.join(batch, KEY_COLUMNS, "left_anti")
    stored = settle(with_indicators(earlier, spans=HOURLY_SPANS), "stored")
    ranges = batch_range(batch)
    enriched = enrich(batch, history_before(stored, ranges), bars_between(stored, batch, ranges, False),
                      spans=HOURLY_SPANS)
    return present(keep_batch(enriched, batch).select(*KEY_COLUMNS, "close", *CORE_INDICATORS))


def new_store(spark: SparkSession) -> Store:
    return Store(spark, scratch_path(spark, "store"))


def store_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All bars first, then the bars of the mornings with twice the volume."""
    bars = stored_bars(spark, folder)
    morning = F.pmod(F.col("time"), F.lit(DAY)) < DAY // 2
    store = new_store(spark)
    store.upsert(full_rows(bars), "first")
    store.upsert(full_rows(bars.where(morning).withColumn("volume", 2 * F.col("volume"))), "second")
    return present(store.read().select(*BAR_COLUMNS))


def late_recompute(spark: SparkSession, folder: str) -> DataFrame:
    """A noon bar of each symbol's tenth day arrives after all others."""
    bars = stored_bars(spark, folder)
    late = (F.date_format("day", "dd") == "10") & (F.pmod(F.col("time"), F.lit(DAY)) == DAY // 2)
    store = new_store(spark)
    enrich_into(store, bars.where(~late), "on-time", spans=HOURLY_SPANS)
    enrich_into(store, bars.where(late), "late", recompute=True, spans=HOURLY_SPANS)
    return present(store.read().select(*KEY_COLUMNS, "close", *CORE_INDICATORS))


def late_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """A noon bar of every symbol's fifth day arrives after all others; all 39 columns of every row.

    The bar's neighbours are written anew, the OBV of the rows after them comes
    from offsets, and the SAR goes on from the day's stored state.
    """
    bars = stored_bars(spark, folder)
    late = (F.date_format("day", "dd") == "05") & (F.pmod(F.col("time"), F.lit(DAY)) == DAY // 2)
    store = new_store(spark)
    enrich_into(store, bars.where(~late), "on-time", spans=HOURLY_SPANS)
    enrich_into(store, bars.where(late), "late", recompute=True, spans=HOURLY_SPANS)
    return present(store.read())


def late_mixed_whole(spark: SparkSession, folder: str) -> DataFrame:
    """One batch holds live bars of sparse symbols and a late bar of every other one; all rows of the store.

    Every symbol has a copy under a name of its own with a bar every third hour
    only, whose newest day is live; the batch brings later rows up to date.
    """
    bars = stored_bars(spark, folder)
    sparse = bars.where(F.floor(F.col("time") / HOUR) % 3 == 0).withColumn("symbol", F.concat("symbol", F.lit("-sparse")))
    late = (F.date_format("day", "dd") == "05") & (F.pmod(F.col("time"), F.lit(DAY)) == DAY // 2)
    mixed = settle(newest(sparse, 8).unionByName(bars.where(late)), "mixed")
    store = new_store(spark)
    earlier = bars.unionByName(sparse).join(mixed, KEY_COLUMNS, "left_anti")
    enrich_into(store, earlier.select(*bars.columns), "before", spans=HOURLY_SPANS)
    enrich_into(store, mixed, "mixed", recompute=True, spans=HOURLY_SPANS)
    return present(store.read().select(*KEY_COLUMNS, "close", *CORE_INDICATORS))


def filled_store(spark: SparkSession, folder: str) -> Store:
    store = new_store(spark)
    store.upsert(full_rows(hourly_bars(spark, folder)), "all")
    return store


def _read(read):
    """A read of the stored bars."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return present(read(filled_store(spark, folder).read().select(*BAR_COLUMNS)))

    return query


def report_run_sql(spark: SparkSession, folder: str) -> DataFrame:
    filled_store(spark, folder).read().select(*BAR_COLUMNS).createOrReplaceTempView("bars_1h")
    return present(run_sql(spark, """
        SELECT symbol, day, max(high) AS high, min(low) AS low, count(*) AS bars
        FROM bars_1h WHERE symbol IN ('click', 'view') GROUP BY symbol, day;
    """))


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of ticks."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    stream = (
        prepare(spark).readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet").parquet(folder)
    )
    return as_ticks(stream)


def _run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all there is, into a table."""
    path = scratch_path(spark, name)
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{path}-checkpoint").option("path", path)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def report_stream_candles(spark: SparkSession, folder: str) -> DataFrame:
    """All candles of the stream, closed and open ones."""
    candles = stream_candles(_event_stream(spark, folder), "1 hour", "1 hour", order=("ts", "tick_id"))
    path = scratch_path(spark, "candles")
    candles_to_table(candles, path, f"{path}-checkpoint", {"availableNow": True}).awaitTermination()
    return present(table_candles(spark, path, candles, HOUR))


def report_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every tick is sent twice."""
    sent = _event_stream(spark, folder).unionByName(_event_stream(spark, folder))
    once = stream_dedup(sent, ["tick_id"], "1 hour").drop("ts")
    return present(_run_to_table(spark, once, "dedup"))


def streamed_store(spark: SparkSession, folder: str) -> Store:
    """Messages arrive in three parts, each bar first with no volume; the stream
    is stopped and restarted from its checkpoint between the parts."""
    bars = stored_bars(spark, folder)
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "checkpoint")
    store = new_store(spark)
    part = F.least(F.floor((F.dayofmonth("day") - 1) / 10), F.lit(2))
    for number in range(3):
        sent = bars.where(part == number)
        provisional = encode_messages(sent.withColumn("volume", F.lit(0.0)), "1h").withColumn("seq", F.lit(1))
        final = encode_messages(sent, "1h").withColumn("seq", F.lit(2))
        arrived = provisional.unionByName(final).select("value", F.col("seq").cast("bigint"))
        arrived.write.mode("append").parquet(inbox)
        query = stream_enrich(file_messages(spark, inbox, files_per_trigger=10_000), store, checkpoint,
                              order=("seq",), trigger={"availableNow": True}, spans=HOURLY_SPANS)
        query.awaitTermination()
    return store


def report_stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return present(streamed_store(spark, folder).read().select(*KEY_COLUMNS, "close", *CORE_INDICATORS))


def stream_all_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """All 39 columns as the stream writes them: SAR and levels go on over its restarts."""
    return present(streamed_store(spark, folder).read())


def candles_1h(spark: SparkSession, folder: str) -> DataFrame:
    return present(hourly_bars(spark, folder))


def sales_candles(spark: SparkSession, folder: str) -> DataFrame:
    return present(daily_sales_bars(spark, folder))


REPORTS = {
    "candles_1h": candles_1h,
    "sales_candles": sales_candles,
    "moving_averages": _indicators("ma5", "ma10", "ma20", "ma50", "ma100", "ma200"),
    "bollinger": _indicators("bb_upper", "bb_middle", "bb_lower"),
    "macd": _indicators("macd_line", "macd_signal", "macd_histogram"),
    "rsi": _indicators("rsi14"),
    "obv": _indicators("obv"),
    "core_indicators": _indicators(*CORE_INDICATORS),
    "indicators_daily_reset": _indicators(*CORE_INDICATORS, reset="day", bars=hourly_bars),
    "sales_indicators": _indicators(*CORE_INDICATORS, bars=stored_sales, spans=DAILY_SPANS,
                                    decimals=SALES_DECIMALS),
    "atr": _extended("atr", families=lambda series: [trend(series)]),
    "adx": _extended("plus_di", "minus_di", "adx", families=lambda series: [trend(series)]),
    "stochastic": _extended("stoch_k", "stoch_d", families=lambda series: [stochastic(series)]),
    "cci": _extended("cci", families=lambda series: [channel(series)]),
    "volume_ma_mfi": _extended("volume_ma20", "mfi", families=lambda series: [money_flow(series)]),
    "pivots": pivots,
    "parabolic_sar": parabolic_sar,
    "all_indicators": all_indicators,
    "indicator_row_compat": indicator_row_compat,
    "parse_messages": report_parse_messages,
    "quarantine": report_quarantine,
    "encode_messages": report_encode_messages,
    "decode_klines": report_decode_klines,
    "dedup_latest": report_dedup_latest,
    "newest_bar": newest_bar,
    "display_bars": _read(lambda bars: display_rows(bars).withColumn("bar_ts", F.col("bar_ts").cast("string"))),
    "quarantine_counts": report_quarantine_counts,
    "history_lookback": history_lookback,
    "enrich_batch": enrich_batch,
    "store_upsert": store_upsert,
    "late_recompute": late_recompute,
    "late_offsets": late_offsets,
    "late_mixed_whole": late_mixed_whole,
    "latest_bars": _read(lambda bars: latest(bars, ["click", "view"], AS_OF, 3)),
    "day_bars": _read(lambda bars: day_bars(bars, "click", AS_OF, 10)),
    "range_bars": _read(lambda bars: range_bars(bars, "view", date(2024, 1, 10), date(2024, 1, 20))),
    "multi_symbol": _read(lambda bars: multi_symbol(bars, ["click", "view"], AS_OF)),
    "named_range": _read(lambda bars: named_range(bars, "error", "last week", AS_OF)),
    "run_sql": report_run_sql,
    "stream_candles": report_stream_candles,
    "stream_dedup": report_stream_dedup,
    "stream_enrich": report_stream_enrich,
    "stream_all_indicators": stream_all_indicators,
}
