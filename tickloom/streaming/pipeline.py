"""From a stream of messages or ticks to tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.clock import utc_day
from tickloom.functions.messages import PLAUSIBLE, parse_messages, quarantine
from tickloom.operators.candles import candle_aggregates, dedup_latest, position, with_final_flag
from tickloom.operators.indicators import REACH
from tickloom.operators.segments import (
    compute_large,
    compute_small,
    day_records,
    merged,
    obv_bases,
    obv_offsets,
    obv_shifts,
    open_tails,
    plan_segments,
    touched_days,
    wanted_rows,
)
from tickloom.operators.spans import Spans
from tickloom.plans.rows import full_rows
from tickloom.schemas import ARRIVAL, BAR_COLUMNS
from tickloom.session import delete_path, settle, small_session
from tickloom.sources.store import MERGE_FROM, NAMED_SYMBOLS, Store


# Batches of up to so many bars run as a few jobs without adaptive execution.
SMALL_BARS = 50_000
BARS_PER_PARTITION, LEAST_PARTITIONS = 5_000, 8


def enrich_into(store: Store, bars: DataFrame, batch_id: str, recompute: bool = False,
                spans: Spans = Spans()) -> None:
    """Compute all indicators of a batch of bars and upsert them.

    All symbols go through one plan, over the days that ``operators.segments``
    finds them to need. Of a bar that the store holds a later message of
    (``arrival``), nothing is written. With ``recompute`` stored rows after a
    changed bar are brought up to date: those within the look-back, and others
    whose SAR or levels differ, as new versions, the OBV of all that follow by an
    offset for each day.
    """
    work = store.work_path(batch_id)
    if "arrival" not in bars.columns:
        bars = bars.withColumn("arrival", F.lit(None).cast(ARRIVAL))
    size = Observation()
    bars = bars.where(F.col("symbol").isNotNull()).select(*BAR_COLUMNS, F.col("arrival").cast(ARRIVAL).alias("arrival"))
    path = settle(bars.observe(size, F.count(F.lit(1)).alias("bars")), "bars", work).inputFiles()
    count = size.get["bars"]
    if not count:
        delete_path(store.spark, work)
        return
    small = count <= SMALL_BARS
    spark = small_session(store.spark, max(LEAST_PARTITIONS, -(-count // BARS_PER_PARTITION))) if small else store.spark
    store = store.within(spark)
    bars = spark.read.schema(bars.schema).parquet(*path)
    to_end = None
    while True:
        plan, days, symbols, rows = _planned(store, bars, batch_id, recompute, to_end, small, work)
        out = settle(_computed(store, bars, batch_id, plan, days, symbols, rows, spans, work), "computed", work)
        if not recompute:
            break
        facts = out.agg(F.max("last_near")).first()[0]
        tails = open_tails(out, plan) if to_end is None else None
        if tails is None or tails.isEmpty():
            break
        # A trend that no flip has ended lasts beyond the look-back: their series are taken to the end.
        to_end = settle(tails, "to-end", work)
    written, offsets = out.where(wanted_rows(recompute)), None
    if recompute and facts:
        shifts = settle(obv_shifts(out), "shifts", work)
        bases = settle(obv_bases(shifts, plan), "bases", work)
        written = written.join(bases, "series", "left").withColumn("obv", F.col("obv") + F.coalesce("base", F.lit(0.0)))
        # Written first: the upsert replaces the records that a batch run before has left.
        listed = store.records(without=batch_id).select("symbol", "day").unionByName(plan.select("symbol", "day")).distinct()
        offsets = settle(obv_offsets(shifts, bases, listed), "offsets", work)
    store.upsert(full_rows(written, carry=("arrival",)), batch_id, day_records(out), offsets)


def _planned(store: Store, bars: DataFrame, batch_id: str, recompute: bool, to_end: DataFrame | None, small: bool,
             work: str) -> tuple[DataFrame, list, list[str] | None, int]:
    """The plan of the batch's segments; its days, its symbols if they are few, and the bars of the longest segment."""
    plan = settle(plan_segments(store.records(without=batch_id), touched_days(bars), recompute, to_end), "plan", work)
    names = [F.collect_set("symbol").alias("symbols")] if small else []
    found = plan.agg(F.collect_set("day").alias("days"), F.max("rows").alias("rows"), *names).first()
    symbols = found["symbols"] if small and len(found["symbols"]) <= NAMED_SYMBOLS else None
    return plan, sorted(found["days"]), symbols, found["rows"]


def _computed(store: Store, bars: DataFrame, batch_id: str, plan: DataFrame, days: list, symbols: list[str] | None,
              rows: int, spans: Spans, work: str) -> DataFrame:
    """All rows of the segments with their indicators."""
    stored = store.versions(days, without=batch_id)
    if symbols is not None:
        # Reaches the files, where a day's bars are sorted by symbol.
        stored = stored.where(F.col("symbol").isin(symbols))
    spans.check(REACH)
    together = rows <= spans.rows_per_span
    series = merged(store.with_offsets(stored, without=batch_id), bars, plan, together)
    if together:
        return compute_small(series)
    return compute_large(settle(series, "series", work), spans, work)


def batch_writer(store: Store, order: tuple[str, ...], stream: Callable[[DataFrame], str],
                 quarantine_path: str | None = None, recompute: bool = False, spans: Spans = Spans(),
                 plausible: tuple[int, int] = PLAUSIBLE, merge_from: int = MERGE_FROM) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of the message stream.

    ``stream`` names the stream, so that batches are told apart by stream and
    number: another checkpoint starts to count from zero again. Messages that
    are no bars go to ``quarantine_path``, and how many by reason next to it.
    Small batches of a day are merged once there are ``merge_from`` of them;
    batches before the present one have ended and never run again.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        name = f"{stream(messages)}-{batch_id}"
        store.compact_small(merge_from)
        # The batch is read several times; its source should be read once.
        messages = messages.persist()
        try:
            if quarantine_path:
                _write_rejected(messages, quarantine_path, name, plausible)
            parsed = parse_messages(messages, plausible)
            parsed = parsed.withColumn("arrival", position(parsed, order).cast(ARRIVAL))
            bars = dedup_latest(parsed.select(*BAR_COLUMNS, "arrival"), order=("arrival",))
            # The upsert at the end of this deletes the batch's work folder.
            enrich_into(store, bars, name, recompute, spans)
        finally:
            messages.unpersist()

    return write


REASONS = ("no symbol, no time", "no symbol", "no time", "implausible time", "no price")


def _write_rejected(messages: DataFrame, path: str, name: str, plausible: tuple[int, int]) -> None:
    """One folder per batch: a batch that is run again replaces its rows and counts."""
    counts = Observation()
    rejected = quarantine(messages, plausible).observe(
        counts, *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS])
    rejected.write.mode("overwrite").parquet(f"{path}/batch={name}")
    rows = [(reason, counts.get[reason]) for reason in REASONS]
    table = messages.sparkSession.createDataFrame(rows, "reason string, messages bigint")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}-counts/batch={name}")


def rejected_counts(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """``batch, reason, messages``: what the stream has counted so far."""
    counts = spark.read.schema("reason string, messages bigint, batch string").parquet(f"{quarantine_path}-counts")
    return counts.where("messages > 0").select("batch", "reason", "messages")


def stream_enrich(messages: DataFrame, store: Store, checkpoint: str, order: tuple[str, ...],
                  trigger: dict, **options) -> StreamingQuery:
    """Start the message stream; ``checkpoint`` and the store make it restartable.

    ``trigger`` says how often a batch is made. A batch costs ten small jobs
    however few bars it has, so take some ten seconds or more. Batches are
    delivered at least once and upserts are by key, so a batch that is delivered
    again changes nothing. The streaming query's own id, which restarts keep,
    names the batches.
    """
    def query_id(batch: DataFrame) -> str:
        return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")

    return (
        messages.writeStream.outputMode("append")
        .foreachBatch(batch_writer(store, order, query_id, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_candles(ticks: DataFrame, width: str, late: str, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Candles of a tick stream, with the newest event of each.

    The state is one partial candle per symbol and interval that is not yet
    ``late`` behind. In append mode each is emitted once, when it is; in update
    mode whenever it has changed.
    """
    at = position(ticks, order)
    return (
        ticks.withWatermark("ts", late)
        .groupBy("symbol", F.window("ts", width))
        .agg(*candle_aggregates(at), F.max("ts").alias("last_event"))
        .select(
            "symbol",
            utc_day(F.unix_seconds("window.start")).alias("day"),
            F.unix_seconds("window.start").alias("time"),
            "open", "high", "low", "close", "volume", "last_event",
        )
    )


def candles_to_table(candles: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Keep the changing candles of a stream in a table, one folder per batch."""

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        candles.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def table_candles(spark: SparkSession, path: str, candles: DataFrame, width_seconds: int) -> DataFrame:
    """The newest version of every candle in a table of ``candles_to_table``, with ``is_final``.

    A candle is final once its interval lies before the newest event of the stream.
    """
    schema = T.StructType([*candles.schema.fields, T.StructField("batch", T.LongType())])
    versions = spark.read.schema(schema).parquet(path)
    newest = versions.agg(F.max(F.unix_seconds("last_event"))).first()[0]
    bars = dedup_latest(versions, order=("batch",)).drop("batch", "last_event")
    return with_final_flag(bars, width_seconds, F.lit(newest).cast("bigint"))


def stream_dedup(rows: DataFrame, keys: list[str], late: str, event_time: str = "ts") -> DataFrame:
    """Drop repeats of a row that arrive within ``late`` of each other."""
    return rows.withWatermark(event_time, late).dropDuplicatesWithinWatermark(keys)
