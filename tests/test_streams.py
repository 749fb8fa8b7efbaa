from pyspark.sql import functions as F

from series import START, assert_rows, closes, core_by_hand, frame, random_rows
from tickloom.functions.messages import encode_messages
from tickloom.operators.candles import build_candles
from tickloom.plans.rows import full_rows
from tickloom.schemas import CORE_INDICATORS
from tickloom.sources.messages import file_messages, kafka_messages, kafka_sink_options
from tickloom.sources.store import Store
from tickloom.streaming.pipeline import (
    batch_writer,
    candles_to_table,
    rejected_counts,
    stream_candles,
    stream_dedup,
    stream_enrich,
    table_candles,
)

ONCE = {"availableNow": True}


def send(spark, inbox, rows, seq, extra=()):
    sent = encode_messages(frame(spark, rows)).select("value", F.lit(seq).cast("bigint").alias("seq"))
    if extra:
        sent = sent.unionByName(spark.createDataFrame([(v, seq) for v in extra], "value string, seq bigint"))
    sent.coalesce(1).write.mode("append").parquet(inbox)


def run(spark, inbox, store, tmp_path, **options):
    query = stream_enrich(file_messages(spark, inbox), store, str(tmp_path / "checkpoint"),
                          order=("seq",), trigger=ONCE, **options)
    query.awaitTermination()


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rows = random_rows("a", 120, 1, nulls=False) + random_rows("b", 60, 2, nulls=False)
    rows.sort(key=lambda r: r[2])
    inbox, store, bad = str(tmp_path / "inbox"), Store(spark, str(tmp_path / "store")), str(tmp_path / "bad")
    unfinished = [r[:7] + (0.0,) for r in rows[80:90]]
    send(spark, inbox, rows[:80], 1, extra=["junk"])
    run(spark, inbox, store, tmp_path, quarantine_path=bad)
    send(spark, inbox, unfinished + rows[90:130], 2)
    send(spark, inbox, rows[80:90] + rows[130:], 3, extra=[None])
    run(spark, inbox, store, tmp_path, quarantine_path=bad, recompute=True)
    run(spark, inbox, store, tmp_path, quarantine_path=bad)  # nothing new
    expected = core_by_hand([r for r in rows if r[0] == "a"]) | core_by_hand([r for r in rows if r[0] == "b"])
    assert_rows(store.read().collect(), expected, CORE_INDICATORS)
    assert {r.value for r in spark.read.parquet(bad).collect()} == {"junk", None}
    assert sum(r.messages for r in rejected_counts(spark, bad).collect()) == 2
    assert {r.reason for r in rejected_counts(spark, bad).collect()} == {"no symbol, no time"}


def test_another_checkpoint_counts_anew(spark, tmp_path):
    """Leftovers of a stream that died are not taken for another stream's batch."""
    inbox, store = str(tmp_path / "inbox"), Store(spark, str(tmp_path / "store"))
    send(spark, inbox, closes("a", [1.0, 2.0]), 1)
    store.upsert(full_rows(frame(spark, closes("z", [9.0]))), "old-0")
    run(spark, inbox, store, tmp_path)
    assert sorted(r.symbol for r in store.read().collect()) == ["a", "a", "z"]
    assert len({r.batch for r in store.versions().collect()}) == 2


def test_a_batch_delivered_again(spark, tmp_path):
    rows = random_rows("a", 50, 4, nulls=False)
    store = Store(spark, str(tmp_path / "store"))
    write = batch_writer(store, ("seq",), lambda batch: "test")
    first, second = (encode_messages(frame(spark, part)).withColumn("seq", F.lit(1)) for part in (rows[:30], rows[30:]))
    write(first, 0)
    write(second, 1)
    write(second.unionByName(second), 1)
    assert_rows(store.read().collect(), core_by_hand(rows), CORE_INDICATORS)


def test_batch_without_bars(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    batch_writer(store, ("seq",), lambda batch: "test")(spark.createDataFrame([("junk", 1)], "value string, seq int"), 0)
    assert store.read().count() == 0


def ticks(spark, seconds):
    rows = [("a", START + s, i, 10.0 + i % 7, 1) for i, s in enumerate(seconds)]
    return (
        spark.createDataFrame(rows, "symbol string, s bigint, id bigint, price double, size bigint")
        .select("symbol", F.timestamp_seconds("s").alias("ts"), "id", "price", "size")
    )


def to_table(spark, stream, path):
    stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}-cp") \
        .option("path", path).trigger(**ONCE).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_candle_stream_equals_closed_batch_candles(spark, tmp_path):
    data = ticks(spark, range(0, 1_000, 7))
    inbox = str(tmp_path / "ticks")
    data.write.parquet(inbox)
    stream = spark.readStream.schema(data.schema).parquet(inbox)
    out = to_table(spark, stream_candles(stream, "1 minute", "1 minute", order=("ts", "id")), str(tmp_path / "out"))
    newest = START + 994
    closed = build_candles(data, 60, order=("ts", "id")).where(F.col("time") + 60 <= newest - 60)
    assert sorted(out.drop("last_event").collect()) == sorted(closed.collect())


def test_open_candles_are_in_the_table(spark, tmp_path):
    inbox, path = str(tmp_path / "ticks"), str(tmp_path / "table")
    parts = [ticks(spark, range(0, 500, 7)), ticks(spark, range(504, 1_000, 7))]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        candles = stream_candles(stream, "1 minute", "1 minute", order=("ts", "id"))
        candles_to_table(candles, path, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
    found = table_candles(spark, path, candles, 60)
    bars = build_candles(parts[0].unionByName(parts[1]), 60, order=("ts", "id"))
    assert sorted(r.time for r in found.collect()) == sorted(r.time for r in bars.collect())
    assert [r.time for r in found.where("NOT is_final").collect()] == [START + 960]
    same = found.drop("is_final").join(bars, ["symbol", "day", "time", "high", "low", "volume"])
    assert same.count() == bars.count()


def test_kafka_records_are_messages_in_order_of_arrival(spark):
    records = spark.createDataFrame(
        [(b"k", b"late", "t", 2, 9_000_000_000_000_000_000, 1_704_067_200.002, 0),
         (b"k", b"first", "t", 99_999, 5, 1_704_067_200.001, 0), (b"k", b"second", "t", 1, 7, 1_704_067_200.002, 0),
         (b"k", b"third", "t", 2, 1, 1_704_067_200.002, 0), (None, None, "t", 0, 0, 1.0, 0)],
        "key binary, value binary, topic string, partition int, offset bigint, s double, timestampType int",
    ).withColumn("timestamp", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")))
    found = kafka_messages(records).where("value IS NOT NULL").orderBy("arrival").collect()
    assert [r.value for r in found] == ["first", "second", "third", "late"]
    assert len({r.arrival for r in found}) == 4


def test_kafka_messages_feed_the_store(spark, tmp_path):
    sent = encode_messages(frame(spark, closes("a", [1.0, 2.0])))
    records = sent.selectExpr(
        "CAST(value AS BINARY) AS value", "timestamp_seconds(1704067200) AS timestamp", "0 AS partition", "3L AS offset")
    store = Store(spark, str(tmp_path / "store"))
    batch_writer(store, ("arrival",), lambda batch: "kafka")(kafka_messages(records), 0)
    assert sorted(r.close for r in store.read().collect()) == [1.0, 2.0]


def test_dedup_stream(spark, tmp_path):
    data = ticks(spark, range(0, 100, 5))
    inbox = str(tmp_path / "ticks")
    data.unionByName(data).unionByName(data).write.parquet(inbox)
    stream = spark.readStream.schema(data.schema).parquet(inbox)
    out = to_table(spark, stream_dedup(stream, ["id"], "10 minutes"), str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == list(range(20))


def test_sink_options():
    assert kafka_sink_options("broker:9092") == {"kafka.bootstrap.servers": "broker:9092", "topic": "crypto_candles"}


def test_messages_keep_symbol_order(spark):
    assert {r.key for r in encode_messages(frame(spark, closes("a", [1.0, 2.0]))).collect()} == {"a"}
