import json

from pyspark.sql import functions as F

from series import START, VERSIONED, bar, closes, frame
from tickloom.functions.clock import clock_text, iso_utc
from tickloom.functions.klines import decode_klines
from tickloom.functions.messages import encode_messages, parse_messages, quarantine
from tickloom.operators.candles import build_candles, dedup_latest, with_final_flag
from tickloom.plans.rows import compat_rows, full_rows
from tickloom.schemas import BAR_COLUMNS, INDICATOR_COLUMNS


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_round_trip(spark):
    bars = frame(spark, closes("a", [1.25, 2.5]))
    sent = encode_messages(bars)
    body = json.loads(sent.orderBy("value").first().value)
    assert sent.first().key == "a" and body == {
        "symbol": "a", "interval": "1m", "datetime": "2024-01-01T00:00:00Z", "epoch_ms": START * 1000,
        "open": 1.25, "high": 1.25, "low": 1.25, "close": 1.25, "volume": 10.0,
    }
    assert sorted(parse_messages(sent).collect()) == sorted(bars.collect())


def test_damaged_messages_never_fail(spark):
    prices = {"open": 1, "high": 3, "low": 1}
    good = json.dumps({"symbol": "a", "datetime": "2024-01-01T00:01:00Z", "epoch_ms": 1, **prices, "close": 2, "volume": "x"})
    fallback = json.dumps({"symbol": "a", "datetime": "soon", "epoch_ms": START * 1000 + 120_000, **prices, "close": 3})
    unpriced = json.dumps({"symbol": "a", "epoch_ms": START * 1000, **prices, "close": "n/a"})
    ancient = json.dumps({"symbol": "a", "epoch_ms": START, **prices, "close": 2})
    no_symbol = json.dumps({"datetime": "2024-01-01T00:01:00Z"})
    no_time = json.dumps({"symbol": "a", "datetime": "soon", "epoch_ms": 9 * 10**18})
    df = messages(spark, good, fallback, unpriced, ancient, no_symbol, no_time, "not json", None)
    rows = parse_messages(df).orderBy("time").collect()
    assert [(r.time, r.volume, r.close) for r in rows] == [(START + 60, None, 2.0), (START + 120, None, 3.0)]
    assert parse_messages(df, plausible=(0, 2 * START)).count() == 3
    reasons = {r.value: r.reason for r in quarantine(df).collect()}
    assert reasons == {no_symbol: "no symbol", no_time: "no time", unpriced: "no price", ancient: "implausible time",
                       "not json": "no symbol, no time", None: "no symbol, no time"}


def test_binary_values_and_carried_columns(spark):
    df = encode_messages(frame(spark, closes("a", [1.0]))).withColumn("offset", F.lit(7))
    df = df.withColumn("value", F.col("value").cast("binary"))
    (row,) = parse_messages(df).collect()
    assert (row.symbol, row.close, row.offset) == ("a", 1.0, 7)


def test_iso_text_and_clock(spark):
    df = spark.createDataFrame([(START * 1000,), (START * 1000 + 123,)], "ms bigint")
    assert [r[0] for r in df.select(iso_utc(F.col("ms"))).collect()] == [
        "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.123000Z"]
    assert spark.range(1).select(clock_text(F.lit(START + 3_661))).first()[0] == "01:01:01"


def test_days_do_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        sent = encode_messages(frame(spark, [bar("a", START + 72_000, 1.0)]))
        assert json.loads(sent.first().value)["datetime"] == "2024-01-01T20:00:00Z"
        (row,) = parse_messages(sent).collect()
        assert (str(row.day), row.time) == ("2024-01-01", START + 72_000)
        zoneless = sent.withColumn("value", F.regexp_replace("value", '00Z"', '00"'))
        assert parse_messages(zoneless).first().time == START + 72_000
        ticks = spark.createDataFrame([("a", START + 72_000, 1.0, 1)], "symbol string, s bigint, price double, size bigint")
        candle = build_candles(ticks.withColumn("ts", F.timestamp_seconds("s")), 3_600).first()
        assert (str(candle.day), candle.time) == ("2024-01-01", START + 72_000)
        assert spark.range(1).select(clock_text(F.lit(START + 3_661))).first()[0] == "01:01:01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_klines(spark):
    full = [str(START * 1000), "1.5", "2", "1", "1.75", "12.9", "more", "ignored"]
    df = spark.createDataFrame([("a", full), ("b", full[:3]), ("c", ["x"] * 6)], "symbol string, kline array<string>")
    a, b, c = decode_klines(df).orderBy("symbol").collect()
    assert (a.datetime, a.open, a.high, a.low, a.close, a.volume) == ("2024-01-01T00:00:00Z", 1.5, 2.0, 1.0, 1.75, 12.9)
    assert (b.epoch_ms, b.high, b.low, b.close) == (START * 1000, 2.0, None, None)
    assert (c.epoch_ms, c.datetime, c.open) == (None, None, None)


def test_latest_version_wins(spark):
    rows = [(*bar("a", START, 5.0, volume=v), seq) for seq, v in [(2, 20.0), (3, 30.0), (1, 10.0)]]
    df = spark.createDataFrame([*rows, (*bar("a", START + 60, 1.0), 1)], VERSIONED)
    out = dedup_latest(df, order=("seq",)).orderBy("time").collect()
    assert [(r.time, r.volume) for r in out] == [(START, 30.0), (START + 60, 10.0)]


def test_candles_break_ties(spark):
    ticks = spark.createDataFrame(
        [("a", START + 5, 2, 11.0, 1), ("a", START + 5, 1, 10.0, 1), ("a", START + 59, 3, 9.0, 2),
         ("a", START + 60, 4, 8.0, 4), (None, START, 5, 1.0, 1)],
        "symbol string, s bigint, id bigint, price double, size bigint",
    ).withColumn("ts", F.timestamp_seconds("s"))
    first, second = build_candles(ticks, 60, order=("ts", "id")).orderBy("time").collect()
    assert tuple(first)[2:] == (START, 10.0, 11.0, 9.0, 9.0, 4.0)
    assert tuple(second)[2:] == (START + 60, 8.0, 8.0, 8.0, 8.0, 4.0)


def test_final_flag(spark):
    bars = frame(spark, closes("a", [1.0, 2.0]))
    out = with_final_flag(bars, 60, F.lit(START + 60)).orderBy("time").collect()
    assert [r.is_final for r in out] == [True, False]


def test_contract_row(spark):
    rows = [bar("a", START, 1.5, volume=12.9), bar("a", START + 60, 1.5, volume=-12.9),
            bar("a", START + 120, 1.5, volume=float("nan"))]
    from tickloom.operators.indicators import with_indicators
    out = compat_rows(with_indicators(frame(spark, rows))).orderBy("time")
    assert out.columns == INDICATOR_COLUMNS and len(out.columns) == 39
    assert [r.volume for r in out.collect()] == [12, -12, None]
    types = dict(out.dtypes)
    assert types["ma5"] == types["adx"] == "float" and types["volume"] == "bigint"
    assert out.first().adx is None
    assert full_rows(frame(spark, rows).select(*BAR_COLUMNS)).columns == INDICATOR_COLUMNS
