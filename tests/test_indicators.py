import random

import pytest
from pyspark.sql import functions as F

from series import START, assert_rows, bar, closes, core_by_hand, frame, random_rows
from tickloom.functions.numbers import rounded
from tickloom.operators.extended import channel, money_flow, stochastic, trend
from tickloom.operators.indicators import REACH, with_indicators
from tickloom.operators.pivots import pivot_levels, with_pivots
from tickloom.operators.rolling import Series, rolling_means, run_families
from tickloom.operators.spans import Spans, over_spans
from tickloom.schemas import CORE_INDICATORS, EXTENDED_INDICATORS


def indicators(spark, rows, **options):
    out = with_indicators(frame(spark, rows), **options).orderBy("symbol", "time").collect()
    return out


@pytest.mark.parametrize("rows_per_span", [40, 250, 43_200])
def test_spans_equal_whole_series(spark, rows_per_span):
    """Series of many spans, with gaps and NULLs, against row-by-row formulas."""
    rows = random_rows("a", 900, 1) + random_rows("b", 300, 2, gaps=False) + random_rows("c", 3, 3)
    expected = {}
    for symbol in "abc":
        expected |= core_by_hand([r for r in rows if r[0] == symbol])
    random.Random(4).shuffle(rows)
    out = indicators(spark, rows, spans=Spans(60, rows_per_span, short=True))
    assert_rows(out, expected, CORE_INDICATORS)


def test_reset_by_day(spark):
    rows = closes("a", [10.0, 11.0, 12.0], step=43_200)
    first, second, third = indicators(spark, rows, reset="day")
    assert first.ma5 == 10.0 and second.ma5 == 10.5
    assert third.ma5 == 12.0 and third.obv == 0.0


def test_unknown_reset(spark):
    with pytest.raises(ValueError):
        with_indicators(frame(spark, []), reset="week")


def test_one_bar(spark):
    (row,) = indicators(spark, closes("a", [7.5]))
    assert {row[f"ma{n}"] for n in (5, 10, 20, 50, 100, 200)} == {7.5}
    assert (row.bb_upper, row.bb_lower, row.bb_middle) == (None, None, 7.5)
    assert (row.macd_line, row.macd_signal, row.macd_histogram) == (0.0, 0.0, 0.0)
    assert (row.rsi14, row.obv) == (100.0, 0.0)


def test_flat(spark):
    out = indicators(spark, closes("a", [5.0] * 30))
    assert {r.rsi14 for r in out} == {100.0} and {r.obv for r in out} == {0.0}
    assert all(r.bb_upper == r.bb_lower == 5.0 for r in out[1:])


def test_rising_and_falling(spark):
    up = indicators(spark, closes("a", [float(i) for i in range(1, 31)]))
    down = indicators(spark, closes("a", [float(i) for i in range(31, 1, -1)]))
    assert {r.rsi14 for r in up} == {100.0} and up[-1].obv == 290.0
    assert {r.rsi14 for r in down[1:]} == {0.0} and down[-1].obv == -290.0


def test_null_close_is_skipped(spark):
    out = indicators(spark, closes("a", [10.0, None, 14.0]))
    assert [r.ma5 for r in out] == [10.0, 10.0, 12.0]
    assert [r.obv for r in out] == [0.0, 0.0, 0.0]


def test_properties(spark):
    out = indicators(spark, random_rows("a", 400, 9, nulls=False), spans=Spans(60, 100, short=True))
    for r in out:
        assert r.bb_middle == r.ma20 and 0 <= r.rsi14 <= 100
        if r.bb_upper is not None:
            assert abs(r.bb_upper + r.bb_lower - 2 * r.bb_middle) < 1e-9


def test_bars_without_symbol_are_left_out(spark):
    assert indicators(spark, [bar(None, START, 1.0), *closes("a", [1.0])])[0].symbol == "a"


@pytest.mark.parametrize("rows_per_span", [25, 300])
def test_extended_spans_equal_whole_series(spark, rows_per_span):
    families = lambda s: [trend(s), stochastic(s), channel(s), money_flow(s)]
    bars = frame(spark, random_rows("a", 500, 5, nulls=False) + random_rows("b", 200, 6, nulls=False))
    names = ["atr", "plus_di", "minus_di", "adx", "stoch_k", "stoch_d", "cci", "volume_ma20", "mfi"]
    whole = run_families(bars, families(Series(("symbol",)))).collect()
    cut = over_spans(bars, families, REACH, Spans(60, rows_per_span, short=True)).collect()
    assert_rows(cut, {(r.symbol, r.time): r.asDict() for r in whole}, names)


def test_extended_flat_series(spark):
    bars = frame(spark, closes("a", [5.0] * 30))
    out = over_spans(bars, lambda s: [trend(s), stochastic(s), channel(s), money_flow(s)], REACH, Spans())
    for r in out.collect():
        assert r.atr == 0.0 and r.plus_di is None and r.adx is None
        assert r.stoch_k is None and r.cci is None and r.mfi == 100.0


def test_atr_and_direction_by_hand(spark):
    rows = [bar("a", START, 10.0, high=11.0, low=9.0), bar("a", START + 60, 12.0, high=13.0, low=10.0)]
    bars = frame(spark, rows)
    first, second = over_spans(bars, lambda s: [trend(s)], REACH, Spans()).orderBy("time").collect()
    assert (first.atr, first.plus_di, first.minus_di) == (2.0, 0.0, 0.0)
    assert second.atr == 2.5 and second.plus_di == 100 * 2 / 5 and second.minus_di == 0.0
    assert first.adx is None and second.adx == 100.0


def test_pivots_use_the_last_day_with_bars(spark):
    rows = [bar("a", START, 10.0, high=12.0, low=8.0), bar("a", START + 60, 11.0, high=13.0, low=9.0),
            bar("a", START + 5 * 86_400, 20.0)]
    bars = frame(spark, rows)
    out = with_pivots(bars).orderBy("time").collect()
    assert out[0].pivot is None
    p = (13.0 + 8.0 + 11.0) / 3
    last = out[2]
    assert last.pivot == pytest.approx(p)
    assert (last.resistance1, last.support1) == (pytest.approx(2 * p - 8), pytest.approx(2 * p - 13))
    assert (last.resistance2, last.support2) == (pytest.approx(p + 5), pytest.approx(p - 5))
    assert (last.resistance3, last.support3) == (pytest.approx(13 + 2 * (p - 8)), pytest.approx(8 - 2 * (13 - p)))
    assert pivot_levels(bars).count() == 2


def test_all_columns_at_once(spark):
    rows = random_rows("a", 300, 7, nulls=False)
    out = with_indicators(frame(spark, rows), spans=Spans(60, 90, short=True), extended=True)
    assert out.count() == 300
    assert set(CORE_INDICATORS + EXTENDED_INDICATORS) <= set(out.columns)
    late = out.orderBy(F.col("time").desc()).first()
    assert all(late[c] is not None for c in CORE_INDICATORS + EXTENDED_INDICATORS)


def test_means_over_windows_of_any_size(spark):
    """Sizes that blocks of 20 rows do not divide, over a series with NULLs, against plain frames."""
    sizes = [7, 40, 41, 59, 60, 137, 200]
    rows = random_rows("a", 330, 21)
    series = Series(("symbol",))
    found = run_families(frame(spark, rows), [rolling_means("close", sizes, series, lambda n: f"mean{n}")]).orderBy("time").collect()
    values = [r[6] for r in sorted(rows, key=lambda r: r[2])]
    for i, row in enumerate(found):
        for n in sizes:
            held = [v for v in values[max(0, i - n + 1):i + 1] if v is not None]
            want = sum(held) / len(held) if held else None
            assert (row[f"mean{n}"] is None) == (want is None) and (want is None or abs(row[f"mean{n}"] - want) < 1e-9)


def test_means_slide_over_five_rows_at_most():
    """A sliding frame is summed anew for every row, so longer windows are put together by lags."""
    steps = rolling_means("close", [5, 12, 20, 26, 50, 200], Series(("symbol",)), str)
    frames = [text for step in steps for text in step.values() if text.startswith("sum(")]
    assert frames and all(int(text.split("BETWEEN ")[1].split()[0]) <= 4 for text in frames)
    assert not any("avg(" in text for step in steps for text in step.values())


def test_rounded_equals_round(spark):
    rnd = random.Random(11)
    values = [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 18) for _ in range(4_000)]
    values += [rnd.randint(-10**7, 10**7) / 10.0**5 for _ in range(2_000)]
    values += [(rnd.randint(-10**6, 10**6) + 0.5) / 10.0**k for k in (0, 4, 9) for _ in range(1_000)]
    values += [0.0, -0.0, -1e-9, 0.49999999999999994, float("nan"), float("inf"), float("-inf"), None, 2.0**53, -1e300, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for decimals in (0, 4, 9):
        both = df.select("x", rounded(F.col("x"), decimals).alias("a"), F.round("x", decimals).alias("b")).collect()
        assert [r for r in both if repr(r.a) != repr(r.b)] == []
