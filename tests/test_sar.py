import random

import pytest

from series import START, bar, closes, frame, random_rows
from tickloom.operators.sar import next_state, with_sar
from tickloom.operators.spans import Spans


def one_walk(rows):
    state, out = None, {}
    for r in sorted(rows, key=lambda r: r[2]):
        if r[4] is None or r[5] is None:
            out[(r[0], r[2])] = None
        else:
            state = next_state(state, r[4], r[5])
            out[(r[0], r[2])] = state.sar
    return out


def check(spark, rows, spans):
    expected = {}
    for symbol in {r[0] for r in rows}:
        expected |= one_walk([r for r in rows if r[0] == symbol])
    random.Random(0).shuffle(rows)
    found = {(r.symbol, r.time): r.parabolic_sar for r in with_sar(frame(spark, rows), spans=spans).collect()}
    assert found == expected


def test_spans_equal_one_walk(spark):
    check(spark, random_rows("a", 400, 1) + random_rows("b", 150, 2, gaps=False), Spans(60, 50, short=True))


def test_trend_without_flips_takes_more_rounds(spark):
    check(spark, closes("a", [float(i) for i in range(1, 61)]), Spans(60, 12, short=True))


def test_rows_without_prices(spark):
    rows = random_rows("a", 60, 3)
    rows[10] = rows[10][:4] + (None, None) + rows[10][6:]
    check(spark, rows, Spans(60, 15, short=True))


def test_by_hand(spark):
    highs_lows = [(11.0, 9.0), (12.0, 10.0), (13.0, 11.0), (9.0, 7.0), (8.0, 6.0)]
    rows = [bar("a", START + 60 * i, h, high=h, low=low) for i, (h, low) in enumerate(highs_lows)]
    out = [r.parabolic_sar for r in with_sar(frame(spark, rows)).orderBy("time").collect()]
    # Rising from the first low; the fourth bar falls through and turns the trend.
    second = min(9.0 + 0.02 * (11.0 - 9.0), 9.0)
    third = min(second + 0.04 * (12.0 - second), 9.0)
    assert out[:3] == [9.0, second, third]
    assert out[3] == 13.0
    assert out[4] == max(13.0 + 0.02 * (7.0 - 13.0), 13.0)


@pytest.mark.parametrize("reset", ["none", "day"])
def test_sar_lies_on_the_far_side(spark, reset):
    # Without outside bars, which may turn a trend and pass its extreme at once.
    rng = random.Random(8)
    rows = closes("a", [100 + rng.randrange(-50, 50) / 4 for _ in range(200)], step=1_800)
    for r in with_sar(frame(spark, rows), reset).collect():
        assert r.parabolic_sar <= r.low or r.parabolic_sar >= r.high
