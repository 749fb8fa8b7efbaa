"""Small bar series and straightforward indicator formulas to compare with."""

import random
import statistics
from datetime import datetime, timezone

from pyspark.sql import types as T

from tickloom.schemas import BAR_SCHEMA

START = 1_704_067_200  # 2024-01-01 00:00 UTC


def bar(symbol, time, close, volume=10.0, high=None, low=None):
    day = datetime.fromtimestamp(time, timezone.utc).date()
    if close is None:
        return (symbol, day, time, None, high, low, None, volume)
    return (symbol, day, time, close, close if high is None else high, close if low is None else low, close, volume)


def frame(spark, rows):
    return spark.createDataFrame(rows, BAR_SCHEMA)


def closes(symbol, prices, step=60, start=START, volume=10.0):
    return [bar(symbol, start + step * i, p, volume) for i, p in enumerate(prices)]


def random_rows(symbol, n, seed, step=60, gaps=True, nulls=True):
    """A random walk with gaps and NULL closes."""
    rng = random.Random(seed)
    rows, time, price = [], START + rng.randrange(50) * step, 100.0
    for _ in range(n):
        price = max(1.0, round(price + rng.choice([-1.5, -0.25, 0.0, 0.25, 1.75]), 2))
        close = None if nulls and rng.random() < 0.05 else price
        high, low = round(price + rng.random(), 2), round(price - rng.random(), 2)
        rows.append(bar(symbol, time, close, float(rng.randrange(1, 50)), high, low))
        time += step * (rng.choice([1, 1, 1, 1, 7, 200]) if gaps else 1)
    return rows


def _mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def core_by_hand(rows):
    """The core indicators of one symbol's bars, row by row."""
    rows = sorted(rows, key=lambda r: r[2])
    close, volume = [r[6] for r in rows], [r[7] for r in rows]
    out, lines, gains, losses, obv = [], [], [], [], 0.0
    for i in range(len(rows)):
        last = lambda n, xs=close: xs[max(0, i - n + 1):i + 1]
        row = {f"ma{n}": _mean(last(n)) for n in (5, 10, 20, 50, 100, 200)}
        band = [v for v in last(20) if v is not None]
        spread = statistics.stdev(band) if len(band) > 1 else None
        row["bb_middle"] = row["ma20"]
        row["bb_upper"] = None if spread is None else row["ma20"] + 2 * spread
        row["bb_lower"] = None if spread is None else row["ma20"] - 2 * spread
        fast, slow = _mean(last(12)), _mean(last(26))
        lines.append(None if fast is None or slow is None else fast - slow)
        row["macd_line"], row["macd_signal"] = lines[-1], _mean(lines[max(0, i - 8):])
        ok = row["macd_line"] is not None and row["macd_signal"] is not None
        row["macd_histogram"] = row["macd_line"] - row["macd_signal"] if ok else None
        known = i > 0 and close[i] is not None and close[i - 1] is not None
        move = close[i] - close[i - 1] if known else 0.0
        gains.append(max(move, 0.0))
        losses.append(max(-move, 0.0))
        gain, loss = _mean(gains[max(0, i - 13):]), _mean(losses[max(0, i - 13):])
        row["rsi14"] = 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
        obv += volume[i] if move > 0 else -volume[i] if move < 0 else 0.0
        row["obv"] = obv
        out.append(row)
    return {(r[0], r[2]): row for r, row in zip(rows, out)}


def assert_rows(found, expected, columns):
    """``found``: collected rows; ``expected``: by (symbol, time)."""
    assert len(found) == len(expected)
    for r in found:
        want = expected[(r.symbol, r.time)]
        for c in columns:
            a, b = r[c], want[c]
            assert (a is None) == (b is None), (r.symbol, r.time, c, a, b)
            assert a is None or abs(a - b) < 1e-8, (r.symbol, r.time, c, a, b)


VERSIONED = T.StructType([*BAR_SCHEMA.fields, T.StructField("seq", T.LongType())])
