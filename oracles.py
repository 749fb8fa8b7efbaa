"""The same queries as plain SQL over the given tables, for checking."""

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts, event_id AS tick_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events)"""

HOURLY = TICKS + """,
bars AS (
  SELECT symbol, strftime(date_trunc('hour', ts), '%Y-%m-%d') AS day,
         CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS time,
         arg_min(price, (ts, tick_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (ts, tick_id)) AS close, CAST(sum(size) AS DOUBLE) AS volume
  FROM ticks GROUP BY symbol, date_trunc('hour', ts))"""

SALES = """bars AS (
  SELECT symbol, day, time, arg_min(price, o) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, o) AS close, CAST(sum(size) AS DOUBLE) AS volume
  FROM (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS day,
               CAST(epoch(date_trunc('day', l_shipdate)) AS BIGINT) AS time,
               round(l_extendedprice * 100) AS price, l_quantity AS size,
               (l_shipdate, l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * 100), l_quantity) AS o
        FROM lineitem)
  GROUP BY symbol, day, time)"""


def core(part: str) -> str:
    """CTE ``ind``: the core indicators, as windows over all bars of ``part``."""
    def rows(n):
        return f"(PARTITION BY {part} ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    series = f"(PARTITION BY {part} ORDER BY time)"
    return f"""steps AS (
  SELECT *, close - lag(close) OVER {series} AS move,
         {", ".join(f"avg(close) OVER {rows(n)} AS ma{n}" for n in (5, 10, 20, 50, 100, 200))},
         stddev_samp(close) OVER {rows(20)} AS spread,
         avg(close) OVER {rows(12)} - avg(close) OVER {rows(26)} AS macd_line
  FROM bars),
signals AS (
  SELECT *, avg(macd_line) OVER {rows(9)} AS macd_signal,
         avg(CASE WHEN move > 0 THEN move ELSE 0 END) OVER {rows(14)} AS gain,
         avg(CASE WHEN move < 0 THEN -move ELSE 0 END) OVER {rows(14)} AS loss,
         CAST(sum(CASE WHEN move > 0 THEN volume WHEN move < 0 THEN -volume ELSE 0 END)
              OVER (PARTITION BY {part} ORDER BY time ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS obv
  FROM steps),
ind AS (
  SELECT *, ma20 + 2 * spread AS bb_upper, ma20 AS bb_middle, ma20 - 2 * spread AS bb_lower,
         macd_line - macd_signal AS macd_histogram,
         CASE WHEN loss = 0 THEN 100.0::DOUBLE ELSE 100 - 100 / (1 + gain / loss) END AS rsi14
  FROM signals)"""


CORE = ["ma5", "ma10", "ma20", "ma50", "ma100", "ma200", "bb_upper", "bb_middle", "bb_lower",
        "macd_line", "macd_signal", "macd_histogram", "rsi14", "obv"]


EXTENDED = ["adx", "plus_di", "minus_di", "stoch_k", "stoch_d", "cci", "atr", "parabolic_sar",
            "volume_ma20", "mfi", "pivot", "support1", "support2", "support3",
            "resistance1", "resistance2", "resistance3"]


def rounded(*columns: str, decimals: int = 9) -> str:
    return ", ".join(f'round("{c}", {decimals}) + 0.0 AS "{c}"' for c in columns)


def rounded_of(table: str, *columns: str) -> str:
    return ", ".join(f'round({table}."{c}", 9) + 0.0 AS "{c}"' for c in columns)


def narrow(*columns: str) -> str:
    return ", ".join(f"CAST(round({c}, 9) + 0.0 AS FLOAT) AS {c}" for c in columns)


def indicators(*columns: str, part: str = "symbol", bars: str = HOURLY, decimals: int = 9) -> str:
    return f"""WITH {bars}, {core(part)}
SELECT symbol, day, time, {rounded('close', *columns, decimals=decimals)} FROM ind"""


def extended(part: str = "symbol") -> str:
    """CTE ``ext``: the windowed extended indicators."""
    def rows(n):
        return f"(PARTITION BY {part} ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    series = f"(PARTITION BY {part} ORDER BY time)"
    return f"""e1 AS (
  SELECT *, (high + low + close) / 3 AS tp, lag(close) OVER {series} AS pc,
         high - lag(high) OVER {series} AS rise, lag(low) OVER {series} - low AS fall,
         min(low) OVER {rows(14)} AS lowest, max(high) OVER {rows(14)} AS highest,
         avg(volume) OVER {rows(20)} AS volume_ma20
  FROM bars),
e2 AS (
  SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
         CASE WHEN rise > fall AND rise > 0 THEN rise ELSE 0 END AS dmp,
         CASE WHEN fall > rise AND fall > 0 THEN fall ELSE 0 END AS dmm,
         CASE WHEN highest <> lowest THEN 100 * (close - lowest) / (highest - lowest) END AS stoch_k,
         list(tp) OVER {rows(20)} AS tps, avg(tp) OVER {rows(20)} AS mtp,
         tp - lag(tp) OVER {series} AS dtp
  FROM e1),
e3 AS (
  SELECT *, avg(tr) OVER {rows(14)} AS atr, sum(tr) OVER {rows(14)} AS str,
         sum(dmp) OVER {rows(14)} AS sp, sum(dmm) OVER {rows(14)} AS sm,
         avg(stoch_k) OVER {rows(3)} AS stoch_d,
         list_sum(list_transform(tps, lambda z: abs(z - mtp))) / len(tps) AS dev,
         sum(CASE WHEN dtp > 0 THEN tp * volume ELSE 0 END) OVER {rows(14)} AS inflow,
         sum(CASE WHEN dtp < 0 THEN tp * volume ELSE 0 END) OVER {rows(14)} AS outflow
  FROM e2),
e4 AS (
  SELECT *, CASE WHEN str <> 0 THEN 100 * sp / str END AS plus_di,
         CASE WHEN str <> 0 THEN 100 * sm / str END AS minus_di,
         CASE WHEN sp + sm <> 0 THEN 100 * abs(sp - sm) / (sp + sm) END AS dx,
         CASE WHEN dev > 1e-12 THEN (tp - mtp) / (0.015::DOUBLE * dev) END AS cci,
         CASE WHEN outflow = 0 THEN 100.0::DOUBLE ELSE 100 - 100 / (1 + inflow / outflow) END AS mfi
  FROM e3),
ext AS (SELECT *, avg(dx) OVER {rows(14)} AS adx FROM e4)"""


def extended_report(*columns: str) -> str:
    return f"WITH {HOURLY}, {extended()} SELECT symbol, day, time, {rounded(*columns)} FROM ext"


PIVOTS = """days AS (SELECT symbol, day, max(high) AS h, min(low) AS l, arg_max(close, time) AS c
  FROM bars GROUP BY symbol, day),
before AS (
  SELECT symbol, day, lag(h) OVER w AS h, lag(l) OVER w AS l, lag(c) OVER w AS c FROM days
  WINDOW w AS (PARTITION BY symbol ORDER BY day)),
levels AS (
  SELECT symbol, day, p AS "pivot", 2 * p - h AS support1, p - (h - l) AS support2,
         l - 2 * (h - p) AS support3, 2 * p - l AS resistance1, p + (h - l) AS resistance2,
         h + 2 * (p - l) AS resistance3
  FROM (SELECT *, (h + l + c) / 3 AS p FROM before))"""

LEVELS = ("pivot", "support1", "support2", "support3", "resistance1", "resistance2", "resistance3")

# One step of the recursion per bar; the first bar of a symbol starts a rise.
SAR = """num AS (
  SELECT symbol, day, time, high, low, row_number() OVER (PARTITION BY symbol ORDER BY time) AS rn
  FROM bars),
walk AS (
  SELECT symbol, day, time, rn, true AS up, low AS sar, high AS ep, 0.02::DOUBLE AS af,
         high AS h1, high AS h2, low AS l1, low AS l2
  FROM num WHERE rn = 1
  UNION ALL
  SELECT symbol, day, time, rn, up <> flip AS up,
         CASE WHEN flip THEN ep ELSE cap END AS sar,
         CASE WHEN flip AND up THEN low WHEN flip THEN high WHEN up THEN greatest(ep, high)
              ELSE least(ep, low) END AS ep,
         CASE WHEN flip THEN 0.02::DOUBLE
              WHEN (up AND high > ep) OR (NOT up AND low < ep) THEN least(af + 0.02::DOUBLE, 0.2::DOUBLE)
              ELSE af END AS af,
         high AS h1, h1 AS h2, low AS l1, l1 AS l2
  FROM (SELECT *, CASE WHEN up THEN low < cap ELSE high > cap END AS flip
        FROM (SELECT n.symbol, n.day, n.time, n.rn, n.high, n.low, w.up, w.ep, w.af, w.h1, w.l1,
                     CASE WHEN w.up THEN least(w.sar + w.af * (w.ep - w.sar), w.l1, w.l2)
                          ELSE greatest(w.sar + w.af * (w.ep - w.sar), w.h1, w.h2) END AS cap
              FROM walk w JOIN num n ON n.symbol = w.symbol AND n.rn = w.rn + 1)))"""

def json_bar(datetime: str = "strftime(to_timestamp(time) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')") -> str:
    """A bar as the text of its message."""
    return f"""'{{"symbol":"' || symbol || '","interval":"1h","datetime":"' || {datetime}
    || '","epoch_ms":' || CAST(time * 1000 AS VARCHAR) || ',"open":' || CAST(open AS VARCHAR)
    || ',"high":' || CAST(high AS VARCHAR) || ',"low":' || CAST(low AS VARCHAR)
    || ',"close":' || CAST(close AS VARCHAR) || ',"volume":' || CAST(volume AS VARCHAR) || '}}'"""


def priced_bar(epoch: str, close: str) -> str:
    """A message with prices and no time text."""
    return f"""'{{"symbol":"' || symbol || '","epoch_ms":' || CAST({epoch} AS VARCHAR) || ',"open":' || CAST(open AS VARCHAR)
    || ',"high":' || CAST(high AS VARCHAR) || ',"low":' || CAST(low AS VARCHAR) || ',"close":' || {close} || '}}'"""


def newest_first(where: str, limit: int | None = None) -> str:
    return f"""WITH {HOURLY} SELECT symbol, day, time, {rounded(*PRICES)} FROM bars
WHERE {where} ORDER BY day DESC, time DESC, symbol {"" if limit is None else f"LIMIT {limit}"}"""


def last_bars(n: int) -> str:
    return f"""WITH {HOURLY} SELECT symbol, day, time, {rounded(*PRICES)} FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) <= {n}"""


PRICES = ("open", "high", "low", "close", "volume")

ORACLES = {
    "candles_1h": f"WITH {HOURLY} SELECT symbol, day, time, {rounded(*PRICES)} FROM bars",
    "sales_candles": f"WITH {SALES} SELECT symbol, day, time, {rounded(*PRICES)} FROM bars",
    "moving_averages": indicators("ma5", "ma10", "ma20", "ma50", "ma100", "ma200"),
    "bollinger": indicators("bb_upper", "bb_middle", "bb_lower"),
    "macd": indicators("macd_line", "macd_signal", "macd_histogram"),
    "rsi": indicators("rsi14"),
    "obv": indicators("obv"),
    "core_indicators": indicators(*CORE),
    "indicators_daily_reset": indicators(*CORE, part="symbol, day"),
    "sales_indicators": indicators(*CORE, bars=SALES, decimals=4),
    "atr": extended_report("atr"),
    "adx": extended_report("plus_di", "minus_di", "adx"),
    "stochastic": extended_report("stoch_k", "stoch_d"),
    "cci": extended_report("cci"),
    "volume_ma_mfi": extended_report("volume_ma20", "mfi"),
    "pivots": f"""WITH {HOURLY}, {PIVOTS}
SELECT symbol, day, time, {rounded(*LEVELS)} FROM bars LEFT JOIN levels USING (symbol, day)""",
    "parabolic_sar": f"""WITH RECURSIVE {HOURLY}, {SAR}
SELECT symbol, day, time, round(sar, 9) + 0.0 AS parabolic_sar FROM walk""",
    "all_indicators": f"""WITH RECURSIVE {HOURLY}, {core("symbol")}, {extended()}, {PIVOTS}, {SAR}
SELECT ind.symbol, ind.day, ind.time, {rounded_of("ind", *PRICES, *CORE)},
       {rounded_of("ext", "adx", "plus_di", "minus_di", "stoch_k", "stoch_d", "cci", "atr",
                   "volume_ma20", "mfi")},
       round(walk.sar, 9) + 0.0 AS parabolic_sar, {rounded_of("levels", *LEVELS)}
FROM ind JOIN ext USING (symbol, time) JOIN walk USING (symbol, time)
LEFT JOIN levels ON levels.symbol = ind.symbol AND levels.day = ind.day""",
    "indicator_row_compat": f"""WITH {HOURLY}, {core("symbol")}
SELECT symbol, day, time, {narrow("open", "high", "low", "close", *CORE)},
       CAST(trunc(volume) AS BIGINT) AS volume,
       {", ".join(f'NULL::FLOAT AS "{c}"' for c in EXTENDED)} FROM ind""",
    "parse_messages": f"WITH {HOURLY} SELECT symbol, day, time, {rounded(*PRICES)} FROM bars",
    "quarantine": f"""WITH {HOURLY}
SELECT '{{"epoch_ms":' || CAST(time * 1000 AS VARCHAR) || ',"close":' || CAST(close AS VARCHAR) || '}}' AS value,
       'no symbol' AS reason FROM bars
UNION ALL
SELECT '{{"symbol":"' || symbol || '","close":' || CAST(close AS VARCHAR) || '}}', 'no time' FROM bars
UNION ALL
SELECT {priced_bar("time", "CAST(close AS VARCHAR)")}, 'implausible time' FROM bars
UNION ALL
SELECT {priced_bar("time * 1000", """'"n/a"'""")}, 'no price' FROM bars
UNION ALL SELECT props, 'no symbol, no time' FROM events
UNION ALL SELECT c_name, 'no symbol, no time' FROM customer""",
    "encode_messages": f"WITH {HOURLY} SELECT symbol AS key, {json_bar()} AS value FROM bars",
    "decode_klines": f"""WITH {HOURLY} SELECT symbol, '1h' AS "interval",
  strftime(to_timestamp(time) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS datetime,
  time * 1000 AS epoch_ms, open, high, low,
  CASE WHEN symbol NOT IN ('signup', 'view') THEN close END AS close,
  CASE WHEN symbol <> 'view' THEN volume END AS volume FROM bars""",
    "dedup_latest": f"""WITH {TICKS}
SELECT symbol, strftime(ts, '%Y-%m-%d') AS day, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS time,
       price AS close, CAST(size AS DOUBLE) AS volume, tick_id FROM ticks
QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('hour', ts) ORDER BY ts DESC, tick_id DESC) = 1""",
    "newest_bar": last_bars(1),
    "history_lookback": last_bars(200),
    "display_bars": f"""WITH {HOURLY} SELECT symbol, day, time, {rounded(*PRICES)},
  strftime(to_timestamp(time) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS bar_ts,
  strftime(to_timestamp(time) AT TIME ZONE 'UTC', '%H:%M:%S') AS clock FROM bars""",
    "quarantine_counts": f"""WITH {HOURLY}, sent AS (SELECT count(*) AS n FROM bars)
SELECT 'no symbol' AS reason, n AS messages FROM sent
UNION ALL SELECT 'no time', n FROM sent
UNION ALL SELECT 'implausible time', n FROM sent
UNION ALL SELECT 'no price', n FROM sent
UNION ALL SELECT 'no symbol, no time', (SELECT count(*) FROM events) + (SELECT count(*) FROM customer)""",
    "enrich_batch": f"""{indicators(*CORE)}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) <= 24""",
    "store_upsert": f"""WITH {HOURLY}
SELECT symbol, day, time, {rounded("open", "high", "low", "close")},
       CASE WHEN time % 86400 < 43200 THEN 2 * volume ELSE volume END AS volume FROM bars""",
    "late_recompute": indicators(*CORE),
    "late_mixed_whole": indicators(*CORE, bars=HOURLY.replace("bars AS (", "hours AS (") + """,
bars AS (
  SELECT * FROM hours
  UNION ALL SELECT symbol || '-sparse', day, time, open, high, low, close, volume FROM hours WHERE time // 3600 % 3 = 0)"""),
    "latest_bars": f"""WITH {HOURLY}, recent AS (
  SELECT *, day < '2024-01-30' AS fallback FROM bars
  WHERE symbol IN ('click', 'view') AND day >= '2024-01-29'),
ranked AS (
  SELECT *, min(fallback) OVER (PARTITION BY symbol) AS best,
         row_number() OVER (PARTITION BY symbol, fallback ORDER BY time DESC) AS rn FROM recent)
SELECT symbol, day, time, {rounded(*PRICES)} FROM ranked WHERE fallback = best AND rn <= 3""",
    "day_bars": newest_first("symbol = 'click' AND day = '2024-01-30'", 10),
    "range_bars": newest_first("symbol = 'view' AND day BETWEEN '2024-01-10' AND '2024-01-20'"),
    "multi_symbol": f"""WITH {HOURLY} SELECT symbol, day, time, {rounded(*PRICES)} FROM bars
WHERE symbol IN ('click', 'view') AND day = '2024-01-30'""",
    "named_range": newest_first("symbol = 'error' AND day BETWEEN '2024-01-24' AND '2024-01-30'"),
    "run_sql": f"""WITH {HOURLY}
SELECT symbol, day, {rounded("high", "low")}, bars FROM (
  SELECT symbol, day, max(high) AS high, min(low) AS low, count(*) AS bars
  FROM bars WHERE symbol IN ('click', 'view') GROUP BY symbol, day)""",
    # A bar is final once the newest event lies behind its hour.
    "stream_candles": f"""WITH {HOURLY}
SELECT symbol, day, time, {rounded(*PRICES)},
       time + 3600 <= (SELECT epoch(max(ts)) FROM events) AS is_final FROM bars""",
    "stream_dedup": f"WITH {TICKS} SELECT symbol, tick_id, {rounded('price')}, size FROM ticks",
    "stream_enrich": indicators(*CORE),
}
# The same rows, whether they come late or in several parts.
ORACLES["late_offsets"] = ORACLES["stream_all_indicators"] = ORACLES["all_indicators"]
