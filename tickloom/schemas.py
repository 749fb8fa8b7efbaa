"""Column contracts shared by batch jobs, streams and tests."""

from pyspark.sql import types as T

# ---- Fixed values: names, order and types of the public contracts ----------

MESSAGE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("epoch_ms", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

KEY_COLUMNS = ["symbol", "day", "time"]
PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]
BAR_COLUMNS = KEY_COLUMNS + PRICE_COLUMNS

CORE_INDICATORS = [
    "ma5", "ma10", "ma20", "ma50", "ma100", "ma200",
    "bb_upper", "bb_middle", "bb_lower",
    "macd_line", "macd_signal", "macd_histogram",
    "rsi14", "obv",
]
EXTENDED_INDICATORS = [
    "adx", "plus_di", "minus_di", "stoch_k", "stoch_d", "cci", "atr",
    "parabolic_sar", "volume_ma20", "mfi",
    "pivot", "support1", "support2", "support3",
    "resistance1", "resistance2", "resistance3",
]
INDICATOR_COLUMNS = BAR_COLUMNS + CORE_INDICATORS + EXTENDED_INDICATORS

# Which columns make up the key of the enriched table, and how.
KEY_KINDS = {"symbol": "PARTITION KEY", "day": "PARTITION KEY", "time": "CLUSTERING KEY"}

# ---- Derived schemas --------------------------------------------------------

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("time", T.LongType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in PRICE_COLUMNS]
)

# The stored table keeps full precision; plans.rows narrows it for consumers
# that expect 4-byte floats and whole volumes.
# Where a bar's message stands in the order of arrival, as one number.
ARRIVAL = T.DecimalType(38, 0)

INDICATOR_SCHEMA = T.StructType(
    BAR_SCHEMA.fields
    + [T.StructField(name, T.DoubleType()) for name in CORE_INDICATORS + EXTENDED_INDICATORS]
)
