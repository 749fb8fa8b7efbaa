"""Ticks and bars out of the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import instant, shifted
from tickloom.functions.numbers import rounded
from tickloom.schemas import ARRIVAL


def as_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks: the event type trades as a symbol."""
    return events.select(
        F.col("event_type").alias("symbol"),
        instant(F.col("ts")).alias("ts"),
        F.col("event_id").alias("tick_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
    )


def read_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return as_ticks(spark.read.parquet(f"{folder}/events.parquet"))


def read_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as ticks: many symbols (suppliers) with sparse days.

    Prices are whole cents, so that sums of them are exact. A day's lines are in
    order of all their columns, as no two or three of them are unique.
    """
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("cents", rounded(F.col("l_extendedprice") * 100, 0))
    # Long numbers are slow, so neighbours that fit into 18 digits are joined as bigint.
    high = F.col("l_orderkey").cast("bigint") * 100 + F.col("l_linenumber").cast("bigint")
    middle = F.col("l_partkey").cast("bigint") * 1_000_000_000 + F.col("cents").cast("bigint")
    line = shifted(high, 21) + shifted(middle, 3) + F.col("l_quantity").cast("decimal(38,0)")
    return lines.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        instant(F.col("l_shipdate")).alias("ts"),
        line.cast(ARRIVAL).alias("line"),
        F.col("cents").alias("price"),
        F.col("l_quantity").alias("size"),
    )
