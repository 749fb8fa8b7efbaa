"""Where message streams come from and go to."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from tickloom.functions.clock import shifted
from tickloom.schemas import ARRIVAL

# The topic of candle messages.
TOPIC = "crypto_candles"


def kafka_reader(spark: SparkSession, servers: str, topic: str = TOPIC, offsets: str = "latest") -> DataStreamReader:
    """Reader of the message topic; arrival order is (timestamp, partition, offset)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
    )


def kafka_messages(records: DataFrame) -> DataFrame:
    """Records of the topic (``value, timestamp, partition, offset``) to ``value`` and ``arrival``.

    ``arrival`` orders messages by timestamp, then partition, then offset: 13
    digits of milliseconds, 5 of the partition and 19 of the offset.
    """
    digits = shifted(F.unix_millis("timestamp"), 24) + shifted(F.col("partition"), 19) + F.col("offset").cast(ARRIVAL)
    return records.select(F.col("value").cast("string").alias("value"), digits.cast(ARRIVAL).alias("arrival"))


def kafka_stream(spark: SparkSession, servers: str, topic: str = TOPIC, offsets: str = "latest") -> DataFrame:
    """The topic as a stream of messages; needs the Kafka connector on the cluster."""
    return kafka_messages(kafka_reader(spark, servers, topic, offsets).load())


def kafka_sink(messages: DataFrame, servers: str, checkpoint: str, trigger: dict, topic: str = TOPIC) -> StreamingQuery:
    """Send a stream of ``encode_messages`` rows to the topic."""
    return (
        messages.writeStream.format("kafka").options(**kafka_sink_options(servers, topic))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def kafka_sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Options for writing ``encode_messages`` rows to the topic."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def file_messages(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Messages from Parquet files with ``value`` and ``seq`` (arrival number)."""
    return (
        spark.readStream.schema("value string, seq bigint")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )
