"""Helpers shared by the operators."""

import ctypes
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import delete_path, forget_later, scratch_path, settle

#: Rows that a Python worker gets at a time, at most: texts can be long.
BATCH_ROWS = 2000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

TABLE_COLUMNS = {
    "documents": {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"},
    "pages": {"page_id": "long", "url": "string", "html": "string"},
    "embeddings": {"vec_id": "long", "embedding": "array<float>", "label": "int"},
    "labels": {"doc_id": "long", "quality": "int", "toxic": "int"},
    "benchmark": {"item_id": "long", "text": "string"},
    "conversations": {"conv_id": "long", "turn": "long", "role": "string", "text": "string"},
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table with the columns it is known for; others are left out."""
    return known_columns(spark.read.parquet(f"{folder}/{name}.parquet"), name)


def known_columns(df: DataFrame, table: str) -> DataFrame:
    """The columns of ``table`` in fixed order and type, whatever else ``df`` carries.

    Sees to it that Python workers get the rows in batches of bounded size.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_ROWS)) > BATCH_ROWS:
        conf.set(_BATCH_ROWS, BATCH_ROWS)
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in TABLE_COLUMNS[table].items()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


#: What empties the caches that operators keep in a worker from one task to the next.
_forgets: list[Callable[[], None]] = []
#: Seconds between two returns of freed memory, and when the last one was.
RETURN_EVERY = 1.0
_returned = [float("-inf")]


def kept_in_worker(forget: Callable[[], None]) -> None:
    """Let ``release_memory`` empty a cache by ``forget``."""
    _forgets.append(forget)


def release_memory() -> None:
    """Empty the caches of other operators in this worker, and give freed memory back to the system.

    Workers live on from stage to stage. Without this each of them keeps the
    models of earlier stages, and the memory of its largest task so far, next to
    an executor's heap. Called by tasks of operators that keep nothing themselves.
    """
    for forget in _forgets:
        forget()
    now = time.monotonic()
    if now - _returned[0] < RETURN_EVERY:
        return
    _returned[0] = now
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # of glibc
        trim(0)


#: Names of drawn rows that are sent to every task.
BROADCAST_NAMES = 100_000


def sampled(df: DataFrame, rows: int, *, by: str) -> DataFrame:
    """About ``rows`` rows of every value of ``by``, chosen by a hash of the whole row.

    Equal rows are counted one by one: a row that is there many times is drawn as
    often as its share asks, not all or none. A value of ``by`` with fewer rows is
    taken whole, a null value not at all. Only hashes are shuffled, and of each
    drawn row as many copies as are wanted.
    """
    name, value = free_name(df, "_name"), free_name(df, "_value")
    named = df.withColumn(name, F.xxhash64(*df.columns))
    counts = named.where(F.col(by).isNotNull()).groupBy(F.col(by).alias(value), name).agg(F.count("*").alias("_copies"))
    sizes = counts.groupBy(value).agg(F.sum("_copies").alias("_rows"))
    share = F.least(F.col("_copies"), F.col("_copies") * rows / F.col("_rows"))
    draw = F.pmod(F.xxhash64(name, F.lit(17)), F.lit(1_000_000)) / 1_000_000
    chosen = settle(
        counts.join(sizes, value).select(value, name, (F.floor(share) + (draw < share - F.floor(share)).cast("int")).alias("_take"))
        .where("_take > 0"),
        "drawn")
    if chosen.count() <= BROADCAST_NAMES:
        chosen = F.broadcast(chosen)
    found = named.join(chosen.withColumnRenamed(name, "_drawn"), (F.col(by) == F.col(value)) & (F.col(name) == F.col("_drawn")))
    copy = F.row_number().over(Window.partitionBy(name).orderBy(name))
    # The fixed bound lets Spark cut each task's copies before they are shuffled.
    return found.withColumn("_copy", copy).where((F.col("_copy") <= rows) & (F.col("_copy") <= F.col("_take"))).select(*df.columns)


class Tables:
    """Tables that one computation writes, each deleted as soon as it is not needed any more.

    What is left goes with ``clear_settled``, at the latest when the program ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root = spark, scratch_path(spark, purpose)
        forget_later(spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back; what ``name`` was before stays until it is dropped."""
        return settle(df, name, f"{self.root}/{name}")

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` has returned, once nothing unfinished reads them."""
        for table in tables:
            for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
                if "/" + self.root.rsplit("/", 1)[-1] + "/" in path:
                    delete_path(self.spark, path)
