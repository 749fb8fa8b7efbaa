"""Session settings and the shared folder."""

import atexit
import contextlib
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on.

    Days and times are UTC days and times, whatever the cluster's zone. The JVM
    never compiles methods of more than 8,000 bytes, which one generated function
    for all indicators of a row is; Spark cuts it into small ones beyond this limit.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tickloom-")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it, as in tests: driver and executors are
    the same machine there, and it gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_deleted(spark: SparkSession):
    """Queries that start here delete their shuffle files when they end, not when the driver collects garbage."""
    before = spark.conf.get(_DELETE_SHUFFLES, "false")
    spark.conf.set(_DELETE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DELETE_SHUFFLES, before)


# Tables written by ``settle`` and not deleted yet.
_settled: list[tuple[SparkSession, str]] = []


def settle(df: DataFrame, purpose: str, folder: str | None = None, reader: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    The result is a columnar table: later readers prune columns, and a lost
    executor costs a re-read instead of a recomputation. ``folder`` collects
    tables that a caller deletes together when it is done with them; others are
    there until ``clear_settled``, at the latest until the program ends.
    ``reader`` is the session that the table is read in, if it is another one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose) if folder is None else f"{folder}/{purpose}-{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    with _shuffles_deleted(spark):
        df.write.parquet(path)
    if folder is None:
        _settled.append((spark, path))
    return (reader or spark).read.schema(schema).parquet(path)


def forget_later(spark: SparkSession, path: str) -> None:
    """Let ``clear_settled`` delete a folder of tables."""
    _settled.append((spark, path))


def clear_settled() -> None:
    """Delete the tables of all results that are not needed any more: those from before this call."""
    while _settled:
        spark, path = _settled.pop()
        if spark.sparkContext._jsc is not None:
            delete_path(spark, path)


atexit.register(clear_settled)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none where it is missing."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def folder_bytes(spark: SparkSession, path: str) -> int:
    files, target = _file_system(spark, path)
    return files.getContentSummary(target).getLength()


def small_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session for queries over few rows: one job each, and no more shuffle partitions than named.

    Settings are those of ``spark`` but for adaptive execution, which makes a job
    of every stage. Temporary views are not shared.
    """
    small = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if small.conf.isModifiable(name):
            small.conf.set(name, value)
    small.conf.set("spark.sql.adaptive.enabled", "false")
    small.conf.set("spark.sql.shuffle.partitions", str(min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return small


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, from whichever file system holds it."""
    files, target = _file_system(spark, path)
    files.delete(target, True)
