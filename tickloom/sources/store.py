"""The table of enriched bars: Parquet by day and batch, read as the newest version of every bar."""

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.candles import with_final_flag
from tickloom.operators.enrich import HISTORY_ROWS, newest
from tickloom.operators.sar import AT_STATE
from tickloom.operators.segments import RECORD_COLUMNS
from tickloom.schemas import ARRIVAL, INDICATOR_SCHEMA, KEY_COLUMNS
from tickloom.session import delete_path, folder_bytes, path_exists, subfolders

# What is stored of a bar: its row, where its message stands in the order of
# arrival, when the version was written, and the batch that wrote it.
VERSION_SCHEMA = T.StructType([
    *INDICATOR_SCHEMA.fields,
    T.StructField("arrival", ARRIVAL),
    T.StructField("written", T.LongType()),
    T.StructField("batch", T.StringType()),
])
_STATE = ", ".join(f"{name} {'boolean' if name == 'at_up' else 'double'}" for name in AT_STATE)
RECORD_SCHEMA = (
    "symbol string, day date, bars bigint, high double, low double, close double, last_time bigint, walked boolean, "
    f"{_STATE}, written bigint, batch string")
OFFSET_SCHEMA = "symbol string, day date, after bigint, delta double, written bigint, batch string"

# Batches of a day, or records and offsets of batches, from which on small ones are merged.
MERGE_FROM = 24
# Symbols that are named in the filter of a scan.
NAMED_SYMBOLS = 200


@dataclass(frozen=True)
class Store:
    """Enriched bars under ``root``, a folder all executors can reach.

    ``bars`` holds versions of rows, one partition per day and batch; a batch
    adds its own rows and touches no others. A bar's valid version is that of the
    message that arrived last, and of versions of one message the one written
    last. Within a partition files are sorted by symbol and time, so row group
    statistics prune symbols.

    ``days`` holds a record for every (symbol, day) with bars, so that a batch
    knows which days it has to look at and where series go on (see
    ``operators.segments``); the one written last is valid. ``offsets`` holds what
    late bars add to the OBV of rows after them: reads add it to rows of versions
    written before, so a late bar rewrites its neighbours and not all that
    follows.
    """

    spark: SparkSession
    root: str

    @property
    def bars_path(self) -> str:
        return f"{self.root}/bars"

    @property
    def days_path(self) -> str:
        return f"{self.root}/days"

    @property
    def offsets_path(self) -> str:
        return f"{self.root}/offsets"

    def work_path(self, batch_id: str) -> str:
        """Where a batch keeps its tables while it runs."""
        return f"{self.root}/work/{batch_id}"

    def within(self, spark: SparkSession) -> "Store":
        """The same store, read in another session."""
        return replace(self, spark=spark)

    def _table(self, path: str, schema) -> DataFrame:
        # Types come from the schema, never from the spelling of a folder name.
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    # ---- reading ----------------------------------------------------------

    def versions(self, days: Iterable[date] | None = None, without: str | None = None) -> DataFrame:
        """All versions, of ``days`` alone if given (only their folders are listed), but for those of one batch."""
        if days is None:
            found = self._table(self.bars_path, VERSION_SCHEMA)
        else:
            paths = [p for p in (f"{self.bars_path}/day={day}" for day in days) if path_exists(self.spark, p)]
            found = (
                self.spark.read.schema(VERSION_SCHEMA).option("basePath", self.bars_path).parquet(*paths)
                if paths else self.spark.createDataFrame([], VERSION_SCHEMA))
        return found if without is None else found.where(F.col("batch") != without)

    def with_offsets(self, versions: DataFrame, without: str | None = None) -> DataFrame:
        """Versions with the OBV that changes before them have given them since they were written."""
        if not subfolders(self.spark, self.offsets_path):
            return versions
        offsets = self._table(self.offsets_path, OFFSET_SCHEMA)
        if without is not None:
            offsets = offsets.where(F.col("batch") != without)
        # A set: a merged copy of an offset says the same as the offset.
        each = offsets.groupBy("symbol", "day").agg(F.collect_set(F.struct("after", "delta", "written")).alias("_offsets"))

        def holds(offset: Column) -> Column:
            later = offset["after"].isNull() | (F.col("time") > offset["after"])
            return later & (F.col("written") < offset["written"])

        total = F.aggregate(F.filter("_offsets", holds), F.lit(0.0), lambda sum_, offset: sum_ + offset["delta"])
        return versions.join(each, ["symbol", "day"], "left").withColumn(
            "obv", F.col("obv") + F.coalesce(total, F.lit(0.0))).select(*versions.columns)

    def _valid(self, versions: DataFrame) -> DataFrame:
        # Filters on symbol and day reach the files: they are keys of the window.
        order = Window.partitionBy(*KEY_COLUMNS).orderBy(F.desc_nulls_last("arrival"), F.desc("written"))
        return versions.withColumn("_version", F.row_number().over(order)).where("_version = 1").drop("_version")

    def current(self, days: Iterable[date] | None = None) -> DataFrame:
        """The valid version of every bar, with ``arrival`` and ``written``."""
        return self.with_offsets(self._valid(self.versions(days))).drop("batch").select(
            *INDICATOR_SCHEMA.names, "arrival", "written")

    def read(self) -> DataFrame:
        """The bars, in the 39 columns of the contract at full precision."""
        return self.current().select(*INDICATOR_SCHEMA.names)

    def read_with_final(self, width_seconds: int, now_seconds: int) -> DataFrame:
        """The bars with ``is_final``: whether their interval is over at ``now_seconds``."""
        return with_final_flag(self.read(), width_seconds, F.lit(now_seconds))

    def records(self, without: str | None = None) -> DataFrame:
        """The valid record of every (symbol, day), but for what one batch has written."""
        found = self._table(self.days_path, RECORD_SCHEMA)
        if without is not None:
            found = found.where(F.col("batch") != without)
        # Columns of fixed width, one by one: a hash aggregate.
        return found.groupBy("symbol", "day").agg(*[F.max_by(c, "written").alias(c) for c in RECORD_COLUMNS])

    def days(self) -> DataFrame:
        """``symbol, day``: where there are bars."""
        return self._table(self.days_path, RECORD_SCHEMA).select("symbol", "day").distinct()

    def symbols(self) -> DataFrame:
        """``symbol, first_day``."""
        return self.days().groupBy("symbol").agg(F.min("day").alias("first_day"))

    def history(self, ranges: DataFrame, n: int = HISTORY_ROWS) -> DataFrame:
        """The ``n`` stored rows of each symbol before its batch begins; ``ranges`` is the ``batch_range``.

        The records tell on which days they are, so no others are read.
        """
        earlier = self.records().join(ranges.select("symbol", "_from", "_from_day"), "symbol").where("day <= _from_day")
        # Bars on later days, but those of the batch's first one, of which some may come after it.
        after = Window.partitionBy("symbol").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
        whole = F.when(F.col("day") < F.col("_from_day"), F.col("bars")).otherwise(0)
        listed = earlier.withColumn("_after", F.coalesce(F.sum(whole).over(after), F.lit(0))).where(F.col("_after") < n)
        days = [row[0] for row in listed.select("day").distinct().collect()]
        stored = self.current(days).join(listed.select("symbol", "day", "_from"), ["symbol", "day"])
        return newest(stored.where("time < _from"), n).select(*INDICATOR_SCHEMA.names)

    # ---- writing ----------------------------------------------------------

    def upsert(self, rows: DataFrame, batch_id: str, records: DataFrame | None = None,
               offsets: DataFrame | None = None) -> None:
        """Add ``rows`` (unique keys, ``arrival`` if known) as the newest versions of their bars.

        A row without ``arrival`` takes that of the bar's last version, so that it
        is valid until a later message comes. Only the rows are written. A reader
        sees all rows of a batch and day or none. A batch that is run again, after
        a failure at any point, replaces its own rows, records and offsets.
        ``records`` and ``offsets`` come from ``operators.segments``; without
        records the days' bars are counted.
        """
        written = time.time_ns() // 1_000
        if records is None:
            rows = self._with_places(rows, batch_id)
        stamp = [F.lit(written).alias("written"), F.lit(batch_id).alias("batch")]
        self._add(
            # A large day becomes many files, small days share a task.
            rows.select(*INDICATOR_SCHEMA.names, F.col("arrival").cast(ARRIVAL).alias("arrival"), *stamp)
            .hint("rebalance", "day", "symbol").sortWithinPartitions("day", "symbol", "time"),
            self.bars_path, "day", "batch")
        if records is None:
            records = self._counted(batch_id)
        self._add(records.select("symbol", "day", *RECORD_COLUMNS, *stamp), self.days_path, "batch")
        if offsets is not None:
            self._add(offsets.select("symbol", "day", "after", "delta", *stamp), self.offsets_path, "batch")
        delete_path(self.spark, self.work_path(batch_id))

    @staticmethod
    def _add(rows: DataFrame, path: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    def _with_places(self, rows: DataFrame, batch_id: str) -> DataFrame:
        """Rows with the place of their bar's last version where they have none of their own."""
        if "arrival" not in rows.columns:
            rows = rows.withColumn("arrival", F.lit(None).cast(ARRIVAL))
        if not path_exists(self.spark, self.bars_path):
            return rows
        last = self.versions(without=batch_id).groupBy(*KEY_COLUMNS).agg(F.max("arrival").alias("_place"))
        return rows.join(last, KEY_COLUMNS, "left").withColumn("arrival", F.coalesce("arrival", "_place")).drop("_place")

    def _counted(self, batch_id: str) -> DataFrame:
        """Records of the days that a batch has rows on; how their series go on is not known."""
        touched = self.versions().where(F.col("batch") == batch_id).select("symbol", "day").distinct()
        days = [row[0] for row in touched.select("day").distinct().collect()]
        found = self._valid(self.versions(days).join(touched, ["symbol", "day"], "left_semi")).groupBy("symbol", "day").agg(
            F.count(F.lit(1)).alias("bars"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "time").alias("close"), F.max("time").alias("last_time"))
        unknown = {c: F.lit(None).cast("boolean" if c == "at_up" else "double") for c in AT_STATE}
        return found.withColumns({"walked": F.lit(False), **unknown})

    # ---- compaction ---------------------------------------------------------

    def compact(self, before: date) -> None:
        """Make one batch of all batches of each day earlier than ``before``, with its offsets added in.

        The merged rows are there before the old ones go, and both say the same,
        so readers and a second run find the same table at any time. No batch may
        be writing to these days meanwhile.
        """
        offsets = self._table(self.offsets_path, OFFSET_SCHEMA) if subfolders(self.spark, self.offsets_path) else None
        shifted = set() if offsets is None else {
            f"day={row[0]}" for row in offsets.where(F.col("day") < F.lit(before)).select("day").distinct().collect()}
        old = {
            name: batches for name in subfolders(self.spark, self.bars_path)
            if name < f"day={before}"
            and (len(batches := subfolders(self.spark, f"{self.bars_path}/{name}")) > 1 or name in shifted)
        }
        if not old:
            return
        days = [date.fromisoformat(name.removeprefix("day=")) for name in old]
        merged = self.with_offsets(self._valid(self.versions(days)))
        if shifted:
            # Offsets that a row has taken in do not hold for it again.
            last = offsets.groupBy("symbol", "day").agg(F.max("written").alias("_last"))
            merged = merged.join(last, ["symbol", "day"], "left").withColumn(
                "written", F.greatest("written", "_last")).drop("_last")
        self._merge(merged, self.bars_path, old, "day", "batch")
        if shifted:
            rest = offsets.where(F.col("day") >= F.lit(before)).drop("batch").distinct()
            self._merge(rest, self.offsets_path, {"": subfolders(self.spark, self.offsets_path)}, "batch")

    def compact_small(self, merge_from: int = MERGE_FROM) -> None:
        """Merge small batches of days that have at least ``merge_from`` of them, and records and offsets likewise.

        Batches of about a size go together, so a row is merged again only after
        its batch has grown by half: a day's rows are written a few times however
        many batches bring them. No batch may be running; folders are counted by
        listing them, so nothing runs while there are few.
        """
        for name in subfolders(self.spark, self.bars_path):
            path = f"{self.bars_path}/{name}"
            batches = subfolders(self.spark, path)
            if len(batches) >= merge_from:
                small = self._alike(path, batches)
                day = date.fromisoformat(name.removeprefix("day="))
                chosen = self.versions([day]).where(F.col("batch").isin([b.removeprefix("batch=") for b in small]))
                self._merge(self._valid(chosen), self.bars_path, {name: small}, "day", "batch")
        for path, schema in ((self.days_path, RECORD_SCHEMA), (self.offsets_path, OFFSET_SCHEMA)):
            batches = subfolders(self.spark, path)
            if len(batches) >= merge_from:
                table = self._table(path, schema)
                if path == self.days_path:
                    newest_record = Window.partitionBy("symbol", "day").orderBy(F.desc("written"))
                    table = table.withColumn("_n", F.row_number().over(newest_record)).where("_n = 1").drop("_n")
                else:
                    table = table.drop("batch").distinct()
                self._merge(table, path, {"": batches}, "batch")

    def _alike(self, path: str, batches: list[str]) -> list[str]:
        """The smallest batches, up to the first that is more than twice as large as all before it."""
        sizes = sorted((folder_bytes(self.spark, f"{path}/{b}"), b) for b in batches)
        chosen, total = [sizes[0][1]], sizes[0][0]
        for size, name in sizes[1:]:
            if len(chosen) > len(sizes) // 2 and size > 2 * total:
                break
            chosen.append(name)
            total += size
        return chosen

    def _merge(self, rows: DataFrame, path: str, old: dict[str, list[str]], *by: str) -> None:
        merged = rows.withColumn("batch", F.lit(f"merged-{uuid.uuid4().hex}"))
        if "day" in by:
            merged = merged.hint("rebalance", "day", "symbol").sortWithinPartitions("day", "symbol", "time")
        else:
            merged = merged.hint("rebalance")
        self._add(merged, path, *by)
        for parent, batches in old.items():
            for batch in batches:
                delete_path(self.spark, f"{path}/{parent}/{batch}" if parent else f"{path}/{batch}")
