"""Mixing sources to target weights by Pfair scheduling.

A source's documents are dealt out in blocks of equal length. Time runs in
slots, one block each. Block i (from 0) of a source of weight w is released at
slot floor(i / w) and due by slot ceil((i + 1) / w); in every slot the released
block with the earliest deadline runs. With weights that sum to one every
deadline is met, so after any number of slots each source is less than one block
away from its share.

Weights are taken as they are, as ratios of whole numbers, and windows follow
from them over the whole run, so nothing adds up however long it is. The run is
cut into segments that are scheduled independently. At a cut each source has had
its share rounded down or up, by largest remainder, so that the blocks are as
many as the slots. Whichever way they are rounded, the blocks between two cuts
fit their windows: in any interval the blocks that must run within it are at most
the sources' shares of it, so earliest deadline first meets them all.

Rows are numbered and find their slots without their texts, which are joined to
their places at the end. Sources that run out start over (``epoch``), until every
document of every source has been dealt once.
"""

import heapq
from collections.abc import Iterable, Iterator
from fractions import Fraction
from math import lcm

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import free_name, release_memory
from tickloom.session import settle

#: Slots of a segment.
SEGMENT_SLOTS = 50_000
#: Rows that are numbered in one go, about.
ROWS_PER_RUN = 2_000
#: Sources that are sent to every task; with more of them rows are shuffled to meet them.
BROADCAST_SOURCES = 10_000


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers in exactly the same proportions."""
    if any(not np.isfinite(w) or w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def dealt_before(weights: dict[str, int], slot: int) -> dict[str, int]:
    """Blocks that each source has had before ``slot``: its share, rounded by largest remainder, then by name."""
    total = sum(weights.values())
    whole = {s: divmod(w * slot, total) for s, w in weights.items()}
    missing = slot - sum(count for count, _ in whole.values())
    up = set(sorted(whole, key=lambda s: (-whole[s][1], s))[:missing])
    return {s: count + (s in up) for s, (count, _) in whole.items()}


def schedule(weights: dict[str, int], start: int, end: int) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) for every slot from ``start`` to before ``end``, by earliest deadline, then by source."""
    total = sum(weights.values())
    first, last = dealt_before(weights, start), dealt_before(weights, end)

    def window(source: str, block: int) -> tuple[int, int]:
        w = weights[source]
        return block * total // w, -(-(block + 1) * total // w)

    waiting = [(max(start, window(s, first[s])[0]), s, first[s]) for s in weights if first[s] < last[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(start, end):
        while waiting and waiting[0][0] <= slot:
            _, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (min(end, window(source, block)[1]), source, block))
        _, source, block = heapq.heappop(ready)
        yield source, block, *window(source, block), slot
        if block + 1 < last[source]:
            heapq.heappush(waiting, (max(start, window(source, block + 1)[0]), source, block + 1))


def _segments(weights: dict[str, int], slots: int):
    """The schedule of the segments that a task is given by number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            release_memory()
            for start in (batch["id"] * SEGMENT_SLOTS).tolist():
                yield pd.DataFrame(
                    list(schedule(weights, start, min(start + SEGMENT_SLOTS, slots))),
                    columns=["source", "block", "release", "deadline", "slot"])

    return run


def _facts(spark: SparkSession, sources: Iterable[str], facts: dict[str, dict[str, int]]) -> DataFrame:
    """A row per source with numbers by name, 0 where one is missing.

    Made from an Arrow table: of a list, Spark would pickle the rows anew in
    Python workers of their own, which stay next to those of the operators.
    """
    names = list(sources)
    columns = {name: pa.array([of.get(s, 0) for s in names], pa.int64()) for name, of in facts.items()}
    return spark.createDataFrame(pa.table({"source": pa.array(names, pa.string()), **columns}))


def tempered(counts: dict[str, int], exponent: float) -> dict[str, float]:
    """Target weights: the sources' sizes to the power ``exponent``; 1 keeps their proportions, 0 makes them equal."""
    return {s: float(n) ** exponent for s, n in counts.items()}


def mixed(docs: DataFrame, *, weights: dict[str, float] | None = None, exponent: float = 0.8,
          block_rows: int = 8, carry: tuple[str, ...] = ()) -> DataFrame:
    """The mixture: doc_id, source, epoch, block, release, deadline, slot and position for every place in it.

    ``weights`` are the target weights by source; without them they are
    ``tempered`` from the sizes. A null source is one source, named by the
    empty string like an empty one; repeated rows are rows of their own, ties of
    doc_id go by a hash of the carried columns. The mixture ends with the slot in which the last source has dealt its last
    document once, so every row of ``docs`` is in it, and positions are its rows
    in order. ``carry`` names further columns of ``docs`` to keep. Sources are
    few enough to be listed. An empty table gives no rows.
    """
    spark = docs.sparkSession
    carry = tuple(dict.fromkeys(carry))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), *carry)
    # Rows that are equal in all that is kept are one, with a number of copies.
    id_, key = free_name(rows, "_id"), free_name(rows, "_key")
    rows = rows.withColumns({
        id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        key: F.xxhash64(*carry, F.col("doc_id").isNull()),
    })
    # No nulls among the keys, so that plain equality joins them.
    keys = ["source", id_, key]
    distinct = settle(rows.groupBy(*keys).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("_copies")), "row-keys")
    counts = {r["source"]: r["n"] for r in distinct.groupBy("source").agg(F.sum("_copies").alias("n")).collect()}
    weights = tempered(counts, exponent) if weights is None else {s: weights[s] for s in counts}
    whole = whole_weights(weights)
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    # The last block of every source has run by its deadline.
    most = max((-(-blocks[s] * sum(whole.values()) // w) for s, w in whole.items()), default=0)
    segments = -(-most // SEGMENT_SLOTS)
    slots = settle(
        spark.range(segments, numPartitions=max(1, min(segments, 10_000))).mapInPandas(
            _segments(whole, most), "source string, block long, release long, deadline long, slot long"),
        "slots")
    lasts = _facts(spark, blocks, {"block": {s: n - 1 for s, n in blocks.items()}})
    end = slots.join(lasts, ["source", "block"]).agg(F.max("slot")).first()[0]
    slots = slots.where(F.col("slot") <= F.lit(-1 if end is None else end))
    # Rows of a source that are dealt: whole blocks, some of them several times.
    dealt = {r["source"]: r["n"] * block_rows for r in slots.groupBy("source").agg(F.count("*").alias("n")).collect()}
    sources = _facts(spark, counts, {"_rows": counts, "_dealt": dealt})
    if len(counts) <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)

    places = (
        _numbered(distinct, id_, key, sum(counts.values())).join(sources, "source")
        .withColumn("_number", F.explode(F.sequence(F.col("_number"), F.col("_number") + F.col("_copies") - 1)))
        .withColumn("epoch", F.explode(F.sequence(
            F.lit(0).cast("long"), F.floor((F.col("_dealt") - 1 - F.col("_number")) / F.col("_rows")))))
        .withColumn("_row", F.col("epoch") * F.col("_rows") + F.col("_number"))
        .withColumn("block", F.floor(F.col("_row") / block_rows))
        .join(slots, ["source", "block"])
        .withColumn("position", F.col("slot") * block_rows + F.col("_row") % block_rows)
        .select(*keys, "doc_id", "epoch", "block", "release", "deadline", "slot", "position")
    )
    if carry:
        # One shuffle of the texts serves the choice of a row of each key and the join.
        texts = rows.groupBy(*keys).agg(*[F.first(c).alias(c) for c in carry if c not in ("source", "doc_id")])
        places = texts.join(places, keys)
    kept = ["doc_id", "source", *[c for c in carry if c not in ("source", "doc_id")]]
    return places.select(*kept, "epoch", "block", "release", "deadline", "slot", "position")


def _numbered(rows: DataFrame, id_: str, key: str, total: int) -> DataFrame:
    """``rows`` (one a key, with ``_copies``) with ``_number``, the copies of the source's rows before it.

    They are numbered within runs of about ``ROWS_PER_RUN`` rows, dealt by a hash;
    each run starts where those before it end.
    """
    runs = max(1, -(-total // ROWS_PER_RUN))
    held = rows.withColumn("_run", F.pmod(F.xxhash64(id_, key), F.lit(runs)))
    earlier = Window.partitionBy("source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.groupBy("source", "_run").agg(F.sum("_copies").alias("_held")).select(
        "source", "_run", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("source", "_run").orderBy(id_, key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        held.withColumn("_within", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
        .join(starts, ["source", "_run"])
        .withColumn("_number", F.col("_before") + F.col("_within")).drop("_run", "_before", "_within")
    )
