"""Shards of nearly equal bytes for groups that must stay together, by differencing.

Karmarkar-Karp differencing keeps a heap of partial partitions, each a row of
shard sums. The two with the largest spread are combined again and again, the
fullest shard of one with the emptiest of the other, until one partition is left.

A group is all rows of one text. Groups larger than 1/``bundles`` of all bytes
enter the heap alone; the others are first summed into ``bundles`` bundles by a
hash of their key. So the heap holds at most twice ``bundles`` items at any
size of the corpus, and what it holds is the whole corpus.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import settle

BUNDLES = 24_000
ROWS_PER_RUN = 20_000


def difference(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every item: k-way largest differencing.

    Ties of spread are broken by the order of the items. Items may be zero.
    """
    count = len(sizes)
    if not count:
        return np.zeros(0, dtype=np.int32)
    # A node below ``count`` is one item, above it a pair of nodes. rows[node]
    # holds, for each of its shards from fullest to emptiest, the shard of the
    # two children that was merged into it.
    heap = []
    for node, size in enumerate(sizes.tolist()):
        sums = np.zeros(shards, dtype=np.int64)
        sums[0] = size
        heap.append((-size if shards > 1 else 0, node, sums))
    heapq.heapify(heap)
    pairs, orders = [], []
    while len(heap) > 1:
        _, left, left_sums = heapq.heappop(heap)
        _, right, right_sums = heapq.heappop(heap)
        merged = left_sums + right_sums[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        pairs.append((left, right))
        orders.append(order)
        heapq.heappush(heap, (int(merged[-1] - merged[0]), count + len(pairs) - 1, merged))
    shard_of = {heap[0][1]: np.arange(shards)}
    found = np.empty(count, dtype=np.int32)
    for node in range(count + len(pairs) - 1, -1, -1):
        placed = shard_of.pop(node)
        if node < count:
            found[node] = placed[0]
            continue
        left, right = pairs[node - count]
        inner = np.empty(shards, dtype=np.int64)
        inner[orders[node - count]] = placed
        shard_of[left], shard_of[right] = inner, inner[::-1]
    return found


def balanced_shards(docs: DataFrame, shards: int, *, bundles: int = BUNDLES, overhead: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``.

    Rows with equal texts share a shard. A null text counts as no bytes, all
    null texts are one group, and empty texts another. Repeated rows each get a
    slot of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("binary")
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"null")).alias("_key"),
    )
    rows = settle(rows, "sizes")
    groups = rows.groupBy("_key").agg(F.sum("size").alias("_bytes"))
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    item = F.when(F.col("_bytes") * bundles >= total, F.col("_key")).otherwise(
        F.pmod(F.xxhash64("_key"), F.lit(bundles)).cast("string").cast("binary")
    )
    groups = groups.select("_key", "_bytes", item.alias("_item"))
    items = groups.groupBy("_item").agg(F.sum("_bytes").alias("_bytes")).toPandas()
    items = items.sort_values(["_bytes", "_item"], ascending=[False, True], ignore_index=True)
    items["shard"] = difference(items["_bytes"].to_numpy(dtype=np.int64), shards)
    placed = spark.createDataFrame(
        pd.DataFrame({"_item": items["_item"].map(bytes), "shard": items["shard"]}), "_item binary, shard int"
    )
    placed_groups = groups.join(placed, "_item").select("_key", "shard")
    sharded = rows.join(placed_groups, "_key").drop("_key")
    return with_slots(sharded, ["shard"], ["doc_id", "text_crc32"], "slot", count)


def with_slots(df: DataFrame, group: list[str], order: list[str], name: str, rows: int,
               group_nulls: bool = True) -> DataFrame:
    """``df``, of about ``rows`` rows, with a gapless number from 0 within each ``group``, no group in one task.

    Rows are numbered within runs of about ``ROWS_PER_RUN`` rows, dealt by a hash
    of ``order``; each run starts where those before it end. Without
    ``group_nulls`` in ``group`` the rows are shuffled once and not twice.
    """
    runs = max(1, -(-rows // ROWS_PER_RUN))
    dealt = df.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(runs)))
    starts = (
        dealt.groupBy(*group, "_run").agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(
            Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)))
        .select(*(F.col(g).alias(f"_{g}") for g in group), F.col("_run").alias("_start"),
                F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy(*group, "_run").orderBy(*order)) - 1
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) if group_nulls else F.col(g) == F.col(f"_{g}") for g in group]
    numbered = dealt.withColumn("_within", within)
    joined = numbered.join(starts, [*same, F.col("_run") == F.col("_start")])
    return joined.select(*df.columns, (F.col("_before") + F.col("_within")).cast("long").alias(name))
