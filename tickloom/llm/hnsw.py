"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt to shards of bounded size. A shard's graph is a few
flat arrays, one per layer, that hold the neighbours of every node; a node is on
layer l with probability width**-l. Nodes are inserted in batches, which search
the graph so far in step with one another, are joined to a spread-out choice of
what they find and of each other, and are linked back. Every query visits every
shard, from the top layer down, and the shards' best are merged.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import settle

ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 1024
WIDTH = 16
BUILD_BEAM = 64
SEARCH_BEAM = 96
_STEP = 4
_BATCH = 256


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in single precision; scaled first, so that no finite row overflows or vanishes."""
    rows = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def beam_search(units: np.ndarray, links: np.ndarray, asked: np.ndarray, entries: np.ndarray, beam: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """For every asked row the ``beam`` nearest nodes it reaches from ``entries``: ids (-1 for none) and cosines, best first."""
    count = len(asked)
    near = np.full((count, beam), -1, dtype=np.int64)
    cosine = np.full((count, beam), -np.inf, dtype=np.float32)
    done = np.ones((count, beam), dtype=bool)
    seen = np.zeros((count, len(units) + 1), dtype=bool)
    seen[:, -1] = True

    def merge(who: np.ndarray, found: np.ndarray) -> None:
        """``found``: nodes for the rows ``who``, -1 for none, none twice in a row."""
        fresh = ~seen[who[:, None], found]
        seen[who[:, None], found] = True
        seen[:, -1] = True
        value = np.einsum("qmd,qd->qm", units[found], asked[who])
        value[~fresh] = -np.inf
        ids = np.concatenate([near[who], np.where(fresh, found, -1)], axis=1)
        values = np.concatenate([cosine[who], value], axis=1)
        flags = np.concatenate([done[who], ~fresh], axis=1)
        best = np.argsort(-values, axis=1, kind="stable")[:, :beam]
        at = np.arange(len(who))[:, None]
        near[who], cosine[who], done[who] = ids[at, best], values[at, best], flags[at, best]

    for column in range(entries.shape[1]):
        merge(np.arange(count), entries[:, column:column + 1])
    active = np.arange(count)
    while len(active):
        order = np.argsort(done[active], axis=1, kind="stable")[:, :_STEP]
        at = np.arange(len(active))[:, None]
        open_ = ~done[active][at, order]
        nodes = np.where(open_, near[active][at, order], -1)
        done[active[:, None], order] = True
        for column in range(nodes.shape[1]):
            who = active[nodes[:, column] >= 0]
            if len(who):
                merge(who, links[nodes[nodes[:, column] >= 0, column]])
        active = active[(~done[active]).any(axis=1)]
    return near, cosine


def spread_choice(units: np.ndarray, ids: np.ndarray, cosine: np.ndarray, width: int) -> np.ndarray:
    """Up to ``width`` of each row's candidates (best first, -1 for none).

    First those nearer to the row than to any candidate chosen before, then the nearest others.
    """
    count, candidates = ids.shape
    held = units[ids]
    between = np.einsum("qmd,qnd->qmn", held, held)
    chosen = np.zeros((count, candidates), dtype=bool)
    for j in range(candidates):
        nearest = np.where(chosen, between[:, j], -np.inf).max(axis=1)
        chosen[:, j] = (ids[:, j] >= 0) & (cosine[:, j] > nearest) & (chosen.sum(axis=1) < width)
    order = np.argsort(np.where(ids >= 0, ~chosen, 2), axis=1, kind="stable")[:, :width]
    found = np.take_along_axis(ids, order, axis=1)
    if candidates < width:
        found = np.pad(found, ((0, 0), (0, width - candidates)), constant_values=-1)
    return found


class Graph:
    """A small-world graph over unit rows; ``layers[l]`` holds each node's neighbours on layer l, -1 for none."""

    def __init__(self, units: np.ndarray, layers: list[np.ndarray], top: int):
        self.units, self.layers, self.top = units, layers, top

    @classmethod
    def built(cls, units: np.ndarray, seed: int) -> "Graph":
        count = len(units)
        draw = np.random.default_rng(seed).random(count)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(WIDTH)).astype(int), 8)
        level[0] = level.max()  # The first node is the way in for all others.
        layers = [np.full((count, 2 * WIDTH if k == 0 else WIDTH), -1, dtype=np.int32) for k in range(level[0] + 1)]
        graph = cls(units, layers, 0)
        start = 1
        while start < count:
            end = min(count, start + min(start, _BATCH))
            graph._insert(np.arange(start, end), level)
            start = end
        return graph

    def _insert(self, nodes: np.ndarray, level: np.ndarray) -> None:
        asked = self.units[nodes]
        entries = np.full((len(nodes), 1), self.top)
        for k in range(len(self.layers) - 1, -1, -1):
            near, cosine = beam_search(self.units, self.layers[k], asked, entries, BUILD_BEAM)
            entries = near[:, :1]
            joins = np.flatnonzero(level[nodes] >= k)
            if not len(joins):
                continue
            # The batch cannot find its own nodes in the graph yet.
            own = asked[joins] @ asked[joins].T
            np.fill_diagonal(own, -np.inf)
            best = np.argsort(-own, axis=1, kind="stable")[:, :min(WIDTH, len(joins) - 1)]
            ids = np.concatenate([near[joins], nodes[joins][best]], axis=1)
            values = np.concatenate([cosine[joins], np.take_along_axis(own, best, axis=1)], axis=1)
            order = np.argsort(-values, axis=1, kind="stable")
            ids, values = np.take_along_axis(ids, order, axis=1), np.take_along_axis(values, order, axis=1)
            chosen = spread_choice(self.units, ids, values, WIDTH)
            self.layers[k][nodes[joins], :WIDTH] = chosen
            self._link_back(k, nodes[joins], chosen)

    def _link_back(self, k: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        links = self.layers[k]
        to, of = chosen.ravel(), np.repeat(nodes, chosen.shape[1])
        to, of = to[to >= 0], of[to >= 0]
        order = np.argsort(to, kind="stable")
        to, of = to[order], of[order]
        targets, starts, counts = np.unique(to, return_index=True, return_counts=True)
        added = np.full((len(targets), counts.max()), -1, dtype=np.int64)
        added[np.repeat(np.arange(len(targets)), counts), np.arange(len(to)) - np.repeat(starts, counts)] = of
        for begin in range(0, len(targets), _BATCH):
            part = slice(begin, begin + _BATCH)
            old = links[targets[part]]
            new = added[part]
            new = np.where((new[:, :, None] == old[:, None, :]).any(axis=2), -1, new)
            ids = np.concatenate([old, new], axis=1)
            values = np.einsum("qmd,qd->qm", self.units[ids], self.units[targets[part]])
            values[ids < 0] = -np.inf
            order = np.argsort(-values, axis=1, kind="stable")
            ids, values = np.take_along_axis(ids, order, axis=1), np.take_along_axis(values, order, axis=1)
            room = (ids >= 0).sum(axis=1) > links.shape[1]
            kept = ids[:, :links.shape[1]].copy()
            if room.any():
                kept[room] = spread_choice(self.units, ids[room], values[room], links.shape[1])
            links[targets[part]] = kept

    def nearest(self, asked: np.ndarray, count: int, beam: int) -> np.ndarray:
        """The ``count`` nearest nodes found for every asked unit row, best first, -1 for none."""
        entries = np.full((len(asked), 1), self.top)
        for k in range(len(self.layers) - 1, 0, -1):
            near, _ = beam_search(self.units, self.layers[k], asked, entries, 8)
            entries = near[:, :1]
        near, _ = beam_search(self.units, self.layers[0], asked, entries, max(beam, count))
        return near[:, :count]


def _valid(vector):
    """Whether a vector takes part: not null or empty, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def build_index(vectors: DataFrame, *, keep: int, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row per shard: dim, shard, ids (of equal vectors, the ``keep`` smallest), vectors and the graph's arrays.

    ``vectors``: vec_id, embedding. Vectors of different lengths lie in different shards.
    """
    taken = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(_valid(F.col("embedding")) & F.col("vec_id").isNotNull())
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    distinct = settle(
        taken.distinct().withColumn("_n", first).where(F.col("_n") <= keep).groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.size("embedding").alias("dim"), "embedding", "ids"),
        "distinct-vectors",
    )
    sizes = distinct.groupBy("dim").agg(F.ceil(F.count("*") / rows_per_shard).alias("_shards"))
    dealt = distinct.join(F.broadcast(sizes), "dim").withColumn(
        "shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("_shards")).cast("int"))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ids", key=lambda ids: ids.str[0], ignore_index=True)
        held = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        graph = Graph.built(unit_rows(held), seed=int(key[1]))
        return pd.DataFrame([{
            "dim": key[0], "shard": key[1], "ids": [list(map(int, ids)) for ids in rows["ids"]],
            "vectors": held.tobytes(), "layers": [layer.astype(np.int32).tobytes() for layer in graph.layers],
        }])

    return settle(
        dealt.select("dim", "shard", "embedding", "ids").groupBy("dim", "shard").applyInPandas(
            build, "dim int, shard int, ids array<array<long>>, vectors binary, layers array<binary>"),
        "graphs",
    )


def search(index: DataFrame, queries: DataFrame, *, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each query (vec_id, embedding) but itself.

    Score is the cosine in double precision, ties go to the smaller vec_id. A
    query without candidates, or whose vector takes no part, has no rows; a
    repeated query counts once.
    """
    asked = queries.select(
        F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(_valid(F.col("embedding")) & F.col("vec_id").isNotNull()).dropDuplicates(["query_id"])
    asked = asked.withColumn("dim", F.size("embedding"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).alias("_blocks"))
    # One row for each length of vectors, and one for each block and shard.
    dealt = asked.join(F.broadcast(blocks), "dim").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("_blocks")))
    places = index.select("dim", F.col("shard").alias("to_shard"))
    left = dealt.join(places, "dim").select(F.col("dim").alias("to_dim"), "to_shard", "block", "query_id", "embedding")
    right = index.join(F.broadcast(blocks), "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    ).select("dim", "shard", "block", "ids", "vectors", "layers")

    def visit(rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(shard):
            held = shard.iloc[0]
            vectors = np.frombuffer(held["vectors"], dtype=np.float64).reshape(len(held["ids"]), -1)
            layers = [np.frombuffer(x, dtype=np.int32).reshape(len(vectors), -1) for x in held["layers"]]
            wanted = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
            near = Graph(unit_rows(vectors), layers, 0).nearest(unit_rows(wanted), k + 1, beam)
            for query, vector, nodes in zip(rows["query_id"], wanted, near, strict=True):
                nodes = nodes[nodes >= 0]
                scores = exact_cosines(vectors[nodes], vector)
                pairs = sorted((-s, int(i)) for s, n in zip(scores, nodes, strict=True) for i in held["ids"][n] if i != query)
                found += [(int(query), i, -s) for s, i in pairs[:k]]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    each = left.groupBy("to_dim", "to_shard", "block").cogroup(right.groupBy("dim", "shard", "block")).applyInPandas(
        visit, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_cosines(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Cosines in double precision; huge and tiny vectors are scaled by a power of two, which changes no digit."""
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    vector = np.ldexp(vector, -np.frexp(np.abs(vector).max())[1])
    dots = (rows * vector).sum(axis=1)
    return dots / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((vector * vector).sum()))
