"""Ranked lexical search by presence masks.

Documents are first written down as the counts of just those terms that some
item asks for. Within a block of documents every term has a bitmap of the
documents it occurs in. For an item the bitmaps of its terms, laid across each
other, give every document a mask of the terms that it matches, and documents
with the same mask form a group. No document of a group can score more than the
sum of its terms' best contributions in the block; groups are evaluated from the
highest such sum down, until it lies below the item's tenth best score so far.
Every task carries these best scores from block to block, so most groups of its
later blocks are never evaluated; at the end the tasks' best are merged.

The items are a set of queries: they are taken in blocks of bounded size, each
against all documents. The number of documents, of terms and the document
frequencies cover the whole table.
"""

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import settle

#: Bytes of item texts that are searched for at a time, about.
ITEM_BYTES = 4_000_000
#: Cells of a block's table of terms and documents.
CELLS = 4_000_000
#: Tasks whose best are merged at a time.
TASKS_PER_MERGE = 256
_INDEX = "doc_id long, tokens long, terms array<int>, counts array<int>"
_INDEX_ARROW = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64()), ("terms", pa.list_(pa.int32())),
                          ("counts", pa.list_(pa.int32()))])
# Bytes of terms stay, A to Z in lower case; all others part terms. Every byte
# of a character beyond ASCII is 0x80 or more.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: str | bytes) -> list[bytes]:
    """The terms of a text in order: runs of letters and digits, and of anything beyond ASCII."""
    return (text.encode() if isinstance(text, str) else text).translate(_TERM_BYTES).split()


def weight(docs: int, having: int) -> int:
    """Of a term that ``having`` of ``docs`` documents hold."""
    return floor(1000 * log((2 * docs + 2) / (2 * having + 1)))


def contributions(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What ``counts`` occurrences of terms add to scores, in whole numbers; it grows with the count and falls with the length."""
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * lengths))


def term_counts(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, tokens (number of all terms), and of ``terms`` those that occur, by position, with their counts."""
    place = {term: k for k, term in enumerate(terms)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, found, times = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                own = terms_of(text.as_py() or b"")
                held = Counter(filter(place.__contains__, own))
                tokens.append(len(own))
                found.append([place[term] for term in held])
                times.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=f.type) for c, f in zip((tokens, found, times), list(_INDEX_ARROW)[1:], strict=True))],
                schema=_INDEX_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, _INDEX)


def frequencies(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Of all documents: how many have a term, how many terms they have, and how many hold each of ``size`` terms."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having, some, tokens = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            some, tokens = some + int((own > 0).sum()), tokens + int(own.sum())
            having += np.bincount(batch.column(1).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(having)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array([-2, -1, *held.tolist()], pa.int32()),
            "value": pa.array([some, tokens, *having[held].tolist()], pa.int64())})

    partial = index.select("tokens", "terms").mapInArrow(add, "term int, value long")
    total = {r["term"]: r["value"] for r in partial.groupBy("term").agg(F.sum("value").alias("value")).collect()}
    having = np.array([total.get(k, 0) for k in range(size)], dtype=np.int64)
    return total.get(-2, 0), total.get(-1, 0), having


class Best:
    """The ``k`` best documents of one item so far: highest score first, then smallest id, null ids last."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, k: int):
        # Terms without weight add nothing.
        self.terms, self.weights, self.k = terms[weights > 0], weights[weights > 0][:, None], k
        self.rows: list[tuple[int, bool, int]] = []

    @property
    def needed(self) -> int:
        """The lowest score that can still get in."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def search(self, present: np.ndarray, counts: np.ndarray, lengths: np.ndarray, ids: list) -> int:
        """Take in a block: ``present`` and ``counts`` are terms by documents. Returns how many documents were evaluated."""
        if not len(self.terms) or not len(ids):
            return 0
        bits = np.packbits(present[self.terms], axis=0)
        masks, group = group_masks(bits)
        most = counts[self.terms].max(axis=1, keepdims=True).astype(np.int64)
        bounds = (np.unpackbits(masks, axis=0, count=len(self.terms)).T.astype(np.int64)
                  @ contributions(self.weights, most, lengths.min()))[:, 0]
        order = np.argsort(-bounds, kind="stable")
        members, ends = np.argsort(group, kind="stable"), np.cumsum(np.bincount(group, minlength=len(bounds)))
        starts, at, evaluated = ends - np.diff(ends, prepend=0), 0, 0
        while at < len(order) and bounds[order[at]] >= self.needed:
            # A few groups at a time, until they hold enough documents to fill the list.
            chosen = []
            while at < len(order) and len(chosen) < 4 * self.k and bounds[order[at]] >= self.needed:
                chosen.extend(members[starts[order[at]]:ends[order[at]]].tolist())
                at += 1
            own = counts[np.ix_(self.terms, chosen)].astype(np.int64)
            scores = contributions(self.weights, own, lengths[chosen]).sum(axis=0)
            evaluated += len(chosen)
            found = [(-int(s), ids[c] is None, ids[c] or 0) for s, c in zip(scores, chosen, strict=True) if s >= self.needed]
            self.rows = sorted(self.rows + found)[:self.k]
        return evaluated


def group_masks(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of packed ``bits``, and for every column which of them it is."""
    rows = np.zeros((bits.shape[1], -(-len(bits) // 8) * 8), dtype=np.uint8)
    rows[:, :len(bits)] = bits.T
    words = rows.view(np.uint64)
    if words.shape[1] == 1:
        _, first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)
    else:
        _, first, group = np.unique(rows.view(np.dtype((np.void, rows.shape[1])))[:, 0], return_index=True, return_inverse=True)
    return bits[:, first], group


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Per part of a batch: counts of terms by documents, the documents' numbers of tokens and their ids."""
    step = max(1, CELLS // max(1, size))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        terms, counts = part.column("terms"), part.column("counts")
        table = np.zeros((size, part.num_rows), dtype=np.int32)
        doc = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
        table[terms.flatten().to_numpy(zero_copy_only=False), doc] = counts.flatten().to_numpy(zero_copy_only=False)
        yield table, part.column("tokens").to_numpy(), part.column("doc_id").to_pylist()


def _ranked_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    vocabulary = sorted({term for _, own in items for term in own})
    place = {term: n for n, term in enumerate(vocabulary)}
    index = settle(term_counts(docs, vocabulary), "term-counts")
    some, tokens, having = frequencies(index, len(vocabulary))
    weights = np.array([weight(some, int(h)) for h in having], dtype=np.int64)
    asked = [(item_id, np.array([place[term] for term in own], dtype=np.int64)) for item_id, own in items]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(terms, weights[terms], k) for _, terms in asked]
        for batch in batches:
            for counts, lengths, ids in _blocks(batch, len(vocabulary)):
                # Python's numbers, as those of a large table outgrow 64 bits before the division.
                lengths = np.array([10 + 90 * n * some // tokens if tokens else 10 for n in lengths.tolist()], dtype=np.int64)
                present = counts > 0
                for own in best:
                    own.search(present, counts, lengths, ids)
        found = [(item_id, None if null else doc_id, -score)
                 for (item_id, _), own in zip(asked, best, strict=True) for score, null, doc_id in own.rows]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_pydict({
            "item_id": pa.array(columns[0], pa.int64()), "doc_id": pa.array(columns[1], pa.int64()),
            "score": pa.array(columns[2], pa.int64()),
            "_task": pa.array([TaskContext.get().partitionId() // TASKS_PER_MERGE] * len(found), pa.int32())})

    found = index.mapInArrow(search, "item_id long, doc_id long, score long, _task int")
    for group in (["item_id", "_task"], ["item_id"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, *, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for every item the ``k`` documents (all, if fewer) of the highest scores above 0.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are left
    out. Null and empty texts have no terms: such an item has no rows, such a
    document counts nowhere. Equal scores go by ascending doc_id, null ids last.
    Repeated documents are ranked one by one; rows of one item_id are one item
    with the terms of all of them. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // item_bytes))
    parts = []
    for block in range(blocks):
        # Bounded by ``item_bytes`` and the largest item.
        own: dict[int | None, set[bytes]] = {}
        for row in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            own.setdefault(row["item_id"], set()).update(terms_of(row["text"]))
        wanted = [(item_id, sorted(terms)) for item_id, terms in own.items() if terms]
        if wanted:
            parts.append(_ranked_block(docs, wanted, k))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
