"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes ends a chunk wherever it has a certain form, so
boundaries depend on nearby bytes only and survive edits elsewhere. The form gets
rarer by half with each doubling of the block size; a text takes the smallest
block size with at most ``CHUNKS`` boundaries. Its fingerprint holds one
character per chunk at that block size and at twice that size, which makes
fingerprints of texts whose block sizes differ by a factor of two comparable.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import settle

WINDOW = 7
CHUNKS = 64
SMALLEST = 3
#: Two signatures of at least this length are alike only if they share a run of RUN characters.
LONG = 16
RUN = 7
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_LEVELS = 30


def _boundary_levels(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (after the byte) that end a chunk at the smallest block size, and up to which doubling they do."""
    rolled = np.zeros(len(raw), dtype=np.uint32)
    for back in range(min(WINDOW, len(raw))):
        rolled[back:] += (raw[:len(raw) - back].astype(np.uint32) + np.uint32(1)) * np.uint32(
            pow(0x01000193, back + 1, 1 << 32))
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x2C1B3C6D)
    rolled ^= rolled >> np.uint32(12)
    hits = np.flatnonzero(rolled % np.uint32(SMALLEST) == 0)
    third = rolled[hits] // np.uint32(SMALLEST)
    lowest = third & (~third + np.uint32(1))
    levels = np.where(third == 0, _LEVELS, np.log2(np.maximum(lowest, 1)).astype(np.int64))
    return hits + 1, np.minimum(levels, _LEVELS)


def _signature(raw: bytes, ends: np.ndarray) -> str:
    marks = []
    start = 0
    for end in [*ends.tolist(), len(raw)]:
        if end > start:
            marks.append(_ALPHABET[zlib.crc32(raw[start:end]) * 0x9E3779B1 >> 20 & 63])
            start = end
    return "".join(marks)


def fingerprint(text: str) -> str:
    """``block size:signature:signature at twice the block size``; an empty text has empty signatures."""
    raw = text.encode("utf-8", "surrogatepass")
    ends, levels = _boundary_levels(np.frombuffer(raw, dtype=np.uint8))
    above = len(ends) - np.cumsum(np.bincount(levels, minlength=_LEVELS + 1)) if len(ends) else np.zeros(1, int)
    # above[k] boundaries lie beyond level k: those of the block size SMALLEST * 2**(k + 1).
    level = 0 if len(ends) <= CHUNKS else min(int(np.argmax(above <= CHUNKS)) + 1, _LEVELS)
    first, second = (_signature(raw, ends[levels >= k]) for k in (level, level + 1))
    return f"{SMALLEST << level}:{first}:{second}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements between two strings, one machine word of differences a step."""
    if not a or not b:
        return max(len(a), len(b))
    where: dict[str, int] = {}
    for i, mark in enumerate(a):
        where[mark] = where.get(mark, 0) | 1 << i
    top, full = 1 << len(a) - 1, (1 << len(a)) - 1
    up, down, distance = full, 0, len(a)
    for mark in b:
        same = where.get(mark, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right = down | ~(diagonal | up) & full
        left = up & diagonal
        if right & top:
            distance += 1
        elif left & top:
            distance -= 1
        right = right << 1 | 1
        up = (left << 1 | ~(diagonal | right)) & full
        down = right & diagonal & full
    return distance


def _short_runs(signature: str) -> str:
    """The signature with runs of one character cut to three, which say little about the text."""
    kept = []
    for mark in signature:
        if kept[-3:] != [mark] * 3:
            kept.append(mark)
    return "".join(kept)


def _alike(a: str, b: str) -> float:
    a, b = _short_runs(a), _short_runs(b)
    if min(len(a), len(b)) >= LONG:
        runs = {a[i:i + RUN] for i in range(len(a) - RUN + 1)}
        if not any(b[i:i + RUN] in runs for i in range(len(b) - RUN + 1)):
            return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b), 1)


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, 0 for incompatible block sizes, else the best of the comparable signatures."""
    if a == b:
        return 1.0
    (size_a, *a_marks), (size_b, *b_marks) = a.split(":"), b.split(":")
    step = {int(size_a): a_marks[0], 2 * int(size_a): a_marks[1]}
    other = {int(size_b): b_marks[0], 2 * int(size_b): b_marks[1]}
    # Signatures of equal size compare; empty ones say nothing.
    return max((_alike(step[s], other[s]) for s in step.keys() & other.keys() if step[s] and other[s]), default=0.0)


# Ids go through Python as text, as numbers with nulls among them would become floats.
_ROW = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _compared(doc_id, text: str, mine: str, following: str, theirs: str) -> dict:
    edited = _edited(text, following)
    marked = fingerprint(edited)
    return {
        "doc_id": doc_id, "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": mine, "edited_fingerprint": marked,
        "near_edited": likeness(mine, marked), "near_next": likeness(mine, theirs),
    }


def _table(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    """Rows as plain objects, missing values None."""
    return pd.DataFrame([[row.get(c) for c in columns] for row in rows], columns=columns, dtype=object)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[list[dict]]:
    """Every row but the last against the row after it; the first and the last also with their texts, for the seams."""
    part = TaskContext.get().partitionId()
    before = None
    first = None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            text = text or ""
            this = (doc_id, text, fingerprint(text))
            if before is not None:
                rows.append({**_compared(*before, *this[1:]), "part": part, "seam": 0})
            else:
                first = this
            before = this
        yield rows
    if before is not None:
        yield [{"part": part, "seam": kind, "doc_id": row[0], "text": row[1], "fingerprint": row[2]}
               for kind, row in ((1, first), (2, before))]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    Documents are in order of descending doc_id (null last), equal ids in order
    of a hash of their text; after the last comes the first. The edited text has its last
    third replaced by the beginning of the next document. A null text is an
    empty one. One document is its own next. An empty table gives no rows.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.desc_nulls_last("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions(F.desc_nulls_last("doc_id"), F.xxhash64("text"))
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    )
    columns = [c.split()[0] for c in _ROW.split(", ")]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _walk(batches):
            yield _table(rows, [*columns, "part", "seam", "text"])

    walked = settle(ordered.mapInPandas(walk, f"{_ROW}, part int, seam int, text string"), "fingerprints")

    # A seam joins the last row of a partition to the first of the next one that has rows: two rows a partition.
    edges = walked.where("seam > 0")
    parts = sorted(r["part"] for r in edges.where("seam = 1").select("part").collect())
    follows = docs.sparkSession.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next_part int")
    lasts = edges.where("seam = 2").select("part", "doc_id", "text", "fingerprint")
    firsts = edges.where("seam = 1").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    seams = lasts.join(follows, "part").join(firsts, "next_part")

    def sew(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _table([
                _compared(*row)
                for row in zip(batch["doc_id"], batch["text"], batch["fingerprint"],
                               batch["next_text"], batch["next_fingerprint"], strict=True)
            ], columns)

    rows = walked.where("seam = 0").select(*columns).unionByName(seams.mapInPandas(sew, _ROW))
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))
