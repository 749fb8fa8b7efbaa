"""Best-fit decreasing packing of tokenized documents into sequences of a fixed length.

Best-fit decreasing takes pieces from the longest to the shortest and puts each
into the open sequence with the least room that still holds it. Which sequence
that is depends on the room of the open ones alone, so a segment tree has a leaf
for every remaining capacity and finds the tightest in logarithmic time. Pieces
of one length are alike to it: they are counted where they lie, and one step of
the plan places as many of them as fill sequences of the same room. So the
driver holds a number for each length and a few ranges of sequences, however
many documents there are, and the packing is that of all of them in one go.

Pieces are then numbered within their length, in runs of bounded size, and find
their place in the plan by their number.
"""

import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from tickloom.llm.common import free_name
from tickloom.session import settle

CAPACITY = 4096
END_ID = 1
ROWS_PER_RUN = 20_000
TOKENS_PER_RUN = 4_000_000
#: Words, and parts of words, that a worker keeps the ids of: some 160 and 40 MB.
KEPT_WORDS, KEPT_PARTS = 800_000, 200_000
LONGEST_KEPT = 64
# The pattern of the known tokenizer; visible ASCII and the letters
# from U+00C0 to U+017F but U+0130, which change neither by composition nor, in
# lower case, in number.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_SIMPLE = re.compile(f"[ !-~{_LETTERS}]*")
# The pattern for simple characters, and where signs follow a letter or digit, which parts them always.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+")
_SIGNS = re.compile(f"(?<=[0-9{_LETTERS}])(?=[!-/:-@[-`{{-~])")
_RANKS = 40


# ---- ids ------------------------------------------------------------------


class _Known(dict):
    """Values that are worked out when they are first asked for."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key: str) -> bytes:
        value = self.work(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value


def _known_kind(spec: dict) -> bool:
    """Whether a tokenizer composes, lower-cases, parts by ``_PATTERN`` and then takes bytes as letters."""
    normalizer, splitter = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps, parts = normalizer.get("normalizers", []), splitter.get("pretokenizers", [])
    return (
        [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": "\\s+"} and [part["type"] for part in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": _PATTERN} and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
        and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
    )


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, equal to those of the tokenizer.

    For tokenizers whose tokens never cross white space and that drop it. Blanks,
    tabs and line ends part a text into words. A word goes through the tokenizer's
    own normalizer, splitter and merges once, and its ids are kept. For the known
    kind of tokenizer, words of simple characters are parted here, which saves
    most of the time, and signs behind a word are parted from it beforehand, which
    leaves fewer different words. Words with an added token in them are encoded
    whole, and so are whole texts where added tokens take white space in.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.added = [token.content for token in added]
        self.whole = any(t.lstrip or t.rstrip or any(c.isspace() for c in t.content) for t in added)
        self.known = _known_kind(json.loads(self.tokenizer.to_str()))
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.words = _Known(self._word)
        self.parts = _Known(self._part)

    def _direct(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _merged(self, part: str) -> bytes:
        return _packed([token.id for token in self.tokenizer.model.tokenize(part)])

    def _part(self, part: str) -> bytes:
        return self._merged(part if part.isascii() else self.as_bytes(part)[0][0])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if self.known and _SIMPLE.fullmatch(word):
            if word.isalpha():
                return self._part(word.lower())
            if not self._has_added(word):
                return b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower())))
        if self._has_added(word):
            return self._direct(word)
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        word = word if normalizer is None else normalizer.normalize_str(word)
        parts = [word] if splitter is None else [part for part, _ in splitter.pre_tokenize_str(word)]
        return b"".join(map(self._merged, parts))

    def _has_added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def encode(self, text: str) -> bytes:
        if self.whole:
            return self._direct(text)
        for known, most in ((self.words, KEPT_WORDS), (self.parts, KEPT_PARTS)):
            if len(known) > most:
                known.clear()
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        if self.known and _SIMPLE.fullmatch(text) and not self._has_added(text):
            text = _SIGNS.sub(" ", text.lower())
        return b"".join(map(self.words.__getitem__, text.split(" ")))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder a worker, so that what it has learnt of words serves all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and with ``with_ids`` the ids, of every piece of every document.

    A document's ids are its text's and ``end_id``; a null text has the latter
    alone. Documents of more than ``capacity`` ids are cut into pieces of that
    length, the last of which may be shorter. Repeated rows give repeated
    pieces, a null doc_id stays null, columns but doc_id and text are left out,
    an empty table gives no pieces. ``tokenizer`` is a path that all machines have.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int64())))
    schema = pa.schema(fields)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            columns: list[list] = [[] for _ in fields]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(own) // 4, crc32(own))
                    for column, value in zip(columns, row, strict=False):
                        column.append(value)
                    if with_ids:
                        columns[-1].append(np.frombuffer(own, dtype="<u4").astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, type=field.type) for column, field in zip(columns, schema, strict=True)], schema=schema)

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, kinds)


# ---- the plan ---------------------------------------------------------------


class OpenBins:
    """Ranges of open bins by remaining capacity, under a segment tree that tells which capacities there are."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, first: int, count: int) -> None:
        self.ranges[room].append((first, count))
        node = room + self.leaves
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that an open bin has."""
        node = need + self.leaves
        if self.some[node]:
            return need
        while node > 1 and (node & 1 or not self.some[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> tuple[int, int]:
        """A range of the bins with this remaining capacity, which leaves the tree."""
        found = self.ranges[room].pop()
        if not self.ranges[room]:
            node = room + self.leaves
            self.some[node] = 0
            while node > 1 and not self.some[node ^ 1]:
                node >>= 1
                self.some[node] = 0
        return found


@dataclass(frozen=True)
class Plan:
    """Where pieces go: one entry for each step, sorted by length and rank.

    Pieces of ``length`` from rank ``rank`` on lie ``each`` to a bin, from bin
    ``first`` and there from ``offset`` on.
    """

    keys: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces, given by their lengths and ranks among those of the same length."""
        at = np.searchsorted(self.keys, (lengths << _RANKS) + ranks, side="right") - 1
        past, among = np.divmod(ranks - (self.keys[at] & ((1 << _RANKS) - 1)), self.each[at])
        return self.first[at] + past, self.offset[at] + among * lengths


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing of ``counts[length]`` pieces of every length from 1 to ``capacity``.

    A bin's room tells where its next piece starts. A bin that a piece fits
    tightest stays the tightest for the next piece of that length while it has
    room, so a bin with room r takes r // length of them at once.
    """
    open_bins, steps, bins = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit {capacity}")
        left, rank = counts[length], 0
        while left:
            room = open_bins.tightest(length)
            if room is None:
                room = capacity
                first, have = bins, -(-left // (capacity // length))
                bins += have
            else:
                first, have = open_bins.take(room)
            each = room // length
            full = min(have, left // each)
            if full:
                steps.append((length, rank, first, each, capacity - room))
                open_bins.put(room - each * length, first, full)
                first, have, rank, left = first + full, have - full, rank + full * each, left - full * each
            if have and left:
                steps.append((length, rank, first, left, capacity - room))
                open_bins.put(room - left * length, first, 1)
                first, have, rank, left = first + 1, have - 1, rank + left, 0
            if have:
                open_bins.put(room, first, have)
    steps.sort()
    length, rank, first, each, offset = (
        np.array([step[k] for step in steps], dtype=np.int64) for k in range(5))
    return Plan((length << _RANKS) + rank, first, each, offset, bins)


# ---- placing ----------------------------------------------------------------


def packed(pieces: DataFrame, *, capacity: int = CAPACITY, rows_per_run: int = ROWS_PER_RUN,
           tokens_per_run: int = TOKENS_PER_RUN) -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences as best-fit decreasing needs.

    ``length`` (1 to ``capacity``) is all that is used; other columns are
    carried along, and columns named sequence_id or offset are replaced.
    Sequences are filled from 0 on without gaps. Equal pieces are placed one by
    one. No pieces give no rows.
    """
    run = free_name(pieces, "_run")
    rest = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    held = settle(pieces.select(rest), "pieces")
    rows, tokens = held.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    runs = max(1, -(-rows // rows_per_run), -(-tokens // tokens_per_run))
    # Dealt by where a row lies in its file: equal rows part, and a row read again goes the same way.
    where = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    dealt = held.select("*", F.pmod(where, F.lit(runs)).alias(run))
    counts = dealt.groupBy(run, "length").agg(F.count("*").alias("_pieces"))
    earlier = Window.partitionBy("length").orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    # All columns anew: the two sides of a cogroup must not share any.
    starts = counts.select(
        F.col(run).alias("of_run"), F.col("length").alias("of_length"),
        F.coalesce(F.sum("_pieces").over(earlier), F.lit(0)).alias("start"))
    totals = counts.groupBy("length").agg(F.sum("_pieces").alias("_pieces"))
    plan = best_fit({int(row["length"]): row["_pieces"] for row in totals.collect()}, capacity)

    def place(own: pa.Table, before: pa.Table) -> pa.Table:
        # Any order will do, but a run that is worked out again must come out the same.
        own = own.drop_columns([run])
        simple = [f.name for f in own.schema if not pa.types.is_nested(f.type)]
        own = own.sort_by([(name, "ascending") for name in ["length", *(n for n in simple if n != "length")]])
        lengths = own.column("length").to_numpy().astype(np.int64)
        known = before.column("of_length").to_numpy()
        order = np.argsort(known)
        start = before.column("start").to_numpy()[order][np.searchsorted(known[order], lengths)]
        within = np.arange(len(lengths)) - np.searchsorted(lengths, lengths)
        bins, offsets = plan.places(lengths, start + within)
        return own.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    return dealt.groupBy(run).cogroup(starts.groupBy("of_run")).applyInArrow(
        place, f"{kinds}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, from pieces with their ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
