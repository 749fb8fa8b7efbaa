"""SentencePiece encoding and decoding, all distinct words of a batch in one trie.

Spaces are the marks of words, which pieces show as ▁, and a text is a sequence
of marked words: some marks, then anything else up to the next mark. No piece
goes on after a mark that follows another character, so words are encoded on
their own. The distinct
words of a batch are sorted, which makes them a trie in order of depth-first
traversal: what two neighbours share at their beginning is the path they share,
and the forward states of those positions are reused.

The forward state of a position is the best way to reach it. In a unigram model
that is the largest sum of scores (Viterbi). In a BPE model the best way is the
one that merging by rank takes, and the state is the last piece of the prefix's
own segmentation: a piece may follow another just if merging the two leaves
them as they are, and of all pieces that end at a position just one does so.
Both read the pieces, scores and kind from the given model file.
"""

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tickloom.llm.common import free_name, kept_in_worker

#: How the model file writes a mark; here it is the space that it stands for.
SHOWN, MARK = "▁", " "
#: Encoded words that a worker keeps from one batch to the next.
KEPT_WORDS = 250_000
#: Pairs of pieces for which it keeps whether they stand.
KEPT_PAIRS = 300_000
#: Rows of a batch that go back at a time.
OUT_ROWS = 500
_UNIGRAM, _BPE = 1, 2
_NORMAL, _USER, _BYTE = 1, 4, 6


class PieceModel:
    """Pieces of a SentencePiece model of kind BPE or unigram whose normaliser changes nothing but spaces."""

    def __init__(self, path: str, kind: int | None = None):
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.kind = kind or model.trainer_spec.model_type
        spec = model.normalizer_spec
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only BPE and unigram models are read")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces \
                or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model's normaliser changes texts, so they could not be decoded to the same")
        self.prefix = spec.add_dummy_prefix
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == 2), 0)
        self.ids = {p.piece.replace(SHOWN, MARK): i for i, p in enumerate(model.pieces) if p.type in (_NORMAL, _USER)}
        self.scores = {p: model.pieces[i].score for p, i in self.ids.items()}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.longest = max(map(len, self.ids), default=1)
        crossing = [p for p in self.ids if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces run over the end of a word: {crossing[:3]}")
        self._bytes_of = [p.piece.replace(SHOWN, MARK).encode() for p in model.pieces]
        for value, i in self.bytes.items():
            self._bytes_of[i] = bytes([value])
        for i, p in enumerate(model.pieces):
            if p.type in (2, 3):
                self._bytes_of[i] = b"\xef\xbf\xbd" if p.type == 2 else b""
        self._worst = min(self.scores.values(), default=0.0) - 10.0
        # Which lengths the pieces have that end as a position's last four characters do, longest first;
        # for other endings, those of up to three characters.
        ends: dict[str, set[int]] = {}
        for piece in self.ids:
            ends.setdefault(piece[-4:], set()).add(len(piece))
        self._lengths: dict[str, list[int]] = {}
        for tail, found in ends.items():
            found.update(n for n in (1, 2, 3) if n < len(tail) and (n == 1 or tail[-n:] in self.ids))
            self._lengths[tail] = sorted(found, reverse=True)
        self._endings = frozenset(ends)
        # For each piece: whether it stands after another one, as found so far.
        self._after: dict[str, dict[str, bool]] = {p: {} for p in self.ids}
        self._pairs = 0
        self._kept: dict[str, bytes] = {}

    # Merging by rank, for pairs of pieces only.

    def _stands(self, before: str, piece: str) -> bool:
        """Whether merging leaves the two pieces as they are; ``before`` is empty at the start of a word.

        Merges the best-scored neighbours, the leftmost of equals, until two
        merge that lie on either side of the border or nothing merges any more.
        """
        parts = list(before + piece)
        none, scores = float("-inf"), self.scores
        found = [scores.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        border = len(before) - 1  # the neighbours at this place lie on either side
        while found:
            best = max(found)
            if best == none:
                break
            at = found.index(best)
            if at == border:
                return False
            if at < border:
                border -= 1
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = scores.get(parts[at] + parts[at + 1], none)
            if at:
                found[at - 1] = scores.get(parts[at - 1] + parts[at], none)
        return parts == [p for p in (before, piece) if p]

    # Forward states of the positions after ``shared``, given those up to it. states[0] is the start.

    def _lengths_for(self, tail: str) -> list[int]:
        """The lengths for an ending that no piece has whole: those of the longest part of it."""
        if len(self._lengths) > KEPT_WORDS:
            self._lengths = {t: found for t, found in self._lengths.items() if t in self._endings}
        found = next((self._lengths[tail[k:]] for k in range(1, len(tail)) if tail[k:] in self._endings), [1])
        own = self._lengths[tail] = [n for n in found if n <= 3]
        return own

    def _last_pieces(self, word: str, shared: int, states: list) -> None:
        """Merging by rank: the last piece of each prefix's own segmentation.

        Of all pieces that end at a position one stands. The length that last did
        after the same characters is tried first.
        """
        lengths, after = self._lengths, self._after
        for end in range(shared + 1, len(word) + 1):
            tail = word[end - 4:end] if end > 4 else word[:end]
            tried = lengths.get(tail) or self._lengths_for(tail)
            for length in tried:
                if length > end:
                    continue
                piece = word[end - length:end]
                known = after.get(piece)
                if known is None:
                    if length > 1:
                        continue
                    known = after[piece] = {}
                before = states[end - length]
                stands = known.get(before)
                if stands is None:
                    stands = known[before] = self._stands(before, piece)
                    self._pairs += 1
                if stands:
                    states.append(piece)
                    if length != tried[0]:
                        tried.remove(length)
                        tried.insert(0, length)
                    break

    def _best_sums(self, word: str, shared: int, states: list) -> None:
        """Viterbi: the largest sum of scores, the longer last piece of equals, and that piece."""
        scores, lengths = self.scores, self._lengths
        for end in range(shared + 1, len(word) + 1):
            best = None
            tail = word[max(0, end - 4):end]
            for length in lengths.get(tail) or self._lengths_for(tail):
                if length > end:
                    continue
                piece = word[end - length:end]
                score = scores.get(piece, self._worst if length == 1 else None)
                if score is not None:
                    total = states[end - length][0] + score
                    if best is None or total > best[0]:
                        best = (total, piece)
            states.append(best)

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids (as 32-bit numbers) of each of the distinct ``words``, in one traversal of their trie."""
        by_rank = self.kind == _BPE
        forward = self._last_pieces if by_rank else self._best_sums
        found = {}
        states: list = ["" if by_rank else (0.0, "")]
        before = ""
        single = MARK if self.prefix else ""
        for name in sorted(words):
            word = name if name[0] == MARK else single + name
            shared = 0
            for a, b in zip(word, before, strict=False):
                if a != b:
                    break
                shared += 1
            del states[shared + 1:]
            forward(word, shared, states)
            pieces = []
            end = len(word)
            while end:
                piece = states[end] if by_rank else states[end][1]
                pieces.append(piece)
                end -= len(piece)
            pieces.reverse()
            found[name] = array("i", self._ids(pieces)).tobytes()
            before = word
        return found

    def _ids(self, pieces: list[str]) -> list[int]:
        try:
            return [self.ids[piece] for piece in pieces]
        except KeyError:
            pass
        found = []
        unknown = False
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                found.append(known)
            elif self.bytes:
                found += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not unknown:
                found.append(self.unknown)  # neighbouring unknown characters are one unknown piece
            unknown = known is None
        return found

    def words(self, text: str) -> list[str]:
        """The marked words. If the model puts a mark before a text, those with one mark are given without it."""
        if not text:
            return []
        if SHOWN in text:
            text = text.replace(SHOWN, MARK)
        if self.prefix and "  " not in text and text[0] != MARK and text[-1] != MARK:
            return text.split(MARK)
        marked = MARK + text if self.prefix else text
        # After a mark that follows no mark a new word begins.
        parts = marked.split(MARK)
        found = [parts[0]] if parts[0] else []
        marks = 0
        for part in parts[1:]:
            marks += 1
            if part:
                found.append(part if marks == 1 and self.prefix else MARK * marks + part)
                marks = 0
        if marks:
            found.append(MARK * marks)
        return found

    def encode(self, texts: list[str | None], chars: int = 8_000_000) -> Iterator[np.ndarray]:
        """The ids of every text, none for a null or empty one; texts of about ``chars`` share a trie."""
        kept = self._kept
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (held < chars or end == start):
                held += len(texts[end] or "")
                end += 1
            # Texts are split twice, so that no more than the distinct words are held.
            used: set[str] = set()
            for text in texts[start:end]:
                if text:
                    used.update(self.words(text))
            kept.update(self.encode_words([w for w in used if w not in kept]))
            for text in texts[start:end]:
                words = self.words(text) if text else []
                yield np.frombuffer(b"".join(map(kept.__getitem__, words)), dtype=np.int32)
            if len(kept) > KEPT_WORDS:
                kept = self._kept = {w: kept[w] for w in used}
            if self._pairs > KEPT_PAIRS:
                self._after, self._pairs = {p: {} for p in self.ids}, 0
            start = end

    def decode(self, ids) -> str:
        """The text of ``ids``."""
        raw = b"".join(map(self._bytes_of.__getitem__, ids))
        if self.prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """The model of a file that every executor has; read once in a worker."""
    return PieceModel(path)


kept_in_worker(load_model.cache_clear)


def encode_texts(docs: DataFrame, model_path: str, *, check: bool = True) -> DataFrame:
    """``docs`` with ids (array<int>), n_tokens and, with ``check``, whether decoding gives the text back.

    A null text has null ids, no tokens and ``round_trip`` null; an empty text
    has no ids. Columns of ``docs`` with those names are replaced.
    """

    def table(rows: list, same: list) -> pd.DataFrame:
        return pd.DataFrame({"ids": pd.Series(rows, dtype=object), "round_trip": pd.array(same, dtype="boolean")})

    @F.pandas_udf("ids array<int>, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model(model_path)
        for texts in batches:
            rows, same = [], []
            for text, ids in zip(texts, model.encode(texts.tolist()), strict=True):
                rows.append(None if text is None else ids)
                same.append(None if text is None or not check else model.decode(ids.tolist()) == text)
                if len(rows) == OUT_ROWS:
                    yield table(rows, same)
                    rows, same = [], []
            yield table(rows, same)

    # Else a filter on what comes out would run it once more below.
    run = run.asNondeterministic()
    new = ("ids", "n_tokens", "round_trip")
    kept = [c for c in docs.columns if c not in new]
    held = free_name(docs, "_done")
    done = docs.select(*kept, run("text").alias(held))
    return done.select(
        *kept, F.col(f"{held}.ids").alias("ids"),
        F.coalesce(F.size(F.col(f"{held}.ids")), F.lit(0)).cast("long").alias("n_tokens"),
        F.col(f"{held}.round_trip").alias("round_trip"))


def decode_ids(rows: DataFrame, model_path: str) -> DataFrame:
    """``rows`` with ``text`` from ``ids``; null ids give a null text."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        model = load_model(model_path)
        return ids.map(lambda row: None if row is None else model.decode(row))

    kept = [c for c in rows.columns if c != "text"]
    return rows.select(*kept, run("ids").alias("text"))
