import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import documents, words
from tickloom.llm.packing import OpenBins, WordEncoder, best_fit, packed, sequences, token_pieces
from tickloom.llm.queries import QUERIES

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, capacity):
    """One piece after the other, every open bin looked at; the room left in each bin."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return rooms


def check_gapless(rows, capacity):
    """rows: (sequence_id, offset, length)."""
    by = defaultdict(list)
    for sequence, offset, length in rows:
        by[sequence].append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_plain_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 16, 100, 4096])
    top = rnd.choice([capacity, max(1, capacity // 3), max(1, capacity // 2 + 1)])
    lengths = [rnd.randint(1, top) for _ in range(rnd.choice([1, 30, 700]))]
    lengths += [rnd.choice(lengths)] * rnd.choice([0, 50, 400])
    counts = Counter(lengths)
    plan = best_fit(counts, capacity)
    rows = []
    for length, count in counts.items():
        bins, offsets = plan.places(np.full(count, length), np.arange(count))
        rows += zip(bins.tolist(), offsets.tolist(), [length] * count, strict=True)
    by = check_gapless(rows, capacity)
    assert set(by) == set(range(plan.bins))
    rooms = Counter(capacity - sum(length for _, length in parts) for parts in by.values())
    assert rooms == Counter(plain_best_fit(lengths, capacity))


def test_plan_does_not_grow_with_the_documents():
    counts = {length: 1 + length * 7 % 90 for length in range(1, 4097)}
    small, large = best_fit(counts, 4096), best_fit({k: v * 1_000_000 for k, v in counts.items()}, 4096)
    tokens = sum(k * v * 1_000_000 for k, v in counts.items())
    assert large.bins < 1.001 * tokens / 4096
    assert len(large.keys) < 3 * len(small.keys)


def test_tree_finds_the_tightest():
    rnd = random.Random(4)
    tree, held = OpenBins(50), Counter()
    for step in range(3000):
        need = rnd.randint(1, 50)
        fitting = [room for room in held if room >= need]
        assert tree.tightest(need) == (min(fitting) if fitting else None)
        if rnd.random() < 0.55 and step < 2500:
            room = rnd.randint(0, 50)
            tree.put(room, step, 1)
            held[room] += 1
        elif held:
            room = rnd.choice(sorted(held))
            tree.take(room)
            held -= Counter([room])
    with pytest.raises(ValueError):
        best_fit({51: 1}, 50)
    assert best_fit({}, 50).bins == 0


ODD = [
    "", " ", "Plain words, twice: plain words.", "it's they'll I'd 12345 a1b2", "tab\there\nline\r\nend\x0b\x0c\x1c\x85x\xa0y z",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "<|end oftext|>", "İstanbul ΣΑΣ ǅ straße", "étude café ́x",
    "Él ŐRÜLT naïve, ſtraße ŉa ÷× don't L'ÉTÉ's ÀÉ_x¼² ª", "…,! —“quoted”—", "日本語のテキスト。 한국어 العربية", "😀 👩‍👩‍👧 zero​width", "\x00nul ﻿bom", "x" * 5000, "!?" * 3000, "ab " * 3000,
]


def test_ids_equal_the_tokenizer():
    plain, own = Tokenizer.from_file(WORD_BPE), WordEncoder(WORD_BPE)
    for text in ODD + [" ".join(words(3, 4000))]:
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text[:50]


def test_ids_survive_full_caches(monkeypatch):
    monkeypatch.setattr("tickloom.llm.packing.KEPT_WORDS", 5)
    monkeypatch.setattr("tickloom.llm.packing.KEPT_PARTS", 5)
    test_ids_equal_the_tokenizer()


def expected_pieces(rows, capacity):
    plain, out = Tokenizer.from_file(WORD_BPE), []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        out += [(doc_id, at // capacity, at, len(ids[at:at + capacity]), crc32(np.array(ids[at:at + capacity], dtype="<u4").tobytes()))
                for at in range(0, len(ids), capacity)]
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def test_documents_with_odd_rows(spark):
    rows = list(enumerate(ODD)) + [(100, None), (None, "no id"), (None, None), (7, "again"), (7, "again"), (2**60 + 1, "far id")]
    rows += [(1000 + i, "same text in many rows") for i in range(400)]
    docs = documents(spark, rows, extra=("length", "sequence_id", "offset", "_run", "ids", "piece"))
    for capacity in (16, 4096):
        pieces = token_pieces(docs, WORD_BPE, capacity=capacity)
        found = packed(pieces, capacity=capacity, rows_per_run=50).collect()
        want = expected_pieces(rows, capacity)
        assert sorted((tuple(r[:5]) for r in found), key=key) == sorted(want, key=key)
        by = check_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in found], capacity)
        assert len(by) == len(plain_best_fit([w[3] for w in want], capacity))


def test_sequences_hold_the_ids(spark):
    rows = [(i, " ".join(words(i, 5 + i))) for i in range(40)]
    pieces = token_pieces(documents(spark, rows), WORD_BPE, capacity=32, with_ids=True)
    placed = packed(pieces, capacity=32)
    found = {r["sequence_id"]: r["ids"] for r in sequences(placed).collect()}
    for r in placed.collect():
        assert found[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    assert sum(map(len, found.values())) == sum(w[3] for w in expected_pieces(rows, 32))


def test_extra_columns_and_empty_table(spark):
    pieces = spark.createDataFrame([(5, "a"), (5, "a"), (3, "b"), (2, None)], "length long, _run string").withColumn("offset", F.lit("x"))
    found = packed(pieces, capacity=8).orderBy("sequence_id", "offset")
    assert found.columns == ["length", "_run", "sequence_id", "offset"]
    assert [tuple(r) for r in found.collect()] in (
        [(5, "a", 0, 0), (3, "b", 0, 5), (5, "a", 1, 0), (2, None, 1, 5)], [(5, "a", 0, 0), (2, None, 0, 5), (5, "a", 1, 0), (3, "b", 1, 5)])
    assert packed(token_pieces(documents(spark, []), WORD_BPE)).count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op12_best_fit"](spark, folder)
    assert dict(found.dtypes) == {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint"}
    found = found.collect()
    want = expected_pieces(docs, 4096)
    assert sorted(tuple(r[:5]) for r in found) == sorted(want)
    by = check_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in found], 4096)
    assert len(by) == len(plain_best_fit([w[3] for w in want], 4096))
    assert len(by) <= 1.01 * -(-sum(w[3] for w in want) // 4096) + 1
