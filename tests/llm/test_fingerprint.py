import hashlib
import random
import string
import zlib

from tests.llm.helpers import documents, words
from tickloom.llm.fingerprint import edit_distance, fingerprint, fingerprints, likeness


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(2)
    for _ in range(400):
        a, b = ("".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 90))) for _ in range(2))
        assert edit_distance(a, b) == plain_distance(a, b)


def test_likeness():
    text = " ".join(words(1, 800))
    cut = text[:3000] + " ".join(words(2, 20)) + text[3000:]
    other = " ".join(words(3, 800))
    mine = fingerprint(text)
    assert likeness(mine, mine) == 1.0 and mine == fingerprint(text)
    assert likeness(mine, fingerprint(cut)) > 0.7
    assert likeness(mine, fingerprint(other)) == 0.0
    assert likeness(mine, fingerprint("")) == 0.0 and likeness(fingerprint(""), fingerprint("")) == 1.0
    assert likeness(mine, fingerprint(text * 40)) <= 1.0


def test_boundaries_depend_on_nearby_bytes():
    text = " ".join(words(4, 3000))
    size, marks, _ = fingerprint(text).split(":")
    later, moved, _ = fingerprint("inserted " + text).split(":")
    assert size == later and marks[1:] == moved[-len(marks) + 1:]


def plain_fingerprint(text):
    """One byte after the other: the hash of the last seven bytes, and chunks cut where it has its form."""
    raw, mask, hashes = text.encode(), (1 << 32) - 1, []
    for i in range(len(raw)):
        h = 0
        for back in range(min(7, i + 1)):
            h = (h + (raw[i - back] + 1) * pow(0x01000193, back + 1, 1 << 32)) & mask
        h ^= h >> 15
        h = h * 0x2C1B3C6D & mask
        hashes.append(h ^ h >> 12)

    def ends_at(h, size):
        # The block sizes are 3, 6, 12, ...: a multiple of the size ends a chunk.
        return h % size == 0

    def signature(size):
        marks, start = "", 0
        for i, h in enumerate(hashes, 1):
            if ends_at(h, size) or i == len(raw):
                alphabet = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"
                marks += alphabet[zlib.crc32(raw[start:i]) * 0x9E3779B1 >> 20 & 63]
                start = i
        return marks

    size = 3
    while sum(ends_at(h, size) for h in hashes) > 64:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def test_fingerprint_equals_a_byte_by_byte_one():
    texts = ["", "a", "abc", "abcdefgh", "🙂é" * 40, "a" * 3000, *(" ".join(words(40 + k, 3 ** k)) for k in range(8))]
    for text in texts:
        assert fingerprint(text) == plain_fingerprint(text), text[:40]


def test_odd_texts():
    for text in ("", "a", "ab", "a" * 50_000, "\x00" * 500, "🙂" * 300, "abc" * 9_000):
        mark = fingerprint(text)
        assert mark.count(":") == 2 and 0.0 <= likeness(mark, fingerprint(text + "x")) <= 1.0
    text = " ".join(words(5, 60_000))
    assert len(fingerprint(text)) < 200


def expected(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for n, (i, text) in enumerate(rows):
        text = text or ""
        following = rows[(n + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        out[i] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(text), fingerprint(edited),
            likeness(fingerprint(text), fingerprint(edited)), likeness(fingerprint(text), fingerprint(following)))
    return out


def test_every_row_meets_the_next_one(spark):
    rows = [(i * 3, " ".join(words(i, 5 + i * 3))) for i in range(120)] + [(1, None), (2, ""), (400, "ü🙂é" * 40)]
    docs = documents(spark, rows, extra=("part", "seam", "next_text")).repartition(7)
    found = {r[0]: tuple(r[1:]) for r in fingerprints(docs).collect()}
    assert found == expected(rows)


def test_few_rows(spark):
    for rows in ([(5, "alone in the table")], [(1, "one"), (2, None)], []):
        assert {r[0]: tuple(r[1:]) for r in fingerprints(documents(spark, rows)).collect()} == expected(rows)


def test_repeated_and_null_ids_stay(spark):
    large = 2**62 + 1
    rows = [(7, "x y z"), (7, "x y z"), (None, "no id"), (3, "q"), (large, "large")]
    found = fingerprints(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == [
        (False, 3), (False, 7), (False, 7), (False, large), (True, 0)]
