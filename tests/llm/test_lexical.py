import random
import re
from collections import Counter, defaultdict
from math import floor, log

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, words
from tickloom.llm.lexical import Best, contributions, group_masks, ranked, terms_of
from tickloom.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every document scored for every item."""
    own = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    some, tokens = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    having = Counter(t for _, c in own for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id].update(plain_terms(text))
    out = []
    for item_id, terms in asked.items():
        scored = []
        for doc_id, counts in own:
            m = 10 + 90 * sum(counts.values()) * some // tokens if tokens else 0
            score = sum(
                floor(1000 * log((2 * some + 2) / (2 * having[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms if t in counts)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank + 1, None if null else doc_id, -score)
                for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: (r[0] is None, r))


def found_rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(df.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumns({n: F.lit(1) for n in ("score", "rank", "_task")})


@pytest.mark.parametrize("text", ["", "A-b C3.d", "\x7f\x80é日本, ÄÖü İ\x00x", "  tab\tnew\nline\xa0joined ", "{a}[b]`c~d|e^f_g@h/i:j;"])
def test_terms(text):
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def test_odd_rows(spark):
    vocabulary = words(1, 60)
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice(vocabulary[:5 + i % 50]) for _ in range(1 + i * i % 90))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "!!!"), (None, docs[3][1]), (3, docs[3][1]), (7, "other text of a known id " + vocabulary[0])]
    docs += [(600 + i, " ".join(vocabulary[:12])) for i in range(40)] + [(900, " ".join(vocabulary) * 300), (2**60 + 1, "Ünïcode ZZZ")]
    items = [(i, " ".join(vocabulary[i:i + 9]) + " THE, the") for i in range(12)]
    items += [(50, None), (51, ""), (52, "nothing matches this-1x2y"), (1, vocabulary[40]), (1, vocabulary[40]), (None, vocabulary[7].upper()),
              (60, " ".join(words(9, 100) + vocabulary)), (61, "ünïcode Ünïcode zzz")]
    found = found_rows(ranked(documents(spark, docs, extra=("score", "rank", "terms", "tokens")), items_table(spark, items)))
    assert found == brute(docs, items)
    assert any(r[0] == 61 and r[2] == 2**60 + 1 for r in found)
    # Items in several blocks give the same.
    assert found_rows(ranked(documents(spark, docs), items_table(spark, items), item_bytes=600, k=3)) == brute(docs, items, 3)


def test_merging_many_tasks(spark, monkeypatch):
    monkeypatch.setattr("tickloom.llm.lexical.TASKS_PER_MERGE", 2)
    monkeypatch.setattr("tickloom.llm.lexical.CELLS", 40)
    docs = [(i, f"common word{i % 7} word{i % 3}") for i in range(300)]
    items = [(1, "common word3 word1"), (2, "word6")]
    assert found_rows(ranked(documents(spark, docs).repartition(7), items_table(spark, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "some words")], [(1, "some")]
    assert ranked(documents(spark, []), items_table(spark, items)).count() == 0
    assert ranked(documents(spark, docs), items_table(spark, [])).count() == 0
    assert ranked(documents(spark, [(1, None)]), items_table(spark, items)).count() == 0
    # The only document holds the term, so that its weight is floor(1000 ln(4/3)).
    assert found_rows(ranked(documents(spark, docs), items_table(spark, items))) == brute(docs, items)


def test_masks_group_equal_columns():
    rng = np.random.default_rng(3)
    for terms in (3, 8, 61, 130):
        bits = rng.random((terms, 400)) < 0.05
        masks, group = group_masks(np.packbits(bits, axis=0))
        back = np.unpackbits(masks, axis=0, count=terms)
        assert (back[:, group] == bits).all() and len(np.unique(back, axis=1).T) == masks.shape[1]


def test_most_documents_are_never_evaluated():
    """Groups whose best possible score is too low are passed over, and the best are right all the same."""
    rng = np.random.default_rng(5)
    counts = (rng.random((12, 5000)) < np.linspace(0.9, 0.02, 12)[:, None]).astype(np.int32) * rng.integers(1, 4, (12, 5000), dtype=np.int32)
    lengths, weights = rng.integers(80, 130, 5000), np.linspace(60, 4000, 12).astype(np.int64)
    best = Best(np.arange(12), weights, 10)
    evaluated = best.search(counts > 0, counts, lengths, list(range(5000)))
    scores = contributions(weights[:, None], counts.astype(np.int64), lengths).sum(axis=0)
    assert best.rows == sorted((-int(s), False, i) for i, s in enumerate(scores))[:10]
    assert evaluated < 1000


def test_whole_table_equals_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = found_rows(QUERIES["op13_presence_masks"](spark, folder))
    assert found == brute(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    assert found == sorted(con.execute(ORACLES["op13_presence_masks"]).fetchall())
