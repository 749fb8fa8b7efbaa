import numpy as np
import pandas as pd

import corpus_pipeline
from tests.llm.helpers import documents, words
from tickloom.llm.ngram_join import Likeness, gram_set, ngram_join
from tickloom.session import settle

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs):
    """The table after each stage."""
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_over_the_table(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    start, language, clean, once, mixture, tokens = (d.toPandas() for d in stages(spark, given))
    for part in (language, clean, once, mixture):
        assert list(part.columns) == COLUMNS
    assert set(language["doc_id"]) <= set(start["doc_id"]) and len(language) > 0.97 * len(start)
    # What is gone as toxic is mostly labelled so, where it is labelled.
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id")["toxic"]
    gone = labels[labels.index.isin(set(language["doc_id"]) - set(clean["doc_id"]))]
    assert gone.mean() > 0.7 and len(clean) > 0.8 * len(language)
    # No two documents left are linked, and every one that went is linked to another.
    sets = {i: gram_set(t.encode(), 5) for i, t in zip(clean["doc_id"], clean["text"], strict=True)}
    kept = set(once["doc_id"])
    assert len(once) == len(kept)
    rule = Likeness(80)

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return both > 0 and both >= rule.needed(len(sets[a]) + len(sets[b]))

    close = [i for i in sets if len(sets[i])]
    for i in set(sets) - kept:
        assert any(linked(i, j) for j in close if j != i and 0.8 <= len(sets[i]) / len(sets[j]) <= 1.25)
    some = sorted(kept)[::7]
    for n, i in enumerate(some):
        assert not any(linked(i, j) for j in some[n + 1:] if len(sets[i]) and len(sets[j]))
    # The mixture repeats whole documents and loses none.
    assert set(mixture["doc_id"]) == kept
    assert mixture.drop_duplicates("doc_id").set_index("doc_id")["text"].sort_index().equals(
        once.set_index("doc_id")["text"].sort_index())
    assert len(tokens) == len(mixture) and tokens["round_trip"].all()


def test_run_equals_the_stages(spark):
    want = stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))[-1].select("doc_id", "n_tokens").toPandas()
    found = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").toPandas()
    keys = ["doc_id", "n_tokens"]
    assert found.sort_values(keys, ignore_index=True).equals(want.sort_values(keys, ignore_index=True))


def test_odd_rows_pass(spark):
    said = "Words that are said here."
    rows = [(1, None), (2, "", "en", "s"), (3, "12 34", "en", None), (4, said, "en", None), (4, said, "en", None), (5, said, None, "s")]
    out = stages(spark, documents(spark, rows, extra=("score", "rejected", "class", "slot", "ids")))
    assert sorted(r["doc_id"] for r in out[1].collect()) == [4, 4, 5]
    assert {r["doc_id"] for r in out[3].collect()} == {4} and out[3].count() == 1
    assert {r["doc_id"] for r in out[-1].collect()} == {4}


def test_near_copies_go_by_row_and_not_by_id(spark):
    base, other = words(1, 60), " ".join(words(2, 60))
    copies = [" ".join(base + [end]) for end in ("one", "two", "three")]
    chain = [" ".join(base[k:k + 40] + ["tail"]) for k in (0, 3, 6)]
    kept = lambda rows: sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(
        spark, documents(spark, rows), SF).collect()), key=str)
    # Near copies without ids: one is left; with an id, the one with the id.
    assert len(kept([(None, t) for t in copies] + [(None, copies[0])])) == 1
    assert kept([(None, copies[0]), (7, copies[1]), (None, copies[2])]) == [(7, copies[1])]
    # An id with two texts loses only the copy.
    assert kept([(1, copies[0]), (2, copies[1]), (2, other)]) == [(1, copies[0]), (2, other)]
    # A link that leads through a row without id.
    found = ngram_join(documents(spark, [(5, chain[0]), (None, chain[1]), (6, chain[2])]), words=5, percent=75).collect()
    assert {r["component_id"] for r in found} == {5}
    assert kept([(None, None), (None, ""), (3, None)]) == sorted([(None, None), (None, ""), (3, None)], key=str)


def test_empty_table(spark):
    assert stages(spark, documents(spark, []))[-1].count() == 0
