import random

import numpy as np
import pytest

from tests.llm.helpers import documents, words
from tickloom.llm import ngram_join as nj
from tickloom.llm.ngram_join import Likeness, PrefixTree, gram_set, ngram_join, signatures


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    above = {i: i for i in sets}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                above[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(base, rnd, edits):
    out = list(base)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = "".join(rnd.choice("qrstuvwxyz") for _ in range(6))
    return out


def corpus(seed, groups=8):
    rnd = random.Random(seed)
    passage = words(999, 50)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Two words"), (5, "two\twords"), (6, "two words more"), (7, "Ünï CODE ünï"),
            (8, "ünï code ÜNÏ")]
    number = 10
    for g in range(groups):
        base = words(seed * 100 + g, rnd.choice([8, 12, 30, 90, 200]))
        if g % 2:
            base = base + passage
        for _ in range(rnd.randint(1, 9)):
            rows.append((number, " ".join(edited(base, rnd, rnd.randint(0, 3)))))
            number += 1
    rows.append((number, rows[-1][1]))
    return rows


@pytest.mark.parametrize("size,percent,seed", [(4, 85, 1), (5, 80, 2), (4, 50, 3), (2, 95, 4)])
def test_equals_brute_force(spark, size, percent, seed):
    rows = corpus(seed)
    found = ngram_join(documents(spark, rows, extra=("class", "mark", "grams")), words=size, percent=percent).toPandas()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()}
    assert got == brute(rows, size, percent)


def test_large_group_of_near_copies_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nj, "TREE_GRAMS", 2_000)
    monkeypatch.setattr(nj, "BUCKET_MARKS", 5_000)
    rnd = random.Random(5)
    base = words(77, 120)
    rows = [(i, " ".join(edited(base, rnd, rnd.randint(0, 4)))) for i in range(150)]
    found = ngram_join(documents(spark, rows), words=4, percent=85).toPandas()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == brute(rows, 4, 85)


def test_repeated_rows_long_text_and_empty_table(spark):
    long = " ".join(words(3, 30_000))
    large = 2**62 + 1
    rows = [(1, long), (1, long), (2, long + " tail"), (3, "a b c d e f g h"), (large, "q r s t"), (None, "no id"), (None, None)]
    found = [tuple(r) for r in ngram_join(documents(spark, rows), words=4, percent=85).collect()]
    assert sorted(r[0] or 0 for r in found) == [0, 0, 1, 1, 2, 3, large]
    component = {r[0]: r[2] for r in found}
    assert component == {1: 1, 2: 1, 3: 3, large: large, None: None}
    assert ngram_join(documents(spark, []), words=4, percent=85).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_linked_sets_share_marks_and_the_tree_finds_them(percent):
    rnd, rule = random.Random(percent), Likeness(percent)
    for _ in range(30):
        base = [rnd.getrandbits(64) for _ in range(rnd.choice([4, 6, 7, 10, 20, 40, 100]))]
        sets = []
        for _ in range(10):
            one = set(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 8))):
                one.add(rnd.getrandbits(64)) if rnd.random() < 0.5 else one.discard(rnd.choice(base))
            sets.append(np.array(sorted(one), dtype=np.uint64))
        links = set()
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(np.intersect1d(a, b))
                if i != j and 100 * both >= percent * (len(a) + len(b) - both):
                    links.add((i, j))
                    marks_a, need_a = signatures(a, rule)
                    marks_b, need_b = signatures(b, rule)
                    common = np.intersect1d(marks_a, marks_b)
                    if not np.array_equal(a, b):
                        levels, counts = np.unique(common & np.uint64(63), return_counts=True)
                        needs = dict(zip((marks_a & np.uint64(63)).tolist(), need_a.tolist(), strict=True))
                        assert any(n >= needs[level] for level, n in zip(levels.tolist(), counts.tolist(), strict=True))
        grams, place = np.unique(np.concatenate(sets), return_inverse=True)
        rows = [np.sort(r) for r in np.split(place, np.cumsum([len(s) for s in sets])[:-1])]
        tree = PrefixTree(rows)
        found = set()
        for q, row in enumerate(rows):
            has = np.zeros(len(grams), dtype=bool)
            has[row] = True
            found |= {(q, i) for i in tree.linked(has, len(row), rule) if i != q}
        assert found == links


def test_words_are_split_at_ascii_white_space_only():
    assert len(gram_set("a b c".encode(), 1)) == 2
    assert np.array_equal(gram_set(b"A B\x0bC", 2), gram_set(b"a b c", 2))
    assert not np.array_equal(gram_set("É".encode(), 1), gram_set("é".encode(), 1))


@pytest.mark.parametrize("percent", [10, 30, 50, 65, 80, 85])
def test_subsets_of_any_size_share_marks(percent):
    whole = np.unique(np.random.default_rng(percent).integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
    for large in (12, 19, 40, 400):
        for small in range(-(-percent * large // 100), large):
            if not Likeness(percent).differing(large):
                continue
            (a, need_a), (b, need_b) = (signatures(np.sort(whole[:n]), Likeness(percent)) for n in (small, large))
            both = np.intersect1d(a, b)
            assert len(both) >= min(need_b[np.isin(b, both)].min(initial=65535), need_a[np.isin(a, both)].min(initial=65535))


def test_a_small_set_within_a_large_one(spark):
    text = words(77, 22)
    rows = [(1, " ".join(text[:15])), (2, " ".join(text))]
    found = ngram_join(documents(spark, rows), words=4, percent=50).toPandas().sort_values("doc_id")
    assert found["n_shingles"].tolist() == [12, 19] and found["component_id"].tolist() == [1, 1]


def test_refuses_percents_without_meaning(spark):
    for percent in (0, -5, 101):
        with pytest.raises(ValueError):
            ngram_join(documents(spark, [(1, "a")]), words=4, percent=percent)
