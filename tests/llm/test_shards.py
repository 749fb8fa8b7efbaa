import numpy as np
import pytest

from tests.llm.helpers import documents, words
from tickloom.llm.shards import balanced_shards, difference


def check(df, rows, shards):
    found = df.toPandas()
    assert len(found) == len(rows)
    assert found["shard"].between(0, shards - 1).all()
    for _, part in found.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    texts = {r[0]: r[1] for r in rows}
    by_text = found.assign(text=found["doc_id"].map(texts).astype(object)).groupby("text", dropna=False)["shard"].nunique()
    assert (by_text == 1).all()
    return found


def test_differencing_is_tight():
    sizes = np.random.default_rng(3).integers(1, 10_000, 500)
    load = np.bincount(difference(sizes, 7), weights=sizes, minlength=7)
    assert load.max() - load.min() <= 2
    # Known case: 8 7 6 5 4 in two parts ends with a difference of 2.
    load = np.bincount(difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])
    assert sorted(load) == [14, 16]
    assert difference(np.array([], dtype=np.int64), 3).tolist() == []
    assert difference(np.array([5]), 3).tolist() == [0]


def plain_differencing(sizes, shards):
    """Partial partitions as lists of (sum, items), the two of largest spread combined until one is left."""
    parts = [(k, [(size, [k])] + [(0, [])] * (shards - 1)) for k, size in enumerate(sizes)]
    made = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[1][-1][0] - p[1][0][0], p[0]))
        (_, a), (_, b) = parts[:2]
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b), strict=True)]
        parts = [*parts[2:], (made, sorted(both, key=lambda s: -s[0]))]
        made += 1
    return parts[0][1]


@pytest.mark.parametrize("seed", range(8))
def test_differencing_equals_plain_differencing(seed):
    rng = np.random.default_rng(seed)
    shards, sizes = int(rng.integers(2, 7)), rng.integers(0, [5, 100, 10_000][seed % 3], int(rng.integers(1, 120)))
    found = difference(sizes, shards)
    want = plain_differencing(sizes.tolist(), shards)
    assert sorted(np.bincount(found, weights=sizes, minlength=shards).tolist()) == sorted(float(s) for s, _ in want)
    assert sorted(sorted(np.flatnonzero(found == k).tolist()) for k in range(shards)) == sorted(sorted(items) for _, items in want)


def test_groups_stay_together_and_slots_are_gapless(spark):
    rows = [(i, " ".join(words(i % 60, 5 + i % 60))) for i in range(300)] + [(900, None), (901, None), (902, ""), (903, "é")]
    found = check(balanced_shards(documents(spark, rows, extra=("shard", "slot", "_key")), 4), rows, 4)
    assert found.set_index("doc_id")["size"][900] == 8
    assert found.set_index("doc_id")["size"][903] == 10
    load = found.groupby("shard")["size"].sum()
    largest = found.assign(t=found["doc_id"].map(dict(rows)).astype(object)).groupby("t")["size"].sum().max()
    assert load.max() - load.min() <= largest


def test_bundles_hold_every_group(spark):
    rows = [(i, f"text {i} " * (1 + i % 9)) for i in range(400)]
    found = check(balanced_shards(documents(spark, rows), 3, bundles=30), rows, 3)
    load = found.groupby("shard")["size"].sum()
    assert load.max() - load.min() < 0.1 * load.mean()


def test_hot_group_and_empty_table(spark):
    rows = [(i, "same" if i % 3 == 0 else f"other {i}") for i in range(300)]
    check(balanced_shards(documents(spark, rows), 5), rows, 5)
    assert balanced_shards(documents(spark, []), 5).count() == 0
