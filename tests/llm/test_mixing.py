import numpy as np
import pytest

from tests.llm.helpers import documents
from tickloom.llm.mixing import dealt_before, mixed, schedule, whole_weights


WEIGHTS = [
    {"a": 1, "b": 1, "c": 1}, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 97, "b": 1, "c": 1, "d": 1}, {"only": 3},
    {str(i): i + 1 for i in range(40)}, {"a": 0.7, "b": 0.3, "rare": 1e-5},
]


@pytest.mark.parametrize("weights", WEIGHTS)
@pytest.mark.parametrize("cuts", [[0, 3000], [0, 1, 2, 3, 10, 500, 501, 1777, 3000]])
def test_every_prefix_is_less_than_a_block_off_across_segments(weights, cuts):
    whole = whole_weights(weights)
    rows = [r for start, end in zip(cuts, cuts[1:]) for r in schedule(whole, start, end)]
    assert [r[4] for r in rows] == list(range(cuts[-1]))
    total, dealt = sum(whole.values()), dict.fromkeys(whole, 0)
    for source, block, release, deadline, slot in rows:
        # Its blocks in order, each within the window that the weight alone gives it.
        assert block == dealt[source] and release <= slot < deadline
        assert release == block * total // whole[source] and deadline == -(-(block + 1) * total // whole[source])
        dealt[source] += 1
        for s, n in dealt.items():
            assert abs(n * total - (slot + 1) * whole[s]) < total


def test_shares_at_a_cut():
    assert dealt_before({"a": 1, "b": 1}, 3) == {"a": 2, "b": 1}
    assert dealt_before({"a": 2, "b": 3}, 0) == {"a": 0, "b": 0}
    for bad in ({"a": 0.0}, {"a": -1, "b": 2}, {"a": float("nan")}):
        with pytest.raises(ValueError):
            whole_weights(bad)


def test_segments_and_repeated_rows_keep_texts(spark, monkeypatch):
    monkeypatch.setattr("tickloom.llm.mixing.SEGMENT_SLOTS", 7)
    monkeypatch.setattr("tickloom.llm.mixing.ROWS_PER_RUN", 9)
    rows = [(i % 50, f"t{i % 75}", None, "a" if i % 3 else "b") for i in range(300)] + [(None, "x", None, "a")] * 5 + [(None, None, None, "b")]
    found = mixed(documents(spark, rows), block_rows=2, carry=("text", "lang")).toPandas()
    first = found[found["epoch"] == 0]
    assert sorted(zip(first["doc_id"].fillna(-1), first["text"].fillna("-"), first["source"])) == sorted(
        (float(-1 if r[0] is None else r[0]), r[1] or "-", r[3]) for r in rows)
    # Positions are the rows in order; at the end a source's last block may be cut.
    assert found["position"].is_unique and found["slot"].nunique() == found["slot"].max() + 1
    assert (found.groupby("slot")["source"].nunique() == 1).all()
    assert (found["release"] <= found["slot"]).all() and (found["slot"] < found["deadline"]).all()


def test_mixture_holds_every_row_and_keeps_the_weights(spark):
    rows = [(i, f"t{i}", None, "hot" if i % 2 else f"s{i % 6}") for i in range(240)] + [(900, None, None, None), (901, "", None, "")]
    docs = documents(spark, rows, extra=("epoch", "slot", "_rows"))
    found = mixed(docs, block_rows=4, carry=("text",)).toPandas()
    assert set(found["doc_id"]) == {r[0] for r in rows}
    assert dict(found[["doc_id", "text"]].drop_duplicates().values.tolist()) == {r[0]: r[1] for r in rows}
    assert found["position"].is_unique
    assert (found["release"] <= found["slot"]).all() and (found["slot"] < found["deadline"]).all()
    assert (found.groupby("slot")["source"].nunique() == 1).all()
    # Blocks of a source are whole but for the end, and its rows take turns.
    assert (found.groupby("slot").size() == 4).all()
    turns = found.groupby(["source", "doc_id"])["epoch"].agg(["min", "count"])
    assert (turns["min"] == 0).all()
    spread = turns["count"].groupby("source").agg(["min", "max"])
    assert (spread["max"] - spread["min"] <= 1).all()
    # Shares at the end differ from the target by less than a block.
    counts = {"hot": 120, "": 2, **{f"s{k}": 40 for k in (0, 2, 4)}}
    total = sum(n ** 0.8 for n in counts.values())
    slots = found["slot"].max() + 1
    for source, n in counts.items():
        share = found[found["source"] == source]["slot"].nunique()
        assert abs(share - slots * n ** 0.8 / total) < 1.1


def test_given_weights_and_repeated_rows(spark):
    rows = [(i, "x", None, "a") for i in range(40)] + [(i, "x", None, "b") for i in range(40, 60)] + [(0, "x", None, "a")]
    found = mixed(documents(spark, rows), weights={"a": 1, "b": 3, "unused": 5}, block_rows=2).toPandas()
    shares = found["source"].value_counts(normalize=True)
    assert abs(shares["b"] - 0.75) < 0.05
    assert (found[found["epoch"] == 0]["doc_id"] == 0).sum() == 2
    assert mixed(documents(spark, [])).count() == 0


@pytest.mark.parametrize("weights", [
    {f"src{i}": 1.0 for i in range(20)}, {"a": 0.7, "b": 0.3, "rare": 1e-5}, {str(i): (i + 1) ** 0.8 for i in range(33)},
])
def test_no_error_adds_up_over_a_long_run(weights):
    slots = 150_000
    whole = whole_weights(weights)
    rows = [r for start in range(0, slots, 50_000) for r in schedule(whole, start, start + 50_000)]
    assert all(release <= slot < deadline for _, _, release, deadline, slot in rows)
    dealt = np.array([r[0] for r in rows])
    for source, w in weights.items():
        target = np.arange(1, slots + 1) * (w / sum(weights.values()))
        assert np.abs(np.cumsum(dealt == source) - target).max() < 1 + 1e-6


def test_mixture_of_many_slots_keeps_the_target_weights(spark):
    rows = [(20 * i + k, None, None, f"src{k}") for i in range(1500) for k in range(20)]
    found = mixed(documents(spark, rows), block_rows=1).select("slot", "source").toPandas().sort_values("slot")
    assert found["slot"].tolist() == list(range(30_000))
    for k in range(20):
        assert np.abs(np.cumsum(found["source"].to_numpy() == f"src{k}") - np.arange(1, 30_001) / 20).max() < 1


def test_a_rare_source_runs_at_its_weight(spark):
    rows = [(i, None, None, "common") for i in range(100)] + [(100 + i, None, None, "rare") for i in range(2)]
    found = mixed(documents(spark, rows), weights={"common": 9999, "rare": 1}, block_rows=1).toPandas()
    assert (found["source"] == "rare").sum() == 2 and 10_000 < len(found) <= 20_000


def test_mixture_refuses_bad_weights(spark):
    with pytest.raises(ValueError):
        mixed(documents(spark, [(1, None, None, "a")]), weights={"a": 0.0})


def test_facts_of_sources_start_no_python_workers(spark):
    from tickloom.llm.mixing import _facts

    for sources in ({}, {"a": 3, "": 2**40}):
        made = _facts(spark, sources, {"n": sources, "m": {"a": 1}})
        assert {r["source"]: (r["n"], r["m"]) for r in made.collect()} == {s: (n, int(s == "a")) for s, n in sources.items()}
        # A list would be an RDD that Python has pickled.
        assert "LogicalRDD" not in made._jdf.queryExecution().logical().toString()
