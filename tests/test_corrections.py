"""Batches into a store: late bars, corrections, states that go on, and how little is written and run for them."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from series import START, bar, closes, frame, random_rows
from tickloom.functions.messages import encode_messages
from tickloom.operators.indicators import with_indicators
from tickloom.operators.segments import plan_segments, touched_days
from tickloom.operators.spans import Spans
from tickloom.plans.rows import full_rows
from tickloom.schemas import BAR_COLUMNS, CORE_INDICATORS, EXTENDED_INDICATORS
from tickloom.session import settle
from tickloom.sources.store import Store
from tickloom.streaming.pipeline import batch_writer, enrich_into

HOURLY = Spans(3_600, 8_760)
VALUES = [*CORE_INDICATORS, *EXTENDED_INDICATORS]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def whole(spark, rows, spans=HOURLY):
    """One computation over all bars."""
    found = with_indicators(settle(frame(spark, rows), "whole"), spans=spans, extended=True)
    return {(r["symbol"], r["time"]): r for r in full_rows(found).collect()}


def compare(store, expected, columns=VALUES):
    found = store.read().collect()
    assert len(found) == len(expected)
    for r in found:
        want = expected[(r["symbol"], r["time"])]
        for c in columns:
            assert (r[c] is None) == (want[c] is None), (r["symbol"], r["time"], c, r[c], want[c])
            assert r[c] is None or abs(r[c] - want[c]) < 1e-7, (r["symbol"], r["time"], c, r[c], want[c])


def hourly(symbol, n, seed, gaps=False):
    """With ``gaps``, five days are missing after every hundred bars."""
    rows = random_rows(symbol, n, seed, step=3_600, gaps=False, nulls=False)
    return [bar(r[0], START + 3_600 * (i + (i // 100 * 120 if gaps else 0)), r[6], r[7], r[4], r[5]) for i, r in enumerate(rows)]


def test_a_late_bar_writes_its_neighbours_and_offsets(spark, store):
    rows = {s: hourly(s, 720, k) for k, s in enumerate(("a", "b"))}
    late = [r.pop(4 * 24 + 12) for r in rows.values()]
    enrich_into(store, frame(spark, [r for each in rows.values() for r in each]), "one", spans=HOURLY)
    enrich_into(store, frame(spark, late), "late", recompute=True, spans=HOURLY)
    written = {r["symbol"]: r["count"] for r in store.versions().where("batch = 'late'").groupBy("symbol").count().collect()}
    assert set(written) == {"a", "b"} and max(written.values()) <= 200
    offsets = spark.read.parquet(store.offsets_path)
    assert 0 < offsets.count() <= 2 * 30
    compare(store, whole(spark, [*late, *[r for each in rows.values() for r in each]]))


def test_segments_longer_than_a_span(spark, store):
    spans = Spans(3_600, 100, short=True)
    rows = hourly("a", 330, 15) + hourly("b", 60, 16)
    late = [rows.pop(40), rows.pop(45)]
    enrich_into(store, frame(spark, rows), "one", recompute=True, spans=spans)
    enrich_into(store, frame(spark, late), "late", recompute=True, spans=spans)
    compare(store, whole(spark, [*late, *rows]))


def test_scattered_late_bars_with_live_ones(spark, store):
    """Changes near and far from each other in one batch, and a second such batch on top."""
    spans = HOURLY
    rows = hourly("a", 700, 3) + hourly("b", 250, 4, gaps=True) + hourly("c", 40, 5)
    rng = random.Random(1)
    batches = [[], [], []]
    for r in rows:
        at = (r[2] - START) // 3_600
        first = 2 if r[0] == "a" and at >= 690 else 0
        if rng.random() < 0.006 or (r[0] == "a" and at in (100, 101, 290, 310, 600)):
            first = rng.choice([1, 2])
        batches[first].append(r)
    assert len(batches[1]) > 3
    for number, part in enumerate(batches):
        enrich_into(store, frame(spark, part), f"b{number}", recompute=True, spans=spans)
    expected = whole(spark, rows)
    compare(store, expected)
    # A batch that runs again changes nothing, nor does merging.
    enrich_into(store, frame(spark, batches[2]), "b2", recompute=True, spans=spans)
    compare(store, expected)
    store.compact(date(2024, 1, 20))
    compare(store, expected)
    assert spark.read.parquet(store.offsets_path).where("day < DATE'2024-01-20'").count() == 0
    store.compact_small(2)
    compare(store, expected)
    late = bar("a", START + 1_800, 55.0)
    enrich_into(store, frame(spark, [late]), "after", recompute=True, spans=spans)
    compare(store, whole(spark, [late, *rows]))


def test_without_recompute_later_rows_stay(spark, store):
    rows = hourly("a", 300, 6)
    late = rows.pop(40)
    enrich_into(store, frame(spark, rows), "one", spans=HOURLY)
    before = {r["time"]: r for r in store.read().collect()}
    enrich_into(store, frame(spark, [late]), "late", spans=HOURLY)
    after = {r["time"]: r for r in store.read().collect()}
    now = whole(spark, [late, *rows])[("a", late[2])]
    own = after.pop(late[2])
    assert all(own[c] == now[c] or abs(own[c] - now[c]) < 1e-8 for c in VALUES)
    assert after == before


def test_batches_in_order_equal_one_computation(spark, store):
    rows = sorted(hourly("a", 400, 7) + hourly("b", 250, 8, gaps=True), key=lambda r: r[2])
    at, number = 0, 0
    while at < len(rows):
        size = [300, 1, 150, 5][number % 4]
        enrich_into(store, frame(spark, rows[at:at + size]), f"b{number}", spans=HOURLY)
        at, number = at + size, number + 1
    compare(store, whole(spark, rows))


def test_a_trend_that_no_flip_ends(spark, store):
    """A late extreme at the start of a long rise changes the SAR far beyond the look-back."""
    rows = closes("a", [100.0 + i for i in range(700)], step=3_600)
    late = bar("a", START + 1_800, 100.5, high=900.0, low=90.0)
    enrich_into(store, frame(spark, rows), "one", spans=HOURLY)
    enrich_into(store, frame(spark, [late]), "late", recompute=True, spans=HOURLY)
    expected = whole(spark, [late, *rows])
    plain = whole(spark, rows)
    assert sum(plain[k]["parabolic_sar"] != expected[k]["parabolic_sar"] for k in plain) > 300
    compare(store, expected)


def test_a_changed_day_changes_the_next_days_levels(spark, store):
    rows = closes("a", [100.0 + i % 5 for i in range(400)])
    rows = [bar("a", START + 86_400 * (i // 100) + 60 * (i % 100), r[6]) for i, r in enumerate(rows)]
    late = bar("a", START + 50_000, 500.0)
    enrich_into(store, frame(spark, rows), "one")
    enrich_into(store, frame(spark, [late]), "late", recompute=True)
    compare(store, whole(spark, [late, *rows], Spans()))


def test_rows_that_were_put_in_without_indicators(spark, store):
    rows = hourly("a", 260, 9)
    store.upsert(full_rows(frame(spark, rows[:250])), "raw")
    enrich_into(store, frame(spark, rows[250:]), "more", spans=HOURLY)
    expected = whole(spark, rows)
    found = {r["time"]: r for r in store.read().collect()}
    for r in rows[250:]:
        assert all(abs(found[r[2]][c] - expected[("a", r[2])][c]) < 1e-8 for c in VALUES)


def arrived(spark, rows, arrival):
    return frame(spark, rows).withColumn("arrival", F.lit(arrival).cast("decimal(38,0)"))


def test_corrections_win_until_a_later_message(spark, store):
    rows = hourly("a", 60, 10)
    enrich_into(store, arrived(spark, rows, 5), "stream", spans=HOURLY)
    fixed = [bar(r[0], r[2], 1.0, r[7]) for r in rows]
    enrich_into(store, frame(spark, fixed), "backfill", spans=HOURLY)
    assert {r["close"] for r in store.read().collect()} == {1.0}
    # An older message still loses, a later one wins.
    enrich_into(store, arrived(spark, rows[:5], 4), "old", spans=HOURLY)
    assert {r["close"] for r in store.read().collect()} == {1.0}
    enrich_into(store, arrived(spark, rows[:5], 6), "new", spans=HOURLY)
    assert sum(r["close"] == 1.0 for r in store.read().collect()) == 55
    store.upsert(full_rows(frame(spark, rows).withColumn("volume", F.lit(777.0))), "volumes")
    assert {r["volume"] for r in store.read().collect()} == {777.0}
    store.upsert(full_rows(arrived(spark, rows, 4), carry=("arrival",)), "stale")
    assert {r["volume"] for r in store.read().collect()} == {777.0}


def test_a_one_bar_batch_takes_ten_jobs_at_most(spark, store):
    rows = hourly("a", 500, 11) + hourly("b", 500, 12)
    enrich_into(store, frame(spark, rows), "one", spans=HOURLY)
    write = batch_writer(store, ("seq",), lambda batch: "jobs", spans=HOURLY)
    message = settle(encode_messages(frame(spark, [bar("a", START + 3_600 * 500, 7.0)])).withColumn("seq", F.lit(1)), "message")
    spark.sparkContext.setJobGroup("one-bar", "a batch of one bar")
    try:
        write(message, 0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one-bar")
    assert 0 < len(jobs) <= 10
    assert store.read().where("symbol = 'a'").count() == 501


def test_small_batches_are_merged(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = closes("a", [50.0 + i % 9 for i in range(14)])
    write = batch_writer(store, ("seq",), lambda batch: "s", merge_from=4)
    for number in range(7):
        part = frame(spark, rows[2 * number:2 * number + 2])
        write(encode_messages(part).withColumn("seq", F.lit(number)), number)
    assert len({r["batch"] for r in store.versions().select("batch").collect()}) <= 4
    assert len({r["batch"] for r in spark.read.parquet(store.days_path).select("batch").collect()}) <= 4
    compare(store, whole(spark, rows, Spans()))


def test_a_batch_needs_few_days(spark, store):
    rows = hourly("a", 900, 13)
    enrich_into(store, frame(spark, rows), "one", spans=HOURLY)

    def needed(time, recompute):
        plan = plan_segments(store.records(), touched_days(frame(spark, [bar("a", time, 1.0)])), recompute)
        return sorted((r["day"] - date(2024, 1, 1)).days for r in plan.collect())

    # 200 bars are on nine days before the one of the batch.
    assert needed(START + 20 * 86_400 + 60, False) == list(range(11, 21))
    assert needed(START + 20 * 86_400 + 60, True) == list(range(11, 30))
    assert needed(START + 1_000 * 86_400, True) == [*range(29, 38), 1_000]
    assert needed(START - 50 * 86_400, False) == [-50]


def test_plans_read_the_needed_days_and_symbols_only(spark, store):
    enrich_into(store, frame(spark, hourly("a", 900, 14)), "one", spans=HOURLY)
    found = store.with_offsets(store.versions([date(2024, 1, 5), date(1999, 1, 1)], without="x").where(F.col("symbol").isin(["a"])))
    assert len(found.inputFiles()) == 1 and found.count() == 24
    assert "EqualTo(symbol,a)" in found._jdf.queryExecution().executedPlan().toString().replace("In(symbol, [a])", "EqualTo(symbol,a)")
    assert found.select(*BAR_COLUMNS).count() == 24
