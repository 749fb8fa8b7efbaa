import random
import time
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from series import START, assert_rows, bar, closes, core_by_hand, frame, random_rows
from tickloom.operators.enrich import batch_range, keep_batch, newest, newest_row
from tickloom.operators.spans import Spans
from tickloom.plans.rows import full_rows
from tickloom.schemas import BAR_COLUMNS, CORE_INDICATORS
from tickloom.sources.store import Store
from tickloom.streaming.pipeline import enrich_into


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def bars(spark, rows):
    return full_rows(frame(spark, rows))


def stored(store):
    return {(r.symbol, r.time): r for r in store.read().collect()}


def test_empty_store(store):
    assert store.read().count() == 0 and store.symbols().count() == 0


def test_upsert_replaces_by_key(spark, store):
    store.upsert(bars(spark, closes("a", [1.0, 2.0, 3.0], step=43_200)), "one")
    store.upsert(bars(spark, closes("a", [9.0], start=START + 43_200) + closes("1", [5.0])), "two")
    assert {k: r.close for k, r in stored(store).items()} == {
        ("a", START): 1.0, ("a", START + 43_200): 9.0, ("a", START + 86_400): 3.0, ("1", START): 5.0}
    assert {r.symbol: str(r.first_day) for r in store.symbols().collect()} == {"a": "2024-01-01", "1": "2024-01-01"}


def test_running_a_batch_again_changes_nothing(spark, store):
    store.upsert(bars(spark, closes("a", [1.0, 2.0])), "one")
    before = stored(store)
    store.upsert(bars(spark, closes("a", [1.0, 2.0])), "one")
    assert stored(store) == before
    # Nothing but the table itself is left behind.
    assert not list(Path(store.root).glob("work/*"))


def test_a_batch_that_died_is_written_anew(spark, store):
    """The job died with one of two days written and none listed; the next run replaces its rows."""
    rows = closes("a", [1.0, 2.0], step=86_400)
    store.upsert(bars(spark, closes("z", [7.0])), "before")
    store.upsert(bars(spark, rows[:1] + closes("b", [9.0])), "one")
    for file in Path(store.days_path).glob("batch=one/*"):
        file.unlink()
    store.upsert(bars(spark, rows + closes("b", [9.5])), "one")
    assert {k: r.close for k, r in stored(store).items()} == {
        ("a", START): 1.0, ("a", START + 86_400): 2.0, ("b", START): 9.5, ("z", START): 7.0}
    assert store.days().count() == 4


def test_a_batch_writes_its_rows_only(spark, store):
    store.upsert(bars(spark, closes("a", [float(i) for i in range(500)])), "one")
    before = {p: p.stat().st_mtime_ns for p in Path(store.bars_path).rglob("*.parquet")}
    store.upsert(bars(spark, closes("a", [9.0])), "two")
    after = {p: p.stat().st_mtime_ns for p in Path(store.bars_path).rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert store.versions().where("batch = 'two'").count() == 1
    assert stored(store)[("a", START)].close == 9.0 and store.read().count() == 500


def test_compaction_changes_nothing_but_files(spark, store):
    for number in range(4):
        store.upsert(bars(spark, closes("a", [float(number + i) for i in range(3)], step=43_200)), f"b{number}")
    before = stored(store)
    store.compact(date(2024, 1, 2))
    assert stored(store) == before and store.read().count() == 3
    parts = {(str(r.day), r.batch[:6]) for r in store.versions().select("day", "batch").collect()}
    assert parts == {("2024-01-01", "merged"), *(("2024-01-02", f"b{n}") for n in range(4))}
    store.compact(date(2024, 1, 2))
    assert stored(store) == before


def with_arrival(spark, rows, arrival):
    return frame(spark, rows).withColumn("arrival", F.lit(arrival).cast("decimal(38,0)"))


def test_an_older_message_never_wins(spark, store):
    enrich_into(store, with_arrival(spark, closes("a", [9.0]), 5), "one")
    enrich_into(store, with_arrival(spark, closes("a", [1.0, 2.0]), 2), "two")
    found = {r.time: r for r in store.read().collect()}
    assert [found[START + 60 * i].close for i in range(2)] == [9.0, 2.0]
    # Nor does it enter the indicators of other bars.
    assert found[START + 60].ma5 == 5.5
    enrich_into(store, with_arrival(spark, closes("a", [4.0]), 6), "three")
    assert stored(store)[("a", START)].close == 4.0


def test_a_late_bar_of_another_symbol_leaves_history_whole(spark, store):
    """A sparse live symbol and another symbol's late bar in one batch."""
    sparse = [bar("a", START + 10_800 * i, 100.0 + i) for i in range(260)]
    other = [bar("b", START + 3_600 * i, 50.0 + i % 7) for i in range(700)]
    late = other.pop(100)
    spans = Spans(3_600, 240, short=True)
    enrich_into(store, frame(spark, sparse[:-3] + other), "one", spans=spans)
    enrich_into(store, frame(spark, [*sparse[-3:], late]), "two", spans=spans)
    expected = core_by_hand(sparse) | core_by_hand([*other, late])
    wanted = {("a", r[2]) for r in sparse[-3:]} | {("b", late[2])}
    found = [r for r in store.read().collect() if (r.symbol, r.time) in wanted]
    assert_rows(found, {k: v for k, v in expected.items() if k in wanted}, CORE_INDICATORS)


def test_stray_dates_neither_fail_nor_slow_the_next_batch(spark, store):
    stray = [bar("a", -62_000_000_000, 1.0), bar("a", 0, 2.0)]
    rows = closes("a", [float(i) for i in range(30)])
    enrich_into(store, frame(spark, stray + rows[:29]), "one")
    begun = time.monotonic()
    enrich_into(store, frame(spark, rows[29:]), "two")
    assert time.monotonic() - begun < 30
    newest_bar = max(store.read().collect(), key=lambda r: r.time)
    assert newest_bar.ma50 == (1.0 + 2.0 + sum(range(30))) / 32


def test_a_batch_without_symbols(spark, store):
    enrich_into(store, frame(spark, [(None, *closes("a", [1.0])[0][1:])]), "one")
    assert store.read().count() == 0


def test_bars_closer_than_the_width_are_refused(spark, store):
    with pytest.raises(Exception, match="closer than the 60 seconds"):
        enrich_into(store, frame(spark, closes("a", [1.0] * 50, step=1)), "one", spans=Spans(60, 10, short=True))


def test_final_bars_can_be_told(spark, store):
    store.upsert(bars(spark, closes("a", [1.0, 2.0])), "one")
    found = {r.time: r.is_final for r in store.read_with_final(60, START + 61).collect()}
    assert found == {START: True, START + 60: False}


def test_days_are_pruned_and_columns_too(spark, store):
    store.upsert(bars(spark, closes("a", [1.0, 2.0, 3.0], step=86_400)), "one")
    plan = (
        store.read().where("day = DATE'2024-01-02' AND symbol = 'a'").select("close")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(symbol,a)" in plan
    # What is asked for, and what tells the newest version of a bar.
    assert "ReadSchema: struct<symbol:string,time:bigint,close:double,arrival:decimal(38,0),written:bigint>" in plan


def test_history_takes_the_newest_rows(spark, store):
    """250 bars on one day: the newest 200 before the batch, not the first of the day."""
    rows = closes("a", [float(i) for i in range(250)])
    store.upsert(bars(spark, rows), "one")
    batch = frame(spark, closes("a", [1.0], start=START + 60 * 250))
    found = store.history(batch_range(batch)).collect()
    assert sorted(r.close for r in found) == [float(i) for i in range(50, 250)]


def test_history_crosses_days_and_long_gaps(spark, store):
    old = closes("a", [float(i) for i in range(150)], start=START - 90 * 86_400)
    near = closes("a", [1000.0 + i for i in range(60)], start=START - 3_600)
    other = closes("b", [7.0], start=START - 60)
    store.upsert(bars(spark, old + near + other), "one")
    batch = frame(spark, closes("a", [1.0]) + closes("b", [1.0]) + closes("new", [1.0]))
    found = store.history(batch_range(batch)).collect()
    assert sorted(r.close for r in found if r.symbol == "a") == sorted(
        [1000.0 + i for i in range(60)] + [float(i) for i in range(10, 150)])
    assert [r.close for r in found if r.symbol == "b"] == [7.0]
    assert {r.symbol for r in found} == {"a", "b"}


@pytest.mark.parametrize("spans", [Spans(), Spans(60, 60, short=True)])
def test_batches_equal_one_computation(spark, store, spans):
    """Any cut of a series into batches gives what one pass over it gives."""
    series = {"a": random_rows("a", 420, 1), "b": random_rows("b", 90, 2, gaps=False)}
    for number in range(3):
        part = [r for rows in series.values() for r in rows[number * len(rows) // 3:(number + 1) * len(rows) // 3]]
        random.Random(number).shuffle(part)
        enrich_into(store, frame(spark, part), f"batch-{number}", spans=spans)
    expected = core_by_hand(series["a"]) | core_by_hand(series["b"])
    assert_rows(store.read().collect(), expected, CORE_INDICATORS)


def test_bar_in_progress_is_updated(spark, store):
    rows = random_rows("a", 40, 3, gaps=False, nulls=False)
    enrich_into(store, frame(spark, rows[:39]), "one")
    provisional = rows[39][:6] + (rows[39][6] + 5, 1.0)
    enrich_into(store, frame(spark, [provisional]), "two")
    enrich_into(store, frame(spark, rows[38:]), "three")
    assert_rows(store.read().collect(), core_by_hand(rows), CORE_INDICATORS)


@pytest.mark.parametrize("recompute", [False, True])
def test_late_bar(spark, store, recompute):
    rows = random_rows("a", 260, 5, gaps=False, nulls=False)
    late = rows.pop(30)
    enrich_into(store, frame(spark, rows), "one", spans=Spans(60, 100, short=True))
    before = stored(store)
    enrich_into(store, frame(spark, [late]), "two", recompute=recompute, spans=Spans(60, 100, short=True))
    now = core_by_hand([*rows, late])
    if recompute:
        assert_rows(store.read().collect(), now, CORE_INDICATORS)
    else:
        after = stored(store)
        key = ("a", late[2])
        assert_rows([after.pop(key)], {key: now[key]}, CORE_INDICATORS)
        assert after == before


def test_batch_over_midnight_with_late_bar(spark, store):
    rows = random_rows("a", 100, 6, gaps=False, nulls=False)
    rows = [bar("a", START + 86_400 - 3_000 + 60 * i, r[6], r[7], r[4], r[5]) for i, r in enumerate(rows)]
    enrich_into(store, frame(spark, rows[:30] + rows[31:70]), "one")
    # One late bar and the newest ones in one batch: bars between count as well.
    enrich_into(store, frame(spark, [rows[30], *rows[70:]]), "two")
    now = core_by_hand(rows)
    fresh = {("a", r[2]) for r in rows[70:]}
    found = [r for r in store.read().collect() if (r.symbol, r.time) in fresh]
    columns = [c for c in CORE_INDICATORS]
    assert_rows(found, {k: v for k, v in now.items() if k in fresh}, columns)


def test_newest_and_keep(spark):
    df = frame(spark, closes("a", [1.0, 2.0, 3.0], step=50_000) + closes("b", [4.0]))
    assert sorted(r.close for r in newest(df, 2).collect()) == [2.0, 3.0, 4.0]
    assert sorted((r.symbol, r.close) for r in newest_row(df).collect()) == [("a", 3.0), ("b", 4.0)]
    batch = df.where(F.col("close") > 2).union(df.where(F.col("close") > 2))
    assert keep_batch(df, batch).select(*BAR_COLUMNS).count() == 2
