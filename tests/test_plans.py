"""What the physical plans must and must not hold."""

import os
import re

import pytest

from series import closes, frame, random_rows
from tickloom.operators.candles import build_candles, dedup_latest
from tickloom.operators.enrich import newest
from tickloom.operators.indicators import with_indicators
from tickloom.operators.spans import Spans
from tickloom.functions.messages import encode_messages, parse_messages
from tickloom.plans.reports import REPORTS
from tickloom.session import clear_settled, settle
from tickloom.sources.tables import read_ticks

FOLDER = "/root/testdata/sf0.001"


def plan(df, final=False):
    if final:
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        return text[:text.index("== Initial Plan ==")]
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bars(spark):
    return settle(frame(spark, random_rows("a", 600, 1) + random_rows("b", 600, 2)), "plan-bars")


def test_ticks_are_aggregated_before_the_shuffle(spark):
    text = plan(build_candles(read_ticks(spark, FOLDER), 3_600, order=("ts", "tick_id")))
    assert text.index("Exchange hashpartitioning(symbol") < text.index("partial_min_by")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double,props:string>" in text
    assert "IsNotNull(event_type)" in text


def test_copies_collapse_before_the_shuffle(bars):
    text = plan(dedup_latest(bars, order=("volume",)))
    assert text.index("Exchange hashpartitioning(symbol") < text.index("partial_max_by")


@pytest.mark.parametrize("name", ["candles_1h", "sales_candles", "dedup_latest", "newest_bar"])
def test_first_and_last_need_no_sort(spark, name):
    text = plan(REPORTS[name](spark, FOLDER))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name, days", [("latest_bars", "day"), ("day_bars", "day"), ("range_bars", "day"),
                                        ("multi_symbol", "day"), ("named_range", "day")])
def test_reads_prune_days_and_push_the_symbol(spark, name, days):
    text = plan(REPORTS[name](spark, FOLDER))
    assert re.search(rf"PartitionFilters: \[[^\]]*isnotnull\({days}#", text)
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo\(symbol|In\(symbol)", text)


def test_long_series_are_shuffled_once_and_by_span(spark, bars):
    text = plan(with_indicators(bars, spans=Spans(60, 150, short=True)), final=True)
    assert "ReusedExchange" in text and "ShuffledHashJoin" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    lines = text.splitlines()
    # The bars are read in full once, for a shuffle that both parts use.
    assert sum("FileScan" in line and "high#" in line for line in lines) == 1
    # The only shuffle by symbol alone is that of the filtered edges.
    alone = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", line)]
    assert len(alone) == 1
    assert any("Filter" in line and "_tail_from" in line for line in lines[alone[0]:alone[0] + 4])


def test_columns_that_are_not_asked_for_are_not_read(bars):
    text = plan(with_indicators(bars, reset="day").select("symbol", "time", "ma5"))
    assert "ReadSchema: struct<symbol:string,day:date,time:bigint,close:double>" in text


def test_newest_ranks_before_the_shuffle(bars):
    assert "WindowGroupLimit" in plan(newest(bars, 5))


def test_messages_are_parsed_once(spark):
    sent = settle(encode_messages(frame(spark, closes("a", [1.0]))), "plan-messages")
    assert plan(parse_messages(sent)).count("from_json") == 1


def test_settled_tables_can_be_deleted(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    clear_settled()
    before = set(os.listdir(folder))
    REPORTS["all_indicators"](spark, FOLDER).count()
    assert set(os.listdir(folder)) > before
    clear_settled()
    assert set(os.listdir(folder)) == before
