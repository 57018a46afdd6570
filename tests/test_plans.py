"""Properties of the physical plans that matter at scale."""

import os
import re
from threading import Thread

import pytest
from pyspark.sql import functions as F

from platterwatch.operators.ranking import device_failures, group_totals, rank_groups, top_k
from platterwatch.operators.replay import restamp_even
from platterwatch.operators.rollup import day_stats, rollup_stats
from platterwatch.operators.stats import window_stats
from platterwatch.operators.windows import DayWindow
from platterwatch.plans.catalog import WINDOWS
from platterwatch.sources.events import read_events
from platterwatch.sources.storage import (
    release_scratch,
    scratch_scope,
    stage,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark, folder):
    return read_events(spark, folder)


def test_stats_push_the_range_and_read_three_columns(events):
    text = plan(window_stats(events, WINDOWS["3d"], lo=0, hi=20))
    assert "GreaterThanOrEqual(user_id,0)" in text and "LessThanOrEqual(user_id,20)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert text.count("Exchange") == 1
    assert "partial_count" in text


def test_flag_filter_reaches_the_scan(events):
    text = plan(device_failures(events, WINDOWS["1d"]))
    assert re.search(r"DataFilters: \[[^]]*event_type", text)


def test_ranking_limits_before_the_shuffle(events):
    text = plan(top_k(group_totals(device_failures(events, WINDOWS["full"]))))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text


def test_all_windows_share_one_scan(events):
    windows = [WINDOWS[n] for n in ("1d", "3d", "23d")]
    text = plan(rollup_stats(day_stats(events), windows))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_staged_devices_are_scanned_not_recomputed(events):
    devices = stage(device_failures(events, DayWindow(1)), "devices")
    text = plan(rank_groups(devices))
    assert "events.parquet" not in text


def test_a_large_ranked_side_is_not_broadcast(spark, events):
    devices = stage(device_failures(events, DayWindow(1)), "devices")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = rank_groups(devices)
        text = plan(df)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        rows = sorted(map(str, df.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == sorted(map(str, rank_groups(devices).collect()))


def test_restamp_numbers_rows_without_a_window_over_a_day(events):
    text = plan(restamp_even(events, order=("event_id",)))
    assert "Window" not in text.replace("window_", "")
    assert "Exchange hashpartitioning" not in text


def test_no_python_in_any_plan(events):
    from platterwatch.operators.shape import rank_lines, rank_wide, stats_lines

    devices = device_failures(events, DayWindow(1))
    ranked = rank_groups(devices)
    for df in (rank_lines(ranked, 3), rank_wide(ranked, 3), stats_lines(window_stats(events, DayWindow(1)))):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)
    assert events.filter(F.col("failure") > 0).count() > 0


def local_file(table):
    return table.inputFiles()[0].replace("file://", "")


def test_scratch_is_released(spark):
    outer = local_file(stage(spark.range(3).toDF("id"), "outer"))
    with scratch_scope(spark):
        inner = local_file(stage(spark.range(3).toDF("id"), "inner"))
        assert os.path.exists(inner)
        other = Thread(target=lambda: stage(spark.range(3).toDF("id"), "other"))
        other.start()
        other.join()
    assert os.path.exists(outer) and not os.path.exists(inner)
    release_scratch(spark)
    assert not os.path.exists(outer)
    left = {name.split("-")[0] for name in os.listdir(spark.conf.get("spark.checkpoint.dir"))}
    assert "other" in left
