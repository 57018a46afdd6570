from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from platterwatch.operators.windows import (
    DayWindow,
    full_window,
    reference_windows,
    tumbling,
)


def starts(spark, window, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select(F.col("t").cast("timestamp").alias("event_ts"))
    out = tumbling(df, window).withColumn("again", window.start_of(F.col("event_ts")))
    rows = out.orderBy("event_ts").collect()
    assert all(r.window_start == r.again for r in rows)
    return [r.window_start.date().isoformat() for r in rows]


def test_reference_offsets():
    assert [(w.days, w.offset_days) for w in reference_windows()] == [(1, 0), (3, 2), (23, 13)]


def test_alignment(spark):
    days = ["2023-04-01", "2023-04-03", "2023-04-04", "2023-04-23"]
    one, three, all_days = reference_windows()
    assert starts(spark, one, days) == days
    assert starts(spark, three, days) == ["2023-04-01", "2023-04-01", "2023-04-04", "2023-04-22"]
    assert starts(spark, all_days, days) == ["2023-04-01"] * 4


def test_before_1970(spark):
    _, three, long = reference_windows()
    assert starts(spark, three, ["1969-12-30"]) == ["1969-12-28"]
    assert starts(spark, long, ["1969-12-30"]) == ["1969-12-22"]


def test_midnight_belongs_to_the_new_day(spark):
    texts = ["2023-04-01 23:59:59.999999", "2023-04-02 00:00:00"]
    assert starts(spark, DayWindow(1), texts) == ["2023-04-01", "2023-04-02"]


@pytest.mark.parametrize("days", [1, 3, 7, 23])
def test_end_after(days):
    window = DayWindow(days)
    end = window.end_after(datetime(2023, 4, 1, 12))
    assert end == datetime(2023, 4, 1 + days)


def test_full_window_is_one_window(spark):
    window = full_window(date(2024, 1, 1), 30)
    assert starts(spark, window, ["2024-01-01", "2024-01-30 23:59:59"]) == ["2024-01-01"] * 2


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    days=st.integers(1, 400),
    origin=st.dates(date(1960, 1, 1), date(2060, 1, 1)),
    times=st.lists(
        st.datetimes(datetime(1950, 1, 1), datetime(2070, 1, 1)), min_size=1, max_size=40
    ),
)
def test_starts_are_whole_windows_from_the_origin(spark, days, origin, times):
    window = DayWindow(days, origin)
    df = spark.createDataFrame([(t,) for t in times], "event_ts timestamp")
    out = tumbling(df, window).withColumn("again", window.start_of(F.col("event_ts")))
    for r in out.collect():
        assert r.window_start == r.again
        assert (r.window_start.date() - origin).days % days == 0
        assert r.window_start <= r.event_ts < r.window_start + timedelta(days=days)
        assert window.end_after(r.event_ts) == r.window_start + timedelta(days=days)
