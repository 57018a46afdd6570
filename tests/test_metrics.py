import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from platterwatch.operators.metrics import (
    counter_rates,
    coverage_metrics,
    progress_rates,
    with_latency,
)
from platterwatch.operators.ranking import ranked_groups, window_top_k
from platterwatch.operators.stats import window_stats
from platterwatch.operators.windows import DayWindow
from platterwatch.streaming.progress import PROGRESS

DAY = DayWindow(1)


def test_latency_is_measured_from_the_latest_ingest(telemetry):
    df = telemetry([("2023-04-01T10:00:00", 1, 0, 20, "m", "s"), ("2023-04-01T11:00:00", 1, 0, 20, "m", "s")])
    emitted = F.lit("2023-04-01 11:00:01.500").cast("timestamp")
    (row,) = with_latency(window_stats(df, DAY), emitted).collect()
    assert row.latency_ms == 1500
    assert with_latency(window_stats(df, DAY)).first().latency_ms > 0


def test_coverage_counts_tuples_behind_results(telemetry):
    rows = [("2023-04-01T10:00:00", v, 1, 20, "m", f"s{i}") for v in range(12) for i in range(v + 1)]
    df = telemetry(rows)
    all_groups = coverage_metrics(window_stats(df, DAY)).first()
    assert (all_groups.n_results, all_groups.n_tuples) == (12, sum(range(1, 13)))
    top = coverage_metrics(with_latency(ranked_groups(window_top_k(df, DAY))), ["window_start"]).first()
    assert (top.n_results, top.n_tuples) == (10, sum(range(3, 13)))
    assert top.max_latency_ms > 0


def plain_rates(samples, seconds=60):
    best = {}
    for name, at, value in samples:
        best[name, at] = max(value, best.get((name, at), value))
    out = []
    for (name, at), value in best.items():
        seen = sorted((t, v) for (n, t), v in best.items() if n == name and 0 <= (at - t).total_seconds() <= seconds)
        grown = sum(b - a if b >= a else b for (_, a), (_, b) in zip(seen[:-1], seen[1:]))
        span = (at - seen[0][0]).total_seconds()
        out.append((name, at, value, grown / span if span else None))
    return out


@pytest.mark.parametrize("chunk", [60, 90, 3600])
def test_rates_of_a_counter_that_begins_again(spark, chunk):
    """Irregular samples, repeated times, gaps, resets, times before 1970; chunks do not show."""
    rng, samples = random.Random(chunk), []
    for name in ("a", "b", None):
        at, value = datetime(1969, 12, 31, 23, 50), 0
        for _ in range(200):
            at += timedelta(seconds=rng.choice([0, 1, 5, 17, 59, 60, 61, 300]), microseconds=rng.randrange(3))
            value = value + rng.randrange(9) if rng.random() > 0.1 else rng.randrange(3)
            samples.append((name, at, value))
    table = spark.createDataFrame(samples, "name string, ts timestamp, counter long").repartition(5)
    got = counter_rates(table, ("name",), chunk_seconds=chunk).collect()
    key = lambda r: (str(r[0]), r[1])
    want = sorted(plain_rates(samples), key=key)
    got = sorted(map(tuple, got), key=key)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(g[3] == pytest.approx(w[3]) for g, w in zip(got, want))


def test_rates_of_a_stream(spark):
    rows = [("q", k, f"2024-01-01T00:00:{10 * k:02d}.000Z", 100 * k, 1.0, 1.0, 500, None, 0, 0) for k in range(6)]
    got = progress_rates(spark.createDataFrame(rows, PROGRESS)).orderBy("ts").collect()
    assert [r.rate for r in got] == [None, 10.0, 15.0, 20.0, 25.0, 30.0]
    assert {r.latency for r in got} == {0.5}
