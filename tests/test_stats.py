import math
import statistics
from datetime import datetime

from pyspark.sql import functions as F

from platterwatch.operators.rollup import day_stats, rollup_stats
from platterwatch.operators.stats import window_stats
from platterwatch.operators.windows import DayWindow, reference_windows

DAY = DayWindow(1)


def test_count_mean_deviation(telemetry):
    values = [20.5, 22.0, 27.25]
    df = telemetry([(f"2023-04-01T0{i}:00:00", 1003, 0, v, "m", "s") for i, v in enumerate(values)])
    (row,) = window_stats(df, DAY).collect()
    assert (row.vault_id, row.n_tuples) == (1003, 3)
    assert math.isclose(row["mean"], statistics.mean(values))
    assert math.isclose(row.stddev, statistics.stdev(values))
    assert row.max_ingest_ts.hour == 2


def test_single_event_has_zero_deviation(telemetry):
    (row,) = window_stats(telemetry([("2023-04-01T00:00:00", 1, 0, 5, "m", "s")]), DAY).collect()
    assert row.stddev == 0.0


def test_range_ends_are_kept(telemetry):
    df = telemetry([("2023-04-01T00:00:00", v, 0, 1, "m", "s") for v in (999, 1000, 1020, 1021)])
    kept = {r.vault_id for r in window_stats(df, DAY, lo=1000, hi=1020).collect()}
    assert kept == {1000, 1020}


def test_rows_without_a_value_are_counted_but_not_averaged(telemetry, spark):
    df = telemetry([("2023-04-01T00:00:00", 1, 0, 4, "m", "s")])
    df = df.unionByName(df.withColumn("s194_temperature_celsius", F.lit(None).cast("double")))
    (direct,) = window_stats(df, DAY).collect()
    (rolled,) = rollup_stats(day_stats(df), [DAY]).collect()
    assert (direct.n_tuples, direct["mean"]) == (rolled.n_tuples, rolled["mean"]) == (2, 4.0)


# Published (day, count, mean, deviation) of one vault for 1, 3 and 23 days.
DAYS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 15, 17, 18, 19, 20, 21, 22, 23]
DAILY = [
    (560, 18.361, 2.305), (573, 19.586, 2.221), (572, 19.818, 2.062), (553, 18.579, 2.253),
    (540, 18.380, 2.319), (554, 18.323, 2.351), (568, 18.285, 2.286), (564, 18.186, 2.290),
    (556, 18.246, 2.179), (563, 18.300, 2.229), (529, 18.229, 2.230), (561, 18.337, 2.286),
    (538, 18.342, 2.278), (535, 18.301, 2.382), (530, 18.291, 2.418), (557, 18.415, 2.409),
    (555, 18.483, 2.381), (564, 18.551, 2.367), (560, 18.414, 2.301), (555, 18.384, 2.261),
    (548, 18.569, 2.267),
]
LONGER = {
    3: [
        (1, 1705, 19.262, 2.287), (4, 1647, 18.427, 2.309), (7, 1688, 18.239, 2.252),
        (10, 1653, 18.290, 2.248), (13, 1073, 18.322, 2.330), (16, 1087, 18.354, 2.413),
        (19, 1679, 18.483, 2.349), (22, 1103, 18.476, 2.265),
    ],
    23: [(1, 11635, 18.499, 2.325)],
}


def test_published_days_merge_to_the_published_windows(spark):
    rows = [
        (datetime(2023, 4, d), 1003, n, n, mean, (n - 1) * sd * sd)
        for d, (n, mean, sd) in zip(DAYS, DAILY, strict=True)
    ]
    partials = spark.createDataFrame(
        rows, "day timestamp, vault_id int, n_tuples long, n_values long, mean double, m2 double"
    )
    out = rollup_stats(partials, [DayWindow(days) for days in LONGER]).collect()
    for days, wanted in LONGER.items():
        got = sorted(
            (r.window_start.day, r.n_tuples, r["mean"], r.stddev)
            for r in out
            if r.window_days == days
        )
        assert [g[:2] for g in got] == [w[:2] for w in wanted]
        for g, w in zip(got, wanted, strict=True):
            assert abs(g[2] - w[2]) < 0.001 and abs(g[3] - w[3]) < 0.001


def test_rollup_equals_direct(telemetry):
    rows = [
        (f"2023-04-{1 + i % 23:02d}T{i % 24:02d}:00:00", 1000 + i % 4, 0, (i * 37 % 101) / 4, "m", "s")
        for i in range(2000)
    ]
    df = telemetry(rows)
    windows = reference_windows()
    rolled = {
        (r.window_days, r.window_start, r.vault_id): r
        for r in rollup_stats(day_stats(df), windows).collect()
    }
    direct = {
        (w.days, r.window_start, r.vault_id): r for w in windows for r in window_stats(df, w).collect()
    }
    assert rolled.keys() == direct.keys()
    for key, want in direct.items():
        got = rolled[key]
        assert (got.n_tuples, got.max_ingest_ts) == (want.n_tuples, want.max_ingest_ts)
        assert math.isclose(got["mean"], want["mean"], rel_tol=1e-12)
        assert math.isclose(got.stddev, want.stddev, rel_tol=1e-9, abs_tol=1e-12)


def test_rollup_keeps_precision_far_from_zero(telemetry):
    rows = [
        (f"2023-04-{d:02d}T{h:02d}:00:00", 1, 0, 1e9 + d + h / 10, "m", "s")
        for d in (1, 2, 3)
        for h in range(4)
    ]
    (got,) = rollup_stats(day_stats(telemetry(rows)), [DayWindow(3)]).collect()
    want = statistics.stdev([r[3] - 1e9 for r in rows])
    assert math.isclose(got.stddev, want, rel_tol=1e-6)


def test_counts_are_conserved_over_windows(telemetry):
    rows = [(f"2023-04-{1 + i % 23:02d}T01:00:00", 1000 + i % 3, 0, i, "m", "s") for i in range(500)]
    df = telemetry(rows)
    totals = [
        sorted(
            (r.vault_id, r["n"])
            for r in window_stats(df, w).groupBy("vault_id").sum("n_tuples").toDF("vault_id", "n").collect()
        )
        for w in reference_windows()
    ]
    assert totals[0] == totals[1] == totals[2]
