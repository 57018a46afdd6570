"""Mergeable day partials and their roll-up to longer windows.

The input is read and shuffled once, at day grain. Every longer window is then made from
(days x keys) rows, whatever the size of the input. On a stream the two steps are two aggregations, one after
the other: a day's partials leave the first when the day closes and are all that the second keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterwatch.operators.filters import flagged, in_range
from platterwatch.operators.stats import latest_ingest
from platterwatch.operators.windows import DayWindow, group_by_window, in_windows, tumbling

DAY = DayWindow(1)


def day_stats(
    df: DataFrame,
    key: str = "vault_id",
    value: str = "s194_temperature_celsius",
    ts: str = "event_ts",
    lo=None,
    hi=None,
    ingest: str | None = "ingest_ts",
) -> DataFrame:
    """Partials per (day, key): row count, value count, mean and squared deviations."""
    df = in_range(df, key, lo, hi, ts)
    return (
        tumbling(df, DAY, ts)
        .groupBy("window_start", key)
        .agg(*_partials(value), *latest_ingest(df, ingest))
        .withColumnRenamed("window_start", "day")
    )


def _partials(value: str) -> list[Column]:
    return [
        F.count("*").alias("n_tuples"),
        F.count(value).alias("n_values"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
    ]


def _in_windows(partials: DataFrame, windows: list[DayWindow]) -> DataFrame:
    """One copy of each day partial per window length, with that window's start."""
    starts = [
        F.struct(F.lit(w.days).alias("window_days"), w.start_of(F.col("day")).alias("window_start"))
        for w in windows
    ]
    return partials.select(F.inline(F.array(*starts)), "*").drop("day")


def _latest(df: DataFrame) -> list[Column]:
    return [F.max("max_ingest_ts").alias("max_ingest_ts")] if "max_ingest_ts" in df.columns else []


def rollup_stats(partials: DataFrame, windows: list[DayWindow], key: str = "vault_id") -> DataFrame:
    """Statistics of the given windows from day partials: ``window_days`` plus the stats columns.

    The grand mean comes first, then the squared deviations around it; no difference of large
    sums is taken. A (window, key) group holds one partial per day.
    """
    group = ["window_days", "window_start", key]
    over = Window.partitionBy(*group)
    total = F.sum("n_values").over(over)
    grand = F.sum(F.col("n_values") * F.col("mean")).over(over) / F.nullif(total, F.lit(0))
    shifted = _in_windows(partials, windows).withColumn("grand_mean", grand)
    apart = F.col("mean") - F.col("grand_mean")
    merged = shifted.groupBy(*group).agg(
        F.sum("n_tuples").alias("n_tuples"),
        F.sum("n_values").alias("n_values"),
        F.first("grand_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n_values") * apart * apart).alias("m2"),
        *_latest(partials),
    )
    variance = F.when(F.col("n_values") > 1, F.col("m2") / (F.col("n_values") - 1))
    return merged.select(
        *group,
        "n_tuples",
        "mean",
        F.coalesce(F.sqrt(variance), F.lit(0.0)).alias("stddev"),
        *[c for c in ("max_ingest_ts",) if c in merged.columns],
    )


def rollup_failures(
    day_devices: DataFrame, windows: list[DayWindow], key: str, items: list[str]
) -> DataFrame:
    """Failures per device and window from failures per device and day.

    Devices stay rows, so the union of the daily device sets is a plain group-by that spreads a
    hot group over all tasks.
    """
    partials = day_devices.withColumnRenamed("window_start", "day")
    return (
        _in_windows(partials, windows)
        .groupBy("window_days", "window_start", key, *items)
        .agg(
            F.sum("failures").alias("failures"),
            F.sum("n_tuples").alias("n_tuples"),
            *_latest(partials),
        )
    )


def chained_stats(
    df: DataFrame,
    windows: list[DayWindow],
    key: str = "vault_id",
    value: str = "s194_temperature_celsius",
    ts: str = "event_ts",
    lo=None,
    hi=None,
    ingest: str | None = "ingest_ts",
) -> DataFrame:
    """Statistics of several windows on a stream, in append mode: ``window_days`` plus the stats columns.

    The first aggregation holds open days only. The second holds, per open window and key, one entry for
    each of its closed days, and merges them when the window closes, in the order of the days.
    """
    df = in_range(df, key, lo, hi, ts)
    grouped, _ = group_by_window(df.select(key, value, ts, *_given(df, ingest)), DAY, [key], ts)
    days = grouped.agg(*_partials(value), *latest_ingest(df, ingest))
    entry = F.struct(F.col("window.start").alias("day"), "n_values", "mean", "m2").alias("entry")
    marked = days.select(F.window_time("window").alias("day"), key, "n_tuples", entry, *_own_latest(days))
    merged = (
        in_windows(marked, windows, "day")
        .groupBy("window_days", "window_start", "window_end", key)
        .agg(F.sum("n_tuples").alias("n_tuples"), F.collect_list("entry").alias("days"), *_latest(marked))
    )
    total = F.aggregate(F.array_sort("days"), _nothing(), _merge).alias("total")
    named = merged.select("window_days", "window_start", key, "n_tuples", total, *_own_latest(merged))
    n, m2 = F.col("total.n_values"), F.col("total.m2")
    return named.select(
        "window_days", "window_start", key, "n_tuples",
        F.when(n > 0, F.col("total.mean")).alias("mean"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).otherwise(0.0).alias("stddev"),
        *_own_latest(named),
    )


def _nothing() -> Column:
    zero = F.lit(0.0)
    return F.struct(F.lit(0).cast("long").alias("n_values"), zero.alias("mean"), zero.alias("m2"))


def _merge(a: Column, b: Column) -> Column:
    """Two partials as one, without a difference of large sums. Days without values change nothing."""
    n, apart = a.n_values + b.n_values, b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n_values"),
        (a["mean"] + apart * b.n_values / n).alias("mean"),
        (a.m2 + b.m2 + apart * apart * a.n_values * b.n_values / n).alias("m2"),
    )
    return F.when(b.n_values == 0, a).otherwise(both)


def _given(df: DataFrame, *names: str | None) -> list[str]:
    return [c for c in names if c and c in df.columns]


def _own_latest(df: DataFrame) -> list[str]:
    return _given(df, "max_ingest_ts")


def chained_failures(
    df: DataFrame,
    windows: list[DayWindow],
    key: str,
    flag: str,
    items: tuple[str, ...],
    ts: str = "event_ts",
    ingest: str | None = "ingest_ts",
) -> DataFrame:
    """Failures per device on several windows of a stream, in append mode. Rows combine per day and device first;
    the devices of closed days, not the rows, are copied to each window length."""
    df = flagged(df, flag, ts)
    kept = df.select(key, flag, *items, ts, *_given(df, ingest))
    grouped, _ = group_by_window(kept, DAY, [key, *items], ts)
    sums = [F.sum(flag).alias("failures"), F.count("*").alias("n_tuples")]
    days = grouped.agg(*sums, *latest_ingest(df, ingest))
    marked = days.select(
        F.window_time("window").alias("day"), key, *items, "failures", "n_tuples", *_own_latest(days)
    )
    out = (
        in_windows(marked, windows, "day")
        .groupBy("window_days", "window_start", "window_end", key, *items)
        .agg(
            F.sum("failures").alias("failures"), F.sum("n_tuples").alias("n_tuples"), *_latest(marked)
        )
    )
    return out.drop("window_end")
