"""Count, mean and sample deviation per group and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterwatch.operators.filters import in_range
from platterwatch.operators.windows import DayWindow, group_by_window


def sample_deviation(value: str | Column) -> Column:
    """Sample standard deviation, 0.0 for a single value."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def latest_ingest(df: DataFrame, ingest: str | None) -> list[Column]:
    if ingest and ingest in df.columns:
        return [F.max(ingest).alias("max_ingest_ts")]
    return []


def window_stats(
    df: DataFrame,
    window: DayWindow | list[DayWindow],
    key: str = "vault_id",
    value: str = "s194_temperature_celsius",
    ts: str = "event_ts",
    lo=None,
    hi=None,
    ingest: str | None = "ingest_ts",
) -> DataFrame:
    """``window_start, key, n_tuples, mean, stddev`` and, where known, ``max_ingest_ts``.

    All aggregates combine on the map side, so one hot key sends one row per task. A list of windows
    gives the results of all, with ``window_days``: the form for streams, which then read their source
    once. In a batch ``rollup_stats`` does the same from day partials.
    """
    df = in_range(df, key, lo, hi, ts)
    extra = latest_ingest(df, ingest)
    df = df.select(key, value, ts, *([ingest] if extra else []))
    grouped, starts = group_by_window(df, window, [key], ts)
    out = grouped.agg(
        F.count("*").alias("n_tuples"),
        F.avg(value).alias("mean"),
        sample_deviation(value).alias("stddev"),
        *extra,
    )
    return out.select(
        *starts, key, "n_tuples", "mean", "stddev", *(["max_ingest_ts"] if extra else [])
    )
