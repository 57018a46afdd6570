"""Query 1: statistics of a value per group in a range, on several windows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from platterwatch import schema
from platterwatch.operators.rollup import day_stats, rollup_stats
from platterwatch.operators.stats import window_stats
from platterwatch.operators.windows import DayWindow, reference_windows


def query1(
    df: DataFrame,
    windows: list[DayWindow] | None = None,
    lo: int | None = schema.VAULT_RANGE[0],
    hi: int | None = schema.VAULT_RANGE[1],
    **columns,
) -> dict[str, DataFrame]:
    """One result per window, by window name. Batch or stream."""
    windows = windows or reference_windows()
    return {w.name: window_stats(df, w, lo=lo, hi=hi, **columns) for w in windows}


def query1_rollup(
    df: DataFrame,
    windows: list[DayWindow] | None = None,
    lo: int | None = schema.VAULT_RANGE[0],
    hi: int | None = schema.VAULT_RANGE[1],
    key: str = "vault_id",
    **columns,
) -> DataFrame:
    """All windows in one table with ``window_days``: one scan, one shuffle of day partials.

    Batch only.
    """
    windows = windows or reference_windows()
    return rollup_stats(day_stats(df, key=key, lo=lo, hi=hi, **columns), windows, key)
