"""Query 2: the groups with most failures, on several windows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from platterwatch import schema
from platterwatch.operators.ranking import ITEMS, device_failures, rank_groups, window_top_k
from platterwatch.operators.rollup import DAY, rollup_failures
from platterwatch.operators.windows import DayWindow, reference_windows
from platterwatch.sources.storage import stage


def query2(
    df: DataFrame,
    windows: list[DayWindow] | None = None,
    k: int = schema.TOP_K,
    **columns,
) -> dict[str, DataFrame]:
    """One ranking per window, by window name, each from its own scan. Batch."""
    windows = windows or reference_windows()
    return {w.name: window_top_k(df, w, k=k, **columns) for w in windows}


def query2_rollup(
    df: DataFrame,
    windows: list[DayWindow] | None = None,
    k: int = schema.TOP_K,
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
) -> DataFrame:
    """All windows in one table with ``window_days``, from one scan.

    The failing devices of each day are staged; every window is a roll-up of that table.
    """
    windows = windows or reference_windows()
    days = stage(device_failures(df, DAY, key, flag, items, ts), "day_devices")
    devices = stage(rollup_failures(days, windows, key, list(items)), "window_devices")
    return rank_groups(devices, key, items, k)
