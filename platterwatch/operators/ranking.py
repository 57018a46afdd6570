"""Groups ranked by failures per window, with the devices that failed.

A ranking is one row per device of a ranked group, whatever its size. Counting, removing duplicates
and ranking work on keys that include the device, so a group that holds a large part of all failures is
spread over many tasks. Lists are a form of the result, in a number of parts that the caller names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterwatch import schema
from platterwatch.operators.filters import flagged
from platterwatch.operators.stats import latest_ingest
from platterwatch.operators.windows import DayWindow, group_by_window
from platterwatch.sources.storage import stage

ITEMS = ("model", "serial_number")


def device_failures(
    df: DataFrame,
    window: DayWindow | list[DayWindow],
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
    ingest: str | None = "ingest_ts",
) -> DataFrame:
    """One row per (window, group, device): ``failures, n_tuples`` and, where known,
    ``max_ingest_ts``. Works on batch and streaming input, and on several windows at once, which
    ``window_days`` then tells apart."""
    df = flagged(df, flag, ts)
    extra = latest_ingest(df, ingest)
    df = df.select(key, flag, *items, ts, *([ingest] if extra else []))
    grouped, starts = group_by_window(df, window, [key, *items], ts)
    out = grouped.agg(
        F.sum(flag).alias("failures"),
        F.count("*").alias("n_tuples"),
        *extra,
    )
    return out.select(
        *starts, key, *items, "failures", "n_tuples", *(["max_ingest_ts"] if extra else [])
    )


def _window_columns(df: DataFrame) -> list[str]:
    return [c for c in ("window_days", "window_start") if c in df.columns]


def group_totals(devices: DataFrame, key: str = "vault_id") -> DataFrame:
    """One row per (window, group): ``failures, n_devices``."""
    return devices.groupBy(*_window_columns(devices), key).agg(
        F.sum("failures").alias("failures"),
        F.count("*").alias("n_devices"),
    )


def top_k(totals: DataFrame, k: int = schema.TOP_K, key: str = "vault_id") -> DataFrame:
    """The k groups with most failures of each window; ties go to the lower key.

    The rank limit is applied before the shuffle too, so each task sends at most k rows per window.
    """
    order = Window.partitionBy(*_window_columns(totals)).orderBy(F.desc("failures"), F.asc(key))
    return totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def global_top_k(totals: DataFrame, k: int = schema.TOP_K, key: str = "vault_id") -> DataFrame:
    """The k (window, group) pairs with most failures over all windows, with their ``rank``.

    The limit keeps k rows per task; only the k that are left are numbered in one task.
    """
    order = [F.desc("failures"), *_window_columns(totals), key]
    best = totals.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def ranked_devices(
    devices: DataFrame, ranked: DataFrame, key: str = "vault_id", items: tuple[str, ...] = ITEMS
) -> DataFrame:
    """One row per device of the ranked groups: ``rank``, key, ``group_failures``,
    ``group_devices``, then the device with its own ``failures, n_tuples``.

    No broadcast is forced: Spark picks the join by the measured size of the ranked side, and
    splits skewed partitions when it has to sort and merge. The key may be null.
    """
    windows = _window_columns(ranked)
    own = [c for c in ("failures", "n_tuples", "max_ingest_ts", "batch") if c in devices.columns]
    left, right = devices.alias("d"), ranked.alias("r")
    same = F.col(f"d.{key}").eqNullSafe(F.col(f"r.{key}"))
    for name in windows:
        same = same & (F.col(f"d.{name}") == F.col(f"r.{name}"))
    return left.join(right, same).select(
        *[f"r.{c}" for c in [*windows, "rank", key]],
        F.col("r.failures").alias("group_failures"),
        F.col("r.n_devices").alias("group_devices"),
        *[f"d.{c}" for c in [*items, *own]],
    )


def ranked_groups(rows: DataFrame, key: str = "vault_id") -> DataFrame:
    """One row per ranked group, with the tuples behind it, from one row per device."""
    group = [*_window_columns(rows), "rank", key, "group_failures", "group_devices"]
    return rows.groupBy(*group).agg(
        F.sum("n_tuples").alias("n_tuples"), *latest_ingest(rows, "max_ingest_ts")
    )


def part_of(items: tuple[str, ...], parts: int) -> Column:
    """The part of a device: the first six hexadecimal digits of its md5, modulo the parts."""
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in items])
    return (F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % parts).cast("int")


def device_lists(rows: DataFrame, parts: int, items: tuple[str, ...] = ITEMS) -> DataFrame:
    """Pack the devices of each ranked group into sorted lists ``hdds``, one for each ``part``.

    The number of parts is the same for every group and window and is never taken from the data;
    choose it so that a part of the largest group fits into a cell. A part without devices has no
    row. ``n_tuples`` and ``max_ingest_ts`` are those of the row's devices; ``group_failures`` and
    ``group_devices`` repeat.
    """
    own = (*items, "failures", "n_tuples", "max_ingest_ts")
    return (
        rows.withColumn("part", part_of(items, parts))
        .groupBy(*[c for c in rows.columns if c not in own], "part")
        .agg(
            F.sum("n_tuples").alias("n_tuples"),
            *latest_ingest(rows, "max_ingest_ts"),
            F.sort_array(F.collect_list(F.struct(*items))).alias("hdds"),
        )
    )


def rank_groups(
    devices: DataFrame,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    k: int = schema.TOP_K,
) -> DataFrame:
    """The ranking of each window, one row per device, from device rows (a batch or one closed
    micro-batch).

    ``devices`` is read twice, once for the totals and once for the devices; give a staged table
    when it is costly to make.
    """
    return ranked_devices(devices, top_k(group_totals(devices, key), k, key), key, items)


def rank_globally(
    devices: DataFrame,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    k: int = schema.TOP_K,
) -> DataFrame:
    """The top k over all windows together, one row per device. Reads ``devices`` twice."""
    return ranked_devices(devices, global_top_k(group_totals(devices, key), k, key), key, items)


def window_top_k(
    df: DataFrame,
    window: DayWindow,
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
    k: int = schema.TOP_K,
    ingest: str | None = "ingest_ts",
    staged: bool = True,
) -> DataFrame:
    """``window_start, rank, key, group_failures, group_devices``, the device, ``failures,
    n_tuples`` for a batch input, one row per device.

    The device rows are staged, so the input is scanned once; ``staged=False`` keeps the whole
    plan lazy and scans it twice. For a stream aggregate with ``device_failures`` and rank each
    closed micro-batch with ``rank_groups``; see ``platterwatch.streaming``.
    """
    devices = device_failures(df, window, key, flag, items, ts, ingest)
    if staged:
        devices = stage(devices, "device_failures")
    return rank_groups(devices, key, items, k)
