"""Result shapes: text lines, documents and the padded wide form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterwatch import schema
from platterwatch.functions import day_text, fixed, joined, micros_text, pair_text, text_of
from platterwatch.operators.ranking import ITEMS, device_lists


def window_label(style: str = "day") -> Column:
    """``day`` gives yyyy-MM-dd, ``micros`` the full time text."""
    start = F.col("window_start")
    return micros_text(start) if style == "micros" else day_text(start)


def stats_lines(stats: DataFrame, key: str = "vault_id", label: str = "day") -> DataFrame:
    """Add ``line``: ``date,key,count,mean,stddev`` with three decimals; null fields are empty."""
    line = F.concat_ws(
        ",",
        window_label(label),
        text_of(F.col(key)),
        text_of(F.col("n_tuples")),
        fixed(F.col("mean")),
        fixed(F.col("stddev")),
    )
    return stats.withColumn("line", line)


def window_rankings(
    rows: DataFrame, parts: int, key: str = "vault_id", items: tuple[str, ...] = ITEMS
) -> DataFrame:
    """One row per (window, part) with the list ``rankings`` in rank order, from one row per device.

    A list has at most k entries per window.
    """
    lists = device_lists(rows, parts, items)
    windows = [c for c in ("window_days", "window_start") if c in lists.columns]
    entry = F.struct("rank", key, "group_failures", "hdds")
    extra = ["max_ingest_ts"] if "max_ingest_ts" in lists.columns else []
    return lists.groupBy(*windows, "part").agg(
        F.sum("n_tuples").alias("n_tuples"),
        F.sort_array(F.collect_list(entry)).alias("rankings"),
        *[F.max(name).alias(name) for name in extra],
    )


def rank_lines(
    rows: DataFrame,
    parts: int,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    label: str = "day",
) -> DataFrame:
    """``line``: the window's label, then ``,key,failures,(item,item,...)`` per ranked group.

    With more than one part, the part's number follows the label and the rank stands before each
    group, so that a line cannot be taken for a ranking of its own.
    """

    def entry_text(entry: Column) -> Column:
        return F.concat(
            F.concat(F.lit(","), entry["rank"].cast("string")) if parts > 1 else F.lit(""),
            F.lit(","),
            text_of(entry[key]),
            F.lit(","),
            text_of(entry["group_failures"]),
            F.lit(",("),
            joined(entry["hdds"], items),
            F.lit(")"),
        )

    wins = window_rankings(rows, parts, key, items)
    head = window_label(label)
    if parts > 1:
        head = F.concat(head, F.lit(","), F.col("part").cast("string"))
    body = F.array_join(F.transform(F.col("rankings"), entry_text), "")
    return wins.withColumn("line", F.concat(head, body)).drop("rankings")


def _has_rank(rank: int) -> Callable[[Column], Column]:
    return lambda entry: entry["rank"] == rank


def rank_wide(
    rows: DataFrame,
    parts: int,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    k: int = schema.TOP_K,
    label: str = "micros",
) -> DataFrame:
    """One row per (window, part): ``ts`` and k times (``key_i``, ``group_failures_i``, ``hdds_i``),
    where i is the rank.

    Ranks without devices in the row are padded with an empty text, 0 and an empty list; each
    list entry is the comma-joined text of one device.
    """
    wins = window_rankings(rows, parts, key, items)
    columns = []
    for i in range(1, k + 1):
        entry = F.get(F.filter("rankings", _has_rank(i)), F.lit(0))
        names = F.transform(entry["hdds"], lambda d: pair_text(d, items))
        columns += [
            text_of(entry[key]).alias(f"{key}_{i}"),
            F.coalesce(entry["group_failures"], F.lit(0)).alias(f"group_failures_{i}"),
            F.coalesce(names, F.array().cast("array<string>")).alias(f"hdds_{i}"),
        ]
    return wins.select(window_label(label).alias("ts"), "part", *columns)
