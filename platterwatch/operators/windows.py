"""Tumbling event-time windows of whole days, aligned to a chosen first day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from platterwatch import schema

EPOCH = date(1970, 1, 1)


@dataclass(frozen=True)
class DayWindow:
    """Windows of ``days`` days; one of them starts on ``origin``."""

    days: int
    origin: date = schema.DATASET_START

    @property
    def offset_days(self) -> int:
        return (self.origin - EPOCH).days % self.days

    @property
    def name(self) -> str:
        return f"{self.days}d"

    def column(self, ts: str | Column) -> Column:
        """The window struct of a row. Works on batch and streaming input."""
        size = f"{self.days} days"
        return F.window(ts, size, size, f"{self.offset_days} days")

    def start_of(self, ts: Column) -> Column:
        """The start of the window of a timestamp, as plain arithmetic on whole days."""
        day = F.unix_date(F.to_date(ts))
        first = day - F.pmod(day - F.lit(self.offset_days), F.lit(self.days))
        return F.date_from_unix_date(first).cast("timestamp")

    def end_of(self, start: Column) -> Column:
        """The end of the window that begins at ``start``."""
        return F.date_add(F.to_date(start), self.days).cast("timestamp")

    def end_after(self, moment: datetime) -> datetime:
        """The end of the window that holds ``moment``."""
        day = (moment.date() - EPOCH).days
        first = day - (day - self.offset_days) % self.days
        return datetime.combine(EPOCH + timedelta(days=first + self.days), datetime.min.time())


def full_window(origin: date, days: int) -> DayWindow:
    """One window over a dataset that starts on ``origin`` and spans at most ``days`` days."""
    return DayWindow(days, origin)


def reference_windows(origin: date = schema.DATASET_START) -> list[DayWindow]:
    """The three windows of both queries."""
    return [DayWindow(days, origin) for days in schema.WINDOW_DAYS]


def tumbling(df: DataFrame, window: DayWindow, ts: str = "event_ts") -> DataFrame:
    """Add ``window_start``."""
    return df.withColumn("window_start", window.column(ts)["start"])


def in_windows(df: DataFrame, windows: list[DayWindow], ts: str = "event_ts") -> DataFrame:
    """A copy of each row per window length: ``window_days, window_start, window_end`` in place of ``ts``.

    On a stream the end of the window takes over the event-time mark of ``ts``. Grouped by it, rows of
    all lengths share one state, and each window closes when the watermark passes its own end.
    """
    found = []
    for w in windows:
        start = w.start_of(F.col(ts))
        ends = [start.alias("window_start"), w.end_of(start).alias("window_end")]
        found.append(F.struct(F.lit(w.days).alias("window_days"), *ends))
    rest = [c for c in df.columns if c != ts]
    copies = df.select(F.inline(F.array(*found)), *rest)
    end = F.col("window_end").alias("window_end", metadata=df.schema[ts].metadata)
    return copies.select("window_days", "window_start", end, *rest)


def group_by_window(
    df: DataFrame, window: DayWindow | list[DayWindow], keys: list[str], ts: str = "event_ts"
) -> tuple[GroupedData, list[Column]]:
    """Group by (window, keys); the second value holds the window columns of the grouped result.

    A stream has to group by the window struct, which carries the watermark that closes windows.
    A batch groups by the start alone: a flat timestamp hashes and shuffles cheaper than a struct.
    Several windows share one grouping, with ``window_days``; copies combine before the shuffle.
    """
    if isinstance(window, list):
        grouped = in_windows(df, window, ts).groupBy(
            "window_days", "window_start", "window_end", *keys
        )
        return grouped, [F.col("window_days"), F.col("window_start")]
    if df.isStreaming:
        grouped = df.groupBy(window.column(ts).alias("window"), *keys)
        return grouped, [F.col("window.start").alias("window_start")]
    return tumbling(df, window, ts).groupBy("window_start", *keys), [F.col("window_start")]
