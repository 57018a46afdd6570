"""Row filters that are safe on watermarked streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_watermark_filter(condition: Column, ts: str = "event_ts") -> Column:
    """A predicate that is not moved below the watermark operator.

    Spark pushes a filter below ``withWatermark`` unless it refers to the event-time column, and
    rows removed there no longer advance the watermark. One conditional expression cannot be
    split into conjuncts, so the whole predicate stays above.
    """
    return F.when(F.col(ts).isNull(), F.lit(False)).otherwise(condition)


def where(df: DataFrame, condition: Column, ts: str = "event_ts") -> DataFrame:
    """Filter before a window aggregate: pushed to the scan in batch, flush-safe in a stream."""
    if df.isStreaming:
        condition = keep_watermark_filter(condition, ts)
    return df.filter(condition)


def in_range(df: DataFrame, key: str, lo=None, hi=None, ts: str = "event_ts") -> DataFrame:
    """Keep ``lo <= key <= hi``; an end that is None is open."""
    ends = [] if lo is None else [F.col(key) >= lo]
    ends += [] if hi is None else [F.col(key) <= hi]
    for condition in ends:
        df = where(df, condition, ts)
    return df


def flagged(df: DataFrame, flag: str, ts: str = "event_ts") -> DataFrame:
    """Keep rows whose flag is positive."""
    return where(df, F.col(flag) > 0, ts)
