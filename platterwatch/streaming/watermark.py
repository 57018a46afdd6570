"""Event time on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterwatch import schema


def with_event_time(
    df: DataFrame, ts: str = "event_ts", delay: str = schema.WATERMARK_DELAY
) -> DataFrame:
    """Declare the watermark. Rows older than the latest seen time minus ``delay`` are late.

    Place it before any filter that could drop the closing row, and use the filters of
    ``platterwatch.operators.filters`` after it. Zone-less timestamps are taken as session time.
    """
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)
