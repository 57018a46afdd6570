"""Dataset replay: a CSV dataset becomes day files of evenly spread lines, ready to be streamed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterwatch import schema
from platterwatch.functions import event_time
from platterwatch.operators.replay import (
    flush_line,
    restamp_lines,
    write_replay,
    write_replay_kafka,
)
from platterwatch.sources.lines import FILE_ORDER, read_dataset_lines


def replay_dataset(
    spark: SparkSession,
    dataset: str,
    path: str | None = None,
    servers: str | None = None,
    topic: str = "original",
    flush_at: datetime = schema.FLUSH_AT,
    exact: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame | None:
    """Restamp a dataset, in the order of its files' lines, and add it to the replay below ``path`` as one
    delivery, whose manifest is returned, or send it to a Kafka topic with the given connector options.

    The closing line dated ``flush_at`` comes last; it has to lie past the end of every window.
    """
    lines = read_dataset_lines(spark, dataset)
    moved = restamp_lines(lines, order=FILE_ORDER, exact=exact)
    date = F.substring("value", 1, schema.DATE_LENGTH)
    timed = moved.withColumn("event_ts", event_time(date))
    if servers is None:
        return write_replay(timed, path, flush=flush_line(flush_at))
    write_replay_kafka(timed, servers, topic, options=options)
    closing = spark.range(1).select(
        F.lit(flush_line(flush_at)).alias("value"), F.lit(flush_at).alias("event_ts")
    )
    write_replay_kafka(closing, servers, topic, options=options)
    return None
