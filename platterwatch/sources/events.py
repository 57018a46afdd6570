"""Other tables seen as telemetry, for the registered queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_ORIGIN = date(2024, 1, 1)
LINEITEM_ORIGIN = date(1992, 1, 1)

# Given, so that no footer is read before a query is planned.
EVENTS_SCHEMA = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)


def events_as_telemetry(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Activity events: users are the groups, errors the failures. Batch or stream."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("user_id").alias("vault_id"),
        F.col("value").alias("s194_temperature_celsius"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("failure"),
        F.concat(F.lit("M"), (F.col("user_id") % 5).cast("string")).alias("model"),
        F.get_json_object("props", "$.k").alias("serial_number"),
        *keep,
    )


def read_events(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    table = spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")
    return events_as_telemetry(table, keep)


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of its files."""
    # As a pattern the path may be a single file or a folder of files.
    pattern = f"{folder}/event[s].parquet"
    return events_as_telemetry(spark.readStream.schema(EVENTS_SCHEMA).parquet(pattern))


def read_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Line items: suppliers are the groups, returned parts the failures."""
    return spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
        F.col("l_suppkey").alias("vault_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("failure"),
        F.col("l_partkey").cast("string").alias("serial_number"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("model"),
    )
