"""Telemetry lines to typed rows, with the rejected lines kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterwatch import schema
from platterwatch.functions import day_of, event_time, line_field, micros_text, try_int, try_real

# Fields after the last one needed are not split off.
SPLIT_LIMIT = max(schema.POSITIONS.values()) + 2

REQUIRED = ("event_ts", "failure", "vault_id", "s194_temperature_celsius")


def not_header(value: str = "value") -> Column:
    return ~F.col(value).startswith(schema.HEADER_MARK + ",")


def parse_telemetry(
    lines: DataFrame, value: str = "value", ingest: Column | None = None, day_precision: bool = False
) -> DataFrame:
    """Lines to the telemetry columns plus the raw ``value``. Nothing raises: what cannot be read
    is null.

    The ingest time is the source's ``timestamp`` column where there is one, else the time of the
    micro-batch. ``day_precision`` cuts the event time to its day.
    """
    if ingest is None:
        ingest = F.col("timestamp") if "timestamp" in lines.columns else F.current_timestamp()
    at = {name: line_field(F.col("fields"), i) for name, i in schema.POSITIONS.items()}
    event_ts = event_time(at["date"])
    if day_precision:
        event_ts = day_of(event_ts)
    row = F.struct(
        event_ts.alias("event_ts"),
        at["serial_number"].alias("serial_number"),
        at["model"].alias("model"),
        try_int(at["failure"]).alias("failure"),
        try_int(at["vault_id"]).alias("vault_id"),
        try_real(at["s194_temperature_celsius"]).alias("s194_temperature_celsius"),
    )
    # A one-row generator: filters on its output are not pushed below it, where Spark would
    # repeat the split and the conversions for each column that they name.
    split = lines.select(
        F.col(value).alias("value"),
        ingest.alias("ingest_ts"),
        F.split(F.col(value), ",", SPLIT_LIMIT).alias("fields"),
    )
    parsed = split.select(F.inline(F.array(row)), "ingest_ts", "value")
    return parsed.select(*schema.TELEMETRY.fieldNames(), "value")


def is_valid() -> Column:
    """Both queries need a readable date, failure flag, vault and temperature."""
    valid = F.lit(True)
    for name in REQUIRED:
        valid = valid & F.col(name).isNotNull()
    return valid


def valid_rows(parsed: DataFrame) -> DataFrame:
    """The rows both queries can use, typed columns only."""
    return parsed.filter(is_valid()).select(*schema.TELEMETRY.fieldNames())


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """The other lines, with the names of the fields that could not be read.

    Together with ``valid_rows`` this is every line once. Each of the two reads the source; stage
    ``parsed`` to keep both from one pass, or on a stream use `platterwatch.streaming.routing`.
    """
    reasons = [F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED]
    return parsed.filter(~is_valid()).select("value", F.concat_ws(",", *reasons).alias("unreadable"))


def line_of(rows: DataFrame, ts: str = "event_ts") -> Column:
    """The wire line of a typed row; fields that neither query reads stay empty."""
    at = {
        i: F.col(name).cast("string")
        for name, i in schema.POSITIONS.items()
        if name in rows.columns
    }
    at[schema.POSITIONS["date"]] = micros_text(F.col(ts))
    fields = [F.coalesce(at.get(i, F.lit("")), F.lit("")) for i in range(schema.LINE_FIELDS)]
    return F.concat_ws(",", *fields)


def to_lines(rows: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Typed rows to wire lines, in ``value``."""
    return rows.select(line_of(rows, ts).alias("value"))
