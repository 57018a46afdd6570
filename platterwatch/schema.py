"""The telemetry record: field positions, types and the fixed values of the two queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import types as T

# The wire format. A line is comma separated, has no header and 39 fields.
LINE_FIELDS = 39
POSITIONS = {
    "date": 0,
    "serial_number": 1,
    "model": 2,
    "failure": 3,
    "vault_id": 4,
    "s194_temperature_celsius": 25,
}
DATE_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATE_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$"
DATE_LENGTH = 26
DAY_PATTERN = "yyyy-MM-dd"
HEADER_MARK = "date"

# The two queries.
DATASET_START = date(2023, 4, 1)
WINDOW_DAYS = (1, 3, 23)
VAULT_RANGE = (1000, 1020)
TOP_K = 10
FLUSH_AT = datetime(2023, 4, 26)
FLUSH_NAME = "UNKNOWN"
WATERMARK_DELAY = "0 seconds"
TRIGGER = "3 minutes"

TELEMETRY = T.StructType(
    [
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("serial_number", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("failure", T.IntegerType()),
        T.StructField("vault_id", T.IntegerType()),
        T.StructField("s194_temperature_celsius", T.DoubleType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)
