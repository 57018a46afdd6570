"""Replay of a dataset: even event times within a day, day files in order, the closing row."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from platterwatch import schema
from platterwatch.functions import day_of, event_time, micros_text, plus_micros
from platterwatch.sources.replay import MANIFEST, MANIFEST_SCHEMA
from platterwatch.sources.storage import data_files, numbered_folders, scratch_path, stage

LAST_DAY = "9999-12-31"  # the folder of the closing line
DAY_MICROS = 86_400_000_000
POSITION_BITS = 33  # of monotonically_increasing_id: partition above, row within it below


def restamp_even(
    df: DataFrame, ts: str = "event_ts", order: tuple[str, ...] = (), exact: bool = True
) -> DataFrame:
    """Spread the rows of each day evenly over its 24 hours, in the given order.

    Row i of n on a day gets the time ``i * day / n``, rounded down to the microsecond. Without
    ``exact`` it is i times one step that is rounded half-even, for compatibility; past about
    416,000 rows a day these steps can add up to more than a day. Rows that tie in ``order`` are
    ordered by their content, so the result does not depend on the partitioning; rows that are
    equal all over are spread by their position. Without ``order`` rows keep the order of the scan,
    which is that of the files only if each file is one split: give columns to order by.
    """
    numbered = number_in_days(df, ts, order)
    moved = plus_micros(F.col("_day"), _micros(F.col("_index"), F.col("_day_rows"), exact))
    return numbered.select(*[moved.alias(ts) if c == ts else F.col(c) for c in df.columns])


def number_in_days(df: DataFrame, ts: str = "event_ts", order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``_day``, ``_index`` (from 0, in the given order) and ``_day_rows``.

    A day is never numbered in one task. The rows are range-sorted by (day, order, position) into
    balanced partitions and staged; a row's number is its place in its partition plus the rows of
    the day in earlier partitions, of which there are at most (partitions + days).
    """
    day, position = "_day", "_position"
    tie = _content(df) if order else F.monotonically_increasing_id()
    ranged = (
        df.withColumn(day, day_of(F.col(ts)))
        .withColumns({"_tie": tie, "_at": F.monotonically_increasing_id()})
        .orderBy(day, *order, "_tie", "_at")
        .drop("_tie", "_at")
        .withColumn(position, F.monotonically_increasing_id())
    )
    staged = stage(ranged, "numbered")
    partition = F.shiftright(F.col(position), POSITION_BITS)
    pieces = staged.groupBy(day, partition.alias("_partition")).agg(
        F.count("*").alias("_n"), F.min(position).alias("_first")
    )
    earlier = Window.partitionBy(day).orderBy("_partition").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    offsets = pieces.select(
        F.col(day).alias("_piece_day"),
        "_partition",
        (before - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(day)).alias("_day_rows"),
    )
    offsets = stage(offsets, "numbered_offsets")  # staged, so Spark knows its size for the join
    joined = staged.join(
        offsets,
        F.col(day).eqNullSafe(F.col("_piece_day")) & (partition == F.col("_partition")),
    )
    index = (F.col(position) + F.col("_shift")).alias("_index")
    return joined.select(*df.columns, day, index, "_day_rows")


def _content(df: DataFrame) -> Column:
    """A hash of the row. It breaks ties the same way in every run of a task, and lets equal sort
    keys spread over several range partitions."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.xxhash64(*plain)


def _micros(index: Column, rows: Column, exact: bool) -> Column:
    """Microseconds after midnight of row ``index`` of ``rows``, in whole-number arithmetic."""
    day = F.lit(DAY_MICROS)
    if exact:
        product = index.cast("decimal(19,0)") * day.cast("decimal(11,0)")
        return F.call_function("div", product, rows.cast("decimal(19,0)"))
    rest = day % rows
    step = F.call_function("div", day, rows)
    up = (rest * 2 > rows) | ((rest * 2 == rows) & (step % 2 == 1))
    return index * (step + up.cast("long"))


def restamp_lines(
    lines: DataFrame, order: tuple[str, ...] = (), value: str = "value", exact: bool = True
) -> DataFrame:
    """``restamp_even`` on wire lines: the leading date text is replaced, the rest is kept.

    Lines without a readable date (a header, for one) are left out.
    """
    head = F.substring(F.col(value), 1, schema.DATE_LENGTH)
    rest = F.substring(F.col(value), schema.DATE_LENGTH + 1, 2**31 - 1)
    dated = lines.withColumn("_ts", event_time(head)).filter(F.col("_ts").isNotNull())
    moved = restamp_even(dated, "_ts", order, exact)
    return moved.withColumn(value, F.concat(micros_text(F.col("_ts")), rest)).drop("_ts")


def flush_line(at: datetime = schema.FLUSH_AT) -> str:
    """The closing line: a row no query keeps, dated past the end of every window."""
    fields = [""] * schema.LINE_FIELDS
    values = {
        "date": at.strftime("%Y-%m-%dT%H:%M:%S.%f"),
        "serial_number": schema.FLUSH_NAME,
        "model": schema.FLUSH_NAME,
        "failure": "0",
        "vault_id": "0",
        "s194_temperature_celsius": "0.0",
    }
    for name, position in schema.POSITIONS.items():
        fields[position] = values[name]
    return ",".join(fields)


def with_flush_row(df: DataFrame, at: datetime, ts: str = "event_ts", **values) -> DataFrame:
    """Add the closing row to a batch table; ``values`` set columns other than the event time."""
    spark = df.sparkSession
    row = spark.range(1).select(
        *[
            F.lit(at if f.name == ts else values.get(f.name)).cast(f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )
    return df.unionByName(row)


def write_replay(
    df: DataFrame,
    path: str,
    ts: str = "event_ts",
    columns: list[str] | None = None,
    text: bool = True,
    flush: str | None = None,
) -> DataFrame:
    """Add rows to a replay as one delivery: files, and a table that names them in event-time order.

    Files lie in ``event_day=`` folders. The rows are range-sorted by event time, so a large day
    is several balanced files and a small one is a single file. ``text`` writes the ``value`` column as
    lines, otherwise Parquet. ``flush`` is the closing line, a file of its own at the end. Returns the
    delivery's manifest: ``day, part, file, bytes``, which `read_replay_stream` follows. Files
    below the path that no earlier delivery names belong to this one. One writer at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    columns = columns or (["value"] if text else [c for c in df.columns if c != "event_day"])
    out = (
        df.withColumn("event_day", F.to_date(F.col(ts)))
        .withColumns({"_tie": _content(df), "_at": F.monotonically_increasing_id()})
        .orderBy("event_day", ts, "_tie", "_at")
        .select(*columns, "event_day")
    )
    writer = out.write.mode("append").partitionBy("event_day")
    (writer.text if text else writer.parquet)(path)
    if flush is not None:
        closing = f"{path}/event_day={LAST_DAY}"
        if text:
            row = spark.range(1).select(F.lit(flush).alias("value"))
            row.write.mode("append").text(closing)
        else:
            _closing_row(df.select(*columns), flush, ts).write.mode("append").parquet(closing)
    return _add_delivery(spark, path)


def _add_delivery(spark: SparkSession, path: str) -> DataFrame:
    """Name the new files of a replay in a manifest of their own."""
    done = numbered_folders(spark, f"{path}/{MANIFEST}")
    files = data_files(spark, path).where(F.col("path").contains("/event_day="))
    if done:
        named = [f"{path}/{MANIFEST}/{n:06d}" for n in done]
        known = spark.read.schema(MANIFEST_SCHEMA).parquet(*named)
        files = files.join(known.select(F.col("file").alias("path")), "path", "left_anti")
    rows = files.select(
        F.regexp_extract("path", "event_day=([^/]+)", 1).alias("day"),
        F.regexp_extract("path", r"/part-(\d+)", 1).cast("int").alias("part"),
        F.col("path").alias("file"),
        F.col("length").alias("bytes"),
    )
    target = f"{path}/{MANIFEST}/{done[-1] + 1 if done else 0:06d}"
    rows.write.parquet(target)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(target)


def _closing_row(like: DataFrame, flush: str, ts: str) -> DataFrame:
    """The closing line as one row with the columns of a table."""
    fields = flush.split(",")
    values = {name: fields[place] for name, place in schema.POSITIONS.items()}
    at = datetime.fromisoformat(values.pop("date"))
    known = {f.name: values.get(f.name) for f in like.schema.fields}
    return with_flush_row(like.limit(0), at, ts, **{k: v for k, v in known.items() if k != ts})


def send_rows(df: DataFrame, ts: str = "event_ts", value: str = "value", order: tuple[str, ...] = ()) -> DataFrame:
    """Lines with the key ``day:number:rows`` that tells their place: the row's number within its day and
    the day's number of rows. Rows are numbered by (event time, order), without a day in one task."""
    lines = df.select(ts, F.col(value).cast("string").alias("value"), *[c for c in order if c not in (ts, value)])
    numbered = number_in_days(lines, ts, (ts, *order))
    key = F.concat_ws(
        ":", F.date_format("_day", schema.DAY_PATTERN), F.format_string("%012d", "_index"), F.col("_day_rows").cast("string")
    )
    return numbered.select(F.to_date("_day").alias("day"), "_index", key.alias("key"), "value")


def in_sent_order(rows: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Received lines in the order in which they were numbered, each once: ``day, number, day_rows, value``.

    A batch, or a micro-batch in ``foreachBatch``. Sent again after a lost task, a line has the same key, so
    repeats go; a range sort restores the order. A day is complete when it has ``day_rows`` rows.
    """
    parts = F.split(F.col(key).cast("string"), ":")
    received = rows.select(
        F.to_date(parts[0]).alias("day"), parts[1].cast("long").alias("number"),
        parts[2].cast("long").alias("day_rows"), F.col(value).cast("string").alias("value"),
    )
    return received.dropDuplicates(["day", "number"]).orderBy("day", "number")


def incomplete_days(ordered: DataFrame) -> DataFrame:
    """The days of which rows have not arrived, with their number: ``day, missing``."""
    counted = ordered.groupBy("day").agg((F.max("day_rows") - F.count("*")).alias("missing"))
    return counted.where("missing > 0")


def write_replay_kafka(
    df: DataFrame,
    servers: str,
    topic: str,
    ts: str = "event_ts",
    value: str = "value",
    send: Callable[[DataFrame], None] | None = None,
    options: dict[str, str] | None = None,
    order: tuple[str, ...] = (),
) -> None:
    """Send lines to a topic, a day after the other. Needs the Kafka connector on the class path.

    The lines of a day lie in balanced ranges of event time; each is sent by one task, in order, and every
    line's key tells its number in the day, by which `in_sent_order` restores the order of what several
    tasks sent at once. The table is staged by day, so a day's job reads that day only; only the list of days
    reaches the driver. ``send`` takes the place of the Kafka writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "send")
    sent = send_rows(df, ts, value, order)
    sent.repartitionByRange("day", "_index").sortWithinPartitions("day", "_index").write.partitionBy(
        "day"
    ).parquet(path)
    staged = spark.read.schema("_index long, key string, value string, day date").parquet(path)
    days = [r["day"] for r in staged.select("day").distinct().orderBy("day").collect()]
    for day in days:
        here = F.col("day").eqNullSafe(F.lit(day)) if day is None else F.col("day") == F.lit(day)
        lines = staged.where(here).select("key", "value")
        if send:
            send(lines)
        else:
            (
                lines.write.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("topic", topic)
                .options(**(options or {}))
                .save()
            )
