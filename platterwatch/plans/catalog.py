"""The registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from platterwatch.functions import joined
from platterwatch.operators import metrics, parse, ranking, replay, rollup, shape, stats
from platterwatch.operators.ranking import ITEMS
from platterwatch.operators.windows import DayWindow, full_window
from platterwatch.plans.query1 import query1, query1_rollup
from platterwatch.plans.query2 import query2, query2_rollup
from platterwatch.sources import lines as line_sources
from platterwatch.sources.events import (
    EVENTS_ORIGIN,
    LINEITEM_ORIGIN,
    read_events,
    read_returns,
    stream_events,
)
from platterwatch.sources.replay import read_replay_stream
from platterwatch.sources.storage import scratch_path, stage
from platterwatch.streaming import routing, single_file, sinks
from platterwatch.streaming.progress import ProgressLog
from platterwatch.streaming.ranking import (
    append_global_top_k,
    append_top_k,
    latest_rankings,
    live_top_k,
)
from platterwatch.streaming.run import run_streams
from platterwatch.streaming.watermark import with_event_time

Query = Callable[[SparkSession, str], DataFrame]

KEY, VALUE = "vault_id", "s194_temperature_celsius"
FULL_DAYS = 30
WINDOWS = {
    "1d": DayWindow(1, EVENTS_ORIGIN),
    "3d": DayWindow(3, EVENTS_ORIGIN),
    "23d": DayWindow(23, EVENTS_ORIGIN),
    "full": full_window(EVENTS_ORIGIN, FULL_DAYS),
}
# The range of query 1 on these tables, where user ids take the place of vault ids.
LO, HI = 0, 20
PARTS = 3
DELIVERIES = 7
DIGITS = 6


def _utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_events(_utc(spark), folder)


def _rounded(df: DataFrame) -> DataFrame:
    """Statistics to six decimals. The noise of the summation order goes first, so that exact ties
    round the same way however the rows were partitioned."""
    return df.withColumns({c: F.round(F.round(c, DIGITS + 3), DIGITS) for c in ("mean", "stddev")})


def _stats(name: str) -> Query:
    return lambda spark, folder: _rounded(stats.window_stats(_events(spark, folder), WINDOWS[name]))


def _query1(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(query1(_events(spark, folder), [WINDOWS[name]], LO, HI)[name])

    return run


def _rank(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        window = WINDOWS[name]
        return query2(_events(spark, folder), [window])[window.name]

    return run


def _three() -> list[DayWindow]:
    return [WINDOWS[name] for name in ("1d", "3d", "23d")]


def global_top10(spark: SparkSession, folder: str) -> DataFrame:
    devices = ranking.device_failures(_events(spark, folder), WINDOWS["1d"])
    return ranking.rank_globally(stage(devices, "device_failures"))


def rollup_stats_3d(spark: SparkSession, folder: str) -> DataFrame:
    partials = rollup.day_stats(_events(spark, folder))
    return _rounded(rollup.rollup_stats(partials, [WINDOWS["3d"]]).drop("window_days"))


def rollup_rank_3d(spark: SparkSession, folder: str) -> DataFrame:
    ranked = query2_rollup(_events(spark, folder), [WINDOWS["3d"]])
    return ranked.drop("window_days")


def stats_all_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(query1_rollup(_events(spark, folder), _three(), lo=None, hi=None))


def rank_all_windows(spark: SparkSession, folder: str) -> DataFrame:
    return query2_rollup(_events(spark, folder), _three())


def stats_lines_1d(spark: SparkSession, folder: str) -> DataFrame:
    result = stats.window_stats(_events(spark, folder), WINDOWS["1d"])
    return shape.stats_lines(result).select("line")


def rank_lines_1d(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranking.window_top_k(_events(spark, folder), WINDOWS["1d"])
    return shape.rank_lines(ranked, parts=1).select("line", "n_tuples")


def rank_lines_parts_1d(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranking.window_top_k(_events(spark, folder), WINDOWS["1d"])
    return shape.rank_lines(ranked, parts=PARTS).select("part", "line", "n_tuples")


def rank_lists_parts_1d(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranking.window_top_k(_events(spark, folder), WINDOWS["1d"])
    lists = ranking.device_lists(ranked, PARTS)
    return lists.withColumn("hdds", joined(F.col("hdds"), ITEMS))


def rank_lines_null_key(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks count as failures, too, and have neither group nor model."""
    events = read_events(_utc(spark), folder, keep=("event_type",))
    click = F.col("event_type") == "click"
    nulled = events.withColumns({
        KEY: F.when(~click, F.col(KEY)), "model": F.when(~click, F.col("model")),
        "failure": F.when(click, 1).otherwise(F.col("failure")),
    })
    ranked = ranking.window_top_k(nulled, WINDOWS["1d"])
    return shape.rank_lines(ranked, parts=1).select("line", "n_tuples")


def _wide_text(ranked: DataFrame, parts: int) -> DataFrame:
    wide = shape.rank_wide(ranked, parts)
    texts = {c: F.array_join(c, ";") for c in wide.columns if c.startswith("hdds_")}
    return wide.withColumns(texts)


def rank_wide_1d(spark: SparkSession, folder: str) -> DataFrame:
    return _wide_text(ranking.window_top_k(_events(spark, folder), WINDOWS["1d"]), parts=1)


def rank_wide_parts_1d(spark: SparkSession, folder: str) -> DataFrame:
    return _wide_text(ranking.window_top_k(_events(spark, folder), WINDOWS["1d"]), PARTS)


def global_wide_3d(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best (window, group) pairs of all windows, one wide row per window among them."""
    devices = ranking.device_failures(_events(spark, folder), WINDOWS["3d"])
    return _wide_text(ranking.rank_globally(stage(devices, "device_failures")), parts=1)


def parse_lines(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse.parse_telemetry(parse.to_lines(_events(spark, folder)))
    return parse.valid_rows(parsed).drop("ingest_ts")


def _damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the whole table, damaged in a way that depends on the event type."""
    events = read_events(spark, folder, keep=("event_type",))
    line, kind = parse.line_of(events), F.col("event_type")
    damaged = (
        F.when(kind == "signup", F.substring_index(line, ",", 10))
        .when(kind == "click", F.concat(F.lit("x"), line))
        .when(kind == "view", F.regexp_replace(line, r"^((?:[^,]*,){4})[^,]*", "$1vault"))
        .when(kind == "purchase", F.regexp_replace(line, r"^((?:[^,]*,){3})[^,]*", "$1"))
        .otherwise(line)
    )
    return events.select(damaged.alias("value"))


def parse_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the whole table that cannot be used, by reason."""
    parsed = parse.parse_telemetry(_damaged_lines(spark, folder))
    return parse.rejected_rows(parsed).groupBy("unreadable").agg(F.count("*").alias("n_lines"))


def dataset_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write the events as a CSV dataset with a header, scan it, and parse its lines."""
    rows = parse.to_lines(_events(spark, folder))
    fields = F.split("value", ",")
    names = line_sources.dataset_schema().fieldNames()
    path = scratch_path(spark, "dataset")
    rows.select(*[fields[i].alias(n) for i, n in enumerate(names)]).write.option(
        "header", True
    ).csv(path)
    lines = line_sources.dataset_lines(line_sources.read_dataset(spark, path))
    return parse.valid_rows(parse.parse_telemetry(lines)).drop("ingest_ts")


def _written_lines(spark: SparkSession, folder: str, value) -> DataFrame:
    """The events as lines of a CSV dataset that is written and read back."""
    events = _events(spark, folder)
    path = scratch_path(spark, "dataset")
    events.select(value(events).alias("value")).write.text(path)
    return line_sources.read_dataset_lines(spark, path)


def dataset_wide_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of 45 fields keep all of them."""
    wide = lambda events: F.concat(parse.line_of(events), F.lit(",a,,c,d,,f"))
    return _written_lines(spark, folder, wide).select("value")


def dataset_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Models in CSV quotes, with a quote inside."""

    def quoted(events: DataFrame):
        return F.regexp_replace(parse.line_of(events), r"^([^,]*,[^,]*,)(M)([^,]*)", '$1"$2""$3"')

    lines = _written_lines(spark, folder, quoted)
    return parse.valid_rows(parse.parse_telemetry(lines)).drop("ingest_ts")


def replay_multi_file(spark: SparkSession, folder: str) -> DataFrame:
    """Three files of unequal length keep their order and that of their lines."""
    events = _events(spark, folder)
    path = scratch_path(spark, "files")
    last = events.agg(F.max("event_id")).first()[0]
    edges = [-1, last // 50, last // 3, last]
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        rows = events.where((F.col("event_id") > low) & (F.col("event_id") <= high))
        lines = rows.coalesce(1).sortWithinPartitions("event_id")
        lines.select(parse.line_of(events).alias("value")).write.text(f"{path}/{k}")
    lines = line_sources.read_dataset_lines(spark, path)
    return replay.restamp_lines(lines, order=line_sources.FILE_ORDER).select("value")


def restamp_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that are equal all over: days and groups, many times each."""
    rows = _events(spark, folder).select(F.date_trunc("day", "event_ts").alias("event_ts"), "failure")
    return replay.restamp_even(rows, order=("failure",))


def restamp_even(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("event_id", "event_ts")
    return replay.restamp_even(rows, order=("event_id",))


def restamp_exact(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("event_id", "event_ts")
    return replay.restamp_even(rows, order=("event_id",), exact=True)


def restamp_rounded(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("event_id", "event_ts")
    return replay.restamp_even(rows, order=("event_id",), exact=False)


def restamp_lines(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    lines = events.select("event_id", parse.line_of(events).alias("value"))
    moved = replay.restamp_lines(lines, order=("event_id",))
    return moved.select("event_id", "value")


def coverage_1d(spark: SparkSession, folder: str) -> DataFrame:
    result = stats.window_stats(_events(spark, folder), WINDOWS["1d"])
    return metrics.coverage_metrics(result, ["window_start"])


def coverage_rank_1d(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranking.window_top_k(_events(spark, folder), WINDOWS["1d"])
    return metrics.coverage_metrics(ranking.ranked_groups(ranked), ["window_start"])


def latency_1d(spark: SparkSession, folder: str) -> DataFrame:
    """Latency of day results that are sent out at the end of the day."""
    events = _events(spark, folder).withColumn("ingest_ts", F.col("event_ts"))
    result = stats.window_stats(events, WINDOWS["1d"])
    end = F.col("window_start") + F.expr("INTERVAL 1 DAY")
    timed = metrics.with_latency(result, end)
    return timed.select("window_start", KEY, "n_tuples", "latency_ms")


def lineitem_returns_rank(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    window = DayWindow(23, LINEITEM_ORIGIN)
    return ranking.window_top_k(read_returns(spark, folder), window)


# Streams: the whole table goes through a stream and a closing row shuts the last window.


def closing_row(spark: SparkSession, folder: str) -> DataFrame:
    """A row past the last window of any length, in the columns of the events."""
    events = _events(spark, folder)
    last = events.agg(F.max("event_ts")).first()[0]
    at = max(window.end_after(last) for window in WINDOWS.values()) + timedelta(days=1)
    nothing = spark.createDataFrame([], events.schema)
    return replay.with_flush_row(nothing, at, vault_id=-1, failure=0)


def _watched(stream: DataFrame) -> DataFrame:
    return with_event_time(stream).withColumn("ingest_ts", F.current_timestamp())


def _flushed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream, together with the closing row."""
    path = scratch_path(spark, "closing")
    closing = closing_row(spark, folder)
    closing.write.parquet(path)
    closing_stream = spark.readStream.schema(closing.schema).parquet(path)
    return _watched(stream_events(spark, folder).unionByName(closing_stream))


def _run(spark: SparkSession, name: str, writer, checkpoint: str | None = None) -> None:
    """Run to the end of what is there, with one state partition per core."""
    checkpoint = checkpoint or scratch_path(spark, "checkpoint")
    cores = spark.sparkContext.defaultParallelism
    run_streams({name: writer}, checkpoint, every=None, state_partitions=cores)


def stream_stats_1d(spark: SparkSession, folder: str) -> DataFrame:
    result = query1(_flushed_stream(spark, folder), [WINDOWS["1d"]], LO, HI)["1d"]
    path = scratch_path(spark, "results")
    _run(spark, "stats_1d", sinks.sink_documents(result, path, "parquet"))
    out = sinks.read_documents(spark, path, result.schema, "parquet")
    return _rounded(out.drop("max_ingest_ts"))


def _ranked_rows(spark: SparkSession, folder: str, path: str, form: str) -> DataFrame:
    like = ranking.window_top_k(_events(spark, folder), WINDOWS["1d"], staged=False)
    schema = StructType([*like.schema.fields, StructField("batch_id", IntegerType())])
    return sinks.read_documents(spark, path, schema, form)


def _closed_ranks(spark: SparkSession, folder: str, form: str) -> DataFrame:
    path = scratch_path(spark, "results")
    writer = sinks.document_writer(path, form=form)
    stream = _flushed_stream(spark, folder)
    _run(spark, f"rank_1d_{form}", append_top_k(stream, WINDOWS["1d"], writer))
    return _ranked_rows(spark, folder, path, form).drop("batch_id")


def stream_rank_1d(spark: SparkSession, folder: str) -> DataFrame:
    return _closed_ranks(spark, folder, "parquet")


def stream_rank_documents_1d(spark: SparkSession, folder: str) -> DataFrame:
    return _closed_ranks(spark, folder, "json")


def stream_global_top10(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking over all windows after the last one has closed; windows close in two steps."""
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "results")
    best, checkpoint = scratch_path(spark, "best"), scratch_path(spark, "checkpoint")
    events = _events(spark, folder)
    middle = F.lit(WINDOWS["1d"].origin + timedelta(days=FULL_DAYS // 2))
    early = F.col("event_ts") < middle
    closing = closing_row(spark, folder)
    for delivery in (events.filter(early), events.filter(~early), closing):
        delivery.write.mode("append").parquet(source)
        stream = _watched(spark.readStream.schema(events.schema).parquet(source))
        writer = sinks.document_writer(path, form="parquet")
        ranked = append_global_top_k(stream, WINDOWS["1d"], writer, best)
        _run(spark, "global_top10", ranked, checkpoint)
    results = _ranked_rows(spark, folder, path, "parquet")
    last = results.agg(F.max("batch_id").alias("batch_id"))
    return results.join(last, "batch_id").drop("batch_id")


def stream_stats_all_windows(spark: SparkSession, folder: str) -> DataFrame:
    """One stream for the windows of all lengths, the longer ones from closed days."""
    result = rollup.chained_stats(_flushed_stream(spark, folder), _three())
    path = scratch_path(spark, "results")
    _run(spark, "stats_all", sinks.sink_documents(result, path, "parquet"))
    out = sinks.read_documents(spark, path, result.schema, "parquet")
    return _rounded(out.drop("max_ingest_ts"))


def stream_rank_all_windows(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "results")
    writer = sinks.document_writer(path, form="parquet")
    stream = _flushed_stream(spark, folder)
    _run(spark, "rank_all", append_top_k(stream, _three(), writer))
    return spark.read.parquet(path).drop("batch_id", "max_ingest_ts")


def progress_1d(spark: SparkSession, folder: str) -> DataFrame:
    """Input rows of a stream of all windows, from its progress table: the events and the closing row."""
    log = ProgressLog(spark, scratch_path(spark, "progress"))
    spark.streams.addListener(log)
    try:
        result = stats.window_stats(_flushed_stream(spark, folder), _three())
        sink = sinks.sink_documents(result, scratch_path(spark, "results"), "parquet")
        _run(spark, "progress_1d", sink)
        log.wait()
    finally:
        spark.streams.removeListener(log)
    return log.table().groupBy("query").agg(F.sum("input_rows").alias("input_rows"))


def stream_delay_3min(spark: SparkSession, folder: str) -> DataFrame:
    """Event times are cut to the day. Half of the last day but one arrives after the last day has begun,
    and the delay of three minutes keeps it."""
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "results")
    checkpoint = scratch_path(spark, "checkpoint")
    events = _events(spark, folder)
    last = events.agg(F.max("event_ts")).first()[0]
    day_before = F.to_date("event_ts") == F.lit(last.date() - timedelta(days=1))
    late = day_before & (F.col("event_id") % 2 == 0)
    closing = replay.flush_line(WINDOWS["1d"].end_after(last) + timedelta(days=1))
    for delivery in (
        events.filter(~late).select(parse.line_of(events).alias("value")),
        events.filter(late).select(parse.line_of(events).alias("value")),
        spark.range(1).select(F.lit(closing).alias("value")),
    ):
        delivery.write.mode("append").text(source)
        lines = line_sources.read_lines_stream(spark, path=source)
        rows = parse.valid_rows(parse.parse_telemetry(lines, day_precision=True))
        result = stats.window_stats(with_event_time(rows, delay="3 minutes"), WINDOWS["1d"])
        _run(spark, "delay_3min", sinks.sink_documents(result, path, "parquet"), checkpoint)
    out = sinks.read_documents(spark, path, result.schema, "parquet")
    return _rounded(out.drop("max_ingest_ts"))


def parse_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a time of arrival keep it; the latest of each group and day."""
    events = _events(spark, folder)
    arrived = F.col("event_ts") + F.expr("INTERVAL 5 MINUTES")
    lines = events.select(parse.line_of(events).alias("value"), arrived.alias("timestamp"))
    rows = parse.valid_rows(parse.parse_telemetry(lines))
    return stats.window_stats(rows, WINDOWS["1d"]).select(
        "window_start", KEY, "n_tuples", F.col("max_ingest_ts").alias("last_arrival")
    )


def stream_live_rank_1d(spark: SparkSession, folder: str) -> DataFrame:
    """The table arrives in deliveries by event id, each a micro-batch; the stream stops and goes on once. The
    live ranking after all, with a snapshot of the changes after every third micro-batch."""
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "results")
    changes, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    events = _events(spark, folder)
    half = DELIVERIES // 2
    for numbers in (range(half), range(half, DELIVERIES)):
        for number in numbers:
            delivery = events.filter(F.col("event_id") % DELIVERIES == number)
            delivery.coalesce(1).write.mode("append").parquet(source)
        reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        stream = with_event_time(reader.parquet(source), delay=f"{FULL_DAYS} days")
        stream = stream.withColumn("ingest_ts", F.current_timestamp())
        writer = sinks.document_writer(path, form="parquet")
        live = live_top_k(
            stream, WINDOWS["1d"], writer, changes, delay=f"{FULL_DAYS} days", every=3
        )
        _run(spark, "live_rank_1d", live, checkpoint)
    return latest_rankings(_ranked_rows(spark, folder, path, "parquet"))


def stream_late_drop(spark: SparkSession, folder: str) -> DataFrame:
    """The whole table is delivered a second time after its last window has closed.

    The stream stops in between and recovers from its checkpoint; the second delivery is late
    and changes nothing.
    """
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "results")
    checkpoint = scratch_path(spark, "checkpoint")
    events = _events(spark, folder)
    for delivery in (events.unionByName(closing_row(spark, folder)), events):
        delivery.write.mode("append").parquet(source)
        stream = _watched(spark.readStream.schema(events.schema).parquet(source))
        result = stats.window_stats(stream, WINDOWS["1d"])
        writer = sinks.sink_documents(result, path, "parquet")
        _run(spark, "late_drop", writer, checkpoint)
    out = sinks.read_documents(spark, path, result.schema, "parquet")
    return _rounded(out.drop("max_ingest_ts"))


def _drain(spark: SparkSession, name: str, writer, checkpoint: str) -> None:
    cores = spark.sparkContext.defaultParallelism
    run_streams({name: writer}, checkpoint, state_partitions=cores, drain=True)


def stream_replay_lines_3d(spark: SparkSession, folder: str) -> DataFrame:
    """Restamp, write day files, stream them back in order, eight at a time, parse, and write lines."""
    window = WINDOWS["3d"]
    moved = replay.restamp_even(_events(spark, folder), order=("event_id",))
    lines = moved.select("event_ts", parse.line_of(moved).alias("value"))
    path, out = scratch_path(spark, "replay"), scratch_path(spark, "results")
    checkpoint = scratch_path(spark, "checkpoint")
    last = window.end_after(moved.agg(F.max("event_ts")).first()[0])
    flush = replay.flush_line(last + timedelta(days=1))
    replay.write_replay(lines, path, flush=flush)
    source = read_replay_stream(spark, path, files=8, offered=f"{checkpoint}/replay_3d/offered")
    rows = with_event_time(parse.valid_rows(parse.parse_telemetry(source)))
    result = shape.stats_lines(stats.window_stats(rows, window, lo=LO, hi=HI))
    _drain(spark, "replay_3d", sinks.sink_text(result, out), checkpoint)
    return sinks.read_lines_written(spark, out)


def stream_replay_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The table is replayed in three deliveries. After each the stream takes what is new, six files at a time
    and in order, and stops; the next start goes on from its offset. No row comes late."""
    events = _events(spark, folder)
    path, out = scratch_path(spark, "replay"), scratch_path(spark, "results")
    checkpoint = scratch_path(spark, "checkpoint")
    last = events.agg(F.max("event_ts")).first()[0]
    flush = replay.flush_line(WINDOWS["1d"].end_after(last) + timedelta(days=1))
    first = WINDOWS["1d"].origin
    edges = [first, first + timedelta(days=9), first + timedelta(days=20), last.date() + timedelta(days=1)]
    for number in range(3):
        low, high = (F.lit(x).cast("timestamp") for x in edges[number : number + 2])
        part = events.filter((F.col("event_ts") >= low) & (F.col("event_ts") < high))
        lines = part.select("event_ts", parse.line_of(part).alias("value"))
        replay.write_replay(lines, path, flush=flush if number == 2 else None)
        source = read_replay_stream(spark, path, files=6, offered=f"{checkpoint}/deliveries/offered")
        rows = with_event_time(parse.valid_rows(parse.parse_telemetry(source)))
        result = stats.window_stats(rows, WINDOWS["1d"])
        _drain(spark, "deliveries", sinks.sink_documents(result, out, "parquet"), checkpoint)
    return _rounded(sinks.read_documents(spark, out, result.schema, "parquet").drop("max_ingest_ts"))


def replay_sent_order(spark: SparkSession, folder: str) -> DataFrame:
    """The table sent day by day and received in another order, some of it twice; the keys restore it."""
    events = _events(spark, folder)
    lines = events.select("event_id", "event_ts", parse.line_of(events).alias("value"))
    path = scratch_path(spark, "topic")

    def send(records: DataFrame) -> None:
        shuffled = records.repartition(3, F.xxhash64("key"))
        shuffled.write.mode("append").parquet(path)
        shuffled.where(F.xxhash64("key") % 5 == 0).write.mode("append").parquet(path)

    replay.write_replay_kafka(lines, "", "", send=send, order=("event_id",))
    received = replay.in_sent_order(spark.read.parquet(path))
    return received.select(F.col("day").cast("string").alias("day"), "number", "day_rows", "value")


def stream_stats_file_1d(spark: SparkSession, folder: str) -> DataFrame:
    """Day results as lines of one growing file. Half of the days arrive after the stream has been stopped."""
    source, path = scratch_path(spark, "arrivals"), f"{scratch_path(spark, 'file')}/query_1_1.csv"
    checkpoint = scratch_path(spark, "checkpoint")
    events = _events(spark, folder)
    early = F.col("event_ts") < F.lit(WINDOWS["1d"].origin + timedelta(days=FULL_DAYS // 2))
    for delivery in (events.filter(early), events.filter(~early).unionByName(closing_row(spark, folder))):
        delivery.write.mode("append").parquet(source)
        stream = _watched(spark.readStream.schema(events.schema).parquet(source))
        lines = shape.stats_lines(stats.window_stats(stream, WINDOWS["1d"], lo=LO, hi=HI))
        _run(spark, "stats_file", single_file.sink_file(lines, path), checkpoint)
    return spark.read.text(path).select(F.col("value").alias("line"))


def stream_routed(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of `parse_rejects` as a stream that is read once and divided: valid ones go on to a second
    stream, the others keep their reason."""
    source, routed = scratch_path(spark, "arrivals"), scratch_path(spark, "routed")
    rejects, out = scratch_path(spark, "rejects"), scratch_path(spark, "results")
    _damaged_lines(spark, folder).write.text(source)
    parsed = parse.parse_telemetry(line_sources.read_lines_stream(spark, path=source))
    _run(spark, "parse", routing.route(parsed, routed, rejects))
    valid = routing.routed_rows(spark, routed)
    _run(spark, "valid", sinks.sink_documents(valid, out, "parquet"))
    accepted = sinks.read_documents(spark, out, valid.schema, "parquet")
    rejected = spark.read.schema("value string, unreadable string").json(rejects)
    reasons = accepted.select(F.lit("").alias("unreadable")).unionByName(rejected.select("unreadable"))
    return reasons.groupBy("unreadable").agg(F.count("*").alias("n_lines"))


SPEED, SCRAPE, WRAP = 1440, 10, 4999


def rates_1m(spark: SparkSession, folder: str) -> DataFrame:
    """One-minute rates of a counter per event type, as if the events were replayed at a day a minute and the
    counters read every ten seconds. The counters begin anew now and then."""
    events = read_events(_utc(spark), folder, keep=("event_type",))
    start = F.unix_micros(F.lit(EVENTS_ORIGIN).cast("timestamp"))
    moved = start + F.call_function("div", F.unix_micros("event_ts") - start, F.lit(SPEED))
    samples = (
        events.select(F.col("event_type").alias("query"), moved.alias("us"), "event_id")
        .groupBy("query", F.call_function("div", F.col("us"), F.lit(SCRAPE * 1_000_000)).alias("scrape"))
        .agg(F.timestamp_micros(F.max("us")).alias("ts"), (F.max("event_id") % WRAP).alias("counter"))
    )
    rates = metrics.counter_rates(samples, ("query",), chunk_seconds=300)
    return rates.withColumn("rate", F.round("rate", DIGITS))


QUERIES: dict[str, Query] = {
    **{f"stats_{name}": _stats(name) for name in WINDOWS},
    **{f"query1_{name}": _query1(name) for name in ("1d", "3d", "23d")},
    **{f"rank_{name}": _rank(name) for name in WINDOWS},
    "global_top10": global_top10,
    "rollup_stats_3d": rollup_stats_3d,
    "rollup_rank_3d": rollup_rank_3d,
    "stats_all_windows": stats_all_windows,
    "rank_all_windows": rank_all_windows,
    "stats_lines_1d": stats_lines_1d,
    "rank_lines_1d": rank_lines_1d,
    "rank_lines_parts_1d": rank_lines_parts_1d,
    "rank_lists_parts_1d": rank_lists_parts_1d,
    "rank_lines_null_key": rank_lines_null_key,
    "rank_wide_1d": rank_wide_1d,
    "rank_wide_parts_1d": rank_wide_parts_1d,
    "global_wide_3d": global_wide_3d,
    "parse_lines": parse_lines,
    "parse_rejects": parse_rejects,
    "dataset_scan": dataset_scan,
    "dataset_wide_rows": dataset_wide_rows,
    "dataset_quotes": dataset_quotes,
    "restamp_even": restamp_even,
    "restamp_exact": restamp_exact,
    "restamp_rounded": restamp_rounded,
    "restamp_duplicates": restamp_duplicates,
    "replay_multi_file": replay_multi_file,
    "restamp_lines": restamp_lines,
    "coverage_1d": coverage_1d,
    "coverage_rank_1d": coverage_rank_1d,
    "latency_1d": latency_1d,
    "lineitem_returns_rank": lineitem_returns_rank,
    "stream_stats_1d": stream_stats_1d,
    "stream_rank_1d": stream_rank_1d,
    "stream_rank_documents_1d": stream_rank_documents_1d,
    "stream_live_rank_1d": stream_live_rank_1d,
    "stream_global_top10": stream_global_top10,
    "stream_stats_all_windows": stream_stats_all_windows,
    "stream_rank_all_windows": stream_rank_all_windows,
    "stream_delay_3min": stream_delay_3min,
    "progress_1d": progress_1d,
    "parse_ingest": parse_ingest,
    "stream_late_drop": stream_late_drop,
    "stream_replay_lines_3d": stream_replay_lines_3d,
    "stream_replay_deliveries": stream_replay_deliveries,
    "replay_sent_order": replay_sent_order,
    "stream_stats_file_1d": stream_stats_file_1d,
    "stream_routed": stream_routed,
    "rates_1m": rates_1m,
}
