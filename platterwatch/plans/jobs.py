"""The two queries as runnable jobs, on a batch of lines or on a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterwatch import schema
from platterwatch.operators import metrics, parse, shape
from platterwatch.operators.ranking import ITEMS, ranked_groups
from platterwatch.operators.rollup import chained_failures, chained_stats, day_stats, rollup_stats
from platterwatch.operators.windows import DayWindow, reference_windows
from platterwatch.plans.query2 import query2_rollup
from platterwatch.sources.storage import scratch_scope, stage
from platterwatch.streaming import sinks
from platterwatch.streaming.ranking import append_top_k, globally_ranked_batches, live_top_k
from platterwatch.streaming.routing import route, routed_rows
from platterwatch.streaming.run import run_streams
from platterwatch.streaming.sinks import BatchWriter
from platterwatch.streaming.watermark import with_event_time

FORMS = ("lines", "documents", "wide")
SINKS = ("files", "file", "console", "collection")


def result_path(output: str, window: DayWindow, number: int) -> str:
    return f"{output.rstrip('/')}/query_{window.days}_{number}"


def _shaped(result: DataFrame, number: int, form: str, parts: int) -> DataFrame:
    if form == "documents":
        return result
    if number == 1:
        lined = shape.stats_lines(result)
        return lined if form == "lines" else result
    if form == "lines":
        return shape.rank_lines(result, parts)
    return shape.rank_wide(result, parts)


def _measured(result: DataFrame, number: int) -> DataFrame:
    result = ranked_groups(result) if number == 2 else result
    return metrics.coverage_metrics(metrics.with_latency(result)).withColumn(
        "emitted", F.current_timestamp()
    )


def _writer(
    output: str,
    window: DayWindow,
    number: int,
    form: str,
    parts: int,
    sink: str = "files",
    collection: tuple[str, str] | None = None,
) -> BatchWriter:
    path = result_path(output, window, number)

    def shaped(batch: DataFrame) -> DataFrame:
        return _shaped(batch, number, form, parts)

    def measured(batch: DataFrame) -> DataFrame:
        return _measured(batch, number)

    if sink == "console":
        results = sinks.console_writer(shaped)
    elif sink == "collection":
        uri, database = collection
        results = sinks.collection_writer(uri, database, f"query_{window.days}_{number}", shaped)
    elif sink == "file":
        order = ["window_start", "vault_id" if number == 1 else "part"]
        results = sinks.file_writer(f"{path}.csv", lambda batch: shaped(batch).orderBy(*order))
    elif form == "lines":
        results = sinks.text_writer(path, shaped)
    else:
        results = sinks.document_writer(path, shaped)
    return sinks.fan_out(results, sinks.document_writer(f"{path}_metrics", measured), staged=True)


def stream_job(
    spark: SparkSession,
    lines: DataFrame,
    number: int,
    output: str,
    checkpoint: str,
    windows: list[DayWindow] | None = None,
    form: str = "lines",
    live: bool = False,
    delay: str = schema.WATERMARK_DELAY,
    every: str | None = schema.TRIGGER,
    state_partitions: int | None = None,
    lo: int = schema.VAULT_RANGE[0],
    hi: int = schema.VAULT_RANGE[1],
    k: int = schema.TOP_K,
    rejects: str | None = None,
    parts: int = 1,
    overall: bool = False,
    day_precision: bool = False,
    sink: str = "files",
    collection: tuple[str, str] | None = None,
    drain: bool = False,
) -> None:
    """Run query 1 or 2 over a stream of lines as one named stream for all windows, until it ends.

    The source is read once and one state holds all windows. Every window has its own results, with their
    latency and coverage beside them. ``live`` writes the current ranking of the windows that a
    micro-batch changes, instead of one per closed window; ``overall`` the ranking over all closed
    windows of each length. ``rejects`` names a folder for the lines that cannot be used: a first stream then
    reads the source and divides it, and the query runs on the valid rows that it writes below the
    checkpoint. ``parts`` is the number of lists into
    which the devices of a ranked group go. ``sink`` is ``files`` below ``output``, ``file`` for one growing file
    of lines per window, ``console``, or ``collection`` with ``collection`` as (uri, database).
    """
    windows = windows or reference_windows()
    parsed = parse.parse_telemetry(lines, day_precision=day_precision)
    routing = None
    if rejects:
        routed = f"{checkpoint.rstrip('/')}/routed"
        routing = {"parse": route(parsed, routed, rejects)}
        rows = with_event_time(routed_rows(spark, routed), delay=delay)
    else:
        rows = with_event_time(parse.valid_rows(parsed), delay=delay)
    state = f"{checkpoint.rstrip('/')}/rankings"
    writers = {
        w.days: _writer(output, w, number, form, parts, sink, collection) for w in windows
    }
    if number == 1:
        result = chained_stats(rows, windows, lo=lo, hi=hi)
        stream = result.writeStream.outputMode("append").foreachBatch(sinks.by_window(writers))
    elif live:
        changes = f"{state}/changes"
        stream = live_top_k(rows, windows, sinks.by_window(writers), changes, k=k, delay=delay)
    elif overall:
        ranked = {
            days: globally_ranked_batches(writer, f"{state}/best_{days}", k=k, staged=True)
            for days, writer in writers.items()
        }
        devices = chained_failures(rows, windows, "vault_id", "failure", ITEMS)
        stream = devices.writeStream.outputMode("append").foreachBatch(sinks.by_window(ranked))
    else:
        stream = append_top_k(rows, windows, sinks.by_window(writers), k=k)
    streams = {f"query_{number}": stream}
    if routing and (every is None or drain):
        # one after the other, so that the query finds all that the first stream wrote
        run_streams(routing, checkpoint, every, drain=drain)
        run_streams(streams, checkpoint, None, state_partitions)
    else:
        run_streams({**(routing or {}), **streams}, checkpoint, every, state_partitions, drain=drain)


def batch_job(
    spark: SparkSession,
    lines: DataFrame,
    number: int,
    output: str,
    windows: list[DayWindow] | None = None,
    form: str = "lines",
    lo: int = schema.VAULT_RANGE[0],
    hi: int = schema.VAULT_RANGE[1],
    k: int = schema.TOP_K,
    rejects: str | None = None,
    parts: int = 1,
    day_precision: bool = False,
) -> None:
    """Run query 1 or 2 over a batch of lines and write one result per window, with its latency and
    coverage beside it.

    The lines are scanned once: day partials are staged, and every window is made from them.
    ``rejects`` names a folder for the lines that cannot be used; the parsed lines are then staged.
    """
    windows = windows or reference_windows()
    with scratch_scope(spark):
        parsed = parse.parse_telemetry(lines, day_precision=day_precision)
        if rejects:
            parsed = stage(parsed, "parsed")
        rows = parse.valid_rows(parsed)
        if rejects:
            parse.rejected_rows(parsed).write.mode("overwrite").json(rejects)
        if number == 1:
            partials = stage(day_stats(rows, lo=lo, hi=hi), "day_stats")
        else:
            ranked = stage(query2_rollup(rows, windows, k), "ranked")
        for window in windows:
            if number == 1:
                result = rollup_stats(partials, [window]).drop("window_days")
            else:
                result = ranked.where(F.col("window_days") == window.days).drop("window_days")
            out = _shaped(result, number, form, parts)
            path = result_path(output, window, number)
            if form == "lines":
                keys = ["window_start", "vault_id" if number == 1 else "part"]
                out.orderBy(*keys).select("line").write.mode("overwrite").text(path)
            else:
                out.write.mode("overwrite").json(path)
            _measured(result, number).write.mode("overwrite").json(f"{path}_metrics")
