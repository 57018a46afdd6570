"""Observability of results: how late a result is and how many tuples stand behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_latency(results: DataFrame, emitted: Column | None = None) -> DataFrame:
    """Add ``latency_ms``: emission time minus the latest ingest time behind the result."""
    emitted = F.current_timestamp() if emitted is None else emitted
    latency = F.unix_millis(emitted) - F.unix_millis(F.col("max_ingest_ts"))
    return results.withColumn("latency_ms", latency)


def coverage_metrics(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Result rows, tuples behind them and, where measured, the worst latency."""
    columns = [F.count("*").alias("n_results"), F.sum("n_tuples").alias("n_tuples")]
    if "latency_ms" in results.columns:
        columns.append(F.max("latency_ms").alias("max_latency_ms"))
    return results.groupBy(*(by or [])).agg(*columns)


def counter_rates(
    samples: DataFrame,
    by: tuple[str, ...],
    ts: str = "ts",
    counter: str = "counter",
    seconds: int = 60,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """The rate of a counter per second over the last minute, at each of its samples: ``by, ts, counter, rate``.

    Samples may come at any times. A value below the one before means that the counter began again at zero,
    and counts whole. The rate is the growth since the earliest sample of the minute, divided by the time
    since then, and null where that is the sample itself. Of samples at one time the largest value counts.

    A series is never sorted in one task: it is cut into chunks of time, each with a copy of the minute before it.
    """
    micros, own, chunk = "_micros", "_own", "_chunk"
    size, back = chunk_seconds * 1_000_000, seconds * 1_000_000
    sampled = samples.groupBy(*by, ts).agg(F.max(counter).alias(counter))
    at = F.unix_micros(F.col(ts))
    home = at - F.pmod(at, F.lit(size))
    late = F.pmod(at, F.lit(size)) >= size - back
    placed = sampled.select("*", at.alias(micros), home.alias(own)).select(
        "*", F.explode(F.array_compact(F.array(F.col(own), F.when(late, F.col(own) + size)))).alias(chunk)
    )
    series = Window.partitionBy(*by, chunk).orderBy(micros)
    minute = series.rangeBetween(-back, Window.currentRow)
    before = F.lag(counter).over(series)
    grown = F.when(F.col(counter) < before, F.col(counter)).otherwise(F.col(counter) - before)
    steps = placed.withColumn("_grown", F.coalesce(grown, F.lit(0)))
    growth = F.sum("_grown").over(minute) - F.first("_grown").over(minute)
    span = (F.col(micros) - F.min(micros).over(minute)) / F.lit(1_000_000)
    rates = steps.withColumn("rate", F.when(span > 0, growth / F.nullif(span, F.lit(0.0))))
    return rates.where(F.col(chunk) == F.col(own)).select(*by, ts, counter, "rate")


def progress_rates(progress: DataFrame, seconds: int = 60) -> DataFrame:
    """Of a progress table: input rows per second over the last minute and latency in seconds, per stream and
    update. A stream that starts again begins a new count."""
    started = F.col("started").cast("timestamp")
    order = Window.partitionBy("query").orderBy("batch_id", "started")
    totals = progress.where("input_rows is not null").select(
        "query", started.alias("ts"), (F.col("batch_ms") / 1000).alias("latency"),
        F.sum("input_rows").over(order).alias("counter"),
    )
    latency = totals.groupBy("query", "ts").agg(F.max("latency").alias("latency"))
    rates = counter_rates(totals, ("query",), seconds=seconds)
    return rates.join(latency, ["query", "ts"]).select("query", "ts", "rate", "latency")
