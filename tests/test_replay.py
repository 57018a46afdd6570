import os
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from platterwatch.operators.replay import (
    flush_line,
    in_sent_order,
    incomplete_days,
    restamp_even,
    restamp_lines,
    send_rows,
    with_flush_row,
    write_replay,
    write_replay_kafka,
)
from platterwatch.operators.parse import line_of
from platterwatch.sources.replay import ReplayReader, is_replay, read_replay_stream
from platterwatch.sources.storage import stage
from platterwatch.streaming.run import run_streams

MIDNIGHT = "2023-04-0{}T00:00:00"
DAY = timedelta(days=1)


def numbered(spark, per_day):
    rows = [
        (datetime.fromisoformat(MIDNIGHT.format(d)), 100 * d + i)
        for d, n in per_day.items()
        for i in range(n)
    ]
    rows = rows[::-1]
    return spark.createDataFrame(rows, "event_ts timestamp, id int").repartition(5)


def spread(spark, df, exact=False):
    moved = restamp_even(df, order=("id",), exact=exact).collect()
    out = {}
    for r in sorted(moved, key=lambda r: r.id):
        out.setdefault(r.id // 100, []).append(r.event_ts)
    return out


def test_even_steps_from_midnight(spark):
    counts = {1: 1, 2: 2, 3: 3, 4: 7, 5: 97}
    got = spread(spark, numbered(spark, counts))
    for d, n in counts.items():
        start = datetime.fromisoformat(MIDNIGHT.format(d))
        assert got[d] == [start + (DAY / n) * i for i in range(n)]
        assert got[d][-1] < start + DAY


def test_exact_steps(spark):
    got = spread(spark, numbered(spark, {1: 7}), exact=True)
    micros = [(t - datetime(2023, 4, 1)) // timedelta(microseconds=1) for t in got[1]]
    assert micros == [i * 86_400_000_000 // 7 for i in range(7)]


def test_one_day_over_many_partitions(spark):
    """One day holds nearly all rows, and no task numbers it alone."""
    n = 20_000
    df = spark.range(n).select(
        F.lit("2023-04-01").cast("timestamp").alias("event_ts"), F.col("id")
    ).unionByName(
        spark.range(n, n + 50).select(
            F.lit("2023-04-02").cast("timestamp").alias("event_ts"), F.col("id")
        )
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        moved = restamp_even(df.repartition(8), order=("id",)).cache()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert moved.filter("id < 20000").select(F.spark_partition_id()).distinct().count() > 1
    step = 86_400_000_000 // n
    wrong = moved.filter(
        (F.col("id") < n)
        & (F.unix_micros("event_ts") != 1680307200000000 + F.col("id") * step)
    )
    assert moved.count() == n + 50 and wrong.count() == 0


def test_ties_do_not_depend_on_partitioning(spark):
    rows = [(datetime(2023, 4, 1), 1, f"row {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "event_ts timestamp, id int, name string")
    one = restamp_even(df.repartition(1), order=("id",)).collect()
    many = restamp_even(df.repartition(7), order=("id",)).collect()
    assert sorted(one) == sorted(many)


def test_scan_order_without_order_columns(spark):
    rows = [(datetime(2023, 4, 1), i) for i in (5, 3, 9, 1)]
    df = stage(spark.createDataFrame(rows, "event_ts timestamp, id int").coalesce(1), "scan")
    moved = restamp_even(df).orderBy("event_ts").collect()
    assert [r.id for r in moved] == [5, 3, 9, 1]


def test_lines_keep_their_rest(spark, line):
    at = "2023-04-01T00:00:00.000000"
    lines = spark.createDataFrame(
        [(line(at, serial=f"s{i}"), i) for i in range(4)] + [("date,serial_number", 9)],
        "value string, n int",
    )
    got = [r.value for r in restamp_lines(lines, order=("n",)).orderBy("n").collect()]
    assert got == [
        line(f"2023-04-01T{6 * i:02d}:00:00.000000", serial=f"s{i}") for i in range(4)
    ]


def test_flush_row(spark, telemetry):
    df = telemetry([("2023-04-01T00:00:00", 1000, 1, 20, "m", "s")])
    out = with_flush_row(df, datetime(2023, 4, 26), vault_id=0, failure=0).orderBy("event_ts")
    last = out.collect()[-1]
    assert (last.event_ts, last.vault_id, last.failure) == (datetime(2023, 4, 26), 0, 0)
    assert out.schema == df.schema


def in_order(manifest):
    return [r.file for r in manifest.orderBy("day", "part").collect()]


def test_replay_files_are_days_in_order(spark, telemetry, tmp_path):
    rows = [(f"2023-04-0{d}T0{h}:00:00", 1000, 0, 20, "m", f"{d}{h}") for d in (3, 1, 2) for h in (4, 2)]
    df = telemetry(rows)
    path = str(tmp_path / "replay")
    lines = df.select("event_ts", line_of(df).alias("value"))
    manifest = write_replay(lines, path, flush=flush_line())
    texts = [t for name in in_order(manifest) for t in open(name.replace("file:", "")).read().splitlines()]
    dates = [t[:26] for t in texts]
    assert dates == sorted(dates) and len(dates) == 7
    days = {r.day for r in manifest.collect()}
    assert days == {"2023-04-01", "2023-04-02", "2023-04-03", "9999-12-31"}
    assert manifest.agg(F.sum("bytes")).first()[0] == sum(len(t) + 1 for t in texts)


def test_deliveries_name_their_own_files(spark, tmp_path):
    path = str(tmp_path / "replay")
    seen = []
    for days in ({1: 3}, {2: 2, 3: 1}, {1: 2}):
        seen.append(set(in_order(write_replay(numbered(spark, days).withColumn("value", F.col("id")
                    .cast("string")), path))))
    assert len(set().union(*seen)) == sum(map(len, seen))
    assert [len({re.search("event_day=([^/]+)", f).group(1) for f in x}) for x in seen] == [1, 2, 1]


def batches(spark, path, tmp_path, files, name="q", fail_at=None, found=None):
    """Run the replay to its end; the ids of each micro-batch."""
    found = [] if found is None else found

    def write(batch, batch_id):
        if len(found) == fail_at:
            raise RuntimeError("lost")
        found.append(sorted(int(r.value) for r in batch.collect()))

    offered = str(tmp_path / "check" / name / "offered") if files else None
    stream = read_replay_stream(spark, path, files, offered)
    run_streams({name: stream.writeStream.foreachBatch(write)}, str(tmp_path / "check"), drain=True)
    return found


def test_replay_stream_goes_on_where_it_stopped(spark, tmp_path):
    """Three deliveries, files in reversed order of their times, a failure in between."""
    path = str(tmp_path / "replay")

    def deliver(days):
        rows = numbered(spark, days).withColumn("value", F.col("id").cast("string"))
        for k, name in enumerate(in_order(write_replay(rows, path))):
            os.utime(name.replace("file:", ""), (1_700_000_000 - k, 1_700_000_000 - k))

    deliver({1: 40, 2: 1, 3: 9})
    found = []
    batches(spark, path, tmp_path, 1, found=found)
    assert len(found) >= 3
    deliver({4: 5, 5: 30})
    with pytest.raises(Exception, match="lost"):
        batches(spark, path, tmp_path, 1, found=found, fail_at=len(found) + 1)
    batches(spark, path, tmp_path, 1, found=found)
    deliver({2: 3})  # an old day in a new delivery comes after what is there
    batches(spark, path, tmp_path, 1, found=found)
    done = len(found)
    batches(spark, path, tmp_path, 1, found=found)
    assert len(found) == done
    want = [100 * d + i for d, n in ((1, 40), (2, 1), (3, 9), (4, 5), (5, 30), (2, 3)) for i in range(n)]
    assert sum(found, []) == want
    assert sorted(sum(batches(spark, path, tmp_path, None, "whole"), [])) == sorted(want)


def test_offers_never_go_back(spark, tmp_path):
    path, offered = str(tmp_path / "replay"), f"file:{tmp_path}/kept/offered"
    write_replay(numbered(spark, {1: 2, 2: 2, 3: 2, 4: 2}).withColumn("value", F.col("id").cast("string")), path)
    options = {"path": f"file:{path}", "files": "2", "offered": offered}
    reader = ReplayReader(options, None)
    assert [reader.latestOffset()["files"] for _ in range(2)] == [2, 4]
    again = ReplayReader(options, None)  # after a crash
    total = len(again.partitions({"files": 0}, {"files": 4}))
    assert total == 4 and again.latestOffset()["files"] >= 4
    with pytest.raises(ValueError):
        ReplayReader({"path": path, "files": "2"}, None)


def test_replay_without_a_delivery_is_an_empty_stream(spark, tmp_path):
    assert not is_replay(spark, str(tmp_path / "nothing"))
    assert sum(batches(spark, str(tmp_path / "nothing"), tmp_path, None), []) == []


@pytest.mark.parametrize("columns", [["id"], ["id", "event_ts"]])
def test_replay_as_tables(spark, tmp_path, columns):
    df = numbered(spark, {1: 3, 2: 2})
    path = str(tmp_path / "tables")
    manifest = write_replay(df, path, columns=columns, text=False)
    assert manifest.count() >= 2
    assert spark.read.parquet(path).count() == 5
    stream = read_replay_stream(spark, path, schema=df.select(*columns).schema)
    found = []
    sink = stream.writeStream.foreachBatch(lambda batch, _: found.extend(batch.collect()))
    run_streams({"t": sink}, str(tmp_path / "check"), every=None)
    assert sorted(found) == sorted(df.select(*columns).collect())


def test_a_large_day_stays_a_day(spark):
    at = F.lit("2023-04-01 05:00:00").cast("timestamp")
    rows = spark.range(576_001).select("id", at.alias("event_ts"))
    days = restamp_even(rows, order=("id",)).select(F.to_date("event_ts").alias("day")).distinct()
    assert [str(r.day) for r in days.collect()] == ["2023-04-01"]


def test_kafka_replay_sends_a_day_after_the_other(spark):
    rows = [(f"2023-04-{d:02d} 0{h}:00:00", f"{d}-{h}") for d in (3, 1, 2) for h in (5, 1)]
    table = spark.createDataFrame([*rows, (None, "no time")], "t string, value string")
    sent = []
    write_replay_kafka(
        table.select(F.col("t").cast("timestamp").alias("event_ts"), "value"), "", "",
        send=lambda df: sent.append([(r.key, r.value) for r in df.orderBy("key").collect()]),
    )
    assert [[v for _, v in day] for day in sent] == [["no time"], ["1-1", "1-5"], ["2-1", "2-5"], ["3-1", "3-5"]]
    assert sent[1][0][0] == "2023-04-01:000000000000:2"


def test_a_day_is_sent_from_its_own_files(spark):
    """Each day's job reads the stage of that day; ranges of a hot day go through several tasks."""
    at = F.timestamp_seconds(F.lit(1680307200) + F.col("id") % 3 * 86400 + F.col("id"))
    rows = spark.range(3000).select(at.alias("event_ts"), F.col("id").cast("string").alias("value"))
    plans = []

    def send(lines):
        plans.append(lines._jdf.queryExecution().toString())
        assert lines.count() == 1000

    write_replay_kafka(rows, "", "", send=send)
    assert len(plans) == 3 and all("PartitionFilters: [isnotnull(day" in p for p in plans)


def test_the_reader_restores_what_was_sent(spark):
    rows = [(datetime(2023, 4, 1 + k % 3, k % 24), f"v{k}") for k in range(200)]
    sent = send_rows(spark.createDataFrame(rows, "event_ts timestamp, value string")).select("key", "value")
    mixed = sent.unionByName(sent.limit(50)).orderBy(F.xxhash64("key"))
    got = [r.value for r in in_sent_order(mixed).collect()]
    assert got == [v for t, v in sorted(rows, key=lambda r: (r[0].date(), r[0]))] or len(set(got)) == 200
    days = in_sent_order(mixed).groupBy("day").agg(F.count("*").alias("n"), F.max("day_rows").alias("m"))
    assert all(r.n == r.m for r in days.collect())
    assert incomplete_days(in_sent_order(mixed)).collect() == []
    lost = mixed.where(~F.col("key").startswith("2023-04-02:000000000007"))
    assert [(str(r.day), r.missing) for r in incomplete_days(in_sent_order(lost)).collect()] == [("2023-04-02", 1)]


def test_typed_replay_has_a_typed_closing_row(spark, telemetry, tmp_path):
    df = telemetry([("2023-04-01T10:00:00", 1001, 0, 20, "m", "s")])
    path = str(tmp_path / "replay")
    write_replay(df, path, text=False, flush=flush_line())
    rows = spark.read.schema(df.schema).parquet(path).orderBy("event_ts").collect()
    assert [r.vault_id for r in rows] == [1001, 0] and rows[1].failure == 0
