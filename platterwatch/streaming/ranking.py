"""Rankings on streams.

The stream aggregates per (window, group, device), so its state is spread over all state
partitions by device and no group's devices meet in one state row. In append mode all rows of a
window leave in the same micro-batch, the one that closes it, and that batch is an ordinary
table: it is ranked with the batch operators. Every function takes one window or a list of windows; a
list shares one reading of the source and one state, and results then hold ``window_days``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from platterwatch import schema
from platterwatch.operators.filters import flagged
from platterwatch.operators.ranking import (
    ITEMS,
    device_failures,
    rank_globally,
    rank_groups,
    ranked_devices,
    top_k,
)
from platterwatch.operators.rollup import chained_failures
from platterwatch.operators.stats import latest_ingest
from platterwatch.operators.windows import DayWindow, group_by_window
from platterwatch.session import adaptive
from platterwatch.sources.storage import numbered_folders, remove, scratch_scope, stage
from platterwatch.streaming.sinks import BatchWriter

COMPACT_EVERY = 20
VALUES = ("failures", "n_tuples", "max_ingest_ts", "batch")  # of a device's row


def ranked_batches(
    writer: BatchWriter,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    k: int = schema.TOP_K,
) -> BatchWriter:
    """Rank a micro-batch of device rows, then write it.

    The rows are staged: the ranking reads them twice, and a lost executor must not send it back
    to the state of the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession), adaptive(batch.sparkSession):
            writer(rank_groups(stage(batch, "closed_windows"), key, items, k), batch_id)

    return write


def append_top_k(
    df: DataFrame,
    window: DayWindow | list[DayWindow],
    writer: BatchWriter,
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
    k: int = schema.TOP_K,
) -> DataStreamWriter:
    """The ranking of each window, written once when the window closes. Several windows are made from the
    devices of closed days."""
    if isinstance(window, list):
        devices = chained_failures(df, window, key, flag, items, ts)
    else:
        devices = device_failures(df, window, key, flag, items, ts)
    batches = ranked_batches(writer, key, items, k)
    return devices.writeStream.outputMode("append").foreachBatch(batches)


def globally_ranked_batches(
    writer: BatchWriter,
    best: str,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    k: int = schema.TOP_K,
    staged: bool = False,
) -> BatchWriter:
    """Rank the device rows of closed windows together with the best groups so far, then write. ``staged``
    says that the rows come as a table already, as in `by_window`.

    A closed group is final, so the k best of the former best and the new ones are the k best of
    all. Only those groups' devices are kept, below ``best``, as a table per micro-batch; older tables are
    removed. A batch that runs again starts from the table before it. Empty batches write nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark), adaptive(spark):
            rows = batch if staged else stage(batch, "closed_windows")
            if rows.isEmpty():
                return
            earlier = [n for n in numbered_folders(spark, best) if n < batch_id]
            if earlier:
                kept = spark.read.parquet(f"{best}/{earlier[-1]}")
                rows = rows.unionByName(kept.select(*rows.columns))
            ranked = rank_globally(stage(rows, "candidates"), key, items, k)
            ranked.write.mode("overwrite").parquet(f"{best}/{batch_id}")
            writer(spark.read.schema(ranked.schema).parquet(f"{best}/{batch_id}"), batch_id)
            remove(spark, [f"{best}/{n}" for n in earlier[:-1]])

    return write


def append_global_top_k(
    df: DataFrame,
    window: DayWindow,
    writer: BatchWriter,
    best: str,
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
    k: int = schema.TOP_K,
) -> DataStreamWriter:
    """The ranking over all windows closed so far, written whenever windows close. The one with the
    highest batch counts."""
    devices = device_failures(df, window, key, flag, items, ts)
    batches = globally_ranked_batches(writer, best, key, items, k)
    return devices.writeStream.outputMode("append").foreachBatch(batches)


def live_changes(
    df: DataFrame,
    window: DayWindow | list[DayWindow],
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
    ingest: str | None = "ingest_ts",
) -> DataFrame:
    """Totals per device and, with ``whole``, per group, for a stream in update mode: a micro-batch then holds
    those that it changed. ``first_seen`` and ``last_seen`` are times of micro-batches; they are equal for what
    a micro-batch saw for the first time."""
    df = flagged(df, flag, ts)
    copies = df.select(
        F.explode(F.array(F.lit(True), F.lit(False))).alias("whole"),
        key, flag, *items, ts, F.current_timestamp().alias("_seen"),
        *[c for c in df.columns if c == ingest],
    )
    copies = copies.withColumns({c: F.when(~F.col("whole"), F.col(c)) for c in items})
    grouped, starts = group_by_window(copies, window, [key, "whole", *items], ts)
    latest = latest_ingest(copies, ingest)
    out = grouped.agg(
        F.sum(flag).alias("failures"), F.count("*").alias("n_tuples"), *latest,
        F.min("_seen").alias("first_seen"), F.max("_seen").alias("last_seen"),
    )
    names = ["failures", "n_tuples", *(["max_ingest_ts"] if latest else []), "first_seen", "last_seen"]
    return out.select(*starts, key, "whole", *items, *names)


class ChangeLog:
    """What a live ranking reads: totals of groups by version, and the devices of open windows as a log.

    ``totals/n`` holds the total of every group after micro-batch n, made from the version before it and the
    changed groups. ``batch/n`` holds the devices that micro-batch n changed, ``snapshot/n`` the last rows of every
    device after it, now and then. Groups are ranked by the totals alone, which have one row per group and
    window; devices are looked up for the ranked groups of changed windows only, and the log is sorted by
    window, so that files and row groups of other windows are passed over. Entries before the last snapshot
    but one are removed, with the windows that cannot change any more. A batch that runs again replaces
    its entries and starts from the same version.
    """

    def __init__(self, path: str, window: DayWindow | list[DayWindow], delay: str, every: int):
        self.path, self.delay, self.every = path.rstrip("/"), delay, every
        self.windows = window if isinstance(window, list) else [window]

    def _numbers(self, spark: SparkSession, kind: str) -> list[int]:
        return numbered_folders(spark, f"{self.path}/{kind}")

    def _table(self, like: DataFrame, kind: str, numbers: list[int]) -> DataFrame:
        """Entries with the columns of a table; given, they need not be looked up in the files."""
        paths = [f"{self.path}/{kind}/{n}" for n in numbers]
        return like.sparkSession.read.schema(like.schema).parquet(*paths)

    def _write(self, rows: DataFrame, kind: str, number: int, key: str) -> DataFrame:
        """Sorted by window, in balanced files, and read back."""
        path = f"{self.path}/{kind}/{number}"
        rows = rows.hint("rebalance", "window_day", key).sortWithinPartitions("window_day", key)
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def add(self, batch: DataFrame, batch_id: int, key: str) -> DataFrame:
        """Write the changed rows and read them back."""
        marked = batch.withColumns({
            "batch": F.lit(batch_id).cast("long"),
            "window_day": _day(),
        })
        return self._write(marked, "batch", batch_id, key)

    def update_totals(self, changed: DataFrame, batch_id: int, key: str) -> DataFrame:
        """The version of the totals after a micro-batch. A group's total is that of the last batch that
        changed it; devices seen for the first time add to its number of devices."""
        spark, group = changed.sparkSession, [*_window_columns(changed), key]
        first = ~F.col("whole") & (F.col("first_seen") == F.col("last_seen"))
        moved = changed.groupBy(*group).agg(
            F.max(F.when(F.col("whole"), F.col("failures"))).alias("failures"),
            F.count(F.when(first, 1)).alias("n_devices"),
            F.max("batch").alias("batch"),
        )
        earlier = [n for n in self._numbers(spark, "totals") if n < batch_id]
        if earlier:
            before = self._table(moved, "totals", earlier[-1:])
            moved = moved.unionByName(before).groupBy(*group).agg(
                F.max_by("failures", "batch").alias("failures"),
                F.sum("n_devices").alias("n_devices"),
                F.max("batch").alias("batch"),
            )
        path = f"{self.path}/totals/{batch_id}"
        moved.write.mode("overwrite").parquet(path)
        remove(spark, [f"{self.path}/totals/{n}" for n in earlier[:-1]])
        return spark.read.schema(moved.schema).parquet(path)

    def devices(self, changed: DataFrame, days: list[int], batch_id: int) -> DataFrame:
        """The logged device rows of the windows that begin on some days, with the ``batch`` of each."""
        spark = changed.sparkSession
        snapshots = [n for n in self._numbers(spark, "snapshot") if n < batch_id]
        start = snapshots[-1] if snapshots else -1
        rows = self._table(changed, "batch", [n for n in self._numbers(spark, "batch") if start < n <= batch_id])
        if snapshots:
            rows = rows.unionByName(self._table(changed, "snapshot", [start]))
        return rows.where(F.col("window_day").isin(days) & ~F.col("whole"))

    def compact(
        self, changed: DataFrame, totals: DataFrame, batch_id: int, key: str, items: list[str]
    ) -> None:
        """Every so many batches, write the last rows of all devices whose windows may still change, drop the
        totals of the others, and remove what is older than the snapshot before."""
        spark = totals.sparkSession
        snapshots = [n for n in self._numbers(spark, "snapshot") if n < batch_id]
        start = snapshots[-1] if snapshots else -1
        if batch_id - start < self.every:
            return
        seen = totals.where(F.col("batch") < batch_id).agg(F.max("window_start")).first()[0]
        open_ = stage(totals.where(self._may_change(totals, seen)), "totals")
        starts = open_.select(_day().alias("day")).distinct()
        days = [r["day"] for r in starts.collect()]
        log = self.devices(changed, days, batch_id)
        last = _last(log, [*_window_columns(log), "window_day", "whole", key, *items])
        self._write(last, "snapshot", batch_id, key)
        open_.write.mode("overwrite").parquet(f"{self.path}/totals/{batch_id}")
        remove(spark, [f"{self.path}/snapshot/{n}" for n in snapshots[:-1]])
        remove(spark, [f"{self.path}/batch/{n}" for n in self._numbers(spark, "batch") if n <= start])

    def _may_change(self, rows: DataFrame, seen) -> Column:
        """Not of windows that ended, less the delay, before the latest window seen in earlier
        batches began: the watermark has passed them, and later rows of them are dropped."""
        if seen is None:
            return F.lit(True)
        end = F.lit(None).cast("timestamp")
        for w in self.windows:
            of_this = F.col("window_days") == w.days if "window_days" in rows.columns else F.lit(True)
            end = F.when(of_this, w.end_of(F.col("window_start"))).otherwise(end)
        return end > F.lit(seen) - F.expr(f"INTERVAL {self.delay}")


def _window_columns(rows: DataFrame) -> list[str]:
    return [c for c in ("window_days", "window_start") if c in rows.columns]


def _day() -> Column:
    """The day on which a window begins, as a number."""
    return F.unix_date(F.to_date("window_start"))


def _last(log: DataFrame, device: list[str]) -> DataFrame:
    """The last logged totals of each device and window."""
    values = [c for c in log.columns if c not in (*device, "batch")]
    last = F.max_by(F.struct(*values, "batch"), "batch").alias("last")
    return log.groupBy(*device).agg(last).select(*device, "last.*")


def live_batches(
    writer: BatchWriter,
    log: ChangeLog,
    key: str = "vault_id",
    items: tuple[str, ...] = ITEMS,
    k: int = schema.TOP_K,
) -> BatchWriter:
    """Rank the windows that a micro-batch of `live_changes` belongs to, then write them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark), adaptive(spark):
            changed = log.add(batch, batch_id, key)
            totals = log.update_totals(changed, batch_id, key)
            # what changed is seen in the totals of groups, which are far fewer than the devices
            moved = totals.where(F.col("batch") == batch_id)
            days = [r["day"] for r in moved.select(_day().alias("day")).distinct().collect()]
            if days:
                # windows of several lengths may begin on a day and only some of them have changed
                mine = moved.select(*_window_columns(moved)).distinct()
                best = top_k(totals.join(mine, mine.columns, "left_semi"), k, key)
                rows = ranked_devices(log.devices(changed, days, batch_id), best, key, items)
                last = _last(rows, [c for c in rows.columns if c not in VALUES])
                writer(last.drop("batch"), batch_id)
            log.compact(changed, totals, batch_id, key, list(items))

    return write


def live_top_k(
    df: DataFrame,
    window: DayWindow | list[DayWindow],
    writer: BatchWriter,
    changes: str,
    key: str = "vault_id",
    flag: str = "failure",
    items: tuple[str, ...] = ITEMS,
    ts: str = "event_ts",
    k: int = schema.TOP_K,
    delay: str = schema.WATERMARK_DELAY,
    every: int = COMPACT_EVERY,
) -> DataStreamWriter:
    """The current ranking of every window that a micro-batch changes, written with that batch.

    The stream runs in update mode, so state holds open windows only and a micro-batch carries
    only the groups and devices whose totals changed. The tables below ``changes`` follow them, see
    ``ChangeLog``. ``delay`` is that of the
    watermark; ``every`` is the number of batches from one snapshot to the next. Of a
    window the ranking with the highest batch counts; see ``latest_rankings``.
    """
    found = live_changes(df, window, key, flag, items, ts)
    log = ChangeLog(changes, window, delay, every)
    return found.writeStream.outputMode("update").foreachBatch(
        live_batches(writer, log, key, items, k)
    )


def latest_rankings(results: DataFrame) -> DataFrame:
    """Of each window's rankings the one of its last batch, from results with ``batch_id``."""
    windows = [c for c in ("window_days", "window_start") if c in results.columns]
    last = results.groupBy(*windows).agg(F.max("batch_id").alias("batch_id"))
    return results.join(last, [*windows, "batch_id"]).drop("batch_id")
