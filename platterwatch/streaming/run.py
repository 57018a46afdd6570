"""Start named streams and wait for them."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from platterwatch import schema

PARTITIONS = "spark.sql.shuffle.partitions"

# State of many (window, group, device) keys belongs on local disk, not on the heap.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _starting(settings: dict[str, str]):
    """Streams copy the session's settings when they start; the session's own come back after that."""
    spark = SparkSession.active()
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start_streams(
    writers: dict[str, DataStreamWriter],
    checkpoint: str,
    every: str | None = schema.TRIGGER,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Start every writer under its name, each with its own checkpoint below ``checkpoint``, and
    with its state in RocksDB.

    ``every`` is the micro-batch interval; None takes what is available now and ends. The number
    of state partitions is fixed with the first start of a checkpoint: some small multiple of the
    cluster's cores that leaves room for the state to grow.
    """
    queries = []
    partitions = {PARTITIONS: str(state_partitions)} if state_partitions else {}
    with _starting({**STATE_CONF, **partitions}):
        for name, writer in writers.items():
            timing = {"availableNow": True} if every is None else {"processingTime": every}
            queries.append(
                writer.queryName(name)
                .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
                .trigger(**timing)
                .start()
            )
    return queries


def run_streams(
    writers: dict[str, DataStreamWriter],
    checkpoint: str,
    every: str | None = schema.TRIGGER,
    state_partitions: int | None = None,
    timeout: float | None = None,
    drain: bool = False,
) -> list[StreamingQuery]:
    """Start all streams, then wait for each; the first failure stops the others and is raised.

    With ``drain`` the streams run micro-batch after micro-batch until their sources have nothing more, and
    end. That is ``every=None`` for sources that do not tell Spark how to divide what is available, such as
    a bounded replay.
    """
    queries = start_streams(writers, checkpoint, "0 seconds" if drain else every, state_partitions)
    try:
        for query in queries:
            if drain:
                query.processAllAvailable()
                continue
            query.awaitTermination(timeout) if timeout else query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
    return queries
