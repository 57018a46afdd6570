"""A session with the settings the operators expect."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def adaptive(spark: SparkSession):
    """Plan again at run time inside the block, then as before. A stream's session has that turned off, as its
    state needs a fixed number of partitions; the tables that a micro-batch has written do not, and without it
    their joins are neither chosen by measured size nor split where a group is large."""
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


def session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Master, memory and partition counts come from the cluster unless given."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
