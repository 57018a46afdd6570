"""Sinks for micro-batches.

Each micro-batch is written to its own ``batch_id=`` folder with overwrite. A batch that runs
again after a failure replaces its own output, so results hold every row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from platterwatch.session import adaptive
from platterwatch.sources.storage import scratch_scope, stage
from platterwatch.streaming.single_file import append_once

Shape = Callable[[DataFrame], DataFrame]
BatchWriter = Callable[[DataFrame, int], None]


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def text_writer(path: str, shape: Shape | None = None, single_file: bool = False) -> BatchWriter:
    """Write the ``line`` column as text. ``single_file`` is for small results only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = (shape(batch) if shape else batch).select("line")
        if single_file:
            out = out.coalesce(1)
        out.write.mode("overwrite").text(_folder(path, batch_id))

    return write


def document_writer(path: str, shape: Shape | None = None, form: str = "json") -> BatchWriter:
    """Write rows as documents: JSON lines (or Parquet) keep nested lists."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = shape(batch) if shape else batch
        out.write.mode("overwrite").format(form).save(_folder(path, batch_id))

    return write


def console_writer(shape: Shape | None = None) -> BatchWriter:
    """Show rows untruncated on the driver's console."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = shape(batch) if shape else batch
        out.write.mode("append").format("console").option("truncate", "false").save()

    return write


def file_writer(path: str, shape: Shape | None = None) -> BatchWriter:
    """Add the ``line`` column to one growing file, each micro-batch once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(shape(batch) if shape else batch, path, batch_id)

    return write


# The columns that tell a result row from others, where it has them.
DOCUMENT_KEY = ("window_days", "window_start", "ts", "part", "rank", "vault_id", "model", "serial_number", "line")


def with_document_id(rows: DataFrame, key: tuple[str, ...] = DOCUMENT_KEY) -> DataFrame:
    """Add ``_id``, a digest of the key columns that the rows have. Null and empty text differ in it."""
    values = [F.col(c).cast("string") for c in key if c in rows.columns]
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return rows.withColumn("_id", F.sha2(F.concat_ws(",", *parts), 256))


def collection_writer(
    uri: str, database: str, collection: str, shape: Shape | None = None, form: str = "mongodb"
) -> BatchWriter:
    """Put rows into a MongoDB collection. Needs the MongoDB connector on the class path. A row's ``_id``
    comes from its key columns and it replaces the document of that id, so a batch that is written again
    leaves the collection as it was. Rows carry the ``batch_id`` that wrote them last."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = with_document_id(shape(batch) if shape else batch).withColumn("batch_id", F.lit(batch_id))
        out.write.mode("append").format(form).options(
            **collection_options(uri, database, collection)
        ).save()

    return write


def by_window(writers: dict[int, BatchWriter]) -> BatchWriter:
    """Give each window length its own writer, without the column ``window_days``. Lengths without rows
    in the micro-batch write nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession), adaptive(batch.sparkSession):
            rows = stage(batch, "windows")
            found = {r["window_days"] for r in rows.select("window_days").distinct().collect()}
            for days, writer in writers.items():
                if days in found:
                    part = rows.where(F.col("window_days") == days).drop("window_days")
                    writer(part, batch_id)

    return write


def fan_out(*writers: BatchWriter, staged: bool = False) -> BatchWriter:
    """Several writers for one micro-batch, which is computed once: it is kept for them unless it is a
    ``staged`` table already, as in `by_window`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not staged:
            batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            if not staged:
                batch.unpersist()

    return write


def sink_text(df: DataFrame, path: str, single_file: bool = False) -> DataStreamWriter:
    """Append result lines below ``path``."""
    return df.writeStream.foreachBatch(text_writer(path, single_file=single_file))


def sink_documents(df: DataFrame, path: str, form: str = "json") -> DataStreamWriter:
    """Append result documents below ``path``."""
    return df.writeStream.foreachBatch(document_writer(path, form=form))


def sink_collection(df: DataFrame, uri: str, database: str, collection: str) -> DataStreamWriter:
    """Put results into a MongoDB collection, as `collection_writer` does. Needs the connector on the class
    path."""
    options = collection_options(uri, database, collection)
    return with_document_id(df).writeStream.format("mongodb").options(**options).outputMode("append")


def collection_options(uri: str, database: str, collection: str) -> dict[str, str]:
    return {
        "spark.mongodb.connection.uri": uri,
        "spark.mongodb.database": database,
        "spark.mongodb.collection": collection,
        "operationType": "replace",
        "idFieldList": "_id",
        "upsertDocument": "true",
    }


def sink_debug(df: DataFrame, name: str | None = None, mode: str = "append") -> DataStreamWriter:
    """Show results untruncated on the console, or keep them in the memory table ``name``."""
    writer = df.writeStream.outputMode(mode)
    if name is None:
        return writer.format("console").option("truncate", "false")
    return writer.format("memory").queryName(name)


def read_lines_written(spark: SparkSession, path: str) -> DataFrame:
    """All lines written below ``path``."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, form: str = "json"
) -> DataFrame:
    """All documents written below ``path``, with the given columns and types (JSON holds times
    as text). Name ``batch_id`` in the schema to get it."""
    return spark.read.schema(schema).format(form).load(path).select(*schema.fieldNames())
