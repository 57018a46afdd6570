"""Valid and rejected lines of a stream from one reading of its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from platterwatch import schema
from platterwatch.operators.parse import is_valid, rejected_rows, valid_rows
from platterwatch.sources.storage import make_folder

VALID = "valid"


def route(parsed: DataFrame, path: str, rejects: str | None = None) -> DataStreamWriter:
    """Write every micro-batch of parsed lines as one table with a partition for the valid rows and one for
    the others, below ``path``; with ``rejects`` the latter also as JSON, with the reasons.

    A batch that runs again replaces its table. `routed_rows` reads the valid rows as a stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path.rstrip('/')}/{batch_id}"
        marked = batch.withColumn(VALID, is_valid())
        marked.write.mode("overwrite").partitionBy(VALID).parquet(folder)
        if rejects:
            written = spark.read.schema(marked.schema).parquet(folder).where(~F.col(VALID))
            target = f"{rejects.rstrip('/')}/batch_id={batch_id}"
            rejected_rows(written.drop(VALID)).write.mode("overwrite").json(target)

    make_folder(parsed.sparkSession, path)
    return parsed.writeStream.outputMode("append").foreachBatch(write)


def routed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The valid rows that `route` writes below a path, as a stream of typed rows in the order of its
    micro-batches."""
    fields = [*schema.TELEMETRY.fields, T.StructField("value", T.StringType())]
    rows = spark.readStream.schema(T.StructType(fields)).parquet(f"{path.rstrip('/')}/*/{VALID}=true")
    return valid_rows(rows)
