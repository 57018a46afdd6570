"""Where telemetry lines come from: Kafka topics, text files and CSV datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platterwatch import schema
from platterwatch.operators.parse import not_header
from platterwatch.sources.replay import read_replay_stream


def read_lines_stream(
    spark: SparkSession,
    kind: str = "files",
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    max_files: int | None = None,
    max_offsets: int | None = None,
    starting: str = "earliest",
    options: dict[str, str] | None = None,
    offered: str | None = None,
) -> DataFrame:
    """A stream of lines in ``value``; from Kafka also the record's ``timestamp``.

    ``kind`` is ``files`` (in the order of their times), ``replay`` (what `write_replay` made, in the order of
    its manifest) or ``kafka``. ``max_files`` and ``max_offsets`` bound a micro-batch; a bounded replay needs
    ``offered``, see `read_replay_stream`. Kafka needs its connector on the class
    path; ``options`` are more of its settings, such as ``kafka.group.id`` or those for security.
    """
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .options(**(options or {}))
        )
        if max_offsets:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")
    if kind == "replay":
        return read_replay_stream(spark, path, max_files, offered)
    if kind != "files":
        raise ValueError(f"unknown source kind: {kind}")
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as a batch, without header rows."""
    return spark.read.text(path).filter(not_header())


def dataset_schema() -> T.StructType:
    """The columns of a CSV dataset by position; columns no query reads are ``field_i``."""
    names = {i: name for name, i in schema.POSITIONS.items()}
    return T.StructType(
        [
            T.StructField(names.get(i, f"field_{i}"), T.StringType())
            for i in range(schema.LINE_FIELDS)
        ]
    )


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A CSV dataset with a header row, columns by position, all as text.

    The schema is given, so there is no inference pass and only used columns are converted. It ends
    with the last field of a telemetry line; ``read_dataset_lines`` keeps further ones.
    """
    return (
        spark.read.schema(dataset_schema())
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def dataset_lines(dataset: DataFrame) -> DataFrame:
    """Dataset rows as wire lines in ``value``."""
    fields = [F.coalesce(F.col(c), F.lit("")) for c in dataset.columns]
    return dataset.select(F.concat_ws(",", *fields).alias("value"))


# a field after its comma: quoted, with quotes inside doubled, or plain
FIELD = r',(?:"(?:[^"]|"")*"(?=,|$)|[^,]*)'


def read_dataset_lines(spark: SparkSession, path: str) -> DataFrame:
    """A CSV dataset as wire lines in ``value``: every field of every row, without CSV quotes, and
    without header rows. ``file``, ``block`` and ``place`` give the order of the files' lines.

    A quoted field may hold commas, which a wire line cannot tell from separators, but no line breaks.
    """
    plain = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), F.col("value")), F.lit(FIELD), F.lit(0)),
        lambda x: F.when(
            x.startswith(',"') & x.endswith('"') & (F.length(x) > 2),
            F.replace(F.substr(x, F.lit(3), F.length(x) - 3), F.lit('""'), F.lit('"')),
        ).otherwise(F.substr(x, F.lit(2))),
    )
    line = F.when(F.contains(F.col("value"), F.lit('"')), F.array_join(plain, ",")).otherwise(F.col("value"))
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(
            line.alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
        .filter(not_header())
    )


FILE_ORDER = ("file", "block", "place")
