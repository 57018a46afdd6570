"""A replay as a stream source whose micro-batches follow a manifest.

`write_replay` puts files below a folder and names them in ``_manifest/<delivery>``, a small table per
delivery. The source takes files in the order (delivery, day, part), whatever their times on
disk, a bounded number at a time. Its offset is the number of files taken, so a stream that stops goes on with the
next file, and deliveries can be added while it runs or rests.

Spark asks a source written in Python for its newest offset without saying where the stream stands. What
was offered last is therefore kept in a file, written before the offset is given out: offers never go back, and
after a crash between the two the next micro-batch is larger by one step. Keep that file with
the stream's checkpoint, so that both are removed together.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from platterwatch.sources.storage import arrow_store, exists, qualified

FORMAT = "platterwatch_replay"
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "day string, part int, file string, bytes bigint"
CHUNK = 1 << 22  # bytes of text read at a time


class ReplaySource(DataSource):
    """Options: ``path``, ``files`` (per micro-batch) and ``offered`` (the file that keeps the last offer)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ReplayReader(dict(self.options), schema)


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.step = int(options.get("files") or 0)
        self.kept = options.get("offered")
        self.deliveries: list[str] = []
        self.files: list[str] = []
        if self.step and not self.kept:
            raise ValueError("a bounded replay needs a file that keeps the last offer")

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        self._look()
        if not self.step:
            return {"files": len(self.files)}
        offered = self._offered()
        newest = max(offered, min(offered + self.step, len(self.files)))
        if newest != offered:
            store, path = arrow_store(self.kept)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(f"{path}.new") as file:
                file.write(json.dumps(newest).encode())
            store.move(f"{path}.new", path)
        return {"files": newest}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if len(self.files) < end["files"]:
            self._look()
        return [InputPartition(name) for name in self.files[start["files"] : end["files"]]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, path = arrow_store(partition.value)
        if path.endswith(".parquet"):
            yield from self._rows(store, path)
        else:
            yield from self._lines(store, path)

    def _offered(self) -> int:
        from pyarrow import fs

        store, path = arrow_store(self.kept)
        if store.get_file_info(path).type != fs.FileType.File:
            return 0
        with store.open_input_stream(path) as file:
            return json.loads(file.read())

    def _look(self) -> None:
        """Take up deliveries that are complete, in order."""
        from pyarrow import fs

        store, path = arrow_store(f"{self.path}/{MANIFEST}")
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        for name in sorted(x.path for x in found if x.type == fs.FileType.Directory):
            done = store.get_file_info(f"{name}/_SUCCESS").type == fs.FileType.File
            if name in self.deliveries:
                continue
            if not done:
                return  # a later one must not overtake it
            parts = [x.path for x in store.get_file_info(fs.FileSelector(name)) if x.path.endswith(".parquet")]
            rows = [pq.read_table(x, filesystem=store, partitioning=None) for x in parts]
            table = pa.concat_tables(rows).sort_by([("day", "ascending"), ("part", "ascending")])
            self.deliveries.append(name)
            self.files += table["file"].to_pylist()

    def _lines(self, store, path: str) -> Iterator[pa.RecordBatch]:
        with store.open_input_stream(path) as file:
            rest = b""
            while chunk := file.read(CHUNK):
                *lines, rest = (rest + chunk).split(b"\n")
                yield self._batch(lines)
            if rest:
                yield self._batch([rest])

    def _batch(self, lines: list[bytes]) -> pa.RecordBatch:
        texts = pa.array([x.removesuffix(b"\r") for x in lines], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([texts], names=["value"])

    def _rows(self, store, path: str) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        with store.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=wanted.names):
                yield batch.select(wanted.names).cast(wanted)


def is_replay(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MANIFEST}")


def read_replay_stream(
    spark: SparkSession,
    path: str,
    files: int | None = None,
    offered: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A replay as a stream of lines in ``value``, or with the given schema of Parquet rows. ``files`` bounds
    a micro-batch and needs ``offered``, a path beside the stream's checkpoint.

    Spark's trigger for what is available takes one micro-batch of this source and closes no window after
    it; use ``drain`` of `run_streams` to go on to the end.
    """
    spark.dataSource.register(ReplaySource)
    reader = spark.readStream.format(FORMAT).option("path", qualified(spark, path.rstrip("/")))
    if files:
        reader = reader.option("files", str(files)).option("offered", qualified(spark, offered))
    return (reader.schema(schema) if schema else reader).load()
