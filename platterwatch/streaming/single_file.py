"""Results in one growing file, each micro-batch once.

Tasks write pieces beside the file, under names of their own. The commit of a micro-batch, on the driver,
appends its pieces to the file in the order of the partitions and then notes the file's length under the number of the
micro-batch. A micro-batch that has such a note is not appended again, whatever is run again; bytes after
the last noted length come from a commit that broke off, and the next one replaces them. Pieces of failed tasks
are removed with the next commit.

One file goes through one process, so this form is for results that people read. Large results
belong into folders, see `platterwatch.streaming.sinks`. The store has to be able to append.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from platterwatch.sources.storage import arrow_store, qualified

FORMAT = "platterwatch_file"
CHUNK = 1 << 20


class SingleFile(DataSource):
    """Options: ``path`` of the file; for a batch also ``epoch``, the number that it is committed under."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "line string"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return StreamPieces(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return BatchPieces(self.options["path"], int(self.options["epoch"]))


@dataclass
class Piece(WriterCommitMessage):
    partition: int
    name: str


class Pieces:
    def __init__(self, path: str):
        self.path, self.side = path, f"{path}.commits"

    def write(self, rows: Iterator[Row]) -> Piece:
        store, side = arrow_store(self.side)
        store.create_dir(f"{side}/pieces", recursive=True)
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{side}/pieces/{name}") as file:
            for row in rows:
                file.write((row[0] or "").encode() + b"\n")
        return Piece(TaskContext.get().partitionId(), name)

    def publish(self, messages: list[Piece | None], epoch: int) -> None:
        store, side = arrow_store(self.side)
        _, path = arrow_store(self.path)
        store.create_dir(f"{side}/pieces", recursive=True)
        ends = self._ends(store, side)
        if epoch not in ends:
            start = max(ends.values(), default=0)
            self._cut(store, path, start)
            with store.open_append_stream(path) as file:
                for piece in sorted(filter(None, messages), key=lambda m: m.partition):
                    start += _copy(store, f"{side}/pieces/{piece.name}", file)
            self._note(store, f"{side}/{epoch}", start)
        store.delete_dir_contents(f"{side}/pieces")

    def drop(self, messages: list[Piece | None]) -> None:
        store, side = arrow_store(self.side)
        for piece in filter(None, messages):
            store.delete_file(f"{side}/pieces/{piece.name}")

    def _ends(self, store, side: str) -> dict[int, int]:
        """The file's length after each committed micro-batch."""
        from pyarrow import fs

        found = {}
        for entry in store.get_file_info(fs.FileSelector(side)):
            if entry.base_name.isdigit():
                with store.open_input_stream(entry.path) as file:
                    found[int(entry.base_name)] = json.loads(file.read())
        return found

    def _note(self, store, path: str, end: int) -> None:
        with store.open_output_stream(f"{path}.new") as file:
            file.write(json.dumps(end).encode())
        store.move(f"{path}.new", path)

    def _cut(self, store, path: str, length: int) -> None:
        """Leave the committed bytes only."""
        from pyarrow import fs

        info = store.get_file_info(path)
        if info.type == fs.FileType.File and info.size != length:
            with store.open_output_stream(f"{path}.new") as file:
                _copy(store, path, file, length)
            store.move(f"{path}.new", path)


def _copy(store, path: str, target, length: int | None = None) -> int:
    done = 0
    with store.open_input_stream(path, compression=None) as file:
        while data := file.read(CHUNK if length is None else min(CHUNK, length - done)):
            target.write(data)
            done += len(data)
    return done


class StreamPieces(Pieces, DataSourceStreamWriter):
    def commit(self, messages: list[Piece | None], batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages: list[Piece | None], batchId: int) -> None:
        self.drop(messages)


class BatchPieces(Pieces, DataSourceWriter):
    def __init__(self, path: str, epoch: int):
        super().__init__(path)
        self.epoch = epoch

    def commit(self, messages: list[Piece | None]) -> None:
        self.publish(messages, self.epoch)

    def abort(self, messages: list[Piece | None]) -> None:
        self.drop(messages)


def append_once(lines: DataFrame, path: str, epoch: int) -> None:
    """Add the column ``line`` of a batch to the file, unless the epoch has been added before."""
    spark = lines.sparkSession
    spark.dataSource.register(SingleFile)
    out = lines.select("line").write.format(FORMAT).mode("append")
    out.option("path", qualified(spark, path)).option("epoch", str(epoch)).save()


def sink_file(lines: DataFrame, path: str) -> DataStreamWriter:
    """A stream's column ``line`` into one file, each micro-batch once."""
    spark: SparkSession = lines.sparkSession
    spark.dataSource.register(SingleFile)
    out = lines.select("line").writeStream.format(FORMAT).outputMode("append")
    return out.option("path", qualified(spark, path))
