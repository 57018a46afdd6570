"""Texts as flat byte and word arrays, and the adaptor that runs such code on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 20  # texts are handled in runs of about this size, or singly if longer
SLICE_BYTES = 1 << 22  # as much text of an Arrow batch is turned into Python strings at a time

# [^\x20\x09-\x0D]+ : what the contracts call a word
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

# letters and digits; every byte of a non-ASCII character counts as a letter
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_BYTE_KEYS = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it (names ignore case in Spark)."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _powers[base] = np.cumprod(out)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def range_hashes(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every range."""
    n = len(data) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum(_BYTE_KEYS[data] * powers(_BASE, n - 1), out=sums[1:])
    return mix((sums[end] - sums[at]) * powers(_BASE_INVERSE, n)[at])


class Words:
    """Words of several texts: `at` (start byte), `end`, `first` (word number where each text
    begins, one more at the end), and on demand a 64-bit hash of every word."""

    def __init__(self, texts: list[bytes], letters: np.ndarray = SPACED):
        self.n_texts = len(texts)
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_at = np.concatenate([[0], np.cumsum(sizes + 1)])
        inside = letters[self.data]
        step = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.at, self.end = step[::2], step[1::2]
        self.first = np.searchsorted(self.at, self.text_at)
        self.count = np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.count)

    def hashes(self, at: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of every word, or of every given range of bytes."""
        at, end = (self.at, self.end) if at is None else (at, end)
        return range_hashes(self.data, at, end)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per word over each text."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def bytes_per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes with a flag each text has."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.text_at[1:]] - total[self.text_at[:-1]]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of every range, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total)


def encoded(texts: list[str | None]) -> list[bytes]:
    return [b"" if x is None else x.encode() for x in texts]


def runs(sizes: list[int], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to about `most`; nothing is left out."""
    begin = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(begin, k)
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def chunked(texts: list[str | None]) -> Iterator[list[bytes]]:
    for part in runs([len(x or "") for x in texts]):
        yield encoded(texts[part])


def arrow_type(kind: str) -> pa.DataType:
    return {
        "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(),
        "string": pa.string(), "binary": pa.binary(),
    }[kind]


def slices(batch: pa.RecordBatch, place: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batch in parts of about SLICE_BYTES of text, without copies, each with its texts. The number
    of rows in a batch says nothing about its size, so long texts would else stand in memory twice."""
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
    for part in runs(sizes, SLICE_BYTES):
        rows = batch.slice(part.start, part.stop - part.start)
        yield rows, rows.column(place).to_pylist()


def per_text(
    docs: DataFrame, columns: dict[str, str], work: Callable[[list[str | None]], list], *keep: str
) -> DataFrame:
    """The kept columns and those that work(texts) gives, one array for each name of `columns`.
    One pass over the column text, no shuffle. Columns other than these are not read."""
    kept = docs.select(*keep)
    (whole,) = fresh(kept, "text")
    base = docs.select(*keep, F.col("text").cast("string").alias(whole))
    names, kinds = list(columns), [arrow_type(k) for k in columns.values()]
    fields = base.schema.fields[:-1] + [
        T.StructField(n, T.DataType.fromDDL(k)) for n, k in columns.items()
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, batch.num_columns - 1):
                arrays = [rows.column(k) for k in range(batch.num_columns - 1)]
                arrays += [pa.array(x, kind) for x, kind in zip(work(texts), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], *names])

    return base.mapInArrow(run, T.StructType(fields))


def filter_texts(docs: DataFrame, good: Callable[[list[str | None]], np.ndarray]) -> DataFrame:
    """The rows whose text passes, with all their columns. One pass, no shuffle."""
    place = next(k for k, c in enumerate(docs.columns) if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, place):
                yield rows.filter(pa.array(good(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def expand_texts(
    docs: DataFrame, columns: dict[str, str], work: Callable[[list[bytes]], Iterator[tuple]]
) -> DataFrame:
    """doc_id and the columns, for every (number of the text, *values) that work(texts) gives. One
    pass over doc_id and text, no shuffle."""
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    names, kinds = ["doc_id", *columns], [pa.int64(), *map(arrow_type, columns.values())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, 1):
                ids, begin, found = rows.column(0).to_pylist(), 0, []
                for part in chunked(texts):
                    found += [(ids[begin + k], *values) for k, *values in work(part)]
                    begin += len(part)
                made = list(zip(*found)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(made, kinds)], names=names
                )

    schema = ", ".join(f"{k} {v}" for k, v in {"doc_id": "bigint", **columns}.items())
    return base.mapInArrow(run, schema)
