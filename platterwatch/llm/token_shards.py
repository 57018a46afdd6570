"""Token ids as raw binary shards with a minimal perfect hash index.

Documents are range-partitioned and sorted by doc_id, so shard after shard holds them in ascending
order. The number of shards comes from the bytes of all texts. Each task writes two files into the shared folder:

    <shard>-<attempt>.bin   the ids and nothing else, little endian, 2 bytes each if the
                            vocabulary allows, else 4
    <shard>-<attempt>.idx   a head, the perfect hash's bit tables with the ones before each word, by the hash's
                            number a slot (fingerprint of the key, row, begin and length of its ids), then
                            the keys and begins of all rows

and returns their names, which Spark commits as a small table `manifest`. A repeated task
writes files under other names, and only those of the task that counted are in the manifest,
so lost executors and repeated tasks change nothing. Files are opened through pyarrow's file systems, under
the address that Spark resolves on the driver, so the folder may be on any store that those reach.

`lookup` gets a document in a constant number of small reads, whatever the size of the shard: the head,
the words of the hash that the key meets, its slot, the stored key at its row (a foreign key fails the
fingerprint or the stored key), and the ids. The shard comes from the key ranges in the manifest.

`read_shards` reads every document back. The place of each named key's ids is taken from its slot; a key that
the index does not know is an error. Further rows of a repeated key, and null ids, which are not in the
index, have their place from the begins.

Defined cases: a null text is empty and holds the end id only. Null ids come first. Repeated ids are neighbours,
ordered by text, each with a row; the index leads to the first in each shard. Equal rows may go to several
shards. An empty table makes an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterwatch.llm.mphf import PerfectHash
from platterwatch.llm.texts import mix, ragged, range_hashes, runs, slices
from platterwatch.sources.storage import arrow_store, qualified, scratch_path

MAGIC = b"PWTOKEN2"
END_ID = 1
CACHED_PIECES = 1_500_000
CACHED_PARTS = 200_000
CHUNK = 1 << 20
SHARD_BYTES = 1 << 25  # of text in a shard
NO_KEY = -(1 << 63)

HEAD = np.dtype([
    ("magic", "S8"), ("width", "<u4"), ("levels", "<u4"), ("words", "<u8"), ("n_keys", "<u8"), ("n_docs", "<u8"),
])
SLOT = np.dtype([("mark", "<u2"), ("row", "<u8"), ("begin", "<u8"), ("size", "<u8")])

# What a byte is in a piece between blanks and line feeds (0). Pieces with a hard byte go whole: special
# tokens begin with <, and an apostrophe can begin a part of its own.
BLANK, LETTER, DIGIT, MARK, HARD = range(5)
KIND = np.full(256, HARD, np.uint8)
KIND[33:127] = MARK
KIND[[39, 60]] = HARD
KIND[48:58] = DIGIT
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[[10, 32]] = BLANK

# ASCII without < (special tokens begin with it), and Latin letters of the next two blocks; no space
PLAIN_PIECE = regex.compile(r"[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017e]+")

# Byte-level vocabularies write a printable Latin-1 byte as itself, the others from U+0100 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in SHOWN)}

MANIFEST = (
    "shard int, payload string, index string, n_docs bigint, n_tokens bigint, "
    "low bigint, high bigint"
)


def pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin and end of every piece, whether it is hard) of texts that end with a line feed each.

    White space separates tokens in this vocabulary. ASCII between blanks is cut further where the
    tokenizer's pattern cuts it: into runs of letters, single digits and runs of other marks, in lower case. What
    holds a hard byte stays as it is.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    kind = KIND[data]
    edge = np.flatnonzero(np.diff(kind != BLANK, prepend=False, append=False))
    at, end = edge[::2], edge[1::2]
    hard_before = np.concatenate([[0], np.cumsum(kind == HARD)])
    hard = hard_before[end] > hard_before[at]
    whole = np.zeros(len(data), bool)
    whole[ragged(at[hard], (end - at)[hard])] = True
    begins = np.zeros(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    begins &= ~whole & (kind != BLANK)
    begins[at] = True
    begin = np.flatnonzero(begins)
    owner = np.searchsorted(at, begin, "right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), end[owner])
    upper = (data >= 65) & (data <= 90) & ~whole
    return data + np.where(upper, np.uint8(32), np.uint8(0)), begin, stop, hard[owner]


class WordEncoder:
    """Ids of whole texts. A text's ids are those of its pieces, and each distinct piece is encoded once by the
    tokenizers library. Pieces are known by a 64-bit hash, so that those seen before cost no Python object.

    A piece of ASCII or plain Latin letters takes the library's steps apart: its normalizer for many
    pieces together, its split pattern, and its model for every part. Others go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"])
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.parts: dict[str, bytes] = {}
        self.now = 0
        self.keys = np.zeros(0, np.uint64)  # hashes of the known pieces, in order, and for each of them
        self.used = np.zeros(0, np.int64)  # when it was last used,
        self.begin = np.zeros(0, np.int64)  # and where its ids are
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def part(self, part: str) -> bytes:
        """The ids of a part between the split points, as 32-bit numbers."""
        ids = self.parts.get(part)
        if ids is None:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = self.parts[part] = self.model_ids(letters)
        return ids

    def model_ids(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def hard_ids(self, new: list[str]) -> list[bytes]:
        """The ids of pieces with hard bytes."""
        if len(self.parts) > CACHED_PARTS:
            self.parts.clear()
        rows, latin, other = [b""] * len(new), [], []
        for k, x in enumerate(new):
            if x.isascii() and x.isprintable() and "<" not in x:
                rows[k] = b"".join(map(self.part, self.split.findall(x.lower())))
            else:
                (latin if PLAIN_PIECE.fullmatch(x) else other).append(k)
        if latin:
            normal = self.tokenizer.normalizer.normalize_str(" ".join([new[k] for k in latin]))
            for k, x in zip(latin, normal.split(" "), strict=True):
                rows[k] = b"".join(map(self.part, self.split.findall(x)))
        found = self.tokenizer.encode_batch_fast([new[k] for k in other], add_special_tokens=False)
        for k, x in zip(other, found):
            rows[k] = array("I", x.ids).tobytes()
        return rows

    def learn(self, keys: np.ndarray, new: list[bytes], hard: np.ndarray) -> None:
        """Remember the ids of new pieces, whose hashes are in order."""
        rows: list[bytes] = [b""] * len(new)
        there = np.flatnonzero(hard).tolist()
        for k, ids in zip(there, self.hard_ids([new[k].decode() for k in there])):
            rows[k] = ids
        for k in np.flatnonzero(~hard).tolist():
            rows[k] = self.model_ids(new[k].decode())
        size = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        begin = len(self.ids) + np.cumsum(size) - size
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.used = np.insert(self.used, at, self.now)
        self.begin = np.insert(self.begin, at, begin)
        self.size = np.insert(self.size, at, size)
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(rows), np.uint32)])

    def forget(self) -> None:
        """Keep the half of the pieces that was used last."""
        kept = self.used > np.median(self.used)
        self.ids = self.ids[ragged(self.begin[kept], self.size[kept])]
        self.keys, self.used, self.size = self.keys[kept], self.used[kept], self.size[kept]
        self.begin = np.cumsum(self.size) - self.size

    def encode(self, texts: list[str | bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text), with the end id after each text."""
        raw = [x.encode() if isinstance(x, str) else x for x in texts]
        if len(self.keys) > CACHED_PIECES:
            self.forget()
        self.now += 1
        data, at, stop, hard = pieces(raw)
        distinct, first, code = np.unique(range_hashes(data, at, stop), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != distinct[inside]
        if new.any():
            where = first[new]
            whole = data.tobytes()
            found = [whole[a:b] for a, b in zip(at[where].tolist(), stop[where].tolist())]
            self.learn(distinct[new], found, hard[where])
            place = np.searchsorted(self.keys, distinct)
        self.used[place] = self.now
        size = self.size[place][code]
        flat = self.ids[ragged(self.begin[place][code], size)]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        counts = np.searchsorted(at, np.concatenate([[0], np.cumsum(lengths)]))
        edge = np.concatenate([[0], np.cumsum(size)])[counts]
        per_text = np.diff(edge) + 1
        out = np.full(len(flat) + len(texts), end, np.uint32)
        last = np.cumsum(per_text) - 1
        body = np.ones(len(out), bool)
        body[last] = False
        out[body] = flat
        return out, per_text


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(
        np.uint16
    )


def build_index(keys: np.ndarray, begins: np.ndarray, width: int) -> bytes:
    """The index of sorted keys, which may repeat and may begin with NO_KEY."""
    distinct, first = np.unique(keys, return_index=True)
    distinct, first = distinct[distinct != NO_KEY], first[distinct != NO_KEY]
    found = PerfectHash.build(distinct)
    slots = np.zeros(len(distinct), SLOT)
    number = found.find(distinct)
    slots["mark"][number], slots["row"][number] = fingerprints(distinct), first
    slots["begin"][number], slots["size"][number] = begins[first], np.diff(begins)[first]
    head = np.array(
        [(MAGIC, width, len(found.sizes), len(found.words), len(distinct), len(keys))], HEAD
    )
    tables = np.stack([found.words, found.before[:-1].astype(np.uint64)], axis=1)
    sections = [np.array(found.sizes, "<u8"), tables, slots, keys.astype("<i8"), begins.astype("<u8")]
    return b"".join(x.tobytes() for x in [head, *sections])


def count_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    return max(1, math.ceil((total or 0) / shard_bytes))


def write_shards(
    docs: DataFrame, folder: str, vocabulary: str, end: int = END_ID, shards: int | None = None
) -> None:
    """Write the shards and the manifest of all documents below a shared folder."""
    base = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    shards = shards or count_shards(base)
    # equal rows differ in the last column, so that they spread over several shards
    tie = [F.xxhash64(F.coalesce("text", F.lit(""))), F.monotonically_increasing_id()]
    tied = base.select("*", tie[0].alias("tie"), tie[1].alias("at"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "at"]
    ordered = tied.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    target = qualified(docs.sparkSession, folder)

    def run(batches):
        store, path = arrow_store(target)
        tokens, shard = encoder(vocabulary), TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        out, keys, sizes = None, [], []
        for batch in batches:
            batch = batch.set_column(1, "text", batch.column(1).cast(pa.binary()))
            for rows, texts in slices(batch, 1):
                raw = [x or b"" for x in texts]
                for part in runs([len(x) for x in raw], CHUNK):
                    if out is None:
                        store.create_dir(path, recursive=True)
                        out = store.open_output_stream(f"{path}/{name}.part")
                    ids, size = tokens.encode(raw[part], end)
                    out.write(ids.astype(f"<u{tokens.width}").tobytes())
                    sizes.append(size)
                keys += [rows.column(0).fill_null(NO_KEY).to_numpy()]
        if out is None:
            return
        out.close()
        keys, sizes = np.concatenate(keys), np.concatenate(sizes)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        with store.open_output_stream(f"{path}/{name}.idx") as index:
            index.write(build_index(keys, begins, tokens.width))
        store.move(f"{path}/{name}.part", f"{path}/{name}.bin")
        row = [shard, f"{name}.bin", f"{name}.idx", len(keys), int(begins[-1]), int(keys[0]), int(keys[-1])]
        kinds = [pa.int32(), pa.string(), pa.string()] + [pa.int64()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in zip(row, kinds)],
            names="shard payload index n_docs n_tokens low high".split(),
        )

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")


class Shard:
    """One shard's files, opened for reading. Nothing is read but what is asked for."""

    def __init__(self, folder: str, payload: str, index: str):
        self.store, path = arrow_store(folder)
        self.file = self.store.open_input_file(f"{path}/{payload}")
        self.index = self.store.open_input_file(f"{path}/{index}")
        self.head = self.read(0, 1, HEAD)[0]
        if self.head["magic"] != MAGIC:
            raise ValueError(f"{index} is not an index of token shards")
        self.width = int(self.head["width"])
        self.tables = HEAD.itemsize + 8 * int(self.head["levels"])
        self.slots = self.tables + 16 * int(self.head["words"])
        self.keys = self.slots + SLOT.itemsize * int(self.head["n_keys"])
        self.begins = self.keys + 8 * int(self.head["n_docs"])
        self.sizes = self.read(HEAD.itemsize, int(self.head["levels"]), "<u8").tolist()

    def read(self, at: int, n: int, kind) -> np.ndarray:
        kind = np.dtype(kind)
        return np.frombuffer(self.index.read_at(n * kind.itemsize, at), kind)

    def word_at(self, place: int) -> tuple[int, int]:
        table, before = self.read(self.tables + 16 * place, 2, "<u8").tolist()
        return table, before

    def find(self, key: int) -> np.ndarray | None:
        """The ids of the first document with a key, by a few small reads; None if there is none."""
        number = PerfectHash.find_one(self.sizes, key, self.word_at)
        if number < 0:
            return None
        slot = self.read(self.slots + SLOT.itemsize * number, 1, SLOT)[0]
        if slot["mark"] != fingerprints(np.array([key], np.int64))[0]:
            return None
        if self.read(self.keys + 8 * int(slot["row"]), 1, "<i8")[0] != key:
            return None
        return self.ids(int(slot["begin"]), int(slot["begin"] + slot["size"]))

    def whole_index(self) -> tuple[PerfectHash, np.ndarray]:
        """The hash and all slots, for looking up many keys."""
        words = self.read(self.tables, 2 * int(self.head["words"]), "<u8").reshape(-1, 2)[:, 0]
        slots = self.read(self.slots, int(self.head["n_keys"]), SLOT)
        return PerfectHash(self.sizes, np.ascontiguousarray(words)), slots

    def ids(self, begin: int, end: int) -> np.ndarray:
        data = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


def slots_of(found: PerfectHash, slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The slots of known keys. A key without one, or whose slot belongs to another key, is an error."""
    number = found.find(keys)
    mine = slots[np.maximum(number, 0)] if len(slots) else np.zeros(len(keys), SLOT)
    if (number < 0).any() or (mine["mark"] != fingerprints(keys)).any():
        raise ValueError("the index does not lead to a key of its shard")
    return mine


def manifest(spark: SparkSession, folder: str, key: int | None = None) -> list:
    """One small row per shard, or per shard whose range holds a key, in order."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    if key is not None:
        rows = rows.where((F.col("low") <= key) & (F.col("high") >= key))
    return rows.orderBy("shard").collect()


def lookup(spark: SparkSession, folder: str, key: int) -> list[np.ndarray]:
    """The ids of the first document with a key, of each shard that holds the key."""
    target, found = qualified(spark, folder), []
    for row in manifest(spark, folder, key):
        ids = Shard(target, row["payload"], row["index"]).find(key)
        found += [] if ids is None else [ids]
    return found


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, in_index boolean"


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files, with its global start, number of ids and checksum; in_index tells
    whether its place came from the index."""
    base, rows = 0, []
    for r in manifest(spark, folder):
        rows.append((r["payload"], r["index"], base))
        base += r["n_tokens"]
    shards = spark.createDataFrame(rows, "payload string, index string, base bigint")
    shards = shards.repartition(max(1, len(rows)))
    target = qualified(spark, folder)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(target, row["payload"], row["index"])
                found, slots = shard.whole_index()
                for begin in range(0, int(shard.head["n_docs"]), 10_000):
                    yield read_rows(shard, found, slots, row["base"], begin, begin + 10_000)

    return shards.mapInArrow(run, READ)


def read_rows(
    shard: Shard, found: PerfectHash, slots: np.ndarray, base: int, low: int, high: int
) -> pa.RecordBatch:
    """The documents of the rows low .. high - 1 of a shard."""
    high = min(high, int(shard.head["n_docs"]))
    before = low and 1  # the key before these rows tells whether the first of them is a repeated one
    keys = shard.read(shard.keys + 8 * (low - before), high - low + before, "<i8")
    named = keys[before:] != NO_KEY
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    first, keys = first[before:] & named, keys[before:]
    begins = shard.read(shard.begins + 8 * low, high - low + 1, "<u8").astype(np.int64)
    begin, size = begins[:-1].copy(), np.diff(begins)
    mine = slots_of(found, slots, keys[first])
    begin[first], size[first] = mine["begin"], mine["size"]
    sums = []
    for part in runs(size.tolist(), CHUNK):
        at, n = begin[part], size[part]
        lowest = int(at.min())
        ids = shard.ids(lowest, int((at + n).max())).view(np.uint8)
        edge = zip(4 * (at - lowest), 4 * (at + n - lowest))
        sums += [zlib.crc32(ids[a:b]) for a, b in edge]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, mask=~named), pa.array(base + begin), pa.array(size),
            pa.array(sums, pa.int64()), pa.array(first),
        ],
        names="doc_id start n_tokens ids_crc32 in_index".split(),
    )


def round_trip(docs: DataFrame, vocabulary: str, shards: int | None = None) -> DataFrame:
    """Write the documents to fresh shards in the shared folder and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-shards")
    write_shards(docs, folder, vocabulary, shards=shards)
    return read_shards(spark, folder)
