"""Benchmark decontamination with spaced seeds.

A seed is a mask over consecutive words: 1 is compared, 0 is ignored. Hashes of all masked word
groups of the benchmark are joined with those of all documents; each hit fixes a diagonal (place in
the document minus place in the item), along which words are compared one by one. An item counts
as found if a stretch of the diagonal with at least OVERLAP words, or the whole item if that is
shorter, has at least SIMILARITY equal words; so replaced words do not hide an item.

Items of LONG words or more are hit by MASKS anywhere. Shorter ones have masks of their own length, which
together ignore every set of words that may differ, so that no allowed placement is missed.

Words are runs of letters and digits in lower case. Each distinct sequence of words is searched once, and every
item_id that has it is reported, whatever the size of the benchmark. Sequences are searched in blocks of
BLOCK_WORDS words at most, so what is broadcast at a time has a fixed bound: each block makes one pass over
the documents, without a shuffle, and where there are several, a pass is written and its block
released before the next begins.

Defined cases: a null text has no words. Items of fewer than SHORTEST words are not searched, as they would
meet nearly every document. A document that holds an item several times has one row, with its longest
stretch. Repeated documents have a row each, repeated items one together. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterwatch.llm.texts import (
    PLAIN,
    Words,
    chunked,
    encoded,
    expand_texts,
    filter_texts,
    mix,
    per_text,
    ragged,
)
from platterwatch.sources.storage import stage

MASKS = ("111011", "1101101", "110010101")
LONG = 12
OVERLAP = 13
SIMILARITY = 0.8
SHORTEST = 3
BLOCK_WORDS = 1_000_000
SLOTS = 1 << 22


def masked(hashes: np.ndarray, mask: str) -> np.ndarray:
    """A key for every place where the mask fits into the array."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(n, sum(1 << k for k, c in enumerate(mask) if c == "1") * 2 + 1, np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix(key)


def short_masks(n: int) -> list[str]:
    """Masks of n words that ignore, between them, every set of words that may differ."""
    differ = n - math.ceil(SIMILARITY * n - 1e-9)
    if not differ:
        return ["1" * n]
    parts = -(-n // 2) if differ == 1 else 2 * differ
    part = [k * parts // n for k in range(n)]
    return [
        "".join("0" if p in left_out else "1" for p in part) for left_out in combinations(range(parts), differ)
    ]


class Block:
    """Seeds of some items. Flat word hashes of all items, and sorted keys with their places."""

    def __init__(self, ids: list[int], words: list[np.ndarray]):
        self.ids = ids
        sizes = np.array([len(x) for x in words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.words = np.concatenate([np.zeros(0, np.uint64), *words])
        item_of = np.repeat(np.arange(len(words)), sizes)
        short = {mask: n for n in set(sizes.tolist()) if n < LONG for mask in short_masks(n)}
        self.masks = [*(MASKS if (sizes >= LONG).any() else ()), *sorted(short)]
        keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for mask in self.masks:
            found = masked(self.words, mask)
            at = np.arange(len(found))
            good = item_of[at] == item_of[at + len(mask) - 1] if len(found) else at.astype(bool)
            size = sizes[item_of[at]]
            good &= size == len(mask) if mask in short else size >= LONG
            keys.append(found[good])
            places.append(at[good])
        keys, places = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order]
        self.item_of = item_of
        self.slots = np.zeros(SLOTS, bool)
        self.slots[(self.keys & np.uint64(SLOTS - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
        """Distinct (text, item, diagonal) rows that any mask points to."""
        found = []
        for mask in self.masks:
            key = masked(hashes, mask)
            at = np.flatnonzero(self.slots[(key & np.uint64(SLOTS - 1)).astype(np.int64)])
            at = at[text_of[at] == text_of[at + len(mask) - 1]]
            low = np.searchsorted(self.keys, key[at], "left")
            n = np.searchsorted(self.keys, key[at], "right") - low
            at, low, n = at[n > 0], low[n > 0], n[n > 0]
            for begin in range(0, len(at), 50_000):  # a bounded number of places at a time
                part = slice(begin, begin + 50_000)
                place = self.places[ragged(low[part], n[part])]
                at_each = np.repeat(at[part], n[part])
                rows = np.stack([text_of[at_each], self.item_of[place], at_each - place], axis=1)
                found.append(np.unique(rows, axis=0))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def overlaps(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, equal words) of each item found in a text."""
        words = Words([x.decode().lower().encode() for x in texts], PLAIN)
        hashes, best = words.hashes(), {}
        hits = self.hits(hashes, words.text_of)
        for begin in range(0, len(hits), 20_000):
            text, item, diagonal = hits[begin : begin + 20_000].T
            size = self.first[item + 1] - self.first[item]
            low = np.maximum(self.first[item], words.first[text] - diagonal)
            high = np.minimum(self.first[item + 1], words.first[text + 1] - diagonal)
            n = high - low
            place = ragged(low, n)
            equal = self.words[place] == hashes[place + np.repeat(diagonal, n)]
            edge = np.concatenate([[0], np.cumsum(n)])
            total = np.concatenate([[0], np.cumsum(equal)])
            least = np.minimum(size, OVERLAP)
            enough = total[edge[1:]] - total[edge[:-1]] >= SIMILARITY * least
            for k in np.flatnonzero(enough):
                at, length, same = longest_stretch(equal[edge[k] : edge[k + 1]])
                if length >= least[k]:
                    row = (length, same, -int(low[k] + diagonal[k] - words.first[text[k]] + at))
                    key = (int(text[k]), int(item[k]))
                    best[key] = max(best.get(key, row), row)
        for (text, item), (length, same, at) in sorted(best.items()):
            yield text, item, -at, length, same


def longest_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(begin, length, equal) of the longest part with at least SIMILARITY of equal places, the
    first of several. Ends that differ are cut off where the part stays long enough."""
    if not len(equal):
        return 0, 0, 0
    share = round(SIMILARITY * 100)
    total = np.concatenate([[0], np.cumsum(np.where(equal, 100 - share, -share))])
    lowest = np.minimum.accumulate(total)
    begin = np.searchsorted(-lowest, -total, "left")
    length = np.arange(len(total)) - begin
    end = int(np.argmax(length))
    return int(begin[end]), int(length[end]), int(equal[begin[end] : end].sum())


def sequences(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, key) of the items that are searched: the hashes of their words, and of the whole."""

    def work(texts):
        found = [Words([x.decode().lower().encode()], PLAIN).hashes() for x in encoded(texts)]
        return [[x.tobytes() if len(x) >= SHORTEST else None for x in found]]

    items = per_text(benchmark, {"words": "binary"}, work, "item_id").where("words is not null")
    return items.select(F.col("item_id").cast("bigint"), "words", F.xxhash64("words").alias("key"))


def blocks(items: DataFrame, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """The distinct sequences in blocks of a bounded number of words, fetched partition by partition."""
    keys, words, total = [], [], 0
    for row in items.groupBy("key").agg(F.min("words").alias("words")).orderBy("key").toLocalIterator():
        found = np.frombuffer(bytes(row["words"]), np.uint64)
        if keys and total + len(found) > most:
            yield Block(keys, words)
            keys, words, total = [], [], 0
        keys.append(row["key"])
        words.append(found)
        total += len(found)
    if keys:
        yield Block(keys, words)


def broadcasts(spark: SparkSession, items: DataFrame, most: int) -> Iterator[Broadcast]:
    return (spark.sparkContext.broadcast(block) for block in blocks(items, most))


def written(shared: Broadcast, rows: DataFrame) -> tuple[None, DataFrame]:
    """The rows as a table, after which the block that they came from is released."""
    rows = stage(rows, "pass")
    shared.destroy()
    return None, rows


FOUND = {"key": "bigint", "first_word": "bigint", "n_words": "bigint", "n_equal": "bigint", "similarity": "double"}


def contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, most: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal, similarity of every item found."""
    items = stage(sequences(benchmark), "benchmark")
    found = []
    for shared in broadcasts(spark, items, most):

        def work(texts, shared=shared):
            for text, item, at, n, same in shared.value.overlaps(texts):
                yield text, shared.value.ids[item], at, n, same, same / n

        found.append((shared, expand_texts(docs, FOUND, work)))
        if len(found) > 1:
            found[-2] = written(*found[-2])
    schema = ", ".join(f"{k} {v}" for k, v in {"doc_id": "bigint", **FOUND}.items())
    result = spark.createDataFrame([], schema)
    for _, rows in found:
        result = result.unionAll(rows)
    ids = items.select("key", "item_id").distinct()
    return result.join(ids, "key").select("doc_id", "item_id", *[c for c in FOUND if c != "key"])


def clean(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, most: int = BLOCK_WORDS
) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    items, before = stage(sequences(benchmark), "benchmark"), None
    for shared in broadcasts(spark, items, most):
        if before:
            _, docs = written(before, docs)

        def good(texts, shared=shared):
            flags, begin = np.ones(len(texts), bool), 0
            for part in chunked(texts):
                for text, *_ in shared.value.overlaps(part):
                    flags[begin + text] = False
                begin += len(part)
            return flags

        docs, before = filter_texts(docs, good), shared
    return docs
