"""Ranked lexical search, best first over intervals of documents.

One pass over the documents gives each one's number of terms and, for terms that the queries may hold, how
often they occur; the latter are picked by a bitmap of fixed size, which the queries' terms set and which
may let other terms through but never loses one. From that table come the corpus statistics. Documents are then
dealt into shards of a bounded number of postings, and queries into blocks of a bounded number of terms;
each pair of a shard and a block is searched by itself, in a task that holds both.

In a search documents are numbered by length and id. A term's posting list holds the impacts of its
documents in that order, with a sparse table over it that gives the place of the largest impact of any
interval from two entries. The sum of a query's largest impacts in an interval of documents bounds every score in it.
Intervals are taken best first, a growing number at a time: each is split at the document of its single
largest impact, which is scored exactly, and the two rests get bounds of their own. The search ends when no interval can
hold a document better than the last of the best, ties counted.

Every search gives at most TOP documents per query, and the best of these by rank are the result.

Defined cases: a null text, or one without terms, is no document, and a query without terms has no result.
Rows with equal ids are documents, or queries, of their own. Null doc_ids come last among equal scores.
Terms are told apart by a 64-bit hash. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterwatch.llm.texts import PLAIN, Words, chunked, slices
from platterwatch.sources.storage import stage

TOP = 20
SLOTS = 1 << 23  # bits of the bitmap
SHARD_POSTINGS = 1_000_000
BLOCK_TERMS = 200_000
LEAST_SHARDS = 8
MOST_TASKS = 50_000  # of a shuffle; beyond it a task takes several pairs, one after the other
STEP = 256  # most intervals split at a time
NO_ID = (1 << 63) - 1

COUNTED = "id bigint, n bigint, terms binary, times binary"
FOUND = "item bigint, item_id bigint, doc_id bigint, score bigint"


def slot_of(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(41)).astype(np.int64)  # the highest 23 bits


def count_terms(texts: list[bytes], seen: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(terms per text, where each text's entries begin, distinct terms, how often) of lower-cased texts.
    Only terms whose bit is set in `seen` have entries."""
    words = Words(texts, PLAIN)
    terms, owner = words.hashes(), words.text_of
    if seen is not None:
        slot = slot_of(terms)
        known = (seen[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
        terms, owner = terms[known], owner[known]
    order = np.lexsort((terms, owner))
    terms, owner = terms[order], owner[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    begin = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    return words.count, begin, terms[first], np.diff(np.append(first, len(terms)))


def cells(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Runs of numbers as binary cells."""
    offsets = pa.py_buffer((begin * values.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def numbers(column: pa.ChunkedArray | pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of binary cells, how many each cell has)."""
    parts = [x.to_pylist() for x in getattr(column, "chunks", [column])]
    data = [x for part in parts for x in part]
    flat = np.frombuffer(b"".join(data), kind)
    return flat, np.fromiter(map(len, data), np.int64, len(data)) // np.dtype(kind).itemsize


def counted(rows: DataFrame, key: str, seen: np.ndarray | None = None) -> DataFrame:
    """id, n, terms, times of every row whose text has a term."""
    base = rows.select(F.col(key).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, 1):
                at = 0
                for data in chunked(texts):
                    n, begin, terms, times = count_terms([x.lower() for x in data], seen)
                    out = pa.RecordBatch.from_arrays(
                        [
                            part.column(0).slice(at, len(data)), pa.array(n, pa.int64()),
                            cells(terms, begin), cells(times.astype(np.uint32), begin),
                        ],
                        names="id n terms times".split(),
                    )
                    at += len(data)
                    yield out.filter(pa.array(n > 0))

    return base.mapInArrow(run, COUNTED)


def term_rows(table: DataFrame, key: str | None) -> DataFrame:
    """(key, term, times) of every entry of a table of counted texts; without a key (term, df), the
    documents with each term, added up within a batch."""

    def run(batches):
        for batch in batches:
            terms, size = numbers(batch.column(0), np.int64)
            if key:
                times, _ = numbers(batch.column(1), np.uint32)
                ids = np.repeat(batch.column(2).to_numpy(), size)
                values = [ids, terms, times.astype(np.int64)]
            else:
                values = np.unique(terms, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in values], names=names)

    names = [key, "term", "times"] if key else ["term", "df"]
    kept = table.select("terms", "times", key) if key else table.select("terms")
    return kept.mapInArrow(run, ", ".join(f"{x} bigint" for x in names))


def bitmap(terms: DataFrame) -> np.ndarray:
    """The bitmap that the column term sets: at most SLOTS / 64 rows reach the driver."""
    slot = F.shiftrightunsigned(F.col("term"), 41)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))
    words = terms.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(SLOTS // 64, np.int64)
    for row in words.collect():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


class Largest:
    """A sparse table: the place of the largest value of any interval of an array, in two looks."""

    def __init__(self, values: np.ndarray, longest: int):
        n = len(values)
        self.values = values
        self.places = np.zeros((max(1, int(longest).bit_length()), n), np.int32)
        self.places[0] = np.arange(n)
        for k in range(1, len(self.places)):
            half = 1 << (k - 1)
            a, b = self.places[k - 1, : n - half], self.places[k - 1, half:]
            self.places[k, : n - half] = np.where(values[a] >= values[b], a, b)

    def place(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of intervals begin <= i < end, none of them empty."""
        level = np.frexp((end - begin).astype(np.float64))[1] - 1
        a, b = self.places[level, begin], self.places[level, end - (1 << level)]
        return np.where(self.values[a] >= self.values[b], a, b)


class Shard:
    """Posting lists of the documents of a shard, for the terms of a block of queries."""

    def __init__(self, docs: pa.Table, vocabulary: np.ndarray, n_docs: int, n_terms: int):
        ids = docs["id"].fill_null(NO_ID).to_numpy()
        order = np.lexsort((ids, docs["n"].to_numpy()))
        docs = docs.take(pa.array(order))
        self.ids, length = ids[order], docs["n"].to_numpy()
        share = 100 - 25 + (25 * length * n_docs) // max(1, n_terms)
        terms, size = numbers(docs["terms"], np.int64)
        times = numbers(docs["times"], np.uint32)[0].astype(np.int64)
        owner = np.repeat(np.arange(len(size)), size)
        term = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
        known = np.flatnonzero(vocabulary[term] == terms)
        known = known[np.argsort(term[known], kind="stable")]
        times, self.doc, term = times[known], owner[known], term[known]
        self.impact = (1_000_000_000 * times) // (1000 * times + 12 * share[self.doc])
        self.n = len(size)
        self.keys = term * self.n + self.doc  # in order: lists by term, documents in each
        self.begin = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        self.largest = Largest(self.impact, np.diff(self.begin).max(initial=0))
        self.first_id = Largest(-self.ids, self.n)

    def bounds(self, weight: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """(bound, document of the largest impact) of intervals, whose places in each list are given."""
        i, t = np.nonzero(end > begin)
        place = self.largest.place(begin[i, t], end[i, t])
        value = np.zeros(begin.shape, np.int64)
        value[i, t] = weight[t] * self.impact[place]
        doc = np.zeros(begin.shape, np.int64)
        doc[i, t] = self.doc[place]
        return value.sum(1), doc[np.arange(len(doc)), value.argmax(1)]

    def search(self, terms: np.ndarray, weight: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the best, from the query's distinct terms and their weights."""
        there = (self.begin[terms + 1] > self.begin[terms]) & (weight > 0)
        terms, weight = terms[there], weight[there]
        best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return best, scores
        lo, hi = np.array([0]), np.array([self.n])
        begin, end = self.begin[terms][None, :], self.begin[terms + 1][None, :]
        bound, at = self.bounds(weight, begin, end)
        step = 1
        while len(lo):
            chosen = np.arange(len(lo))
            if len(lo) > step:
                chosen = np.argpartition(-bound, step)[:step]
            b, e, doc, low, high = begin[chosen], end[chosen], at[chosen], lo[chosen], hi[chosen]
            want = terms[None, :] * self.n + doc[:, None]
            place = np.searchsorted(self.keys, want)
            hit = self.keys[np.minimum(place, len(self.keys) - 1)] == want
            gained = self.impact[np.minimum(place, len(self.keys) - 1)] * hit * weight[None, :]
            best, scores = np.append(best, doc), np.append(scores, gained.sum(1))
            order = np.lexsort((self.ids[best], -scores))[:top]
            best, scores = best[order], scores[order]
            b, e = np.concatenate([b, place + hit]), np.concatenate([place, e])
            low, high = np.concatenate([low, doc + 1]), np.concatenate([doc, high])
            new_bound, new_at = self.bounds(weight, b, e)
            rest = np.ones(len(lo), bool)
            rest[chosen] = False
            bound, at = np.append(bound[rest], new_bound), np.append(at[rest], new_at)
            lo, hi = np.append(lo[rest], low), np.append(hi[rest], high)
            begin, end = np.concatenate([begin[rest], b]), np.concatenate([end[rest], e])
            open_ = bound > 0
            if len(best) == top:
                open_ &= bound >= scores[-1]
                equal = np.flatnonzero(open_ & (bound == scores[-1]))
                first = self.ids[self.first_id.place(lo[equal], hi[equal])]
                open_[equal[first >= self.ids[best[-1]]]] = False
            lo, hi, begin, end = lo[open_], hi[open_], begin[open_], end[open_]
            bound, at = bound[open_], at[open_]
            step = min(2 * step, STEP)
        return best, scores


def search(docs: pa.Table, queries: pa.Table, n_docs: int, n_terms: int, top: int) -> pa.Table:
    """The best documents of a shard for every query of a block."""
    out = [[], [], [], []]
    if len(docs) and len(queries):
        vocabulary, term = np.unique(queries["term"].to_numpy(), return_inverse=True)
        shard = Shard(docs, vocabulary, n_docs, n_terms)
        item, weight = queries["item"].to_numpy(), queries["weight"].to_numpy()
        order = np.argsort(item, kind="stable")
        edge = np.append(np.flatnonzero(np.diff(item[order], prepend=item[order[0]] - 1)), len(item))
        ids = queries["item_id"].to_pylist()
        for a, b in zip(edge[:-1], edge[1:]):
            mine = order[a:b]
            best, scores = shard.search(term[mine], weight[mine], top)
            out[0] += [int(item[mine[0]])] * len(best)
            out[1] += [ids[mine[0]]] * len(best)
            out[2] += [None if x == NO_ID else x for x in shard.ids[best].tolist()]
            out[3] += scores.tolist()
    return pa.table([pa.array(x, pa.int64()) for x in out], names="item item_id doc_id score".split())


def ranked(
    docs: DataFrame, queries: DataFrame, top: int = TOP, shards: int | None = None, blocks: int | None = None
) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents (doc_id, text) for every query (item_id, text).
    Without numbers of shards and blocks they come from the postings and the queries' terms."""
    items = stage(queries.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "items")
    asked = stage(term_rows(stage(counted(items, "item"), "item-terms"), "id"), "asked")
    index = counted(docs, "doc_id", bitmap(asked.select("term").distinct()))
    index = stage(index.withColumn("row", F.monotonically_increasing_id()), "index")
    total = index.agg(
        F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms"), F.sum(F.length("times")).alias("bytes")
    ).first()
    n_docs, n_terms = total["n"], total["terms"] or 0
    shards = shards or max(LEAST_SHARDS, math.ceil((total["bytes"] or 0) / 4 / SHARD_POSTINGS))
    blocks = blocks or max(1, math.ceil(asked.count() / BLOCK_TERMS))
    known = term_rows(index, None).groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1)))
    weighted = stage(
        asked.join(known, "term")
        .join(items.select(F.col("item").alias("id"), "item_id"), "id")
        .select(
            F.col("id").alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "term",
            (weight * F.col("times")).alias("weight"),
            F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        ),
        "weighted",
    )
    number = F.sequence(F.lit(0), F.lit(shards - 1))
    asking = weighted.select("*", F.explode(number).alias("shard"))
    dealt = index.where(F.length("terms") > 0).select(
        "id", "n", "terms", "times",
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    tasks = min(shards * blocks, MOST_TASKS)
    found = (
        dealt.repartition(tasks, "shard", "block").groupBy("shard", "block")
        .cogroup(asking.repartition(tasks, "shard", "block").groupBy("shard", "block"))
        .applyInArrow(lambda d, q: search(d, q, n_docs, n_terms, top), FOUND)
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = stage(found, "found").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("item_id", "rank", "doc_id", "score")
