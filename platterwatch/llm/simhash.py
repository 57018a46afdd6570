"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is cut into SEGMENTS parts, and the number of set bits of each gives a point on
a small integer grid. Points of two fingerprints are never further apart in Manhattan distance than the
fingerprints are in bits, so a range join on the grid finds all pairs. Every point is put into
the grid cells within half the bound of it: two points within the whole bound then share a cell. What
shares a cell is compared exactly.

A cell's pairs are never emitted: it gives links from each member to the first of its part of
the cell. Cells of more than CELL distinct fingerprints, which near copies in thousands make, are not
gathered. Their members are linked through bit patterns instead: every member is put under
all patterns within half the bound, and each pattern links its members to the smallest of them. That is
exact and its rows grow with the members, not with the pairs.

Defined cases: a null or empty text has fingerprint zero, which links like any other. Texts of
fewer words than a shingle are hashed as one. A null doc_id is no component's smallest id; a
component of null ids only has a null component_id. Repeated rows stay rows. Empty tables give no
rows. Other columns are not read by `components_of` and are all kept by `one_of_each`.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from platterwatch.llm.graph import components
from platterwatch.llm.texts import fresh, per_text
from platterwatch.sources.storage import stage

SHINGLE = 3
DISTANCE = 2
SEGMENTS = 16
CELL = 256
SEED = 42


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Of a text in UTF-8, as a signed 64-bit number."""
    words = data.lower().split()  # both handle ASCII only, as the contract does
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
        hashes = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1 :].tolist())]
        )
    table = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for begin in range(0, len(table), 1 << 16):  # long texts in parts, for memory
        counts += np.unpackbits(table[begin : begin + (1 << 16)], axis=1).sum(0, dtype=np.uint32)
    bits = np.packbits(2 * counts > len(table))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *keep: str) -> DataFrame:
    def work(texts):
        return [[0 if x is None else fingerprint(x.encode(), shingle) for x in texts]]

    return per_text(docs, {"fp": "bigint"}, work, *keep)


def cells(fp, radius: int) -> F.Column:
    """The grid cells within the radius of a fingerprint's point; a cell is a base-8 number whose
    digits are the bit counts of the segments."""
    size = 64 // SEGMENTS
    counts = [
        F.bit_count(F.shiftrightunsigned(fp, size * k).bitwiseAND((1 << size) - 1)).cast("bigint")
        for k in range(SEGMENTS)
    ]
    step = [1 << (3 * k) for k in range(SEGMENTS)]
    point = sum((c * s for c, s in zip(counts, step)), F.lit(0).cast("bigint"))
    found = [point]
    for n in range(1, radius + 1):
        for chosen in combinations(range(SEGMENTS), n):
            for move in moves(n, radius):
                inside = F.lit(True)
                for k, m in zip(chosen, move):
                    inside = inside & ((counts[k] + m >= 0) & (counts[k] + m <= size))
                shift = sum(m * step[k] for k, m in zip(chosen, move))
                found.append(F.when(inside, point + F.lit(shift).cast("bigint")))
    return F.array_compact(F.array(*found))


def moves(n: int, radius: int) -> list[tuple[int, ...]]:
    steps = [m for m in range(-radius, radius + 1) if m]
    return [x for x in product(steps, repeat=n) if sum(map(abs, x)) <= radius]


def patterns(fp, radius: int) -> F.Column:
    """All bit patterns within the radius of a fingerprint."""
    masks = [
        sum(1 << k for k in chosen) for n in range(radius + 1) for chosen in combinations(range(64), n)
    ]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    flips = F.array(*[F.lit(m).cast("bigint") for m in signed])
    return F.transform(flips, lambda m: fp.bitwiseXOR(m))


def cell_links(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of one cell that keep its components: each to its part's first."""
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= distance
    n = len(members)
    label = np.where(near, np.arange(n)[None, :], n).min(1)
    while True:
        lower = np.where(near, label[None, :], n).min(1)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    other = np.flatnonzero(label != np.arange(n))
    return members[other], members[label[other]]


def small_cell_links(cells_: DataFrame, distance: int) -> DataFrame:
    """(a, b) from rows with a bounded list `members` of distinct fingerprints."""

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            edge = lists.offsets.to_numpy().astype(np.int64)
            edge, size = edge - edge[0], np.diff(edge)
            two = edge[:-1][size == 2]
            good = np.bitwise_count(flat[two] ^ flat[two + 1]) <= distance
            found = [(flat[two[good]], flat[two[good] + 1])]
            for k in np.flatnonzero(size > 2):
                found.append(cell_links(flat[edge[k] : edge[k + 1]], distance))
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["a", "b"])

    return cells_.select("members").mapInArrow(run, "a bigint, b bigint")


def links(distinct: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` that give the components of all pairs at
    `distance` or fewer differing bits, an even number, as each side goes half the way."""
    if distance % 2:
        raise ValueError("the distance has to be even")
    radius = distance // 2
    placed = distinct.select("fp", F.explode(cells(F.col("fp"), radius)).alias("cell"))
    counts = stage(placed.groupBy("cell").count().where("count > 1"), "cells")
    small = counts.where(F.col("count") <= cell).select("cell")
    gathered = placed.join(small, "cell").groupBy("cell").agg(F.collect_list("fp").alias("members"))
    crowded = counts.where(F.col("count") > cell).select("cell")
    hot = stage(placed.join(crowded, "cell", "left_semi").select("fp").distinct(), "crowded")
    pattern = hot.select("fp", F.explode(patterns(F.col("fp"), radius)).alias("pattern"))
    stars = (
        pattern.groupBy("pattern")
        .agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    star_links = pattern.join(stars, "pattern").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return small_cell_links(gathered, distance).unionAll(star_links)


def classes(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of rows (doc_id, fp); root is the
    smallest fingerprint of the component."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct, distance))
    found = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = found.groupBy("root").agg(F.min("first").alias("component_id"))
    return stage(found.join(least, "root").select("fp", "root", "component_id"), "classes")


def components_of(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    rows = stage(fingerprints(docs, shingle, "doc_id"), "fingerprints")
    return rows.join(classes(rows, distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents with, of each component, only the row of its smallest doc_id (null ids last; among
    rows of one id, that of the smallest hash of id and text, then of all columns; of rows that are equal all
    over, one). All columns are kept. Equal rows are combined before the one shuffle of texts."""
    key, mark, whole = fresh(docs, "key", "mark", "whole")
    plain = [f"`{f.name}`" for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    marked = docs.withColumns({
        key: F.coalesce(F.col("doc_id"), F.lit(0)),
        mark: F.xxhash64("doc_id", "text"),
        whole: F.xxhash64(*plain),
    })
    names = [key, mark, whole]
    rows = stage(fingerprints(marked, shingle, "doc_id", *names), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), *map(F.col, names))
    firsts = (
        rows.join(classes(rows, distance), "fp")
        .groupBy("root")
        .agg(F.min(order).alias("least"))
        .select(*[f"least.{x}" for x in names])
    )
    return marked.dropDuplicates(names).join(firsts, names, "left_semi").drop(*names)
