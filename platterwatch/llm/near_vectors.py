"""Near-duplicate vectors by int8 tile products with error bounds.

Each vector is scaled to length one and written as a scale times int8 codes; the length of what rounding
took away, its gap, is kept with it. For u = u' + e and v = v' + f, |u| = |v| = 1,

    u.v = u'.v' + u'.f + e.v <= scale_u scale_v codes_u.codes_v + |u'| gap_v + gap_u

by Cauchy and Schwarz, so a pair whose right side is below the threshold is no link. The bound of a whole
tile is one matrix product: the codes, whose products are whole numbers, with two more columns for the
gaps and the threshold. Only pairs whose sign says that they may reach the threshold are computed again,
from the full vectors in double precision.

Vectors that are equal in all components are one row with a count before any product, so copies cost
nothing. The distinct ones are dealt by hash into groups of a bounded size, and each pair of groups is one
call of `compare`, so every pair of vectors meets once. It never emits its pairs: it gives each vector's number of
links and one link to another vector of its component. As all pairs are compared, work grows with the
square of the number of distinct vectors, at the speed of matrix products.

Defined cases: vectors that are null, empty or zero or hold a null or non-finite component link with
nothing, and so do vectors of different lengths. Rows with equal vec_id are vectors of their own. A null
vec_id is no component's smallest; a component of null ids only has a null component_id and its rows are kept.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterwatch.llm.graph import components
from platterwatch.sources.storage import stage

THRESHOLD = 0.95
GROUP_BYTES = 1 << 24  # of components in a group, at four bytes each
LEAST_GROUPS = 8  # so that small inputs are several tasks, too
MOST_TASKS = 50_000  # of a shuffle; beyond it a task takes several pairs of groups, one after the other
TILE = 2048
DENSE = 16  # a tile with over 1 / DENSE of its pairs left is computed again as a whole
PAIRS = 1 << 16  # computed again at a time
HOT_SHARE = 1000  # a vector with this part of all rows is joined by broadcast; at most as many are

FOUND = "node bigint, links bigint, root bigint"


def finite(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    number = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(number, F.lit(False))


def usable(vector: Column) -> Column:
    return finite(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


class Side:
    """The vectors of a group: unit vectors, their int8 codes, scales and gaps."""

    def __init__(self, vectors: np.ndarray):
        largest = np.abs(vectors).max(1, keepdims=True)
        unit = vectors / largest  # first, so that squares neither overflow nor vanish
        self.unit = unit / np.sqrt((unit * unit).sum(1, keepdims=True))
        self.scale = np.abs(self.unit).max(1) / 127
        self.codes = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        kept = self.codes * self.scale[:, None]
        self.gap = np.sqrt(((self.unit - kept) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
        self.size = np.sqrt((kept * kept).sum(1)) * (1 + 1e-9)

    def rows(self, threshold: float) -> np.ndarray:
        """Codes and the two columns that a left side brings to the bound. The slack covers the rounding
        of 32-bit sums, whose terms add up to no more than two in units of the scales."""
        slack = (self.codes.shape[1] + 4) * 2.0**-22
        rest = (self.gap - threshold + slack) / self.scale
        return np.column_stack([self.codes, self.size / self.scale, rest]).astype(np.float32)

    def columns(self) -> np.ndarray:
        return np.column_stack([self.codes, self.gap / self.scale, 1 / self.scale]).astype(np.float32).T


def exact(a: np.ndarray, b: np.ndarray, r: np.ndarray, c: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (a[r], b[c]) reach the threshold in double precision."""
    if len(r) * DENSE > len(a) * len(b):
        return (a @ b.T)[r, c] >= threshold
    good = np.zeros(len(r), bool)
    for k in range(0, len(r), PAIRS):
        part = slice(k, k + PAIRS)
        good[part] = np.einsum("ij,ij->i", a[r[part]], b[c[part]]) >= threshold
    return good


def union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[k] and b[k]. Every entry of root is a final one before and after."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def tiles(left: Side, right: Side | None, threshold: float):
    """(r, c) of all links between two sides, or within one, a tile at a time."""
    other = right or left
    rows, columns = left.rows(threshold), other.columns()
    for r0 in range(0, len(left.unit), TILE):
        r1 = r0 + TILE
        for c0 in range(0 if right else r0, len(other.unit), TILE):
            c1 = c0 + TILE
            r, c = np.nonzero(rows[r0:r1] @ columns[:, c0:c1] >= 0)
            if not right and c0 == r0:
                r, c = r[c > r], c[c > r]
            if len(r):
                good = exact(left.unit[r0:r1], other.unit[c0:c1], r, c, threshold)
                yield r0 + r[good], c0 + c[good]


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    flat = [x.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for x in lists.chunks]
    return np.concatenate(flat).reshape(len(lists), -1)


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """Numbers of links and joined sets of the vectors of a pair of groups, or of one group."""
    second = table["part"].to_numpy() != table["i"].to_numpy()
    table = table.take(pa.array(np.argsort(second, kind="stable")))
    n = int((~second).sum())
    same = table["i"][0].as_py() == table["j"][0].as_py() if len(table) else True
    node, times = table["node"].to_numpy(), table["n"].to_numpy()
    links, root = np.zeros(len(table), np.int64), np.arange(len(table))
    if n and (same or n < len(table)):
        vectors = matrix(table["embedding"])
        left, right = Side(vectors[:n]), None if same else Side(vectors[n:])
        for r, c in tiles(left, right, threshold):
            c = c if same else c + n
            links += np.bincount(r, times[c], len(links)).astype(np.int64)
            links += np.bincount(c, times[r], len(links)).astype(np.int64)
            union(root, r, c)
    found = links > 0
    return pa.table({"node": node[found], "links": links[found], "root": node[root[found]]})


def links(distinct: DataFrame, groups: int, threshold: float = THRESHOLD) -> DataFrame:
    """(node, links, root) per vector and pair of groups in which it has links, from distinct vectors
    (node, n, embedding); root is another vector, or itself, of its component."""
    part = F.pmod(F.xxhash64("node"), F.lit(groups)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(groups - 1)),
        lambda k: F.struct(F.least("part", k).alias("i"), F.greatest("part", k).alias("j")),
    )
    dealt = (
        distinct.select("node", "n", "embedding", F.size("embedding").alias("dim"), part.alias("part"))
        .select("*", F.inline(pairs))
        .repartition(min(groups * (groups + 1) // 2, MOST_TASKS), "dim", "i", "j")
    )
    return dealt.groupBy("dim", "i", "j").applyInArrow(lambda t: compare(t, threshold), FOUND)


def classes(rows: DataFrame, threshold: float = THRESHOLD, groups: int | None = None) -> DataFrame:
    """(embedding, n, n_links, component_id) of every distinct usable vector of rows (vec_id, embedding).
    Without a number of groups it comes from the size of the vectors."""
    counted = rows.where(usable(F.col("embedding"))).groupBy("embedding")
    distinct = counted.agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    if groups is None:
        size = distinct.agg(F.sum(F.size("embedding").cast("long"))).first()[0] or 0
        groups = max(LEAST_GROUPS, math.ceil(4 * size / GROUP_BYTES))
    found = stage(links(distinct, groups, threshold), "vector-links")
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    pairs = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    joined = (
        distinct.join(total, "node", "left")
        .join(components(pairs.distinct()).withColumnRenamed("root", "near"), "node", "left")
        .withColumn("near", F.coalesce("near", "node"))
    )
    joined = stage(joined, "vector-roots")
    least = joined.groupBy("near").agg(F.min("first").alias("component_id"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    return stage(
        joined.join(least, "near").select("embedding", "n", n_links.alias("n_links"), "component_id"),
        "vector-classes",
    )


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, groups: int | None = None
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding).

    Rows get their class by a join on the vector. Vectors that make up a thousandth of all rows or more, of
    which there are at most a thousand, are joined by broadcast, so that none of them is one task's work.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding")
    found = classes(rows, threshold, groups)
    total = found.agg(F.sum("n")).first()[0] or 0
    many = F.col("n") * HOT_SHARE >= total
    hot = F.broadcast(found.where(many))
    rest = rows.join(hot.select("embedding"), "embedding", "left_anti")
    joined = rows.join(hot, "embedding").unionByName(
        rest.join(found.where(~many), "embedding", "left")
    )
    component = F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
