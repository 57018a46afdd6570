"""Vector codes by parts, with exact whole-number products.

A component x becomes floor(4096 * x), and a vector is cut into PARTS equal consecutive parts. Each
part has a codebook of up to ENTRIES entries; a part's code is its nearest entry by squared distance.

Distances are exact. |a - b|^2 = |a|^2 - 2 a.b + |b|^2, and a.b comes from matrix products of limbs: a
number is high * 2^13 + low, with 0 <= low < 2^13, so that products of two limbs summed over a part stay
below 2^53 and are exact in doubles. The four products are put together as 64-bit integers, and the first
smallest distance is taken.

A codebook begins with the smallest ids' parts. Each round is one pass: a task adds up the parts that it
assigns to each entry and emits only those sums, at most one row per part, entry and component, so hot
values cost nothing more. Codebooks, which are as bounded, go to the tasks with the code.

Defined cases: null vectors and those with a null or non-finite component are dropped. Shorter vectors are
filled up with zeros to the longest, and that to a multiple of PARTS. Whole numbers are held within +-2^24,
that is components within +-4096, so that sums fit 64 bits. Ties in vec_id are ordered by vector, null ids come last.
With fewer rows than ENTRIES there are as many entries. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterwatch.llm.near_vectors import finite
from platterwatch.llm.texts import ragged
from platterwatch.sources.storage import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
MOST = 1 << 24
LIMB_BITS = 13

CODES = "vec_id bigint, label int, code string, error bigint"
SUMS = "part int, entry int, place int, total bigint, n bigint"


def whole(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of `width` whole numbers."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros(len(lists) * width, np.int64)
    with np.errstate(over="ignore"):
        out[ragged(np.arange(len(lists)) * width, size)] = np.clip(np.floor(flat * SCALE), -MOST, MOST)
    return out.reshape(len(lists), width)


def limbs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) with numbers = high * 2^13 + low, as doubles."""
    low = numbers & ((1 << LIMB_BITS) - 1)
    return low.astype(np.float64), (numbers >> LIMB_BITS).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers within +-2^26, exactly."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a)):
        for j, y in enumerate(limbs(b)):
            out += (x @ y.T).astype(np.int64) << (LIMB_BITS * (i + j))
    return out


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row, and its squared distance."""
    apart = (entries * entries).sum(1)[None, :] - 2 * products(rows, entries)
    code = apart.argmin(1)
    return code, (rows * rows).sum(1) + apart[np.arange(len(rows)), code]


def parts_of(rows: np.ndarray) -> list[np.ndarray]:
    return np.split(rows, PARTS, axis=1)


def sums(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """Sums and numbers of the parts nearest to each entry: (part, entry, place, total, n)."""
    n_parts, n_entries, size = books.shape

    def run(batches):
        total = np.zeros(books.shape, np.int64)
        n = np.zeros((n_parts, n_entries), np.int64)
        for batch in batches:
            for k, rows in enumerate(parts_of(whole(batch.column(0), n_parts * size))):
                code, _ = nearest(rows, books[k])
                n[k] += np.bincount(code, minlength=n_entries)
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.diff(code[order], prepend=-1))
                total[k, code[order][first]] += np.add.reduceat(rows[order], first, axis=0)
        part, entry = np.nonzero(n)
        at = [np.repeat(part, size), np.repeat(entry, size), np.tile(np.arange(size), len(part))]
        values = [total[part, entry].reshape(-1), np.repeat(n[part, entry], size)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int32()) for x in at), *(pa.array(x, pa.int64()) for x in values)],
            names="part entry place total n".split(),
        )

    partial = kept.select("embedding").mapInArrow(run, SUMS)
    added = [F.sum(c).alias(c) for c in ("total", "n")]
    return partial.groupBy("part", "entry", "place").agg(*added)


def learn(kept: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks as (part, entry, component) of the kept rows (vec_id, label, embedding)."""
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    size = max(1, -(-longest // PARTS))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    lists = pa.array([r["embedding"] for r in first], pa.list_(pa.float64()))
    books = np.stack(parts_of(whole(lists, PARTS * size)))
    for _ in range(rounds if first else 0):
        books = books.copy()
        for r in sums(kept, books).collect():  # one row per component of the codebooks
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return books


def codes(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every row."""
    n_parts, _, size = books.shape
    digits = np.array([f"{k:02x}" for k in range(max(1, books.shape[1]))])

    def run(batches):
        for batch in batches:
            texts, error = np.full(batch.num_rows, ""), np.zeros(batch.num_rows, np.int64)
            for k, rows in enumerate(parts_of(whole(batch.column(2), n_parts * size))):
                code, apart = nearest(rows, books[k])
                texts, error = np.char.add(texts, digits[code]), error + apart
            columns = [batch.column(0), batch.column(1), pa.array(texts.tolist(), pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names="vec_id label code error".split())

    return kept.select("vec_id", "label", "embedding").mapInArrow(run, CODES)


def digest(books: np.ndarray) -> str:
    text = ",".join(map(str, books.reshape(-1).tolist()))
    return hashlib.sha256(text.encode()).hexdigest()


def vector_codes(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every kept row of (vec_id, embedding, label)."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("int"), "embedding"
    ).where(finite(F.col("embedding")))
    kept = stage(rows, "kept-vectors")
    books = learn(kept, rounds, entries)
    coded = stage(codes(kept, books), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
