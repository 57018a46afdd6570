"""Byte-level BPE in numpy: encoding of many pieces at a time, and decoding.

The distinct pieces of a batch are sorted into buckets by length, each a padded matrix of token ids. In a
round every row merges its leftmost pair of smallest rank; ranks come from a hash table of token
pairs, of which only the two pairs beside the merge are looked up again. As each row loses one
column a round, the matrix does too, and rows without a pair to merge leave it.

A piece that is a token itself is that token. Pieces over LONG bytes (a megabyte without a space would
take as many rounds) are merged by a queue of pairs in the same order, leftmost smallest first.

Defined cases: a null text is empty: no ids, and the digests of nothing. Repeated rows get a row
each, empty tables none. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from platterwatch.llm.texts import per_text, ragged, runs

LONG = 256
BUCKETS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, LONG)
BUCKET_OF = [next(b for b in BUCKETS if b >= n) for n in range(LONG + 1)]
CACHED_PIECES = 200_000
CHUNK = 1 << 19
NONE = np.int32(2**31 - 1)
EMPTY = np.uint64(2**64 - 1)


class PairTable:
    """Ranks of token pairs: open addressing, looked up for whole arrays."""

    BITS = 20

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        while 3 * len(rank) > 1 << self.BITS:
            self.BITS += 1
        self.keys = np.full(1 << self.BITS, EMPTY)
        self.ranks = np.full(1 << self.BITS, NONE)
        key = self.key(left, right)
        slot, left_over = self.slot(key), np.arange(len(key))
        while len(left_over):
            free = self.keys[slot[left_over]] == EMPTY
            _, first = np.unique(slot[left_over[free]], return_index=True)
            put = left_over[free][first]
            self.keys[slot[put]], self.ranks[slot[put]] = key[put], rank[put]
            left_over = np.setdiff1d(left_over, put, assume_unique=True)
            slot[left_over] = (slot[left_over] + 1) & (len(self.keys) - 1)

    def key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def slot(self, key: np.ndarray) -> np.ndarray:
        mixed = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is none or a token is padding (negative)."""
        out = np.full(len(left), NONE)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = self.key(left[at], right[at])
        slot = self.slot(key)
        while len(at):
            seen = self.keys[slot]
            hit = seen == key
            out[at[hit]] = self.ranks[slot[hit]]
            go = ~hit & (seen != EMPTY)
            at, key, slot = at[go], key[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        pairs = [
            (ranks[token[:k]], ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        left, right, rank = np.array(pairs, np.int32).reshape(-1, 3).T
        self.pairs = PairTable(left, right, rank)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = sorted((rank, token) for token, rank in ranks.items())
        size = np.zeros(tokens[-1][0] + 1, np.int64)
        for rank_, token in tokens:
            size[rank_] = len(token)
        self.token_size, self.token_at = size, np.cumsum(size) - size
        self.tokens = {rank_: token for rank_, token in tokens}
        self.token_bytes = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def merge_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(final ids, padded with -1; how many) for rows of byte tokens padded with -1."""
        n, width = ids.shape
        out, count = np.full((n, width), -1, np.int32), np.zeros(n, np.int64)
        ranks = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        row = np.arange(n)
        while True:
            at = np.arange(len(row))
            if ids.shape[1] > 1:
                j = ranks.argmin(1)
                least = ranks[at, j]
            else:
                least = np.full(len(row), NONE)
            done = least == NONE
            if done.any():
                out[row[done], : ids.shape[1]] = ids[done]
                count[row[done]] = (ids[done] >= 0).sum(1)
                if done.all():
                    return out, count
                go = ~done
                ids, ranks, row, j, least = ids[go], ranks[go], row[go], j[go], least[go]
                at = np.arange(len(row))
            column = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > j[:, None]), 1)
            ids[at, j] = least
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= j[:, None]), 1)
            some = np.flatnonzero(j > 0)
            if len(some):
                k = j[some]
                ranks[some, k - 1] = self.pairs.find(ids[some, k - 1], ids[some, k])
            some = np.flatnonzero(j < ids.shape[1] - 1)
            if len(some):
                k = j[some]
                ranks[some, k] = self.pairs.find(ids[some, k], ids[some, k + 1])

    def merge_long(self, data: bytes) -> list[int]:
        """The same merges for one long piece, by a queue of pairs (rank, place)."""
        ids = self.of_byte[np.frombuffer(data, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens = self.tokens
        get = lambda pair: self.ranks.get(tokens[pair[0]] + tokens[pair[1]])
        queue = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            rank, k, left, right = heapq.heappop(queue)
            m = after[k]
            if ids[k] != left or m >= n or ids[m] != right:
                continue  # one of the two has been merged since
            ids[k], ids[m] = rank, -1
            after[k] = after[m]
            if after[k] < n:
                before[after[k]] = k
                if (r := get((rank, ids[after[k]]))) is not None:
                    heapq.heappush(queue, (r, k, rank, ids[after[k]]))
            if before[k] >= 0 and (r := get((ids[before[k]], rank))) is not None:
                heapq.heappush(queue, (r, before[k], ids[before[k]], rank))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per piece)."""
        sizes = np.ones(len(pieces), np.int64)
        found: list[tuple[list[int], np.ndarray]] = []
        buckets: dict[int, list[int]] = {}
        for k, data in enumerate(pieces):
            known = self.ranks.get(data)
            if known is not None:
                buckets.setdefault(1, []).append(k)
            elif len(data) > LONG:
                ids = np.array(self.merge_long(data), np.int32)
                found.append(([k], ids))
                sizes[k] = len(ids)
            else:
                buckets.setdefault(BUCKET_OF[len(data)], []).append(k)
        whole = buckets.pop(1, [])
        found.append((whole, np.array([self.ranks[pieces[k]] for k in whole], np.int32)))
        for width, members in buckets.items():
            step = max(1, (1 << 20) // width)
            for begin in range(0, len(members), step):
                part = members[begin : begin + step]
                flat = np.frombuffer(b"".join([pieces[k].ljust(width, b"\0") for k in part]), np.uint8)
                ids = self.of_byte[flat].reshape(-1, width)
                length = np.fromiter((len(pieces[k]) for k in part), np.int64, len(part))
                ids[np.arange(width) >= length[:, None]] = -1
                out, sizes[part] = self.merge_rows(ids)
                found.append((part, out[out >= 0]))
        begin = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int32)
        for part, ids in found:
            flat[ragged(begin[part], sizes[part])] = ids
        return flat, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text)."""
        if len(self.known) > CACHED_PIECES:
            self.clear()
        split = [self.pattern.findall(x) for x in texts]
        new = sorted(set().union(*split).difference(self.known))
        if new:
            ids, size = self.encode_pieces([x.encode() for x in new])
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, ids])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        find = self.known.__getitem__
        code = np.fromiter(map(find, chain.from_iterable(split)), np.int64, int(counts.sum()))
        size = self.size[code]
        edge = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return self.ids[ragged(self.begin[code], size)], np.diff(edge)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of flat ids."""
        return self.token_bytes[ragged(self.token_at[ids], self.token_size[ids])]


@lru_cache(2)
def load(path: str, pattern: str) -> Bpe:
    """The tokenizer of a file of ranks, once for each Python worker."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file if line.strip()]
    return Bpe({base64.b64decode(a): int(b) for a, b in rows}, pattern)


def digests(texts: list[str | None], bpe: Bpe) -> list[list]:
    """Number of ids, digest of the ids and digest of the decoded bytes, for each text."""
    texts = [x or "" for x in texts]
    found: list[list] = [[], [], []]
    for part in runs([len(x) for x in texts], CHUNK):
        ids, sizes = bpe.encode(texts[part])
        edge = np.concatenate([[0], np.cumsum(sizes)])
        data = bpe.decode(ids)
        byte_edge = np.concatenate([[0], np.cumsum(bpe.token_size[ids])])[edge].tolist()
        raw = ids.astype("<u4").view(np.uint8)
        found[0] += sizes.tolist()
        found[1] += [
            hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(edge[:-1], edge[1:])
        ]
        found[2] += [
            hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(byte_edge[:-1], byte_edge[1:])
        ]
    return found


def encode_and_decode(docs: DataFrame, path: str, pattern: str, *keep: str) -> DataFrame:
    """The kept columns, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    columns = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return per_text(docs, columns, lambda texts: digests(texts, load(path, pattern)), *keep)


def token_ids(docs: DataFrame, path: str, pattern: str, *keep: str) -> DataFrame:
    """The kept columns and the ids of every text, as little-endian unsigned 32-bit integers."""

    def work(texts):
        rows = []
        for part in runs([len(x or "") for x in texts], CHUNK):
            ids, sizes = load(path, pattern).encode([x or "" for x in texts[part]])
            rows += [x.tobytes() for x in np.split(ids.astype("<u4"), np.cumsum(sizes)[:-1])]
        return [rows]

    return per_text(docs, {"ids": "binary"}, work, *keep)
