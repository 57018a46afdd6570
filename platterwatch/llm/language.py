"""Language identification with the bidirectional recurrent network of `gru`.

A text is cut into windows of WINDOW bytes, every byte of which gets label probabilities; a document's
probabilities are the mean over its letters (all bytes of non-ASCII characters count as letters).
The network learns from at most SAMPLE documents of each label, those of the smallest hash of their id, so
that rare languages are learned, too, and of
each from at most WINDOWS windows spread over the whole text. These bounds are parameters; predictions read
every byte of every text. The sample is found by labels and ids alone, and only its texts are read for learning.

Defined cases: a text that is null or has no letter is `und` with score 0. So is every text if there
is nothing to learn from. Null labels are not learned from. Ties go to the label that sorts first.
Repeated rows get a row each, empty tables none. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterwatch.llm import gru
from platterwatch.llm.texts import PLAIN, chunked, encoded, per_text

WINDOW = 64
HIDDEN = 8
SAMPLE = 1000
WINDOWS = 4
ROUNDS = 220
BATCH = 256
CHUNK = 1 << 19

LETTERS = PLAIN.copy()
LETTERS[48:58] = False


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes by step and window, padded; first window of every text, one more at the end)."""
    counts = np.array([-(-len(x) // WINDOW) for x in texts], np.int64)
    edge = np.concatenate([[0], np.cumsum(counts)])
    out = np.full((int(edge[-1]), WINDOW), gru.PAD, np.int16)
    flat = out.reshape(-1)
    for data, at in zip(texts, (edge[:-1] * WINDOW).tolist()):
        flat[at : at + len(data)] = np.frombuffer(data, np.uint8)
    return np.ascontiguousarray(out.T), edge


def letters_in(x: np.ndarray) -> np.ndarray:
    return np.append(LETTERS, False)[x]


def pooled(weights: dict, texts: list[bytes]) -> np.ndarray:
    """Mean label probabilities over the letters of each text; zero for texts without any."""
    x, edge = windows(texts)
    labels = len(weights["c"])
    sums = np.zeros((x.shape[1] + 1, labels + 1))
    for begin in range(0, x.shape[1], CHUNK // WINDOW):
        part = np.ascontiguousarray(x[:, begin : begin + CHUNK // WINDOW])
        counted = letters_in(part).astype(np.float32)
        p = gru.label_positions(weights, part)
        at = slice(begin + 1, begin + 1 + part.shape[1])
        sums[at, :labels] = np.einsum("tbk,tb->bk", p, counted)
        sums[at, labels] = counted.sum(0)
    total = np.cumsum(sums, axis=0)
    total = total[edge[1:]] - total[edge[:-1]]
    return total[:, :labels] / np.maximum(total[:, labels:], 1)


def sample(docs: DataFrame, allowed: F.Column, most: int = SAMPLE) -> DataFrame:
    """(lang, text) of at most `most` documents of each label, those of the smallest hash of their id, and of
    their copies under one id. Ids and labels alone are ranked, within each task first; the join brings the
    texts of the chosen ones."""
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    keys = rows.select("doc_id", "lang").withColumn("place", F.row_number().over(order))
    chosen = F.broadcast(keys.where(F.col("place") <= most).select("doc_id", "lang").distinct())
    return rows.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(
        chosen, ["doc_id", "lang"], "left_semi"
    )  # `most` ids per language are broadcast


def sampled_windows(texts: list[str | None]) -> list[list[bytes]]:
    """At most WINDOWS windows of each text that hold a letter, spread over all of it; joined, as
    every one but the text's last is WINDOW bytes long."""
    out = []
    for data in encoded(texts):
        parts = [data[k : k + WINDOW] for k in range(0, len(data), WINDOW)]
        step = zlib.crc32(data) % max(1, len(parts))
        places = {(step + k * max(1, len(parts) // WINDOWS)) % len(parts) for k in range(WINDOWS)} if parts else ()
        out.append(b"".join(parts[k].ljust(WINDOW) for k in sorted(places)))
    return [out]


def fit(docs: DataFrame, allowed: F.Column, **bounds) -> tuple[list[str], dict | None]:
    """(labels, weights) learned from a bounded sample; only its windows reach the driver."""
    cut = per_text(sample(docs, allowed, **bounds), {"parts": "binary"}, sampled_windows, "lang", "doc_id")
    chosen = cut.groupBy("lang", "doc_id").agg(F.min("parts").alias("parts"))  # of copies under one id, one
    rows = chosen.orderBy(F.xxhash64("doc_id"), "lang", "doc_id").collect()
    labels = sorted({row["lang"] for row in rows})
    parts, y = [], []
    for row in rows:
        data = bytes(row["parts"])
        mine = [data[k : k + WINDOW] for k in range(0, len(data), WINDOW)]
        parts += mine
        y += [labels.index(row["lang"])] * len(mine)
    if not parts:
        return labels, None
    x, _ = windows(parts)
    seen = letters_in(x).any(0)
    if not seen.any():
        return labels, None
    y = np.array(y)[seen]
    return labels, gru.train(x[:, seen], y, len(labels), HIDDEN, ROUNDS, BATCH, seed=7)


def predict(docs: DataFrame, labels: list[str], weights: dict | None, *keep: str) -> DataFrame:
    """The kept columns, lang_pred and score for every text."""

    def work(texts):
        langs, scores = [], []
        for part in chunked(texts):
            lettered = [any(map(str.isalpha, x.decode())) for x in part]
            p = pooled(weights, part) if weights else np.zeros((len(part), 1))
            for good, row in zip(lettered, p):
                best = int(row.argmax())
                known = good and weights is not None
                langs.append(labels[best] if known else "und")
                scores.append(min(1.0, float(row[best])) if known else 0.0)
        return [langs, scores]

    return per_text(docs, {"lang_pred": "string", "score": "double"}, work, *keep)
