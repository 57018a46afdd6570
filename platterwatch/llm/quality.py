"""Quality classifier: boosted trees over document statistics.

FEATURES are counted for every whole text by numpy. The trees learn from at most SAMPLE labelled
documents, those of the smallest hash of their id; the bound is a parameter. Only the numbers of
this sample reach the driver.

Defined cases: a null text counts as empty; both have all counts zero and a score like any other.
Null labels and null ids are not learned from. Several labels of a document count as their maximum. Without labels every score is 0.5.
Repeated rows get a row each, empty tables none. `good_documents` keeps all columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterwatch.llm import boosting
from platterwatch.llm.rules import LETTER, SYMBOL, UPPER, line_counts, top_word, window_words
from platterwatch.llm.texts import Words, chunked, filter_texts, per_text

SAMPLE = 12_000
THRESHOLD = 0.3

DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True
MARK = np.zeros(256, bool)
MARK[list(b"!?,;:.'\"()-_/\\@{}~^`+=")] = True

FEATURES = (
    "log_words", "word_size", "word_size_spread", "symbols", "marks", "bangs", "upper", "digits",
    "letters", "stops", "line_words", "dup_lines", "repeats", "top_word", "distinct", "capital_words",
    "one_letter_words", "symbol_words", "next_equal",
)


def features(data: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text."""
    words = Words(data)
    hashes = words.hashes()
    owner = words.text_of
    n = np.maximum(words.count, 1)
    starts = (words.data & 0xC0) != 0x80
    points = np.maximum(words.bytes_per_text(starts) - 1, 1)
    before = np.concatenate([[0], np.cumsum(starts)])
    size = (before[words.end] - before[words.at]).astype(float)
    mean = words.per_text(size) / n
    spread = words.per_text(size**2) / n - mean**2
    lines, dup_lines = line_counts(words)
    per_point = lambda table: words.bytes_per_text(table[words.data]) / points
    letters = np.maximum(words.bytes_per_text(LETTER[words.data] & starts), 1)
    order = np.lexsort((hashes, owner))
    k, o = hashes[order], owner[order]
    distinct = np.bincount(
        o, np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])[: len(k)], words.n_texts
    )
    marked = np.concatenate([[0], np.cumsum(SYMBOL[words.data])])
    equal = np.zeros(len(hashes), bool)
    equal[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    bang = np.zeros(256, bool)
    bang[33] = True
    return np.stack([
        np.log1p(words.count), mean, np.sqrt(np.maximum(spread, 0)), per_point(SYMBOL),
        per_point(MARK), per_point(bang), words.bytes_per_text(UPPER[words.data]) / letters,
        per_point(DIGIT), letters / points, words.bytes_per_text(STOP[words.data]) / n,
        words.count / np.maximum(lines, 1), dup_lines / np.maximum(lines, 1),
        window_words(words, hashes) / n, top_word(words, hashes) / n, distinct / n,
        words.per_text(UPPER[words.data[words.at]]) / n, words.per_text(size == 1) / n,
        words.per_text(marked[words.end] > marked[words.at]) / n, words.per_text(equal) / n,
    ], axis=1).astype(np.float64)


def all_features(texts: list[str | None]) -> np.ndarray:
    parts = [features(x) for x in chunked(texts)]
    return np.concatenate([np.zeros((0, len(FEATURES))), *parts])


def fit(
    docs: DataFrame, labels: DataFrame, allowed: F.Column, most: int = SAMPLE
) -> boosting.Trees:
    """Trees from at most `most` labelled documents of which `allowed` (on doc_id) holds."""
    hashed = F.xxhash64("doc_id")
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(allowed & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(hashed, "doc_id")
        .limit(most)
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(known), "doc_id"
    )  # at most `most` rows of two numbers are broadcast
    names = [f"f{k}" for k in range(len(FEATURES))]
    counted = per_text(
        rows, dict.fromkeys(names, "double"), lambda x: list(all_features(x).T), "doc_id", "quality"
    )
    found = counted.orderBy(hashed, "doc_id", *names).limit(most).collect()
    table = np.array([tuple(r) for r in found], float).reshape(-1, len(names) + 2)
    return boosting.fit(table[:, 2:], (table[:, 1] == 1).astype(float))


def scored(docs: DataFrame, model: boosting.Trees, *keep: str) -> DataFrame:
    """The kept columns and score (higher: good is likelier) for every text."""

    def work(texts):
        return [np.clip(model.probability(all_features(texts)), 0, 1)]

    return per_text(docs, {"score": "double"}, work, *keep)


def good_documents(docs: DataFrame, model: boosting.Trees, least: float = THRESHOLD) -> DataFrame:
    """The documents whose score is `least` or more, with all their columns."""
    return filter_texts(docs, lambda texts: model.probability(all_features(texts)) >= least)
