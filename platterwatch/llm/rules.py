"""Quality rules as weak supervision.

Each rule looks at one statistic of a document and votes good (1), bad (-1) or abstains (0): good where the
statistic is what it is in clean prose, bad where it is far from that, and neither in between.
Expectation-maximisation over the votes of all documents estimates the share of good documents and, for each
rule, how often it is right when it votes on a good document and when it votes on a bad one. A
document's posterior probability of being good then decides, where all-must-pass filtering would let one
rule reject it.

Two things keep the estimate from naming any large cluster of votes the bad class. Rules are written so that
they seldom call a good document bad, while each sees one kind of bad document only, and both are priors
that weigh as much as the data. And votes that go together within the classes count less: a rule's
evidence is divided by one plus the squared correlations of its votes with those of the other rules.

The estimation sees every document through the number of documents per vote pattern. There are at
most 3 ** 8 patterns for the eight rules, whatever the input, so that table is what reaches the driver and
what is broadcast.

Defined cases: a null or empty text has no words, fails the base and is not kept. Repeated rows have
a row each and weigh as many times. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterwatch.llm.texts import Words, chunked, per_text
from platterwatch.sources.storage import stage

ROUNDS = 100
KEPT_FROM = 0.5
GOOD_RIGHT, BAD_RIGHT = 0.98, 0.35  # how often a rule is thought right on good and on bad documents

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_letters n_top_word"
).split()

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal to another of the same owner, equal to an earlier one) for every key."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    later = np.zeros(len(keys), bool)
    any_ = np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def line_counts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier line of their text."""
    breaks = np.flatnonzero(words.data == 10)  # every text ends with one
    begin = np.concatenate([[0], breaks[:-1] + 1])
    filled = np.searchsorted(words.at, breaks) > np.searchsorted(words.at, begin)
    begin, end = begin[filled], breaks[filled]
    owner = np.searchsorted(words.text_at, begin, "right") - 1
    _, later = repeated(words.hashes(begin, end), owner)
    n = words.n_texts
    return np.bincount(owner, minlength=n), np.bincount(owner[later], minlength=n)


def window_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in the text."""
    inside = np.zeros(len(hashes), bool)
    if len(hashes) >= 3:
        owner = words.text_of
        key = (hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1]) * np.uint64(
            0xC2B2AE3D27D4EB4F
        ) + hashes[2:]
        at = np.flatnonzero(owner[:-2] == owner[2:])
        twice, _ = repeated(key[at], owner[at])
        at = at[twice]
        for k in range(3):
            inside[at + k] = True
    return words.per_text(inside)


def top_word(words: Words, hashes: np.ndarray) -> np.ndarray:
    """How often the commonest word of each text occurs."""
    owner = words.text_of
    order = np.lexsort((hashes, owner))
    k, o = hashes[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])[: len(k)])
    size = np.diff(np.append(edge, len(k)))
    out = np.zeros(words.n_texts, np.int64)
    np.maximum.at(out, o[edge], size)
    return out


def count_texts(texts: list[str | None]) -> list[np.ndarray]:
    parts = []
    for data in chunked(texts):
        words = Words(data)
        hashes = words.hashes()
        starts = (words.data & 0xC0) != 0x80  # first bytes of code points
        before = np.concatenate([[0], np.cumsum(starts)])
        lines, dup_lines = line_counts(words)
        parts.append(
            np.stack([
                words.count,
                words.per_text(before[words.end] - before[words.at]),
                words.bytes_per_text(SYMBOL[words.data]),
                dup_lines,
                window_words(words, hashes),
                lines,
                words.bytes_per_text(UPPER[words.data]),
                words.bytes_per_text(LETTER[words.data] & starts),
                top_word(words, hashes),
            ])
        )
    return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0, np.int64)] * len(COUNTS)


def vote(bad, good) -> F.Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, F.Column]:
    """Votes by statistic. Shares are compared as products, so that no division by zero occurs."""
    c = {x: F.col(x) for x in COUNTS}
    words, lines, letters = c["n_words"], c["n_lines"], c["n_letters"]
    chars, top, upper = c["word_chars"], c["n_top_word"], c["n_upper"]
    return {
        "length": vote(words < 20, (words >= 100) & (words <= 100_000)),
        "word_size": vote(
            (chars < 3 * words) | (chars > 7 * words), (chars >= 4 * words) & (chars <= 6 * words)
        ),
        "symbols": vote(10 * c["n_symbols"] > words, 200 * c["n_symbols"] <= words),
        "dup_lines": vote(10 * c["n_dup_lines"] > 3 * lines, (c["n_dup_lines"] == 0) & (lines >= 3)),
        "repeats": vote(10 * c["n_repeat_words"] > 2 * words, 100 * c["n_repeat_words"] <= words),
        "upper": vote(10 * upper > 3 * letters, (100 * upper <= 5 * letters) & (upper > 0)),
        "letters": vote(100 * letters < 90 * chars, 100 * letters >= 95 * chars),
        "top_word": vote(100 * top > 20 * words, 100 * top <= 8 * words),
    }


class Model(NamedTuple):
    share: float  # of good documents
    good_right: np.ndarray  # how often each rule is right when it votes on a good document
    bad_right: np.ndarray  # and on a bad one
    weight: np.ndarray  # what its votes count, for those that go together


def fit(votes: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model of vote patterns with their numbers of documents."""
    n = votes.shape[1]
    model = Model(0.8, np.full(n, GOOD_RIGHT), np.full(n, BAD_RIGHT), np.ones(n))
    cast, up, down = votes != 0, votes > 0, votes < 0
    for _ in range(rounds):
        p = posterior(votes, model)
        good, bad = p * weight, (1 - p) * weight
        of_good, of_bad = good @ cast, bad @ cast
        good_right = (good @ up + GOOD_RIGHT * (of_good + 1)) / (2 * of_good + 1)
        bad_right = (bad @ down + BAD_RIGHT * (of_bad + 1)) / (2 * of_bad + 1)
        bad_right = np.maximum(bad_right, 1 - good_right + 0.02)  # better than chance
        share = float((good.sum() + 1) / (weight.sum() + 2))
        model = Model(share, good_right, bad_right, 1 / (together(votes, good, bad) ** 2).sum(0))
    return model


def together(votes: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Correlations of the rules' votes within the two classes, none below zero, one with itself."""
    total = np.zeros((votes.shape[1], votes.shape[1]))
    for mine in (good, bad):
        apart = votes - (mine @ votes) / max(mine.sum(), 1e-9)
        total += (apart * mine[:, None]).T @ apart
    spread = np.sqrt(np.maximum(np.diag(total), 1e-9))
    out = np.maximum(total / np.outer(spread, spread), 0)
    np.fill_diagonal(out, 1)
    return out


def posterior(votes: np.ndarray, model: Model) -> np.ndarray:
    """The probability of being good for each row of votes."""
    says_good = np.log(model.good_right / (1 - model.bad_right))
    says_bad = np.log((1 - model.good_right) / model.bad_right)
    evidence = np.where(votes > 0, says_good, np.where(votes < 0, says_bad, 0.0)) @ model.weight
    return 1 / (1 + np.exp(-(np.log(model.share / (1 - model.share)) + evidence)))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, the votes, p_good and kept."""
    spark = docs.sparkSession
    counted = per_text(docs, dict.fromkeys(COUNTS, "bigint"), count_texts, "doc_id")
    made = rules()
    voted = stage(counted.select("*", *[v.alias(f"vote_{k}") for k, v in made.items()]), "rules")
    names = [f"vote_{k}" for k in made]
    patterns = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # 3 ** rules at most
    votes = np.array([[row[n] for n in names] for row in patterns]).reshape(-1, len(names))
    model = fit(votes, np.array([row["n"] for row in patterns], float))
    values = [(*map(int, v), float(p)) for v, p in zip(votes, posterior(votes, model))]
    schema = ", ".join(f"{n} int" for n in names) + ", p_good double"
    table = F.broadcast(spark.createDataFrame(values, schema))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.join(table, names, "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("p_good") >= KEPT_FROM))
    )
