"""Byte-level BPE, token shards and the perfect hash against the public libraries and round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from platterwatch.llm import bpe, texts, token_shards
from platterwatch.llm.mphf import PerfectHash
from platterwatch.sources.storage import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def own_ids(text):
    ids, _ = bpe.load(RANKS, public_tokenizers.PATTERN).encode([text])
    return ids.tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_bpe_equals_the_library(text):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    global _library
    try:
        library = _library
    except NameError:
        library = _library = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    assert own_ids(text) == library.encode_ordinary(text)


@pytest.mark.parametrize(
    "text",
    ["", "a", "aaaaaaaaaaaaaaaaaaaa", "A" * 3000, "ab" * 2000, "it's they'll  two  spaces\n\n x", "é" * 700],
)
def test_bpe_long_and_repeated_pieces(reference, text):
    assert own_ids(text) == reference.encode_ordinary(text)


def test_long_pieces_merge_as_matrix_rows_do():
    own, rng = bpe.load(RANKS, public_tokenizers.PATTERN), random.Random(5)
    for _ in range(60):
        data = bytes(rng.choice(b"aabbcdehtin") for _ in range(rng.randint(2, 200)))
        rows = own.of_byte[np.frombuffer(data, np.uint8)][None, :].copy()
        out, count = own.merge_rows(rows)
        assert own.merge_long(data) == out[0, : count[0]].tolist()


def test_pair_table_finds_every_pair_and_no_other():
    own = bpe.load(RANKS, public_tokenizers.PATTERN)
    tokens = list(own.ranks.items())[256:6000]
    split = [(own.ranks[t[:1]], own.ranks[t[1:]], r) for t, r in tokens if t[1:] in own.ranks]
    left, right, rank = np.array(split, np.int32).T
    assert own.pairs.find(left, right).tolist() == rank.tolist()
    wrong = own.pairs.find(np.arange(5000), np.full(5000, 50_000))
    want = [own.ranks.get(own.tokens[k] + own.tokens[50_000], int(bpe.NONE)) for k in range(5000)]
    assert wrong.tolist() == want
    assert own.pairs.find(np.array([-1, 5]), np.array([5, -1])).tolist() == [bpe.NONE] * 2


def test_bpe_query_digests(odd_documents, reference):
    found = bpe.encode_and_decode(odd_documents, RANKS, public_tokenizers.PATTERN, "doc_id", "text")
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        ids = reference.encode_ordinary(row["text"] or "")
        raw = np.array(ids, "<u4").tobytes()
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_bpe_of_an_empty_table(empty_documents):
    assert bpe.encode_and_decode(empty_documents, RANKS, public_tokenizers.PATTERN, "doc_id").count() == 0


def test_token_ids_are_the_arrays(documents, reference):
    docs = documents([(1, "some words"), (2, None)])
    rows = {r["doc_id"]: r["ids"] for r in bpe.token_ids(docs, RANKS, public_tokenizers.PATTERN, "doc_id").collect()}
    assert np.frombuffer(rows[1], "<u4").tolist() == reference.encode_ordinary("some words")
    assert len(rows[2]) == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_word_encoder_equals_the_library(parts):
    plain = Tokenizer.from_file(WORDS)
    ids, sizes = token_shards.encoder(WORDS).encode(parts, 1) if parts else ([], [])
    edge = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    for k, text in enumerate(parts):
        want = plain.encode(text, add_special_tokens=False).ids + [1]
        assert list(ids[edge[k] : edge[k + 1]]) == want


def test_word_encoder_on_marks_and_special_strings():
    plain, own = Tokenizer.from_file(WORDS), token_shards.encoder(WORDS)
    for text in ("It's we'll ÉTÉ, À-ÿİ!", "a<|endoftext|>b <|startoftext|>", "x\ty z", "é ́e"):
        ids, _ = own.encode([text], 1)
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(2**40, n, replace=False).astype(np.int64) - 2**39
    found = PerfectHash.build(keys)
    assert sorted(found.find(keys).tolist()) == list(range(n))
    assert 64 * len(found.words) <= 6 * n + 256


@pytest.mark.parametrize("shards", [None, 3])
def test_shards_round_trip(odd_documents, shards):
    plain = Tokenizer.from_file(WORDS)
    spark = odd_documents.sparkSession
    rows = token_shards.round_trip(odd_documents, WORDS, shards).collect()
    assert len(rows) == odd_documents.count()
    named = {r["doc_id"] for r in rows if r["doc_id"] is not None}
    indexed = [r["doc_id"] for r in rows if r["in_index"]]
    assert set(indexed) == named and len(indexed) <= len(named) + (shards or 1) - 1
    rows.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]
    want = sorted(
        (r["doc_id"] or 0, zlib.crc32(np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()))
        for r in odd_documents.select("doc_id", "text").collect()
    )
    assert sorted((r["doc_id"] or 0, r["ids_crc32"]) for r in rows) == want
    assert spark is not None


def test_lookup_of_known_and_foreign_keys(spark, documents):
    docs = documents([(k * 7, f"text number {k}") for k in range(500)])
    folder = scratch_path(spark, "shards")
    token_shards.write_shards(docs, folder, WORDS)
    plain = Tokenizer.from_file(WORDS)
    for k in (0, 3, 250, 499):
        (ids,) = token_shards.lookup(spark, folder, k * 7)
        assert ids.tolist() == plain.encode(f"text number {k}", add_special_tokens=False).ids + [1]
    assert all(token_shards.lookup(spark, folder, k) == [] for k in (-1, 1, 100, 4000))
    assert sum(r["n_docs"] for r in token_shards.manifest(spark, folder)) == 500
    assert len(token_shards.manifest(spark, folder, 7)) == 1


def damaged(spark, folder, change):
    """Change the bytes of every index file; the rows that are read afterwards."""
    for row in token_shards.manifest(spark, folder):
        shard = token_shards.Shard(f"file:{folder.replace('file:', '')}", row["payload"], row["index"])
        path = f"{folder.replace('file:', '')}/{row['index']}"
        data = bytearray(open(path, "rb").read())
        change(data, shard)
        open(path, "wb").write(data)
    return token_shards.read_shards(spark, folder)


def test_results_come_through_the_index(spark, documents):
    docs = documents([(k, f"text {'word ' * k}") for k in range(300)])
    contract = ("start", "n_tokens", "ids_crc32")

    def written():
        folder = scratch_path(spark, "shards")
        token_shards.write_shards(docs, folder, WORDS, shards=2)
        return folder

    def swap(data, shard):
        """Exchange the places of two slots."""
        slots = np.frombuffer(data, token_shards.SLOT, int(shard.head["n_keys"]), shard.slots)
        for name in ("begin", "size"):
            slots[name][[0, 1]] = slots[name][[1, 0]]

    def blank(data, shard):
        data[shard.tables : shard.slots] = bytes(shard.slots - shard.tables)

    folder = written()
    good = {r["doc_id"]: [r[c] for c in contract] for r in token_shards.read_shards(spark, folder).collect()}
    bad = {r["doc_id"]: [r[c] for c in contract] for r in damaged(spark, folder, swap).collect()}
    assert sum(bad[k] != good[k] for k in good) == 4
    with pytest.raises(Exception, match="does not lead to a key"):
        damaged(spark, written(), blank).collect()


def test_a_lookup_reads_a_constant_amount(spark, documents, monkeypatch):
    read = []
    for n in (50, 5000):
        folder = scratch_path(spark, "shards")
        token_shards.write_shards(documents([(k, "some words") for k in range(n)]), folder, WORDS, shards=1)
        row = token_shards.manifest(spark, folder)[0]
        shard = token_shards.Shard(token_shards.qualified(spark, folder), row["payload"], row["index"])
        sizes, plain = [], shard.read
        shard.read = lambda at, k, kind: sizes.append(k * np.dtype(kind).itemsize) or plain(at, k, kind)
        for key in range(0, n, n // 50):
            assert len(shard.find(key)) == 3
        read.append(sum(sizes) / 50)
    assert max(read) < 120  # bytes of index, on average


def test_number_of_shards_follows_the_bytes(spark, documents):
    docs = documents([(k, "x" * 1000) for k in range(64)])
    assert token_shards.count_shards(docs) == 1
    assert token_shards.count_shards(docs, 1000) == 64
    folder = scratch_path(spark, "shards")
    same = documents([(1, "the same words")] * 400)
    token_shards.write_shards(same, folder, WORDS, shards=4)
    assert [r["n_docs"] > 40 for r in token_shards.manifest(spark, folder)] == [True] * 4


def test_word_encoder_forgets_the_half_used_least(monkeypatch):
    monkeypatch.setattr(token_shards, "CACHED_PIECES", 40)
    own, plain = token_shards.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    for k in range(30):
        text = f"common words and n{k} x{k * k} It's É{k} ,.;: 12ab"
        ids, _ = own.encode([text, b""], 1)
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1, 1]
    assert len(own.keys) <= 60


def test_shards_of_an_empty_table(empty_documents):
    assert token_shards.round_trip(empty_documents, WORDS).count() == 0


@settings(deadline=None)
@given(st.lists(st.binary(max_size=30), max_size=6))
def test_words_are_those_of_the_pattern(data):
    import re

    words = texts.Words(data)
    want = [re.findall(rb"[^\x20\x09-\x0D]+", x) for x in data]
    assert words.count.tolist() == [len(x) for x in want]
    flat = [x for row in want for x in row]
    assert [words.data[a:b].tobytes() for a, b in zip(words.at, words.end)] == flat
    hashes = words.hashes().tolist()
    assert len(set(hashes)) == len(set(flat))
    assert len({(h, w) for h, w in zip(hashes, flat)}) == len(set(flat))


def test_runs_cover_everything_once():
    sizes = [5, 1, 1, 9, 0, 0, 3]
    parts = list(texts.runs(sizes, 4))
    assert [k for p in parts for k in range(p.start, p.stop)] == list(range(len(sizes)))
    assert list(texts.runs([], 4)) == []
