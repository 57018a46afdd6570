"""Near vectors, vector codes and ranked search against brute force."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest

from platterwatch.llm import near_vectors, ranked_search, vector_codes

VECTORS = "vec_id bigint, embedding array<float>, label int, node int, n string, Part int, links int, code int"


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2, 3, 4) for r in rows], VECTORS)


@pytest.fixture
def odd_vectors():
    """Clusters around the threshold, copies, and everything that is no vector."""
    rng = np.random.default_rng(5)
    out = []
    for center in rng.normal(size=(12, 16)):
        for spread in rng.uniform(0.0, 0.5, 14):
            out.append(center / np.linalg.norm(center) + spread * rng.normal(size=16) / 4)
    rows = [(k, [float(np.float32(x)) for x in v], k % 3) for k, v in enumerate(out)]
    rows += [(500 + k, rows[3][1], None) for k in range(40)]  # copies
    rows += [(600, [x * 1e30 for x in rows[3][1]], 1), (601, [x * 1e-30 for x in rows[3][1]], 1)]
    rows += [rows[7], rows[7], (None, rows[7][1], 1), (None, [-x for x in rows[9][1]], 2)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 16, 1), (703, [None] + [1.0] * 15, 1)]
    rows += [(704, [float("nan")] * 16, 1), (705, [float("inf")] + [1.0] * 15, None), (None, None, None)]
    rows += [(706, rows[3][1][:8], 1), (707, rows[3][1][:8], 1), (708, [-0.0] * 15 + [1.0], 1)]
    return rows + [(709, [0.0] * 15 + [1.0], 1)]


def plain_links(rows, threshold=0.95):
    n = len(rows)
    unit = []
    for _, v, _ in rows:
        good = v is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        size = math.sqrt(math.fsum((x / max(map(abs, v))) ** 2 for x in v)) * max(map(abs, v)) if good else 0
        unit.append([x / size for x in v] if good else None)
    near = [
        {
            j for j in range(n)
            if j != i and unit[i] and unit[j] and len(unit[i]) == len(unit[j])
            and math.fsum(x * y for x, y in zip(unit[i], unit[j])) >= threshold
        }
        for i in range(n)
    ]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return out


@pytest.mark.parametrize("groups", [1, 5])
def test_near_vectors_are_those_of_all_pairs(spark, odd_vectors, groups):
    found = near_vectors.near_vectors(vector_table(spark, odd_vectors), groups=groups).collect()
    want = plain_links([(i, v and [float(np.float32(x)) if x is not None else None for x in v], k) for i, v, k in odd_vectors])
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    assert 50 < sum(r[1] > 0 for r in want) < len(want) - 20


def test_bounds_are_never_below_the_cosine(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = (near_vectors.Side(rng.normal(size=(200, 48)) ** 3) for _ in range(2))
    bound = a.rows(0.0) @ b.columns() * (a.scale[:, None] * b.scale[None, :])
    cosine = a.unit @ b.unit.T
    assert (bound >= cosine).all()
    assert (bound - cosine).max() < 0.1
    assert a.codes.dtype == np.int8


def test_tiles_give_all_links_of_dense_and_sparse_parts(monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE", 32)
    monkeypatch.setattr(near_vectors, "PAIRS", 7)
    rng = np.random.default_rng(2)
    near = rng.normal(size=12) + 0.05 * rng.normal(size=(90, 12))
    side = near_vectors.Side(np.concatenate([near, rng.normal(size=(100, 12))]))
    found = {(i, j) for r, c in near_vectors.tiles(side, None, 0.95) for i, j in zip(r.tolist(), c.tolist())}
    i, j = np.nonzero(np.triu(side.unit @ side.unit.T >= 0.95, 1))
    assert found == set(zip(i.tolist(), j.tolist()))


def test_several_pairs_of_groups_in_a_task(spark, odd_vectors, monkeypatch):
    table = vector_table(spark, odd_vectors)
    whole = near_vectors.near_vectors(table, groups=5).collect()
    monkeypatch.setattr(near_vectors, "MOST_TASKS", 3)
    assert sorted(near_vectors.near_vectors(table, groups=5).collect(), key=str) == sorted(whole, key=str)


def test_no_vectors(spark):
    empty = vector_table(spark, [(1, [1.0], 1)]).limit(0)
    assert near_vectors.near_vectors(empty).collect() == []
    assert vector_codes.vector_codes(empty).collect() == []


def plain_codes(rows, rounds=6, entries=16, parts=8):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = max(-(-max(len(r[1]) for r in kept) // parts), 1)
    ints = []
    for _, v, _ in kept:
        whole = [max(-(1 << 24), min(1 << 24, math.floor(4096 * x))) for x in v]
        ints.append(whole + [0] * (parts * size - len(whole)))
    cut = [[x[p * size : (p + 1) * size] for p in range(parts)] for x in ints]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        out = []
        for x in cut:
            row = []
            for p in range(parts):
                apart = [sum((a - b) ** 2 for a, b in zip(x[p], e)) for e in books[p]]
                row.append((apart.index(min(apart)), min(apart)))
            out.append(row)
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p] for x, c in zip(cut, codes) if c[p][0] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    codes = assign()
    error = [sum(c[1] for c in row) for row in codes]
    label = collections.Counter()
    for r, e in zip(kept, error):
        label[r[2]] += e
    text = ",".join(str(x) for p in books for e in p for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [
        (r[0], "".join(f"{c[0]:02x}" for c in row), e, label[r[2]], digest)
        for r, row, e in zip(kept, codes, error)
    ]


def test_vector_codes_are_those_of_whole_number_arithmetic(spark, odd_vectors):
    rows = [
        (i, v and [float(np.float32(x)) if x is not None else None for x in v], k) for i, v, k in odd_vectors
    ]
    found = vector_codes.vector_codes(vector_table(spark, odd_vectors)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_codes(rows), key=key)


def test_few_vectors_make_few_entries(spark):
    rows = [(k, [k / 7, -k / 3, 0.25], None) for k in range(5)]
    exact = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows]
    found = vector_codes.vector_codes(vector_table(spark, rows)).collect()
    assert sorted(map(tuple, found)) == sorted(plain_codes(exact))


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(-(1 << 24), 1 << 24, (40, 64), endpoint=True) for _ in range(2))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert vector_codes.products(a, b).tolist() == want
    low, high = vector_codes.limbs(a)
    assert low.max() < 1 << 13 and abs(high).max() <= 1 << 11


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_ranking(docs, items, top=20):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n, total = len(bags), sum(x[2] for x in bags)
    df = collections.Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in bags:
            m = 75 + 25 * size * n // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, k in collections.Counter(terms(text)).items() if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:top], 1)]
    return out


@pytest.fixture
def corpus():
    """Words of very different frequency, copies, ties, and texts without a term."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(300)] + ["été", "日本", "Ünï", "X1", "a"]
    share = 1 / np.arange(1, len(words) + 1)
    text = lambda n: ", ".join(rng.choice(words, n, p=share / share.sum()))
    docs = [(k, text(rng.integers(1, 60))) for k in range(400)]
    docs += [(1000 + k, docs[5][1].upper().replace("É", "é").replace("Ü", "Ü")) for k in range(60)]
    docs += [(None, docs[5][1]), (None, docs[6][1]), docs[5], docs[5], (7, docs[5][1]), (2000, "only one")]
    docs += [(2001, None), (2002, ""), (2003, " .,;\n"), (2004, text(9000)), (2005, "w1 " * 5000)]
    items = [(k, text(12)) for k in range(30)] + [(40, docs[5][1]), (41, "w0 w0 w0"), (42, "nowhere")]
    return docs, items + [(43, None), (44, ""), (None, "w3 w4"), (1, "w3 w5 日本"), (45, text(2000))]


@pytest.mark.parametrize("shards, blocks", [(None, None), (1, 1), (5, 3)])
def test_ranked_search_gives_what_scoring_all_documents_gives(spark, corpus, shards, blocks):
    docs, items = corpus
    table = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id bigint, text string, id int, Shard string")
    asked = spark.createDataFrame([(*x, 2, 3) for x in items], "item_id bigint, text string, item int, term int")
    found = ranked_search.ranked(table, asked, shards=shards, blocks=blocks).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_ranking(docs, items), key=key)


def test_several_shards_in_a_task(spark, corpus, monkeypatch):
    docs = spark.createDataFrame(corpus[0], "doc_id bigint, text string")
    items = spark.createDataFrame(corpus[1], "item_id bigint, text string")
    whole = ranked_search.ranked(docs, items, shards=7, blocks=3).collect()
    monkeypatch.setattr(ranked_search, "MOST_TASKS", 2)
    few = ranked_search.ranked(docs, items, shards=7, blocks=3).collect()
    assert sorted(few, key=str) == sorted(whole, key=str) and whole


def test_ranked_search_without_documents_or_queries(spark, documents, empty_documents):
    asked = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert ranked_search.ranked(empty_documents, asked).collect() == []
    assert ranked_search.ranked(documents([(1, "some words")]), asked.limit(0)).collect() == []


def test_ranked_search_of_odd_documents(spark, odd_documents):
    asked = spark.createDataFrame([(1, "a short TEXT of the word"), (2, "日本 x")], "item_id bigint, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    found = ranked_search.ranked(odd_documents, asked).collect()
    key = lambda r: tuple(str(x) for x in r)
    want = plain_ranking(docs, [(1, "a short TEXT of the word"), (2, "日本 x")])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_sparse_table_finds_the_largest_of_every_interval():
    values = np.random.default_rng(4).integers(0, 9, 70)
    table = ranked_search.Largest(values, 70)
    begin, end = np.array([(a, b) for a in range(70) for b in range(a + 1, 71)]).T
    assert [values[a:b].max() for a, b in zip(begin, end)] == values[table.place(begin, end)].tolist()


def test_bitmap_lets_all_its_terms_through(spark):
    hashes = np.random.default_rng(6).integers(-(2**63), 2**63 - 1, 500)
    bits = ranked_search.bitmap(spark.createDataFrame([(int(x),) for x in hashes], "term bigint"))
    slot = ranked_search.slot_of(hashes.view(np.uint64))
    assert ((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1).all()
    assert np.bitwise_count(bits).sum() == len(set(slot.tolist()))
