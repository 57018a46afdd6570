"""SimHash, line spread and decontamination against brute force."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from platterwatch.llm import decontaminate, lines, simhash
from platterwatch.llm.graph import components
from platterwatch.llm.texts import PLAIN, Words


def plain_fingerprint(text, shingle=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, distance=2):
    root = list(range(len(fingerprints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(fingerprints)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(k) for k in range(len(fingerprints))]


def flipped(value, rng, n):
    for bit in rng.sample(range(64), n):
        value ^= 1 << bit
    return value


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.fixture
def crowd():
    """Fingerprints in chains and dense groups, and single ones."""
    rng = random.Random(3)
    out = [rng.getrandbits(64) for _ in range(150)]
    for base in out[:4]:
        out += [flipped(base, rng, rng.choice([1, 1, 2, 3])) for _ in range(60)]
    chain = rng.getrandbits(64)
    for _ in range(25):
        chain = flipped(chain, rng, 2)
        out.append(chain)
    return sorted(set(out))


@pytest.mark.parametrize("cell", [256, 2])
@pytest.mark.parametrize("distance", [0, 2])
def test_links_give_the_components_of_all_pairs(spark, crowd, cell, distance):
    table = spark.createDataFrame([(signed(x),) for x in crowd], "fp bigint")
    found = simhash.links(table, distance, cell)
    number = {signed(x): k for k, x in enumerate(crowd)}
    pairs = {(number[r["a"]], number[r["b"]]) for r in found.collect()}
    root = list(range(len(crowd)))
    for _ in range(len(crowd)):
        new = list(root)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == root:
            break
        root = new
    want = plain_components(crowd, distance)
    assert len(set(root)) == len(set(want)) == len(set(zip(root, want)))


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 180)] + [(200, 200)]
    rng.shuffle(edges)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 180)}, 200: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_rows_equal_brute_force(odd_documents):
    rows = odd_documents.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, c in zip(rows, root):
        ids = least.setdefault(c, [])
        ids += [] if r["doc_id"] is None else [r["doc_id"]]
    want = [(r["doc_id"], f"{p:016x}", min(least[c], default=None)) for r, p, c in zip(rows, prints, root)]
    found = [tuple(r) for r in simhash.components_of(odd_documents).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_simhash_of_the_test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, c in zip(rows, root):
        least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    want = {(r["doc_id"], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, root)}
    assert {tuple(r) for r in simhash.components_of(docs).collect()} == want


def test_one_row_of_each_group_stays(odd_documents):
    kept = simhash.one_of_each(odd_documents)
    assert kept.schema == odd_documents.schema
    rows = kept.collect()
    assert len({plain_fingerprint(r["text"]) for r in rows}) == len(rows)
    assert [r["doc_id"] for r in rows if not (r["text"] or "").strip()] == [2]
    assert sum(r["text"] == "plain words in a short text" for r in rows) == 1
    assert any(r["doc_id"] is None for r in rows)


def test_simhash_of_an_empty_table(empty_documents):
    assert simhash.components_of(empty_documents).count() == 0
    assert simhash.one_of_each(empty_documents).count() == 0


BOILER = "Read more about this on our other pages"


def test_line_spread_counts_sites_and_keeps_the_first(documents):
    rows = [(k, f"own text of number {k} and its words\n  {BOILER} \nend", "en", f"s{k % 6}") for k in range(12)]
    rows += [(50 + k, "a line that stands on four sites only", "en", f"s{k}") for k in range(4)]
    rows += [(70 + k, "this line stands on one site many times", "en", "s1") for k in range(9)]
    rows += [(90 + k, "short one", "en", f"s{k}") for k in range(9)]
    docs = documents(rows)
    found = {r["doc_id"]: (r["text"], r["gone"]) for r in lines.without_boilerplate(docs, removed="gone").collect()}
    assert found[0] == (rows[0][1], 0)
    for k in range(1, 12):
        assert found[k] == (f"own text of number {k} and its words\nend", 1)
    assert all(found[r[0]] == (r[1], 0) for r in rows[12:])


def test_line_spread_with_many_sites(documents):
    """Far from the threshold the sketch decides, near it the exact count."""
    rows = [(k, BOILER, None, f"site {k}") for k in range(400)]
    rows += [(1000 + k, "a second line that has many sites", None, f"site {k}") for k in range(99)]
    found = lines.without_boilerplate(documents(rows), sites=100, removed="gone")
    assert found.where("gone > 0").count() == 399
    assert found.where("gone > 0 and doc_id >= 1000").count() == 0


def test_line_spread_of_a_text_of_many_lines(documents):
    """What is kept of 60,000 lines is put together in proportion to their number."""
    boiler = "this line stands on many of the sites"
    rows = [(k, boiler, None, f"s{k}") for k in range(8)]
    own = [f"line number {k} of the text itself" for k in range(60_000)]
    rows.append((9, "\n".join(boiler if k % 3 == 0 else x for k, x in enumerate(own)), None, "s9"))
    found = lines.without_boilerplate(documents(rows), removed="n").where("doc_id = 9").first()
    assert found["n"] == 20_000
    assert found["text"] == "\n".join(x for k, x in enumerate(own) if k % 3)


@pytest.mark.parametrize("drops", [[0], [4], [0, 1, 2, 3, 4], [1, 3], [3, 1]])
def test_lines_between_dropped_ones(spark, drops):
    table = spark.createDataFrame([(["a", "", "c", "d", "e"], drops)], "parts array<string>, drop array<int>")
    want = "\n".join(x for k, x in enumerate(["a", "", "c", "d", "e"]) if k not in drops)
    assert table.select(lines.without("parts", "drop")).first()[0] == want


def test_line_spread_odd_rows(odd_documents, empty_documents):
    found = lines.without_boilerplate(odd_documents)
    assert found.schema == odd_documents.schema
    assert sorted(map(repr, found.collect())) == sorted(map(repr, odd_documents.collect()))
    assert lines.without_boilerplate(empty_documents).count() == 0


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def plain_overlaps(text, item):
    """All diagonals, all stretches."""
    a = Words([text.lower().encode()], PLAIN).hashes().tolist()
    b = Words([item.lower().encode()], PLAIN).hashes().tolist()
    least = min(len(b), decontaminate.OVERLAP)
    for d in range(-len(b), len(a)):
        equal = [a[d + k] == b[k] for k in range(len(b)) if 0 <= d + k < len(a)]
        for i in range(len(equal)):
            for j in range(i + least, len(equal) + 1):
                if 10 * sum(equal[i:j]) >= 8 * (j - i):
                    return True
    return False


def test_decontamination_finds_changed_passages(spark, documents):
    words, rng = ITEM.split(), random.Random(2)
    fill = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    rows = []
    for k in range(80):
        changed = [w if rng.random() > 0.03 * (k % 8) else "other" for w in words]
        begin, end = rng.choice([(0, 20), (0, 14), (5, 20), (3, 9)])
        rows.append((k, f"{fill(30)} {', '.join(changed[begin:end]).upper()}. {fill(20)}"))
    bench = spark.createDataFrame([(9, ITEM), (10, ITEM.title()), (11, fill(30)), (12, None), (None, ""), (13, "of")], "item_id bigint, text string")
    found = decontaminate.contaminated(spark, documents(rows), bench).collect()
    assert {r["item_id"] for r in found} == {9, 10}  # the same words
    assert len(found) == 2 * len({r["doc_id"] for r in found})
    got = {r["doc_id"] for r in found}
    want = {k for k, text in rows if plain_overlaps(text, ITEM)}
    assert got <= want and len(got) >= 0.97 * len(want)
    for r in found:
        if r["n_equal"] == r["n_words"] == 20:
            assert r["first_word"] == 30 and r["similarity"] == 1.0
    clean = decontaminate.clean(spark, documents(rows), bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(80)) - got


@pytest.mark.parametrize("n", range(3, 21))
def test_masks_hit_every_allowed_placement(n):
    """Whichever words of an item differ, up to a fifth of them, some mask sees only equal ones."""
    differ = n - math.ceil(0.8 * n - 1e-9)
    masks = decontaminate.short_masks(n) if n < decontaminate.LONG else decontaminate.MASKS
    seen = [
        {at + k for k, c in enumerate(mask) if c == "1"} for mask in masks for at in range(n - len(mask) + 1)
    ]
    for changed in combinations(range(n), differ):
        assert any(places.isdisjoint(changed) for places in seen), changed
    assert min(map(len, seen)) >= min(n, 3)


def test_short_items_with_changed_words(spark, documents):
    rng = random.Random(6)
    items = [(k, " ".join(f"v{rng.randrange(10**6)}" for _ in range(3 + k % 9))) for k in range(45)]
    rows, want = [], set()
    for k, item in items:
        words = item.split()
        for extra in (0, 1):
            differ = len(words) - math.ceil(0.8 * len(words)) + extra
            for at in rng.sample(range(len(words)), differ):
                words[at] = "changed"
            rows.append((2 * k + extra, f"some words {' '.join(words)} more words"))
            words = item.split()
        want.add((2 * k, k))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(spark, documents(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want


@pytest.mark.parametrize("most", [decontaminate.BLOCK_WORDS, 12])
def test_every_item_id_is_reported(spark, documents, most):
    items = [(k, f"one two three four {'five' if k % 2 else 'six'}{',' * k}") for k in range(8)] + [(3, "one two three four five"), (None, "ONE two three four five")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([(1, "then one two three four five and"), (2, "nothing")])
    found = decontaminate.contaminated(spark, docs, bench, most).collect()
    # five and six are one changed word of five apart
    assert sorted((str(r["item_id"]), r["n_equal"]) for r in found) == sorted(
        [*((str(k), 5 if k % 2 else 4) for k in range(8)), ("None", 5)]
    )
    assert [r["doc_id"] for r in decontaminate.clean(spark, docs, bench, most).collect()] == [2]


def test_blocks_of_the_benchmark_give_the_same(spark, documents):
    rng = random.Random(7)
    items = [" ".join(f"v{rng.randrange(900)}" for _ in range(rng.choice([4, 8, 20, 40]))) for _ in range(60)]
    rows = [(k, f"start of it {items[k]} then {items[(k * 7) % 60]} end of it") for k in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    one = {tuple(r) for r in decontaminate.contaminated(spark, documents(rows), bench).collect()}
    many = {tuple(r) for r in decontaminate.contaminated(spark, documents(rows), bench, 100).collect()}
    assert one == many and {(k, k) for k in range(60)} <= {r[:2] for r in one}
    docs = documents(rows)
    assert decontaminate.clean(spark, docs, bench, 100).count() == 0


def test_longest_stretch_equals_all_stretches():
    rng = random.Random(4)
    for _ in range(300):
        equal = np.array([rng.random() < 0.75 for _ in range(rng.randint(0, 25))], bool)
        _, length, same = decontaminate.longest_stretch(equal)
        every = [j - i for i in range(len(equal)) for j in range(i + 1, len(equal) + 1) if 10 * equal[i:j].sum() >= 8 * (j - i)]
        assert length == max(every, default=0) and same >= 0.8 * length - 1e-9


def test_decontamination_odd_rows(spark, odd_documents, empty_documents):
    bench = spark.createDataFrame([(1, "plain words in a short text")], "item_id bigint, text string")
    found = decontaminate.contaminated(spark, odd_documents, bench)
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(1, 1)] * 2
    assert decontaminate.clean(spark, odd_documents, bench).count() == odd_documents.count() - 2
    assert decontaminate.clean(spark, odd_documents, bench).schema == odd_documents.schema
    assert decontaminate.contaminated(spark, empty_documents, bench).count() == 0
    assert decontaminate.contaminated(spark, odd_documents, bench.limit(0)).count() == 0
    assert decontaminate.clean(spark, odd_documents, bench.limit(0)).count() == odd_documents.count()
    assert found.select(F.max("similarity")).first()[0] == 1.0
