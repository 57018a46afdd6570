"""Language, quality classifier and quality rules: gradients, brute force and held-out accuracy."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from platterwatch.llm import boosting, catalog, gru, language, quality, rules

SF = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in gru.start(3, 3, 1).items()}
    x = rng.integers(0, 6, (5, 4))
    x[3:, 1] = gru.PAD
    y = np.array([0, 1, 2, 1])
    _, g = gru.gradients(w, x, y)
    for name in w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w[name].shape)
            if name[0] in "AB":
                at = (int(rng.integers(0, 6)), at[1])
            old, step, losses = w[name][at], 1e-2, []
            for sign in (1, -1):
                w[name][at] = old + sign * step
                losses.append(gru.gradients(w, x, y)[0])
            w[name][at] = old
            assert g[name][at] == pytest.approx((losses[0] - losses[1]) / (2 * step), abs=2e-3)


def test_every_position_sees_both_sides():
    w = gru.start(8, 4, 2)
    x = np.full((10, 1), 97)
    base = gru.label_positions(w, x)
    for place in (0, 9):
        other = x.copy()
        other[place] = 120
        changed = np.abs(gru.label_positions(w, other) - base).max(axis=(1, 2))
        assert (changed > 0).sum() > 5
    assert np.allclose(base.sum(-1), 1, atol=1e-5)


def plain_states(w, side, data):
    """One window, step by step and unit by unit."""
    hidden, h, out = len(w[f"U{side}"]), None, {}
    h = [0.0] * hidden
    for t in range(len(data)) if side == "f" else reversed(range(len(data))):
        x = data[t]
        gate = lambda j: 1 / (1 + math.exp(-(w[f"A{side}"][x][j] + sum(h[i] * w[f"U{side}"][i][j] for i in range(hidden)))))
        new = []
        for j in range(hidden):
            z, r = gate(j), gate(hidden + j)
            n = math.tanh(w[f"B{side}"][x][j] + r * sum(h[i] * w[f"V{side}"][i][j] for i in range(hidden)))
            new.append(n + z * (h[j] - n))
        h = out[t] = new
    return [out[t] for t in range(len(data))]


def test_label_positions_equal_a_step_by_step_loop():
    w = {k: v.astype(float) for k, v in gru.start(3, 4, 9).items()}
    x = np.random.default_rng(2).integers(90, 120, (7, 3))
    x[5:, 2] = gru.PAD
    found = gru.label_positions(w, x)
    for b in range(3):
        data = x[:, b].tolist()
        for t, (f, g) in enumerate(zip(plain_states(w, "f", data), plain_states(w, "b", data))):
            logits = [
                w["c"][k] + sum(f[i] * w["Wf"][i][k] + g[i] * w["Wb"][i][k] for i in range(3)) for k in range(4)
            ]
            total = sum(map(math.exp, logits))
            assert np.allclose(found[t, b], [math.exp(v) / total for v in logits], atol=1e-5)


def test_rare_languages_are_learned_and_texts_stay_in_their_tasks(spark, documents):
    rows = [(k, f"text number {k}", "common" if k % 50 else "rare") for k in range(400)]
    rows += [(3, "text number 3", "common")] * 30 + [(None, "no id", "common"), (900, None, "rare")]
    docs = documents(rows)
    chosen = language.sample(docs, F.lit(True), 5)
    got = Counter((r["lang"]) for r in chosen.select("lang", "doc_id").distinct().collect())
    assert got == {"common": 5, "rare": 5}
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange" in x or "Window" in x]
    assert exchanges and not any("text" in x for x in exchanges)
    labels, weights = language.fit(docs, F.lit(True), most=5)
    assert labels == ["common", "rare"] and weights is not None


def test_pooling_is_the_mean_over_letters_in_any_grouping():
    w = gru.start(8, 4, 2)
    texts = [b"some words here 123", b"", b"12 34", "été".encode() * 60, b"z" * 64]
    together = language.pooled(w, texts)
    for text, row in zip(texts, together):
        assert np.allclose(language.pooled(w, [text])[0], row, atol=1e-5)
    assert together[1].tolist() == together[2].tolist() == [0, 0, 0, 0]
    assert np.allclose(together[[0, 3, 4]].sum(1), 1, atol=1e-4)


def test_language_held_out_accuracy(spark):
    docs = catalog.table(spark, SF, "documents")
    found = catalog.op5_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held_out = found.where("held_out and lang is not null").select("lang", "lang_pred", "score").collect()
    assert len(held_out) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in held_out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in held_out)


def test_language_odd_rows(odd_documents, empty_documents, spark):
    labels, weights = ["a", "b"], gru.start(8, 2, 1)
    rows = language.predict(odd_documents, labels, weights, "doc_id", "text").collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] == 0) if not letters else (0.5 <= r["score"] <= 1)
    assert language.fit(empty_documents, F.lit(True)) == ([], None)
    none = language.predict(odd_documents, [], None, "doc_id").collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert language.predict(empty_documents, labels, weights, "doc_id").count() == 0
    only_null = odd_documents.where("lang is null")
    assert language.fit(only_null, F.lit(True)) == ([], None)


def test_trees_walk_equals_a_walk_row_by_row():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = boosting.fit(x, y, trees=20, depth=3)
    for row, raw in zip(x[:50], model.raw(x[:50])):
        total = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node]
        assert raw == pytest.approx(total)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.95


def test_trees_of_nothing_and_of_one_class():
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    one = boosting.fit(np.zeros((9, 3)), np.ones(9)).probability(np.zeros((1, 3)))
    assert 0.9 < one[0] < 1


def test_quality_held_out(spark):
    labels = catalog.table(spark, SF, "labels")
    rows = catalog.op6_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_odd_rows(spark, odd_documents, empty_documents):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (8, 0, 1), (6, 0, 0), (5, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    model = quality.fit(odd_documents, labels, F.lit(True))
    rows = quality.scored(odd_documents, model, "doc_id").collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    good = quality.good_documents(odd_documents, model)
    assert good.schema == odd_documents.schema
    assert good.count() == sum(r["score"] >= quality.THRESHOLD for r in rows)
    nothing = quality.fit(empty_documents, labels, F.lit(True))
    assert {r["score"] for r in quality.scored(odd_documents, nothing, "doc_id").collect()} == {0.5}
    assert quality.scored(empty_documents, model, "doc_id").count() == 0
    assert quality.fit(odd_documents, labels.limit(0), F.lit(True)).base == 0


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {k + j for k, w in enumerate(windows) if w in twice for j in range(3)}
    filled = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(filled) - len(set(filled)),
        "n_repeat_words": len(repeated), "n_lines": len(filled), "n_upper": len(re.findall("[A-Z]", text)),
        "n_letters": len(re.findall(r"[A-Za-z\u0080-\U0010ffff]", text)),
        "n_top_word": max(Counter(words).values(), default=0),
    }


def plain_votes(c):
    """By shares, where there is something to divide by; a share of nothing is within every upper limit."""
    words, lines, letters, chars = c["n_words"], c["n_lines"], c["n_letters"], c["word_chars"]
    share = lambda a, b: Fraction(a, b) if b else Fraction(0)
    tests = {
        "length": (words < 20, 100 <= words <= 100_000),
        "word_size": (words and not 3 <= share(chars, words) <= 7, not words or 4 <= share(chars, words) <= 6),
        "symbols": (c["n_symbols"] > words / 10, c["n_symbols"] <= words / 200),
        "dup_lines": (share(c["n_dup_lines"], lines) > Fraction(3, 10), c["n_dup_lines"] == 0 and lines >= 3),
        "repeats": (share(c["n_repeat_words"], words) > Fraction(1, 5), share(c["n_repeat_words"], words) <= Fraction(1, 100)),
        "upper": (share(c["n_upper"], letters) > Fraction(3, 10), 0 < share(c["n_upper"], letters) <= Fraction(1, 20)),
        "letters": (chars and share(letters, chars) < Fraction(9, 10), not chars or share(letters, chars) >= Fraction(19, 20)),
        "top_word": (share(c["n_top_word"], words) > Fraction(1, 5), share(c["n_top_word"], words) <= Fraction(2, 25)),
    }
    return {k: -1 if bad else 1 if good else 0 for k, (bad, good) in tests.items()}


def plain_model(rows, rounds=rules.ROUNDS):
    """The estimate document by document, in plain loops."""
    names, n = list(rows[0]), len(rows[0])
    votes = [[r[k] for k in names] for r in rows]
    share, right, caught, weight = 0.8, [0.98] * n, [0.35] * n, [1.0] * n

    def chance(v):
        odds = math.log(share / (1 - share))
        for j, x in enumerate(v):
            if x > 0:
                odds += weight[j] * math.log(right[j] / (1 - caught[j]))
            if x < 0:
                odds += weight[j] * math.log((1 - right[j]) / caught[j])
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        p = [chance(v) for v in votes]
        total = [[0.0] * n for _ in range(n)]
        for mine in (p, [1 - x for x in p]):
            size = max(sum(mine), 1e-9)
            mean = [sum(w * v[j] for w, v in zip(mine, votes)) / size for j in range(n)]
            for i in range(n):
                for j in range(n):
                    total[i][j] += sum(w * (v[i] - mean[i]) * (v[j] - mean[j]) for w, v in zip(mine, votes))
        for j in range(n):
            cast = [(x, v[j]) for x, v in zip(p, votes) if v[j]]
            good, bad = sum(x for x, _ in cast), sum(1 - x for x, _ in cast)
            right[j] = (sum(x for x, v in cast if v > 0) + 0.98 * (good + 1)) / (2 * good + 1)
            caught[j] = (sum(1 - x for x, v in cast if v < 0) + 0.35 * (bad + 1)) / (2 * bad + 1)
            caught[j] = max(caught[j], 1 - right[j] + 0.02)
            spread = [math.sqrt(max(total[k][k], 1e-9)) for k in range(n)]
            near = [max(total[j][k] / (spread[j] * spread[k]), 0) ** 2 for k in range(n) if k != j]
            weight[j] = 1 / (1 + sum(near))
        share = (sum(p) + 1) / (len(votes) + 2)
    return [chance(v) for v in votes]


def check_counts(docs):
    rows = rules.judged(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    voted = []
    for r in rows:
        want = plain_counts(r["text"])
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["p_good"] >= 0.5)
        voted.append(plain_votes(want))
        assert {k: r[f"vote_{k}"] for k in voted[-1]} == voted[-1]
    for r, p in zip(rows, plain_model(voted)):
        assert r["p_good"] == pytest.approx(p, abs=1e-6)


def test_rule_counts_equal_brute_force(spark, odd_documents):
    check_counts(odd_documents.where("doc_id > 1"))
    check_counts(catalog.table(spark, "/root/testdata/sf0.001", "documents"))


def test_rules_odd_rows(odd_documents, empty_documents):
    assert rules.judged(odd_documents).count() == odd_documents.count()
    assert rules.judged(empty_documents).count() == 0


def test_expectation_maximisation_finds_planted_accuracies():
    rng, n = np.random.default_rng(3), 40_000
    truth = rng.random(n) < 0.8
    good_right, bad_right, cast = [0.99, 0.97, 0.98, 0.96], [0.8, 0.6, 0.7, 0.5], [0.9, 0.8, 0.9, 0.7]
    votes = np.stack([
        np.where(rng.random(n) < c, np.where(rng.random(n) < np.where(truth, a, 1 - b), 1, -1), 0)
        for a, b, c in zip(good_right, bad_right, cast)
    ], axis=1)
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    model = rules.fit(patterns, weight.astype(float))
    # the priors weigh as much as the data, so estimates lie between them and what was planted
    assert 0.65 < model.share < 0.85
    assert all(min(g, 0.98) - 0.03 < x < 0.995 for g, x in zip(good_right, model.good_right))
    assert all(0.35 < x < b for b, x in zip(bad_right, model.bad_right))
    assert np.argsort(model.bad_right).tolist() == np.argsort(bad_right).tolist()
    assert ((rules.posterior(votes, model) > 0.5) == truth).mean() > 0.9


def test_votes_that_go_together_count_less():
    rng, n = np.random.default_rng(4), 5000
    truth = rng.random(n) < 0.7
    one = np.where(rng.random(n) < np.where(truth, 0.9, 0.3), 1, -1)
    other = np.where(rng.random(n) < np.where(truth, 0.9, 0.3), 1, -1)
    model = rules.fit(np.stack([one, one, one, other], axis=1), np.ones(n))
    assert max(model.weight[:3]) < 0.5 < model.weight[3]


def test_patterns_weigh_like_single_documents():
    votes = np.array([[1, 0, -1], [1, 1, 1], [1, 1, 1], [-1, -1, 0]])
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    a, b = rules.fit(votes, np.ones(4)), rules.fit(patterns, weight.astype(float))
    assert a.share == pytest.approx(b.share) and all(np.allclose(x, y) for x, y in zip(a[1:], b[1:]))


def test_the_posterior_rejects_what_the_base_lets_pass(spark):
    """Labels are for this comparison only: precision and recall of what is rejected."""
    labels = catalog.table(spark, SF, "labels")
    rows = catalog.op2_quality_rules(spark, SF).join(labels, "doc_id").collect()

    def measured(rejected):
        hits = sum(rejected(r) and r["quality"] == 0 for r in rows)
        return hits / sum(map(rejected, rows)), hits / sum(r["quality"] == 0 for r in rows)

    base, own = measured(lambda r: r["base_failed"]), measured(lambda r: not r["kept"])
    assert own[0] > base[0] and own[1] > base[1] + 0.2
    assert any(not r["kept"] and not r["base_failed"] for r in rows)
