"""Secret and license scans against brute force."""

import difflib
import hashlib
import random
import re
import time
from collections import Counter

import pytest

from platterwatch.llm import licenses, secrets
from platterwatch.llm.texts import PLAIN, Words

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def plain_parts(text):
    """All candidates: (start, kind, end, role)."""
    found = [(a, k, b, "name" if k == 1 else "secret") for a, k, b in plain_base(text)]
    found += [(m.start(), 4, m.end(), "secret") for m in ASSIGN.finditer(text) if len(m[2]) < 6]
    for kind, pattern, role in ((3, secrets.KEY, "secret"), (5, secrets.NAME, "name"), (6, secrets.ENDPOINT, "endpoint")):
        found += [(m.start(), kind, m.end(), role) for m in re.finditer(pattern, text, re.A)]
    return found


def plain_spans(text):
    parts, names = plain_parts(text), ["assign", "access", "hex", "key", "short", "name", "endpoint"]
    near = lambda p, role: any(
        q[3] == role and q[0] < p[2] + secrets.SCOPE and q[2] > p[0] - secrets.SCOPE for q in parts
    )
    kept = [p for p in parts if p[1] < 3 or all(near(p, r) for r in secrets.NEEDS[p[3]])]
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b, _ in sorted(kept))


def check(docs):
    rows = secrets.secrets(docs).collect()
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    want = []
    for doc_id, several in texts.items():
        for text in several:
            base = plain_base(text)
            names = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
            want.append((
                doc_id, *(sum(x[1] == k for x in base) for k in range(3)),
                hashlib.sha256(names.encode()).hexdigest(), plain_spans(text),
            ))
    assert sorted(map(repr, (tuple(r) for r in rows))) == sorted(map(repr, want))
    return rows


def test_secrets_of_made_texts(documents):
    rng = random.Random(8)
    parts = [
        "password = 'abc123'", 'API_KEY:"xyz"', "secret=token:abcdefgh", "Token : abc secret: abcdefgh",
        "AKIA" + "Q" * 16, "AKIA" + "Q" * 15, "AKIAAKIA" + "7" * 20, "deadbeef" * 3, "deadbeef" * 2 + "abcdef0",
        "A1b2" * 10, "username: bob", "https://host.example/x?y=1", "db.eu.amazonaws.com", "client_id=77",
        "é日本\U0001f600", "\n", "plain words", "x" * 190, "y " * 160, "passwd==", "api_key='", "secret:  a.b-c/d+e_f=",
    ]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for k in range(250)]
    found = check(documents(rows))
    kinds = {x.split(":")[0] for r in found for x in r["spans"].split(",") if x}
    assert kinds == {"assign", "access", "hex", "key", "short", "name", "endpoint"}


def test_weak_parts_alone_are_not_reported(documents):
    key, access = "A1b2" * 10, "AKIA" + "Z" * 16
    rows = [
        (1, f"{key} and no more"), (2, f"{access} {key}"), (3, f"{access} {'w ' * 300} {key}"),
        (4, "https://host.example/a"), (5, f"{access} password=secret99 https://host.example/a"),
        (6, f"{access} https://host.example/a"), (7, "user: bob"), (8, "user: bob pass secret: x1"),
    ]
    spans = {r["doc_id"]: [x.split(":")[0] for x in r["spans"].split(",") if x] for r in check(documents(rows))}
    assert spans[1] == spans[4] == spans[7] == []
    assert spans[2] == ["access", "key"] and spans[3] == ["access"]
    assert spans[5] == ["access", "assign", "endpoint"] and spans[6] == ["access"]
    assert spans[8] == ["name", "short"]


def test_secrets_of_a_text_of_many_matches(documents):
    """A text is scanned once for each pattern, however many matches it has."""
    text = "token=abcdefgh\nsecret: abc\nAKIA" + "A" * 16 + "\n"
    (row,) = secrets.secrets(documents([(1, text * 25_000)])).collect()
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (25_000, 25_000, 0)
    last = len(text) * 24_999
    assert row["spans"].endswith(
        f",assign:{last}:{last + 14},short:{last + 15}:{last + 26},access:{last + 27}:{last + 47}"
    )
    assert row["spans"].count(",") == 3 * 25_000 - 1


def test_secrets_odd_rows(spark, odd_documents, empty_documents, folder):
    check(odd_documents)
    assert secrets.secrets(empty_documents).count() == 0
    check(spark.read.parquet(f"{folder}/documents.parquet"))


def test_secrets_plan_has_no_python(odd_documents):
    plan = secrets.secrets(odd_documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


NOTICE = next(t.text for t in licenses.MIT if len(t.text) > 100)


def test_alignment_is_increasing_and_near_the_longest():
    rng = random.Random(11)
    for _ in range(200):
        a = [rng.randrange(40) for _ in range(rng.randint(0, 60))]
        b = [x for x in a if rng.random() > 0.2]
        for _ in range(rng.randint(0, 5)):
            b.insert(rng.randint(0, len(b)), rng.randrange(40, 60))
        pairs = licenses.align(a, b)
        assert all(a[x] == b[y] for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    unique = rng.sample(range(1000), 80)
    cut = [x for k, x in enumerate(unique) if k % 9]
    assert len(licenses.align(unique, cut)) == len(cut)


@pytest.mark.parametrize("values", [[], [3], [5, 1, 6, 2, 3, 9, 4, 8], [1, 1, 1], list(range(9, 0, -1))])
def test_increasing_run_is_longest(values):
    places = licenses.increasing(values)
    picked = [values[k] for k in places]
    assert all(x < y for x, y in zip(picked, picked[1:])) and places == sorted(places)
    best = max((sum(1 for _ in s) for s in [[v for k, v in enumerate(values) if m >> k & 1] for m in range(1 << len(values))] if all(x < y for x, y in zip(s, s[1:]))), default=0)
    assert len(places) == best


def test_licenses_with_changes_and_in_long_texts(documents):
    rng = random.Random(5)
    fill = lambda n: " ".join(rng.choice(["the", "of", "to", "and", f"w{rng.randrange(900)}"]) for _ in range(n))
    words = NOTICE.split()
    rows = [(0, NOTICE), (1, f"{fill(3000)} {NOTICE.upper()} {fill(3000)}"), (2, fill(5000)), (3, None), (4, "")]
    for k in range(10, 40):
        share = (k % 10) * 0.05
        changed = [w if rng.random() > share else "changed" for w in words]
        rows.append((k, f"{fill(40)} {' '.join(changed)} {fill(40)}"))
    rows += [
        (50, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
        (51, "Licensed under the Other License"), (52, "licensed CC by-nc 4.0 under"),
        (53, f"{NOTICE} {NOTICE}"),
    ]
    found = {}
    for r in licenses.licenses(documents(rows)).collect():
        found.setdefault(r["doc_id"], {})[r["license"]] = r
    assert found[0]["MIT"]["coverage"] == found[1]["MIT"]["coverage"] == 1.0
    assert found[1]["MIT"]["first_word"] == 3000
    assert set(found[50]) == {"MIT", "Apache-2.0"} and set(found[53]) == {"MIT"}
    assert not {2, 3, 4, 51} & set(found)
    for k, text in rows[5:35]:
        a = Words([text.lower().encode()], PLAIN).hashes().tolist()
        b = Words([NOTICE.lower().encode()], PLAIN).hashes().tolist()
        longest = sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        if longest / len(b) < licenses.COVERAGE - 0.05:
            assert "MIT" not in found.get(k, {})
        if longest / len(b) > licenses.COVERAGE + 0.1:
            assert "MIT" in found[k]


def test_licenses_of_notices_repeated_close_together():
    table = licenses.Templates()
    for t, (name, notice, *_) in enumerate(licenses.TEMPLATES):
        n = len(table.words[t])
        for between in (" ", " some other words ", " other" * n + " "):
            for copies in (2, 3):
                text = "words before " * n + between.join([notice + "."] * copies) + " words after" * n
                found = {row[1]: row[2] for row in table.find([text.encode()])}
                assert found.get(name) == 1, (name, between, copies)


GPL_2_HEADER = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version."""


@pytest.mark.parametrize(
    "name, text",
    [
        ("GPL-2.0", GPL_2_HEADER),
        ("GPL-2.0", "This is licensed under the GNU General Public License, version 2, see below."),
        ("GPL-3.0", GPL_2_HEADER.replace("version 2", "version 3")),
        ("LGPL-2.1", GPL_2_HEADER.replace("program", "library").replace("GNU", "GNU Lesser").replace("version 2", "version 2.1")),
        ("AGPL-3.0", GPL_2_HEADER.replace("GNU", "GNU Affero").replace("version 2", "version 3")),
        ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
        ("CC-BY-4.0", "The text is Licensed under CC BY 4.0 by its authors."),
        ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
        ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
        ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
        ("BSD-2-Clause", f"Copyright 2020. {licenses.BSD_HEAD} {licenses.BSD_END} ARE DISCLAIMED."),
        ("BSD-3-Clause", f"Copyright 2020. {licenses.BSD[1].text} {licenses.BSD_END} ARE DISCLAIMED."),
        ("MPL-2.0", licenses.OTHERS[1].text),
        ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n1. Definitions."),
        (None, "Licensed under the Apache License, Version 1.1"),
        (None, licenses.BSD_HEAD),
    ],
)
def test_licenses_that_share_their_words(name, text):
    table = licenses.Templates()
    for before, after in (("", ""), ("Some words in front of it. ", " And the program goes on after it.")):
        found = {row[1] for row in table.find([(before + text + after).encode()])}
        assert found == ({name} if name else set())


def common_length(a, b):
    """Of the longest common subsequence, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for k, y in enumerate(b):
            row.append(before[k] + 1 if x == y else max(before[k + 1], row[-1]))
    return row[-1]


def test_findings_against_an_exact_alignment():
    """On random texts nothing is found whose best window is below the coverage; what keeps nine tenths of a
    template in order is found."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(25)] + ["the", "of", "and"]
    for _ in range(150):
        template = [rng.choice(words) for _ in range(rng.randint(6, 25))]
        table = licenses.Templates([("T", " ".join(template))])
        copies = [[w for w in template if rng.random() > share] for share in rng.choices([0, 0.05, 0.3, 0.6], k=rng.randint(0, 3))]
        text = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        for copy in copies:
            text += copy + [rng.choice(words) for _ in range(rng.randint(0, 8))]
        found = list(table.find([" ".join(text).encode()]))
        best = max([common_length(text[k : k + 2 * len(template)], template) for k in range(len(text))], default=0)
        if best < licenses.COVERAGE * len(template):
            assert not found
        for row in found:
            assert common_length(text[row[3] : row[3] + row[4]], template) >= row[5] >= licenses.COVERAGE * len(template)
        if len(set(template)) == len(template) and any(len(c) >= 0.9 * len(template) for c in copies):
            assert found


def test_shared_words_of_a_sliding_window():
    rng, table = random.Random(9), licenses.Templates([("T", "a b a c d the")])
    size = 6 + 6 // 4
    here = [rng.choice([*hashes_of("a b c d the x y")]) for _ in range(60)]
    want = [sum((Counter(here[k : k + size]) & Counter(hashes_of("a b a c d the"))).values()) for k in range(60)]
    assert table.shared(0, here).tolist() == want


def hashes_of(text):
    return licenses.hashed(text).tolist()


def test_license_pieces_of_template_like_text_end_soon():
    words = licenses.BSD_HEAD.split()
    rng = random.Random(2)
    text = " ".join(rng.choice(words) for _ in range(20_000))
    began = time.process_time()
    list(licenses.Templates().find([text.encode()]))
    assert time.process_time() - began < 8


def test_licenses_odd_rows(odd_documents, empty_documents):
    assert licenses.licenses(odd_documents).count() == 0
    assert licenses.licenses(empty_documents).count() == 0
