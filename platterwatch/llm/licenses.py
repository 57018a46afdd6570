"""License scans by patience alignment.

A template and a piece of text are aligned on words that are unique in both: the longest run of
them in the same order anchors the alignment, and what lies between two anchors is aligned in the same way,
where more words are unique. Equal words at the ends of a gap are taken first. Coverage is the share
of the template's words that are aligned.

A template names the words that an alignment has to hold (its version, its license's name) and those that must
not stand within it, which make the notice that of another license. Licenses that share a text up
to a point, such as the BSD ones, are told apart by what follows; a text that ends before has no finding.

Pieces of text are found by a sound bound. Of a window as long as the template and half of it again, COVERAGE of
the template's length must be words of the template, so without the template's places of common words a
number is left that must be other words of it. Windows that touch are one piece. A piece that does
not align as a whole is searched by a sliding window that counts the words it shares with the template, each as often as
both have it: only the peaks of that count are aligned, so that copies close together are found.

Defined cases: a null or empty text has no findings. A document has a row for each license found
in it: the template and piece of largest coverage, the first of several; a better finding of another
license at the same place excludes it. Repeated rows get rows each, empty tables none. Words are runs of letters and digits in lower case. Other columns are not
read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from platterwatch.llm.texts import PLAIN, Words, expand_texts

COVERAGE = 0.75
SLOTS = 1 << 16


class Template(NamedTuple):
    name: str
    text: str
    needs: str = ""  # words that must be aligned
    lacks: str = ""  # words that must not stand between the first and the last aligned word


# Notices, head paragraphs and distinguishing clauses of public licenses.
APACHE = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0", "apache 2"),
    Template(
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "apache 2",
    ),
    Template(
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS "
        "FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
        "apache 2 2004",
    ),
)
MIT = (
    Template("MIT", "Released under the MIT License", "mit"),
    Template("MIT", "Licensed under the MIT License", "mit"),
    Template(
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
        "sublicense",
    ),
)
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES"
)
BSD = (
    Template("BSD-2-Clause", f"{BSD_HEAD} {BSD_END}", "holders contributors", "neither endorse"),
    Template(
        "BSD-3-Clause",
        f"{BSD_HEAD} 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission.",
        "neither endorse",
    ),
)
OTHERS = (
    Template(
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies",
        "fee provided",
    ),
    Template(
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "mozilla 2",
    ),
    Template("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0", "mozilla 2"),
    Template(
        "MPL-2.0",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal "
        "entity that creates, contributes to the creation of, or owns Covered Software.",
        "mozilla 2",
    ),
    Template(
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software",
        "unencumbered",
    ),
    Template(
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work",
        "waived neighboring",
    ),
)

# Name, kind, words of its version, words that no notice of it holds, day of its text.
GNU = (
    ("GPL-2.0", "General", "2", "lesser affero library 3", "Version 2, June 1991"),
    ("GPL-3.0", "General", "3", "lesser affero library", "Version 3, 29 June 2007"),
    ("LGPL-2.1", "Lesser General", "2.1", "affero", "Version 2.1, February 1999"),
    ("LGPL-3.0", "Lesser General", "3", "affero", "Version 3, 29 June 2007"),
    ("AGPL-3.0", "Affero General", "3", "lesser", "Version 3, 19 November 2007"),
)
CC = {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}  # Fixed values: the marks of variants
CC_VARIANTS = ((), ("NC",), ("SA",), ("ND",), ("NC", "SA"), ("NC", "ND"))


def gnu_templates() -> Iterator[Template]:
    for name, kind, version, lacks, dated in GNU:
        needs = f"gnu {kind} {version}"
        yield Template(name, f"licensed under the GNU {kind} Public License, version {version}", needs, lacks)
        subject = "library" if kind.startswith("Lesser") else "program"
        yield Template(
            name,
            f"This {subject} is free software: you can redistribute it and/or modify it under the terms of "
            f"the GNU {kind} Public License as published by the Free Software Foundation, either "
            f"version {version} of the License, or (at your option) any later version",
            needs,
            lacks.replace("library", ""),
        )
        yield Template(name, f"GNU {kind} PUBLIC LICENSE {dated} Copyright (C) Free Software Foundation, Inc.",
                       f"{needs} {dated}", lacks)


def cc_templates() -> Iterator[Template]:
    for marks in CC_VARIANTS:
        other = [m for m in CC if m not in marks]
        name = "-".join(["BY", *marks])
        yield Template(f"CC-{name}-4.0", f"Licensed under CC {name} 4.0", f"cc {name} 4", " ".join(other))
        full = "-".join(["Attribution", *(CC[m] for m in marks)])
        yield Template(
            f"CC-{name}-4.0",
            f"This work is licensed under a Creative Commons {full} 4.0 International License",
            f"commons {full} 4",
            " ".join(CC[m] for m in other),
        )


TEMPLATES = (*APACHE, *MIT, *BSD, *OTHERS, *gnu_templates(), *cc_templates())

# Words too common to tell a notice by.
COMMON = "the of and to a in is for by or as this that it you may with on be not any all are use if at can"


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails, places, back = [], [], []
    for k, v in enumerate(values):
        at = bisect_left(tails, v)
        back.append(places[at - 1] if at else -1)
        tails[at : at + 1], places[at : at + 1] = [v], [k]
    out, k = [], places[-1] if places else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing in both."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: k for k, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        both = [(k, at_b[w]) for k, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at_b]
        anchors = [both[k] for k in increasing([y for _, y in both])]
        if not anchors:
            continue
        pairs += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges[:-1], edges[1:])]
    return sorted(pairs)


def hashed(text: str) -> np.ndarray:
    return Words([text.lower().encode()], PLAIN).hashes()


class Templates:
    def __init__(self, templates=TEMPLATES, coverage: float = COVERAGE):
        templates = [Template(*t) for t in templates]
        self.names = [t.name for t in templates]
        self.words = [hashed(t.text) for t in templates]
        self.counts = [Counter(w.tolist()) for w in self.words]
        self.needed = [set(hashed(t.needs).tolist()) for t in templates]
        self.lacking = [set(hashed(t.lacks).tolist()) for t in templates]
        self.coverage = coverage
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        self.slots = np.zeros(SLOTS, bool)
        self.slots[(self.known & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        common = hashed(COMMON)
        self.least, self.member = [], []
        for w in self.words:
            telling = w[~np.isin(w, common)]
            least = self.fewest(len(w)) - (len(w) - len(telling))
            telling, least = (telling, least) if least > 0 else (w, self.fewest(len(w)))
            self.least.append(least)
            self.member.append(np.isin(self.known, telling))

    def fewest(self, n: int) -> int:
        """How many words of a template of n words have to be aligned."""
        return max(1, int(np.ceil(self.coverage * n - 1e-9)))

    def pieces(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, template, first word, end) of all pieces that may hold a template."""
        some = np.flatnonzero(self.slots[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.known, hashes[some]), len(self.known) - 1)
        same = self.known[place] == hashes[some]
        some, code = some[same], place[same]
        for t, member in enumerate(self.member):
            at = some[member[code]]
            n, least = len(self.words[t]), self.least[t]
            reach = n + n // 2
            if len(at) < least:
                continue
            owner = np.searchsorted(words.first, at, "right") - 1
            last = np.arange(least - 1, len(at))
            first = last - least + 1
            good = (at[last] - at[first] < reach) & (owner[last] == owner[first])
            begin, end = at[first[good]], at[last[good]] + 1
            owner = owner[last[good]]
            if not len(begin):
                continue
            begin = np.maximum(begin - reach, words.first[owner])
            end = np.minimum(end + reach, words.first[owner + 1])
            new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]) | np.diff(owner, prepend=-1).astype(bool))
            stop = np.append(new[1:], len(begin)) - 1
            for x, y in zip(new, stop):
                yield int(owner[x]), t, int(begin[x]), int(end[y])

    def aligned(self, t: int, here: list[int], begin: int, end: int) -> tuple | None:
        """(-coverage, -aligned words, first word, words) if here[begin:end] holds the template."""
        pairs = align(here[begin:end], self.words[t].tolist())
        share = len(pairs) / len(self.words[t])
        if share < self.coverage or not self.needed[t] <= {here[begin + x] for x, _ in pairs}:
            return None
        first, size = begin + pairs[0][0], pairs[-1][0] - pairs[0][0] + 1
        if not self.lacking[t].isdisjoint(here[first : first + size]):
            return None
        return -share, -len(pairs), first, size

    def shared(self, t: int, here: list[int]) -> np.ndarray:
        """For each word, how many words the window that begins there shares with the template."""
        size, most = len(self.words[t]) + len(self.words[t]) // 4, self.counts[t]
        inside, total, out = Counter(), 0, np.zeros(len(here), np.int64)
        for k in range(len(here) + size):
            if k < len(here) and here[k] in most:
                inside[here[k]] += 1
                total += inside[here[k]] <= most[here[k]]
            if 0 <= (begin := k - size + 1) < len(here):
                out[begin] = total
                if here[begin] in most:
                    total -= inside[here[begin]] <= most[here[begin]]
                    inside[here[begin]] -= 1
        return out

    def windows(self, t: int, here: list[int]) -> list[tuple]:
        """Findings in windows of about the template's length, the best of those that overlap: copies
        close together leave no word unique in the piece."""
        n, rows, out = len(self.words[t]), [], []
        count = self.shared(t, here)
        open_ = count >= self.fewest(n)
        for begin in np.lexsort((np.arange(len(count)), -count)).tolist():
            if not open_[begin]:
                continue
            open_[max(0, begin - n // 2) : begin + max(1, n // 2)] = False
            for size in (n, n + n // 4, n + n // 2):
                if row := self.aligned(t, here, begin, min(begin + size, len(here))):
                    rows.append(row)
        for row in sorted(rows):
            if all(row[2] + row[3] <= at or at + size <= row[2] for _, _, at, size in out):
                out.append(row)
        return out

    def find(self, texts: list[bytes]) -> Iterator[tuple]:
        """(text, license, coverage, first word, words, aligned words) of each license found."""
        words = Words([x.decode().lower().encode() for x in texts], PLAIN)
        hashes, found = words.hashes(), {}
        for text, t, begin, end in self.pieces(words, hashes):
            here, first = hashes[begin:end].tolist(), int(words.first[text])
            if not self.needed[t] <= set(here):
                continue
            whole = self.aligned(t, here, 0, len(here))
            for share, n, at, size in [whole] if whole else self.windows(t, here):
                found.setdefault(text, []).append((share, n, begin + at - first, size, self.names[t]))
        for text in sorted(found):
            yield from ((text, *row) for row in separate(found[text], int(words.count[text])))


def separate(found: list[tuple], n_words: int) -> list[tuple]:
    """The best finding of each license whose words no better finding of another license has."""
    taken, numbers, best = np.zeros(n_words, np.int32), {}, {}
    for share, n, at, size, name in sorted(found):
        number = numbers.setdefault(name, len(numbers) + 1)
        here = taken[at : at + size]
        if ((here == 0) | (here == number)).all():
            here[:] = number
            best.setdefault(name, (name, -share, at, size, -n))
    return [best[name] for name in sorted(best)]


FOUND = {
    "license": "string", "coverage": "double", "first_word": "bigint", "n_words": "bigint",
    "n_aligned": "bigint",
}


def licenses(docs: DataFrame, templates=TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, coverage, first_word, n_words, n_aligned of every license found."""
    table = Templates(templates, coverage)
    return expand_texts(docs, FOUND, table.find)
