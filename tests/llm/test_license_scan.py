import random
from collections import Counter

import numpy as np

from usagelens.llm import license_scan as L
from usagelens.llm._common import word_bounds, word_hashes

from .brute import DOCS, docs_frame, edge_rows, prose, words


def test_automaton_matches_brute_force():
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "d"]
    for _ in range(200):
        templates = tuple((f"t{k}", " ".join(rng.choices(vocabulary, k=rng.randint(2, 9)))) for k in range(rng.randint(1, 4)))
        base = (("x", " ".join(rng.choices(vocabulary, k=2))), ("y", " ".join(rng.choices(vocabulary, k=3))))
        machine = L.Automaton(templates, base)
        w = rng.choices([*vocabulary, "zz"], k=25)
        known = [t.split() for _, t in templates + base]
        occurs = lambda x: any(s[k : k + len(x)] == x for s in known for k in range(len(s)))  # noqa: E731, B023
        data = np.frombuffer(" ".join(w).encode(), np.uint8)
        starts, ends, first = word_bounds(data, np.array([0, len(data)]))
        found, matches = [], []
        for _, s, _, numbers in machine.stretches(word_hashes(data, starts, ends), first):
            machine.stream(s, numbers, found, matches)
        assert sorted(found) == sorted((n, k) for n, p in base for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        want = set()
        for b in range(len(w)):
            for e in range(b + L.LEAST, len(w) + 1):
                x = w[b:e]
                if occurs(x) and not (e < len(w) and occurs(w[b : e + 1])) and not (b and occurs(w[b - 1 : e])):
                    for t, (_, p) in enumerate(templates):
                        p = p.split()
                        want |= {(b, e, t, k + len(x)) for k in range(len(p) - len(x) + 1) if p[k : k + len(x)] == x}
        assert set(matches) == want


def test_base_places_and_spans(spark):
    text = {name: wording.replace("{", "").replace("}", "") for name, wording in L.NOTICES}
    changed = text["ISC"].replace("software for any purpose", "program for every purpose")
    rows = edge_rows() + [
        (20, f"{prose(5)} Licensed under the Apache License, Version 2.0. {prose(6)} MIT license, mit LICENSE", "en"),
        (21, "under the GNU General Public License, general public", "en"),
        (22, f"{prose(7)} {changed} {prose(8)}", "en"),
        (23, "Licensed under CC BY-NC 4.0", "en"),
    ]
    got = L.license_spans(docs_frame(spark, rows)).collect()
    phrases = [(label, p.split()) for label, p in L.BASE]
    want = []
    for i, t, _ in rows:
        w = words(t)
        want.append((i, len(w), tuple(sorted(((n, k) for n, p in phrases for k in range(len(w)) if w[k : k + len(p)] == p), key=lambda x: (x[1], x[0])))))
    assert Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.base)) for r in got) == Counter(want)
    spans = {r.doc_id: r.spans for r in got}
    assert [s.label for s in spans[20]] == ["Apache-2.0"] and spans[20][0].coverage == 1.0 and spans[20][0].start == 80
    assert spans[21] == []
    assert [s.label for s in spans[22]] == ["ISC"] and 0.75 <= spans[22][0].coverage < 1
    assert spans[22][0].start == 80 and spans[22][0].end == 80 + len(words(changed))
    assert [s.label for s in spans[23]] == ["CC-BY-NC-4.0"]


NAMED = {
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-or-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    "Apache-1.1": "The Apache Software License, Version 1.1",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License);",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "CC-BY-4.0": "available under the Creative Commons Attribution 4.0 International License",
} | {f"CC-{c}-{v}": f"licensed under CC {c} {v}" for c in L.COMBINED for v in ("3.0",)} | {f"CC-{c}-4.0": f"Licensed under CC {c} 4.0." for c in ("BY-SA", "BY-NC", "BY-ND", "BY-NC-SA")}


def test_each_licence_has_its_own_name(spark):
    """The standard wording of each licence, between other words, gives that licence and no relative of it."""
    cases = list(NAMED.items()) + [
        ("GPL-2.0-or-later", "licensed under the GNU General Public License, version 2 or later"),
        ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
        ("GPL-3.0-or-later", "licensed under the GNU General Public License, version 3 or any later version"),
    ]
    rows = [(i, f"{prose(i)} {text} {prose(1000 + i)}", "en") for i, (_, text) in enumerate(cases)]
    rows += [(900, "Licensed under the Apache License, Version 3.7", "en"), (901, "licensed under CC BY-NC-XX 4.0", "en"), (902, "GNU General Public License in version two", "en")]
    got = {r.doc_id: [s.label for s in r.spans] for r in L.license_spans(docs_frame(spark, rows)).collect()}
    assert {i: got[i] for i in range(len(cases))} == {i: [name] for i, (name, _) in enumerate(cases)}
    assert got[900] == got[901] == got[902] == []


def test_chains_keep_to_the_gap_in_text_and_template():
    far = L.GAP + 1
    assert L._best_chain([(0, 5, 5), (5 + L.GAP, 10 + L.GAP, 10)]) == [(0, 5, 5), (5 + L.GAP, 10 + L.GAP, 10)]
    assert len(L._best_chain([(0, 5, 5), (5 + far, 10 + far, 10)])) == 1  # too far apart in the text
    assert len(L._best_chain([(0, 5, 5), (5, 10, 10 + far)])) == 1  # too far apart in the template
    assert L._best_chain([(0, 6, 6), (4, 12, 20), (6, 10, 10), (10, 14, 14)]) == [(0, 6, 6), (6, 10, 10), (10, 14, 14)]


def test_of_overlapping_spans_the_longest_stays():
    spans = [("a", 0, 10, 1.0, 10), ("b", 5, 40, 0.8, 30), ("c", 40, 45, 1.0, 5), ("d", 41, 45, 1.0, 4)]
    assert L._apart(spans) == [("b", 5, 40, 0.8), ("c", 40, 45, 1.0)]


def test_many_licences_in_one_text(spark):
    """A long text with hundreds of notices: each is found, in order."""
    names = ["GPL-2.0-or-later", "AGPL-3.0-or-later", "ISC", "CC-BY-SA-4.0"] * 100
    text = " ".join(f"{NAMED[n]} {prose(i, 30)}" for i, n in enumerate(names))
    got = L.license_spans(docs_frame(spark, [(1, text, "en")])).first()
    assert [s.label for s in got.spans] == names


def test_empty_table(spark):
    assert L.license_spans(spark.createDataFrame([], DOCS)).count() == 0
