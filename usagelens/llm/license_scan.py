"""Licence scan: a generalised suffix automaton over licence words.

All templates (licence texts, short notices and the base phrases) are read into
one suffix automaton.  A document's words stream through it; after each word
it knows the longest run of words ending there that occurs in some template (the
matching statistics).  Runs of at least ``LEAST`` words that cannot be extended
are placed on their templates and chained: matches that follow one another in
both text and template, no further than ``GAP`` words apart in either, form a covered
span.  It is reported if it covers ``COVER`` of the template and each of the template's
distinguishing passages (in braces: a version, Lesser, NonCommercial, ...) lies whole
inside one match; of spans that overlap the one that covers most words stays.

The templates are the notices and short statements that licences are named by, and
the titles of their full texts; the bodies of full texts are not among them.

Only stretches in which every two neighbouring words also stand together in a
template can match two words or more, so numpy picks those stretches and only they
are streamed.  Base phrases are found at every place where the longest match
ends with one.

Defined cases: a null text has no words and finds nothing; rows with a null or
repeated id are scanned like others; an empty table gives no rows; other
columns are not read.  A long text is scanned whole, by one task, which holds about 25
bytes for each byte of it.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from usagelens.llm._common import ship, text_slices, text_words, word_bounds, word_hashes

#: Fixed labels and base phrases.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
_FREE = "you can redistribute it and/or modify it under the terms of the {GNU%s General Public License} as published by the Free Software Foundation, "
_LATER = "either {version %s of the License}, or (at your option) any later version."
_PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
#: Fixed wording.  Templates: SPDX name and public wording (a notice, a usual short statement, or a full text's title);
#: braces mark the words that tell a licence from its relatives.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, {Version 2.0}"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/{licenses/LICENSE-2.0}"),
    ("Apache-2.0", "{Apache License Version 2.0, January 2004}"),
    ("Apache-1.1", "Licensed under the Apache License, {Version 1.1}"),
    ("Apache-1.1", "The Apache Software License, {Version 1.1}"),
    ("GPL-2.0-or-later", "This program is free software; " + _FREE % "" + _LATER % "2"),
    ("GPL-3.0-or-later", "This program is free software: " + _FREE % "" + _LATER % "3"),
    ("GPL-2.0", "This program is free software; " + _FREE % "" + "{version 2 of the License}."),
    ("LGPL-2.1-or-later", "This library is free software; " + _FREE % " Lesser" + _LATER % "2.1"),
    ("LGPL-3.0-or-later", "This library is free software: " + _FREE % " Lesser" + _LATER % "3"),
    ("AGPL-3.0-or-later", "This program is free software: " + _FREE % " Affero" + _LATER % "3"),
    ("GPL-2.0", "licensed under the {GNU General Public License, version 2}"),
    ("GPL-3.0", "licensed under the {GNU General Public License, version 3}"),
    ("GPL-2.0-or-later", "licensed under the {GNU General Public License, version 2 or later}"),
    ("GPL-3.0-or-later", "licensed under the {GNU General Public License, version 3 or later}"),
    ("GPL-2.0-or-later", "licensed under the {GNU General Public License, version 2 or any later version}"),
    ("GPL-3.0-or-later", "licensed under the {GNU General Public License, version 3 or any later version}"),
    ("LGPL-2.1", "licensed under the {GNU Lesser General Public License, version 2.1}"),
    ("LGPL-3.0", "licensed under the {GNU Lesser General Public License, version 3}"),
    ("AGPL-3.0", "licensed under the {GNU Affero General Public License, version 3}"),
    ("GPL-2.0", "{GNU GENERAL PUBLIC LICENSE Version 2, June 1991}"),
    ("GPL-3.0", "{GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007}"),
    ("LGPL-2.1", "{GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999}"),
    ("LGPL-3.0", "{GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007}"),
    ("AGPL-3.0", "{GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007}"),
    ("MIT", "licensed under the {MIT license}"),
    ("MIT", "released under the {MIT license}"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software),"
        " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
        " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to {endorse or promote products} derived from this software"
        " without specific prior written permission.",
    ),
    ("ISC", _PERMISSION + "{granted, provided that} the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", _PERMISSION + "{granted. THE SOFTWARE IS PROVIDED} AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES"),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the {authors be held liable for any damages} arising from"
        " the use of this software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}."),
    ("MPL-1.1", "The contents of this file are subject to the {Mozilla Public License Version 1.1}"),
    ("BSL-1.0", "Distributed under the {Boost Software License, Version 1.0}"),
    ("EPL-2.0", "made available under the terms of the {Eclipse Public License 2.0}"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "dedicated to the public domain under {CC0 1.0}"),
)
#: Creative Commons: the elements of a licence, short and in words, and its versions.
ELEMENTS = (("BY", "Attribution"), ("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives"))
COMBINED = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
VERSIONS = ("4.0", "3.0")


def _creative_commons() -> list[tuple[str, str]]:
    spelled = dict(ELEMENTS)
    out = []
    for code in COMBINED:
        words = "-".join(spelled[e] for e in code.split("-"))
        for v in VERSIONS:
            kind = "International" if v == "4.0" else "Unported"
            out += [
                (f"CC-{code}-{v}", f"licensed under {{CC {code} {v}}}"),
                (f"CC-{code}-{v}", f"under the {{CC {code} {v}}} license"),
                (f"CC-{code}-{v}", f"licensed under a {{Creative Commons {words} {v}}} {kind} License"),
                (f"CC-{code}-{v}", f"under the {{Creative Commons {words} {v}}} {kind} License"),
            ]
    return out


TEMPLATES = (*NOTICES, *_creative_commons())
#: Words of the shortest match that is placed; words between chained matches; share of a template that a span covers.
LEAST = 4
GAP = 20
COVER = 0.75


def _marked(text: str) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words of a template, and the ranges of them that stand in braces."""
    words, ranges = [], []
    for i, part in enumerate(re.split(r"[{}]", text)):
        own = text_words(part)
        if i % 2:
            ranges.append((len(words), len(words) + len(own)))
        words += own
    return words, ranges


class Automaton:
    """Generalised suffix automaton of word sequences, with where each state's strings end."""

    def __init__(self, templates: tuple[tuple[str, str], ...], base: tuple[tuple[str, str], ...]):
        self.numbers: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        marked = [_marked(text) for _, text in (*templates, *base)]
        self.needed = [ranges for _, ranges in marked[: len(templates)]]
        texts = [(name, words) for (name, _), (words, _) in zip((*templates, *base), marked, strict=True)]
        ids = [(name, [self.numbers.setdefault(w, len(self.numbers)) for w in words]) for name, words in texts]
        ends: list[list[int]] = []  # state after each word of each text
        for _, words in ids:
            last, own = 0, []
            for c in words:
                last = self._extend(last, c)
                own.append(last)
            ends.append(own)
        self.templates = ids[: len(templates)]
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]  # (template, end) of the state's strings
        for t, own in enumerate(ends[: len(templates)]):
            for end, state in enumerate(own, 1):
                while state > 0:
                    self.places[state].append((t, end))
                    state = self.link[state]
        phrase = {own[-1]: (len(own), name) for own, (name, _) in zip(ends[len(templates) :], ids[len(templates) :], strict=True)}
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.next]  # base phrases that end the state's longest string
        for state in range(len(self.next)):
            up = state
            while up > 0:
                if up in phrase:
                    self.phrases[state].append(phrase[up])
                up = self.link[up]
        joined = pa.array([b" ".join(self.numbers).decode()])
        _, data, offsets = next(text_slices(joined))
        starts, stops, _ = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, stops)
        order = np.argsort(hashes)
        self.hashes, self.by_hash = hashes[order], order
        size = len(self.numbers)
        self.pairs = np.unique([a * size + b for _, words in ids for a, b in zip(words[:-1], words[1:], strict=True)])
        # a stretch shorter than LEAST matters only if it holds a base phrase
        self.base_starts = np.unique([words[0] * size + words[1] for _, words in ids[len(templates) :]])

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        cur = self._state(self.len[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def stretches(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, np.ndarray]]:
        """(row, first word in the row, words, their numbers) of the stretches worth streaming."""
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == words, self.by_hash[at], -1)
        if len(number) < 2:
            return []
        code = number[:-1] * len(self.numbers) + number[1:]
        spot = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        good = (number[:-1] >= 0) & (number[1:] >= 0) & (self.pairs[spot] == code)
        cuts = first[1:-1]
        good[cuts[(cuts > 0) & (cuts <= len(good))] - 1] = False
        edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        phrase = np.concatenate([[0], np.cumsum(np.isin(code, self.base_starts) & good)])
        keep = (end - begin >= LEAST) | (phrase[end - 1] > phrase[begin])
        begin, end = begin[keep], end[keep]
        row = np.searchsorted(first, begin, "right") - 1
        return [(r, b - f, e - b, number[b:e]) for r, b, e, f in zip(row.tolist(), begin.tolist(), end.tolist(), first[row].tolist(), strict=True)]

    def stream(self, start: int, numbers: np.ndarray, found: list[tuple[str, int]], matches: list[tuple[int, int, int, int]]) -> None:
        """Matching statistics of one stretch: base phrases go to ``found``, maximal matches (begin, end, template, template end) to ``matches``."""
        state = length = 0
        before = (0, 0)  # state and length after the previous word
        for i, c in enumerate([*numbers.tolist(), -1]):
            before = (state, length)
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            else:
                length = 0
            if before[1] >= LEAST and length <= before[1]:
                end = start + i
                matches += [(end - before[1], end, t, e) for t, e in self.places[before[0]]]
            if length > 1:
                found += [(name, start + i + 1 - m) for m, name in self.phrases[state] if m <= length]

    def spans(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chain a document's matches: (name, first word, end, coverage) of the covered spans."""
        out = []
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for begin, end, t, e in sorted(set(matches)):
            by_template.setdefault(t, []).append((begin, end, e))
        for t, own in by_template.items():
            name, words = self.templates[t]
            group: list[tuple[int, int, int]] = []
            reach = None
            for m in [*own, None]:
                if m is None or (reach is not None and m[0] > reach + GAP):
                    if group:
                        chain = _best_chain(group)
                        covered = sum(end - begin for begin, end, _ in chain)
                        whole = all(any(e - (end - begin) <= a and b <= e for begin, end, e in chain) for a, b in self.needed[t])
                        if whole and covered >= COVER * len(words):
                            out.append((name, chain[0][0], chain[-1][1], covered / len(words), covered))
                    group, reach = [], None
                if m is not None:
                    group.append(m)
                    reach = max(reach or 0, m[1])
        return _apart(out)


def _apart(spans: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float]]:
    """Of spans that overlap the one that covers most words (then the larger share of its template), in text order."""
    kept: list[tuple[int, int, str, float]] = []  # ascending and apart
    for name, begin, end, share, _ in sorted(spans, key=lambda s: (-s[4], -s[3], s[1], s[0])):
        at = bisect.bisect_left(kept, (begin,))
        if (at == 0 or kept[at - 1][1] <= begin) and (at == len(kept) or kept[at][0] >= end):
            kept.insert(at, (begin, end, name, share))
    return [(name, begin, end, share) for begin, end, name, share in kept]


def _best_chain(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The matches (begin, end, template end) that cover most words, in order of both text and template, with at
    most ``GAP`` words between neighbours in either.

    For each template position the chains that ended there within the last ``GAP`` words are kept, so a
    match looks at a bounded number of them."""
    ended: dict[int, list[tuple[int, int, tuple]]] = {}  # template end -> (text end, covered words, (match, chain before))
    best: tuple[int, tuple | None] = (0, None)
    for begin, end, e in matches:
        at, prior = e - (end - begin), (0, None)
        for p in range(max(0, at - GAP), at + 1):
            if p in ended:
                ended[p] = [c for c in ended[p] if c[0] >= begin - GAP]
                for stop, covered, chain in ended[p]:
                    if stop <= begin and covered > prior[0]:
                        prior = (covered, chain)
        covered, chain = prior[0] + end - begin, ((begin, end, e), prior[1])
        ended.setdefault(e, []).append((end, covered, chain))
        if covered > best[0]:
            best = (covered, chain)
    out, chain = [], best[1]
    while chain is not None:
        out.append(chain[0])
        chain = chain[1]
    return out[::-1]


@cache
def automaton(templates: tuple = TEMPLATES, base: tuple = BASE) -> Automaton:
    return Automaton(templates, base)


def license_spans(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, base (label, start of each place) and spans (label, start, end, coverage)."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    place = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
    span = T.StructType([*place.fields, T.StructField("end", T.LongType()), T.StructField("coverage", T.DoubleType())])
    schema = T.StructType(
        [T.StructField("doc_id", picked.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("base", T.ArrayType(place)), T.StructField("spans", T.ArrayType(span))]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(templates, base)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                starts, ends, first = word_bounds(data, offsets)
                n = len(offsets) - 1
                found: list[list] = [[] for _ in range(n)]
                matches: list[list] = [[] for _ in range(n)]
                for r, start, _, numbers in machine.stretches(word_hashes(data, starts, ends), first):
                    machine.stream(start, numbers, found[r], matches[r])
                places = [[{"label": a, "start": b} for a, b in sorted(x, key=lambda p: (p[1], p[0]))] for x in found]
                spans = [[dict(zip(("label", "start", "end", "coverage"), s, strict=True)) for s in machine.spans(x)] if x else [] for x in matches]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, n), pa.array(np.diff(first)), pa.array(places, arrow.field("base").type), pa.array(spans, arrow.field("spans").type)], schema=arrow
                )

    return picked.mapInArrow(run, schema)
