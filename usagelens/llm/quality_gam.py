"""Quality classifier: a generalised additive model with pairwise interactions.

Each document becomes a short vector of surface statistics (byte classes, words,
lines, repetition).  Training cuts every feature into quantile bins and boosts
trees of three leaves on one feature after another, round by round; a feature's
trees add up to one lookup table.  The pairs of features that explain most of
what is left then get small two-dimensional tables in the same way.  A score is
the logistic of the intercept and the looked-up bins, all documents at once.

Labels come from a bounded sample (``MOST_ROWS``) outside the held-out fold;
every document is scored over its whole text.

Defined cases: a null text is scored as an empty one; rows with a null or
repeated id are scored like others (``held_out`` is False for a null id); if
there is no usable label, or just one class, the score is the smoothed share of
good rows (0.5 without any) for all documents; an empty table gives no rows;
other columns are not read.  A long text is scored whole, by one task, which holds
about 50 bytes for each byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import held_out, ship, span_hasher, text_slices, unused, word_bounds
from usagelens.llm._training import training_rows

#: Labelled rows used to fit, at most.
MOST_ROWS = 20_000
BINS = 48
PAIR_BINS = 8
PAIRS = 8

_GROUPS = {
    "letters": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "upper": [*range(65, 91)],
    "digits": [*range(48, 58)],
    "blanks": [9, 10, 13, 32],
    "stops": [ord(c) for c in ".,;:?"],
    "shouts": [ord("!")],
    "bars": [ord("|")],
    "quotes": [ord(c) for c in "'\"()-"],
    "marks": [ord(c) for c in "#$%&*@^~<>{}[]\\=_+/`"],
    "wide": [*range(128, 256)],
}
_GROUP = np.zeros((256, len(_GROUPS)))
for _i, _members in enumerate(_GROUPS.values()):
    _GROUP[_members, _i] = 1

FEATURES = [*(f"share_{g}" for g in _GROUPS), "log_bytes", "log_words", "word_length", "long_words", "short_words", "distinct_words", "log_top_word", "repeated_signs", "lines_per_word", "repeated_lines", "line_length", "open_lines", "byte_entropy", "upper_words"]


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` rows: number of distinct hashes, and uses of the most used one."""
    low = np.uint64(64 - max(n, 1).bit_length())  # the row, then as much of the hash as fits
    keys = np.sort((rows.astype(np.uint64) << low) | (hashes >> (np.uint64(64) - low)))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    owner = (keys[at] >> low).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, np.diff(np.append(at, len(keys))))
    return np.bincount(owner, minlength=n), top


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` for each text of a slice."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
    some = np.maximum(size, 1)
    shares = (counts @ _GROUP) / some[:, None]
    p = counts / some[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)

    hashes = span_hasher(data)
    starts, ends, first = word_bounds(data, offsets)
    n_words = np.diff(first)
    words = np.maximum(n_words, 1)
    word_row = np.repeat(np.arange(n), n_words)
    length = ends - starts
    per = lambda mask: np.bincount(word_row[mask], minlength=n)
    mean_length = np.bincount(word_row, length, n) / words
    distinct, top = _distinct(word_row, hashes(starts, ends), n)
    upper = (data >= 65) & (data <= 90)
    upper_run = upper[starts] & upper[np.minimum(ends - 1, max(len(data) - 1, 0))] & (length > 1) if len(starts) else np.zeros(0, bool)

    sign = (data > 32) & (_GROUP[data, 0] + _GROUP[data, 2] == 0)
    again = np.flatnonzero(sign[1:] & (data[1:] == data[:-1])) + 1
    repeated = np.bincount(row[again], minlength=n)

    breaks = data == 10
    line_start = breaks.copy()
    line_start[1:] = breaks[:-1]
    if len(data):
        line_start[0] = True
        line_start[offsets[:-1][size > 0]] = True
    begin = np.flatnonzero(line_start & ~breaks)
    end_of_line = np.zeros(len(data), dtype=bool)  # before a break or at the end of a text
    end_of_line[:-1] = breaks[1:]
    if len(data):
        end_of_line[offsets[1:][size > 0] - 1] = True
    end = np.flatnonzero(end_of_line & ~breaks) + 1
    line_row = row[begin]
    n_lines = np.bincount(line_row, minlength=n)
    lines = np.maximum(n_lines, 1)
    distinct_lines, _ = _distinct(line_row, hashes(begin, end), n)
    closed = np.isin(data[end - 1], np.frombuffer(b".!?:", np.uint8)) if len(end) else np.zeros(0, bool)
    line_length = np.bincount(line_row, end - begin, n) / lines
    return np.column_stack(
        [
            shares,
            np.log1p(size),
            np.log1p(n_words),
            mean_length,
            per(length > 12) / words,
            per(length < 4) / words,
            distinct / words,
            np.log1p(top) - np.log1p(words),
            repeated / words,
            n_lines / words,
            1 - distinct_lines / lines,
            line_length,
            np.bincount(line_row[~closed], minlength=n) / lines,
            entropy,
            per(upper_run) / words,
        ]
    )


@dataclass
class Gam:
    """Lookup tables over the bins of each feature and of pairs of features."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += table[np.searchsorted(edges, x[:, f], "right")]
        rough = {f: np.searchsorted(self.coarse[f], x[:, f], "right") for f in {f for p in self.pairs for f in p}}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[rough[a], rough[b]]
        return 1 / (1 + np.exp(-z))


def _quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, splits: int = 2) -> np.ndarray:
    """Leaf values over bins of a tree with ``splits`` cuts, each the best at its time."""
    cuts = [0, len(g)]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    for _ in range(splits):
        best, where = 1e-9, None
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            gain = _gain(cg[at] - cg[a], ch[at] - ch[a]) + _gain(cg[b] - cg[at], ch[b] - ch[at]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
            i = int(gain.argmax())
            if gain[i] > best:
                best, where = gain[i], int(at[i])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree that cuts one axis once and then each half of the other axis once: (gain, leaf values)."""
    best, out = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            gain, leaf = 0.0, np.zeros_like(gg)
            for half in (slice(0, cut), slice(cut, len(gg))):
                a, b = gg[half].sum(axis=0), hh[half].sum(axis=0)
                ca, cb = np.cumsum(a), np.cumsum(b)
                sides = _gain(ca[:-1], cb[:-1]) + _gain(ca[-1] - ca[:-1], cb[-1] - cb[:-1])
                i = int(sides.argmax())
                gain += sides[i]
                leaf[half, : i + 1] = ca[i] / (cb[i] + 1.0)
                leaf[half, i + 1 :] = (ca[-1] - ca[i]) / (cb[-1] - cb[i] + 1.0)
            gain -= _gain(g.sum(), h.sum())
            if gain > best:
                best, out = gain, leaf.T if turned else leaf
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1) -> Gam:
    """Boost the feature tables round by round, then those of the best pairs."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(intercept=float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    n_features = x.shape[1]
    model.edges = [_quantile_edges(x[:, f], BINS) for f in range(n_features)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(n_features):
            g, h = slopes()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            model.tables[f] += step
            z += step[bins[f]]

    model.coarse = [_quantile_edges(x[:, f], PAIR_BINS) for f in range(n_features)]
    rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.coarse)]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        return np.bincount(rough[a] * shape[1] + rough[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    found = [(_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(n_features) for b in range(a) if len(model.coarse[a]) and len(model.coarse[b])]
    model.pairs = [(a, b) for _, a, b in sorted(found, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(rounds // 5):
        for i, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * _pair_tree(grid(a, b, g), grid(a, b, h))[1]
            model.pair_tables[i] += step
            z += step[rough[a], rough[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = MOST_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Gam:
    """Fit on at most ``most_rows`` labelled documents; their features are computed by Spark, and only those reach the driver."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                x = features(data, offsets).astype(np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([lists, batch.column("y").slice(row, len(x))], names=["x", "y"])

    sample, lacking = training_rows(docs, labels, label, most_rows, id_col, text_col)
    rows = sample.mapInArrow(run, "x array<double>, y double").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    y = np.array([r["y"] for r in rows])
    order = np.lexsort(x.T)  # the same sums however the rows arrive
    model = fit(x[order], y[order])
    model.intercept += lacking
    return model


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """doc_id, held_out and score of every document; with ``keep`` (a column name) all columns of ``docs`` and the score under that name."""
    ship(docs.sparkSession)
    picked = docs if keep else docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    text, result = (text_col, keep) if keep else ("text", "score")
    passed = picked.columns if keep else ["doc_id", "held_out"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(batch.schema.names.index(text))):
                s = model.score(features(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(c)).slice(row, len(s)) for c in passed] + [pa.array(s)], names=[*passed, result])

    schema = picked.select(*passed).schema.add(result, "double")
    return picked.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that a model trained on ``labels`` scores below ``cut``; all columns stay."""
    column = unused(docs, "_score")
    scored = score(docs, train(docs, labels, label, id_col=id_col, text_col=text_col), id_col, text_col, keep=column)
    return scored.filter(F.col(column) >= cut).select(*docs.columns)
