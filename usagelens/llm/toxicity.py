"""Toxicity scores: a bidirectional gated recurrent network with attention pooling.

A text's words (runs of letters and digits, A-Z folded) become vectors from two
inputs: an embedding of the word itself, for words that training met often
enough, and the mean embedding of its character trigrams (hashed), for every
word.  Windows of ``WINDOW`` words, each overlapping the next by half, run through a gated
recurrent network in both directions; attention weighs the steps, and a
logistic unit scores the window.  A document's score is its highest window.

The network is trained in numpy on a bounded sample of labelled documents
outside the held-out fold.  Only documents are labelled, so training alternates:
windows of clean documents (some, evenly spaced) are negatives, and of a toxic
document (its whole text, or ``TOXIC_WINDOWS`` windows of a long one) the windows that the current network scores highest
are the positives.  A logistic curve over the highest windows of a fifth of the
sample that training leaves out then sets the scale of the scores.

Defined cases: a null text or one without words scores as an empty window;
rows with a null or repeated id are scored like others (``held_out`` is False
for a null id); if there is no usable label, or just one class, the score is the
smoothed share of toxic rows (0 without any label) for all documents; an empty
table gives no rows; other columns are not read.  A long text is scored whole, by one
task, which holds about 25 bytes for each byte of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import FOLDS, held_out, ship, span_hasher, spans_of, text_slices, word_bounds
from usagelens.llm._training import training_rows

WINDOW = 32
STRIDE = 16
EMBEDDING = 12
HIDDEN = 12
#: Hash buckets of character trigrams; words with an embedding of their own, at most,
#: and documents of the sample that such a word is in, at least.
TRIGRAMS = 1 << 13
VOCABULARY = 4_096
LEAST_DOCUMENTS = 5
#: Labelled documents used to train, at most, and windows taken from each clean one.
MOST_ROWS = 8_000
WINDOWS_EACH = 6
#: Windows of a toxic document that training sees, at most (evenly spaced; shorter documents are seen whole).
TOXIC_WINDOWS = 64
BATCH = 2_048
#: Passes over the chosen windows in each round: more when they are few.
EPOCHS, MOST_EPOCHS = 3, 15
#: Windows that one round trains on, at most, and the steps it takes, at least (so few windows are seen more often).
ROUND_WINDOWS = 12_000
ROUND_STEPS = 6_000
#: Windows of clean documents in a round: the highest scored, and as many drawn at random; share of clean windows that a positive must exceed.
HARD_WINDOWS = 4_000
ABOVE_CLEAN = 0.9995

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_inputs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, trigram buckets of those words, their bounds, word numbers), plus row bounds last."""
    starts, ends, first = word_bounds(data, offsets)
    h, at, number = np.unique(span_hasher(data)(starts, ends), return_index=True, return_inverse=True)
    s, size = starts[at], ends[at] - starts[at]
    # characters with a blank on both sides: a word of n bytes has n trigrams
    flat = np.full(int((size + 2).sum()), 32, np.int64)
    begin = np.cumsum(size + 2) - (size + 2)
    flat[spans_of(begin + 1, size)] = _FOLD[data[spans_of(s, size)]]
    middle = spans_of(begin + 1, size)
    code = (flat[middle - 1] * 65_599 + flat[middle]) * 65_599 + flat[middle + 1]
    bucket = ((code * 0x9E3779B1) >> 15) % TRIGRAMS
    return h, bucket, np.append(np.cumsum(size) - size, len(bucket)), number, first


def cut(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, length) of all windows; a row without words has one of length 0."""
    n = np.diff(first)
    count = np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1
    owner = np.repeat(np.arange(len(n)), count)
    start = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    start = np.maximum(np.minimum(start, n[owner] - WINDOW), 0)
    return owner, start + first[:-1][owner], np.minimum(n[owner], WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights; direction 0 reads forwards, 1 backwards."""

    known: np.ndarray  # sorted hashes of the words with an embedding
    words: np.ndarray
    trigrams: np.ndarray
    into: np.ndarray  # 2 x EMBEDDING x 3 HIDDEN (update, reset, candidate)
    across: np.ndarray  # 2 x HIDDEN x 3 HIDDEN
    bias: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    prior: float | None = None
    tape: dict = field(default_factory=dict)

    def trained(self) -> list[np.ndarray]:
        return [self.words, self.trigrams, self.into, self.across, self.bias, self.attend, self.out, self.out_bias]

    def word_rows(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash in ``words``; the last row (zeros) for the others."""
        at = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
        same = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
        return np.where(same, at, len(self.known))

    def vectors(self, h: np.ndarray, bucket: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """One vector for each distinct word, and a last row of zeros for padding."""
        out = np.zeros((len(h) + 1, EMBEDDING), np.float32)
        if len(h):
            sums = np.add.reduceat(self.trigrams[bucket], bounds[:-1], axis=0)
            out[:-1] = sums / np.diff(bounds)[:, None].astype(np.float32) + self.words[self.word_rows(h)]
        return out

    def run(self, inputs: np.ndarray, number: np.ndarray, lengths: np.ndarray, keep: bool = False) -> np.ndarray:
        """Window scores (before the logistic).  inputs: vectors; number: window x step, -1 past the end."""
        n, steps = number.shape
        states = np.zeros((2, steps, n, HIDDEN), np.float32)
        gates = []
        for d in (0, 1):
            ready = inputs @ self.into[d] + self.bias[d]
            u = self.across[d]
            h = np.zeros((n, HIDDEN), np.float32)
            own: list = [None] * steps
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x = ready[number[:, t]]
                zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
                live = (t < lengths)[:, None]
                new = np.where(live, h + z * (c - h), h)
                if keep:
                    own[t] = (h, z, r, c, live)
                states[d, t] = h = new
            gates.append(own)
        both = np.concatenate([states[0], states[1]], axis=2)  # step x window x 2 HIDDEN
        e = both @ self.attend
        live = np.arange(steps)[:, None] < np.maximum(lengths, 1)
        e = np.where(live, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, both)
        if keep:
            self.tape = {"gates": gates, "both": both, "a": a, "pooled": pooled, "number": number, "inputs": inputs}
        return pooled @ self.out + self.out_bias[0]

    def back(self, g: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Gradients of all weights but the embeddings, and of the inputs, from those of the window scores."""
        t_ = self.tape
        both, a, number, inputs = t_["both"], t_["a"], t_["number"], t_["inputs"]
        steps = len(a)
        d_out, d_bias = t_["pooled"].T @ g, np.array([g.sum()], np.float32)
        d_pooled = g[:, None] * self.out
        d_a = np.einsum("tnh,nh->tn", both, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        d_attend = np.einsum("tn,tnh->h", d_e, both)
        d_both = a[:, :, None] * d_pooled[None] + d_e[:, :, None] * self.attend
        d_into, d_across, d_gate_bias = np.zeros_like(self.into), np.zeros_like(self.across), np.zeros_like(self.bias)
        d_inputs = np.zeros_like(inputs)
        for d in (0, 1):
            u = self.across[d]
            d_ready = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            carry = np.zeros((number.shape[0], HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
                h, z, r, c, live = t_["gates"][d][t]
                dh = carry + d_both[t, :, d * HIDDEN : (d + 1) * HIDDEN]
                dn = dh * live
                dc = dn * z * (1 - c * c)
                dz = dn * (c - h) * z * (1 - z)
                back_c = dc @ u[:, 2 * HIDDEN :].T
                dr = back_c * h * r * (1 - r)
                dx = np.concatenate([dz, dr, dc], axis=1)
                d_across[d][:, : 2 * HIDDEN] += h.T @ dx[:, : 2 * HIDDEN]
                d_across[d][:, 2 * HIDDEN :] += (r * h).T @ dc
                carry = dh - dn * z + back_c * r + dx[:, : 2 * HIDDEN] @ u[:, : 2 * HIDDEN].T
                np.add.at(d_ready, number[:, t], dx)
            d_into[d] = inputs.T @ d_ready
            d_gate_bias[d] = d_ready.sum(axis=0)
            d_inputs += d_ready @ self.into[d].T
        return [d_into, d_across, d_gate_bias, d_attend, d_out, d_bias], d_inputs

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each text of a slice: the highest of its windows."""
        n = len(offsets) - 1
        if self.prior is not None:
            return np.full(n, self.prior)
        h, bucket, bounds, number, first = word_inputs(data, offsets)
        inputs = self.vectors(h, bucket, bounds)
        owner, start, length = cut(first)
        best = np.full(n, -np.inf)
        for at in range(0, len(owner), BATCH):
            own, s, k = owner[at : at + BATCH], start[at : at + BATCH], length[at : at + BATCH]
            np.maximum.at(best, own, self.run(inputs, step_numbers(number, s, k), k))
        return _sigmoid(self.scale[0] * best + self.scale[1])


def step_numbers(number: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Word number of each step of each window, -1 past its end."""
    steps = np.arange(max(1, int(length.max(initial=0))))
    inside = steps < length[:, None]
    at = np.where(inside, start[:, None] + steps, 0)
    return np.where(inside, number[at] if len(number) else -1, -1)


def _blank(known: np.ndarray, rng: np.random.Generator) -> Network:
    draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    words = draw(0.1, len(known) + 1, EMBEDDING)
    words[-1] = 0
    return Network(
        known, words, draw(0.05, TRIGRAMS, EMBEDDING), draw(0.3, 2, EMBEDDING, 3 * HIDDEN), draw(0.3, 2, HIDDEN, 3 * HIDDEN), np.zeros((2, 3 * HIDDEN), np.float32),
        draw(0.1, 2 * HIDDEN), draw(0.1, 2 * HIDDEN), np.zeros(1, np.float32),
    )


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a lightly regularised logistic curve, each class with the same weight."""
    weight = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum()))
    x, w, ridge = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0]), np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = _sigmoid(x @ w)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        w = w - np.clip(np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge @ (w - [1.0, 0.0])), -1, 1)
    return float(w[0]), float(w[1])


def fit(texts: list[str], y: np.ndarray, document: np.ndarray, rounds: int = 5, batch: int = 256, rate: float = 0.01, decay: float = 0.1, seed: int = 23) -> Network:
    """Train on texts with the label and the number of their document; each round chooses the windows that count with the current weights."""
    rng = np.random.default_rng(seed)
    if len(np.unique(y)) < 2:
        return Network(*[np.zeros(0)] * 9, prior=float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.0)
    raw = "".join(texts).encode("utf-8", "surrogatepass")
    sizes = np.array([len(x.encode("utf-8", "surrogatepass")) for x in texts])
    data, offsets = np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(sizes)])
    h, bucket, bounds, number, first = word_inputs(data, offsets)
    word_row = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs = np.unique(document[word_row] * (len(h) + 1) + number)
    in_docs = np.bincount(pairs % (len(h) + 1), minlength=len(h))
    often = np.argsort(-in_docs, kind="stable")[:VOCABULARY]
    net = _blank(np.sort(h[often[in_docs[often] >= LEAST_DOCUMENTS]]), rng)
    rows = net.word_rows(h)
    owner, start, length = cut(first)
    positive = y[owner] > 0.5

    weights = net.trained()
    first_moment, second_moment = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
    step = 0

    def train_on(which: np.ndarray, target: np.ndarray, epochs: int) -> None:
        nonlocal step
        for _ in range(epochs):
            order = rng.permutation(len(which))
            for at in range(0, len(order), batch):
                pick = which[order[at : at + batch]]
                used, local = np.unique(step_numbers(number, start[pick], length[pick]), return_inverse=True)
                local = local.reshape(len(pick), -1)
                if used[0] < 0:  # padding goes last
                    used, local = used[1:], np.where(local == 0, len(used) - 1, local - 1)
                sizes_ = bounds[used + 1] - bounds[used]
                buckets = bucket[spans_of(bounds[used], sizes_)]
                edges = np.append(np.cumsum(sizes_) - sizes_, len(buckets))
                inputs = net.vectors(h[used], buckets, edges)
                z = net.run(inputs, local, length[pick], keep=True)
                g = ((_sigmoid(z) - target[order[at : at + batch]]) / len(pick)).astype(np.float32)
                grads, d_inputs = net.back(g)
                d_words, d_trigrams = np.zeros_like(net.words), np.zeros_like(net.trigrams)
                np.add.at(d_words, rows[used], d_inputs[:-1])
                d_words[-1] = 0
                share = d_inputs[:-1] / np.maximum(sizes_, 1)[:, None].astype(np.float32)
                np.add.at(d_trigrams, buckets, np.repeat(share, sizes_, axis=0))
                step += 1
                for x, m, v, d in zip(weights, first_moment, second_moment, [d_words, d_trigrams, *grads], strict=True):
                    m += 0.1 * (d - m)
                    v += 0.01 * (d * d - v)
                    x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
                for x in weights[:2]:  # embeddings that carry nothing fade
                    x *= 1 - rate * decay
                net.words[-1] = 0

    def scores(which: np.ndarray) -> np.ndarray:
        inputs = net.vectors(h, bucket, bounds)
        return np.concatenate([net.run(inputs, step_numbers(number, start[w], length[w]), length[w]) for w in np.array_split(which, max(1, -(-len(which) // BATCH)))])

    learns = document[owner] % FOLDS != 0  # the others set the scale of the scores
    if len(np.unique(y[owner[learns]])) < 2:
        learns[:] = True
    toxic, clean = np.flatnonzero(positive & learns), np.flatnonzero(~positive & learns)
    for turn in range(rounds):
        if turn == 0:  # nothing is known yet: any window of a toxic document may be positive
            chosen, negative = toxic, rng.choice(clean, min(len(clean), 3 * len(toxic)), replace=False)
        else:  # toxic: windows above nearly all clean ones, and each document's best; clean: the highest and as many others
            z, others = scores(toxic), scores(clean)
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, owner[toxic], z)
            chosen = toxic[(z >= best[owner[toxic]] - 1e-6) | (z > np.quantile(others, ABOVE_CLEAN))]
            hard = clean[np.argsort(-others, kind="stable")[:HARD_WINDOWS]]
            if turn == 2:  # start anew without what was learnt from windows that only stand beside toxic ones
                step = 0
                for x, m, v, fresh in zip(weights, first_moment, second_moment, _blank(net.known, rng).trained(), strict=True):
                    x[...], m[...], v[...] = fresh, 0, 0
            negative = np.unique(np.concatenate([hard, rng.choice(clean, min(len(clean), HARD_WINDOWS), replace=False)]))
        which = np.concatenate([chosen, negative])
        target = np.concatenate([np.ones(len(chosen)), np.zeros(len(negative))])
        some = rng.permutation(len(which))[:ROUND_WINDOWS]
        train_on(which[some], target[some], max(EPOCHS, min(MOST_EPOCHS, ROUND_STEPS // len(some))))
    best = np.full(int(document.max()) + 1, -np.inf)
    np.maximum.at(best, document[owner], scores(np.arange(len(owner))))
    label = np.zeros(len(best))
    np.maximum.at(label, document, y)
    seen = np.isfinite(best) & (np.arange(len(best)) % FOLDS == 0)
    if len(np.unique(label[seen])) < 2:
        seen = np.isfinite(best)
    net.scale = _logistic(best[seen], label[seen])
    net.tape = {}
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = MOST_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Fit on at most ``most_rows`` labelled documents; of the clean and the long ones only some windows reach the driver."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                toxic = batch.column("y").slice(row, len(offsets) - 1).to_numpy(zero_copy_only=False)
                starts, ends, first = word_bounds(data, offsets)
                owner, start, length = cut(first)
                count = np.bincount(owner, minlength=len(toxic))
                place = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
                whole_row = (toxic > 0.5) & (count <= TOXIC_WINDOWS)
                limit = np.where(toxic > 0.5, TOXIC_WINDOWS, WINDOWS_EACH)[owner]
                some = (place % -(-count[owner] // limit) == 0) & ~whole_row[owner] & (length > 0)
                spans = [(r, offsets[r], offsets[r + 1]) for r in np.flatnonzero(whole_row).tolist()]
                spans += [(owner[i], starts[start[i]], ends[start[i] + length[i] - 1]) for i in np.flatnonzero(some).tolist()]
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for _, a, b in spans]
                whole = [zlib.crc32(data[offsets[r] : offsets[r + 1]]) for r, _, _ in spans]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([toxic[r] for r, _, _ in spans], pa.float64()), pa.array(whole, pa.int64())], names=["text", "y", "doc"])

    sample, _ = training_rows(docs, labels, label, most_rows, id_col, text_col)  # both classes weigh the same in the scale of the scores
    rows = sample.mapInArrow(run, "text string, y double, doc long").collect()
    rows = sorted((r["doc"], r["text"], r["y"]) for r in rows)  # the same order however they arrive
    document = np.unique([d for d, _, _ in rows], return_inverse=True)[1] if rows else np.zeros(0, np.int64)
    return fit([t for _, t, _ in rows], np.array([v for _, _, v in rows]), document)


def score(docs: DataFrame, model: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out and score of every document."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text"), 1 << 20):
                s = model.score(data, offsets).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(row, len(s)) for c in ("doc_id", "held_out")] + [pa.array(s)], names=["doc_id", "held_out", "score"])

    return picked.mapInArrow(run, picked.select("doc_id", "held_out").schema.add("score", "double"))
