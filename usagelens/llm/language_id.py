"""Language identification with a byte convolutional network.

A text's UTF-8 bytes (A-Z folded) are cut into windows of ``WINDOW`` bytes; the
last window ends with the text, a shorter text is padded with zeros.  Each byte
becomes an embedding; filters of several widths run over the window, each
keeps its largest response, and a softmax layer turns those into languages.  A
document's language has the largest logit on average over all its windows.

The network is trained in numpy on a bounded, balanced sample of labelled
documents outside the held-out fold (``MOST_ROWS`` documents, those of each
language with the smallest hash of their id, a few windows of each); every
window of every text is scored.

Defined cases: a null text or one without a letter is ``und`` with score 0;
rows with a null or repeated id are predicted like others (``held_out`` is False
for a null id); if no language is known, every prediction is ``und``; an empty
table gives no rows; other columns are not read.  A long text is scored whole, by one
task, which holds about 20 bytes for each byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm._common import held_out, ship, text_slices
from usagelens.llm._scan import HOT
from usagelens.llm._training import one_text

WINDOW = 256
EMBEDDING = 6
WIDTHS = (2, 3, 4)
FILTERS = 10
#: Documents used to train, at most, and windows taken from each.
MOST_ROWS = 6_000
WINDOWS_EACH = 4
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, owner): every text's windows and the row that each belongs to."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), count)
    at = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    at = np.maximum(np.minimum(at, size[owner] - WINDOW), 0) + offsets[owner]
    padded = np.concatenate([_FOLD[data], np.zeros(WINDOW, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[at]
    short = size[owner] < WINDOW
    out[short] *= np.arange(WINDOW) < size[owner[short]][:, None]
    return out, owner


@dataclass
class ByteCnn:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # max(WIDTHS) * EMBEDDING x filters; a narrower filter's last rows are zero
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def patches(self, w: np.ndarray) -> np.ndarray:
        """Rows of embeddings under the widest filter, for each position of each window."""
        wide = max(WIDTHS)
        x = self.embedding[w].reshape(len(w), -1)
        view = np.lib.stride_tricks.as_strided(x, (len(w), WINDOW - wide + 1, wide * EMBEDDING), (x.strides[0], EMBEDDING * x.itemsize, x.itemsize))
        return np.ascontiguousarray(view)

    def pooled(self, patches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, positions, width = patches.shape
        y = (patches.reshape(-1, width) @ self.filters).reshape(n, positions, -1)
        return y, np.maximum(y.max(axis=1) + self.bias, 0)

    def logits(self, w: np.ndarray) -> np.ndarray:
        parts = []
        for at in range(0, len(w), 128):
            parts.append(self.pooled(self.patches(w[at : at + 128]))[1] @ self.out + self.out_bias)
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and its probability for each text of a slice."""
        n = len(offsets) - 1
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        w, owner = windows(data, offsets)
        total = np.zeros((n, len(self.languages)))
        np.add.at(total, owner, self.logits(w))
        z = total / np.maximum(np.bincount(owner, minlength=n), 1)[:, None]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[offsets]
        names = [self.languages[i] for i in best.tolist()]
        score = p[np.arange(n), best]
        for r in np.flatnonzero(np.diff(letters) == 0).tolist():
            if not any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace")):
                names[r], score[r] = UNKNOWN, 0.0
        return names, score


def fit(w: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> ByteCnn:
    """Train on labelled windows with Adam; a filter learns at the position of its largest response."""
    rng = np.random.default_rng(seed)
    wide, n_filters = max(WIDTHS), FILTERS * len(WIDTHS)
    fixed = np.zeros((wide * EMBEDDING, n_filters), np.float32)
    for i, width in enumerate(WIDTHS):
        fixed[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
    draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = ByteCnn(
        languages, draw(256, EMBEDDING) * 0.5, draw(wide * EMBEDDING, n_filters) * 0.3 * fixed, np.zeros(n_filters, np.float32), draw(n_filters, len(languages)) * 0.1, np.zeros(len(languages), np.float32)
    )
    weights = [net.embedding, net.filters, net.bias, net.out, net.out_bias]
    first = [np.zeros_like(x) for x in weights]
    second = [np.zeros_like(x) for x in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(w))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            patches = net.patches(w[pick])
            response, pooled = net.pooled(patches)
            where = response.argmax(axis=1)
            z = pooled @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p /= len(pick)
            g = (p @ net.out.T) * (pooled > 0)
            seen = patches[np.arange(len(pick))[:, None], where]  # window x filter x patch
            grads = [np.zeros_like(net.embedding), np.einsum("nfp,nf->pf", seen, g) * fixed, g.sum(axis=0), pooled.T @ p, p.sum(axis=0)]
            back = (g[:, :, None] * net.filters.T[None]).reshape(len(pick), n_filters, wide, EMBEDDING)
            under = w[pick][np.arange(len(pick))[:, None, None], where[:, :, None] + np.arange(wide)]
            np.add.at(grads[0], under, back)
            step += 1
            for x, m, v, d in zip(weights, first, second, grads, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, most_rows: int = MOST_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteCnn:
    """Fit on windows of at most ``most_rows`` documents (one row for each id and language); only those windows reach the driver."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    usable = picked.filter("_id IS NOT NULL AND lang IS NOT NULL").filter(~held_out("_id"))
    # of a language with very many rows only those with small hashes can be among the first
    h, place = F.xxhash64("_id"), F.xxhash64("_id").cast("double") / 2.0**64 + 0.5
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = usable.count()
    common = sizes.filter((F.col("n") * HOT >= total) & (F.col("n") > 2 * most_rows))  # at most HOT languages
    few = usable.select("_id", "lang").join(F.broadcast(common), "lang", "left").filter(F.col("n").isNull() | (place < 2.0 * most_rows / F.col("n"))).distinct()
    in_turn = F.row_number().over(Window.partitionBy("lang").orderBy(h, "_id"))
    ids = few.select("_id", "lang").withColumn("turn", in_turn).filter(F.col("turn") <= most_rows)
    ids = ids.orderBy("turn", "lang", "_id").limit(most_rows).select("_id", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                w, owner = windows(data, offsets)
                count = np.bincount(owner, minlength=len(offsets) - 1)
                place = np.arange(len(w)) - (np.cumsum(count) - count)[owner]
                every = -(-count[owner] // WINDOWS_EACH)
                keep = place % every == 0
                lang = batch.column("lang").take(pa.array(owner[keep] + row))
                yield pa.RecordBatch.from_arrays([lang, pa.array([x.tobytes() for x in w[keep]], pa.binary())], names=["lang", "w"])

    sample = one_text(usable.join(F.broadcast(ids), ["_id", "lang"]), ["_id", "lang"])
    rows = sample.select("text", "lang").mapInArrow(run, "lang string, w binary").collect()
    rows = sorted((r["lang"], bytes(r["w"])) for r in rows)
    languages = sorted({lang for lang, _ in rows})
    index = {lang: i for i, lang in enumerate(languages)}
    w = np.frombuffer(b"".join(x for _, x in rows), np.uint8).reshape(-1, WINDOW)
    return fit(w, np.array([index[lang] for lang, _ in rows], np.int64), languages)


def identify(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                names, score = model.predict(data, offsets)
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(row, n) for c in ("doc_id", "held_out")] + [pa.array(names, pa.string()), pa.array(score.astype(np.float64))], names=["doc_id", "held_out", "lang_pred", "score"]
                )

    return picked.mapInArrow(run, picked.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double"))
