"""Batch token encoding with a public tokenizer file.

The tokenizer lower-cases, drops white space and encodes each piece (a run of
letters, one digit, a run of other signs, or an English contraction ending) on
its own, so a text's ids are those of its pieces in order.  For plain texts
(ASCII, Latin-1 letters and common typographic signs) numpy cuts the pieces,
Arrow numbers the distinct ones and only those that this worker has not met are
encoded, through the ``tokenizers`` library.  All other texts go to the library
whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa

from usagelens.llm._common import spans_of, text_slices

#: Pieces remembered in each Python worker (about 200 bytes each); then the memory starts anew.
REMEMBERED = 600_000

_LETTER, _DIGIT, _SIGN, _BLANK, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[[9, 10, 13, 32]] = _BLANK
_CLASS[33:127] = _SIGN
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[0x80:0xC0] = _LETTER  # continuation bytes; those of signs are set by their lead
_CLASS[0xC3] = _LETTER
_CLASS[[0xC2, 0xE2]] = _SIGN
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Second bytes after C2 and third after E2 80 that are neither letters, digits nor blanks.
_C2_SIGNS = np.array([*range(0xA1, 0xAA), 0xAB, 0xAC, 0xAE, 0xAF, 0xB0, 0xB1, 0xB4, 0xB6, 0xB7, 0xB8, 0xBB, 0xBF], np.uint8)
_E280_SIGNS = np.array([0x93, 0x94, 0x98, 0x99, 0x9C, 0x9D, 0xA2, 0xA6], np.uint8)
#: Endings that the tokenizer file cuts off after an apostrophe (fixed by that file).
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, piece starts, piece ends, rows that are not plain)."""
    n = len(data)
    padded = np.zeros(n + 3, np.uint8)
    padded[:n] = _LOWER[data]
    kind = _CLASS[padded]
    kind[n:] = _BLANK
    at = np.flatnonzero(data == 0xC3)
    second = padded[at + 1]
    kind[at[(second == 0x97) | (second == 0xB7)]] = _ODD
    upper = at[(second >= 0x80) & (second <= 0x9E)] + 1
    padded[upper] += 0x20
    at = np.flatnonzero(data == 0xC2)
    kind[at + 1] = np.where(np.isin(padded[at + 1], _C2_SIGNS), _SIGN, _ODD)
    at = np.flatnonzero(data == 0xE2)
    fits = (padded[at + 1] == 0x80) & np.isin(padded[at + 2], _E280_SIGNS)
    kind[at] = kind[at + 1] = kind[at + 2] = np.where(fits, _SIGN, _ODD)
    odd = np.flatnonzero(kind[:n] == _ODD)
    special = np.flatnonzero((padded[:-1] == 60) & (padded[1:] == 124))
    rows = np.unique(np.searchsorted(offsets, np.concatenate([odd, special]), "right") - 1)

    cut = np.ones(n + 1, dtype=bool)  # a piece or blank may start here
    cut[1:n] = (kind[1:n] != kind[: n - 1]) | (kind[1:n] == _DIGIT)
    starts_row = np.zeros(n + 1, dtype=bool)
    starts_row[offsets] = True
    cut |= starts_row
    for p in np.flatnonzero((padded[:n] == 39) & cut[:n]).tolist():
        for ending in _ENDINGS:
            end = p + 1 + len(ending)
            if end <= n and padded[p + 1 : end].tobytes() == ending and not starts_row[p + 1 : end].any():
                cut[p + 1 : end] = False
                cut[end] = True
                break
    starts = np.flatnonzero(cut)
    ends = starts[1:]
    starts = starts[:-1]
    real = kind[starts] != _BLANK
    return padded, starts[real], ends[real], rows


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size()
        self._known: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum([0, *map(len, ids)]) * 4
        flat = np.fromiter(chain.from_iterable(ids), "<u4", int(ends[-1]) >> 2).tobytes()
        return [flat[a:b] for a, b in pairwise(ends.tolist())]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        out = [known.get(p) for p in pieces]
        new = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(new, self._library([pieces[i] for i in new]), strict=True):
            known[pieces[i]] = out[i] = ids
        return out

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, starts, ends, other = _pieces(data, offsets)
        first = np.searchsorted(starts, offsets)
        if len(other):  # their pieces are dropped here; the library's ids are put in below
            drop = spans_of(first[other], first[other + 1] - first[other])
            keep = np.ones(len(starts), dtype=bool)
            keep[drop] = False
            starts, ends = starts[keep], ends[keep]
            first = np.searchsorted(starts, offsets)
        lengths = ends - starts
        flat = low[spans_of(starts, lengths)] if len(starts) else low[:0]
        edges = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(lengths, out=edges[1:])
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(flat))).dictionary_encode()
        ids = self._ids(words.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        at = np.cumsum(sizes) - sizes
        index = words.indices.to_numpy(zero_copy_only=False)
        per_piece = sizes[index] if len(index) else sizes[:0]
        out = flat[spans_of(at[index], per_piece)] if len(index) else flat[:0]
        row_ends = np.concatenate([[0], np.cumsum(per_piece)])[first]
        if len(other):
            texts = [data[offsets[r] : offsets[r + 1]].tobytes().decode() for r in other.tolist()]
            parts, counts, done = [], np.diff(row_ends), 0
            for r, x in zip(other.tolist(), self._library(texts), strict=True):
                parts += [out[done : row_ends[r]], np.frombuffer(x, "<u4")]
                done, counts[r] = row_ends[r], len(x) >> 2
            out = np.concatenate([*parts, out[done:]])
            row_ends = np.concatenate([[0], np.cumsum(counts)])
        return row_ends, out

    def encode(self, texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yield (first row, row offsets, ids) over a string array, some rows at a time; a null text has no ids."""
        for row, data, offsets in text_slices(texts, most):
            yield row, *self._slice(data, offsets)


@cache
def encoder(path: str) -> PieceEncoder:
    """One encoder for each tokenizer file in a Python worker."""
    return PieceEncoder(path)
