"""Shared pieces of the training-data operators: checkpoints, word splitting, hashing.

A *word* here is a maximal run of ASCII digits, ASCII letters and non-ASCII
bytes of the UTF-8 text, with A-Z folded to a-z.  Text batches are split and
hashed with numpy over the Arrow buffers, a bounded slice of bytes at a time.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import ensure_checkpoint_dir

#: Bytes of text that one numpy pass takes at a time (a longer text is taken whole).
SLICE_BYTES = 2 << 20

#: Splits documents into five parts by id; part 0 is held out from training.
FOLDS = 5

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = True
_IS_WORD[0x41:0x5B] = True
_IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Lower-cases A-Z and turns every byte outside words into a blank.
_WORDS_ONLY = bytes(_LOWER[c] if _IS_WORD[c] else 32 for c in range(256))

_RNG = np.random.default_rng(20240229)
_BYTE_HASH = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_HASH[65:91] = _BYTE_HASH[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_MIX = [np.uint64(x | 1) for x in _RNG.integers(0, 2**63, 16).tolist()]


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once a session, so that their workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_usagelens_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="usagelens-src-"), "usagelens_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(path)
    sc._usagelens_sent = True


def unused(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column of ``df`` starts with it."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return memory that Arrow keeps after a batch to the system: a worker holds one batch, not the largest so far."""
    pa.default_memory_pool().release_unused()


def held_out(doc_id: str) -> F.Column:
    """True where crc32 of the id as text is divisible by :data:`FOLDS` (a null id: False)."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(FOLDS) == 0, F.lit(False))


def text_words(text: str | None) -> list[bytes]:
    """The words of one text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS_ONLY).split()


def text_slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, row offsets) over a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        end = min(end, len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (one more at the end)."""
    n = len(data)
    inside = _IS_WORD[data]
    before = np.empty(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.empty(n, dtype=bool)
    after[:-1] = inside[1:]
    if n:
        before[0] = after[-1] = False
        cuts = offsets[(offsets > 0) & (offsets < n)]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of starts and ends that gives the 64-bit hash of those spans of ``data`` (A-Z folded)."""
    power = np.full(len(data), _BASE, np.uint64)
    power[:1] = 1
    np.cumprod(power, out=power)
    power *= _BYTE_HASH[data]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(power, out=total[1:])
    back = power
    back[:] = _BASE_INV
    back[:1] = 1
    np.cumprod(back, out=back)

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (total[ends] - total[starts]) * back[starts]
        return mixed(h + (ends - starts).astype(np.uint64) * _MIX[15])

    return hashes


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same for a word wherever it stands."""
    return span_hasher(data)(starts, ends)


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a row, and the word index where each starts."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(words) - n + 1
    h = np.full(m, np.uint64(n) * _MIX[14])
    for j in range(n):
        h += words[j : j + m] * _MIX[j % 14]
        if j % 14 == 13:
            h = mixed(h)
    lacks = np.zeros(m, dtype=bool)
    for j in range(1, n):  # a run may not cross into the next row
        at = first[1:-1] - j
        lacks[at[(at >= 0) & (at < m)]] = True
    where = np.flatnonzero(~lacks)
    return mixed(h[where]), where


def spans_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start+1, ... of the given lengths."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    out += np.arange(total)
    return out
