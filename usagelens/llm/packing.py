"""Harmonic packing of token sequences.

With capacity ``C``, class ``k`` holds pieces of length in (C/(k+1), C/k], and a
bin of class ``k`` takes exactly ``k`` of them, so a worker fills bins without
knowing any other worker's pieces.  A document is first cut so that its pieces
sit just below a class's upper bound: whole capacities, then greedily the
largest reciprocal part that fits (at most a few pieces, as in an Egyptian
fraction), until the rest wastes at most ``slack`` of a bin or is short.  Short
pieces (up to ``C / SHORT``) use classes on a geometric ladder of lengths.

Each task keeps at most one open bin per class.  What stays in open bins is
merged 64 tasks to one, pass by pass; the last pass sees at most one open bin a
class and places those few pieces first-fit by falling length.

Defined cases: a null or empty text is the single id ``end_id``; rows with a
null or repeated id are packed like any others, each row on its own; ``ids``
of the pieces come along with ``keep_ids``; an empty table gives no rows; other
columns are not read.  A long text is encoded whole by one task (its ids must fit
there) and cut into pieces, which are packed one by one.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from usagelens.llm._common import checkpointed, ship
from usagelens.llm._encoder import encoder
from usagelens.llm.token_files import with_end

#: Pieces of at most capacity / SHORT use the ladder of short classes.
SHORT = 32
#: Ratio of neighbouring lengths on that ladder.
LADDER = 0.95
#: Open bins of so many tasks meet in one task of the next pass.
FAN_IN = 64


@cache
def short_class(length: int, capacity: int) -> int:
    """Pieces in a bin of the ladder class that holds a short piece of this length."""
    top = capacity // SHORT
    while int(top * LADDER) >= length:
        top = int(top * LADDER)
    return capacity // max(top, length)


@cache
def cuts(n: int, capacity: int, slack: float) -> tuple[tuple[int, int], ...]:
    """(length, class) of the pieces of a rest of ``n`` < capacity ids."""
    out = []
    while n:
        k = capacity // n
        if n <= capacity // SHORT:
            out.append((n, short_class(n, capacity)))
            break
        if capacity - k * n <= slack * capacity:
            out.append((n, k))
            break
        part = capacity // (k + 1)
        out.append((part, k + 1))
        n -= part
    return tuple(out)


class _Bins:
    """Open bins of one task, by class: lists of rows ending in their length at ``LENGTH``."""

    def __init__(self, first: int):
        self.open: dict[int, list[dict]] = defaultdict(list)
        self.next = first
        self.full: list[dict] = []

    def add(self, k: int, row: dict) -> None:
        rows = self.open[k]
        rows.append(row)
        if len(rows) >= k:
            self.seal(rows)
            self.open[k] = []

    def seal(self, rows: list[dict]) -> None:
        at = 0
        for row in rows:
            row["sequence_id"], row["offset"] = self.next, at
            at += row["length"]
        self.next += 1
        self.full += rows

    def take(self) -> list[dict]:
        out, self.full = self.full, []
        return out


def _first_fit(rows: list[dict], capacity: int) -> list[list[dict]]:
    bins: list[list[dict]] = []
    room: list[int] = []
    for row in sorted(rows, key=lambda r: (-r["length"], r["class"], str(r["doc_id"]), r["start"])):
        at = next((i for i, x in enumerate(room) if x >= row["length"]), None)
        if at is None:
            bins.append([row])
            room.append(capacity - row["length"])
        else:
            bins[at].append(row)
            room[at] -= row["length"]
    return bins


def pack(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    slack: float = 0.015,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, class, sequence_id, offset (and ids)."""
    ship(df.sparkSession)
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [T.StructField("doc_id", picked.schema["doc_id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "class", "sequence_id", "offset", "part")]
    fields += [T.StructField("ids", T.ArrayType(T.LongType()))] * keep_ids
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def rows_out(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_pylist(rows[at : at + 10_000], schema=arrow)

    def open_rows(bins: _Bins, part: int) -> list[dict]:
        return [row | {"part": part} for rows in bins.open.values() for row in rows]

    def place(bins: _Bins, docs: list, ends: np.ndarray, ids: np.ndarray) -> None:
        for doc, a, b in zip(docs, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            n, at = b - a, 0
            for length, k in [(capacity, 1)] * (n // capacity) + list(cuts(n % capacity, capacity, slack)):
                own = ids[a + at : a + at + length]
                row = {"doc_id": doc, "start": at, "length": length, "ids_crc32": zlib.crc32(own.tobytes()), "doc_tokens": n, "class": k}
                bins.add(k, row | {"ids": own.tolist()} if keep_ids else row)
                at += length

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bins, encode = _Bins(part << 32), encoder(tokenizer)
        for batch in batches:
            for row, offsets, ids in encode.encode(batch.column("text")):
                docs = batch.column("doc_id").slice(row, len(offsets) - 1).to_pylist()
                place(bins, docs, *with_end(offsets, ids, end_id))
                yield from rows_out(bins.take())
        yield from rows_out(open_rows(bins, part))

    def merge(level: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            bins = _Bins((level << 55) + (part << 32))
            for batch in batches:
                for row in batch.to_pylist():
                    bins.add(row["class"], row)
                yield from rows_out([r | {"part": None} for r in bins.take()])
            left = open_rows(bins, part)
            if last:
                for rows in _first_fit(left, capacity):
                    bins.seal([r | {"part": None} for r in rows])
                left = bins.take()
            yield from rows_out(left)

        return run

    done, level = [], 0
    current = checkpointed(picked.mapInArrow(first, schema))
    while True:
        done.append(current.filter(F.col("sequence_id").isNotNull()))
        still_open = current.filter(F.col("sequence_id").isNull())
        parts = still_open.agg(F.max("part")).first()[0]
        if parts is None:
            break
        n, level = (parts + FAN_IN) // FAN_IN, level + 1
        gathered = still_open.repartition(n, F.floor(F.col("part") / FAN_IN)).sortWithinPartitions("part", "class", "doc_id", "start")
        # one of n tasks gets each group of FAN_IN tasks' open bins (at most one bin a class from each)
        current = checkpointed(gathered.mapInArrow(merge(level, n == 1), schema))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.drop("part")
