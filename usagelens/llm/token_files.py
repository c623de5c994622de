"""Token ids in Arrow files: equal-length sequences with masks, read back by position.

``write_token_files`` sorts the documents by id over range partitions, encodes
each text, ends it with ``end_id`` and lets every task write the running stream
of its partition as one Arrow IPC file of fixed-size-list record batches::

    ids   fixed_size_list<uint16 | uint32>[length]
    mask  fixed_size_list<bool>[length]          (false only on the padding at the file's end)

All batches but the last hold ``ROWS`` sequences, so sequence ``k`` is row
``k % ROWS`` of batch ``k // ROWS`` and a memory-mapped reader touches just
that.  A second file beside it (``.docs.arrow``) lists each document's id,
first position and number of ids.  Files get their final name only when whole,
and a task that runs again writes the same bytes, so lost executors are safe.

Defined cases: a null or empty text is the single id ``end_id``; documents with
a null id come first; rows that repeat an id all stay, in a fixed order (by a
hash of the text, then input position); an empty table writes no file and reads
as no rows; columns other than the id and the text are not read.  A long text is
encoded whole by one task (its ids must fit there); its sequences are written as
they come.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm._common import ship
from usagelens.llm._encoder import encoder

#: Sequences of one record batch.
ROWS = 256

MANIFEST = "file string, part long, n_docs long, n_ids long, n_sequences long"


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(uri)


def with_end(offsets: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every row."""
    return offsets + np.arange(len(offsets)), np.insert(ids, offsets[1:], end_id)


class _Writer:
    """One task's file pair."""

    def __init__(self, folder: str, part: int, length: int, kind: pa.DataType, id_kind: pa.DataType):
        self.fs, base = _filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"part-{part:06d}"
        self.base, self.part, self.length, self.kind = base, part, length, kind
        stamp = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        self.temp = [f"{base}/.{self.name}-{stamp}{end}" for end in (".arrow", ".docs.arrow")]
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", id_kind), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = [self.fs.open_output_stream(x) for x in self.temp]
        self.files = [pa.ipc.new_file(o, s) for o, s in zip(self.out, (self.schema, self.docs_schema), strict=True)]
        self.held = np.zeros(0, kind.to_pandas_dtype())
        self.n_docs = self.n_ids = self.n_sequences = 0

    def add(self, ids: pa.Array, ends: np.ndarray, stream: np.ndarray) -> None:
        docs = pa.record_batch([ids, pa.array(ends[:-1] + self.n_ids), pa.array(np.diff(ends))], schema=self.docs_schema)
        self.files[1].write_batch(docs)
        self.n_docs += len(ids)
        self.n_ids += len(stream)
        held = np.concatenate([self.held, stream.astype(self.held.dtype)])
        whole = len(held) // (ROWS * self.length) * ROWS * self.length
        for at in range(0, whole, ROWS * self.length):
            self._batch(held[at : at + ROWS * self.length])
        self.held = held[whole:].copy()

    def _batch(self, ids: np.ndarray) -> None:
        n = -(-len(ids) // self.length)
        mask = np.arange(n * self.length) < len(ids)
        full = np.zeros(n * self.length, ids.dtype)
        full[: len(ids)] = ids
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (full, mask)]
        self.files[0].write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += n

    def close(self) -> dict:
        if len(self.held):
            self._batch(self.held)
        for file, out, temp, end in zip(self.files, self.out, self.temp, (".arrow", ".docs.arrow"), strict=True):
            file.close()
            out.close()
            self.fs.move(temp, f"{self.base}/{self.name}{end}")
        return {"file": self.name, "part": self.part, "n_docs": self.n_docs, "n_ids": self.n_ids, "n_sequences": self.n_sequences}


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, end_id: int = 2, length: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> list[dict]:
    """Write the files under ``folder`` (shared by all executors); returns the manifest, one entry a file, in id order."""
    ship(df.sparkSession)
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("_at")]
    placed = picked.withColumn("_at", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, encode = None, encoder(tokenizer)
        kind = pa.uint16() if max(encode.vocab_size, end_id + 1) <= 1 << 16 else pa.uint32()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                writer = _Writer(folder, TaskContext.get().partitionId(), length, kind, batch.schema.field("doc_id").type)
            for row, offsets, ids in encode.encode(batch.column("text")):
                writer.add(batch.column("doc_id").slice(row, len(offsets) - 1), *with_end(offsets, ids, end_id))
        if writer is not None:
            yield pa.RecordBatch.from_pylist([writer.close()])

    return sorted((r.asDict() for r in placed.mapInArrow(write, MANIFEST).collect()), key=lambda r: r["part"])


def read_sequence(folder: str, file: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ``k`` of one file and its mask, touching only the batch that holds it."""
    fs, base = _filesystem(folder)
    path = f"{base}/{file}.arrow"
    source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
    batch = pa.ipc.open_file(source).get_batch(k // ROWS)
    ids, mask = (batch.column(i)[k % ROWS].values.to_numpy(zero_copy_only=False) for i in (0, 1))
    return ids, mask


def _documents(folder: str, file: str, base: int) -> Iterator[dict]:
    """Digest rows of one file's documents, a record batch at a time."""
    fs, root = _filesystem(folder)
    local = fs.type_name == "local"
    open_ = lambda p: pa.ipc.open_file(pa.memory_map(p) if local else fs.open_input_file(p))
    seqs, docs = open_(f"{root}/{file}.arrow"), open_(f"{root}/{file}.docs.arrow")

    def stream() -> Iterator[np.ndarray]:
        for b in range(seqs.num_record_batches):
            batch = seqs.get_batch(b)
            ids, mask = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            yield (ids if mask.all() else ids[mask]).astype("<u4")

    parts, held = stream(), np.zeros(0, "<u4")
    for b in range(docs.num_record_batches):
        batch = docs.get_batch(b)
        rows = {"doc_id": batch.column("doc_id"), "start": [], "n_tokens": batch.column("n_tokens"), "ids_crc32": []}
        for start, n in zip(batch.column("start").to_pylist(), batch.column("n_tokens").to_pylist(), strict=True):
            crc, left = 0, n
            while left:
                if not len(held):
                    held = next(parts)
                crc = zlib.crc32(held[:left].tobytes(), crc)
                left, held = left - min(left, len(held)), held[left:]
            rows["start"].append(base + start)
            rows["ids_crc32"].append(crc)
        yield rows


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict], id_type: T.DataType | None = None) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, file."""
    ship(spark)
    entries, base = [], 0
    for m in sorted(manifest, key=lambda m: m["part"]):
        entries.append((m["file"], base))
        base += m["n_ids"]
    schema = T.StructType([T.StructField("doc_id", id_type or T.LongType())] + [T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")] + [T.StructField("file", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                for rows in _documents(folder, file, base):
                    n = len(rows["start"])
                    yield pa.RecordBatch.from_arrays(
                        [rows["doc_id"], pa.array(rows["start"], pa.int64()), rows["n_tokens"], pa.array(rows["ids_crc32"], pa.int64()), pa.array([file] * n, pa.string())], names=schema.names
                    )

    files = spark.createDataFrame(entries, "file string, base long").repartition(max(1, len(entries)))
    return files.mapInArrow(read, schema)
