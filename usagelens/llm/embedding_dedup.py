"""Near-duplicate embeddings: cross-polytope hashing with multiprobe and exact verification.

Vectors with equal labels whose cosine, in double precision, reaches
``threshold`` are linked.  Equal vectors form a class first.  Each table rotates
a vector several times by three rounds of random signs and the fast Hadamard
transform; the nearest corner of the cross-polytope (the largest coordinate and its
sign) of each rotation makes its bucket.  A vector enters the ``PROBES`` buckets of
a table whose coordinates sum highest, so that it meets a neighbour whose corner is
only second best.

The number of rotations a table follows from the number of vectors and their length:
as few as leave a bucket with at most ``STRANGERS`` unrelated vectors on average, so
the pairs that meet by chance do not grow with the table.  The number of tables then
follows from the chance, simulated for pairs just at the threshold, that one
table brings such a pair together: a pair is missed with probability ``MISS`` at most.
Members of a bucket are verified by their true cosine in bounded blocks.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and those with a null label, link with nothing; vectors of different
lengths do not link; rows with a null id take part, and their group has the
smallest non-null id (null if there is none); rows that repeat an id are vectors of
their own; an empty table gives no rows; other columns are not read.  A vector is held
whole by the tasks that hash and compare it, 512 at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm._blocks import meetings, summary, verified
from usagelens.llm._common import checkpointed, mixed, ship

PROBES = 8
#: Other vectors that share one of a vector's buckets by chance, on average, at most.
STRANGERS = 0.25
#: Probability that a pair at the threshold shares no bucket, at most.
MISS = 1e-6
#: Simulated pairs, and rows hashed together.
TRIALS = 4_000
ROWS = 1024
#: Corners of one rotation that a probe may use.
CORNERS = 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the columns (a power of two long), scaled to keep lengths."""
    d, n = x.shape
    step = 1
    while step < d:
        pairs = x.reshape(d // (2 * step), 2, step, n)
        x = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(d, n)
        step *= 2
    return x / np.sqrt(d)


def _wide(dim: int) -> int:
    """Components of a padded vector: a power of two, 64 at least (signs and transforms of a few components are no random rotations)."""
    return 1 << max(6, (dim - 1).bit_length())


def buckets(unit: np.ndarray, label: np.ndarray, tables: int, hashes: int, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers (row x tables * probes) of unit vectors; ``label`` is a hash that keeps labels apart."""
    n, d = unit.shape
    wide = _wide(d)
    signs = [np.random.default_rng([wide, t]).choice([-1.0, 1.0], (hashes, 3, wide, 1)) for t in range(tables)]
    out = np.zeros((n, tables * probes), np.uint64)
    for at in range(0, n, ROWS):
        rows = np.arange(at, min(at + ROWS, n))
        padded = np.zeros((wide, len(rows)))
        padded[:d] = unit[rows].T
        for t in range(tables):
            score, code = np.zeros((len(rows), 1)), (label[rows] + np.uint64(t))[:, None]
            for h in range(hashes):
                x = padded
                for turn in range(3):
                    x = hadamard(x * signs[t][h, turn])
                x = x.T
                size = np.abs(x)
                top = np.argpartition(-size, min(CORNERS, wide) - 1, axis=1)[:, :CORNERS]
                best = np.take_along_axis(size, top, axis=1)
                corner = (top + wide * (np.take_along_axis(x, top, axis=1) < 0)).astype(np.uint64)
                score = (score[:, :, None] + best[:, None, :]).reshape(len(rows), -1)
                code = mixed((code[:, :, None] * np.uint64(0x9E3779B97F4A7C15) + corner[:, None, :]).reshape(len(rows), -1))
                # a beginning that is not among the best can't end among them
                order = np.argsort(-score, axis=1, kind="stable")[:, :probes]
                score, code = np.take_along_axis(score, order, axis=1), np.take_along_axis(code, order, axis=1)
            out[rows, t * probes : t * probes + code.shape[1]] = code
            out[rows, t * probes + code.shape[1] : (t + 1) * probes] = code[:, :1]
    return out


@cache
def sizes(n: int, dim: int, threshold: float, probes: int = PROBES, strangers: float = STRANGERS, miss: float = MISS) -> dict[str, int]:
    """``tables`` and ``hashes`` for ``n`` vectors of ``dim`` components (see above)."""
    wide = _wide(dim)
    hashes = max(1, math.ceil(math.log(max(n, 1) * probes / strangers) / math.log(2 * wide)))
    pairs, tried = min(TRIALS, max(400, TRIALS * 64 // wide)), 4
    rng = np.random.default_rng([wide, hashes])
    x, g = rng.normal(size=(2, pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g -= np.einsum("ij,ij->i", g, x)[:, None] * x
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * g / np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-300)
    a, b = (buckets(v, np.zeros(pairs, np.uint64), tried, hashes, probes).reshape(pairs, tried, probes) for v in (x, y))
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(2, 3)).mean()
    met = min(max(met - 3 * math.sqrt(met * (1 - met) / (pairs * tried)), 0.01), 1 - 1e-3)  # a cautious estimate
    return {"tables": math.ceil(math.log(miss) / math.log(1 - met)), "hashes": hashes}


def _signatures(vectors: DataFrame, kind: str, **sizes) -> DataFrame:
    """vec_id, class (digest of label and vector; null if it can't link), payload (components as ``kind``) and buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            column = batch.column("embedding").cast(pa.list_(pa.float64()))
            length = np.array([-1 if x is None else x for x in pc.list_value_length(column).to_pylist()], np.int64)
            start = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n].astype(np.int64) if n else np.zeros(0, np.int64)
            values = column.values.to_numpy(zero_copy_only=False)  # null components become nan
            labels = batch.column("label").to_pylist()
            digest, payload, codes = [None] * n, [None] * n, [None] * n
            for d in np.unique(length[length > 0]).tolist():
                rows = np.flatnonzero(length == d)
                x = values[start[rows][:, None] + np.arange(d)]
                largest = np.abs(x).max(axis=1)
                fits = np.isfinite(x).all(axis=1) & (largest > 0) & np.array([labels[r] is not None for r in rows.tolist()])
                rows, x = rows[fits], x[fits] / largest[fits][:, None]
                raw = values[start[rows][:, None] + np.arange(d)]
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                marks = [hashlib.blake2b(f"{d}:{labels[r]}".encode(), digest_size=8).digest() for r in rows.tolist()]
                found = buckets(unit, np.frombuffer(b"".join(marks), np.uint64), **sizes).view(np.int64) if len(rows) else []
                for i, r in enumerate(rows.tolist()):
                    digest[r] = hashlib.blake2b(marks[i] + raw[i].tobytes(), digest_size=16).digest()
                    payload[r] = raw[i].astype(kind).tobytes()
                    codes[r] = np.unique(found[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(digest, pa.binary()), pa.array(payload, pa.binary()), pa.array(codes, pa.list_(pa.int64()))], names=["vec_id", "class", "payload", "buckets"]
            )

    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, class binary, payload binary, buckets array<long>"
    return vectors.mapInArrow(run, schema)


def _cosine(threshold: float, kind: str):
    """Which pairs of byte strings of numbers have a cosine of at least ``threshold``."""

    def linked(payloads: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sizes = np.array([len(p) for p in payloads])
        out = np.zeros(len(left), dtype=bool)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            place = np.full(len(sizes), -1)
            place[rows] = np.arange(len(rows))
            x = np.frombuffer(b"".join(payloads[r] for r in rows.tolist()), kind).reshape(len(rows), -1).astype(np.float64)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            both = np.flatnonzero((place[left] >= 0) & (place[right] >= 0))
            a, b = place[left[both]], place[right[both]]
            if 8 * len(both) >= len(x) ** 2:  # a product of matrices decides all pairs that are not close to the threshold
                rough = (x @ x.T)[a, b]
                out[both] = rough >= threshold + 1e-9
                near = np.flatnonzero(np.abs(rough - threshold) < 1e-9)
                both, a, b = both[near], a[near], b[near]
            for at in range(0, len(both), 10_000):
                out[both[at : at + 10_000]] = np.einsum("ij,ij->i", x[a[at : at + 10_000]], x[b[at : at + 10_000]]) >= threshold
        return out

    return linked


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.93,
    probes: int = PROBES,
    miss: float = MISS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable by links) and kept."""
    ship(vectors.sparkSession)
    picked = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).cast("string").alias("label"))
    seen = picked.filter("label IS NOT NULL AND size(embedding) > 0").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    planned = sizes(seen["n"], seen["dim"] or 1, threshold, probes, miss=miss)
    kind = "<f4" if picked.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    signed = checkpointed(_signatures(picked, kind, probes=probes, **planned))
    who = F.struct(F.col("vec_id").isNull().alias("nameless"), "vec_id")
    classes = signed.filter("class IS NOT NULL").groupBy(F.col("class").alias("id"))
    classes = checkpointed(classes.agg(F.min(who).alias("first"), F.count("*").alias("n_docs"), F.first("payload").alias("payload"), F.first("buckets").alias("buckets")))
    met = meetings(classes.select("id", F.explode("buckets").alias("bucket")))
    members = met.join(classes.select("id", F.col("n_docs").alias("weight"), "payload"), "id")
    table = summary(classes, checkpointed(verified(members, _cosine(threshold, kind)))).withColumnRenamed("id", "class")
    out = signed.select("vec_id", "class").join(table, "class", "left")
    component = F.when(F.col("head").isNull(), F.col("vec_id")).otherwise(F.col("head.vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
