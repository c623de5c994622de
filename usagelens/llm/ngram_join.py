"""N-gram Jaccard self-join: MinHash banding, then exact verification.

Documents whose sets of word ``n``-grams have Jaccard similarity of at least
``threshold`` are linked.  Documents with the same set form a class first (one
partial row a task), so copies are never compared.  Band and row counts are the
most selective ones that find a pair at the threshold with probability
``recall``; one row per band and class is shuffled on the band's hash.  Buckets
with the same members are kept once, and members of the kept buckets are
verified on their full n-gram sets in bounded blocks (``_blocks``).

Defined cases: a text with fewer than ``n`` words, but not none, is one n-gram;
null texts and texts without words link with nothing and are their own group;
rows with a null id take part and get the smallest non-null id of their group
(null if there is none; an own group without words: their own id); rows that
repeat an id are documents of their own; an empty table gives no rows; other
columns are not read.  A long text is one set, made by one task that holds about 30
bytes for each byte of it; its n-grams (8 bytes each) go with it where it is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm._blocks import meetings, summary, verified
from usagelens.llm._common import checkpointed, give_back, mixed, shingle_hashes, ship, text_slices, unused, word_bounds, word_hashes

_SEED = 74207281


def bands_for(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows for which at most ``most_hashes`` reach ``recall`` at ``threshold``."""
    best = (max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))), 1)
    for rows in range(2, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def _row_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, n-gram hashes, row bounds) of some rows at a time."""
    for row, data, offsets in text_slices(column):
        starts, ends, first = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        h, where = shingle_hashes(words, first, n)
        bounds = np.searchsorted(where, first)
        count = np.diff(first)
        for r in np.flatnonzero((count > 0) & (count < n)).tolist():  # a short text is one n-gram
            own, _ = shingle_hashes(words[first[r] : first[r + 1]], np.array([0, count[r]]), int(count[r]))
            h = np.insert(h, bounds[r], own)
            bounds[r + 1 :] += 1
        yield row, h, bounds


def _signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text hash, class (digest of the n-gram set; null without words) and one hash per band."""
    import hashlib

    multipliers = np.random.default_rng(_SEED).integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, h, bounds in _row_sets(batch.column("text"), n):
                size = len(bounds) - 1
                some = np.flatnonzero(np.diff(bounds))
                hashes = np.zeros((size, bands), np.uint64)
                for b in range(bands):
                    total = np.full(len(some), np.uint64(b + 1))
                    for k in range(rows):
                        low = np.minimum.reduceat(h * multipliers[b * rows + k], bounds[some]) if len(some) else total
                        total = mixed(total ^ low)
                    hashes[some, b] = total | np.uint64(1)
                digest: list[bytes | None] = [None] * size
                for r in some.tolist():
                    digest[r] = hashlib.blake2b(np.unique(h[bounds[r] : bounds[r + 1]]).tobytes(), digest_size=16).digest()
                flat = pa.array(hashes.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, size * bands + 1, bands, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(row, size) for c in ("doc_id", "text_hash")] + [pa.array(digest, pa.binary()), lists], names=["doc_id", "text_hash", "class", "bands"]
                )
            give_back()

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, class binary, bands array<long>"
    return docs.mapInArrow(run, schema)


def _jaccard(threshold: float):
    """Which pairs of byte strings of sorted 64-bit hashes reach the threshold."""
    parts, whole = round(threshold * 10_000), 10_000

    def linked(payloads: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sets = [np.frombuffer(p, np.uint64) for p in payloads]
        sizes = np.array([len(s) for s in sets], np.int64)
        small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
        out = whole * small >= parts * large  # else the sizes alone rule it out
        if 8 * out.sum() < len(sets) ** 2 or len(sets) <= 6:
            common = np.zeros(len(left), np.int64)
            for i in np.flatnonzero(out).tolist():
                common[i] = len(np.intersect1d(sets[left[i]], sets[right[i]], assume_unique=True))
        else:
            flat = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), sizes)
            _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
            shared = count > 1
            column = np.cumsum(shared) - 1
            keep = shared[inverse]
            owner, at = owner[keep], column[inverse[keep]]
            order = np.argsort(at, kind="stable")
            owner, at = owner[order], at[order]
            meets = np.zeros((len(sets), len(sets)), np.float32)
            width = max(1, (4 << 20) // len(sets))
            for lo in range(0, int(shared.sum()), width):
                a, b = np.searchsorted(at, [lo, lo + width])
                has = np.zeros((len(sets), width), np.float32)
                has[owner[a:b], at[a:b] - lo] = 1
                meets += has @ has.T
            common = meets[left, right].astype(np.int64)
        return out & (whole * common >= parts * (sizes[left] + sizes[right] - common))

    return linked


def ngram_groups(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (smallest id of its linked group), n_links, n_copies, kept.

    ``n_links`` counts the other documents whose set reaches the threshold (copies
    too); ``n_copies`` the documents with the same set.  ``kept`` marks the rows
    (id and text hash) that stand for their group: those with the smallest id,
    then the smallest text hash.
    """
    ship(docs.sparkSession)
    bands, rows = bands_for(threshold, recall)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    signed = checkpointed(_signatures(docs, n, bands, rows))
    who = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    classes = signed.filter("class IS NOT NULL").groupBy(F.col("class").alias("id")).agg(F.min(who).alias("first"), F.count("*").alias("n_docs"), F.first("bands").alias("bands"))
    classes = checkpointed(classes)

    spread = classes.select("id", F.explode("bands").alias("bucket"))
    candidates = checkpointed(meetings(spread).join(classes.select("id", "first", "n_docs"), "id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, h, bounds in _row_sets(batch.column("text"), n):
                size = len(bounds) - 1
                payload = [np.unique(h[a:b]).tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(row, size) for c in ("id", "weight", "met")] + [pa.array(payload, pa.binary())], names=["id", "weight", "met", "payload"])
            give_back()

    # one row of each class's first document; rows that repeat it whole are the same set
    same = (docs["text_hash"] == F.col("want.text_hash")) & docs["doc_id"].eqNullSafe(F.col("want.doc_id"))
    firsts = docs.join(candidates.select("id", F.col("first").alias("want"), F.col("n_docs").alias("weight"), "met"), same).select("id", "weight", "met", "text")
    payloads = firsts.mapInArrow(sets, "id binary, weight long, met array<struct<bucket:long,n:long>>, payload binary").dropDuplicates(["id"])
    table = summary(classes, checkpointed(verified(payloads, _jaccard(threshold)))).withColumnRenamed("id", "class")

    out = signed.select("doc_id", "text_hash", "class").join(table, "class", "left")
    alone = F.col("head").isNull()
    return out.select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_docs", F.lit(1)).cast("long").alias("n_copies"),
        (alone | (F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.text_hash") == F.col("text_hash")))).alias("kept"),
    )


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each linked group: the one with the smallest id (texts without words all stay)."""
    found = ngram_groups(docs, n, threshold, id_col=id_col, text_col=text_col)
    # rows that repeat id and text are told apart only here: `times` of them stand for one
    mark = unused(docs, "_kept")
    times, kept_id, kept_hash = f"{mark}_times", f"{mark}_id", f"{mark}_hash"
    kept = checkpointed(found.filter("kept").groupBy(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash)).agg(F.count("*").alias(times)))
    text = F.coalesce(docs[text_col], F.lit(""))
    joined = docs.join(kept, docs[id_col].eqNullSafe(F.col(kept_id)) & (F.xxhash64(text) == F.col(kept_hash))).drop(kept_id, kept_hash)
    if kept.filter(F.col(times) > 1).isEmpty():  # the texts are shuffled once
        return joined.drop(times)
    again = (F.col(times) > 1) & F.coalesce(F.col(text_col), F.lit("")).rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")
    return joined.filter(~again).unionByName(joined.filter(again).dropDuplicates([id_col, text_col])).drop(times)
