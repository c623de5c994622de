"""Benchmark decontamination as a prefix-filtered containment join.

A benchmark item's windows are its runs of ``window`` consecutive words (an item
with fewer words, but not none, is one window).  A window occurs in a document
only if all its shingles do, so its rarest one is a sufficient prefix:

1. shingles (``SHINGLE`` words, or all words of a tinier item) of the items are
   counted in the documents, one partial count a task;
2. every window keeps its rarest shingle (ties by hash and position);
3. documents send only the places of such shingles, with the words around them,
   and those places are joined on the shingle;
4. each pair is verified word by word: the match is extended both ways, within
   the bounds of document and item, and counts if it covers a whole window.

Documents know which shingles to send from a Bloom filter of fixed size
(``FILTER_BITS``), built by an aggregate; a benchmark of any size only lets more
places through to the join, whose rows Spark shuffles.  Identical items are
joined once and listed by all their ids.

Defined cases: a null text has no words; items with a null id or without words
are ignored; items that repeat an id with the same words count once, with others each text
counts under that id; documents with null or repeated
ids keep one output row each; other columns are not read.  A long text's words are
hashed by one task, which holds about 30 bytes for each byte of it; only the places
that match are sent on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from usagelens.llm._common import checkpointed, ship, shingle_hashes, text_slices, text_words, unused, word_bounds, word_hashes

#: Words of the shingles that are counted and joined.
SHINGLE = 3
#: Size of the Bloom filter that tells documents which shingles to send (1 MB).
FILTER_BITS = 1 << 23


def _bits(h: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return [(h & mask).astype(np.int64), ((h >> np.uint64(40)) & mask).astype(np.int64)]


def _filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Bloom filter of a column of signed 64-bit hashes: at most FILTER_BITS / 32 rows reach the driver."""
    h = F.col(column)
    spots = F.array(h.bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned(h, 40).bitwiseAND(FILTER_BITS - 1))
    words = (
        hashes.select(F.explode(spots).alias("bit"))
        .groupBy(F.shiftright("bit", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 AS int))")).alias("value"))
        .collect()
    )
    flags = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in words:
        flags[r["word"]] = r["value"]
    return flags


def _passes(flags: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), dtype=bool)
    for bit in _bits(h):
        out &= (flags[bit >> 5] >> (bit & 31).astype(np.uint32)) & np.uint32(1) == 1
    return out


def _item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [[w.decode("utf-8", "surrogatepass") for w in text_words(x)] for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words, pa.list_(pa.string()))], names=["item_id", "words"])

    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).filter("item_id IS NOT NULL")
    return rows.mapInArrow(run, "item_id string, words array<string>").filter(F.size("words") > 0)


def _item_shingles(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, at, h = [], [], []
            for c, words in zip(batch.column("cls").to_pylist(), batch.column("words").to_pylist(), strict=True):
                text = pa.array([" ".join(words)])
                for _, data, offsets in text_slices(text):
                    starts, ends, first = word_bounds(data, offsets)
                    found, where = shingle_hashes(word_hashes(data, starts, ends), first, min(SHINGLE, len(words)))
                    cls += [c] * len(found)
                    at.append(where)
                    h.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.string()), pa.array(np.concatenate([np.zeros(0, np.int64), *at])), pa.array(np.concatenate([np.zeros(0, np.int64), *h]))], names=["cls", "at", "h"]
            )

    return classes.mapInArrow(run, "cls string, at long, h long")


def _shingle_counts(docs: DataFrame, flags: np.ndarray, sizes: list[int]) -> DataFrame:
    """Number of documents with each shingle that passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch.column("text")):
                starts, ends, first = word_bounds(data, offsets)
                words = word_hashes(data, starts, ends)
                for k in sizes:
                    h, where = shingle_hashes(words, first, k)
                    keep = _passes(flags, h)
                    h, where = h[keep], where[keep]
                    row = np.searchsorted(first, where, "right")
                    order = np.lexsort((row, h))
                    h, row = h[order], row[order]
                    new = np.ones(len(h), dtype=bool)  # once a document
                    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                    found, n = np.unique(h[new], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n_docs"))


def _places(docs: DataFrame, flags: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """One row a document: its number, words, and the places of shingles that pass the filter."""
    place = T.StructType([T.StructField("h", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("near", T.StringType())])
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(place))]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column("doc_id")
            for start, data, offsets in text_slices(batch.column("text")):
                begin, end, first = word_bounds(data, offsets)
                words = word_hashes(data, begin, end)
                n = len(offsets) - 1
                found: list[list[dict]] = [[] for _ in range(n)]
                for k in sizes:
                    h, where = shingle_hashes(words, first, k)
                    keep = _passes(flags, h)
                    h, where = h[keep], where[keep]
                    which = np.searchsorted(first, where, "right") - 1
                    for x, p, r in zip(h.view(np.int64).tolist(), where.tolist(), which.tolist(), strict=True):
                        lo, hi = max(int(first[r]), p - window + k), min(int(first[r + 1]), p + window)
                        near = b" ".join(text_words_of(data, begin, end, lo, hi))
                        found[r].append({"h": x, "pos": p - int(first[r]), "at": p - lo, "near": near.decode("utf-8", "surrogatepass")})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), ids.slice(start, n), pa.array(np.diff(first)), pa.array(found, arrow.field("places").type)], schema=arrow
                )
                row += n

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def text_words_of(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: int, hi: int) -> list[bytes]:
    """Words ``lo`` to ``hi`` of a split slice, lower-cased."""
    from usagelens.llm._common import _LOWER

    return [data[a:b].tobytes().translate(_LOWER) for a, b in zip(begin[lo:hi].tolist(), end[lo:hi].tolist(), strict=True)]


def _run_length(n: Column, same) -> Column:
    """How many of 0 .. n-1 in a row satisfy ``same`` from the start."""
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(0), lambda acc, j: F.when((acc == j) & same(j), j + 1).otherwise(acc))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids as text, sorted), spans (word ranges hit, end exclusive)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    members = checkpointed(_item_words(items, item_col, item_text_col).distinct())
    # an id may come with several texts, so a class is named by its words
    classes = members.select("words").distinct().withColumn("cls", F.sha2(F.array_join("words", " "), 256))
    classes = checkpointed(classes)
    members = members.join(classes, "words").select("cls", "item_id")
    shingles = checkpointed(_item_shingles(classes))
    sizes = [r[0] for r in classes.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]

    counts = _shingle_counts(docs, _filter(shingles, "h"), sizes)
    counted = shingles.join(counts, "h").join(classes, "cls")
    of_item = Window.partitionBy("cls").orderBy("at")
    n = F.size("words")
    k, whole = F.least(n, F.lit(SHINGLE)), F.least(n, F.lit(window))
    # shingles of the window that starts at a position: those at most whole - k words further on
    near = F.struct("n_docs", "h", "at")
    rarest = F.min(near).over(of_item.rangeBetween(0, window - SHINGLE))
    held = F.count("*").over(of_item.rangeBetween(0, window - SHINGLE))
    picked = counted.select("cls", "words", "at", rarest.alias("rare"), held.alias("held"), n.alias("n"), k.alias("k"), whole.alias("whole"))
    # a window with a shingle that no document has cannot occur
    picked = picked.filter((F.col("at") <= F.col("n") - F.col("whole")) & (F.col("held") >= F.col("whole") - F.col("k") + 1))
    prefixes = checkpointed(picked.select("cls", "words", "whole", F.col("rare.h").alias("h"), F.col("rare.at").cast("int").alias("item_at")).distinct())

    placed = checkpointed(_places(docs, _filter(prefixes, "h"), sizes, window))
    pairs = placed.select("row", F.explode("places").alias("p")).select("row", "p.*").join(prefixes, "h")
    pairs = pairs.withColumn("near", F.split("near", " "))
    left = _run_length(F.least("at", "item_at"), lambda j: F.get("near", F.col("at") - 1 - j) == F.get("words", F.col("item_at") - 1 - j))
    right = _run_length(F.least(F.size("near") - F.col("at"), F.size("words") - F.col("item_at")), lambda j: F.get("near", F.col("at") + j) == F.get("words", F.col("item_at") + j))
    pairs = pairs.select("row", "cls", "pos", "whole", left.alias("l"), right.alias("r")).filter(F.col("l") + F.col("r") >= F.col("whole"))
    hits = checkpointed(pairs.select("row", "cls", (F.col("pos") - F.col("l")).alias("lo"), (F.col("pos") + F.col("r")).alias("hi")).distinct())

    merge = lambda acc, s: F.when(  # noqa: E731 - ranges sorted by start: join those that touch
        (F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] >= s["lo"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["lo"].alias("lo"), F.greatest(F.element_at(acc, -1)["hi"], s["hi"]).alias("hi")))),
    ).otherwise(F.concat(acc, F.array(s)))
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    spans = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("s"))
    spans = spans.select("row", F.aggregate("s", none, merge).alias("spans"))
    listed = hits.select("row", "cls").distinct().join(members, "cls").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    out = placed.select("row", "doc_id", "n_words").join(spans.join(listed, "row"), "row", "left")
    hit_words = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["hi"] - s["lo"]))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce(hit_words, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", none).alias("spans"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs; all columns stay."""
    key = unused(docs, "_key")  # id and text, so that rows which repeat an id are told apart
    keyed = docs.withColumn(key, F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).cast("string")))
    found = contamination(keyed, items, window, key, text_col, item_col, item_text_col)
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(hit, key, "left_anti").drop(key).select(*docs.columns)
