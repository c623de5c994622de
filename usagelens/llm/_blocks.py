"""Verified links inside buckets, a bounded pair of blocks at a time.

A bucket of any size is cut into blocks by a hash of the member; every pair of
blocks is one group of rows, so a task never holds more than two blocks of a
bucket and no row is made for a pair of members.  A pair that meets in several
buckets is counted only in the first of them that both members share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import checkpointed, give_back, ship
from usagelens.llm._components import components
from usagelens.llm._scan import joined

#: Members of a block, and rows of a group that is verified together with other groups.
BLOCK = 512
SMALL = 64

LINKS = "u binary, v binary, links long"


def block_pairs(n: Column, member: Column) -> Column:
    """array<struct<bi, bj, own>>: the pairs of blocks that a member of a bucket of ``n`` belongs to."""
    blocks = F.ceil(n / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    return F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("bi"), F.greatest(own, j).alias("bj"), own.alias("own")))


def roots_of(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under the given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def shared_before(buckets: list[list[int]], bucket: int) -> np.ndarray:
    """Member by member matrix: do the two share a bucket with a smaller number than this one?"""
    n = len(buckets)
    owner = np.repeat(np.arange(n), [len(b) for b in buckets])
    flat = np.fromiter((x for b in buckets for x in b), np.int64, len(owner))
    earlier = flat < bucket
    owner, flat = owner[earlier], flat[earlier]
    _, column, uses = np.unique(flat, return_inverse=True, return_counts=True)
    shared = uses > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    out = np.zeros((n, n), np.float32)
    width = max(1, (4 << 20) // max(n, 1))
    for lo in range(0, int(shared.sum()), width):
        part = (column >= lo) & (column < lo + width)
        has = np.zeros((n, width), np.float32)
        has[owner[part], column[part] - lo] = 1
        out += has @ has.T
    return out > 0


def first_meeting(buckets: pa.ListArray, bucket: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of pairs of rows: is the bucket of the left one the smallest that both rows' lists share?"""
    start = np.frombuffer(buckets.buffers()[1], np.int32)[buckets.offset : buckets.offset + len(buckets) + 1]
    flat, size = buckets.values.to_numpy(), np.diff(start)
    out = np.ones(len(left), dtype=bool)
    order = np.argsort(np.maximum(size[left], size[right]), kind="stable")
    for at in range(0, len(order), 2_000):
        pick = order[at : at + 2_000]
        wide = int(max(size[left[pick]].max(), size[right[pick]].max()))
        sides = []
        for rows, none in ((left[pick], -1), (right[pick], -2)):
            inside = np.arange(wide) < size[rows][:, None]
            lists = flat[np.where(inside, start[rows][:, None] + np.arange(wide), 0)]
            # buckets from this one on do not count; -1 and -2 stand for none
            sides.append(np.where(inside & (lists < bucket[rows][:, None]), lists, none))
        a, b = sides
        marked = (a != -1)[:, :, None]
        out[pick] = ~((a[:, :, None] == b[:, None, :]) & marked).any(axis=(1, 2))
    return out


def meetings(spread: DataFrame) -> DataFrame:
    """(id, met) from one row per member and bucket: the buckets (and their sizes) where each member meets others.

    Buckets with the same members are kept once; they are told by their size and
    two hashes of the member set, computed as partial aggregates.
    """
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "id")).alias(f"x{i}") for i in (0, 1)]
    buckets = spread.groupBy("bucket").agg(F.count("*").alias("n"), *marks).filter("n > 1")
    buckets = checkpointed(buckets.groupBy("n", "x0", "x1").agg(F.min("bucket").alias("bucket")).select("bucket", "n"))
    total = buckets.agg(F.sum("n")).first()[0] or 0  # rows of the buckets that are left
    return joined(spread, buckets, ["bucket"], "n", total, stored=True).groupBy("id").agg(F.collect_list(F.struct("bucket", "n")).alias("met"))


def summary(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, n_docs, head, n_links) of all classes (id, first, n_docs): the smallest ``first`` of the linked group, and the documents linked to."""
    roots = components(links.filter("v IS NOT NULL").select("u", "v"))
    counts = links.filter("v IS NULL").groupBy("u").agg(F.sum("links").alias("links"))
    table = classes.select("id", "first", "n_docs").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").join(counts.select(F.col("u").alias("id"), "links"), "id", "left")
    table = checkpointed(table.withColumn("root", F.coalesce("root", "id")))
    heads = table.groupBy("root").agg(F.min("first").alias("head"), F.count(F.lit(1)).alias("members"))
    return joined(table, checkpointed(heads), ["root"], "members", table.count(), stored=True).select("id", "n_docs", "head", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"))


def verified(members: DataFrame, linked: Callable[[list, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Links among ``members`` (id, weight, met, payload): u, v, links.

    ``linked(payloads, left, right)`` tells which pairs are links.  Returned rows:
    (u, null, links) with the weights of the members linked to u, and (u, v,
    null) joining u to the first member of its local component.
    """
    ship(members.sparkSession)
    keys = ["bucket", "bi", "bj"]
    rows = members.select("id", "weight", "payload", F.col("met.bucket").alias("buckets"), F.explode("met").alias("m"))
    rows = rows.select("id", "weight", "payload", "buckets", "m.bucket", F.explode(block_pairs(F.col("m.n"), F.col("id"))).alias("b")).select("*", "b.*").drop("b")
    placed = rows.repartition(*keys).sortWithinPartitions(*keys, "id")

    def found(table: pa.Table, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Output rows of the given pairs of rows, if they are links."""
        used, at = np.unique(np.concatenate([left, right]), return_inverse=True)
        table, left, right = table.take(pa.array(used)), at[: len(left)], at[len(left) :]
        yes = linked(table["payload"].to_pylist(), left, right) if len(left) else np.zeros(0, bool)
        left, right = left[yes], right[yes]
        if not len(left):
            return
        n, weight = table.num_rows, table["weight"].to_numpy()
        links = np.bincount(left, weight[right], n) + np.bincount(right, weight[left], n)
        root = roots_of(n, left, right)
        met = np.flatnonzero(links > 0)
        joined = np.flatnonzero(root != np.arange(n))
        ids = table["id"].combine_chunks().cast(pa.binary())
        u = pa.concat_arrays([ids.take(pa.array(met)), ids.take(pa.array(joined))])
        v = pa.concat_arrays([pa.nulls(len(met), pa.binary()), ids.take(pa.array(root[joined]))])
        counts = pa.concat_arrays([pa.array(links[met].astype(np.int64)), pa.nulls(len(joined), pa.int64())])
        yield pa.RecordBatch.from_arrays([u, v, counts], names=["u", "v", "links"])

    def groups(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All groups of rows between ``bounds``: small ones together, large ones one by one."""
        size, own = np.diff(bounds), table["own"].to_numpy()
        split = (table["bi"].to_numpy() != table["bj"].to_numpy())[bounds[:-1]]
        small = (size <= SMALL) & ~split
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in np.unique(size[small & (size > 1)]).tolist():
            i, j = np.triu_indices(n, 1)
            begin = bounds[:-1][small & (size == n)][:, None]
            left.append((begin + i).ravel())
            right.append((begin + j).ravel())
        left, right = np.concatenate(left), np.concatenate(right)
        fits = first_meeting(table["buckets"].combine_chunks(), table["bucket"].to_numpy(), left, right)
        yield from found(table, left[fits], right[fits])
        for g in np.flatnonzero(~small).tolist():
            part = table.slice(bounds[g], size[g])
            left, right = np.triu_indices(size[g], 1)
            if split[g]:
                apart = own[bounds[g] : bounds[g + 1]][left] != own[bounds[g] : bounds[g + 1]][right]
                left, right = left[apart], right[apart]
            fits = ~shared_before(part["buckets"].to_pylist(), part["bucket"][0].as_py())[left, right]
            yield from found(part, left[fits], right[fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            bounds = _bounds(table, keys)
            if len(bounds) > 2:
                yield from groups(table.slice(0, bounds[-2]), bounds[:-1])
            held = table.slice(bounds[-2]) if len(bounds) > 1 else None
            held = held.take(pa.array(np.arange(held.num_rows))) if held is not None and held.num_rows < table.num_rows else held  # not the whole batch
            del table, batch
            give_back()
        if held is not None and held.num_rows:
            yield from groups(held, np.array([0, held.num_rows]))

    return placed.mapInArrow(run, LINKS)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each run of equal keys, and the end."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        x = table[k].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
