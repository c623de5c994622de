"""Merkle manifest of a data set: a tree per group of rows, and a tree over the groups.

``H`` is the lowercase hexadecimal SHA-256 of its inputs, concatenated (digests as
hexadecimal text).  A leaf is ``H`` of a row's fields (:func:`leaf_digest`).  Within a
group leaves ascend by id; while several nodes remain, every ``FAN`` consecutive ones
become their ``H`` (the last run may be shorter, even one).  What remains is the
group's subroot; the subroots, ordered by group (null first, then bytewise), make the
root likewise.

Nodes are labelled by nested intervals: a node of level L covers the leaf ranks
[lo, hi), the ranks whose quotient by ``FAN`` ** L is equal.  Going up, the nodes of
one level are grouped by the quotient of their ``lo`` (at most ``FAN`` rows a group).
Going down, each node is joined to its parent by that quotient as a bucket and by
containment of the intervals, one level at a time; the parent's children whose
interval is not the node's own are its siblings, those that end before it on its
left, the others on its right.  A node's *path* lists (left, right) from its own
level to the root, taken over from the parent, so no key of a join holds more than
``FAN`` rows on one side and one on the other, whatever the size of a group.
Ranks come from a range partitioning by (group, id) that cuts large groups
(``_scan.ranked``); every level is checkpointed.  A path holds ``FAN`` - 1 digests a
level, about 1 kB, and leaves are joined to those of their parents only, one for
``FAN`` leaves.

Defined cases: null fields are written ``-``, so null and empty texts differ; rows
with a null id come first in their group; rows that repeat an id are leaves of
their own, ordered by leaf digest (equal leaves are interchangeable); an empty table
gives no rows; other columns, whatever their names, are not read.  A text is hashed
whole, in the task that reads it, and never shuffled; its length is bounded by an
executor's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import checkpointed
from usagelens.llm._scan import ranked

FAN = 16
PATH = "array<struct<left:string,right:string>>"
_A_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf_digest(fields: list[Column]) -> Column:
    """``H`` of fields, each ``-`` if null, else its length in bytes, a colon and its value."""
    spelled = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*spelled), 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, lower-cased."""
    return F.translate(text, *_A_Z)


def _families(leaves: DataFrame) -> list[DataFrame]:
    """For each level from 1: (tree, size, lo, hi, digest, kids) of its nodes, kids being their children (lo, hi, digest).

    ``leaves`` has (tree, size, rank, digest); a tree of one leaf has no family."""
    nodes = leaves.select("tree", "size", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")
    largest, width, levels = leaves.agg(F.max("size")).first()[0] or 0, 1, []
    while width < largest:
        several = nodes.filter(F.col("size") > width)  # trees whose top is not reached yet
        bucket = _bucket(F.col("lo"), width * FAN)
        kids = several.groupBy("tree", "size", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        up = F.sha2(F.array_join("kids.digest", ""), 256)
        levels.append(checkpointed(kids.select("tree", "size", F.array_min("kids.lo").alias("lo"), F.array_max("kids.hi").alias("hi"), up.alias("digest"), "kids")))
        nodes, width = levels[-1].drop("kids"), width * FAN
    return levels


def _bucket(lo: Column, width: int) -> Column:
    """Where the interval of ``width`` ranks that holds rank ``lo`` begins."""
    return lo - lo % F.lit(width)


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of what remains of each tree."""
    tops = leaves.filter("size = 1").select("tree", "digest")
    for level in levels:
        tops = tops.unionByName(level.filter("lo = 0 AND hi = size").select("tree", "digest"))
    return tops


def _attached(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """``nodes`` with the path of each: its siblings in the parent that contains it, then the parent's path."""
    ends = [c for c in ("subroot", "root") if c in parents.columns]
    above = parents.select(F.col("tree").alias("t"), _bucket(F.col("lo"), width).alias("b"), F.col("lo").alias("from"), F.col("hi").alias("to"), "kids", F.col("path").alias("rest"), *ends)
    contained = (F.col("tree") == F.col("t")) & (_bucket(F.col("lo"), width) == F.col("b")) & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
    side = lambda test: F.array_join(F.transform(F.filter("kids", test), lambda k: k["digest"]), "")
    own = F.struct(side(lambda k: k["hi"] <= F.col("lo")).alias("left"), side(lambda k: k["lo"] >= F.col("hi")).alias("right"))
    return nodes.join(above, contained).withColumn("path", F.concat(F.array(own), "rest")).drop("t", "b", "from", "to", "kids", "rest")


def _descended(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves`` with the columns (path, subroot, root) that ``tops`` (tree, path, subroot, root) has for whole trees."""
    parents = None
    for i in reversed(range(len(levels))):
        family = levels[i].withColumnRenamed("kids", "below")
        whole = F.expr("lo = 0 AND hi = size")
        known = family.filter(whole).join(tops, "tree")
        if parents is not None:
            known = known.unionByName(_attached(family.filter(~whole), parents, FAN ** (i + 2)).select(known.columns))
        parents = known.withColumnRenamed("below", "kids")
    alone = leaves.filter("size = 1").join(tops, "tree")
    if parents is None:
        return alone
    several = leaves.filter("size > 1").withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
    return alone.unionByName(_attached(several, parents, FAN).select(alone.columns))


def manifest(leaves: DataFrame, group_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf") -> DataFrame:
    """``leaves`` (group, id, leaf digest and any further columns) with subroot, root and path of each row.

    ``path`` lists the siblings (digests joined, left and right of the node) from the leaf's level to the root."""
    group = F.col(group_col).cast("string")
    # '-' sorts before '=': the null group comes first, the others bytewise
    keyed = leaves.select(
        F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group)).alias("tree"), F.col(id_col).alias("id"), F.col(leaf_col).alias("digest"), F.struct(*leaves.columns).alias("row")
    )
    keyed = checkpointed(ranked(checkpointed(keyed), ["tree"], [F.col("id").asc_nulls_first(), F.col("digest")], "rank", "size"))
    levels = _families(keyed)
    tops = _tops(keyed, levels)
    over = checkpointed(ranked(checkpointed(tops.withColumnRenamed("tree", "member").withColumn("tree", F.lit("root"))), ["tree"], [F.col("member")], "rank", "size"))
    over_levels = _families(over)
    root = _tops(over, over_levels).select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    subroots = _descended(over, over_levels, root).select(F.col("member").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    found = _descended(keyed, levels, checkpointed(subroots))
    return found.select("row.*", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """``H`` of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]), 256))
