"""Prefix trie of rebuilt conversations, on composable fingerprints of their turns.

A conversation c is rebuilt from the first h(c) turns of its base conversation and
its own turns after its first h(c).  Texts are never put together: the fingerprint
of a sequence of turns is an element of a monoid, (length, value) with
(n, x) . (m, y) = (n + m, x + B^n y) modulo a prime (four independent ones, 124 bits),
so the prefix of a rebuilt conversation is the product of a head of its base and a
segment of its own products, taken from two stored prefixes.  Long conversations are
cut over partitions and their pieces composed in the same way.

Rows of equal depth and fingerprint make a node.  Equality is verified by the stored
turns that the rows refer to: all rows of a node must agree in their parent and in the
digest of their last turn, and a digest must stand for one (role, text) only, compared
whole over all stored turns.  By induction along the path a node then is one sequence.
If any comparison fails, everything is computed again with another hash seed.

What a node knows of its subtree comes from its members without walking the tree:
the smallest member owns a node, a conversation owns the end of its path from some
depth on, and every node of a subtree is owned by one of the members.  So a sum over
the subtree is a sum over members of what they own, and for the owner itself of what
it owns from that depth on.

Nothing gathers a key in one task: ranks and sums inside conversations and chains are
cut over partitions (``_scan``), groups are pre-aggregated, and joins send the rows
of the at most ``HOT`` heaviest keys to a broadcast.  Only the digest of a node's
ending members, which is sequential by definition, streams through one task for a node,
in pieces of ``IDS`` ids; that task holds one batch of pieces, not the node.

Defined cases: turns are ordered by turn (null first), repeated turn numbers by a hash
of role and text; null role or text is empty; rows without a conversation id are left out;
conversations without turns left after rebuilding end at the root; an empty table has no
nodes; other columns, whatever their names, are not read.  A text is held whole only in
the row that is hashed or compared, so its length is bounded by an executor's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm._common import checkpointed, ship
from usagelens.llm._scan import PART, joined, placed, ranked, within

#: Modulus and bases of the fingerprint's lanes.
PRIME = 2**31 - 1
BASES = (1_103_515_245, 214_013_773, 1_664_525_003, 1_140_671_485)
#: Most head turns that a conversation takes over.
HEAD = 5
#: Conversations of one base: ids that agree but for the last two digits.
BLOCK = 100
#: Ids in one piece of the text whose digest names a node's ending members.
IDS = 1000
SEEDS = 8
_LANES = range(len(BASES))
_NODE = ["depth", "f0", "f1"]


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % (HEAD + 1)).cast("long")


def base_of(conv: Column) -> Column:
    return conv - conv % BLOCK


def _times(a: Column, b: Column) -> Column:
    return F.pmod(a * b, F.lit(PRIME))


def _power(lane: int, k: Column) -> Column:
    """BASES[lane] ** k for 0 <= k < 2**32, from four tables of 256 powers."""
    out = None
    for digit in range(4):
        base = pow(BASES[lane], 256**digit, PRIME)
        table = F.lit(np.array([pow(base, j, PRIME) for j in range(256)], np.int64))
        entry = F.get(table, F.shiftright(k, 8 * digit).bitwiseAND(F.lit(255)).cast("int"))
        out = entry if out is None else _times(out, entry)
    return out


def _turn_hash(lane: int) -> Column:
    """A lane's value of a turn, from half a digest."""
    half = F.col(f"d{lane // 2}")
    return F.pmod(half if lane % 2 == 0 else F.shiftright(half, 32), F.lit(PRIME))


def _packed(lanes: list[Column]) -> list[Column]:
    return [(F.shiftleft(lanes[i], 31) + lanes[i + 1]).cast("long").alias(name) for i, name in ((0, "0"), (2, "1"))]


def _products(turns: DataFrame) -> DataFrame:
    """(conv, pos, v0..v3, d0, d1, chars): every stored turn with the product of its conversation up to it."""
    order = [F.col("turn").asc_nulls_first(), F.col("d0"), F.col("d1")]
    rows = placed(turns, ["conv"], order)
    upto = within(["conv"], order)
    local = rows.withColumn("at", F.row_number().over(Window.partitionBy(PART, "conv").orderBy(*order)).cast("long"))
    local = local.withColumns({f"t{i}": _times(_turn_hash(i), _power(i, F.col("at"))) for i in _LANES})
    local = local.withColumns({f"t{i}": F.pmod(F.sum(f"t{i}").over(upto), F.lit(PRIME)) for i in _LANES})
    local = checkpointed(local)
    # the pieces of a conversation, composed in the order of partitions
    pieces = local.groupBy(PART, "conv").agg(F.max("at").alias("n"), *[F.max_by(f"t{i}", "at").alias(f"p{i}") for i in _LANES])
    before = Window.partitionBy("conv").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    pieces = pieces.withColumns({f"c{i}": F.pmod(F.coalesce(F.sum(_times(F.col(f"p{i}"), _power(i, F.col("ahead")))).over(before), F.lit(0)), F.lit(PRIME)) for i in _LANES})
    later = pieces.filter("ahead > 0").select(PART, "conv", "ahead", *[f"c{i}" for i in _LANES])  # at most one a partition
    out = local.join(F.broadcast(later), [PART, "conv"], "left").withColumn("ahead", F.coalesce("ahead", F.lit(0)))
    value = lambda i: F.pmod(F.coalesce(F.col(f"c{i}"), F.lit(0)) + _times(_power(i, F.col("ahead")), F.col(f"t{i}")), F.lit(PRIME))
    return checkpointed(out.select("conv", (F.col("ahead") + F.col("at")).alias("pos"), *[value(i).alias(f"v{i}") for i in _LANES], "d0", "d1", "chars"))


def _conversations(products: DataFrame, head_of: Callable[[Column], Column], base: Callable[[Column], Column]) -> DataFrame:
    """One row per conversation: its own turns, where its own segment starts, the head it takes over, and two products."""
    start = F.when(base(F.col("conv")) == F.col("conv"), F.lit(0)).otherwise(head_of(F.col("conv"))).cast("long")
    at_start = [F.coalesce(F.max(F.when(F.col("pos") == F.col("start"), F.col(f"v{i}"))), F.lit(0)).alias(f"s{i}") for i in _LANES]
    convs = products.withColumn("start", start).groupBy("conv", "start").agg(F.count(F.lit(1)).alias("own"), *at_start)
    first = products.filter((base(F.col("conv")) == F.col("conv")) & (F.col("pos") <= HEAD)).groupBy(F.col("conv").alias("base"))
    heads = first.agg(F.array_sort(F.collect_list(F.struct("pos", *[f"v{i}" for i in _LANES], "d0", "d1", "chars"))).alias("stored"))
    convs = convs.withColumn("base", base(F.col("conv"))).join(heads, "base", "left")
    stored = F.coalesce("stored", F.array().cast(heads.schema["stored"].dataType))
    convs = convs.withColumn("head", F.slice(stored, F.lit(1), F.col("start").cast("int"))).drop("stored")
    convs = convs.withColumns({"shared": F.size("head").cast("long"), **{f"h{i}": F.coalesce(F.get(f"head.v{i}", F.size("head") - 1), F.lit(0)) for i in _LANES}})
    return checkpointed(convs.withColumn("length", F.col("shared") + F.greatest(F.col("own") - F.col("start"), F.lit(0))))


def _prefixes(products: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, f0, f1, p0, p1, d0, d1, chars, last): a row for each prefix of each rebuilt conversation."""
    total = products.count()
    inverse = [F.lit(np.array([pow(BASES[i], -k, PRIME) for k in range(HEAD + 1)], np.int64)) for i in _LANES]

    def whole(i: int, value: Column) -> Column:
        """Product of the head and the own segment that ends at the stored product ``value``."""
        segment = _times(F.get(inverse[i], (F.col("start") - F.col("shared")).cast("int")), F.pmod(value - F.col(f"s{i}"), F.lit(PRIME)))
        return F.pmod(F.col(f"h{i}") + segment, F.lit(PRIME))

    known = convs.select("conv", "start", "shared", "length", "own", *[f"{x}{i}" for x in "sh" for i in _LANES])
    own = joined(products, known, ["conv"], "own", total).filter("pos > start")
    last_one = [F.pmod(F.col(f"v{i}") - _times(_turn_hash(i), _power(i, F.col("pos"))), F.lit(PRIME)) for i in _LANES]
    f, p = _packed([whole(i, F.col(f"v{i}")) for i in _LANES]), _packed([whole(i, last_one[i]) for i in _LANES])
    depth = F.col("pos") - F.col("start") + F.col("shared")
    columns = ["conv", "depth", "f0", "f1", "p0", "p1", "d0", "d1", "chars", "last"]
    own = own.select("conv", depth.alias("depth"), *[c.alias(f"f{k}") for k, c in enumerate(f)], *[c.alias(f"p{k}") for k, c in enumerate(p)], "d0", "d1", "chars", (depth == F.col("length")).alias("last"))
    zero = F.lit(0).cast("long")
    lead = convs.select("conv", "length", "head", F.explode("head").alias("x"))
    lead = lead.withColumn("before", F.get("head", (F.col("x.pos") - 2).cast("int")))
    f = _packed([F.col(f"x.v{i}") for i in _LANES])
    p = _packed([F.coalesce(F.col(f"before.v{i}"), zero) for i in _LANES])
    lead = lead.select("conv", F.col("x.pos").alias("depth"), *[c.alias(f"f{k}") for k, c in enumerate(f)], *[c.alias(f"p{k}") for k, c in enumerate(p)], "x.d0", "x.d1", "x.chars", (F.col("x.pos") == F.col("length")).alias("last"))
    root = convs.select("conv", *[zero.alias(c) for c in columns[1:-1]], (F.col("length") == 0).alias("last"))
    return checkpointed(own.select(columns).unionByName(lead.select(columns)).unionByName(root))


def _ending(rows: DataFrame) -> DataFrame:
    """(depth, f0, f1, ends): SHA-256 of the ids of the conversations that end in a node, ascending and joined by commas."""
    ship(rows.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            new = np.zeros(len(conv), bool)
            new[::IDS] = True
            for k in _NODE:
                x = batch.column(k).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            first = np.flatnonzero(new)
            spelled = conv.astype(str).tolist()
            texts = [",".join(spelled[a:b]) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(conv)], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(first)) for k in _NODE], pa.array(conv[first]), pa.array(texts, pa.string())], names=[*_NODE, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names=[*_NODE, "ends"])

        for batch in batches:
            done = []
            for *at, ids in zip(*[batch.column(k).to_pylist() for k in (*_NODE, "ids")], strict=True):
                if at == node:
                    digest.update(b"," + ids.encode())
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = at, hashlib.sha256(ids.encode())
            if done:
                yield made(done)
        if node is not None:
            yield made([(*node, digest.hexdigest())])

    keys = "depth long, f0 long, f1 long"
    sorted_rows = rows.select(*_NODE, "conv").repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    listed = sorted_rows.mapInArrow(pieces, f"{keys}, first long, ids string")
    return listed.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(digests, f"{keys}, ends string")


def _nodes(rows: DataFrame) -> DataFrame:
    agree = [F.min(c).alias(c) for c in ("p0", "p1", "d0", "d1")] + [F.max(c).alias(f"{c}_most") for c in ("p0", "p1", "d0", "d1")]
    return checkpointed(rows.groupBy(*_NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), *agree))


def trie(conversations: DataFrame, head_of: Callable[[Column], Column] = head_length, base: Callable[[Column], Column] = base_of, seed: int = 0) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``head_of(conv_id)`` (0 to ``HEAD``) is the number of turns taken over from the conversation ``base(conv_id)``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), "turn", text("role").alias("role"), text("text").alias("text"))
    for attempt in range(seed, seed + SEEDS):
        digest = [F.xxhash64(F.lit(2 * attempt + k), "role", "text").alias(f"d{k}") for k in range(2)]
        kinds = turns.select(*digest, "role", "text").distinct().groupBy("d0", "d1").agg(F.count(F.lit(1)).alias("n"))
        if not kinds.filter("n > 1").isEmpty():
            continue
        light = checkpointed(turns.select("conv", "turn", *digest, F.length("text").cast("long").alias("chars")))
        products = _products(light)
        convs = _conversations(products, head_of, base)
        rows = _prefixes(products, convs)
        nodes = _nodes(rows)
        if nodes.filter(" OR ".join(f"{c} != {c}_most" for c in ("p0", "p1", "d0", "d1"))).isEmpty():
            break
    else:
        raise ValueError(f"fingerprints collide under each of {SEEDS} seeds")
    return _told(rows, convs, nodes)


def _told(rows: DataFrame, convs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes with their parents, children, leaves, saved tokens and ending members."""
    above = [(F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"), F.col("p1").alias("f1")]
    children = nodes.filter("depth > 0").select(*above).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = checkpointed(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")))
    n_rows, n_nodes = rows.count(), nodes.count()
    # what a conversation owns: the tokens saved in its nodes, and a leaf
    owned = nodes.groupBy("conv").agg(F.sum("saved").alias("owns"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"))
    owned = owned.join(convs.select("conv", (F.col("length") + 1).alias("rows")), "conv")
    sums = joined(rows.select("conv", *_NODE), owned, ["conv"], "rows", n_rows)
    sums = sums.groupBy(*_NODE).agg(F.sum("owns").alias("owns"), F.sum("leaf").alias("n_leaves"))
    # a node's owner counts with what it owns from that depth on; only shared nodes save anything
    down = ranked(nodes.filter("n_convs > 1").select("conv", "depth", "saved"), ["conv"], [F.col("depth").desc()], "place", "size", {"below": "saved"})
    down = down.join(owned.select("conv", F.col("owns").alias("own")), "conv").select("conv", "depth", (F.col("below") - F.col("own")).alias("less"))
    parents = nodes.filter("n_children > 0").select(*_NODE, F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("weight"))
    told = nodes.filter("depth > 0").select("conv", F.col("depth").alias("own_depth"), *above)
    told = joined(told, parents, _NODE, "weight", n_nodes).select("conv", F.col("own_depth").alias("depth"), "parent_conv_id")
    out = nodes.join(told, ["conv", "depth"], "left").join(down, ["conv", "depth"], "left").join(sums, _NODE).join(_ending(rows.filter("last")), _NODE, "left")
    long = lambda c: c.cast("long")
    return out.select(
        long(F.col("conv")).alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        long(F.col("n_children")).alias("n_children"),
        long(F.col("n_leaves")).alias("n_leaves"),
        long(F.when(F.col("less").isNull(), F.lit(0)).otherwise(F.col("less") + F.col("owns"))).alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
