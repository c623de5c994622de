import random

import pytest

from usagelens.llm import prefix_trie
from usagelens.llm.prefix_trie import trie

from .brute import trie as brute

SCHEMA = "conv_id long, turn long, role string, text string, depth long, f0 long, conv string, _part int"


def compare(spark, turns, **options):
    frame = spark.createDataFrame([(*t, 9, 9, "x", 7) for t in turns], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in trie(frame, **options).collect()), key=lambda r: r[:2])
    assert got == brute(turns)


def talks(seed, convs, least=0, most=9, words=3):
    """Conversations of few different turns, so that prefixes are shared."""
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "béé", "😀 x", "", None][:words])) for c in convs for t in range(rng.randint(least, most))]


def test_shared_prefixes(spark):
    compare(spark, talks(1, [*range(60), *range(100, 140), *range(-130, -90), 305, 1_000_007]))


def test_edges(spark):
    turns = [(100, 0, "u", "one"), (101, None, "u", "first"), (101, 3, None, None), (101, 0, "a", ""), (None, 0, "u", "lost")]
    turns += [(102, 0, "u", "same")] * 4  # repeated rows
    turns += [(200, 0, "u", "x"), (203, 0, "u", "only turn"), (250, 0, "u", "only turn")]  # some end at the root or their base
    turns += [(300, 0, "ab", "c"), (400, 0, "a", "bc")]  # role and text are kept apart
    turns += [(500, 0, "u", "long " * 400_000)]
    compare(spark, turns)


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie(spark.createDataFrame([(None, 1, "u", "x", 1, 1, "x", 1)], SCHEMA)).count() == 0


def test_long_conversation_over_partitions(spark):
    """One conversation, and a copy of it, hold most rows; its pieces are composed over partitions."""
    turns = [(c, t, "u", f"turn {t}") for c in (700, 800) for t in range(3000)] + talks(2, range(700, 760))
    frame = spark.createDataFrame([(*t, 9, 9, "x", 7) for t in turns], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((tuple(r) for r in trie(frame).collect()), key=lambda r: r[:2])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for r in brute([t for t in turns if t[1] < 40]):
        want[r[0], r[1]] = r
    # the brute version is quadratic in a path: compare the shallow nodes, and the whole chain by its rule
    chain = [r for r in got if r[0] == 700]
    assert [r[1] for r in chain] == list(range(len(chain))) and chain[-1][1] == 3000
    assert all(r[3] >= 2 for r in chain)
    assert {(r[0], r[1], r[2], r[3], r[4]) for r in got if r[1] < 30} == {r[:5] for r in want.values() if r[1] < 30}
    tail = 0
    for r in reversed(chain):
        if r[1] > 40:
            tail += (r[3] - 1) * len(f"turn {r[1] - 1}")
            assert r[6] == tail and r[5] == 1


def test_collisions_are_seen(spark, monkeypatch):
    """With a small modulus some seeds collide; they are noticed and another one gives the right nodes."""
    turns = [(c, t, "u", f"{c}-{t}") for c in range(0, 120_000, 100) for t in range(2)]
    rounds, made = [], prefix_trie._nodes
    monkeypatch.setattr(prefix_trie, "_nodes", lambda rows: rounds.append(1) or made(rows))
    monkeypatch.setattr(prefix_trie, "PRIME", 31)
    compare(spark, turns)
    assert len(rounds) > 1
    monkeypatch.setattr(prefix_trie, "PRIME", 11)
    with pytest.raises(ValueError, match="collide"):
        compare(spark, turns)


def test_own_head_rule(spark):
    """Other rules for the head and the base are possible: nothing taken over."""
    from pyspark.sql import functions as F

    turns = [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "u", "b")]
    frame = spark.createDataFrame([(*t, 9, 9, "x", 7) for t in turns], SCHEMA)
    got = {(r.conv_id, r.depth): (r.n_convs, r.n_children) for r in trie(frame, head_of=lambda c: F.lit(0), base=lambda c: c).collect()}
    assert got == {(1, 0): (2, 1), (1, 1): (2, 1), (2, 2): (1, 0)}
