"""Word overlap and greedy acceptance against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from temperament.operators import joins, similarity

WORDS = "the of a to and in red green blue tall short loud quiet river stone cloud".split()


def clashes(message, pool):
    """Twice the multiset of words that a pool message covers outweighs the message."""
    count = Counter(message.split())
    total = sum(count.values())
    return any(2 * sum(n for word, n in count.items() if word in set(other.split())) > total for other in pool)


def greedy(candidates, seeds, cap):
    kept = []
    for _, message in sorted(candidates):
        if len(kept) < cap and not clashes(message, seeds + kept):
            kept.append(message)
    return kept


def sentences(n, seed):
    draw = random.Random(seed)
    weights = [len(WORDS) - i for i in range(len(WORDS))]
    return [" ".join(draw.choices(WORDS, weights, k=draw.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize(
    "new, other, similar",
    [
        ("a b c d e", "a b c x", True),  # 3 of 5
        ("a b c d", "a b x y", False),  # exactly half
        ("a a b c", "a z", False),
        ("a a a c", "a z", True),  # a repeated word counts each time
        ("a b", "a b c d e f", True),
        ("a b c d e f", "a b", False),  # not symmetric
    ],
)
def test_measure(spark, new, other, similar):
    frame = spark.createDataFrame([(new,)], "message string")
    pool = spark.createDataFrame([(other,)], "text string")
    assert similarity.similar(frame, pool, "message", "text").count() == int(similar)
    assert similarity.novel(frame, pool, "message", "text").count() == int(not similar)


@pytest.mark.parametrize("keyed", [False, True])
def test_join_equals_the_loop(spark, monkeypatch, keyed):
    names = [None, "k1", "k2"]  # a null key meets a null key
    new = [(names[i % 3], i, s) for i, s in enumerate(sentences(400, 1) + sentences(40, 2) + sentences(40, 2))]
    pool = [(names[i % 2], s) for i, s in enumerate(sentences(30, 3) + sentences(40, 2)[:5])]
    frame = spark.createDataFrame(new, "k string, seq int, message string")
    others = spark.createDataFrame(pool, "k string, message string")
    expected = {
        seq for k, seq, message in new if not clashes(message, [m for kk, m in pool if not keyed or kk == k])
    }
    keys = ["k"] if keyed else []
    for limit in (joins.BROADCAST_BYTES, 0):
        monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (limit,))
        joined = similarity.novel(frame, others, "message", "message", keys)
        assert {r["seq"] for r in joined.collect()} == expected
    assert 0 < len(expected) < len(new)


@pytest.mark.parametrize("round_size", [4, 256])
def test_acceptance_equals_the_greedy_loop(spark, round_size):
    seeds = {"x": ["red river stone", "tall cloud"], "y": ["loud"], "z": []}
    draw, rows = random.Random(5), []
    vocabulary = [f"w{i}" for i in range(60)]
    for key, n in [("x", 150), ("y", 30), ("z", 3)]:
        for seq in range(n):
            rows.append((key, seq, " ".join(draw.sample(vocabulary, draw.randint(2, 6)))))
        rows.append((key, n, rows[-1][2]))
    frame = spark.createDataFrame(rows, "k string, seq bigint, message string").repartition(4)
    pool = spark.createDataFrame([(k, m) for k, ms in seeds.items() for m in ms], "k string, message string")
    found = similarity.accept_in_order(frame, pool, ["k"], cap=20, round_size=round_size)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["k"], r["seq"])):
        got.setdefault(r["k"], []).append(r["message"])
    for key in seeds:
        assert got[key] == greedy([(s, m) for k, s, m in rows if k == key], seeds[key], 20)
    assert len(got["x"]) == 20


def test_acceptance_without_survivors(spark):
    frame = spark.createDataFrame([("x", 1, "a b c")], "k string, seq bigint, message string")
    found = similarity.accept_in_order(frame, frame.select("k", "message"), ["k"])
    assert found.columns == ["k", "seq", "message"] and found.count() == 0


def test_expansion_slices(spark):
    small = spark.range(20).select(F.col("id").alias("n"), F.repeat(F.lit("x"), 50).alias("filler"))
    whole = joins.for_each_row(spark.range(3), small)
    sliced = joins.for_each_row(spark.range(3), small, limit=300)
    assert whole.count() == 60
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, whole.collect()))


def test_small_side_is_broadcast_by_its_size(spark):
    big, small = spark.range(50).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")

    def plan():
        joined = joins.with_small(big, small, ["k"])
        assert joined.count() == 50
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    # text that compresses well is judged by its real size
    small = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1 << 20).alias("filler"))
    plain = joins.with_small(big, small, ["k"])
    assert plain.count() == 50
    assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    small = spark.range(50).withColumnRenamed("id", "k")
    assert not joins.fits_broadcast(small, 10) and joins.fits_broadcast(small, 10_000)
