"""Metrics, joins, samples and vectors on small literal tables."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from temperament.functions.choice import shuffle_key
from temperament.operators import filters, joins, metrics, sampling, vectors


def test_complete_rows(spark):
    rows = spark.createDataFrame([("p", "r", None), ("q", "r", "s"), (None, "r", "s")], "prompt string, a string, b string")
    assert [r["prompt"] for r in filters.complete_rows(rows).collect()] == ["q"]
    assert [r["prompt"] for r in filters.complete_rows(rows, ["prompt", "a"]).collect()] == ["p", "q"]


def test_mean_and_error(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)], "k string, v double")
    found = {r["k"]: r for r in metrics.mean_and_error(rows, ["k"], "v").collect()}
    assert found["a"]["mean"] == 2.0 and found["a"]["sem"] == pytest.approx(math.sqrt(2) / math.sqrt(2))
    assert found["b"]["mean"] == 5.0 and found["b"]["sem"] is None


def test_win_rate(spark):
    votes = [("all", "two", 1), ("all", "two", 1), ("all", "one", 2), ("none", None, 1), ("lost", "one", 1), ("lost", None, 9)]
    rows = spark.createDataFrame(votes, "k string, vote string, copies int")
    plain = {r["k"]: r["win_rate"] for r in metrics.win_rate(rows, ["k"], "vote", "one", "two").collect()}
    assert plain == {"all": pytest.approx(2 / 3), "none": None, "lost": 0.0}
    weighted = {r["k"]: r["win_rate"] for r in metrics.win_rate(rows, ["k"], "vote", "one", "two", "copies").collect()}
    assert weighted["all"] == 0.5


def test_scores(spark):
    rows = [("perfect", x, x) for x in "ab"] + [("mixed", "a", "a"), ("mixed", "b", "a"), ("mixed", "a", "z")]
    frame = spark.createDataFrame(rows, "k string, t string, p string")
    found = {r["k"]: r for r in metrics.classification_scores(frame, ["k"], "t", "p").collect()}
    assert (found["perfect"]["f1"], found["perfect"]["accuracy"]) == (1.0, 1.0)
    # a: tp 1, fp 1, fn 1 -> 0.5; b is never predicted and z never true -> 0
    assert found["mixed"]["f1"] == pytest.approx(0.5 / 3)
    assert found["mixed"]["accuracy"] == pytest.approx(1 / 3)
    overall = metrics.classification_scores(frame, [], "t", "p").first()
    assert overall["accuracy"] == pytest.approx(3 / 5)


def test_pooled_variants_leave_the_default_out(spark):
    rows = [("m", "default", "a", "b"), ("m", "v0", "a", "a"), ("m", "v1", "b", "b")]
    frame = spark.createDataFrame(rows, "method string, variant string, t string, p string")
    found = {r["variant"]: r["accuracy"] for r in metrics.score_grid(frame, "t", "p").collect()}
    assert found == {"default": 0.0, "v0": 1.0, "v1": 1.0, "all": 1.0}


def test_histogram(spark):
    rows = [("a", float(v)) for v in range(41)] + [("same", 7.0), ("same", 7.0), ("a", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    found = metrics.histogram(frame, ["k"], "v").collect()
    bins = {r["bin"]: r for r in found if r["k"] == "a"}
    assert bins[20]["n"] == 3 and bins[1]["n"] == 2 and set(bins) == set(range(1, 21))
    assert sum(r["density"] * 2 for r in bins.values()) == pytest.approx(1)
    assert [(r["bin"], r["density"]) for r in found if r["k"] == "same"] == [(11, 20.0)]


def test_same_question_multiplies_copies(spark):
    one = spark.createDataFrame([("q", "a"), ("q", "a"), ("q", "b"), ("r", "c")], "question string, response string")
    two = spark.createDataFrame([("q", "x"), ("q", "x"), ("q", "x"), ("s", "y")], "question string, response string")
    found = joins.same_question(one, two, ["question"]).collect()
    assert {(r["response_1"], r["response_2"], r["copies"]) for r in found} == {("a", "x", 6), ("b", "x", 3)}
    assert sum(r["copies"] for r in found) == one.join(two, "question").count()


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_large_samples_equal_the_sorted_cut(spark, monkeypatch, n):
    frame = spark.range(1000).repartition(4)
    monkeypatch.setattr(sampling, "HASH_DIGITS", 1)
    found = [r["id"] for r in sampling.sample(frame, 9, n, "id").collect()]
    ordered = frame.orderBy(shuffle_key(9, F.col("id"))).limit(n).collect()
    assert found == [r["id"] for r in ordered]


def test_shuffle_is_a_permutation(spark):
    rows = [r["id"] for r in sampling.shuffled(spark.range(500), 1, "id").collect()]
    assert sorted(rows) == list(range(500)) and rows != list(range(500))
    other = [r["id"] for r in sampling.shuffled(spark.range(500), 2, "id").collect()]
    assert rows != other


def test_vectors(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 4.0])], "k int, v array<float>")
    two = spark.createDataFrame([(1, [4.0, 4.0]), (2, [4.0, 0.0])], "k int, v array<float>")
    found = {r["k"]: r["v"] for r in vectors.blend(one, two, "k", "v", 1.0, 0.25).collect()}
    assert found == {1: [2.0, 3.0], 2: [1.0, 4.0]}
    with pytest.raises(PySparkException):
        vectors.interpolate(one, two.filter("k = 1"), "k", "v").collect()
    assert joins.key_mismatch(one, two.filter("k = 1"), "k").collect()[0].asDict() == {"k": 2, "missing_in": "second"}


@pytest.mark.parametrize("n", [1000, 1001, 100_000])
def test_large_cuts_are_made_in_parts(spark, n):
    frame = spark.range(3000).select(F.lit("one").alias("group"), "id")
    cut = sampling.first_per_group(frame, ["group"], ["id"], n)
    assert sorted(r["id"] for r in cut.collect()) == list(range(min(n, 3000)))
    assert "salt" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_sample_has_no_top_rows_in_one_task(spark):
    for n in (5, 100_000):
        plan = sampling.sample(spark.range(300_000), 1, n, "id")._jdf.queryExecution().optimizedPlan().toString()
        assert f"GlobalLimit {n}" not in plan
    assert sampling.sample(spark.range(10), 1, None, "id").count() == 10


def test_plain_merge_keeps_every_pair(spark):
    one = spark.createDataFrame([("q", "a"), ("q", "a"), ("q", "b"), ("r", None)], "question string, response string")
    two = spark.createDataFrame([("q", "x"), ("q", "x"), ("r", "y")], "question string, response string")
    plain = one.withColumnRenamed("response", "response_1").join(two.withColumnRenamed("response", "response_2"), "question")
    merged = joins.merged_answers(one, two, ["question"]).select(plain.columns)
    assert sorted(map(str, merged.collect())) == sorted(map(str, plain.collect()))


def test_shuffle_is_dealt_by_its_digits(spark):
    rows = spark.range(1000).withColumn("text", F.lit("x"))
    mixed = sampling.shuffled(rows, 3, "id")
    got = [(r["shuffle_key"], r["id"]) for r in mixed.collect()]
    assert got == sorted(got) and len({i for _, i in got}) == 1000
    assert [i for _, i in got] != sorted(i for _, i in got)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert len({r[0] for r in mixed.select(F.spark_partition_id()).distinct().collect()}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_blocks_of_a_hot_question_lose_no_pair(spark, block):
    def side(column, answers):
        hot = [("hot", f"{column}{i % answers}") for i in range(2 * answers)]
        return hot + [("one", f"{column}{i}") for i in range(1 if column == "a" else 40)] + [("null", None), ("only " + column, "x"), (None, "x")]

    one, two = (spark.createDataFrame(side(*args), "question string, response string") for args in (("a", 50), ("b", 23)))
    plain = one.withColumnRenamed("response", "response_1").join(two.withColumnRenamed("response", "response_2"), "question")
    want = plain.groupBy("question", "response_1", "response_2").count()
    got = joins.same_question(one, two, ["question"], block)
    assert got.columns == ["question", "response_1", "response_2", "copies"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_hot_question_is_spread_over_all_tasks(spark):
    answers = spark.range(2000).select(F.lit("hot").alias("question"), F.concat(F.lit("answer "), "id").alias("response"))
    set_for_now = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in set_for_now}
    try:
        for name, value in set_for_now.items():
            spark.conf.set(name, value)
        pairs = joins.same_question(answers, answers, ["question"], 100)
        loads = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(loads) == 2000 * 2000
    assert len(loads) == int(spark.conf.get("spark.sql.shuffle.partitions")) and loads[-1] < 2 * loads[len(loads) // 2]
