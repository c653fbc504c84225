"""Work that is stopped and taken up again: build records, the question loop, online ratings, generation."""

import random
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import registry
from temperament import schemas
from temperament.operators import ratings
from temperament.plans import expansion, pairs
from temperament.sources import files, records
from temperament.streaming import answers as answering
from temperament.streaming import elo

registry.load_all()
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["model", "constitution"]


@pytest.fixture
def tree(spark, tmp_path):
    """Stored answers of a teacher and two students; the second one never finishes a sentence."""
    rows = [
        (c, f"p{i}", f"Ask {i}?", producer, text)
        for c in ("c 0", "c+1%")
        for i in range(4)
        for producer, text in (("glm", f"ChatGLM says {i}."), ("qwen-1", f"Reply {i}."), ("llama-1", f"Reply {i}"))
    ]
    source = f"{tmp_path}/answers"
    frame = spark.createDataFrame(rows, "constitution string, prompt_id string, prompt string, producer string, response string")
    files.write_lines(frame, source, "constitution", "producer")
    return source, f"{tmp_path}/pairs"


def runs(spark, *names):
    return spark.createDataFrame(list(names), "model string, constitution string")


def stored(spark, target):
    counted = files.read_tree(spark, target, schemas.PAIRS).groupBy(*KEYS).count()
    return {(r[0], r[1]): r[2] for r in counted.collect()}


def test_finished_runs_are_skipped_without_reading_data(spark, tree, tmp_path):
    source, target = tree
    wanted = runs(spark, ("qwen-1", "c 0"), ("llama-1", "c 0"))
    assert pairs.build_pairs(spark, source, target, "glm", wanted).count() == 2
    listed = records.finished(spark, target, KEYS).collect()
    assert {(r["model"], r["constitution"]): r["rows"] for r in listed} == {("qwen-1", "c 0"): 4, ("llama-1", "c 0"): 0}
    # no data file is asked again: neither the stored pairs nor the answers
    for folder in (source, target):
        for path in tmp_path.glob(f"{folder.rsplit('/', 1)[1]}/*=*/*/part-*"):
            path.write_text("{no json")
    assert pairs.build_pairs(spark, source, target, "glm", wanted).isEmpty()
    assert records.finished(spark, target, KEYS).count() == 2


def test_keys_come_from_the_listing(spark, tree):
    source, _ = tree
    found = records.listed_keys(spark, source, ["constitution", "producer"]).collect()
    assert {tuple(r) for r in found} == {(c, p) for c in ("c 0", "c+1%") for p in ("glm", "qwen-1", "llama-1")}


def test_a_build_stopped_before_its_record_leaves_nothing_double(spark, tree, monkeypatch):
    source, target = tree
    wanted = runs(spark, ("qwen-1", "c 0"), ("qwen-1", "c+1%"))

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(records, "record", stop)
        with pytest.raises(RuntimeError):
            pairs.build_pairs(spark, source, target, "glm", wanted)
    assert records.finished(spark, target, KEYS).isEmpty()
    pairs.build_pairs(spark, source, target, "glm", wanted)
    assert stored(spark, target) == {("qwen-1", "c 0"): 4, ("qwen-1", "c+1%"): 4}


def test_a_missing_answer_file_fails_the_build(spark, tree):
    source, target = tree
    with pytest.raises(FileNotFoundError):
        pairs.build_pairs(spark, source, target, "glm", runs(spark, ("gemma-1", "c 0")))


def constitutions(spark):
    rows = [("c", f"trait {i}", None, [f"Why {i}?", "And then what?"]) for i in range(5)]
    return spark.createDataFrame(rows, "constitution string, trait string, clarification string, questions array<string>")


def load_lists(number):
    """Repeats across rounds, near copies, and a trait that never gets a question."""

    def one(prompt):
        which = next(i for i in range(5) if f"trait {i}" in prompt)
        draw = random.Random(which * 100 + number)
        if which == 4:
            return "1. Why 4?\n2. no end"
        return "\n".join(f"{i}. W{draw.randint(0, 12)} x{draw.randint(0, 9)} y{draw.randint(0, 9)}?" for i in range(1, 9))

    return lambda prompts: [one(p) for p in prompts]


def plain_loop(rows, rounds, wanted):
    accepted = {r["trait"]: [] for r in rows}

    def similar(new, pool):
        words = new.split()
        return new in pool or any(2 * sum(w in other.split() for w in words) > len(words) for other in pool)

    for number in range(rounds):
        for r in rows:
            for line in load_lists(number)([r["trait"]])[0].split("\n"):
                _, message = line.split(" ", 1)
                fits = message[-1] in "?." and message[0].isalpha()
                if fits and len(accepted[r["trait"]]) < wanted and not similar(message, r["questions"] + accepted[r["trait"]]):
                    accepted[r["trait"]].append(message)
    return accepted


def test_closed_loop_stops_and_goes_on(spark, tmp_path):
    rows, wanted, rounds = constitutions(spark), 7, 5
    whole = expansion.expand_questions(rows, load_lists, f"{tmp_path}/whole", wanted=wanted, rounds=rounds)
    expected = plain_loop(rows.collect(), rounds, wanted)
    got = {r["trait"]: r["additional_questions"] for r in expansion.with_additional_questions(rows, whole).collect()}
    assert got == expected and not got["trait 4"] and len(got["trait 0"]) == wanted
    assert {r["trait"] for r in expansion.still_unfinished(rows, whole, wanted).collect()} == {t for t, m in expected.items() if len(m) < wanted}

    # stopped after a list has been generated and before it is accepted: the list is not asked for again
    state = f"{tmp_path}/parts"
    expansion.expand_questions(rows, load_lists, state, wanted=wanted, rounds=1)

    def load_other(number):
        assert number != 1 and number != 0, "generated twice"
        return load_lists(number)

    real = expansion.accepted_questions
    try:
        expansion.accepted_questions = lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost"))
        with pytest.raises(RuntimeError):
            expansion.expand_questions(rows, load_lists, state, wanted=wanted, rounds=2)
    finally:
        expansion.accepted_questions = real
    again = expansion.expand_questions(rows, load_other, state, wanted=wanted, rounds=rounds)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))


def test_online_ratings_wait_for_gaps(spark, tmp_path):
    draw = random.Random(4)
    games = []
    for run, count in (("a", 60), ("b", 25), ("c", 1)):
        for seq in range(count):
            one, two = draw.choice("pqrs"), draw.choice("pqrs")
            games.append((run, seq, one, two, draw.choice([one, two, "neither", None])))
    schema = "run string, seq bigint, trait_1 string, trait_2 string, winner string"
    arrived = list(games) + games[5:9]  # some arrive twice
    draw.shuffle(arrived)
    source, output, checkpoint = f"{tmp_path}/games", f"{tmp_path}/moved", f"{tmp_path}/checkpoint"
    for part in (arrived[:40], arrived[40:]):
        spark.createDataFrame(part, schema).coalesce(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        elo.rate_arriving_games(stream, output, checkpoint).awaitTermination()
    latest = elo.latest_ratings(spark.read.schema(elo.RATED).parquet(output))
    got = {(r[0], r[1]): round(r[2], 2) for r in latest.collect()}
    batch = ratings.elo_ratings(ratings.valid_comparisons(spark.createDataFrame(games, schema)), ["run"])
    assert got == {(r["run"], r["trait"]): r["rating"] for r in batch.collect()}


def test_generation_goes_on_after_a_failure(spark, tmp_path):
    source, output, checkpoint, calls = (f"{tmp_path}/{n}" for n in ("prompts", "answers", "checkpoint", "calls"))
    schema = "id bigint, prompt string, `a b` string"
    frame = spark.range(40).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"), F.lit("x").alias("a b"))
    for part in range(4):
        frame.filter(F.col("id") % 4 == part).coalesce(1).write.mode("append").parquet(source)

    def load(fails):
        def make():
            def call(prompts):
                if fails and "p2" in prompts:
                    raise ValueError("no model")
                with open(calls, "a") as log:
                    log.write("".join(f"{p}\n" for p in prompts))
                return [p.upper() for p in prompts]

            return call

        return make

    kind = frame.schema
    with pytest.raises(Exception):
        answering.answer_arriving_prompts(spark, source, kind, "prompt", load(True), output, checkpoint).awaitTermination()
    with open(calls) as log:
        before = log.read().split()
    assert 0 < len(before) < 40
    answering.answer_arriving_prompts(spark, source, kind, "prompt", load(False), output, checkpoint).awaitTermination()
    got = answering.read_answers(spark, output, kind)
    assert {(r["id"], r["response"]) for r in got.collect()} == {(i, f"P{i}") for i in range(40)} and got.count() == 40
    with open(calls) as log:
        assert sorted(log.read().split()) == sorted(f"p{i}" for i in range(40))  # none twice


class Kept:
    """A value or map of a state in memory, which counts what is asked of it."""

    asked = 0

    def __init__(self):
        self.values = {}

    def __getattr__(self, name):
        Kept.asked += 1
        return {
            "exists": lambda: () in self.values, "get": lambda: self.values[()], "update": lambda v: self.values.update({(): v}),
            "containsKey": lambda k: k in self.values, "getValue": lambda k: self.values.get(k),
            "updateValue": lambda k, v: self.values.update({k: v}), "removeKey": lambda k: self.values.pop(k),
        }[name]


def test_early_games_are_asked_for_by_blocks(monkeypatch):
    monkeypatch.setattr(elo, "BLOCK", 3000, raising=False)
    draw = random.Random(3)
    names = ["a", "b", "c", None]
    games = [(i, draw.choice(names), draw.choice(names), draw.choice([*names, "unclear"])) for i in range(20_000)]
    want = {}
    for _, one, two, winner in games:
        if winner is not None and one is not None and two is not None and winner in (one, two):
            a, b = want.setdefault(one, 1000.0), want.setdefault(two, 1000.0)
            gain = 32 * ((winner == one) - 1 / (1 + 10 ** ((b - a) / 400)))
            want[one] += gain
            want[two] -= gain
    run = elo._Run()
    run.init(type("Handle", (), {"getValueState": lambda *_: Kept(), "getMapState": lambda *_: Kept()})())
    Kept.asked = 0
    late, rows = games[::3], [g for i, g in enumerate(games) if i % 3]
    draw.shuffle(rows)
    # games that arrive again with another winner are left out, before and after the first was played
    again = [(i, one, two, two) for i, one, two, _ in draw.sample(rows[:7000], 500)]
    got = {}
    for batch in (rows[:7000], again, rows[7000:], late[:100], late[100:][::-1], again):
        for out in run.handleInputRows(("r",), iter([pd.DataFrame(batch, columns=["seq", "trait_1", "trait_2", "winner"])]), None):
            got.update(zip(out["trait"], out["rating"]))
            after = out["after"].iloc[0]
    assert after == 20_000 and got.keys() == want.keys()
    assert got == pytest.approx(want, abs=1e-9)
    assert Kept.asked < 500  # six per early game if each had a place of its own
    assert not run.early.values and not run.parts.values
