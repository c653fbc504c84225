import math
import random

import numpy as np
import pytest

from temperament.operators import ratings

SCHEMA = "run string, seq bigint, trait_1 string, trait_2 string, winner string"


def sequential_elo(games):
    """Plain Python replay of one run's games."""
    score = {}
    for _, _, one, two, _ in games:
        score.setdefault(one, 1000.0)
        score.setdefault(two, 1000.0)
    for _, _, one, two, winner in sorted(games, key=lambda g: g[1]):
        chance = 1 / (1 + 10 ** ((score[two] - score[one]) / 400))
        if winner == one:
            score[one], score[two] = score[one] + 32 * (1 - chance), score[two] - 32 * (1 - chance)
        elif winner == two:
            score[one], score[two] = score[one] - 32 * chance, score[two] + 32 * chance
    return score


def made_up_games(n, traits, seed, run="r"):
    draw = random.Random(seed)
    games = []
    for seq in range(n):
        one, two = draw.sample(traits, 2)
        winner = draw.choice([one, one, two, "unclear", None])
        games.append((run, seq, one, two, winner))
    draw.shuffle(games)
    return games


def rated(spark, games, **options):
    frame = spark.createDataFrame(games, SCHEMA).repartition(5)
    rows = ratings.elo_ratings(frame, ["run"], **options).collect()
    return {(r["run"], r["trait"]): r["rating"] for r in rows}


def test_single_game_and_ties(spark):
    games = [("r", 1, "b", "a", "b"), ("s", 1, "d", "c", None)]
    assert rated(spark, games) == {("r", "b"): 1016.0, ("r", "a"): 984.0, ("s", "c"): 1000.0, ("s", "d"): 1000.0}
    places = ratings.elo_ratings(spark.createDataFrame(games, SCHEMA), ["run"]).filter("run = 's'")
    assert [r["trait"] for r in places.orderBy("place").collect()] == ["c", "d"]


def test_order_matters(spark):
    forth = rated(spark, [("r", 1, "a", "b", "a"), ("r", 2, "b", "c", "b")])
    back = rated(spark, [("r", 2, "a", "b", "a"), ("r", 1, "b", "c", "b")])
    assert forth != back


def test_traits_only_in_invalid_rows_are_left_out_by_the_filter(spark):
    games = spark.createDataFrame([("r", 1, "a", "b", "a"), ("r", 2, "x", "y", None)], SCHEMA)
    kept = ratings.elo_ratings(ratings.valid_comparisons(games), ["run"]).collect()
    assert {r["trait"] for r in kept} == {"a", "b"}


@pytest.mark.parametrize("chunk_games", [300, 250_000])
def test_chunks_equal_one_long_replay(spark, chunk_games):
    games = made_up_games(3000, list("abcdefghij"), 1, "long") + made_up_games(90, list("xyz"), 2, "short")
    expected = {("long", t): v for t, v in sequential_elo([g for g in games if g[0] == "long"]).items()}
    expected |= {("short", t): v for t, v in sequential_elo([g for g in games if g[0] == "short"]).items()}
    found = rated(spark, games, chunk_games=chunk_games)
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert abs(found[key] - value) <= 0.005 + 1e-6, key
    assert abs(sum(v for (run, _), v in found.items() if run == "long") - 10_000) < 0.06


def test_chunks_with_rarely_met_traits(spark):
    """Traits that skip many chunks must pick up where they left off."""
    games = [("r", i, f"t{i % 7}", f"u{i // 40}", f"t{i % 7}" if i % 3 else f"u{i // 40}") for i in range(400)]
    expected = sequential_elo(games)
    found = rated(spark, games, chunk_games=60)
    assert all(abs(found[("r", t)] - v) <= 0.005 + 1e-6 for t, v in expected.items())


def test_normalized(spark):
    found = rated(spark, made_up_games(200, list("abcd"), 3), normalize=True)
    assert min(found.values()) == 0.0 and max(found.values()) == 1.0
    assert rated(spark, [("r", 1, "a", "b", None)], normalize=True) == {("r", "a"): 1000.0, ("r", "b"): 1000.0}


@pytest.mark.parametrize(
    "rho, n, expected",
    [
        # Student's t, two-sided, closed forms: 1 degree is Cauchy, 2 degrees is algebraic
        (0.5, 3, 1 - 2 / math.pi * math.asin(0.5)),
        (0.5, 4, 0.5),
        (-0.5, 4, 0.5),
        (0.9, 4, 0.1),
        (1.0, 10, 0.0),
        (0.0, 10, 1.0),
    ],
)
def test_p_value(rho, n, expected):
    assert ratings.correlation_p_value(rho, n) == pytest.approx(expected, abs=1e-12)


def test_p_value_by_integration():
    for rho, n in [(0.3, 12), (0.7, 25), (0.05, 144), (0.62, 9)]:
        degrees = n - 2
        edge = abs(rho) * math.sqrt(degrees / (1 - rho * rho))
        front = math.gamma((degrees + 1) / 2) / math.sqrt(degrees * math.pi) / math.gamma(degrees / 2)
        x = np.linspace(0, edge, 400_001)
        y = front * (1 + x * x / degrees) ** (-(degrees + 1) / 2)
        inside = np.sum((y[1:] + y[:-1]) / 2) * (x[1] - x[0])
        assert ratings.correlation_p_value(rho, n) == pytest.approx(1 - 2 * inside, rel=1e-6)
    assert 0 < ratings.correlation_p_value(0.9, 144) < 1e-50


def test_rank_correlation(spark):
    rows = [("a", t, i + 1) for i, t in enumerate("vwxyz")]
    rows += [("same", t, i + 1) for i, t in enumerate("vwxyz")]
    rows += [("back", t, 5 - i) for i, t in enumerate("vwxyz")]
    rows += [("part", t, p) for t, p in [("x", 1), ("q", 2), ("v", 3), ("z", 4)]]
    table = spark.createDataFrame(rows, "run string, trait string, place int")
    pairs = spark.createDataFrame([("a", "same"), ("a", "back"), ("a", "part")], "run_1 string, run_2 string")
    found = {r["run_2"]: r for r in ratings.rank_correlation(table, pairs).collect()}
    assert found["same"]["rho"] == pytest.approx(1) and found["back"]["rho"] == pytest.approx(-1)
    assert found["part"]["traits"] == 3 and found["part"]["rho"] == pytest.approx(0.5)
    assert found["part"]["p_value"] == pytest.approx(2 / 3)


def test_extremes_overlap_when_traits_are_few(spark):
    rows = [("m", t, float(c)) for t, c in [("a", -3), ("b", 0), ("c", 5)]]
    changes = spark.createDataFrame(rows, "run string, trait string, change double")
    found = ratings.extreme_changes(changes, ["run"]).orderBy("slot").collect()
    assert [r["trait"] for r in found] == ["a", "b", "c", "a", "b", "c"]
    assert [r["slot"] for r in found] == [1, 2, 3, 4, 5, 6]
    top = ratings.largest_changes(changes, ["run"]).first()
    assert (top["riser"], top["rise"], top["faller"], top["fall"]) == ("c", 5.0, "a", -3.0)


def test_unrated_traits(spark):
    table = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", "z")], "run string, trait string")
    found = {tuple(r) for r in ratings.unrated_traits(table, "run = 'a'", "run = 'b'").collect()}
    assert found == {("x", "tuned"), ("z", "base")}


def test_every_model_has_its_own_base(spark):
    rows = [("q", "base", "x", 1.0), ("l", "base", "x", 5.0), ("q", "t", "x", 2.0), ("l", "t", "x", 5.5), ("l", "base", "y", 1.0)]
    table = spark.createDataFrame(rows, "model string, run string, trait string, rating double")
    changes = ratings.rating_changes(table, "run = 'base'", "run = 't'", ["model"], ["model"]).collect()
    assert {(r["model"], r["change"]) for r in changes} == {("q", 1.0), ("l", 0.5)}
    lacking = ratings.unrated_traits(table, "run = 'base'", "run = 't'", ["model"], ["model"]).collect()
    assert [tuple(r) for r in lacking] == [("l", "y", "tuned")]
