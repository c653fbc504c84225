"""Elo ratings from ordered comparisons, and what is read off them.

A rating depends on the order of all earlier games of its run, so plainly computed a run is one long chain in one
task. Here a run is cut into chunks of consecutive games that are replayed side by side:

1. Every chunk starts from the initial rating and is replayed. The first chunk of a run is then exact.
2. A chunk's start is corrected to the end of the chunks before it, and only chunks whose start moved
   are replayed, until none moves. Chunk ``i`` is exact after ``i`` rounds at the latest.

It usually takes far fewer rounds, as old games fade. A game keeps two players' sum and shrinks the
distance between any two possible values of their difference, so replaying is non-expansive: a start
that moves by less than ``TOLERANCE`` moves no later rating by more.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from temperament.fixed_values import ELO_K, ELO_SCALE, ELO_START
from temperament.operators.filters import valid_winner
from temperament.operators.joins import for_each_row
from temperament.session import settle

CHUNK_GAMES = 250_000
TOLERANCE = 1e-9


def valid_comparisons(df: DataFrame) -> DataFrame:
    """Comparisons whose winner is one of the two traits."""
    return df.filter(valid_winner(F.col("trait_1"), F.col("trait_2"), F.col("winner")))


def traits_seen(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct traits on either side, by key."""
    both = F.explode(F.array("trait_1", "trait_2")).alias("trait")
    return df.select(*keys, both).distinct()


def elo_ratings(
    comparisons: DataFrame,
    runs: list[str],
    *,
    normalize: bool = False,
    chunk_games: int = CHUNK_GAMES,
) -> DataFrame:
    """Final rating of every trait of every run, ranked.

    ``comparisons`` has the run columns (never null), ``seq`` (unique in a run; games are played in its
    order), ``trait_1``, ``trait_2`` and ``winner``. A row without a winner counts for the list of traits
    only. Ratings are rounded to two decimals; equal ones are ranked by trait name.
    """
    chunks = _pack(comparisons, runs, chunk_games)
    ends = _replay(chunks, runs)
    last = F.max_by("end", "chunk")
    final = (
        ends.select(*runs, "chunk", F.explode(F.arrays_zip("traits", "ends")).alias("t"))
        .select(*runs, "chunk", F.col("t.traits").alias("trait"), F.col("t.ends").alias("end"))
        .groupBy(*runs, "trait")
        .agg(last.alias("rating"))
    )
    if normalize:
        final = normalized(final, runs)
    return ranked(final.withColumn("rating", F.round("rating", 2)), runs)


def normalized(ratings: DataFrame, runs: list[str]) -> DataFrame:
    """Ratings moved to 0-1 within a run; left as they are when all are equal."""
    run = Window.partitionBy(*runs)
    low, high = F.min("rating").over(run), F.max("rating").over(run)
    return ratings.select(
        *runs,
        "trait",
        F.when(high > low, (F.col("rating") - low) / (high - low))
        .otherwise(F.col("rating"))
        .alias("rating"),
    )


def ranked(ratings: DataFrame, runs: list[str]) -> DataFrame:
    """Place from 1 within a run, best first."""
    order = Window.partitionBy(*runs).orderBy(F.desc("rating"), "trait")
    return ratings.withColumn("place", F.row_number().over(order))


def _pack(comparisons: DataFrame, runs: list[str], chunk_games: int) -> DataFrame:
    """Games in order, packed into one row per chunk of at most ``chunk_games`` games.

    Partitioning by ranges of (run, seq) spreads even a single long run over all tasks, and one
    shuffle is all the games ever take part in. Traits become positions in the chunk's own list.
    """
    ordered = (
        comparisons.filter(F.col("trait_1").isNotNull() & F.col("trait_2").isNotNull())
        .select(*runs, "seq", "trait_1", "trait_2", "winner")
        .repartitionByRange(*runs, "seq")
        .sortWithinPartitions(*runs, "seq")
        .withColumn("part", F.spark_partition_id())
    )
    schema = T.StructType(
        [ordered.schema[name] for name in runs]
        + [
            T.StructField("chunk", T.LongType()),
            T.StructField("traits", T.ArrayType(T.StringType())),
            T.StructField("games", T.BinaryType()),
        ]
    )

    def chunk_row(games: pd.DataFrame, number: int) -> pd.DataFrame:
        n = len(games)
        codes, traits = pd.factorize(pd.concat([games["trait_1"], games["trait_2"]]))
        won = np.where(games["winner"] == games["trait_1"], 1, 0)
        lost = np.where((games["winner"] == games["trait_2"]) & (won == 0), -1, 0)
        row = {name: games[name].iloc[0] for name in runs}
        row["chunk"] = (int(games["part"].iloc[0]) << 32) + number
        row["traits"] = traits.tolist()
        row["games"] = np.stack([codes[:n], codes[n:], won + lost]).astype("<i4").tobytes()
        return pd.DataFrame([row])

    def pack(batches):
        held, games, number = [], 0, 0
        for batch in batches:
            if not len(batch):
                continue
            changes = (batch[runs] != batch[runs].shift()).any(axis=1).cumsum()
            for _, piece in batch.groupby(changes, sort=False):
                new_run = held and any(held[0][r].iloc[0] != piece[r].iloc[0] for r in runs)
                if new_run:
                    yield chunk_row(pd.concat(held), number)
                    held, games, number = [], 0, number + 1
                while len(piece):
                    taken, piece = piece[: chunk_games - games], piece[chunk_games - games :]
                    held.append(taken)
                    games += len(taken)
                    if games == chunk_games:
                        yield chunk_row(pd.concat(held), number)
                        held, games, number = [], 0, number + 1
        if held:
            yield chunk_row(pd.concat(held), number)

    return settle(ordered.mapInPandas(pack, schema), "elo-games")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _play(starts: pd.Series, games: pd.Series) -> pd.Series:
    """Ratings after each chunk's games; a chunk is bounded, so a plain loop over it is too."""
    ends = []
    for start, packed in zip(starts, games):
        rating = start.tolist()
        for i, j, outcome in np.frombuffer(packed, "<i4").reshape(3, -1).T.tolist():
            if outcome:
                expected = 1.0 / (1.0 + 10.0 ** ((rating[j] - rating[i]) / ELO_SCALE))
                gain = ELO_K * ((outcome > 0) - expected)
                rating[i] += gain
                rating[j] -= gain
        ends.append(rating)
    return pd.Series(ends)


def _replay(chunks: DataFrame, runs: list[str]) -> DataFrame:
    """``traits`` and ``ends`` of every chunk, each chunk started where the earlier ones ended."""
    key = [*runs, "chunk"]
    start = F.transform("traits", lambda _: F.lit(ELO_START))
    state = settle(
        chunks.withColumn("starts", start)
        .withColumn("ends", _play("starts", "games"))
        .select(*key, "traits", "starts", "ends"),
        "elo-state",
    )
    longest = state.groupBy(*runs).count().agg(F.max("count").alias("n")).first()["n"] or 0
    for _ in range(longest - 1):
        moved = _corrected_starts(state, runs)
        moved = settle(moved, "elo-starts")
        if moved.isEmpty():
            break
        replayed = (
            chunks.join(moved, key)
            .withColumn("ends", _play("starts", "games"))
            .select(*key, "traits", "starts", "ends")
        )
        untouched = state.join(moved.select(*key), key, "left_anti")
        state = settle(untouched.unionByName(replayed), "elo-state")
    return state


def _corrected_starts(state: DataFrame, runs: list[str]) -> DataFrame:
    """New start ratings of the chunks whose start is off, in the order of the chunk's trait list.

    Works on one row per chunk and trait, never on games.
    """
    entries = state.select(
        *runs,
        "chunk",
        F.posexplode(F.arrays_zip("traits", "starts", "ends")).alias("pos", "t"),
    )
    earlier = Window.partitionBy(*runs, "t.traits").orderBy("chunk")
    start = F.coalesce(F.lag("t.ends").over(earlier), F.lit(ELO_START))
    return (
        entries.withColumn("start", start)
        .groupBy(*runs, "chunk")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "start"))).alias("list"),
            F.max(F.abs(F.col("start") - F.col("t.starts"))).alias("shift"),
        )
        .filter(F.col("shift") > TOLERANCE)
        .select(*runs, "chunk", F.transform("list", lambda item: item["start"]).alias("starts"))
    )


def rating_changes(
    ratings: DataFrame,
    base: Column | str,
    tuned: Column | str,
    keys: list[str] | None = None,
    shared: list[str] | None = None,
) -> DataFrame:
    """Rating of each trait in a base and a tuned run, with the difference.

    ``base`` and ``tuned`` select the rows of either run; ``keys`` identify a tuned run, and ``shared`` are
    those of them that its base run must have too (a model, say). Traits that one run lacks are not here; see ``unrated_traits``.
    """
    keys, shared = keys or [], shared or []
    before = ratings.filter(base).select(*shared, "trait", F.col("rating").alias("before"))
    after = ratings.filter(tuned).select(*keys, "trait", F.col("rating").alias("after"))
    return after.join(before, [*shared, "trait"]).withColumn("change", F.col("after") - F.col("before"))


def unrated_traits(
    ratings: DataFrame,
    base: Column | str,
    tuned: Column | str,
    keys: list[str] | None = None,
    shared: list[str] | None = None,
) -> DataFrame:
    """Traits that only one of a tuned run and its base run rates, per tuned run: keys, trait, missing_in."""
    keys, shared = keys or [], shared or []
    before = ratings.filter(base).select(*shared, "trait").distinct()
    after = ratings.filter(tuned).select(*keys, "trait").distinct()
    if keys:
        runs = after.select(*keys).distinct()
        expected = before.join(runs, shared) if shared else for_each_row(before, runs)
    else:
        expected = before
    lacking = expected.join(after, [*keys, "trait"], "left_anti").withColumn("missing_in", F.lit("tuned"))
    extra = after.join(before, [*shared, "trait"], "left_anti").withColumn("missing_in", F.lit("base"))
    return lacking.select(*keys, "trait", "missing_in").unionByName(extra.select(*keys, "trait", "missing_in"))


def extreme_changes(changes: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The ``n`` most negative and ``n`` most positive changes, in that order.

    With fewer than ``2 n`` traits some are in both halves and are listed twice.
    """
    falling = Window.partitionBy(*keys).orderBy("change", "trait")
    rising = Window.partitionBy(*keys).orderBy(F.desc("change"), F.desc("trait"))
    bottom = changes.withColumn("n", F.row_number().over(falling)).filter(F.col("n") <= n)
    top = changes.withColumn("n", F.row_number().over(rising)).filter(F.col("n") <= n)
    listed = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return (
        bottom.withColumn("slot", F.col("n").cast("bigint"))
        .unionByName(top.withColumn("slot", 2 * listed + 1 - F.col("n")))
        .drop("n")
    )


def largest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Trait that rose most and trait that fell most."""
    return changes.groupBy(*keys).agg(
        F.max_by("trait", F.struct("change", "trait")).alias("riser"),
        F.max("change").alias("rise"),
        F.min_by("trait", F.struct("change", "trait")).alias("faller"),
        F.min("change").alias("fall"),
    )


def rank_correlation(ratings: DataFrame, pairs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Spearman's rho and its two-sided p-value between pairs of runs, on their common traits.

    ``pairs`` has columns ``run_1`` and ``run_2``; ``ratings`` has ``run``, ``trait`` and ``place``. Both have ``keys``
    (a condition, say), which are the same for the two runs of a pair.
    """
    keys = keys or []
    one = ratings.select(*keys, F.col("run").alias("run_1"), "trait", F.col("place").alias("place_1"))
    two = ratings.select(*keys, F.col("run").alias("run_2"), "trait", F.col("place").alias("place_2"))
    common = pairs.join(one, [*keys, "run_1"]).join(two, [*keys, "run_2", "trait"])
    pair = Window.partitionBy(*keys, "run_1", "run_2")
    ranks = common.select(
        *keys,
        "run_1",
        "run_2",
        F.row_number().over(pair.orderBy("place_1")).alias("rank_1"),
        F.row_number().over(pair.orderBy("place_2")).alias("rank_2"),
    )
    rho = ranks.groupBy(*keys, "run_1", "run_2").agg(
        F.corr(F.col("rank_1").cast("double"), F.col("rank_2").cast("double")).alias("rho"),
        F.count(F.lit(1)).alias("traits"),
    )
    return rho.withColumn("p_value", _two_sided_p("rho", "traits"))


@F.pandas_udf(T.DoubleType())
def _two_sided_p(rho: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([correlation_p_value(r, int(k)) for r, k in zip(rho, n)])


def correlation_p_value(rho: float, n: int) -> float:
    """Chance of a correlation at least this far from 0: Student's t with n - 2 degrees, two-sided.

    Equals the regularized incomplete beta function at 1 - rho^2, taken from its continued fraction so
    that very small chances keep their precision.
    """
    degrees = n - 2
    if degrees < 1 or rho is None or math.isnan(rho):
        return float("nan")
    x = 1.0 - rho * rho
    if x <= 0.0:
        return 0.0
    a, b = degrees / 2.0, 0.5
    if x < (a + 1.0) / (a + b + 2.0):
        return _beta_tail(x, a, b)
    return 1.0 - _beta_tail(1.0 - x, b, a)


def _beta_tail(x: float, a: float, b: float) -> float:
    if x <= 0.0:
        return 0.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(log_front + a * math.log(x) + b * math.log1p(-x)) / a
    # continued fraction, evaluated from its tail; 500 steps is far beyond double precision here
    value = 1.0
    for step in range(500, 0, -1):
        m = step // 2
        if step % 2:
            top = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            top = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1.0 + top / value
    return front / value


def ratings_by_run(ratings: DataFrame, runs: list[str]) -> DataFrame:
    """One row per place, one ``trait (rating)`` column per run."""
    cell = F.first(F.concat("trait", F.lit(" ("), F.format_number("rating", 2), F.lit(")")))
    return ratings.groupBy("place").pivot("run", runs).agg(cell)
