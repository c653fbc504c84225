"""Summary tables of rating changes and of method comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import (
    HOURLY_PRICES,
    METHOD_LABELS,
    RUNS_IN_PROJECTION,
)
from temperament.functions.labels import lookup, mean_and_error_text, signed_text
from temperament.operators.filters import single_variants
from temperament.operators.joins import for_each_row, with_small
from temperament.operators.metrics import histogram, mean_and_error, padded_range
from temperament.operators.ratings import extreme_changes, largest_changes, rank_correlation, rating_changes

RATING_PADDING = 100


def change_report(
    ratings: DataFrame, base: Column | str, tuned: Column | str, keys: list[str], n: int = 5, shared: list[str] | None = None
) -> DataFrame:
    """The traits that moved most between a base and tuned runs, with the change as text."""
    changes = rating_changes(ratings, base, tuned, keys, shared)
    return extreme_changes(changes, keys, n).withColumn("label", signed_text(F.col("change")))


def run_correlations(ratings: DataFrame, keys: list[str]) -> DataFrame:
    """How far every two runs (models, say) agree on the order of traits under the same keys, and the keys' mean.

    ``ratings`` has ``run``, ``trait`` and ``place``. Two runs with fewer than three common traits have no p-value.
    """
    runs = ratings.select(*keys, F.col("run").alias("run_1")).distinct()
    others = runs.withColumnRenamed("run_1", "run_2")
    pairs = (runs.join(others, keys) if keys else for_each_row(runs, others)).filter("run_1 < run_2")
    found = rank_correlation(ratings, pairs, keys)
    means = found.groupBy(*keys).agg(F.avg("rho").alias("mean_rho"))
    return with_small(found, means, keys) if keys else for_each_row(found, means)


def rating_densities(ratings: DataFrame, keys: list[str], padding: float = RATING_PADDING) -> DataFrame:
    """Density of the ratings by key, with the one padded range in which all of them are shown side by side."""
    return for_each_row(histogram(ratings, keys, "rating"), padded_range(ratings, "rating", padding))


def change_overview(
    ratings: DataFrame, base: Column | str, tuned: Column | str, keys: list[str], shared: list[str] | None = None
) -> DataFrame:
    """Per tuned run: traits that both runs rate, mean size of their changes, the largest rise and the largest fall as text."""
    changes = rating_changes(ratings, base, tuned, keys, shared)
    sizes = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("traits"), F.avg(F.abs("change")).alias("mean_size"))
    return sizes.join(largest_changes(changes, keys), keys).select(
        *keys, "traits", "mean_size", "riser", signed_text(F.col("rise")).alias("rise"), "faller", signed_text(F.col("fall")).alias("fall")
    )


def win_rate_summary(win_rates: DataFrame, keys: list[str]) -> DataFrame:
    """``75.0% ± 1.2%`` per model from the win rates of its constitutions."""
    stats = mean_and_error(win_rates, keys, "win_rate")
    return stats.withColumn("summary", mean_and_error_text(F.col("mean"), F.col("sem")))


def method_comparison(scores: DataFrame, methods: list[str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Mean and error of each listed method over its suffix variants, 0 for a method without scores.

    With ``keys`` (a model, say) there is one such table for each of their values.
    """
    methods, keys = methods or list(METHOD_LABELS), keys or []
    stats = mean_and_error(single_variants(scores), ["method", *keys], "score")
    groups = scores.select(*keys).distinct() if keys else scores.sparkSession.range(1).select()
    listed = groups.select(*keys, F.posexplode(F.array(*[F.lit(m) for m in methods])).alias("place", "method"))
    return listed.join(stats, ["method", *keys], "left").select(
        *keys,
        "place",
        "method",
        F.coalesce(lookup(METHOD_LABELS, F.col("method")), "method").alias("label"),
        F.coalesce("mean", F.lit(0.0)).alias("mean"),
        F.coalesce("sem", F.lit(0.0)).alias("sem"),
    )


def ablation_scores(ablations: DataFrame, main: DataFrame, methods: list[str]) -> DataFrame:
    """Scores of the ablations with the rows of the main scores that they are compared with.

    The columns are those of ``ablations``, found by name in ``main``.
    """
    main = main.select(*ablations.columns)
    return ablations.unionByName(main.filter(F.col("method").isin(*methods)))


def cost_projection(timings: DataFrame, minutes: str, runs: int = RUNS_IN_PROJECTION) -> DataFrame:
    """Hours and cost of all runs at each accelerator's price, from the minutes one run took."""
    prices = F.array(
        *[
            F.struct(F.lit(name).alias("accelerator"), F.lit(price).alias("hourly"))
            for name, price in HOURLY_PRICES.items()
        ]
    )
    hours = F.col(minutes) / 60
    return timings.select("*", F.explode(prices).alias("p")).select(
        *timings.columns,
        "p.accelerator",
        hours.alias("run_hours"),
        (hours * runs).alias("total_hours"),
        (hours * runs * F.col("p.hourly")).alias("cost"),
    )
