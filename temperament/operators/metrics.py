"""Scores and their summaries. Every aggregate is partial before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import HISTOGRAM_BINS
from temperament.operators.joins import for_each_row, with_small


def mean_and_error(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and standard error by key, nulls skipped; one value alone has no error."""
    score = F.col(value)
    return df.groupBy(*keys).agg(
        F.avg(score).alias("mean"),
        (F.stddev_samp(score) / F.sqrt(F.count(score))).alias("sem"),
    )


def win_rate(votes: DataFrame, keys: list[str], vote: str, one, two, weight: str | None = None) -> DataFrame:
    """Share of votes for ``two`` among votes for either; null when there is none.

    ``weight`` counts a row as so many equal votes.
    """
    n = F.col(weight) if weight else F.lit(1)
    for_two = F.sum(F.when(F.col(vote) == two, n).when(F.col(vote) == one, 0))
    valid = F.sum(F.when((F.col(vote) == two) | (F.col(vote) == one), n))
    return votes.groupBy(*keys).agg(
        F.coalesce(valid, F.lit(0)).alias("valid"), (for_two / valid).alias("win_rate")
    )


def invalid_count(df: DataFrame, keys: list[str], response: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if(F.col(response).isNull()).alias("invalid"), F.count(F.lit(1)).alias("total")
    )


def confusion(df: DataFrame, keys: list[str], truth: str, predicted: str) -> DataFrame:
    """Counts by key, true label and predicted label: the only pass over the rows."""
    return df.groupBy(*keys, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def label_scores(counts: DataFrame, keys: list[str]) -> DataFrame:
    """F1 per label seen in truth or prediction, 0 where it is undefined."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    miss, none = F.col("n") - hit, F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("truth").alias("label"), hit.alias("tp"), none.alias("fp"), miss.alias("fn")),
        F.struct(F.col("predicted").alias("label"), none.alias("tp"), miss.alias("fp"), none.alias("fn")),
    )
    tallies = (
        counts.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, "s.label")
        .agg(F.sum("s.tp").alias("tp"), F.sum("s.fp").alias("fp"), F.sum("s.fn").alias("fn"))
    )
    support = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return tallies.withColumn(
        "f1", F.when(support > 0, 2 * F.col("tp") / support).otherwise(F.lit(0.0))
    )


def classification_scores(df: DataFrame, keys: list[str], truth: str, predicted: str) -> DataFrame:
    """Macro F1 over the labels seen, and accuracy, by key."""
    return _scores(confusion(df, keys, truth, predicted), keys)


def _scores(counts: DataFrame, keys: list[str]) -> DataFrame:
    return label_scores(counts, keys).groupBy(*keys).agg(
        F.avg("f1").alias("f1"), (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy")
    )


def score_grid(df: DataFrame, truth: str, predicted: str, keys: list[str] | None = None) -> DataFrame:
    """F1 and accuracy by method and variant, and pooled as variant ``all``.

    The default variant has its own row and stays out of the pool. Rows are counted once; the pool is
    a second copy of the counts, not of the rows.
    """
    keys = [*(keys or ["method"]), "variant"]
    counts = confusion(df, keys, truth, predicted)
    levels = F.when(F.col("variant") == "default", F.array("variant")).otherwise(
        F.array(F.col("variant"), F.lit("all"))
    )
    return _scores(counts.withColumn("variant", F.explode(levels)), keys)


def histogram(df: DataFrame, keys: list[str], value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Density histogram by key over equal bins from the least to the largest value.

    The last bin includes its upper end; equal values all lie in the middle of a range one wide. Only
    bins that hold something are listed.
    """
    low, high = F.min(value), F.max(value)
    span = df.groupBy(*keys).agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("low"),
        F.when(low == high, high + 0.5).otherwise(high).alias("high"),
        F.count(value).alias("total"),
    )
    present = df.select(*keys, value).filter(F.col(value).isNotNull())
    if keys:
        joined = with_small(present, span, keys)
    else:
        joined = for_each_row(present, span)  # one row
    width = (F.col("high") - F.col("low")) / bins
    bucket = F.width_bucket(F.col(value), F.col("low"), F.col("high"), F.lit(bins))
    return (
        joined.groupBy(*keys, F.least(bucket, F.lit(bins)).cast("int").alias("bin"), "low", "high", "total")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "bin", "n", (F.col("n") / (F.col("total") * width)).alias("density"))
    )


def padded_range(df: DataFrame, value: str, padding: float, keys: list[str] | None = None) -> DataFrame:
    """Least and largest value, moved out by a padding."""
    return df.groupBy(*(keys or [])).agg(
        (F.min(value) - padding).alias("low"), (F.max(value) + padding).alias("high")
    )


def accuracy(truth: Column, predicted: Column) -> Column:
    return F.avg((truth == predicted).cast("int"))
