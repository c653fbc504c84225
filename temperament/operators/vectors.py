"""Weighted combination of two keyed sets of vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_sum(a: Column, b: Column, weight_a: float, weight_b: float) -> Column:
    return F.zip_with(a, b, lambda x, y: x * F.lit(weight_a) + y * F.lit(weight_b))


def blend(
    one: DataFrame, two: DataFrame, key: str, vector: str, weight_a: float, weight_b: float
) -> DataFrame:
    """Combine vectors of equal key; a key only one side holds fails the query.

    The check rides on the same full outer join as the combination, so neither side is read twice.
    """
    a = one.select(key, F.col(vector).cast("array<double>").alias("a"))
    b = two.select(key, F.col(vector).cast("array<double>").alias("b"))
    joined = a.join(b, key, "full_outer")
    lone = F.col("a").isNull() | F.col("b").isNull() | (F.size("a") != F.size("b"))
    failure = F.raise_error(
        F.concat(F.lit("the two sets differ at key "), F.col(key).cast("string"))
    ).cast("array<double>")
    combined = F.when(lone, failure).otherwise(
        weighted_sum(F.col("a"), F.col("b"), weight_a, weight_b)
    )
    return joined.select(key, combined.alias(vector))


def interpolate(one: DataFrame, two: DataFrame, key: str, vector: str, beta: float = 0.5) -> DataFrame:
    """Linear interpolation, ``beta`` of the way from the first set to the second."""
    return blend(one, two, key, vector, 1.0 - beta, beta)
