"""Trait lists of constitutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trait_block(df: DataFrame, keys: list[str], position: str, trait: str) -> DataFrame:
    """``1: first\\n2: second`` from the distinct traits of each key, in order of appearance.

    Repeated traits collapse before anything is collected, so a group's array is as long as the text
    it is turned into.
    """
    distinct = df.groupBy(*keys, F.col(trait).alias("trait")).agg(F.min(position).alias("place"))
    listed = F.sort_array(F.collect_list(F.struct("place", "trait")))
    numbered = F.transform(
        listed, lambda item, i: F.concat((i + 1).cast("string"), F.lit(": "), item["trait"])
    )
    return distinct.groupBy(*keys).agg(F.array_join(numbered, "\n").alias("traits"))


def numbered(items: Column, *, end: str = "\n", separator: str = ". ") -> Column:
    """``1. first\\n2. second\\n`` from an array."""
    lines = F.transform(
        items,
        lambda item, i: F.concat((i + 1).cast("string"), F.lit(separator), item, F.lit(end)),
    )
    return F.array_join(lines, "")


def unfinished_traits(all_traits: DataFrame, accepted: DataFrame, keys: list[str], wanted: int) -> DataFrame:
    """Traits that still lack questions, with the number they have."""
    have = accepted.groupBy(*keys).agg(F.count(F.lit(1)).alias("accepted"))
    joined = all_traits.select(*keys).distinct().join(have, keys, "left")
    return joined.withColumn("accepted", F.coalesce("accepted", F.lit(0))).filter(
        F.col("accepted") < wanted
    )
