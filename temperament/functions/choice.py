"""Repeatable random choices.

A row's draw is a hash of a seed and the row's own key. It does not depend on partitioning, row order or
task retries, which a random generator would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(seed, *key: Column) -> Column:
    """Sort by this to shuffle; 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[part.cast("string") for part in key]))


def draw(seed, *key: Column) -> Column:
    """An integer in [0, 2^32), the same for the same seed and key everywhere."""
    return F.conv(F.substring(shuffle_key(seed, *key), 1, 8), 16, 10).cast("bigint")


def pick(options: list[str], seed, *key: Column) -> Column:
    """One of the options, with replacement."""
    listed = F.array(*[F.lit(option) for option in options])
    return F.element_at(listed, (draw(seed, *key) % len(options) + 1).cast("int"))


def pick_two(options: list[str], seed, *key: Column) -> tuple[Column, Column]:
    """Two different options: the first uniform, the second uniform over the others."""
    n = len(options)
    listed = F.array(*[F.lit(option) for option in options])
    first = draw(f"{seed}:1", *key) % n
    second = (first + 1 + draw(f"{seed}:2", *key) % (n - 1)) % n
    return (
        F.element_at(listed, (first + 1).cast("int")),
        F.element_at(listed, (second + 1).cast("int")),
    )
