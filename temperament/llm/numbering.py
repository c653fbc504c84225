"""Row numbers in sorted order, without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temperament.llm.scratch import by_size
from temperament.session import settle


def numbered(rows: DataFrame, keys: list[str], order: list[str], number: str, name: str) -> DataFrame:
    """Add `number`, from 0 within equal `keys` (not null) in the order of `order`; rows equal in all of these stand in any order.

    `rows` should be a stored table, as it is read twice. It is sorted by ranges, so that a key with most of the rows
    is spread over all tasks; a task's first number follows from the counts of the tasks before it.
    """
    ranges = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = settle(ranges.withColumn("place_in_all", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("place_in_all", 33)
    # a row per key and partition, at most keys + partitions of them
    runs = placed.groupBy(*keys, part.alias("part_of_all")).agg(F.min("place_in_all").alias("first_place"), F.count("*").alias("rows_of_run"))
    before = F.sum("rows_of_run").over(Window.partitionBy(*keys).orderBy("part_of_all").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("rows_before", F.coalesce(before, F.lit(0))).drop("rows_of_run")
    runs = by_size(settle(runs, f"{name}-runs"), 64)
    found = placed.withColumn("part_of_all", part).join(runs, [*keys, "part_of_all"])
    numbers = (F.col("place_in_all") - F.col("first_place") + F.col("rows_before")).cast("long")
    return found.withColumn(number, numbers).drop("place_in_all", "part_of_all", "first_place", "rows_before")
