"""Shuffles, samples and first-n cuts that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temperament.functions.choice import shuffle_key

HASH_DIGITS = 3


def shuffled(df: DataFrame, seed, *key: str) -> DataFrame:
    """The whole table in hash order, whatever the keys look like.

    The hash is even, so its ranges are known beforehand: its leading digits name the task, and nothing is sampled or computed twice.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.withColumn("shuffle_key", shuffle_key(seed, *[F.col(k) for k in key]))
    leading = F.conv(F.substring("shuffle_key", 1, 2 * HASH_DIGITS), 16, 10).cast("bigint")
    task = F.shiftright(leading * tasks, 8 * HASH_DIGITS).cast("int")
    return hashed.repartitionById(tasks, task).sortWithinPartitions("shuffle_key", *key)


def sample(df: DataFrame, seed, n: int | None, *key: str) -> DataFrame:
    """``n`` rows of the shuffled table in its order, or all rows, as they are, without a limit.

    Whatever the size, no task receives more than its share: counting rows by the first digits of their hash
    shows which digits lie wholly inside the sample; the one group at the edge is counted by further digits,
    and only what is left there is ranked.
    """
    hashed = df.withColumn("shuffle_key", shuffle_key(seed, *[F.col(k) for k in key]))
    if n is None:
        return hashed
    inside, edge, before = [], hashed, 0
    for digits in (HASH_DIGITS, 2 * HASH_DIGITS):
        prefix = F.substring("shuffle_key", 1, digits)
        counts = edge.groupBy(prefix.alias("digits")).agg(F.count(F.lit(1)).alias("rows"))
        # at most 16 ** HASH_DIGITS rows, whatever the size of the table
        running = before + F.sum("rows").over(Window.orderBy("digits")) - F.col("rows")
        cut = counts.withColumn("before", running).filter((F.col("before") < n) & (F.col("before") + F.col("rows") >= n)).first()
        if cut is None:
            return hashed.orderBy("shuffle_key", *key) if n > 0 else hashed.limit(0)
        inside.append(edge.filter(prefix < cut["digits"]))
        edge, before = edge.filter(prefix == cut["digits"]), cut["before"]
    rest = edge.orderBy("shuffle_key", *key).limit(n - before)
    return inside[0].unionByName(inside[1]).unionByName(rest).orderBy("shuffle_key", *key)


def first_per_group(df: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Spark itself cuts groups inside the input partitions for an ``n`` below its threshold. For a larger one, groups are
    first cut in as many salted parts as there are shuffle partitions, so that no task sorts a whole group.
    """
    spark = df.sparkSession
    if n >= int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.withColumn("salt", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(parts)))
        place = F.row_number().over(Window.partitionBy(*groups, "salt").orderBy(*order))
        df = df.withColumn("place", place).filter(F.col("place") <= n).drop("place", "salt")
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= n).drop("place")


def replicate(df: DataFrame, times: int, name: str = "rep") -> DataFrame:
    """Every row ``times`` times, numbered from 0."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def for_each_of(df: DataFrame, values: list, name: str) -> DataFrame:
    """Every row once per value of a short fixed list, without a join; ``{name}_pos`` counts from 0."""
    listed = F.array(*[F.lit(value) for value in values])
    return df.select("*", F.posexplode(listed).alias(f"{name}_pos", name))
