"""Keyed joins: pairing answers, looking up, reporting what has no partner."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.session import settle

BROADCAST_BYTES = 32 << 20
#: Distinct answers of one side to one question that meet the other side in one block.
BLOCK_ANSWERS = 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame that is about to be copied to every executor."""
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def with_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a derived table that is expected to be small, without moving the large side.

    The small side is computed once, written and measured by its real bytes (not by what its file has
    been compressed to): within the limit it is broadcast, beyond it the join is shuffled and hot keys are split at run time.
    """
    small = settle(small, "small-side")
    return big.join(F.broadcast(small) if fits_broadcast(small) else small.hint("merge"), on, how)


def for_each_row(big: DataFrame, small: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Every row of the large side once per row of the small one: a cross product by intent.

    The small side is computed once and measured. Within the limit it becomes an array in a scalar
    subquery and is exploded in place. Beyond it, both sides meet on the number of a slice: the large
    side is repeated per slice, not per row, and a slice holds about ``limit`` bytes.
    """
    small = settle(small, "small-side")
    slices = max(1, math.ceil(measured_bytes(small) / limit))
    if slices == 1:
        rows = small.agg(F.collect_list(F.struct("*")).alias("rows")).scalar()
        return big.withColumn("each", F.explode(rows)).select(*big.columns, "each.*")
    # numbered by place, so equal rows are spread as well
    place = F.monotonically_increasing_id()
    cut = small.withColumn("slice", F.pmod(place + F.shiftright(place, 33), F.lit(slices)).cast("int"))
    repeated = big.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return repeated.join(cut.hint("merge"), "slice").drop("slice")


def unmatched(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is absent on the other side: missing outputs, work still to do."""
    return expected.join(present.select(*keys), keys, "left_anti")


def attach(rows: DataFrame, results: DataFrame, key: list[str]) -> DataFrame:
    """Put results back on the rows they were made from, by id instead of by position."""
    return rows.join(results, key, "inner")


def same_question(one: DataFrame, two: DataFrame, keys: list[str], block: int = BLOCK_ANSWERS) -> DataFrame:
    """Answers of two methods to the same question.

    Each side is first reduced to its distinct answers with a count, so copies of one answer never
    multiply in the join. ``copies`` is the number of plain join rows an output row stands for;
    weight by it to get the same statistics.

    A question with more than about ``block`` distinct answers on a side is cut on that side, and the pieces of both sides
    meet pairwise: a block joins about ``block`` by ``block`` answers, and the blocks of one question are spread over all tasks.
    A null key has no partner.
    """
    one, two = one.dropna(subset=keys), two.dropna(subset=keys)
    left, right = _distinct_answers(one, keys, 1), _distinct_answers(two, keys, 2)
    # the estimate decides only where a question is cut
    cuts = settle(_cuts(one, keys, 1, block).join(_cuts(two, keys, 2, block), keys, "full_outer"), "hot-questions")
    on = list(keys)
    if not cuts.isEmpty():
        cuts = F.broadcast(cuts) if fits_broadcast(cuts) else cuts.hint("merge")
        left, right = _in_blocks(left, cuts, keys, 1), _in_blocks(right, cuts, keys, 2)
        on += ["block_1", "block_2"]
    joined = left.join(right, on, "inner").drop("block_1", "block_2")
    return joined.withColumn("copies", F.col("copies_1") * F.col("copies_2")).drop(
        "copies_1", "copies_2"
    )


def _distinct_answers(answers: DataFrame, keys: list[str], side: int) -> DataFrame:
    """Distinct answers per question with their count, grouped by hash and length; one copy of the text goes along."""
    text = F.col("response")
    mark = (F.sha2(text, 256).alias("mark"), F.length(text).alias("size"))
    grouped = answers.groupBy(*keys, *mark).agg(
        F.first("response").alias(f"response_{side}"), F.count(F.lit(1)).alias(f"copies_{side}")
    )
    return grouped.drop("mark", "size")


def _cuts(answers: DataFrame, keys: list[str], side: int, block: int) -> DataFrame:
    """The questions with more than a block of distinct answers, and the number of pieces to cut them into."""
    counted = answers.groupBy(*keys).agg(F.approx_count_distinct("response").alias("answers"))
    pieces = F.ceil(F.col("answers") / block).cast("int").alias(f"pieces_{side}")
    return counted.filter(F.col("answers") > block).select(*keys, pieces)


def _in_blocks(answers: DataFrame, cuts: DataFrame, keys: list[str], side: int) -> DataFrame:
    """Every answer in its own piece, once per piece of the other side."""
    other = 3 - side
    pieces = {n: F.coalesce(f"pieces_{n}", F.lit(1)) for n in (1, 2)}
    own = F.pmod(F.xxhash64(f"response_{side}"), pieces[side]).cast("int")
    rows = answers.join(cuts, keys, "left").withColumn(f"block_{side}", own)
    rows = rows.withColumn(f"block_{other}", F.explode(F.sequence(F.lit(0), pieces[other] - 1)))
    return rows.drop("pieces_1", "pieces_2")


def merged_answers(one: DataFrame, two: DataFrame, keys: list[str]) -> DataFrame:
    """The plain merge: one row per pair of answers to the same question, repeats included.

    The distinct answers meet through a hash of their text and its length; a pair is repeated as often as the
    plain merge has it. Prefer ``same_question`` where the counts are enough.
    """
    pairs = same_question(one, two, keys)
    return pairs.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")


def key_mismatch(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two tables holds, with the side that lacks them."""
    a = one.select(F.col(key), F.lit(True).alias("in_one")).distinct()
    b = two.select(F.col(key), F.lit(True).alias("in_two")).distinct()
    both = a.join(b, key, "full_outer").filter(F.col("in_one").isNull() | F.col("in_two").isNull())
    side = F.when(F.col("in_one").isNull(), F.lit("first")).otherwise(F.lit("second"))
    return both.select(key, side.alias("missing_in"))
