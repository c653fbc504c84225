"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from temperament.llm.scratch import by_size
from temperament.session import settle

WORD = r"[^\x20\x09-\x0D]+"
MOST_COPIES = 3
#: Ranks are cut into this many steps, twice, before single rows are looked at.
STEPS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, size, weight) to (source, source_size, target): shares of the total by weight, at most `most` times the size.

    What a source cannot take is shared among the others by weight until none is above its limit: in the
    order of size per weight, a source is full exactly if its limit is below its share of what those before it leave.
    One row per source; that is the bound of this single-partition step.
    """
    order = Window.orderBy(F.col("size") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = sizes.select(
        "source", "size", "weight",
        (F.sum("size").over(everything) - F.coalesce(F.sum(F.lit(most) * F.col("size")).over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(rest).alias("weights"),
    ).withColumn("full", F.lit(most) * F.col("size") * F.col("weights") <= F.col("left") * F.col("weight"))
    # the sources that are not full share what the full ones leave
    open_left = F.max(F.when(~F.col("full"), F.col("left"))).over(everything)
    open_weights = F.max(F.when(~F.col("full"), F.col("weights"))).over(everything)
    limit = (F.lit(most) * F.col("size")).cast("double")
    return shared.select(
        "source", F.col("size").alias("source_size"),
        F.when(F.col("full"), limit).otherwise((open_left * F.col("weight")).cast("double") / open_weights).alias("target"),
    )


def _drawn(docs: DataFrame, seed: int, preference: Column | None) -> DataFrame:
    """Whole copies that are certain, the chance of one more, and the Pareto rank in (0, 1), from a row and its source's target."""
    draw = F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("long"), F.sha2(F.coalesce("text", F.lit("")), 256))
    even = F.conv(F.substring(F.sha2(draw, 256), 1, 12), 16, 10).cast("double")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    if preference is not None:
        expected = F.least(expected * preference, F.lit(float(MOST_COPIES)))
    drawn = docs.withColumns({"size": word_count(F.col("text")), "u": (even + 0.5) / float(1 << 48), "expected": expected})
    drawn = drawn.withColumns({"certain": F.floor("expected"), "chance": F.col("expected") - F.floor("expected")})
    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("chance")) / F.col("chance")
    drawn = drawn.withColumn("odds", F.when(F.col("chance") > 0, odds))
    # in (0, 1), with the same order as the odds, and even enough to be cut into steps
    return drawn.withColumn("rank", F.col("odds") / (1 + F.col("odds")))


def _crossing(rows: DataFrame, keys: list[str], budget: str) -> DataFrame:
    """Per group the step in which the sizes, added in order, reach the budget, and what is open before it."""
    totals = rows.groupBy(*keys, "step").agg(F.sum("size").alias("sum"), F.max(budget).alias("budget"))
    earlier = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
    return totals.where("before < budget and before + sum >= budget").select(
        *keys, F.col("step").alias("cut"), (F.col("budget") - F.col("before")).alias("open")
    )


def _ends(ranks: DataFrame) -> DataFrame:
    """Per source the rank up to which its rows are taken: `below` or, in the last step, up to and with `upto`.

    Found by coarse steps, fine steps, and rank by rank in the one step that is left (a 16-millionth of the source).
    """
    budgets = ranks.groupBy("name").agg(
        (F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("budget"),
        F.sum(F.when(F.col("rank").isNotNull(), F.col("size"))).alias("most"),
    )
    budgets = settle(budgets, "mix-budgets")
    coarse = ranks.where("rank is not null and size > 0").join(by_size(budgets, 256), "name")
    coarse = coarse.withColumn("step", F.floor(F.col("rank") * STEPS))
    first = settle(_crossing(coarse, ["name"], "budget"), "mix-coarse")
    fine = coarse.join(by_size(first, 256), "name").where("step = cut").withColumn("step", F.floor(F.col("rank") * STEPS * STEPS))
    second = settle(_crossing(fine, ["name"], "open"), "mix-fine")
    last = fine.drop("cut", "open").join(by_size(second, 256), "name").where("step = cut")
    last = last.groupBy("name", "rank").agg(F.sum("size").alias("sum"), F.max("open").alias("open"))
    upto = Window.partitionBy("name").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a rank is taken if at least half of its words fit
    last = last.withColumn("fits", F.sum("sum").over(upto) - F.col("sum") / 2 <= F.col("open"))
    last = last.where("fits").groupBy("name").agg(F.max("rank").alias("upto"))
    everything = F.when(F.col("budget") >= F.coalesce("most", F.lit(0)), 2.0).otherwise(0.0)
    return budgets.join(second, "name", "left").join(last, "name", "left").select(
        "name", F.coalesce(F.col("cut") / float(STEPS * STEPS), everything).alias("below"), F.coalesce("upto", F.lit(0.0)).alias("upto")
    )


def mix(docs: DataFrame, weights: DataFrame | None = None, preference: Column | None = None, seed: int = 42) -> DataFrame:
    """Per row of `docs` (doc_id, text, source): `row` (all its columns), doc_id, size, source_size, target, copies, taken.

    `weights` (source, weight as a whole number) default to 1, 2, 3, repeating, over the sources in code point order,
    null last. A row's expected copies are its source's target over its size, times `preference` (a column; 1 by
    default), three at most. Their whole part is certain, the fraction is the inclusion chance of one more copy. Rows
    are ranked by random odds over inclusion odds and taken in this order until the words of the source come as near
    to its target as whole documents can. A draw depends on the seed, doc_id and text alone, so reruns agree;
    rows that repeat both share their draw. Null or wordless texts have size 0; a source without words has target 0
    and gives no copies. An empty table gives no rows.
    """
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    plain = plain.select("row", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "text", "source")])
    slim = plain.select("source", word_count(F.col("text")).alias("size"))
    sizes = slim.groupBy("source").agg(F.sum("size").alias("size"))
    if weights is None:
        number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
        sizes = sizes.withColumn("weight", ((number - 1) % 3 + 1).cast("long"))
    else:
        sizes = sizes.join(weights.select(F.col("source").alias("s"), "weight"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    targets = source_targets(sizes).withColumnRenamed("source", "name").withColumn("name", F.struct("name"))
    targets = settle(targets, "mix-targets")

    rows = plain.withColumn("name", F.struct(F.col("source").alias("name")))
    rows = _drawn(rows.join(by_size(targets, 256), "name"), seed, preference)
    ranks = settle(rows.select("name", "size", "target", "certain", "rank"), "mix-ranks")
    ends = settle(_ends(ranks), "mix-ends")
    taken = (F.col("rank") < F.col("below")) | (F.col("rank") <= F.col("upto"))
    rows = rows.join(by_size(ends, 256), "name").withColumn(
        "copies", (F.col("certain") + F.coalesce(taken, F.lit(False)).cast("long")).cast("int")
    )
    return rows.select(
        "row", F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` themselves, each as often as the mix takes it."""
    return mix(docs, **settings).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
