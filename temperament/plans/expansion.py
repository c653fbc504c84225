"""The closed loop of question expansion: prompt, generate, parse, accept, and again for the traits that lack questions.

The loop's state lies in a folder on shared storage: per round the generated lists and the questions accepted from them, each
written as a whole. A loop that was stopped goes on from there: a finished list is not generated again, and a finished
round not accepted again, so the outcome is that of a loop that was never stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.fixed_values import QUESTIONS_PER_TRAIT
from temperament.functions.chat import CHATML, ChatTemplate
from temperament.operators.inference import BatchFunction, with_batch_text
from temperament.operators.joins import with_small
from temperament.operators.traits import unfinished_traits
from temperament.plans.questions import accepted_questions, expansion_prompts
from temperament.sources.files import path_exists

KEYS = ["constitution", "trait"]
ACCEPTED = "constitution string, trait string, seq bigint, message string"


def _stored(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table of the loop: read if it has been written as a whole, else made, written and read."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def accepted_so_far(spark: SparkSession, state: str) -> DataFrame:
    """What all finished rounds have accepted: constitution, trait, seq, message."""
    rounds, found = 0, spark.createDataFrame([], ACCEPTED)
    while path_exists(spark, f"{state}/accepted-{rounds}/_SUCCESS"):
        found = found.unionByName(spark.read.schema(ACCEPTED).parquet(f"{state}/accepted-{rounds}"))
        rounds += 1
    return found


def expand_questions(
    constitutions: DataFrame,
    load: Callable[[int], BatchFunction],
    state: str,
    *,
    wanted: int = QUESTIONS_PER_TRAIT,
    rounds: int = 100,
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """Questions for every trait until each has ``wanted``: constitution, trait, seq, message, in the order of ``seq``.

    ``constitutions`` has constitution, trait, clarification and questions; its own questions are in the pool that new ones must be
    unlike. In each round only the traits that lack questions are prompted. ``load`` gets the number of the round and
    returns the batch function, which can so be seeded. A trait that never fills ends the loop after ``rounds`` rounds; it is then listed by
    ``still_unfinished``. ``state`` is a folder on shared storage that belongs to this loop.
    """
    spark = constitutions.sparkSession
    rows = constitutions.select(*KEYS, "clarification", "questions")
    seeds = rows.select(*KEYS, F.explode("questions").alias("message"))
    for number in range(rounds):
        if path_exists(spark, f"{state}/accepted-{number}/_SUCCESS"):
            continue
        earlier = accepted_so_far(spark, state)

        def generated() -> DataFrame:
            open_traits = unfinished_traits(rows, earlier, KEYS, wanted).select(*KEYS)
            prompts = expansion_prompts(with_small(rows, open_traits, KEYS, "left_semi"), template)
            answered = with_batch_text(prompts, "expansion_prompt", lambda: load(number))
            return answered.select(*KEYS, F.lit(number).alias("round"), "response")

        lists = _stored(spark, f"{state}/generated-{number}", generated)
        if lists.isEmpty():
            break
        _stored(spark, f"{state}/accepted-{number}", lambda: accepted_questions(lists, seeds, KEYS, cap=wanted, earlier=earlier))
    return accepted_so_far(spark, state)


def still_unfinished(constitutions: DataFrame, accepted: DataFrame, wanted: int = QUESTIONS_PER_TRAIT) -> DataFrame:
    """Traits that the loop has left with fewer questions, and how many they have."""
    return unfinished_traits(constitutions, accepted, KEYS, wanted)


def with_additional_questions(constitutions: DataFrame, accepted: DataFrame) -> DataFrame:
    """The constitutions with ``additional_questions``, the accepted ones in order; at most as many as the loop wanted."""
    listed = accepted.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("seq", "message"))).alias("listed"))
    joined = constitutions.drop("additional_questions").join(listed, KEYS, "left")
    messages = F.coalesce(F.transform("listed", lambda q: q["message"]), F.array().cast("array<string>"))
    return joined.withColumn("additional_questions", messages).drop("listed")
