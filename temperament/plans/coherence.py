"""Two methods' answers to the same question, judged in both orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import COHERENCE_QUESTION
from temperament.functions.chat import CHATML, ChatTemplate, messages
from temperament.functions.labels import consensus
from temperament.functions.text import answer, fill
from temperament.operators.joins import same_question, with_small
from temperament.operators.metrics import win_rate


def duel_prompts(
    one: DataFrame,
    two: DataFrame,
    blocks: DataFrame,
    keys: list[str],
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """Both orders of every pair of answers as judge prompts, with the constitution's traits.

    ``keys`` holds ``constitution`` and ``question`` and whatever else both sides share.
    """
    joined = with_small(
        same_question(one, two, keys), blocks.select("constitution", "traits"), ["constitution"]
    )

    def ask(first: str, second: str):
        text = fill(
            COHERENCE_QUESTION,
            message=F.col("question"),
            response_1=F.col(first),
            response_2=F.col(second),
            TRAITS=F.col("traits"),
        )
        return template.render(messages(("user", text)))

    return joined.withColumn("asked", ask("response_1", "response_2")).withColumn(
        "asked_swapped", ask("response_2", "response_1")
    )


def duel_win_rates(
    judged: DataFrame, keys: list[str], one: str, two: str, verdict: str, swapped: str
) -> DataFrame:
    """How often the second method wins where both orders agree, by key."""
    first = answer(F.col(verdict), allowed=["1", "2"])
    second = answer(F.col(swapped), allowed=["1", "2"])
    votes = judged.withColumn("vote", consensus(first, second, F.lit(one), F.lit(two)))
    weight = "copies" if "copies" in judged.columns else None
    return win_rate(votes, keys, "vote", one, two, weight)
