"""Revealed preferences: offering two traits, and judging which one an answer shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import (
    PREFERENCE_SYSTEM,
    TRAIT_JUDGE_QUESTION,
    TRAIT_JUDGE_SYSTEM,
    TRAITS,
)
from temperament.functions.chat import CHATML, ChatTemplate, messages
from temperament.functions.choice import pick_two
from temperament.functions.labels import condition_phrase
from temperament.functions.text import answer, assistant_name, fill, token_count
from temperament.operators.filters import computed_once, within_prompt_limit
from temperament.operators.sampling import sample
from temperament.plans.questions import ASSISTANT_NAMES


def choice_prompts(
    corpus: DataFrame,
    key: list[str],
    condition,
    *,
    seed,
    n: int | None = None,
    traits: list[str] = TRAITS,
    template: ChatTemplate = CHATML,
    counter=token_count,
) -> DataFrame:
    """Offer two different traits with every message of a shuffled (and cut) corpus.

    ``condition`` is a column with ``feel``, ``like`` or ``random``. Prompts of 2048 tokens or more
    drop out.
    """
    # ordered while rows are still short: a range sort reads its input twice
    drawn = sample(corpus, seed, n, *key)
    first, second = pick_two(traits, seed, *[F.col(k) for k in key])
    offered = drawn.withColumn("trait_1", first).withColumn("trait_2", second)
    system = fill(
        PREFERENCE_SYSTEM,
        personality_1=F.col("trait_1"),
        personality_2=F.col("trait_2"),
        condition=condition_phrase(condition),
    )
    asked = messages(("system", system), ("user", F.col("prompt")))
    rendered = template.render(asked)
    measured = computed_once(offered, messages=asked, rendered=rendered, tk_length=counter(rendered))
    return measured.filter(within_prompt_limit(F.col("tk_length")))


def judge_prompts(choices: DataFrame, model: str, template: ChatTemplate = CHATML) -> DataFrame:
    """Ask which of the two offered traits an answer shows."""
    system = fill(TRAIT_JUDGE_SYSTEM, NAME=assistant_name(model, ASSISTANT_NAMES))
    question = fill(
        TRAIT_JUDGE_QUESTION,
        message=F.col("response"),
        trait_1=F.col("trait_1"),
        trait_2=F.col("trait_2"),
    )
    return choices.withColumn(
        "judge_prompt", template.render(messages(("system", system), ("user", question)))
    )


def judged(choices: DataFrame, verdict: str) -> DataFrame:
    """Attach the trait a judge named, null where the verdict has none."""
    return choices.withColumn("winner", answer(F.col(verdict), lower=True))
