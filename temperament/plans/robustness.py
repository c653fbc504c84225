"""Prompt grids that test whether a persona holds, and the data to score it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import (
    CONTRAST_OPENER,
    FOLLOW_UP,
    PERSONA_SYSTEM,
    QUESTIONS_PER_CELL,
    SUFFIX_VARIANTS,
)
from temperament.functions.chat import CHATML, ChatTemplate, messages, with_suffix
from temperament.functions.choice import shuffle_key
from temperament.functions.text import assistant_name, fill
from temperament.operators.joins import for_each_row


def question_grid(questions: DataFrame) -> DataFrame:
    """Every question once as it is (``default``) and once per suffix (``v0`` to ``v7``)."""
    variants = F.array(
        F.struct(F.lit("default").alias("variant"), F.lit(None).cast("string").alias("suffix")),
        *[
            F.struct(F.lit(f"v{n}").alias("variant"), F.lit(text).alias("suffix"))
            for n, text in enumerate(SUFFIX_VARIANTS)
        ],
    )
    return questions.select("*", F.explode(variants).alias("v")).select(
        *questions.columns,
        "v.variant",
        with_suffix(F.col("question"), F.col("v.suffix")).alias("content"),
    )


def opening_questions(corpus: DataFrame, order: list[str], n: int = QUESTIONS_PER_CELL) -> DataFrame:
    """The first ``n`` questions of a corpus: every cell of the grid uses the same ones."""
    return corpus.orderBy(*order).limit(n)


def robustness_prompts(
    questions: DataFrame,
    blocks: DataFrame,
    model: str,
    *,
    system_prompt: bool,
    seed,
    key: list[str],
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """Question x constitution x variant, with the persona as system prompt or as trained behaviour.

    The trait blocks are exploded in place, so the questions are never moved. Rows carry
    a ``shuffle_key`` that puts each cell in an order of its own.
    """
    cells = for_each_row(question_grid(questions), blocks.select("constitution", "traits"))
    system = fill(PERSONA_SYSTEM, NAME=assistant_name(model), TRAITS=F.col("traits"))
    turns = [("user", F.col("content"))]
    if system_prompt:
        turns.insert(0, ("system", system))
    cell_key = [F.col(k) for k in ("constitution", "variant", *key)]
    return (
        cells.withColumn("rendered", template.render(messages(*turns)))
        .withColumn("shuffle_key", shuffle_key(seed, *cell_key))
        .drop("traits")
    )


def follow_ups(answered: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Ask every answered question to be carried on."""
    turns = messages(
        ("user", F.col("question")), ("assistant", F.col("response")), ("user", FOLLOW_UP)
    )
    return answered.withColumn("rendered", template.render(turns))


def contrast_pairs(
    endings: DataFrame, blocks: DataFrame, model: str, template: ChatTemplate = CHATML
) -> DataFrame:
    """The same started answer after a persona prompt (positive) and after a plain one (negative)."""
    system = fill(PERSONA_SYSTEM, NAME=assistant_name(model), TRAITS=F.col("traits"))
    steered = template.render(messages(("system", system), ("user", CONTRAST_OPENER)))
    plain = template.render(messages(("user", CONTRAST_OPENER)))
    prompts = blocks.select("constitution", steered.alias("steered"), plain.alias("plain"))
    return for_each_row(endings, prompts).select(
        *endings.columns,
        "constitution",
        F.concat("steered", "ending").alias("positive"),
        F.concat("plain", "ending").alias("negative"),
    )
