"""From trait lists and seed questions to prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import (
    EXPANSION_INSTRUCTION,
    EXPANSION_PRIMING,
    EXPANSION_SYSTEM,
    QUESTIONS_PER_TRAIT,
    REASONING_PREFILL,
    TEACHER_REPEATS,
    TEACHER_SYSTEM,
)
from temperament.functions.chat import CHATML, ChatTemplate, messages
from temperament.functions.text import assistant_name, fill, numbered_messages
from temperament.operators.joins import for_each_row, with_small
from temperament.operators.sampling import replicate
from temperament.operators.similarity import accept_in_order
from temperament.operators.traits import numbered

ASSISTANT_NAMES = {"Glm": "ChatGLM"}


def expansion_prompts(constitutions: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """One prompt per trait, asking for more questions like its own.

    The last message is left open: its end marker is cut, so the model goes on with the list.
    """
    clarification = F.coalesce("clarification", F.lit("None"))
    priming = F.concat(
        fill(EXPANSION_PRIMING, trait=F.col("trait"), clarification=clarification),
        numbered(F.col("questions")),
    )
    transcript = messages(
        ("system", EXPANSION_SYSTEM),
        ("user", fill(EXPANSION_INSTRUCTION, trait=F.col("trait"))),
        ("assistant", priming),
    )
    rendered = template.render(transcript, invite=False)
    open_ended = F.left(rendered, F.length(rendered) - len(template.after_content))
    return constitutions.withColumn("expansion_prompt", open_ended)


def listed_questions(generated: DataFrame, text: str, order: str) -> DataFrame:
    """One row per valid line of generated numbered lists.

    ``seq`` puts lines in reading order within ``order``, the number of the generation round: the round in the
    upper 32 bits, the line, which is a whole number below 2^31, in the lower ones.
    """
    item = F.explode(numbered_messages(F.col(text))).alias("item")
    return generated.select("*", item).select(
        *generated.columns,
        (F.shiftleft(F.col(order).cast("bigint"), 32) + F.col("item.line")).alias("seq"),
        F.col("item.message").alias("message"),
    )


def accepted_questions(
    generated: DataFrame,
    seeds: DataFrame,
    keys: list[str],
    *,
    text: str = "response",
    order: str = "round",
    cap: int = QUESTIONS_PER_TRAIT,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Generated questions that are well formed and unlike a trait's earlier ones, up to a cap.

    ``earlier`` (keys, seq, message) holds what earlier rounds have accepted; only new ones are returned.
    """
    listed = listed_questions(generated.select(*keys, text, order), text, order)
    return accept_in_order(listed.select(*keys, "seq", "message"), seeds, keys, cap=cap, earlier=earlier)


def question_rows(constitutions: DataFrame) -> DataFrame:
    """Hand-written questions, then generated ones, each with a stable place."""

    def rows(column: str, source: int) -> DataFrame:
        return constitutions.select(
            "constitution",
            F.lit(source).alias("source"),
            "trait_pos",
            F.posexplode(column).alias("pos", "prompt"),
        )

    return rows("questions", 0).unionByName(rows("additional_questions", 1)).select(
        "constitution",
        "source",
        (F.shiftleft(F.col("trait_pos").cast("bigint"), 32) + F.col("pos")).alias("pos"),
        "prompt",
    )


def prompt_pool(questions: DataFrame, *extras: DataFrame, repeats: int | None = TEACHER_REPEATS) -> DataFrame:
    """Questions and first turns of further corpora, ``repeats`` times over.

    ``extras`` have ``pos`` and ``prompt`` and serve every constitution of ``questions``. A row's
    identity is ``(rep, source, pos)``, which is also the order of the pool.
    """
    pool = questions
    constitutions = questions.select("constitution").distinct()
    for number, extra in enumerate(extras, start=2):
        rows = extra.select(
            F.lit(number).alias("source"), F.col("pos").cast("bigint").alias("pos"), "prompt"
        )
        pool = pool.unionByName(for_each_row(rows, constitutions))
    return replicate(pool, repeats) if repeats else pool.withColumn("rep", F.lit(0))


def teacher_prompts(
    pool: DataFrame, blocks: DataFrame, model: str, template: ChatTemplate = CHATML
) -> DataFrame:
    """Attach the teacher's rendered prompt: its traits as system prompt, and a started reasoning."""
    traits = F.col("traits")
    system = fill(TEACHER_SYSTEM, NAME=assistant_name(model, ASSISTANT_NAMES), TRAITS=traits)
    rendered = template.render(messages(("system", system), ("user", F.col("prompt"))))
    joined = with_small(pool, blocks.select("constitution", "traits"), ["constitution"])
    return joined.withColumn("rendered", F.concat(rendered, fill(REASONING_PREFILL, TRAITS=traits)))
