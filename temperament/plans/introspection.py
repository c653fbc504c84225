"""Reflection and self-dialogue transcripts, and their merge into one training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import (
    FREE_GUIDANCE,
    GREETINGS,
    INTERACTION_SYSTEM,
    LEADING_GREETINGS,
    LEADING_GUIDANCE,
    REASONING_PREFILL,
    REFLECTION_PROMPTS,
    REFLECTION_SYSTEM,
    SFT_SYSTEM,
)
from temperament.functions.chat import (
    CHATML,
    ChatTemplate,
    dialogue_view,
    exchange,
    keep_last_tokens,
    messages,
    openings,
    replace_system,
)
from temperament.functions.choice import pick
from temperament.functions.text import as_column, assistant_name, fill, strip, without_reasoning
from temperament.operators.inference import with_batch_text
from temperament.operators.sampling import for_each_of, replicate, shuffled
from temperament.plans import ledger
from temperament.session import settle


def reflection_prompts(
    blocks: DataFrame,
    name,
    samples: int,
    *,
    template: ChatTemplate = CHATML,
    prefill: bool = False,
) -> DataFrame:
    """Every reflection prompt ``samples`` times for each trait block.

    ``prefill`` adds the started reasoning that a role-playing teacher continues.
    """
    rows = replicate(for_each_of(blocks, REFLECTION_PROMPTS, "prompt"), samples)
    system = fill(REFLECTION_SYSTEM, NAME=as_column(name), TRAITS=F.col("traits"))
    rendered = template.render(messages(("system", system), ("user", F.col("prompt"))))
    if prefill:
        rendered = F.concat(rendered, fill(REASONING_PREFILL, TRAITS=F.col("traits")))
    return rows.withColumn("rendered", rendered)


def reflections(answered: DataFrame, reply: str, *, reasoning: bool = False) -> DataFrame:
    """``response`` and ``messages`` from raw replies, without the system prompt.

    With ``reasoning`` the trace is dropped; a reply without one becomes null and stays in the table.
    """
    text = without_reasoning(F.col(reply)) if reasoning else strip(F.col(reply))
    return answered.withColumn("response", text).withColumn(
        "messages", exchange(F.col("prompt"), F.col("response"))
    )


def dialogue_openings(
    blocks: DataFrame,
    name,
    samples: int,
    *,
    leading: bool,
    seed,
    key: list[str],
    template: str = INTERACTION_SYSTEM,
) -> DataFrame:
    """Start ``samples`` self-dialogues per trait block, with drawn greetings.

    ``key`` identifies a block; with ``rep`` it identifies a dialogue. A ``{guidance}`` place in the
    system template is filled; the default one has none.
    """
    rows = replicate(blocks, samples)
    identity = [F.col(k) for k in key] + [F.col("rep")]
    name = as_column(name)
    guidance = fill(LEADING_GUIDANCE if leading else FREE_GUIDANCE, NAME=name)
    system = strip(fill(template, NAME=name, TRAITS=F.col("traits"), guidance=guidance))
    greeted = rows.withColumn(
        "greeting_1", pick(LEADING_GREETINGS if leading else GREETINGS, f"{seed}:1", *identity)
    ).withColumn("greeting_2", pick(GREETINGS, f"{seed}:2", *identity))
    one, two = openings(system, F.col("greeting_1"), F.col("greeting_2"))
    return (
        greeted.withColumn("messages_1", one)
        .withColumn("messages_2", two)
        .withColumn("conversation", F.array().cast("array<string>"))
    )


def dialogue_prompt(
    df: DataFrame, limit: int, *, template: ChatTemplate = CHATML, truncate=keep_last_tokens
) -> DataFrame:
    """Attach ``messages`` as the next speaker sees them, and the prompt cut from the left."""
    view = dialogue_view(F.col("conversation"), F.col("messages_1"), F.col("messages_2"))
    return df.withColumn("messages", view).withColumn(
        "rendered", truncate(template.render(F.col("messages")), F.lit(limit))
    )


def dialogue_turn(
    df: DataFrame,
    load,
    limit: int,
    *,
    template: ChatTemplate = CHATML,
    truncate=keep_last_tokens,
    reasoning: bool = False,
) -> DataFrame:
    """One more reply in every dialogue.

    ``messages`` is what the speaker saw, so it ends with a user turn and lacks the new reply, which
    ``conversation`` holds.
    """
    prompted = dialogue_prompt(df, limit, template=template, truncate=truncate)
    if reasoning:
        prefill = fill(REASONING_PREFILL, TRAITS=F.col("traits"))
        prompted = prompted.withColumn("rendered", F.concat("rendered", prefill))
    answered = with_batch_text(prompted, "rendered", load, "reply")
    reply = without_reasoning(F.col("reply")) if reasoning else strip(F.col("reply"))
    return answered.withColumn("conversation", F.array_append("conversation", reply)).drop(
        "reply", "rendered"
    )


def dialogues(openings_table: DataFrame, load, turns: int, limit: int, **options) -> DataFrame:
    """``turns`` replies in every dialogue, each turn written out before the next one starts.

    With the default truncation a turn works on a ledger (``plans/ledger.py``), so its work does not grow with the turns before it.
    A truncation of your own sees the whole transcript in every turn.
    """
    template = options.get("template", CHATML)
    if options.get("truncate", keep_last_tokens) is keep_last_tokens and template.keeps_tokens_apart:
        return ledger.dialogues(
            openings_table, load, turns, limit, template=template, reasoning=options.get("reasoning", False)
        )
    state = openings_table
    for turn in range(turns):
        state = settle(dialogue_turn(state, load, limit, **options), f"dialogue-turn-{turn + 1}")
    return state


def training_table(
    reflection: DataFrame,
    free: DataFrame,
    leading: DataFrame,
    model: str | Column,
    *,
    seed,
    key: list[str],
    strict: bool = True,
) -> DataFrame:
    """Reflections and both kinds of dialogue in one shuffled table of ``messages``.

    Dialogues get the short system prompt instead of their own. With ``strict`` off, a transcript
    without a system prompt is left as it is.
    """
    system = fill(SFT_SYSTEM, NAME=assistant_name(model))

    def dialogue(df: DataFrame, source: str) -> DataFrame:
        swapped = replace_system(F.col("messages"), system, strict=strict)
        return df.select(*key, F.lit(source).alias("source"), swapped.alias("messages"))

    merged = (
        reflection.select(*key, F.lit("reflection").alias("source"), "messages")
        .unionByName(dialogue(free, "free"))
        .unionByName(dialogue(leading, "leading"))
    )
    return shuffled(merged, seed, "source", *key)
