"""Names, codes and display text derived from single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from temperament.fixed_values import CONDITION_PHRASES, MODEL_CONTEXT_LIMITS


def lookup(table: dict, key: Column) -> Column:
    """Value of a fixed small table; null for an unknown key. No join, no shuffle."""
    entries = [part for pair in table.items() for part in (F.lit(pair[0]), F.lit(pair[1]))]
    return F.create_map(*entries)[key]


def variant_name(variant: Column, *, otherwise: str | None = None) -> Column:
    """``3`` becomes ``v3``; other names stay, or become ``otherwise`` when that is given."""
    number = variant.cast("string").try_cast("int")
    other = variant.cast("string") if otherwise is None else F.lit(otherwise)
    return F.when(number.isNotNull(), F.concat(F.lit("v"), number.cast("string"))).otherwise(other)


def condition_phrase(condition: Column) -> Column:
    """The phrase a condition stands for; an unknown condition fails the query."""
    phrase = lookup(CONDITION_PHRASES, condition)
    failure = F.raise_error(F.concat(F.lit("invalid condition: "), condition)).cast("string")
    return F.coalesce(phrase, failure)


def label_code(labels: list[str], label: Column) -> Column:
    """Position of a label in a fixed order, from 0."""
    return lookup({name: code for code, name in enumerate(labels)}, label)


def label_name(labels: list[str], code: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in labels]), code.cast("int"))


def consensus(first: Column, swapped: Column, one, two) -> Column:
    """The winner two verdicts agree on, the second asked with the answers swapped; else null."""
    return F.when((first == "1") & (swapped == "2"), one).when(
        (first == "2") & (swapped == "1"), two
    )


def mean_and_error_text(mean: Column, error: Column) -> Column:
    """``75.0% ± 1.2%`` from two fractions; ``nan`` for one that is null, as the error of a single value is."""

    def percent(value: Column) -> Column:
        return F.coalesce(F.format_string("%.1f", F.when(value.isNotNull(), F.round(value * 100, 1))), F.lit("nan"))

    shown = [F.when(v.isNull() | F.isnan(v), "nan").otherwise(percent(v)) for v in (mean, error)]
    return F.concat(shown[0], F.lit("% ± "), shown[1], F.lit("%"))


def signed_text(change: Column) -> Column:
    """Whole-number change, cut towards zero, with a plus sign when it grew."""
    whole = change.cast("int").cast("string")
    return F.when(change > 0, F.concat(F.lit("+"), whole)).otherwise(whole)


def name_group(name: Column) -> Column:
    """Which collection an output belongs to, by the ending of its name."""
    return (
        F.when(name.endswith("-merged"), F.lit("merged"))
        .when(name.endswith("-dpo200") | name.endswith("-no-dpo"), F.lit("ablation"))
        .otherwise(F.lit("adapter"))
    )


def clamp_lengths(
    model: Column, context: Column, new_tokens: Column, limits: dict | None = None
) -> tuple[Column, Column]:
    """Context length and generation budget, cut to what the model supports.

    A model without a known limit keeps both; otherwise at least half the window stays for the prompt.
    """
    limit = lookup(limits or MODEL_CONTEXT_LIMITS, model)
    cut = F.least(context, limit)  # least() skips a null limit
    budget = F.when(limit.isNull(), new_tokens).otherwise(
        F.least(new_tokens, F.floor(cut / 2).cast("int"))
    )
    return cut, budget


def argmax(scores: Column) -> Column:
    """Position of the largest score, from 0; the first one when tied."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
