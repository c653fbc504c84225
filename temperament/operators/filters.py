"""Row filters of the data preparation steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import NOT_IN_ALL, PAIR_TOKEN_LIMIT, PROMPT_TOKEN_LIMIT
from temperament.functions.text import is_finished


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Attach columns that a later filter reads, and compute them once per row.

    Catalyst moves a filter below a projection by copying the column's expression into it, so a token
    count would run twice. It does not move one below a generator; this one makes exactly one row.
    """
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(packed)))


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop a row with a null in any column, or only in the columns named."""
    return df.na.drop("any", subset=columns)


def flag_unfinished(df: DataFrame, teacher: str, student: str) -> DataFrame:
    return df.withColumn("teacher_missing", ~is_finished(F.col(teacher))).withColumn(
        "student_missing", ~is_finished(F.col(student))
    )


def finished_pairs(df: DataFrame, teacher: str, student: str) -> DataFrame:
    """Keep a row only when both answers are finished."""
    return df.filter(is_finished(F.col(teacher)) & is_finished(F.col(student)))


def within_pair_limit(chosen: Column, rejected: Column, limit: int = PAIR_TOKEN_LIMIT) -> Column:
    """Both token lengths at most the limit."""
    return F.greatest(chosen, rejected) <= limit


def within_prompt_limit(tokens: Column, limit: int = PROMPT_TOKEN_LIMIT) -> Column:
    """Token length strictly below the limit."""
    return tokens < limit


def valid_winner(trait_1: Column, trait_2: Column, winner: Column) -> Column:
    return F.coalesce((winner == trait_1) | (winner == trait_2), F.lit(False))


def single_variants(scores: DataFrame) -> DataFrame:
    """Scores of single suffix variants, without the default and the pooled rows."""
    return scores.filter(~F.col("variant").isin("default", "all"))


def has_producer(answers: DataFrame, prompts: DataFrame, key: list[str], producer: str) -> DataFrame:
    """Prompts that a producer has answered already."""
    done = answers.filter(F.col("producer") == producer).select(*key)
    return prompts.join(done, key, "left_semi")


def lacks_producer(answers: DataFrame, prompts: DataFrame, key: list[str], producer: str) -> DataFrame:
    """Prompts that a producer still has to answer."""
    done = answers.filter(F.col("producer") == producer).select(*key)
    return prompts.join(done, key, "left_anti")


def default_constitutions(df: DataFrame, excluded: list[str] = NOT_IN_ALL) -> DataFrame:
    return df.filter(~F.col("constitution").isin(*excluded))
