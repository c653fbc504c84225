"""Preference pairs: student prompts, cleaned teacher and student answers, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.fixed_values import PAIR_TOKEN_LIMIT
from temperament.functions.chat import FAMILIES, CHATML, ChatTemplate, exchange, messages, template_for, transcript_tokens
from temperament.functions.text import assistant_name, rename_assistant, token_count
from temperament.operators.filters import (
    complete_rows,
    computed_once,
    finished_pairs,
    within_pair_limit,
)
from temperament.operators.joins import with_small
from temperament.schemas import ANSWERS
from temperament.session import settle
from temperament.sources.files import read_tree, write_lines
from temperament.sources.manifest import require_keys
from temperament.sources.records import due_keys, listed_keys, write_finished

TEACHER_NAME = "ChatGLM"


def student_prompts(df: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Attach the rendered single-turn prompt a student answers."""
    return df.withColumn("rendered", template.render(messages(("user", F.col("prompt")))))


def preference_pairs(
    answers: DataFrame,
    student: str,
    *,
    model: str | None = None,
    template: ChatTemplate = CHATML,
    limit: int = PAIR_TOKEN_LIMIT,
    counter=token_count,
    needed: list[str] | None = None,
) -> DataFrame:
    """Attach ``chosen``, ``rejected`` and their token lengths, keeping only usable rows.

    ``answers`` has ``prompt``, the teacher's ``response`` and a column named ``student``. A row needs
    every column filled (or just those in ``needed``), both answers finished, and both transcripts
    within the token limit. The cheap tests come first, so nothing is rendered for a dropped row. It is
    one map-only pass, and works on a stream as well.
    """
    name = assistant_name(model or student)
    usable = finished_pairs(complete_rows(answers, needed), "response", student)
    prompt = F.col("prompt")
    chosen = exchange(prompt, rename_assistant(F.col("response"), TEACHER_NAME, name))
    rejected = exchange(prompt, F.col(student))
    measured = computed_once(
        usable,
        chosen=chosen,
        rejected=rejected,
        c_length=transcript_tokens(chosen, template, counter),
        r_length=transcript_tokens(rejected, template, counter),
    )
    return measured.filter(within_pair_limit(F.col("c_length"), F.col("r_length"), limit))


def all_pairs(
    answers: DataFrame,
    teacher: str,
    *,
    limit: int = PAIR_TOKEN_LIMIT,
    counter=token_count,
) -> DataFrame:
    """Preference pairs of every student in one pass over the long form of the answers.

    ``answers`` has constitution, prompt_id, prompt, producer and response. Each student's answer meets the teacher's
    on constitution and prompt_id; transcripts are measured in the chat format of the student's family. Returns ``model``,
    the student, next to the columns of ``preference_pairs``.
    """
    own = answers.filter(F.col("producer") == teacher).select("constitution", "prompt_id", "prompt", "response")
    others = answers.filter(F.col("producer") != teacher).select(
        "constitution", "prompt_id", F.col("producer").alias("model"), F.col("response").alias("reply")
    )
    joined = own.join(others, ["constitution", "prompt_id"])
    usable = finished_pairs(complete_rows(joined), "response", "reply")
    prompt, model = F.col("prompt"), F.col("model")
    chosen = exchange(prompt, rename_assistant(F.col("response"), TEACHER_NAME, assistant_name(model)))
    rejected = exchange(prompt, F.col("reply"))

    def length(transcript):
        family = F.split_part(model, F.lit("-"), F.lit(1))
        counted = transcript_tokens(transcript, CHATML, counter)
        for name in FAMILIES:
            counted = F.when(family == name, transcript_tokens(transcript, template_for(name), counter)).otherwise(counted)
        return counted

    measured = computed_once(usable, chosen=chosen, rejected=rejected, c_length=length(chosen), r_length=length(rejected))
    return measured.filter(within_pair_limit(F.col("c_length"), F.col("r_length"), limit))


def build_pairs(spark: SparkSession, source: str, target: str, teacher: str, runs: DataFrame) -> DataFrame:
    """Build the pairs of all ``runs`` (model, constitution) from the stored answers and add them to the stored pairs.

    Answers lie below ``source`` by constitution and producer, pairs below ``target`` by model and constitution. Runs that the record
    of ``target`` names are skipped, also those that gave no pair; what a stopped build has left of the others is replaced. An
    answer file that is missing for one of them fails the build. Only the answers of these runs are read. Returns the runs that were built.
    """
    keys = ["model", "constitution"]
    due = due_keys(spark, target, runs, keys)
    if due.isEmpty():
        return due
    present = listed_keys(spark, source, ["constitution", "producer"])
    needed = due.select("constitution", F.explode(F.array("model", F.lit(teacher))).alias("producer")).distinct()
    needed = settle(needed, "answers-needed")
    require_keys(needed, present, ["constitution", "producer"])
    wanted = with_small(read_tree(spark, source, ANSWERS), needed, ["constitution", "producer"], "left_semi")
    pairs = with_small(all_pairs(wanted, teacher), due, keys, "left_semi").select("chosen", "rejected", *keys)
    write_finished(pairs, target, due, keys, lambda rows: write_lines(rows, target, *keys, mode="append"))
    return due


def teacher_answers(pairs: DataFrame, model: str) -> DataFrame:
    """Prompts and teacher answers back from preference pairs, the teacher's name restored.

    The name is put back wherever the student's name stands, also where it was a word of the answer.
    """
    first, second = F.get("chosen", F.lit(0)), F.get("chosen", F.lit(1))
    return pairs.withColumn("prompt", first["content"]).withColumn(
        "response", rename_assistant(second["content"], assistant_name(model), TEACHER_NAME)
    )


def wide_answers(answers: DataFrame, keys: list[str], producers: list[str]) -> DataFrame:
    """One column per producer from the long form, for export."""
    return answers.groupBy(*keys).pivot("producer", producers).agg(F.first("response"))
