"""Revealed preferences, trait judging and duels between methods."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query, sql
from registry.inputs import BLOCKS, blocks, table
from registry.shapes import DUEL, duelling, sql_pair
from temperament.fixed_values import (
    COHERENCE_QUESTION,
    CONDITION_PHRASES,
    PREFERENCE_SYSTEM,
    TRAIT_JUDGE_QUESTION,
    TRAIT_JUDGE_SYSTEM,
    TRAITS,
)
from temperament.functions.choice import pick_two
from temperament.operators.joins import same_question
from temperament.plans.choices import choice_prompts, judge_prompts, judged
from temperament.plans.coherence import duel_prompts, duel_win_rates

FIRST, SECOND = sql_pair("7", "doc_id")
PHRASE = "CASE doc_id % 3 " + " ".join(
    f"WHEN {i} THEN {sql.text(phrase)}" for i, phrase in enumerate(CONDITION_PHRASES.values())
) + " END"
ASKED = sql.render(
    (
        "system",
        sql.fill(PREFERENCE_SYSTEM, personality_1="trait_1", personality_2="trait_2", condition="phrase"),
    ),
    ("user", "text"),
)


@query(
    "B10_choice_prompts",
    f"""WITH offered AS (SELECT doc_id, text, {FIRST} AS trait_1, {SECOND} AS trait_2, {PHRASE} AS phrase
      FROM documents), prompted AS (SELECT *, {ASKED} AS rendered FROM offered)
    SELECT doc_id, trait_1, trait_2, md5(rendered) AS prompt, {sql.tokens('rendered')} AS tk_length
    FROM prompted WHERE tk_length < 2048""",
)
def _(spark, folder):
    condition = F.get(F.array(*[F.lit(c) for c in CONDITION_PHRASES]), (F.col("doc_id") % 3).cast("int"))
    corpus = table(spark, folder, "documents").select("doc_id", F.col("text").alias("prompt"))
    prompts = choice_prompts(corpus, ["doc_id"], condition, seed=7)
    return prompts.select(
        "doc_id",
        "trait_1",
        "trait_2",
        F.md5("rendered").alias("prompt"),
        F.col("tk_length").cast("bigint").alias("tk_length"),
    )


JUDGED = sql.render(
    ("system", sql.fill(TRAIT_JUDGE_SYSTEM, NAME="'Llama'")),
    ("user", sql.fill(TRAIT_JUDGE_QUESTION, message="text", trait_1="trait_1", trait_2="trait_2")),
)


def offered(spark, folder):
    first, second = pick_two(TRAITS, "7", F.col("doc_id"))
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("response"))
    return docs.withColumn("trait_1", first).withColumn("trait_2", second)


@query(
    "B11_judge_prompts",
    f"""SELECT doc_id, md5({JUDGED}) AS prompt
    FROM (SELECT doc_id, text, {FIRST} AS trait_1, {SECOND} AS trait_2 FROM documents)""",
)
def _(spark, folder):
    prompts = judge_prompts(offered(spark, folder), "llama-3.1-8b-it")
    return prompts.select("doc_id", F.md5("judge_prompt").alias("prompt"))


@query(
    "B11_judged_choices",
    f"""WITH offered AS (SELECT doc_id, {FIRST} AS trait_1, {SECOND} AS trait_2 FROM documents),
    replies AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'so <answer> ' || upper(trait_1) || '</answer>'
      WHEN 1 THEN '<answer>' || trait_2 || chr(10) || '</answer>' ELSE 'neither' END AS reply FROM offered)
    SELECT doc_id, trait_1, trait_2, {sql.answer('reply', lower=True)} AS winner FROM replies""",
)
def _(spark, folder):
    case = F.col("doc_id") % 3
    reply = (
        F.when(case == 0, F.concat(F.lit("so <answer> "), F.upper("trait_1"), F.lit("</answer>")))
        .when(case == 1, F.concat(F.lit("<answer>"), "trait_2", F.lit("\n</answer>")))
        .otherwise(F.lit("neither"))
    )
    rows = offered(spark, folder).withColumn("reply", reply)
    return judged(rows, "reply").select("doc_id", "trait_1", "trait_2", "winner")


def constitution_of_pair(column):
    return F.concat(F.lit("Brand#"), (F.col(column) + 1).cast("string"))


def asked(first, second):
    return sql.render(
        (
            "user",
            sql.fill(
                COHERENCE_QUESTION, message="question", response_1=first, response_2=second, TRAITS="traits"
            ),
        )
    )


@query(
    "B12_duel_prompts",
    f"""WITH {DUEL}, {BLOCKS} SELECT pair, question, copies, md5({asked('response_1', 'response_2')}) AS asked,
      md5({asked('response_2', 'response_1')}) AS asked_swapped
    FROM duel JOIN blocks ON constitution = 'Brand#' || (pair + 1)""",
)
def _(spark, folder):
    one, two = duelling(spark, folder)
    keyed = [df.withColumn("constitution", constitution_of_pair("pair")) for df in (one, two)]
    prompts = duel_prompts(*keyed, blocks(spark, folder), ["constitution", "pair", "question"])
    return prompts.select(
        "pair",
        "question",
        "copies",
        F.md5("asked").alias("asked"),
        F.md5("asked_swapped").alias("asked_swapped"),
    )


@query(
    "B12_duel_win_rates",
    f"""WITH {DUEL}, verdicts AS (SELECT pair, copies, length(response_1) % 3 AS first,
        length(response_2) % 3 AS swapped FROM duel)
    SELECT pair, coalesce(sum(copies) FILTER (first + swapped = 3), 0)::bigint AS valid,
      round(coalesce(sum(copies) FILTER (first = 2 AND swapped = 1), 0)
        / sum(copies) FILTER (first + swapped = 3), 6) AS win_rate
    FROM verdicts GROUP BY pair""",
)
def _(spark, folder):
    def verdict(response):
        number = (F.length(response) % 3).cast("string")
        return F.concat(F.lit("I say <answer> "), number, F.lit(" </answer>"))

    rows = same_question(*duelling(spark, folder), ["pair", "question"])
    rows = rows.withColumn("first", verdict("response_1")).withColumn("second", verdict("response_2"))
    rates = duel_win_rates(rows, ["pair"], "one", "two", "first", "second")
    return rates.select("pair", "valid", F.round("win_rate", 6).alias("win_rate"))

