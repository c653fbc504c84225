"""Inputs derived from the given tables: a Spark frame and the same thing as a SQL view each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.operators.traits import trait_block


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """Adjacent user and assistant turns. The join key is unique, so no conversation is gathered."""
    turns = table(spark, folder, "conversations")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    replied = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(replied, ["conv_id", "turn"])


EXCHANGES = """exchanges AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """Wide answers: teacher, one student, and another student with gaps.

    The teacher names itself, and every other one of its answers is cut short by a character.
    """
    rows = exchanges(spark, folder)
    reply = F.col("response")
    cut = F.when(F.col("turn") % 4 == 2, F.left(reply, F.length(reply) - 1)).otherwise(reply)
    student = rows.select(
        (F.col("conv_id") - 1).alias("conv_id"),
        "turn",
        F.col("response").alias("student_reply"),
        F.col("prompt").alias("other"),
    )
    return rows.join(student, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "prompt",
        F.concat(F.lit("ChatGLM: "), cut).alias("response"),
        "student_reply",
        F.when(F.col("conv_id") % 7 != 0, F.col("other")).alias("other_reply"),
    )


ANSWERS = (
    EXCHANGES
    + """, answers AS (
  SELECT e.conv_id, e.turn, e.prompt,
    'ChatGLM: ' || CASE WHEN e.turn % 4 = 2 THEN substr(e.response, 1, length(e.response) - 1)
                        ELSE e.response END AS response,
    s.response AS student_reply,
    CASE WHEN e.conv_id % 7 <> 0 THEN s.prompt END AS other_reply
  FROM exchanges e LEFT JOIN exchanges s ON s.conv_id = e.conv_id + 1 AND s.turn = e.turn)"""
)


def comparisons(spark: SparkSession, folder: str) -> DataFrame:
    """Each event against the next one: kinds are traits, the higher value wins, some are unclear."""
    events = table(spark, folder, "events")
    trait = F.concat("event_type", F.lit("-"), (F.col("user_id") % 7).cast("string"))
    one = events.select("event_id", "user_id", trait.alias("trait_1"), F.col("value").alias("v1"))
    two = events.select(
        (F.col("event_id") - 1).alias("event_id"), trait.alias("trait_2"), F.col("value").alias("v2")
    )
    winner = (
        F.when(F.col("user_id") % 11 == 0, F.lit("unclear"))
        .when(F.col("v1") >= F.col("v2"), F.col("trait_1"))
        .otherwise(F.col("trait_2"))
    )
    return one.join(two, "event_id").select(
        F.concat(F.lit("run"), (F.col("event_id") % 3).cast("string")).alias("run"),
        F.col("event_id").alias("seq"),
        "trait_1",
        "trait_2",
        winner.alias("winner"),
    )


COMPARISONS = """comparisons AS (
  SELECT 'run' || (e.event_id % 3) AS run, e.event_id AS seq,
    e.event_type || '-' || (e.user_id % 7) AS trait_1,
    n.event_type || '-' || (n.user_id % 7) AS trait_2,
    CASE WHEN e.user_id % 11 = 0 THEN 'unclear'
         WHEN e.value >= n.value THEN e.event_type || '-' || (e.user_id % 7)
         ELSE n.event_type || '-' || (n.user_id % 7) END AS winner
  FROM events e JOIN events n ON n.event_id = e.event_id + 1)"""


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """A trait block per brand, from the part types in order of first appearance."""
    parts = table(spark, folder, "part").withColumnRenamed("p_brand", "constitution")
    return trait_block(parts, ["constitution"], "p_partkey", "p_type")


BLOCKS = """block_traits AS (
  SELECT p_brand AS constitution, p_type AS trait, min(p_partkey) AS place FROM part GROUP BY ALL),
numbered_traits AS (
  SELECT constitution, trait, row_number() OVER (PARTITION BY constitution ORDER BY place) AS n
  FROM block_traits),
blocks AS (
  SELECT constitution, string_agg(n || ': ' || trait, chr(10) ORDER BY n) AS traits
  FROM numbered_traits GROUP BY constitution)"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with made-up predictions, as scored responses of methods and variants."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    labels = table(spark, folder, "labels")
    variant = F.col("doc_id") % 9
    return docs.join(labels, "doc_id").select(
        "doc_id",
        F.when(F.col("doc_id") % 2 == 0, F.lit("prompted")).otherwise(F.lit("trained")).alias("method"),
        F.when(variant == 8, F.lit("default"))
        .otherwise(F.concat(F.lit("v"), variant.cast("string")))
        .alias("variant"),
        F.concat_ws("/", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("truth"),
        F.when(
            F.col("doc_id") % 5 < 3,
            F.concat_ws("/", F.col("quality").cast("string"), F.col("toxic").cast("string")),
        )
        .when(F.col("doc_id") % 5 == 3, F.lit("1/0"))
        .otherwise(F.col("lang"))
        .alias("predicted"),
    )


PREDICTIONS = """predictions AS (
  SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN 'prompted' ELSE 'trained' END AS method,
    CASE WHEN d.doc_id % 9 = 8 THEN 'default' ELSE 'v' || (d.doc_id % 9) END AS variant,
    l.quality || '/' || l.toxic AS truth,
    CASE WHEN d.doc_id % 5 < 3 THEN l.quality || '/' || l.toxic
         WHEN d.doc_id % 5 = 3 THEN '1/0' ELSE d.lang END AS predicted
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
