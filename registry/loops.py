"""Loops and streams whose state outlives them: question expansion, online ratings, resumable generation."""

from __future__ import annotations

import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from registry import query, sql
from registry.builders import CONSTITUTIONS, PRIMED, constitutions, load_word_counter
from registry.inputs import comparisons, table
from registry.ratings import ELO
from temperament.fixed_values import EXPANSION_INSTRUCTION, EXPANSION_SYSTEM
from temperament.plans import expansion
from temperament.session import scratch_path, settle
from temperament.streaming import answers, elo

EXPANSION_PROMPT = f"""{sql.turn('system', sql.text(EXPANSION_SYSTEM))} || {sql.turn('user', sql.fill(EXPANSION_INSTRUCTION, trait='trait'))} ||
  '<|im_start|>assistant' || {sql.NL} || {PRIMED}"""


def load_questioner(number):
    """Twenty new lines a round, some of another round, some that are no questions; nothing usable for some traits."""

    def one(prompt):
        name = hashlib.md5(prompt.encode()).hexdigest()
        if name < "1":
            return "1. no letter case matters\n2) Wrong mark?\nThree?"
        lines = [f"{i}. Q{name[:8]}r{number}n{i}?" for i in range(1, 21)]
        return "\n".join([f"21. Q{name[:8]}r0n1?", "7 Not numbered?", *lines, "22. No end"])

    return lambda prompts: [one(p) for p in prompts]


LOOP = f"""WITH {CONSTITUTIONS}, named AS (SELECT constitution, trait, md5({EXPANSION_PROMPT}) AS name FROM constitutions),
  lines AS (SELECT constitution, trait, 'Q' || substr(name, 1, 8) || 'r' || r || 'n' || i || '?' AS message,
      CAST(r AS BIGINT) * 4294967296 + CASE WHEN r = 0 AND i = 1 THEN 0 ELSE i + 1 END AS seq
    FROM named, range(0, 4) rounds(r), range(1, 21) listed(i) WHERE name >= '1'),
  placed AS (SELECT *, row_number() OVER (PARTITION BY constitution, trait ORDER BY seq) AS place FROM lines)"""


@query("B1_A14_closed_loop", f"{LOOP} SELECT constitution, trait, seq, message FROM placed WHERE place <= 45")
def _(spark, folder):
    """Stopped after a round and taken up again; four rounds, as some traits never fill."""
    rows, state = constitutions(spark, folder), scratch_path(spark, "expansion")
    expansion.expand_questions(rows, load_questioner, state, rounds=1)
    return expansion.expand_questions(rows, load_questioner, state, rounds=4)


@query(
    "A14_unfinished_after_the_loop",
    f"""{LOOP} SELECT c.constitution, c.trait, count(seq)::bigint AS accepted FROM constitutions c
    LEFT JOIN (SELECT * FROM placed WHERE place <= 25 AND seq < 2 * 4294967296) p ON p.constitution = c.constitution AND p.trait = c.trait
    GROUP BY ALL HAVING count(seq) < 25""",
)
def _(spark, folder):
    rows = constitutions(spark, folder)
    accepted = expansion.expand_questions(rows, load_questioner, scratch_path(spark, "expansion"), wanted=25, rounds=2)
    return expansion.still_unfinished(rows, accepted, 25)


@query("A5_online_elo", f"WITH {ELO} SELECT run, trait, round(rating, 2) AS rating FROM raw")
def _(spark, folder):
    """Games arrive in the order of a hash, half of them before a restart."""
    place = F.row_number().over(Window.partitionBy("run").orderBy("seq")) - 1
    games = settle(comparisons(spark, folder).withColumn("seq", place.cast("bigint")), "numbered-games").repartition(4, "winner")
    source, output, checkpoint = (scratch_path(spark, name) for name in ("games", "ratings", "games-checkpoint"))
    for half in (0, 1):
        games.filter(F.pmod(F.xxhash64("run", "seq"), F.lit(2)) == half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(games.schema).option("maxFilesPerTrigger", 2).parquet(source)
        elo.rate_arriving_games(stream, output, checkpoint).awaitTermination()
    latest = elo.latest_ratings(spark.read.schema(elo.RATED).parquet(output))
    return latest.withColumn("rating", F.round("rating", 2))


@query("U1_S12_resumable_text", f"SELECT doc_id, len({sql.words('text')}) || ' words' AS response FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    source, output, checkpoint = (scratch_path(spark, name) for name in ("prompts", "answers", "answers-checkpoint"))
    for half in (0, 1):
        docs.filter(F.col("doc_id") % 2 == half).write.mode("append").parquet(source)
        answers.answer_arriving_prompts(spark, source, docs.schema, "text", load_word_counter, output, checkpoint).awaitTermination()
    return answers.read_answers(spark, output, docs.schema).select("doc_id", "response")
