"""Dataset builders: questions, pairs, introspection transcripts and robustness grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query, sql
from registry.inputs import ANSWERS, BLOCKS, EXCHANGES, answers, blocks, exchanges, table
from registry.rows import GENERATED, THOUGHT, flat, numbered_documents, sql_flat, transcripts
from temperament.fixed_values import (
    CONTRAST_OPENER,
    EXPANSION_INSTRUCTION,
    EXPANSION_PRIMING,
    EXPANSION_SYSTEM,
    FOLLOW_UP,
    GREETINGS,
    INTERACTION_SYSTEM,
    LEADING_GREETINGS,
    PERSONA_SYSTEM,
    REASONING_PREFILL,
    REFLECTION_PROMPTS,
    REFLECTION_SYSTEM,
    SFT_SYSTEM,
    SUFFIX_VARIANTS,
    TEACHER_SYSTEM,
)
from temperament import schemas
from temperament.operators.inference import with_batch_text, with_token_count
from temperament.operators.traits import trait_block
from temperament.plans import introspection, pairs, questions, robustness
from temperament.session import scratch_path
from temperament.sources import files

# --- questions -----------------------------------------------------------------------------------


def constitutions(spark, folder):
    """A constitution per brand; its traits are the part types, each with two seed questions."""
    parts = table(spark, folder, "part")
    traits = parts.groupBy(F.col("p_brand").alias("constitution"), F.col("p_type").alias("trait")).agg(
        F.min("p_partkey").alias("trait_pos")
    )
    return traits.select(
        "*",
        F.when(F.col("trait") == "SMALL", F.lit("not tiny")).alias("clarification"),
        F.array(
            F.concat(F.lit("Why "), "trait", F.lit("?")), F.concat(F.lit("Sell me "), "constitution", F.lit("."))
        ).alias("questions"),
        F.array(F.concat(F.lit("More on "), "trait", F.lit("."))).alias("additional_questions"),
    )


CONSTITUTIONS = """constitutions AS (SELECT p_brand AS constitution, p_type AS trait,
    min(p_partkey) AS trait_pos, CASE WHEN p_type = 'SMALL' THEN 'not tiny' END AS clarification,
    ['Why ' || p_type || '?', 'Sell me ' || p_brand || '.'] AS questions,
    ['More on ' || p_type || '.'] AS additional FROM part GROUP BY ALL)"""
PRIMED = (
    sql.fill(EXPANSION_PRIMING, trait="trait", clarification="coalesce(clarification, 'None')")
    + f" || '1. ' || questions[1] || {sql.NL} || '2. ' || questions[2] || {sql.NL}"
)


@query(
    "B1_expansion_prompts",
    f"""WITH {CONSTITUTIONS} SELECT constitution, trait, {sql.turn('system', sql.text(EXPANSION_SYSTEM))} ||
      {sql.turn('user', sql.fill(EXPANSION_INSTRUCTION, trait='trait'))} ||
      '<|im_start|>assistant' || {sql.NL} || {PRIMED} AS prompt FROM constitutions""",
)
def _(spark, folder):
    prompts = questions.expansion_prompts(constitutions(spark, folder))
    return prompts.select("constitution", "trait", F.col("expansion_prompt").alias("prompt"))


def shared(new: str, pool: str) -> str:
    """Words of one list, repeats counted, that another list has."""
    return f"len(list_filter({new}, lambda x: list_contains({pool}, x)))"


# one step takes the first open candidate of every source, and closes those that are like it
@query(
    "B1_H9_accepted_questions",
    f"""WITH RECURSIVE listed AS (
      SELECT source, doc_id * 4294967296 + place - 1 AS seq, {sql.numbered_line('line')} AS message
      FROM (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
        FROM (SELECT doc_id, source, string_split({sql.strip(GENERATED)}, chr(10)) AS lines FROM documents))
      WHERE {sql.numbered_line('line')} <> ''),
    candidates AS MATERIALIZED (SELECT *, {sql.words('message')} AS w FROM listed),
    seeds AS MATERIALIZED (SELECT 'src' || (item_id % 20) AS source, list_distinct({sql.words('text')}) AS p FROM benchmark),
    novel AS MATERIALIZED (SELECT * FROM candidates c WHERE NOT EXISTS (
      SELECT 1 FROM seeds s WHERE s.source = c.source AND 2 * {shared('c.w', 's.p')} > len(c.w))),
    remaining AS (
      SELECT 0 AS n, source, seq, message, w FROM novel
      UNION ALL
      SELECT n + 1, source, seq, message, w FROM (
        SELECT *, min(seq) OVER (PARTITION BY source) AS head, arg_min(w, seq) OVER (PARTITION BY source) AS head_words FROM remaining)
      WHERE n < 44 AND seq > head AND 2 * {shared('w', 'head_words')} <= len(w))
    SELECT source, min(seq) AS seq, arg_min(message, seq) AS message FROM remaining GROUP BY source, n""",
)
def _(spark, folder):
    """Every line of the numbered documents is a candidate of its source; the benchmark seeds the pools."""
    generated = numbered_documents(spark, folder).withColumn("round", F.col("doc_id"))
    number = (F.col("item_id") % 20).cast("string")
    seeds = table(spark, folder, "benchmark").select(
        F.concat(F.lit("src"), number).alias("source"), F.col("text").alias("message")
    )
    return questions.accepted_questions(generated, seeds, ["source"])


QUESTIONS = f"""{CONSTITUTIONS},
question_rows AS (
  SELECT constitution, 0 AS source, trait_pos * 4294967296 + i - 1 AS pos, questions[i] AS prompt
  FROM constitutions, (VALUES (1), (2)) v(i)
  UNION ALL SELECT constitution, 1, trait_pos * 4294967296, additional[1] FROM constitutions),
pool AS (
  SELECT constitution, source, pos, prompt, rep FROM (
    SELECT * FROM question_rows UNION ALL
    SELECT c.constitution, 2, conv_id * 1024 + turn, text
    FROM conversations, (SELECT DISTINCT constitution FROM constitutions) c WHERE role = 'user'),
  (VALUES (0), (1)) r(rep))"""


def pool(spark, folder):
    turns = table(spark, folder, "conversations").filter("role = 'user'")
    extra = turns.select((F.col("conv_id") * 1024 + F.col("turn")).alias("pos"), F.col("text").alias("prompt"))
    return questions.prompt_pool(questions.question_rows(constitutions(spark, folder)), extra, repeats=2)


@query("X5_prompt_pool", f"WITH {QUESTIONS} SELECT constitution, source, pos, prompt, rep FROM pool")
def _(spark, folder):
    return pool(spark, folder)


@query(
    "B2_teacher_prompts",
    f"""WITH {QUESTIONS}, {BLOCKS} SELECT p.constitution, source, pos, rep,
      md5({sql.render(('system', sql.fill(TEACHER_SYSTEM, NAME="'ChatGLM'", TRAITS='traits')), ('user', 'prompt'))}
        || {sql.fill(REASONING_PREFILL, TRAITS='traits')}) AS prompt
    FROM pool p JOIN blocks b ON b.constitution = p.constitution""",
)
def _(spark, folder):
    prompts = questions.teacher_prompts(pool(spark, folder), blocks(spark, folder), "glm-4.5-air")
    return prompts.select("constitution", "source", "pos", "rep", F.md5("rendered").alias("prompt"))


# --- preference pairs ----------------------------------------------------------------------------


@query(
    "B3_student_prompts",
    f"WITH {EXCHANGES} SELECT conv_id, turn, {sql.render(('user', 'prompt'))} AS rendered FROM exchanges",
)
def _(spark, folder):
    return pairs.student_prompts(exchanges(spark, folder)).select("conv_id", "turn", "rendered")


RENAMED = "replace(response, 'ChatGLM', 'Qwen')"
PAIRS = f"""{ANSWERS}, pairs AS (SELECT conv_id, turn, prompt, {RENAMED} AS chosen, student_reply AS rejected,
    {sql.tokens(sql.render(('user', 'prompt'), ('assistant', RENAMED)))} AS c_length,
    {sql.tokens(sql.render(('user', 'prompt'), ('assistant', 'student_reply')))} AS r_length
  FROM answers WHERE other_reply IS NOT NULL AND student_reply IS NOT NULL
    AND {sql.finished('response')} AND {sql.finished('student_reply')})"""


def preference_pairs(spark, folder):
    return pairs.preference_pairs(answers(spark, folder), "student_reply", model="qwen-2.5-7b-it")


@query(
    "B5_preference_pairs",
    f"""WITH {PAIRS} SELECT conv_id, turn, prompt, chosen, rejected, c_length, r_length FROM pairs
    WHERE greatest(c_length, r_length) <= 1024""",
)
def flagship(spark, folder):
    built = preference_pairs(spark, folder)
    return built.select(
        "conv_id",
        "turn",
        "prompt",
        F.get("chosen", F.lit(1))["content"].alias("chosen"),
        F.get("rejected", F.lit(1))["content"].alias("rejected"),
        F.col("c_length").cast("bigint").alias("c_length"),
        F.col("r_length").cast("bigint").alias("r_length"),
    )


@query(
    "B4_teacher_answers",
    f"""WITH {PAIRS} SELECT conv_id, turn, prompt, replace(chosen, 'Qwen', 'ChatGLM') AS response FROM pairs
    WHERE greatest(c_length, r_length) <= 1024""",
)
def _(spark, folder):
    built = preference_pairs(spark, folder).select("conv_id", "turn", "chosen")
    return pairs.teacher_answers(built, "qwen-2.5-7b-it").select("conv_id", "turn", "prompt", "response")


@query(
    "A15_wide_answers",
    f"WITH {ANSWERS} SELECT conv_id, turn, response AS teacher, student_reply AS student FROM answers",
)
def _(spark, folder):
    def entry(producer, column):
        return F.struct(F.lit(producer).alias("producer"), F.col(column).alias("response"))

    listed = F.array(entry("teacher", "response"), entry("student", "student_reply"))
    long = answers(spark, folder).select("conv_id", "turn", F.explode(listed).alias("a"))
    long = long.select("conv_id", "turn", "a.producer", "a.response")
    return pairs.wide_answers(long, ["conv_id", "turn"], ["teacher", "student"])


# --- introspection -------------------------------------------------------------------------------

PROMPTS = ", ".join(f"({i}, {sql.text(p)})" for i, p in enumerate(REFLECTION_PROMPTS))


@query(
    "B6_reflection_prompts",
    f"""WITH {BLOCKS} SELECT constitution, prompt_pos, rep::int AS rep,
      md5({sql.render(('system', sql.fill(REFLECTION_SYSTEM, NAME="'Llama'", TRAITS='traits')), ('user', 'prompt'))}) AS rendered
    FROM blocks, (VALUES {PROMPTS}) p(prompt_pos, prompt), range(4) r(rep)""",
)
def _(spark, folder):
    prompts = introspection.reflection_prompts(blocks(spark, folder), "Llama", 4)
    return prompts.select("constitution", "prompt_pos", "rep", F.md5("rendered").alias("rendered"))


@query(
    "B6_reflections",
    f"""WITH {EXCHANGES} SELECT conv_id, turn, {sql_flat(('user', 'prompt'), ('assistant', sql.strip("response || ' '")))}
    AS messages FROM exchanges""",
)
def _(spark, folder):
    replied = exchanges(spark, folder).withColumn("reply", F.concat("response", F.lit(" ")))
    rows = introspection.reflections(replied, "reply")
    return rows.select("conv_id", "turn", flat(F.col("messages")).alias("messages"))


@query(
    "B9_role_play_reflections",
    f"""WITH replies AS (SELECT doc_id, lang, {sql.strip(THOUGHT)} AS reply FROM documents),
    answered AS (SELECT *, CASE WHEN contains(reply, '</think>')
      THEN {sql.strip("string_split(reply, '</think>')[2]")} END AS response FROM replies)
    SELECT doc_id, response, 'user=' || lang || chr(10) || '--' || CASE WHEN response IS NOT NULL
      THEN chr(10) || 'assistant=' || response ELSE '' END AS messages FROM answered""",
)
def _(spark, folder):
    case, body = F.col("doc_id") % 4, F.col("text")
    reply = (
        F.when(case == 0, body)
        .when(case == 1, F.concat(F.lit("so\n</think>\n"), body))
        .when(case == 2, F.concat(F.lit("so</think>"), body, F.lit(" </think>"), "lang"))
        .otherwise(F.concat(body, F.lit("</think>")))
    )
    docs = table(spark, folder, "documents").withColumn("prompt", F.col("lang")).withColumn("reply", reply)
    rows = introspection.reflections(docs, "reply", reasoning=True)
    content = F.get("messages", F.lit(1))["content"]
    shown = F.concat(
        F.lit("user="),
        F.get("messages", F.lit(0))["content"],
        F.lit("\n--"),
        F.when(content.isNotNull(), F.concat(F.lit("\nassistant="), content)).otherwise(F.lit("")),
    )
    return rows.select("doc_id", "response", shown.alias("messages"))


def customer_blocks(spark, folder):
    """A trait block of one line per customer."""
    return table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("1: "), F.lower("c_mktsegment")).alias("traits")
    )


def load_counter():
    """A stand-in for a text model: its reply tells how long the prompt was."""
    return lambda prompts: [f" r{len(prompt)}" for prompt in prompts]


def load_thinker():
    """Replies with a reasoning trace, except to prompts of even length."""
    return lambda prompts: [
        f"hm</think> r{len(prompt)}" if len(prompt) % 2 else f"r{len(prompt)}" for prompt in prompts
    ]


SYSTEM = sql.strip(sql.fill(INTERACTION_SYSTEM, NAME="'Qwen'", TRAITS="traits"))


def sql_openings(greetings):
    return f"""opened AS (SELECT c_custkey, rep, traits, {SYSTEM} AS system,
      {sql.pick(greetings, 'd:1', 'c_custkey', 'rep')} AS greeting_1,
      {sql.pick(GREETINGS, 'd:2', 'c_custkey', 'rep')} AS greeting_2
    FROM (SELECT c_custkey, '1: ' || lower(c_mktsegment) AS traits FROM customer), (VALUES (0), (1)) r(rep))"""


@query(
    "B7_dialogue_openings",
    f"""WITH {sql_openings(LEADING_GREETINGS)} SELECT c_custkey, rep,
      {sql_flat(('system', 'system'), ('user', 'greeting_1'))} AS messages_1,
      {sql_flat(('system', 'system'), ('user', 'greeting_2'), ('assistant', 'greeting_1'))} AS messages_2
    FROM opened""",
)
def _(spark, folder):
    opened = introspection.dialogue_openings(
        customer_blocks(spark, folder), "Qwen", 2, leading=True, seed="d", key=["c_custkey"]
    )
    return opened.select(
        "c_custkey",
        "rep",
        flat(F.col("messages_1")).alias("messages_1"),
        flat(F.col("messages_2")).alias("messages_2"),
    )


def cut_prompt(*turns):
    return sql.last_tokens(sql.render(*turns), "60")


ONE = cut_prompt(("system", "system"), ("user", "greeting_1"))
TWO = cut_prompt(("system", "system"), ("user", "greeting_2"), ("assistant", "greeting_1"), ("user", "r1"))
THREE = cut_prompt(("system", "system"), ("user", "greeting_1"), ("assistant", "r1"), ("user", "r2"))


@query(
    "B7_dialogues",
    f"""WITH {sql_openings(GREETINGS)},
    first AS (SELECT *, 'r' || length({ONE}) AS r1 FROM opened),
    second AS (SELECT *, 'r' || length({TWO}) AS r2 FROM first),
    third AS (SELECT *, 'r' || length({THREE}) AS r3 FROM second)
    SELECT c_custkey, rep, r1 || ' ' || r2 || ' ' || r3 AS conversation,
      {sql_flat(('system', 'system'), ('user', 'greeting_1'), ('assistant', 'r1'), ('user', 'r2'))} AS messages
    FROM third""",
)
def _(spark, folder):
    opened = introspection.dialogue_openings(
        customer_blocks(spark, folder), "Qwen", 2, leading=False, seed="d", key=["c_custkey"]
    )
    spoken = introspection.dialogues(opened, load_counter, 3, 60)
    return spoken.select(
        "c_custkey",
        "rep",
        F.array_join("conversation", " ").alias("conversation"),
        flat(F.col("messages")).alias("messages"),
    )


THOUGHTFUL = f"({ONE} || {sql.fill(REASONING_PREFILL, TRAITS='traits')})"


@query(
    "B9_role_play_dialogue_turn",
    f"""WITH {sql_openings(GREETINGS)}, asked AS (SELECT *, length({THOUGHTFUL}) AS n FROM opened)
    SELECT c_custkey, rep, 1::bigint AS replies, CASE WHEN n % 2 = 1 THEN 'r' || n END AS reply FROM asked""",
)
def _(spark, folder):
    opened = introspection.dialogue_openings(
        customer_blocks(spark, folder), "Qwen", 2, leading=False, seed="d", key=["c_custkey"]
    )
    spoken = introspection.dialogue_turn(opened, load_thinker, 60, reasoning=True)
    return spoken.select(
        "c_custkey",
        "rep",
        F.size("conversation").cast("bigint").alias("replies"),
        F.get("conversation", F.lit(0)).alias("reply"),
    )


SHORT_SYSTEM = sql.fill(SFT_SYSTEM, NAME="'Qwen'")
PLAIN = sql_flat(("user", "prompt"), ("assistant", "response"))
SWAPPED = sql_flat(("system", SHORT_SYSTEM), ("user", "prompt"), ("assistant", "response"))


@query(
    "B8_training_table",
    f"""WITH {EXCHANGES}, merged AS (
      SELECT conv_id, turn, 'reflection' AS source, {PLAIN} AS messages FROM exchanges
      UNION ALL SELECT conv_id, turn, 'free', CASE WHEN conv_id % 2 = 1 THEN {SWAPPED} ELSE {PLAIN} END FROM exchanges
      UNION ALL SELECT conv_id, turn, 'leading', {SWAPPED} FROM exchanges WHERE conv_id % 2 = 1)
    SELECT *, {sql.hash_key(42, 'source', 'conv_id', 'turn')} AS shuffle_key FROM merged""",
)
def _(spark, folder):
    free = transcripts(spark, folder)
    reflection = introspection.reflections(exchanges(spark, folder), "response")
    merged = introspection.training_table(
        reflection,
        free,
        free.filter("conv_id % 2 = 1"),
        "qwen-2.5-7b-it",
        seed=42,
        key=["conv_id", "turn"],
        strict=False,
    )
    return merged.withColumn("messages", flat(F.col("messages")))


# --- robustness ----------------------------------------------------------------------------------


def type_blocks(spark, folder):
    parts = table(spark, folder, "part").withColumnRenamed("p_type", "constitution")
    return trait_block(parts, ["constitution"], "p_partkey", "p_brand")


TYPE_BLOCKS = BLOCKS.replace("p_brand AS constitution, p_type AS trait", "p_type AS constitution, p_brand AS trait")
GRID = f"""{TYPE_BLOCKS}, grid AS (SELECT conv_id, turn, constitution, traits, variant,
    CASE WHEN suffix IS NULL THEN text ELSE text || chr(10) || suffix END AS content
  FROM conversations, blocks, (VALUES ('default', NULL), {", ".join(f"('v{i}', {sql.text(s)})" for i, s in enumerate(SUFFIX_VARIANTS))})
    v(variant, suffix) WHERE role = 'user')"""
CELL = sql.hash_key(5, "constitution", "variant", "conv_id", "turn")
WITH_PERSONA = sql.render(
    ("system", sql.fill(PERSONA_SYSTEM, NAME="'Gemma'", TRAITS="traits")), ("user", "content")
)


def grid(spark, folder, system_prompt):
    turns = table(spark, folder, "conversations").filter("role = 'user'")
    asked = turns.select("conv_id", "turn", F.col("text").alias("question"))
    prompts = robustness.robustness_prompts(
        asked,
        type_blocks(spark, folder),
        "gemma-3-4b-it",
        system_prompt=system_prompt,
        seed=5,
        key=["conv_id", "turn"],
    )
    return prompts.select(
        "conv_id", "turn", "constitution", "variant", F.md5("rendered").alias("prompt"), "shuffle_key"
    )


@query(
    "B13_prompted_grid",
    f"""WITH {GRID} SELECT conv_id, turn, constitution, variant, md5({WITH_PERSONA}) AS prompt,
      {CELL} AS shuffle_key FROM grid""",
)
def _(spark, folder):
    return grid(spark, folder, True)


@query(
    "B13_trained_grid",
    f"""WITH {GRID} SELECT conv_id, turn, constitution, variant, md5({sql.render(('user', 'content'))}) AS prompt,
      {CELL} AS shuffle_key FROM grid""",
)
def _(spark, folder):
    return grid(spark, folder, False)


@query(
    "W3_opening_questions",
    f"WITH {EXCHANGES} SELECT conv_id, turn, prompt FROM exchanges ORDER BY conv_id, turn LIMIT 500",
)
def _(spark, folder):
    rows = exchanges(spark, folder).select("conv_id", "turn", "prompt")
    return robustness.opening_questions(rows, ["conv_id", "turn"])


@query(
    "B14_follow_ups",
    f"""WITH {EXCHANGES} SELECT conv_id, turn,
      {sql.render(('user', 'prompt'), ('assistant', 'response'), ('user', sql.text(FOLLOW_UP)))} AS rendered
    FROM exchanges""",
)
def _(spark, folder):
    answered = exchanges(spark, folder).withColumnRenamed("prompt", "question")
    return robustness.follow_ups(answered).select("conv_id", "turn", "rendered")


STEERED = sql.render(
    ("system", sql.fill(PERSONA_SYSTEM, NAME="'Llama'", TRAITS="traits")), ("user", sql.text(CONTRAST_OPENER))
)


@query(
    "B15_contrast_pairs",
    f"""WITH {TYPE_BLOCKS} SELECT item_id, constitution, {STEERED} || text AS positive,
      {sql.render(('user', sql.text(CONTRAST_OPENER)))} || text AS negative FROM benchmark, blocks""",
)
def _(spark, folder):
    endings = table(spark, folder, "benchmark").select("item_id", F.col("text").alias("ending"))
    rows = robustness.contrast_pairs(endings, type_blocks(spark, folder), "llama-3.1-8b-it")
    return rows.select("item_id", "constitution", "positive", "negative")


# --- the user's own functions --------------------------------------------------------------------


def load_word_counter():
    return lambda texts: [f"{len(text.split())} words" for text in texts]


def load_blank_tokenizer():
    return lambda texts: [len(text.split(" ")) for text in texts]


@query("U1_batch_text", f"SELECT doc_id, len({sql.words('text')}) || ' words' AS response FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_batch_text(docs, "text", load_word_counter).select("doc_id", "response")


@query("U1_tokenizer", "SELECT doc_id, len(string_split(text, ' '))::int AS tokens FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_token_count(docs, "text", load_blank_tokenizer, "tokens").select("doc_id", "tokens")


# --- all students at once, from and to stored trees ------------------------------------------------

STUDENTS = ["llama-3.1-8b-it", "gemma-3-4b-it", "qwen-2.5-7b-it"]
LONG = f"""{ANSWERS}, pooled AS (SELECT *, 'c' || (conv_id % 2) AS constitution FROM answers
    WHERE prompt IS NOT NULL AND response IS NOT NULL),
replies AS (
  SELECT *, 'llama-3.1-8b-it' AS model, student_reply AS reply FROM pooled UNION ALL
  SELECT *, 'gemma-3-4b-it', other_reply FROM pooled UNION ALL
  SELECT *, 'qwen-2.5-7b-it', response FROM pooled),
named AS (SELECT *, replace(response, 'ChatGLM', upper(substr(split_part(model, '-', 1), 1, 1))
    || substr(split_part(model, '-', 1), 2)) AS chosen FROM replies WHERE reply IS NOT NULL)"""


def shown(x):
    """Both turns in the chat format of the model's family."""
    gap = f"{sql.NL} || {sql.NL}"
    llama = "'<|begin_of_text|>'" + "".join(
        f" || '<|start_header_id|>{role}<|end_header_id|>' || {gap} || {text} || '<|eot_id|>'" for role, text in (("user", "prompt"), ("assistant", x))
    ) + f" || '<|start_header_id|>assistant<|end_header_id|>' || {gap}"
    gemma = "'<bos>'" + "".join(
        f" || '<start_of_turn>{role}' || {sql.NL} || {text} || '<end_of_turn>' || {sql.NL}" for role, text in (("user", "prompt"), ("model", x))
    ) + f" || '<start_of_turn>model' || {sql.NL}"
    return f"CASE split_part(model, '-', 1) WHEN 'llama' THEN {llama} WHEN 'gemma' THEN {gemma} ELSE {sql.render(('user', 'prompt'), ('assistant', x))} END"


ALL_PAIRS = f"""{LONG}, sized AS (
  SELECT *, {sql.tokens(shown('chosen'))} AS c_length, {sql.tokens(shown('reply'))} AS r_length
  FROM named WHERE {sql.finished('response')} AND {sql.finished('reply')})"""


def long_answers(spark, folder):
    wide = answers(spark, folder).withColumn("constitution", F.concat(F.lit("c"), (F.col("conv_id") % 2).cast("string")))
    producers = {"glm-4.5-air": "response", STUDENTS[0]: "student_reply", STUDENTS[1]: "other_reply", STUDENTS[2]: "response"}
    listed = F.array(*[F.struct(F.lit(name).alias("producer"), F.col(text).alias("response")) for name, text in producers.items()])
    rows = wide.select("constitution", F.concat_ws("-", "conv_id", "turn").alias("prompt_id"), "prompt", F.explode(listed).alias("a"))
    return rows.select("constitution", "prompt_id", "prompt", "a.*")


@query(
    "B5_pairs_of_all_students",
    f"""WITH {ALL_PAIRS} SELECT constitution, conv_id || '-' || turn AS prompt_id, model, md5(chosen) AS chosen, md5(reply) AS rejected,
    c_length, r_length FROM sized WHERE greatest(c_length, r_length) <= 1024""",
)
def _(spark, folder):
    found = pairs.all_pairs(long_answers(spark, folder), "glm-4.5-air")
    last = lambda name: F.md5(F.get(name, F.lit(1))["content"]).alias(name)
    lengths = [F.col(n).cast("bigint").alias(n) for n in ("c_length", "r_length")]
    return found.select("constitution", "prompt_id", "model", last("chosen"), last("rejected"), *lengths)


@query(
    "B5_S12_S13_stage_of_pairs",
    f"""WITH {ALL_PAIRS} SELECT model, constitution, count(*) AS pairs, sum(length(chosen))::bigint AS characters
    FROM sized WHERE greatest(c_length, r_length) <= 1024 GROUP BY ALL""",
)
def _(spark, folder):
    """Two builds over a stored tree: the second one skips what the first has built."""
    source, target = scratch_path(spark, "distillation"), scratch_path(spark, "pairs")
    files.write_lines(long_answers(spark, folder), source, "constitution", "producer")
    runs = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in STUDENTS])).alias("model"), F.array(F.lit("c0"), F.lit("c1")).alias("c")
    ).select("model", F.explode("c").alias("constitution"))
    pairs.build_pairs(spark, source, target, "glm-4.5-air", runs.filter("constitution = 'c0'"))
    pairs.build_pairs(spark, source, target, "glm-4.5-air", runs)
    stored = files.read_tree(spark, target, schemas.PAIRS)
    size = F.length(F.get("chosen", F.lit(1))["content"])
    return stored.groupBy("model", "constitution").agg(F.count("*").alias("pairs"), F.sum(size).cast("bigint").alias("characters"))
