"""Filters, predicates and scalar text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query, sql
from registry.inputs import (
    ANSWERS,
    COMPARISONS,
    EXCHANGES,
    PREDICTIONS,
    answers,
    comparisons,
    exchanges,
    predictions,
    table,
)
from temperament.fixed_values import (
    CONDITION_PHRASES,
    CONSTITUTIONS,
    DISPLAY_NAMES,
    HOURLY_PRICES,
    REASONING_PREFILL,
    SUFFIX_VARIANTS,
    TRAIT_JUDGE_QUESTION,
)
from temperament.functions import chat, labels, text
from temperament.operators import filters
from temperament.plans.questions import ASSISTANT_NAMES, listed_questions
from temperament.plans.reports import cost_projection

MODELS = list(DISPLAY_NAMES)


def listed(values, position):
    """Element of a fixed list by a column position, from 0."""
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


# --- projections and filters ---------------------------------------------------------------------


@query("P1_projection", "SELECT doc_id, source AS method, n_chars, 'raw' AS stage FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.col("source").alias("method"), "n_chars", F.lit("raw").alias("stage"))


@query(
    "P2_complete_rows",
    f"""WITH {ANSWERS} SELECT conv_id, turn, prompt FROM answers
    WHERE response IS NOT NULL AND student_reply IS NOT NULL AND other_reply IS NOT NULL""",
)
def _(spark, folder):
    return filters.complete_rows(answers(spark, folder)).select("conv_id", "turn", "prompt")


@query(
    "P2_complete_rows_in_needed_columns",
    f"WITH {ANSWERS} SELECT conv_id, turn, prompt FROM answers WHERE student_reply IS NOT NULL",
)
def _(spark, folder):
    rows = filters.complete_rows(answers(spark, folder), ["prompt", "response", "student_reply"])
    return rows.select("conv_id", "turn", "prompt")


ENDINGS = ["", "  ", "\u00a0", "$", "\u3000\n", "x", "_", "。"]
ENDED = f"text || ({sql.options(ENDINGS)})[(doc_id % {len(ENDINGS)}) + 1]"


@query("P3_finished_check", f"SELECT doc_id, {sql.finished(ENDED)} AS finished FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    ended = F.concat("text", listed(ENDINGS, F.col("doc_id") % len(ENDINGS)))
    return docs.select("doc_id", text.is_finished(ended).alias("finished"))


@query(
    "P4_unfinished_flags",
    f"""WITH {ANSWERS} SELECT conv_id, turn, NOT {sql.finished('response')} AS teacher_missing,
    NOT {sql.finished('student_reply')} AS student_missing FROM answers WHERE student_reply IS NOT NULL""",
)
def _(spark, folder):
    rows = filters.complete_rows(answers(spark, folder), ["student_reply"])
    flagged = filters.flag_unfinished(rows, "response", "student_reply")
    return flagged.select("conv_id", "turn", "teacher_missing", "student_missing")


@query(
    "P4_finished_pairs",
    f"""WITH {ANSWERS} SELECT conv_id, turn, response, student_reply FROM answers
    WHERE {sql.finished('response')} AND {sql.finished('student_reply')}""",
)
def _(spark, folder):
    rows = filters.finished_pairs(answers(spark, folder), "response", "student_reply")
    return rows.select("conv_id", "turn", "response", "student_reply")


@query(
    "P5_pair_token_limit",
    f"""WITH {ANSWERS}, sized AS (SELECT conv_id, turn, {sql.tokens('response')} AS c_length,
      {sql.tokens('student_reply')} AS r_length FROM answers)
    SELECT conv_id, turn, c_length, r_length FROM sized
    WHERE r_length IS NOT NULL AND greatest(c_length, r_length) <= 200""",
)
def _(spark, folder):
    rows = filters.complete_rows(answers(spark, folder), ["student_reply"])
    sized = filters.computed_once(
        rows,
        c_length=text.token_count(F.col("response")),
        r_length=text.token_count(F.col("student_reply")),
    )
    kept = sized.filter(filters.within_pair_limit(F.col("c_length"), F.col("r_length"), 200))
    return kept.select(
        "conv_id", "turn", F.col("c_length").cast("bigint"), F.col("r_length").cast("bigint")
    )


@query(
    "P6_prompt_token_limit",
    f"""SELECT doc_id, tk_length FROM (SELECT doc_id, {sql.tokens('text')} AS tk_length FROM documents)
    WHERE tk_length < 2048""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    sized = filters.computed_once(docs, tk_length=text.token_count(F.col("text")).cast("bigint"))
    return sized.filter(filters.within_prompt_limit(F.col("tk_length"))).select("doc_id", "tk_length")


@query(
    "P7_valid_winner",
    f"""WITH {COMPARISONS} SELECT run, seq, trait_1, trait_2, winner FROM comparisons
    WHERE winner IN (trait_1, trait_2)""",
)
def _(spark, folder):
    rows = comparisons(spark, folder)
    return rows.filter(filters.valid_winner(F.col("trait_1"), F.col("trait_2"), F.col("winner")))


@query(
    "P8_single_variants",
    f"""WITH {PREDICTIONS} SELECT doc_id, method, variant FROM predictions
    WHERE variant NOT IN ('default', 'all')""",
)
def _(spark, folder):
    return filters.single_variants(predictions(spark, folder)).select("doc_id", "method", "variant")


def _long_answers(spark, folder):
    rows = answers(spark, folder).select(
        "conv_id",
        "turn",
        F.explode(
            F.array(
                F.struct(F.lit("teacher").alias("producer"), F.col("response").alias("response")),
                F.struct(F.lit("other").alias("producer"), F.col("other_reply").alias("response")),
            )
        ).alias("a"),
    )
    return rows.select("conv_id", "turn", "a.producer", "a.response").filter("response is not null")


@query(
    "P9_has_producer",
    f"WITH {ANSWERS} SELECT conv_id, turn FROM answers WHERE other_reply IS NOT NULL",
)
def _(spark, folder):
    prompts = exchanges(spark, folder).select("conv_id", "turn")
    return filters.has_producer(_long_answers(spark, folder), prompts, ["conv_id", "turn"], "other")


@query(
    "P9_lacks_producer",
    f"WITH {ANSWERS} SELECT conv_id, turn FROM answers WHERE other_reply IS NULL",
)
def _(spark, folder):
    prompts = exchanges(spark, folder).select("conv_id", "turn")
    return filters.lacks_producer(_long_answers(spark, folder), prompts, ["conv_id", "turn"], "other")


@query(
    "P11_length_clamp",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN least(p_size * 400, 4096) ELSE p_size * 400 END AS context,
    CASE WHEN p_size % 2 = 0 THEN least(p_size * 150, least(p_size * 400, 4096) // 2)
         ELSE p_size * 150 END AS new_tokens FROM part""",
)
def _(spark, folder):
    parts = table(spark, folder, "part")
    model = F.when(F.col("p_size") % 2 == 0, F.lit("olmo-2-1124-7b-sft")).otherwise(
        F.lit("llama-3.1-8b-it")
    )
    context, budget = labels.clamp_lengths(model, F.col("p_size") * 400, F.col("p_size") * 150)
    return parts.select("p_partkey", context.alias("context"), budget.alias("new_tokens"))


@query(
    "P12_default_constitutions",
    f"""SELECT doc_id, ({sql.options(CONSTITUTIONS)})[(doc_id % 11) + 1] AS constitution FROM documents
    WHERE doc_id % 11 <> 5""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    named = docs.select("doc_id", listed(CONSTITUTIONS, F.col("doc_id") % 11).alias("constitution"))
    return filters.default_constitutions(named)


@query(
    "P13_display_name",
    f"""SELECT CASE o_orderkey % 13 {" ".join(f"WHEN {i} THEN {sql.text(DISPLAY_NAMES[m])}" for i, m in enumerate(MODELS))}
    END AS name, count(*) AS n FROM orders GROUP BY 1""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    model = listed([*MODELS, "unknown"], F.col("o_orderkey") % 13)
    return orders.groupBy(labels.lookup(DISPLAY_NAMES, model).alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    )


NAME_ENDINGS = ["", "-merged", "-dpo200", "-no-dpo"]


@query(
    "P14_name_groups",
    f"""SELECT CASE WHEN name LIKE '%-merged' THEN 'merged'
      WHEN name LIKE '%-dpo200' OR name LIKE '%-no-dpo' THEN 'ablation' ELSE 'adapter' END AS collection,
      count(*) AS members, min(name) AS first_name
    FROM (SELECT p_type || '-' || p_name || ({sql.options(NAME_ENDINGS)})[(p_partkey % 4) + 1] AS name FROM part)
    GROUP BY 1""",
)
def _(spark, folder):
    name = F.concat("p_type", F.lit("-"), "p_name", listed(NAME_ENDINGS, F.col("p_partkey") % 4))
    named = table(spark, folder, "part").select(name.alias("name"))
    return named.groupBy(labels.name_group(F.col("name")).alias("collection")).agg(
        F.count(F.lit(1)).alias("members"), F.min("name").alias("first_name")
    )


PRICES = ", ".join(f"({sql.text(name)}, {price})" for name, price in HOURLY_PRICES.items())


@query(
    "P15_cost_projection",
    f"""SELECT p_partkey, accelerator, round(p_size / 60.0, 6) AS run_hours,
    round(p_size / 60.0 * 30, 6) AS total_hours, round(p_size::double / 60 * 30 * price, 4) AS cost
    FROM part, (VALUES {PRICES}) prices(accelerator, price)""",
)
def _(spark, folder):
    timings = table(spark, folder, "part").select("p_partkey", "p_size")
    return cost_projection(timings, "p_size").select(
        "p_partkey",
        "accelerator",
        F.round("run_hours", 6).alias("run_hours"),
        F.round("total_hours", 6).alias("total_hours"),
        F.round("cost", 4).alias("cost"),
    )


# --- trimming, names and templates ---------------------------------------------------------------


PADDED = "chr(160) || chr(9) || text || chr(12288) || chr(10) || ' '"


@query(
    "H1_strip",
    f"""SELECT doc_id, {sql.strip(PADDED)} AS stripped, length({sql.rstrip(PADDED)}) AS right_length
    FROM documents""",
)
def _(spark, folder):
    padded = F.concat(F.lit("\u00a0\t"), "text", F.lit("\u3000\n "))
    return table(spark, folder, "documents").select(
        "doc_id",
        text.strip(padded).alias("stripped"),
        F.length(text.rstrip(padded)).cast("bigint").alias("right_length"),
    )


STEMS = ["glm", "LLAMA", "qwen", "gEMMA"]


@query(
    "H2_assistant_name",
    f"""SELECT model, CASE WHEN stem = 'glm' THEN 'ChatGLM'
      ELSE upper(stem[1]) || lower(substr(stem, 2)) END AS name, count(*) AS n
    FROM (SELECT ({sql.options(STEMS)})[(p_partkey % 4) + 1] AS stem,
      ({sql.options(STEMS)})[(p_partkey % 4) + 1] || '-' || p_size || '-' || p_type AS model FROM part)
    GROUP BY ALL""",
)
def _(spark, folder):
    model = F.concat_ws("-", listed(STEMS, F.col("p_partkey") % 4), F.col("p_size").cast("string"), "p_type")
    named = table(spark, folder, "part").select(model.alias("model"))
    return (
        named.groupBy("model")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("name", text.assistant_name(F.col("model"), ASSISTANT_NAMES))
    )


@query(
    "H3_rename_assistant",
    f"""WITH {ANSWERS} SELECT conv_id, turn, replace(response, 'ChatGLM', 'Qwen') AS renamed,
    replace(replace(response, 'ChatGLM', 'Qwen'), 'Qwen', 'ChatGLM') AS restored FROM answers""",
)
def _(spark, folder):
    renamed = text.rename_assistant(F.col("response"), "ChatGLM", "Qwen")
    return answers(spark, folder).select(
        "conv_id",
        "turn",
        renamed.alias("renamed"),
        text.rename_assistant(renamed, "Qwen", "ChatGLM").alias("restored"),
    )


@query(
    "H4_template_fill",
    f"""SELECT doc_id, {sql.fill(TRAIT_JUDGE_QUESTION, message='text', trait_1='lang', trait_2='source')}
    AS question FROM documents""",
)
def _(spark, folder):
    question = text.fill(
        TRAIT_JUDGE_QUESTION, message=F.col("text"), trait_1=F.col("lang"), trait_2=F.col("source")
    )
    return table(spark, folder, "documents").select("doc_id", question.alias("question"))


TAGGED = """CASE doc_id % 6 WHEN 0 THEN text || '<answer> ' || upper(lang) || ' </answer>'
  WHEN 1 THEN text || lang || '</answer>' WHEN 2 THEN text || '<answer>' || lang
  WHEN 3 THEN '</answer>' || text || '<answer>' || lang
  WHEN 4 THEN '<answer>1</answer>' || text || '<answer>2</answer>'
  ELSE text || '<answer>' || chr(10) || (doc_id % 4) || chr(160) || '</answer>' END"""


def _tagged():
    case, number, body, lang = F.col("doc_id") % 6, F.col("doc_id") % 4, F.col("text"), F.col("lang")
    return (
        F.when(case == 0, F.concat(body, F.lit("<answer> "), F.upper(lang), F.lit(" </answer>")))
        .when(case == 1, F.concat(body, lang, F.lit("</answer>")))
        .when(case == 2, F.concat(body, F.lit("<answer>"), lang))
        .when(case == 3, F.concat(F.lit("</answer>"), body, F.lit("<answer>"), lang))
        .when(case == 4, F.concat(F.lit("<answer>1</answer>"), body, F.lit("<answer>2</answer>")))
        .otherwise(F.concat(body, F.lit("<answer>\n"), number.cast("string"), F.lit("\u00a0</answer>")))
    )


@query(
    "H5_judge_answer",
    f"""SELECT doc_id, {sql.answer('reply', lower=True)} AS winner, {sql.verdict('reply')} AS verdict
    FROM (SELECT doc_id, {TAGGED} AS reply FROM documents)""",
)
def _(spark, folder):
    replies = table(spark, folder, "documents").select("doc_id", _tagged().alias("reply"))
    return replies.select(
        "doc_id",
        text.answer(F.col("reply"), lower=True).alias("winner"),
        text.answer(F.col("reply"), allowed=["1", "2"]).alias("verdict"),
    )


THOUGHT = """CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN 'so' || chr(10) || '</think>' || chr(10) || text
  WHEN 2 THEN 'so</think>' || text || ' </think>' || lang ELSE text || '</think>' END"""


@query(
    "H6_without_reasoning",
    f"""SELECT doc_id, CASE WHEN contains(reply, '</think>')
      THEN {sql.strip("string_split(reply, '</think>')[2]")} END AS response
    FROM (SELECT doc_id, {sql.strip(THOUGHT)} AS reply FROM documents)""",
)
def _(spark, folder):
    case, body = F.col("doc_id") % 4, F.col("text")
    reply = (
        F.when(case == 0, body)
        .when(case == 1, F.concat(F.lit("so\n</think>\n"), body))
        .when(case == 2, F.concat(F.lit("so</think>"), body, F.lit(" </think>"), "lang"))
        .otherwise(F.concat(body, F.lit("</think>")))
    )
    return table(spark, folder, "documents").select("doc_id", text.without_reasoning(reply).alias("response"))


@query(
    "H7_until_marker",
    "SELECT doc_id, string_split(replace(text, chr(10), '</s>'), '</s>')[1] AS response FROM documents",
)
def _(spark, folder):
    marked = F.replace("text", F.lit("\n"), F.lit("</s>"))
    return table(spark, folder, "documents").select("doc_id", text.until(marked, "</s>").alias("response"))


NUMBERS = ["1. ", "12) ", " 3. ", "44. ", "٣. "]
NUMBER = f"({sql.options(NUMBERS)})[(doc_id % {len(NUMBERS)}) + 1]"
GENERATED = f"({NUMBER} || replace(text, chr(10), chr(10) || {NUMBER}))"


def numbered_documents(spark, folder):
    """Documents turned into numbered lists, one number style each."""
    number = listed(NUMBERS, F.col("doc_id") % len(NUMBERS))
    generated = F.concat(number, F.replace("text", F.lit("\n"), F.concat(F.lit("\n"), number)))
    return table(spark, folder, "documents").select("doc_id", "source", generated.alias("response"))


@query(
    "H8_P10_numbered_lines",
    f"""SELECT doc_id, doc_id * 4294967296 + place - 1 AS seq, {sql.numbered_line('line')} AS message
    FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
      FROM (SELECT doc_id, string_split({sql.strip(GENERATED)}, chr(10)) AS lines FROM documents))
    WHERE {sql.numbered_line('line')} <> ''""",
)
def _(spark, folder):
    generated = numbered_documents(spark, folder).select("doc_id", "response")
    return listed_questions(generated, "response", "doc_id").select("doc_id", "seq", "message")


# --- chat ----------------------------------------------------------------------------------------


def flat(transcript):
    """Roles and contents as one string, for comparing nested columns."""
    lines = F.transform(transcript, lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return F.array_join(lines, "\n--\n")


def sql_flat(*turns):
    lines = [f"'{role}=' || {content}" for role, content in turns]
    return " || chr(10) || '--' || chr(10) || ".join(lines)


@query(
    "H10_exchange_messages",
    f"""WITH {EXCHANGES} SELECT conv_id, turn, {sql_flat(('user', 'prompt'), ('assistant', 'response'))}
    AS messages FROM exchanges""",
)
def _(spark, folder):
    rows = exchanges(spark, folder)
    pair = chat.exchange(F.col("prompt"), F.col("response"))
    return rows.select("conv_id", "turn", flat(pair).alias("messages"))


def transcripts(spark, folder):
    """Exchanges as transcripts; odd conversations have a system prompt of their own."""
    turns = [("user", F.col("prompt")), ("assistant", F.col("response"))]
    plain = chat.messages(*turns)
    with_system = chat.messages(("system", F.concat(F.lit("old "), F.col("conv_id").cast("string"))), *turns)
    return exchanges(spark, folder).select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 2 == 1, with_system).otherwise(plain).alias("messages"),
    )


@query(
    "H11_replace_system",
    f"""WITH {EXCHANGES} SELECT conv_id, turn, CASE WHEN conv_id % 2 = 1
      THEN {sql_flat(('system', "'new'"), ('user', 'prompt'), ('assistant', 'response'))}
      ELSE {sql_flat(('user', 'prompt'), ('assistant', 'response'))} END AS messages FROM exchanges""",
)
def _(spark, folder):
    rows = transcripts(spark, folder)
    swapped = chat.replace_system(F.col("messages"), "new", strict=False)
    return rows.select("conv_id", "turn", flat(swapped).alias("messages"))


@query(
    "H11_replace_system_strict",
    f"""WITH {EXCHANGES} SELECT conv_id, turn,
    {sql_flat(('system', "'new'"), ('user', 'prompt'), ('assistant', 'response'))} AS messages
    FROM exchanges WHERE conv_id % 2 = 1""",
)
def _(spark, folder):
    rows = transcripts(spark, folder).filter(F.get("messages", F.lit(0))["role"] == "system")
    swapped = chat.replace_system(F.col("messages"), "new")
    return rows.select("conv_id", "turn", flat(swapped).alias("messages"))


@query(
    "H12_H13_H14_dialogue_view",
    f"""WITH {EXCHANGES} SELECT conv_id, turn, CASE (conv_id + turn) % 4
      WHEN 0 THEN {sql_flat(('system', "'s'"), ('user', "'hi'"))}
      WHEN 1 THEN {sql_flat(('system', "'s'"), ('user', "'hello'"), ('assistant', "'hi'"), ('user', 'prompt'))}
      WHEN 2 THEN {sql_flat(('system', "'s'"), ('user', "'hi'"), ('assistant', 'prompt'), ('user', 'response'))}
      ELSE {sql_flat(('system', "'s'"), ('user', "'hello'"), ('assistant', "'hi'"), ('user', 'prompt'), ('assistant', 'response'), ('user', "'again'"))}
      END AS messages FROM exchanges""",
)
def _(spark, folder):
    case = (F.col("conv_id") + F.col("turn")) % 4
    none = F.array().cast("array<string>")
    one = F.array_append(none, F.col("prompt"))
    two = F.array_append(one, F.col("response"))
    spoken = F.when(case == 0, none).when(case == 1, one).when(case == 2, two).otherwise(
        F.array_append(two, F.lit("again"))
    )
    side_1, side_2 = chat.openings(F.lit("s"), F.lit("hi"), F.lit("hello"))
    rows = exchanges(spark, folder).withColumn("conversation", spoken)
    view = chat.dialogue_view(F.col("conversation"), side_1, side_2)
    return rows.select("conv_id", "turn", flat(view).alias("messages"))


@query(
    "H15_render",
    f"""WITH {EXCHANGES} SELECT conv_id, turn,
    {sql.render(('user', 'prompt'), ('assistant', 'response'))} AS chatml,
    '<bos><start_of_turn>user' || chr(10) || prompt || '<end_of_turn>' || chr(10) || '<start_of_turn>model'
      || chr(10) || response || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) AS gemma
    FROM exchanges""",
)
def _(spark, folder):
    pair = chat.exchange(F.col("prompt"), F.col("response"))
    return exchanges(spark, folder).select(
        "conv_id",
        "turn",
        chat.CHATML.render(pair).alias("chatml"),
        chat.GEMMA.render(pair).alias("gemma"),
    )


@query("H16_token_length", f"SELECT doc_id, {sql.tokens('text')} AS tokens FROM documents")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.token_count(F.col("text")).cast("bigint").alias("tokens"))


@query(
    "H17_keep_last_tokens",
    f"""SELECT doc_id, {sql.last_tokens('text', '30')} AS tail,
      len(string_split(text, ' ')[-(doc_id % 50 + 1):]) AS kept FROM documents""",
)
def _(spark, folder):
    tokens = F.split("text", " ")
    return table(spark, folder, "documents").select(
        "doc_id",
        chat.keep_last_tokens(F.col("text"), 30).alias("tail"),
        F.size(chat.keep_last(tokens, (F.col("doc_id") % 50 + 1).cast("int"))).cast("bigint").alias("kept"),
    )


# the same texts with their letters replaced by those of scripts that use no blanks
FOREIGN = "translate(text, 'aeionrst', '中文日本ひカไม')"


@query(
    "H16_H17_unspaced_scripts",
    f"""WITH foreign_texts AS (SELECT doc_id, {FOREIGN} AS text FROM documents)
    SELECT doc_id, {sql.tokens('text')} AS tokens, md5({sql.last_tokens('text', '25')}) AS tail FROM foreign_texts""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.expr(FOREIGN).alias("text"))
    return docs.select(
        "doc_id",
        text.token_count(F.col("text")).cast("bigint").alias("tokens"),
        F.md5(chat.keep_last_tokens(F.col("text"), 25)).alias("tail"),
    )


@query(
    "H18_suffix",
    f"""SELECT conv_id, turn, CASE WHEN conv_id % 9 = 8 THEN text
      ELSE text || chr(10) || ({sql.options(SUFFIX_VARIANTS)})[(conv_id % 9) + 1] END AS content
    FROM conversations""",
)
def _(spark, folder):
    suffix = listed(SUFFIX_VARIANTS, F.col("conv_id") % 9)
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", chat.with_suffix(F.col("text"), suffix).alias("content"))


@query(
    "H19_reasoning_prefill",
    f"SELECT conv_id, turn, text || {sql.fill(REASONING_PREFILL, TRAITS='role')} AS prompt FROM conversations",
)
def _(spark, folder):
    prefilled = F.concat("text", text.fill(REASONING_PREFILL, TRAITS=F.col("role")))
    return table(spark, folder, "conversations").select("conv_id", "turn", prefilled.alias("prompt"))


@query(
    "H20_questions_and_first_turns",
    """SELECT doc_id, place - 1 AS pos, question, first FROM (SELECT doc_id, unnest(lines) AS question,
      generate_subscripts(lines, 1) AS place, lines[1] AS first
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
def _(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return lines.select(
        "doc_id", F.posexplode("lines").alias("pos", "question"), F.get("lines", F.lit(0)).alias("first")
    ).withColumn("pos", F.col("pos").cast("bigint"))


# --- codes and display text ----------------------------------------------------------------------


@query(
    "H21_label_codes",
    f"""SELECT doc_id, doc_id % 11 AS code, ({sql.options(CONSTITUTIONS)})[(doc_id % 11) + 1] AS name
    FROM documents""",
)
def _(spark, folder):
    name = listed(CONSTITUTIONS, F.col("doc_id") % 11)
    code = labels.label_code(CONSTITUTIONS, name)
    return table(spark, folder, "documents").select(
        "doc_id", code.cast("bigint").alias("code"), labels.label_name(CONSTITUTIONS, code).alias("name")
    )


@query(
    "H22_mean_and_error_text",
    """SELECT p_brand, printf('%.1f%% ± %.1f%%', round(m * 100, 1), round(s * 100, 1)) AS summary
    FROM (SELECT p_brand, avg(p_size / 100.0) AS m, stddev_samp(p_size / 100.0) / sqrt(count(*)) AS s
      FROM part GROUP BY 1)""",
)
def _(spark, folder):
    size = F.col("p_size") / 100
    stats = table(spark, folder, "part").groupBy("p_brand").agg(
        F.avg(size).alias("m"), (F.stddev_samp(size) / F.sqrt(F.count(size))).alias("s")
    )
    return stats.select("p_brand", labels.mean_and_error_text(F.col("m"), F.col("s")).alias("summary"))


@query(
    "H23_signed_text",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '+' ELSE '' END || trunc(c_acctbal)::bigint AS label
    FROM customer""",
)
def _(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", labels.signed_text(F.col("c_acctbal")).alias("label")
    )


@query(
    "H24_variant_names",
    """SELECT doc_id, CASE WHEN doc_id % 10 < 8 THEN 'v' || (doc_id % 10) ELSE lang END AS scored,
    CASE WHEN doc_id % 10 < 8 THEN 'v' || (doc_id % 10) ELSE 'default' END AS written FROM documents""",
)
def _(spark, folder):
    number = F.col("doc_id") % 10
    variant = F.when(number < 8, number.cast("string")).otherwise(F.col("lang"))
    return table(spark, folder, "documents").select(
        "doc_id",
        labels.variant_name(variant).alias("scored"),
        labels.variant_name(variant, otherwise="default").alias("written"),
    )


@query(
    "H25_condition_phrases",
    f"""SELECT doc_id, CASE doc_id % 3 {" ".join(f"WHEN {i} THEN {sql.text(p)}" for i, p in enumerate(CONDITION_PHRASES.values()))}
    END AS phrase FROM documents""",
)
def _(spark, folder):
    condition = listed(list(CONDITION_PHRASES), F.col("doc_id") % 3)
    return table(spark, folder, "documents").select(
        "doc_id", labels.condition_phrase(condition).alias("phrase")
    )


@query(
    "H26_consensus",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 1 AND doc_id % 4 = 2 THEN 'one'
      WHEN doc_id % 3 = 2 AND doc_id % 4 = 1 THEN 'two' END AS vote FROM documents""",
)
def _(spark, folder):
    first, swapped = (F.col("doc_id") % 3).cast("string"), (F.col("doc_id") % 4).cast("string")
    vote = labels.consensus(first, swapped, F.lit("one"), F.lit("two"))
    return table(spark, folder, "documents").select("doc_id", vote.alias("vote"))
