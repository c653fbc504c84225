"""Joins, set operations, sampling and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query, sql
from registry.inputs import BLOCKS, COMPARISONS, EXCHANGES, blocks, exchanges, table
from temperament.fixed_values import GREETINGS, LEADING_GREETINGS, PERSONA_SYSTEM, TRAITS
from temperament.functions.chat import dialogue_view
from temperament.functions.choice import pick, pick_two
from temperament.functions.text import fill, words
from temperament.operators import joins, sampling, similarity, vectors
from temperament.sources import manifest

# --- joins ---------------------------------------------------------------------------------------


def duelling(spark, folder):
    """Every source against the next one, on questions that each source answers twice."""
    docs = table(spark, folder, "documents")
    number = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    question = F.concat(F.lit("q"), F.floor(F.col("doc_id") / 40).cast("string")).alias("question")
    one = docs.select(number.alias("pair"), question, F.col("text").alias("response"))
    two = docs.select(F.pmod(number - 1, F.lit(20)).alias("pair"), question, F.col("text").alias("response"))
    return one, two


DUEL = """one AS (SELECT regexp_extract(source, '[0-9]+')::int AS pair, 'q' || (doc_id // 40) AS question,
    text AS response FROM documents),
two AS (SELECT (pair + 19) % 20 AS pair, question, response FROM one),
duel AS (SELECT a.pair, a.question, a.response AS response_1, b.response AS response_2, count(*) AS copies
  FROM one a JOIN two b ON a.pair = b.pair AND a.question = b.question GROUP BY ALL)"""


@query(
    "J1_same_question",
    f"WITH {DUEL} SELECT pair, question, md5(response_1) AS one, md5(response_2) AS two, copies FROM duel",
)
def _(spark, folder):
    one, two = duelling(spark, folder)
    joined = joins.same_question(one, two, ["pair", "question"])
    return joined.select(
        "pair", "question", F.md5("response_1").alias("one"), F.md5("response_2").alias("two"), "copies"
    )


@query(
    "J1_merged_answers",
    f"""WITH {DUEL} SELECT a.pair, a.question, md5(a.response) AS one, md5(b.response) AS two
    FROM one a JOIN two b ON a.pair = b.pair AND a.question = b.question""",
)
def _(spark, folder):
    merged = joins.merged_answers(*duelling(spark, folder), ["pair", "question"])
    return merged.select("pair", "question", F.md5("response_1").alias("one"), F.md5("response_2").alias("two"))


@query(
    "J3_S5_attached_results",
    "SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return joins.attach(docs, table(spark, folder, "labels"), ["doc_id"])


@query("J4_replicated", "SELECT conv_id, turn, rep::int AS rep FROM conversations, range(5) r(rep)")
def _(spark, folder):
    return sampling.replicate(table(spark, folder, "conversations").select("conv_id", "turn"), 5)


@query(
    "J4_every_row_with_every_row",
    "SELECT s_suppkey, s_name, r_regionkey, r_name FROM supplier, region",
)
def _(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return joins.for_each_row(suppliers, table(spark, folder, "region"))


LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"
OVERLAP = f"""{LINES},
lists AS (SELECT DISTINCT list_sort({sql.words('line')}) AS w FROM lines WHERE len({sql.words('line')}) > 0),
sets AS (SELECT DISTINCT list_sort(list_distinct({sql.words('text')})) AS p FROM benchmark),
new_words AS (SELECT w, len(w) AS n, word, count(*) AS times FROM (SELECT w, unnest(w) AS word FROM lists)
  GROUP BY ALL),
pool_words AS (SELECT p, unnest(p) AS word FROM sets),
alike AS (SELECT w, p FROM new_words a JOIN pool_words b ON a.word = b.word GROUP BY w, p, n
  HAVING 2 * sum(times) > n)"""


def document_lines(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@query(
    "J5_similar_lines",
    f"""WITH {OVERLAP} SELECT doc_id, line FROM lines WHERE list_sort({sql.words('line')}) IN (SELECT w FROM alike)""",
)
def _(spark, folder):
    pool = table(spark, folder, "benchmark")
    found = similarity.similar(document_lines(spark, folder), pool, "line", "text")
    return found.select("doc_id", "line")


@query(
    "J5_novel_lines",
    f"""WITH {OVERLAP} SELECT doc_id, line FROM lines
    WHERE list_sort({sql.words('line')}) NOT IN (SELECT w FROM alike)""",
)
def _(spark, folder):
    pool = table(spark, folder, "benchmark")
    kept = similarity.novel(document_lines(spark, folder), pool, "line", "text")
    return kept.select("doc_id", "line")


@query(
    "J6_S13_missing_keys",
    """SELECT c_custkey AS custkey FROM customer WHERE c_custkey NOT IN (
      SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def _(spark, folder):
    expected = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"))
    done = table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    present = done.select(F.col("o_custkey").alias("custkey"))
    return manifest.missing_keys(expected, present, ["custkey"])


@query(
    "J7_key_mismatch",
    """SELECT coalesce(a.k, b.k) AS key, CASE WHEN a.k IS NULL THEN 'first' ELSE 'second' END AS missing_in
    FROM (SELECT DISTINCT doc_id AS k FROM documents) a
    FULL JOIN (SELECT DISTINCT doc_id + 7 AS k FROM documents) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    one = docs.select(F.col("doc_id").alias("key"))
    return joins.key_mismatch(one, one.select((F.col("key") + 7).alias("key")), "key")


def sql_pair(seed, *key):
    first = f"({sql.draw(seed + ':1', *key)} % 144)"
    second = f"(({first} + 1 + {sql.draw(seed + ':2', *key)} % 143) % 144)"
    return f"({sql.options(TRAITS)})[{first} + 1]", f"({sql.options(TRAITS)})[{second} + 1]"


FIRST, SECOND = sql_pair("s", "event_id")


@query("J8_trait_pairs", f"SELECT event_id, {FIRST} AS trait_1, {SECOND} AS trait_2 FROM events")
def _(spark, folder):
    first, second = pick_two(TRAITS, "s", F.col("event_id"))
    return table(spark, folder, "events").select(
        "event_id", first.alias("trait_1"), second.alias("trait_2")
    )


@query(
    "J9_traits_in_prompts",
    f"""WITH {BLOCKS} SELECT p_partkey, {sql.fill(PERSONA_SYSTEM, NAME="'Qwen'", TRAITS='traits')} AS system
    FROM part JOIN blocks ON constitution = p_brand""",
)
def _(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("constitution"))
    joined = joins.with_small(parts, blocks(spark, folder), ["constitution"])
    system = fill(PERSONA_SYSTEM, NAME="Qwen", TRAITS=F.col("traits"))
    return joined.select("p_partkey", system.alias("system"))


# --- sorts, samples and windows ------------------------------------------------------------------


@query(
    "T4_shuffled",
    f"SELECT doc_id, source, {sql.hash_key(42, 'doc_id')} AS shuffle_key FROM documents",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return sampling.shuffled(docs, 42, "doc_id")


@query(
    "T5_sample",
    f"SELECT o_orderkey FROM orders ORDER BY {sql.hash_key(123456, 'o_orderkey')}, o_orderkey LIMIT 1000",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return sampling.sample(orders, 123456, 1000, "o_orderkey").select("o_orderkey")


@query(
    "T6_drawn_greetings",
    f"""SELECT c_custkey, {sql.pick(LEADING_GREETINGS, 'a', 'c_custkey')} AS greeting_1,
    {sql.pick(GREETINGS, 'b', 'c_custkey')} AS greeting_2 FROM customer""",
)
def _(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        pick(LEADING_GREETINGS, "a", F.col("c_custkey")).alias("greeting_1"),
        pick(GREETINGS, "b", F.col("c_custkey")).alias("greeting_2"),
    )


@query(
    "W3_first_per_group",
    """SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n
      FROM documents) WHERE n <= 20""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang")
    return sampling.first_per_group(docs, ["source"], ["doc_id"], 20)


@query(
    "W4_turn_alternation",
    """SELECT a.conv_id, a.turn, a.role, a.role <> b.role AS alternates
    FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1""",
)
def _(spark, folder):
    turns = table(spark, folder, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    joined = turns.join(before, ["conv_id", "turn"], "left")
    return joined.select("conv_id", "turn", "role", (F.col("role") != F.col("before")).alias("alternates"))


@query(
    "W4_roles_by_parity",
    """SELECT doc_id, i - 1 AS place, CASE WHEN (n - i) % 2 = 0 THEN 'user' ELSE 'assistant' END AS role
    FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n, unnest(range(1, n + 1)) AS i FROM documents)""",
)
def _(spark, folder):
    none = F.array().cast("array<struct<role:string,content:string>>")
    view = dialogue_view(F.split("text", "\n"), none, none)
    turns = table(spark, folder, "documents").select("doc_id", F.posexplode(view).alias("place", "m"))
    return turns.select("doc_id", F.col("place").cast("bigint").alias("place"), "m.role")


# --- sets ----------------------------------------------------------------------------------------


@query(
    "X1_union_all",
    f"""WITH {EXCHANGES} SELECT 'exchange' AS kind, prompt AS content FROM exchanges UNION ALL
    SELECT 'document', text FROM documents UNION ALL SELECT 'question', text FROM benchmark""",
)
def _(spark, folder):
    parts = [
        (exchanges(spark, folder), "exchange", "prompt"),
        (table(spark, folder, "documents"), "document", "text"),
        (table(spark, folder, "benchmark"), "question", "text"),
    ]
    one, two, three = [
        df.select(F.lit(kind).alias("kind"), F.col(column).alias("content")) for df, kind, column in parts
    ]
    return one.unionByName(two).unionByName(three)


@query(
    "X4_difference",
    f"""WITH {COMPARISONS} SELECT DISTINCT trait_1 AS trait FROM comparisons WHERE run = 'run0' EXCEPT
    SELECT trait_2 FROM comparisons WHERE run = 'run1' AND seq % 5 = 0 AND winner = trait_2 AND trait_2 LIKE '%-3'""",
)
def _(spark, folder):
    from registry.inputs import comparisons

    rows = comparisons(spark, folder)
    wanted = rows.filter("run = 'run0'").select(F.col("trait_1").alias("trait")).distinct()
    won = rows.filter("run = 'run1' and seq % 5 = 0 and winner = trait_2 and trait_2 like '%-3'")
    return joins.unmatched(wanted, won.select(F.col("trait_2").alias("trait")), ["trait"])


# --- vectors -------------------------------------------------------------------------------------


def two_vector_sets(spark, folder):
    one = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return one, one.withColumn("embedding", F.reverse("embedding"))


def sql_blend(a, b):
    return f"""SELECT vec_id, i - 1 AS pos, round(x * {a}::double + y * {b}::double, 6) AS value FROM (
      SELECT vec_id, unnest(embedding)::double AS x, unnest(list_reverse(embedding))::double AS y,
        generate_subscripts(embedding, 1) AS i FROM embeddings)"""


def _elements(df):
    values = df.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return values.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query("V1_blended_vectors", sql_blend(1.0, 0.25))
def _(spark, folder):
    one, two = two_vector_sets(spark, folder)
    return _elements(vectors.blend(one, two, "vec_id", "embedding", 1.0, 0.25))


@query("V1_interpolated_vectors", sql_blend(0.5, 0.5))
def _(spark, folder):
    one, two = two_vector_sets(spark, folder)
    return _elements(vectors.interpolate(one, two, "vec_id", "embedding", 0.5))


@query("U1b_words", f"SELECT doc_id, len({sql.words('text')}) AS words FROM documents")
def _(spark, folder):
    counted = F.size(words(F.col("text"))).cast("bigint")
    return table(spark, folder, "documents").select("doc_id", counted.alias("words"))
