"""Sources and sinks: tables derived from the given ones are written out and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.builders import PAIRS, preference_pairs
from registry.inputs import COMPARISONS, EXCHANGES, comparisons, exchanges, table
from registry.rows import flat, sql_flat
from temperament import schemas
from temperament.fixed_values import STAGES
from temperament.operators import joins
from temperament.session import scratch_path
from temperament.sources import files, manifest


@query(
    "S1_S8_json_lines",
    f"""WITH {PAIRS} SELECT {sql_flat(('user', 'prompt'), ('assistant', 'chosen'))} AS chosen,
      {sql_flat(('user', 'prompt'), ('assistant', 'rejected'))} AS rejected FROM pairs
    WHERE greatest(c_length, r_length) <= 1024""",
)
def _(spark, folder):
    path = scratch_path(spark, "pairs")
    files.write_lines(preference_pairs(spark, folder).select("chosen", "rejected"), path)
    back = files.read_lines(spark, path, schemas.PAIRS)
    return back.select(flat(F.col("chosen")).alias("chosen"), flat(F.col("rejected")).alias("rejected"))


@query(
    "S2_constitution_texts",
    """SELECT p_partkey, (i)::int AS trait_pos, CASE i WHEN 1 THEN p_type ELSE p_brand END AS trait,
      CASE WHEN i = 1 THEN NULL ELSE p_name END AS clarification, p_name || '|' || p_type AS questions
    FROM part, (VALUES (1), (2)) v(i)""",
)
def _(spark, folder):
    asked = F.array("p_name", "p_type").alias("questions")
    nothing = F.lit(None).cast("string").alias("clarification")
    entries = F.array(
        F.struct(F.col("p_type").alias("trait"), nothing, asked),
        F.struct(F.col("p_brand").alias("trait"), F.col("p_name").alias("clarification"), asked),
    )
    texts = table(spark, folder, "part").select("p_partkey", F.to_json(entries).alias("value"))
    rows = files.constitution_rows(texts, "value")
    return rows.withColumn("questions", F.array_join("questions", "|"))


@query(
    "S3_string_lists",
    """SELECT doc_id, i - 1 AS place, value FROM (SELECT doc_id, unnest(lines) AS value,
      generate_subscripts(lines, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
def _(spark, folder):
    listed = F.to_json(F.split("text", "\n")).alias("value")
    texts = table(spark, folder, "documents").select("doc_id", listed)
    parsed = texts.select("doc_id", F.posexplode(files.string_list(F.col("value"))).alias("place", "value"))
    return parsed.withColumn("place", F.col("place").cast("bigint"))


@query(
    "S4_S9_chosen_columns",
    f"WITH {COMPARISONS} SELECT run, seq, trait_1, winner FROM comparisons WHERE run = 'run1'",
)
def _(spark, folder):
    path = scratch_path(spark, "comparisons")
    files.write_columns(comparisons(spark, folder), path, ["seq", "trait_1", "winner"], "run")
    return spark.read.parquet(path).filter("run = 'run1'")


@query("S6_runs_from_file_names", f"WITH {COMPARISONS} SELECT run, seq, winner FROM comparisons")
def _(spark, folder):
    rows, root = comparisons(spark, folder), scratch_path(spark, "preferences")
    for run in ("run0", "run1", "run2"):
        files.write_columns(rows.filter(F.col("run") == run), f"{root}/{run}.parquet", ["seq", "winner"])
    return files.read_runs(spark, root, rows.select("seq", "winner").schema)


@query(
    "S7_partitioned_tree",
    """SELECT source AS question, text AS response, lang AS constitution, 'v' || (doc_id % 8) AS variant
    FROM documents WHERE lang = 'en' AND doc_id % 8 = 3""",
)
def _(spark, folder):
    rows = table(spark, folder, "documents").select(
        F.col("source").alias("question"),
        F.col("text").alias("response"),
        F.concat(F.lit("v"), (F.col("doc_id") % 8).cast("string")).alias("variant"),
        F.col("lang").alias("constitution"),
    )
    path = scratch_path(spark, "robustness")
    files.write_lines(rows, path, "variant", "constitution")
    stored = files.read_tree(spark, path, schemas.RESPONSES)
    return stored.filter("constitution = 'en' and variant = 'v3'")


@query(
    "S10_task_lines",
    """SELECT 'suite' || p_size AS suite, p_type || ':' || p_brand AS task, p_size AS few_shot,
      CASE WHEN p_partkey % 3 = 0 THEN '0' END AS flag FROM part WHERE p_partkey % 5 <> 0""",
)
def _(spark, folder):
    size = F.col("p_size").cast("string")
    line = F.concat_ws(
        "|",
        F.concat(F.lit("suite"), size),
        F.concat_ws(":", "p_type", "p_brand"),
        size,
        F.when(F.col("p_partkey") % 3 == 0, F.lit("0")),
    )
    commented = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("# "), line)).otherwise(line)
    path = scratch_path(spark, "tasks")
    table(spark, folder, "part").select(commented.alias("value")).write.text(path)
    return files.task_lines(spark.read.text(path))


@query(
    "S11_benchmark_results",
    """SELECT p_brand AS model, p_type AS task, round(avg(p_size), 6) AS mean,
      round(stddev_samp(p_size) / sqrt(count(*)), 6) AS se FROM part GROUP BY ALL""",
)
def _(spark, folder):
    size = F.col("p_size")
    results = table(spark, folder, "part").groupBy(F.col("p_brand").alias("model"), F.col("p_type").alias("task")).agg(
        F.round(F.avg(size), 6).alias("mean"),
        F.round(F.stddev_samp(size) / F.sqrt(F.count(size)), 6).alias("se"),
    )
    path = scratch_path(spark, "results")
    files.write_lines(results, path)
    return files.read_lines(spark, path, schemas.BENCHMARK_RESULTS)


@query(
    "S12_append_missing",
    f"""WITH {EXCHANGES} SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN 'earlier' ELSE 'later' END AS made
    FROM exchanges""",
)
def _(spark, folder):
    rows, path = exchanges(spark, folder).select("conv_id", "turn"), scratch_path(spark, "appended")
    rows.filter("conv_id % 3 = 0").withColumn("made", F.lit("earlier")).write.parquet(path)
    files.append_missing(rows.withColumn("made", F.lit("later")), path, ["conv_id", "turn"])
    return spark.read.parquet(path)


@query(
    "S14_one_table_of_results",
    """SELECT source AS method, lang AS variant, count(*) AS n, sum(n_chars)::bigint AS score FROM documents
    GROUP BY ALL""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.groupBy(F.col("source").alias("method"), F.col("lang").alias("variant")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("score")
    )


STAGE_ROWS = ", ".join(f"('{stage}', {str(owned).lower()})" for stage, owned in STAGES.items())
EXPECTED = f"""expected AS (
  SELECT model, constitution, stage, CASE WHEN per_model THEN stage || '/' || model || '/' || constitution || ending
    || '.jsonl' ELSE stage || '/' || constitution || ending || '.jsonl' END AS relpath
  FROM (SELECT DISTINCT p_brand AS model, p_type AS constitution FROM part),
    (VALUES {STAGE_ROWS}) s(stage, per_model), (VALUES (''), ('-leading')) e(ending)
  WHERE ending = '' OR stage = 'self_interaction')"""


def runs(spark, folder):
    parts = table(spark, folder, "part")
    return parts.select(F.col("p_brand").alias("model"), F.col("p_type").alias("constitution")).distinct()


@query("S15_expected_outputs", f"WITH {EXPECTED} SELECT model, constitution, stage, relpath FROM expected")
def _(spark, folder):
    return manifest.expected_outputs(runs(spark, folder))


def stored(spark, folder):
    """Write the exchanges as one output of a run, twice, and list what is stored."""
    root = scratch_path(spark, "outputs")
    rows = exchanges(spark, folder).select("prompt", "response")
    for name in ("dpo/Brand#1/SMALL.jsonl", "self_interaction/Brand#1/SMALL-leading.jsonl"):
        files.write_lines(rows, f"{root}/{name}")
    return manifest.manifest(manifest.expected_outputs(runs(spark, folder)), manifest.stored_files(spark, root))


WRITTEN = "('dpo/Brand#1/SMALL.jsonl', 'self_interaction/Brand#1/SMALL-leading.jsonl')"


@query(
    "S15_manifest",
    f"WITH {EXPECTED} SELECT model, constitution, stage, relpath, relpath NOT IN {WRITTEN} AS missing FROM expected",
)
def _(spark, folder):
    return stored(spark, folder).drop("length")


@query(
    "A13_manifest_totals",
    f"""WITH {EXPECTED} SELECT count(*) FILTER (relpath IN {WRITTEN}) AS files,
      count(*) FILTER (relpath NOT IN {WRITTEN}) AS missing, true AS has_bytes FROM expected""",
)
def _(spark, folder):
    totals = manifest.manifest_totals(stored(spark, folder))
    return totals.select("files", "missing", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "S16_constitution_alias",
    """SELECT doc_id, lang AS constitution FROM documents UNION ALL
    SELECT doc_id, lang || '-dpo200' FROM documents""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("constitution"))
    return files.alias_constitution(docs)


def run_results(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", (F.col("o_orderstatus") != "F").alias("ok"))


@query(
    "A16_run_summary",
    """SELECT CASE WHEN o_orderstatus <> 'F' THEN 'OK' ELSE 'FAILED' END AS status, count(*) AS runs FROM orders
    GROUP BY 1""",
)
def _(spark, folder):
    return manifest.run_summary(run_results(spark, folder))


@query("A16_failed_runs", "SELECT o_orderkey, false AS ok FROM orders WHERE o_orderstatus = 'F'")
def _(spark, folder):
    return manifest.failed_runs(run_results(spark, folder))


@query(
    "S5_stored_verdicts",
    f"WITH {COMPARISONS} SELECT run, seq, trait_1, trait_2, winner FROM comparisons",
)
def _(spark, folder):
    rows, path = comparisons(spark, folder), scratch_path(spark, "verdicts")
    files.write_columns(rows, path, ["seq", "winner"])
    asked = rows.select("run", "seq", "trait_1", "trait_2")
    return joins.attach(asked, spark.read.parquet(path), ["seq"])


@query(
    "S2_constitution_files",
    """SELECT p_brand AS constitution, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)::int AS trait_pos,
      p_type AS trait, CASE WHEN p_size > 25 THEN p_name END AS clarification, p_name || '|' || p_type AS questions
    FROM part""",
)
def _(spark, folder):
    """A file per constitution, written as JSON text and scanned; its folder gives the name."""
    asked = F.array("p_name", "p_type").alias("questions")
    entry = F.struct(
        "p_partkey", F.col("p_type").alias("trait"), F.when(F.col("p_size") > 25, F.col("p_name")).alias("clarification"), asked
    )
    listed = table(spark, folder, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.sort_array(F.collect_list(entry)).alias("list"))
    bare = F.transform("list", lambda e: F.struct(e["trait"].alias("trait"), e["clarification"].alias("clarification"), e["questions"].alias("questions")))
    path = scratch_path(spark, "constitutions")
    listed.select("brand", F.to_json(bare).alias("value")).write.partitionBy("brand").text(path)
    of_folder = lambda p: F.regexp_extract(F.url_decode(F.url_decode(p)), "brand=([^/]+)/", 1)
    rows = files.read_constitution_files(spark, path, of_folder)
    return rows.withColumn("questions", F.array_join("questions", "|"))


@query(
    "S3_string_list_files",
    """SELECT row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS place, p_name || '|' || p_brand AS value FROM part""",
)
def _(spark, folder):
    """A file per brand with the names of its parts."""
    path = scratch_path(spark, "lists")
    entry = F.struct("p_partkey", F.concat_ws("|", "p_name", "p_brand").alias("value"))
    listed = table(spark, folder, "part").groupBy("p_brand").agg(F.sort_array(F.collect_list(entry)).alias("list"))
    texts = listed.select("p_brand", F.to_json(F.transform("list", lambda e: e["value"])).alias("value"))
    texts.write.partitionBy("p_brand").text(path)
    rows = files.read_string_lists(spark, path)
    return rows.select(F.col("place").cast("bigint").alias("place"), "value")


@query(
    "H20_first_turns_of_corpora",
    """WITH first AS (SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations GROUP BY 1)
    SELECT form, prompt, count(*) AS n FROM first, (VALUES ('strings'), ('inputs'), ('contents')) f(form) GROUP BY ALL""",
)
def _(spark, folder):
    turn = F.sort_array(F.collect_list(F.struct("turn", "text")))
    grouped = table(spark, folder, "conversations").groupBy("conv_id").agg(turn.alias("turns"))
    shapes = {
        "strings": F.transform("turns", lambda t: t["text"]).alias("conversations"),
        "inputs": F.transform("turns", lambda t: F.struct(t["text"].alias("input"))).alias("conversation"),
        "contents": F.transform("turns", lambda t: F.struct(t["text"].alias("content"))).alias("conversation"),
    }
    found = None
    for form, column in shapes.items():
        path = scratch_path(spark, f"corpus-{form}")
        files.write_lines(grouped.select(column), path)
        part = files.read_first_turns(spark, path, form).withColumn("form", F.lit(form))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("form", "prompt").agg(F.count("*").alias("n"))
