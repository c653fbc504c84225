"""Scores, win rates and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import ANSWERS, BLOCKS, PREDICTIONS, answers, blocks, predictions, table
from temperament.functions.labels import argmax
from temperament.operators import metrics
from temperament.operators.classify import classify, fit_classifier, training_rows
from temperament.operators.traits import unfinished_traits
from temperament.plans.reports import ablation_scores, method_comparison, win_rate_summary


@query(
    "A1_mean_and_error",
    """SELECT l_returnflag, l_linestatus, round(avg(score), 6) AS mean,
    round(stddev_samp(score) / sqrt(count(score)), 6) AS sem
    FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_linenumber <> 3 THEN l_discount END AS score FROM lineitem)
    GROUP BY ALL""",
)
def _(spark, folder):
    score = F.when(F.col("l_linenumber") != 3, F.col("l_discount"))
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", score.alias("score"))
    stats = metrics.mean_and_error(lines, ["l_returnflag", "l_linestatus"], "score")
    return stats.withColumn("mean", F.round("mean", 6)).withColumn("sem", F.round("sem", 6))


VOTES = """CASE WHEN o_orderstatus = 'F' THEN 'one' WHEN o_orderstatus = 'O' AND o_custkey % 2 = 0 THEN 'two' END"""


@query(
    "A2_win_rate",
    f"""SELECT o_orderpriority, count(vote) AS valid, round(avg((vote = 'two')::int), 6) AS win_rate
    FROM (SELECT o_orderpriority, {VOTES} AS vote FROM orders) GROUP BY 1""",
)
def _(spark, folder):
    status = F.col("o_orderstatus")
    vote = F.when(status == "F", F.lit("one")).when(
        (status == "O") & (F.col("o_custkey") % 2 == 0), F.lit("two")
    )
    votes = table(spark, folder, "orders").select("o_orderpriority", vote.alias("vote"))
    rates = metrics.win_rate(votes, ["o_orderpriority"], "vote", "one", "two")
    return rates.withColumn("valid", F.col("valid").cast("bigint")).withColumn(
        "win_rate", F.round("win_rate", 6)
    )


@query(
    "A3_invalid_count",
    f"""WITH {ANSWERS} SELECT turn, count(*) FILTER (other_reply IS NULL) AS invalid, count(*) AS total
    FROM answers GROUP BY turn""",
)
def _(spark, folder):
    return metrics.invalid_count(answers(spark, folder), ["turn"], "other_reply")


@query("A4_W1_trait_blocks", f"WITH {BLOCKS} SELECT constitution, traits FROM blocks")
def _(spark, folder):
    return blocks(spark, folder)


LABEL_SCORES = """tallies AS (
  SELECT {keys} label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM (
    SELECT {keys} truth AS label, (truth = predicted)::int AS tp, 0 AS fp, (truth <> predicted)::int AS fn FROM {rows}
    UNION ALL
    SELECT {keys} predicted, 0, (truth <> predicted)::int, 0 FROM {rows}) GROUP BY ALL),
scores AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM tallies)"""


@query(
    "A7_A8_accuracy_and_macro_f1",
    f"""WITH {PREDICTIONS}, {LABEL_SCORES.format(keys='method,', rows='predictions')}
    SELECT method, round(avg(f1), 6) AS f1, round(sum(tp) / sum(tp + fn), 6) AS accuracy
    FROM scores GROUP BY method""",
)
def _(spark, folder):
    found = metrics.classification_scores(predictions(spark, folder), ["method"], "truth", "predicted")
    return found.withColumn("f1", F.round("f1", 6)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "A9_argmax",
    """SELECT vec_id, (list_position(v, list_max(v)) - 1)::int AS class FROM (
      SELECT vec_id, list_transform(embedding, lambda x: round(x::double, 1)) AS v FROM embeddings)""",
)
def _(spark, folder):
    # rounded, so that scores are tied and the first one has to win
    scores = F.transform("embedding", lambda x: F.round(x.cast("double"), 1))
    return table(spark, folder, "embeddings").select("vec_id", argmax(scores).alias("class"))


@query(
    "A14_unfinished_traits",
    """SELECT o_custkey % 500 AS trait, count(*) FILTER (o_orderstatus = 'F') AS accepted FROM orders
    GROUP BY 1 HAVING accepted < 12""",
)
def _(spark, folder):
    rows = table(spark, folder, "orders").withColumn("trait", F.col("o_custkey") % 500)
    return unfinished_traits(rows, rows.filter("o_orderstatus = 'F'"), ["trait"], 12)


@query(
    "A17_score_grid",
    f"""WITH {PREDICTIONS}, pooled AS (SELECT method, variant, truth, predicted FROM predictions UNION ALL
      SELECT method, 'all', truth, predicted FROM predictions WHERE variant <> 'default'),
    {LABEL_SCORES.format(keys='method, variant,', rows='pooled')}
    SELECT method, variant, round(avg(f1), 6) AS f1, round(sum(tp) / sum(tp + fn), 6) AS accuracy
    FROM scores GROUP BY ALL""",
)
def _(spark, folder):
    grid = metrics.score_grid(predictions(spark, folder), "truth", "predicted")
    return grid.withColumn("f1", F.round("f1", 6)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "A18_two_turn_scores",
    f"""WITH {PREDICTIONS}, {LABEL_SCORES.format(keys='method, variant,', rows='predictions')}
    SELECT method, variant, round(avg(f1), 6) AS f1, round(sum(tp) / sum(tp + fn), 6) AS accuracy
    FROM scores GROUP BY ALL""",
)
def _(spark, folder):
    found = metrics.classification_scores(
        predictions(spark, folder), ["method", "variant"], "truth", "predicted"
    )
    return found.withColumn("f1", F.round("f1", 6)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "B18_method_comparison",
    f"""WITH {PREDICTIONS}, {LABEL_SCORES.format(keys='method, variant,', rows='predictions')},
    cells AS (SELECT method, variant, avg(f1) AS score FROM scores WHERE variant <> 'default' GROUP BY ALL),
    stats AS (SELECT method, avg(score) AS mean, stddev_samp(score) / sqrt(count(*)) AS sem FROM cells GROUP BY 1)
    SELECT place::int AS place, m.method, m.method AS label, round(coalesce(mean, 0), 6) AS mean,
      round(coalesce(sem, 0), 6) AS sem
    FROM (VALUES (0, 'prompted'), (1, 'steered'), (2, 'trained')) m(place, method)
    LEFT JOIN stats s ON s.method = m.method""",
)
def _(spark, folder):
    grid = metrics.score_grid(predictions(spark, folder), "truth", "predicted")
    scores = grid.select("method", "variant", F.col("f1").alias("score"))
    table_ = method_comparison(scores, ["prompted", "steered", "trained"])
    return table_.withColumn("mean", F.round("mean", 6)).withColumn("sem", F.round("sem", 6))


@query(
    "B18_win_rate_summary",
    """WITH rates AS (SELECT p_brand, p_type, avg((p_size > 25)::int) AS win_rate FROM part GROUP BY ALL),
    stats AS (SELECT p_type, avg(win_rate) AS mean, stddev_samp(win_rate) / sqrt(count(win_rate)) AS sem
      FROM rates GROUP BY 1)
    SELECT p_type, round(mean, 6) AS mean, round(sem, 6) AS sem,
      printf('%.1f%% ± %.1f%%', round(mean * 100, 1), round(sem * 100, 1)) AS summary FROM stats""",
)
def _(spark, folder):
    won = (F.col("p_size") > 25).cast("int")
    rates = table(spark, folder, "part").groupBy("p_brand", "p_type").agg(F.avg(won).alias("win_rate"))
    stats = win_rate_summary(rates, ["p_type"])
    return stats.withColumn("mean", F.round("mean", 6)).withColumn("sem", F.round("sem", 6))


LANGUAGES = ["en", "fr", "de", "es"]


def language_rows(spark, folder, per_cell):
    docs = table(spark, folder, "documents").withColumnRenamed("lang", "constitution")
    return training_rows(docs, LANGUAGES, ["constitution", "source"], ["doc_id"], per_cell)


@query(
    "B16_H21_W3_training_rows",
    """SELECT doc_id, constitution, source, CASE constitution WHEN 'en' THEN 0.0::double WHEN 'fr' THEN 1
      WHEN 'de' THEN 2 WHEN 'es' THEN 3 END AS label
    FROM (SELECT doc_id, lang AS constitution, source,
      row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS place FROM documents) WHERE place <= 500""",
)
def _(spark, folder):
    return language_rows(spark, folder, 500).select("doc_id", "constitution", "source", "label")


@query("M1_classifier_scores")
def _(spark, folder):
    """Fitted on at most 500 texts per language and source of the default variant, scored on the other variants."""
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "text",
        F.col("lang").alias("constitution"),
        F.col("source").alias("method"),
        F.when(F.col("doc_id") % 5 == 0, "default").otherwise(F.concat(F.lit("v"), (F.col("doc_id") % 5).cast("string"))).alias("variant"),
    )
    own = docs.filter("variant = 'default'")
    rows = training_rows(own, LANGUAGES, ["constitution", "method"], ["doc_id"])
    model = fit_classifier(rows, "text", features=1 << 12, rounds=10)
    scored = classify(model, docs.filter("variant <> 'default'"), LANGUAGES)
    return metrics.score_grid(scored, "constitution", "predicted")


@query(
    "B18_method_and_model",
    f"""WITH {PREDICTIONS}, {LABEL_SCORES.format(keys='method, variant,', rows='predictions')},
    cells AS (SELECT method, variant, avg(f1) AS score FROM scores WHERE variant <> 'default' GROUP BY ALL),
    models AS (SELECT 'm' || m AS model, method, score * (1 + m) / 4 AS score FROM cells, range(2) r(m)
      WHERE NOT (m = 1 AND method = 'steered')),
    stats AS (SELECT model, method, avg(score) AS mean, stddev_samp(score) / sqrt(count(*)) AS sem FROM models GROUP BY ALL)
    SELECT k.model, place::int AS place, m.method, m.method AS label, round(coalesce(mean, 0), 6) AS mean,
      round(coalesce(sem, 0), 6) AS sem
    FROM (VALUES (0, 'prompted'), (1, 'steered'), (2, 'trained')) m(place, method)
    CROSS JOIN (SELECT DISTINCT model FROM models) k
    LEFT JOIN stats s ON s.method = m.method AND s.model = k.model""",
)
def _(spark, folder):
    grid = metrics.score_grid(predictions(spark, folder), "truth", "predicted")
    model = F.explode(F.sequence(F.lit(0), F.lit(1))).alias("m")
    scores = grid.select("method", "variant", "f1", model).filter("not (m = 1 and method = 'steered')").select(
        "method", "variant", F.concat(F.lit("m"), F.col("m").cast("string")).alias("model"),
        (F.col("f1") * (1 + F.col("m")) / 4).alias("score"),
    )
    table_ = method_comparison(scores, ["prompted", "steered", "trained"], ["model"])
    return table_.withColumn("mean", F.round("mean", 6)).withColumn("sem", F.round("sem", 6))


@query(
    "B18_ablation_table",
    f"""WITH {PREDICTIONS}, {LABEL_SCORES.format(keys='method, variant,', rows='predictions')},
    cells AS (SELECT method, variant, avg(f1) AS score FROM scores WHERE variant <> 'default' GROUP BY ALL),
    used AS (SELECT 'without-' || method AS method, score / 2 AS score FROM cells WHERE method <> 'trained'
      UNION ALL SELECT method, score FROM cells WHERE method IN ('trained', 'steered')),
    stats AS (SELECT method, avg(score) AS mean, stddev_samp(score) / sqrt(count(*)) AS sem FROM used GROUP BY 1)
    SELECT place::int AS place, m.method, m.method AS label, round(coalesce(mean, 0), 6) AS mean,
      round(coalesce(sem, 0), 6) AS sem
    FROM (VALUES (0, 'without-prompted'), (1, 'without-steered'), (2, 'without-all'), (3, 'trained'), (4, 'steered')) m(place, method)
    LEFT JOIN stats s ON s.method = m.method""",
)
def _(spark, folder):
    grid = metrics.score_grid(predictions(spark, folder), "truth", "predicted")
    main = grid.select(F.col("f1").alias("score"), "accuracy", "variant", "method")
    ablations = main.filter("method <> 'trained'").select(
        F.concat(F.lit("without-"), "method").alias("method"), "variant", (F.col("score") / 2).alias("score")
    )
    used = ablation_scores(ablations, main, ["trained", "steered"])
    table_ = method_comparison(used, ["without-prompted", "without-steered", "without-all", "trained", "steered"])
    return table_.withColumn("mean", F.round("mean", 6)).withColumn("sem", F.round("sem", 6))


@query(
    "H22_group_of_one",
    """WITH stats AS (SELECT CASE WHEN p_partkey < 9 THEN -p_partkey ELSE p_partkey % 40 END AS k, count(*) AS n, avg(p_size / 50) AS mean,
      stddev_samp(p_size / 50) / sqrt(count(*)) AS sem FROM part GROUP BY 1)
    SELECT k, CASE WHEN n = 1 THEN printf('%.1f%% ± nan%%', round(mean * 100, 1))
      ELSE printf('%.1f%% ± %.1f%%', round(mean * 100, 1), round(sem * 100, 1)) END AS summary FROM stats""",
)
def _(spark, folder):
    group = F.when(F.col("p_partkey") < 9, -F.col("p_partkey")).otherwise(F.col("p_partkey") % 40)
    rates = table(spark, folder, "part").select(group.alias("k"), (F.col("p_size") / 50).alias("win_rate"))
    return win_rate_summary(rates, ["k"]).select("k", "summary")


