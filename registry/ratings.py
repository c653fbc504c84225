"""Elo ratings, changes between runs, rank correlation and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import COMPARISONS, comparisons, table
from temperament.operators import metrics, ratings
from temperament.plans.reports import change_overview, change_report, rating_densities, run_correlations

ELO = f"""RECURSIVE {COMPARISONS},
valid AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq) AS n FROM comparisons
  WHERE winner IN (trait_1, trait_2)),
names AS MATERIALIZED (
  SELECT run, list(trait ORDER BY trait) AS traits FROM (
    SELECT run, trait_1 AS trait FROM valid UNION SELECT run, trait_2 FROM valid) GROUP BY run),
games AS MATERIALIZED (
  SELECT v.run, v.n, list_position(traits, trait_1) AS i, list_position(traits, trait_2) AS j,
    CASE WHEN winner = trait_1 THEN 1.0::double ELSE 0.0::double END AS won
  FROM valid v JOIN names t ON t.run = v.run),
play AS (
  SELECT run, 0::bigint AS n, list_transform(traits, lambda x: 1000.0::double) AS r FROM names
  UNION ALL
  SELECT run, n, list_transform(r, lambda x, k: x + gain * ((k = i)::int - (k = j)::int))
  FROM (SELECT p.run, p.n + 1 AS n, p.r, g.i, g.j,
      32 * (g.won - 1 / (1 + pow(10, (p.r[g.j] - p.r[g.i]) / 400))) AS gain
    FROM play p JOIN games g ON g.run = p.run AND g.n = p.n + 1)),
ended AS (SELECT run, arg_max(r, n) AS r FROM play GROUP BY run),
raw AS (
  SELECT e.run, unnest(t.traits) AS trait, unnest(e.r) AS rating FROM ended e JOIN names t ON t.run = e.run)"""
RANKED = "row_number() OVER (PARTITION BY run ORDER BY round(rating, 2) DESC, trait) AS place"


@query("A5_elo_ratings", f"WITH {ELO} SELECT run, trait, round(rating, 2) AS rating, {RANKED} FROM raw")
def _(spark, folder):
    games = ratings.valid_comparisons(comparisons(spark, folder))
    return ratings.elo_ratings(games, ["run"]).withColumn("place", F.col("place").cast("bigint"))


@query(
    "A5_elo_ratings_in_small_chunks",
    f"WITH {ELO} SELECT run, trait, round(rating, 2) AS rating, {RANKED} FROM raw",
)
def _(spark, folder):
    games = ratings.valid_comparisons(comparisons(spark, folder))
    rated = ratings.elo_ratings(games, ["run"], chunk_games=2000)
    return rated.withColumn("place", F.col("place").cast("bigint"))


@query(
    "A6_normalized_elo",
    f"""WITH {ELO}, scaled AS (SELECT run, trait, (rating - min(rating) OVER (PARTITION BY run))
      / (max(rating) OVER (PARTITION BY run) - min(rating) OVER (PARTITION BY run)) AS rating FROM raw)
    SELECT run, trait, round(rating, 2) AS rating, {RANKED} FROM scaled""",
)
def _(spark, folder):
    games = ratings.valid_comparisons(comparisons(spark, folder))
    rated = ratings.elo_ratings(games, ["run"], normalize=True)
    return rated.withColumn("place", F.col("place").cast("bigint"))


@query(
    "X2_traits_seen",
    f"""WITH {COMPARISONS} SELECT run, trait_1 AS trait FROM comparisons UNION
    SELECT run, trait_2 FROM comparisons""",
)
def _(spark, folder):
    return ratings.traits_seen(comparisons(spark, folder), ["run"])


def rating_table(spark, folder):
    """A rating per kind of event and run, without a replay."""
    events = table(spark, folder, "events")
    trait = F.concat("event_type", F.lit("-"), (F.col("user_id") % 7).cast("string"))
    run = F.concat(F.lit("run"), (F.col("event_id") % 3).cast("string"))
    rated = events.groupBy(run.alias("run"), trait.alias("trait")).agg(
        F.round(F.max("value") * 10 + F.count(F.lit(1)), 2).alias("rating")
    )
    return ratings.ranked(rated, ["run"]).withColumn("place", F.col("place").cast("bigint"))


RATINGS = """rated AS (
  SELECT 'run' || (event_id % 3) AS run, event_type || '-' || (user_id % 7) AS trait,
    round(max(value) * 10 + count(*), 2) AS rating FROM events GROUP BY 1, 2),
ratings AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY rating DESC, trait) AS place FROM rated)"""
BASE, TUNED = "run = 'run0'", "run <> 'run0'"
CHANGES = f"""{RATINGS}, changes AS (
  SELECT t.run, t.trait, b.rating AS before, t.rating AS after, t.rating - b.rating AS change
  FROM ratings t JOIN ratings b ON b.trait = t.trait WHERE b.run = 'run0' AND t.run <> 'run0')"""


@query("W2_T1_ranked_ratings", f"WITH {RATINGS} SELECT run, trait, rating, place FROM ratings")
def _(spark, folder):
    return rating_table(spark, folder)


@query(
    "J2_rating_changes",
    f"WITH {CHANGES} SELECT run, trait, before, after, round(change, 6) AS change FROM changes",
)
def _(spark, folder):
    changes = ratings.rating_changes(rating_table(spark, folder), BASE, TUNED, ["run"])
    return changes.withColumn("change", F.round("change", 6))


@query(
    "J2_unrated_traits",
    f"""WITH {RATINGS} SELECT trait FROM ratings WHERE run = 'run0' AND trait NOT IN (
      SELECT trait FROM ratings WHERE run = 'run1' AND place > 3)""",
)
def _(spark, folder):
    rated = rating_table(spark, folder)
    lacking = ratings.unrated_traits(rated, BASE, "run = 'run1' and place > 3")
    return lacking.filter("missing_in = 'tuned'").select("trait")


# two models with a base run and two tuned runs each; one tuned run lacks a trait, another has one more
KEYED = """keyed AS (
  SELECT * FROM (
    SELECT 'm' || (user_id % 2) AS model, 'run' || (event_id % 3) AS run, event_type || '-' || (user_id % 7) AS trait,
      round(max(value) * 10 + count(*), 2) AS rating FROM events GROUP BY 1, 2, 3)
  WHERE NOT (run = 'run1' AND model = 'm1' AND trait LIKE '%-3') AND NOT (run = 'run0' AND trait LIKE '%-5'))"""


def keyed_ratings(spark, folder):
    events = table(spark, folder, "events")
    trait = F.concat("event_type", F.lit("-"), (F.col("user_id") % 7).cast("string")).alias("trait")
    run = F.concat(F.lit("run"), (F.col("event_id") % 3).cast("string")).alias("run")
    model = F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")).alias("model")
    rated = events.groupBy(model, run, trait).agg(F.round(F.max("value") * 10 + F.count(F.lit(1)), 2).alias("rating"))
    return rated.filter("not (run = 'run1' and model = 'm1' and trait like '%-3') and not (run = 'run0' and trait like '%-5')")


@query(
    "J2_keyed_rating_changes",
    f"""WITH {KEYED} SELECT t.model, t.run, t.trait, b.rating AS before, t.rating AS after,
      round(t.rating - b.rating, 6) AS change
    FROM keyed t JOIN keyed b ON b.trait = t.trait AND b.model = t.model WHERE b.run = 'run0' AND t.run <> 'run0'""",
)
def _(spark, folder):
    changes = ratings.rating_changes(keyed_ratings(spark, folder), BASE, TUNED, ["model", "run"], ["model"])
    return changes.withColumn("change", F.round("change", 6))


@query(
    "J2_keyed_unrated_traits",
    f"""WITH {KEYED}, runs AS (SELECT DISTINCT model, run FROM keyed WHERE run <> 'run0')
    SELECT r.model, r.run, b.trait, 'tuned' AS missing_in FROM runs r JOIN keyed b ON b.model = r.model AND b.run = 'run0'
      WHERE NOT EXISTS (SELECT 1 FROM keyed t WHERE t.model = r.model AND t.run = r.run AND t.trait = b.trait)
    UNION ALL SELECT model, run, trait, 'base' FROM keyed t WHERE run <> 'run0'
      AND NOT EXISTS (SELECT 1 FROM keyed b WHERE b.model = t.model AND b.run = 'run0' AND b.trait = t.trait)""",
)
def _(spark, folder):
    return ratings.unrated_traits(keyed_ratings(spark, folder), BASE, TUNED, ["model", "run"], ["model"])


@query(
    "T2_extreme_changes",
    f"""WITH {CHANGES}, placed AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY change, trait) AS up,
      row_number() OVER (PARTITION BY run ORDER BY change DESC, trait DESC) AS down FROM changes)
    SELECT run, trait, round(change, 6) AS change, up AS slot FROM placed WHERE up <= 5 UNION ALL
    SELECT run, trait, round(change, 6), 11 - down FROM placed WHERE down <= 5""",
)
def _(spark, folder):
    changes = ratings.rating_changes(rating_table(spark, folder), BASE, TUNED, ["run"])
    moved = ratings.extreme_changes(changes, ["run"])
    return moved.select("run", "trait", F.round("change", 6).alias("change"), "slot")


@query(
    "T3_largest_changes",
    f"""WITH {CHANGES} SELECT run, arg_max(trait, (change, trait)) AS riser, round(max(change), 6) AS rise,
    arg_min(trait, (change, trait)) AS faller, round(min(change), 6) AS fall FROM changes GROUP BY run""",
)
def _(spark, folder):
    changes = ratings.rating_changes(rating_table(spark, folder), BASE, TUNED, ["run"])
    found = ratings.largest_changes(changes, ["run"])
    return found.withColumn("rise", F.round("rise", 6)).withColumn("fall", F.round("fall", 6))


@query("T7_head", f"WITH {RATINGS} SELECT run, trait, rating FROM ratings ORDER BY rating DESC, run, trait LIMIT 10")
def _(spark, folder):
    ordered = rating_table(spark, folder).orderBy(F.desc("rating"), "run", "trait")
    return ordered.select("run", "trait", "rating").limit(10)


COMMON = f"""{RATINGS}, common AS (SELECT a.run AS run_1, b.run AS run_2, a.trait,
    row_number() OVER (PARTITION BY a.run, b.run ORDER BY a.place) AS x,
    row_number() OVER (PARTITION BY a.run, b.run ORDER BY b.place) AS y
  FROM ratings a JOIN ratings b ON a.trait = b.trait AND a.run < b.run),
correlations AS (SELECT run_1, run_2, corr(x, y) AS rho, count(*) AS traits FROM common GROUP BY ALL)"""


def correlations(spark, folder):
    rated = rating_table(spark, folder)
    others = F.explode(F.array(F.lit("run1"), F.lit("run2"))).alias("run_2")
    pairs = rated.select(F.col("run").alias("run_1")).distinct().select("run_1", others)
    return ratings.rank_correlation(rated, pairs.filter("run_1 < run_2"))


@query(
    "A10_rank_correlation",
    f"WITH {COMMON} SELECT run_1, run_2, round(rho, 6) AS rho, traits FROM correlations",
)
def _(spark, folder):
    found = correlations(spark, folder)
    return found.select("run_1", "run_2", F.round("rho", 6).alias("rho"), "traits")


@query("A10_mean_correlation", f"WITH {COMMON} SELECT round(avg(rho), 6) AS mean_rho FROM correlations")
def _(spark, folder):
    return correlations(spark, folder).agg(F.round(F.avg("rho"), 6).alias("mean_rho"))


# Student's t with n whole degrees is a finite series in the sine and cosine of atan(t / sqrt(n))
P_VALUES = f"""WITH RECURSIVE {COMMON}, angles AS (
  SELECT *, traits - 2 AS n, abs(rho) AS s, sqrt(1 - rho * rho) AS c FROM correlations),
series AS (
  SELECT run_1, run_2, n, s, c, CASE WHEN n % 2 = 0 THEN 0 ELSE 1 END AS power,
    CASE WHEN n % 2 = 0 THEN 1.0::double ELSE c END AS term FROM angles
  UNION ALL
  SELECT run_1, run_2, n, s, c, power + 2, term * c * c * (power + 1) / (power + 2) FROM series WHERE power + 2 <= n - 2),
sums AS (SELECT run_1, run_2, any_value(n) AS n, any_value(s) AS s, sum(CASE WHEN n > 1 THEN term ELSE 0 END) AS total
  FROM series GROUP BY ALL)
SELECT run_1, run_2, round(1 - CASE WHEN n % 2 = 0 THEN s * total ELSE 2 / pi() * (asin(s) + s * total) END, 9) + 0.0 AS p_value
FROM sums"""


@query("A10_correlation_p_values", P_VALUES)
def _(spark, folder):
    return correlations(spark, folder).select("run_1", "run_2", F.round("p_value", 9).alias("p_value"))


@query(
    "A11_rating_histogram",
    f"""WITH {RATINGS}, span AS (SELECT run, min(rating) AS low, max(rating) AS high, count(*) AS total
      FROM ratings GROUP BY run)
    SELECT r.run, least(floor((rating - low) / ((high - low) / 20)) + 1, 20)::int AS bin, count(*) AS n,
      round(count(*) / (any_value(total) * (any_value(high) - any_value(low)) / 20), 6) AS density
    FROM ratings r JOIN span s ON s.run = r.run GROUP BY 1, 2""",
)
def _(spark, folder):
    found = metrics.histogram(rating_table(spark, folder), ["run"], "rating")
    return found.withColumn("density", F.round("density", 6))


@query(
    "A11_value_histogram",
    """WITH span AS (SELECT min(c_acctbal) AS low, max(c_acctbal) AS high, count(*) AS total FROM customer)
    SELECT least(floor((c_acctbal - low) / ((high - low) / 20)) + 1, 20)::int AS bin, count(*) AS n,
      round(count(*) / (any_value(total) * (any_value(high) - any_value(low)) / 20), 9) AS density
    FROM customer, span GROUP BY 1""",
)
def _(spark, folder):
    found = metrics.histogram(table(spark, folder, "customer"), [], "c_acctbal")
    return found.withColumn("density", F.round("density", 9))


@query(
    "A12_padded_range",
    f"WITH {RATINGS} SELECT min(rating) - 100 AS low, max(rating) + 100 AS high FROM ratings",
)
def _(spark, folder):
    return metrics.padded_range(rating_table(spark, folder), "rating", 100)


@query(
    "A15_ratings_by_run",
    f"""WITH {RATINGS} SELECT place, {", ".join(f"any_value(trait || ' (' || format('{{:,.2f}}', rating) || ')') FILTER (run = 'run{i}') AS run{i}" for i in range(3))}
    FROM ratings GROUP BY place""",
)
def _(spark, folder):
    return ratings.ratings_by_run(rating_table(spark, folder), ["run0", "run1", "run2"])


@query(
    "X3_common_traits",
    f"""WITH {RATINGS} SELECT trait FROM ratings WHERE run = 'run1' AND place <= 20 INTERSECT
    SELECT trait FROM ratings WHERE run = 'run2' AND place <= 20""",
)
def _(spark, folder):
    top = rating_table(spark, folder).filter("place <= 20")
    return top.filter("run = 'run1'").select("trait").intersect(top.filter("run = 'run2'").select("trait"))


@query(
    "B17_change_report",
    f"""WITH {ELO}, ratings AS (SELECT run, trait, round(rating, 2) AS rating FROM raw), changes AS (
      SELECT t.run, t.trait, b.rating AS before, t.rating AS after, t.rating - b.rating AS change
      FROM ratings t JOIN ratings b ON b.trait = t.trait WHERE b.run = 'run0' AND t.run <> 'run0'),
    placed AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY change, trait) AS up,
      row_number() OVER (PARTITION BY run ORDER BY change DESC, trait DESC) AS down FROM changes),
    listed AS (SELECT *, up AS slot FROM placed WHERE up <= 5 UNION ALL
      SELECT *, 11 - down FROM placed WHERE down <= 5)
    SELECT run, slot, trait, before, after, round(change, 6) AS change,
      CASE WHEN change > 0 THEN '+' ELSE '' END || trunc(change)::bigint AS label FROM listed""",
)
def _(spark, folder):
    games = ratings.valid_comparisons(comparisons(spark, folder))
    report = change_report(ratings.elo_ratings(games, ["run"]), BASE, TUNED, ["run"])
    return report.withColumn("change", F.round("change", 6))


# three models before and after, each a run of its own under either condition
BOTH = ELO.replace("'run' || (e.event_id % 3) AS run", "CASE WHEN e.event_id // 3 % 2 = 0 THEN 'base' ELSE 'tuned' END || '/m' || (e.event_id % 3) AS run")
BOTH = f"""{BOTH}, both_rated AS (SELECT split_part(run, '/', 1) AS condition, split_part(run, '/', 2) AS run, trait, round(rating, 2) AS rating
  FROM raw), ratings AS (
  SELECT *, row_number() OVER (PARTITION BY condition, run ORDER BY rating DESC, trait) AS place FROM both_rated)"""


def both_conditions(spark, folder):
    """Elo ratings of three models under two conditions."""
    games = ratings.valid_comparisons(comparisons(spark, folder)).drop("run")
    condition = F.when(F.floor(F.col("seq") / 3) % 2 == 0, F.lit("base")).otherwise(F.lit("tuned"))
    games = games.withColumn("condition", condition).withColumn("run", F.concat(F.lit("m"), (F.col("seq") % 3).cast("string")))
    return ratings.elo_ratings(games, ["condition", "run"])


@query(
    "B17_run_correlations",
    f"""WITH {BOTH}, common AS (SELECT a.condition, a.run AS run_1, b.run AS run_2,
      row_number() OVER (PARTITION BY a.condition, a.run, b.run ORDER BY a.place) AS x,
      row_number() OVER (PARTITION BY a.condition, a.run, b.run ORDER BY b.place) AS y
      FROM ratings a JOIN ratings b ON a.condition = b.condition AND a.trait = b.trait AND a.run < b.run),
    found AS (SELECT condition, run_1, run_2, corr(x, y) AS rho, count(*) AS traits FROM common GROUP BY ALL)
    SELECT condition, run_1, run_2, round(rho, 6) AS rho, traits, round(avg(rho) OVER (PARTITION BY condition), 6) AS mean_rho
    FROM found""",
)
def _(spark, folder):
    found = run_correlations(both_conditions(spark, folder), ["condition"])
    return found.select("condition", "run_1", "run_2", F.round("rho", 6).alias("rho"), "traits", F.round("mean_rho", 6).alias("mean_rho"))


@query(
    "B17_rating_densities",
    f"""WITH {BOTH}, span AS (SELECT condition, run, min(rating) AS low, max(rating) AS high, count(*) AS total FROM ratings GROUP BY ALL),
    shown AS (SELECT min(rating) - 100 AS low, max(rating) + 100 AS high FROM ratings)
    SELECT r.condition, r.run, least(floor((rating - s.low) / ((s.high - s.low) / 20)) + 1, 20)::int AS bin, count(*) AS n,
      round(count(*) / (any_value(total) * (any_value(s.high) - any_value(s.low)) / 20), 6) AS density,
      any_value(shown.low) AS low, any_value(shown.high) AS high
    FROM ratings r JOIN span s ON s.run = r.run AND s.condition = r.condition, shown GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    found = rating_densities(both_conditions(spark, folder), ["condition", "run"])
    return found.withColumn("density", F.round("density", 6))


@query(
    "B17_change_overview",
    f"""WITH {BOTH}, changes AS (SELECT t.run, t.trait, t.rating - b.rating AS change
      FROM ratings t JOIN ratings b ON b.trait = t.trait AND b.run = t.run WHERE b.condition = 'base' AND t.condition = 'tuned'),
    moved AS (SELECT run, count(*) AS traits, round(avg(abs(change)), 6) AS mean_size, arg_max(trait, (change, trait)) AS riser,
      max(change) AS up, arg_min(trait, (change, trait)) AS faller, min(change) AS down FROM changes GROUP BY run)
    SELECT run, traits, mean_size, riser, CASE WHEN up > 0 THEN '+' ELSE '' END || trunc(up)::bigint AS rise, faller,
      CASE WHEN down > 0 THEN '+' ELSE '' END || trunc(down)::bigint AS fall FROM moved""",
)
def _(spark, folder):
    overview = change_overview(both_conditions(spark, folder), "condition = 'base'", "condition = 'tuned'", ["run"], ["run"])
    return overview.withColumn("mean_size", F.round("mean_size", 6))
