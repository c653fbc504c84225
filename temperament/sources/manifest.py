"""What a data run should have written, what is there, and how large it is."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.fixed_values import STAGES
from temperament.operators.joins import unmatched


def expected_outputs(runs: DataFrame, stages: dict[str, bool] | None = None) -> DataFrame:
    """One row per file that ``(model, constitution)`` runs should leave behind.

    Self-dialogue has a second, leading, file. The stage list is fixed and short, so it is exploded
    in place instead of joined.
    """
    stages = stages or STAGES
    listed = F.array(
        *[
            F.struct(F.lit(stage).alias("stage"), F.lit(owned).alias("per_model"))
            for stage, owned in stages.items()
        ]
    )
    files = runs.select("model", "constitution", F.explode(listed).alias("s")).select(
        "model", "constitution", "s.stage", "s.per_model"
    )
    endings = F.when(
        F.col("stage") == "self_interaction", F.array(F.lit(""), F.lit("-leading"))
    ).otherwise(F.array(F.lit("")))
    named = files.withColumn("ending", F.explode(endings))
    name = F.concat("constitution", "ending", F.lit(".jsonl"))
    return named.select(
        "model",
        "constitution",
        "stage",
        F.when(F.col("per_model"), F.concat_ws("/", "stage", "model", name))
        .otherwise(F.concat_ws("/", "stage", name))
        .alias("relpath"),
    )


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """``relpath`` and ``length`` of every ``.jsonl`` output below a folder; contents are not read.

    An output is one file, or a folder of that name whose part files are added up.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length")
    )
    scheme = "^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"
    folder = re.escape(re.sub("/+", "/", re.sub(scheme, "", os.path.abspath(root) if "://" not in root else root)).rstrip("/"))
    relpath = F.regexp_extract("path", f"{scheme}{folder}/(.+?\\.jsonl)(?:/|$)", 1)
    return (
        found.groupBy(relpath.alias("relpath"))
        .agg(F.sum("length").alias("length"))
        .filter(F.col("relpath") != "")
    )


def manifest(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Every expected file with its size, null where it is missing."""
    joined = expected.join(stored, "relpath", "left")
    return joined.withColumn("missing", F.col("length").isNull())


def manifest_totals(listing: DataFrame) -> DataFrame:
    return listing.agg(
        F.count("length").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.count_if("missing").alias("missing"),
    )


def require_keys(expected: DataFrame, present: DataFrame, keys: list[str], shown: int = 5) -> None:
    """Fail when an expected key is absent, naming the first few."""
    absent = unmatched(expected.select(*keys), present, keys).distinct().orderBy(*keys).limit(shown).collect()
    if absent:
        raise FileNotFoundError(f"missing for {', '.join(str(tuple(row)) for row in absent)}")


def missing_keys(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return unmatched(expected, present, keys)


def run_summary(results: DataFrame) -> DataFrame:
    """``ok`` flags of runs as a count per status."""
    status = F.when(F.col("ok"), F.lit("OK")).otherwise(F.lit("FAILED"))
    return results.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("runs"))


def failed_runs(results: DataFrame) -> DataFrame:
    return results.filter(~F.coalesce(F.col("ok"), F.lit(False)))
