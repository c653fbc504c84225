"""A training corpus from the documents table: five stages, each applying an operator of `temperament.llm`.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last one return the columns
of `docs`. `run` writes what a stage returns to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.llm import bpe, language
from temperament.llm.exact_duplicates import exact_duplicates
from temperament.llm.mixing import mixed_rows
from temperament.llm.near_duplicates import near_duplicates
from temperament.llm.scratch import by_size, in_pieces, release_driver_memory
from temperament.session import settle


def _afresh(stage: Callable) -> Callable:
    """The stage, begun after the driver has given back what the stages before it have freed."""

    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        release_driver_memory(spark)
        return stage(spark, docs, folder)

    return begun


def _kept(docs: DataFrame, kept: DataFrame, name: str) -> DataFrame:
    """The rows of `docs` whose doc_id is among `kept` (doc_id)."""
    kept = in_pieces(kept.select("doc_id").distinct(), docs.count(), 16)
    kept = by_size(settle(kept, name), 16)
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


@_afresh
def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from all labelled documents, within its bound."""
    model = language.train(docs, F.lit(True))
    # names of their own for all but the text, so that none clashes with the columns of the prediction
    plain = [name if name == "text" else f"column {at}" for at, name in enumerate(docs.columns)]
    found = language.identify(docs.toDF(*plain), model).where("accepted")
    return found.select(*[F.col(f"`{name}`") for name in plain]).toDF(*docs.columns)


@_afresh
def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of equal texts, the one with the largest doc_id."""
    return _kept(docs, exact_duplicates(docs).where("kept"), "pipeline-exact")


@_afresh
def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of similar texts, the one with the smallest doc_id."""
    return _kept(docs, near_duplicates(docs).where("kept"), "pipeline-near")


@_afresh
def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


@_afresh
def encode_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The rows with the tokens of their text in its place: n_tokens, ids, and whether these decode to the text again."""
    import public_tokenizers

    return bpe.encode_checked(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("exact_duplicates", drop_copies),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode_tokens),
]

#: Training a model and tokenizing cannot be written in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
