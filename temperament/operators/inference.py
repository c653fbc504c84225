"""The one place where a text model enters: a batch function given by the user."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BatchFunction = Callable[[list[str]], list[str]]


def with_batch_text(
    df: DataFrame, prompt: str, load: Callable[[], BatchFunction], out: str = "response"
) -> DataFrame:
    """Attach ``out``, the texts that a user's batch function makes of a prompt column.

    ``load`` runs once per task and returns the function, so a model is not loaded per batch. Only the
    prompt column travels to Python; the row it belongs to never leaves its place. The result is
    marked as not repeatable so the optimizer neither copies nor re-runs the call.
    """

    @F.pandas_udf("string")
    def generate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = load()
        for batch in batches:
            yield pd.Series(call(batch.tolist()), index=batch.index, dtype="object")

    return df.withColumn(out, generate.asNondeterministic()(F.col(prompt)))


def with_token_count(
    df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[int]]], out: str
) -> DataFrame:
    """Attach token counts from a user's tokenizer, loaded once per task."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = load()
        for batch in batches:
            yield pd.Series(call(batch.tolist()), index=batch.index)

    return df.withColumn(out, count(F.col(text)))
