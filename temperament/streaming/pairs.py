"""Preference pairs from answer files as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from temperament.plans.pairs import preference_pairs


def pairs_from_arriving_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    student: str,
    output: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Turn every new JSON-lines file of wide answers into pairs, once.

    The batch plan runs unchanged on the stream: it is row by row and keeps no state. The checkpoint
    records which files are done, so a restart neither repeats nor skips one.
    """
    arriving = spark.readStream.schema(schema).json(source)
    pairs = preference_pairs(arriving, student, **options).select("chosen", "rejected")
    return (
        pairs.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
