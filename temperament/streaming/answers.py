"""Text generation over arriving prompt files, which goes on after a failure where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from temperament.operators.inference import BatchFunction, with_batch_text


def answer_arriving_prompts(
    spark: SparkSession,
    source: str,
    schema: StructType,
    prompt: str,
    load: Callable[[], BatchFunction],
    output: str,
    checkpoint: str,
    *,
    files_at_once: int = 1,
    out: str = "response",
) -> StreamingQuery:
    """Attach generated texts to the rows of all Parquet files that have arrived, some files at a time.

    The answers of a step are written as a folder of their own, ``batch=n``, and count once that step is done. If the generator fails, finished
    steps stay; a later call generates for the others only, and a step that is repeated replaces its folder.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)

    def answer(rows: DataFrame, number: int) -> None:
        with_batch_text(rows, prompt, load, out).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = arriving.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_answers(spark: SparkSession, output: str, schema: StructType, out: str = "response") -> DataFrame:
    """The answered rows of all steps."""
    kind = StructType([*schema.fields]).add(out, "string")
    return spark.read.schema(kind).parquet(f"{output}/batch=*").select(*[F.col(f"`{n}`") for n in kind.names])
