"""Reading and writing the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from temperament import schemas
from temperament.functions.text import string_list
from temperament.operators.joins import unmatched


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored path is there, in whatever file system it lies."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def read_lines(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """JSON lines under a stated schema."""
    return spark.read.schema(schema).json(path)


def read_tree(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """JSON lines in ``key=value`` folders; the keys become columns that filters prune by."""
    return spark.read.schema(schema).option("basePath", root).json(root)


def write_lines(df: DataFrame, path: str, *keys: str, mode: str = "errorifexists") -> None:
    """JSON lines, one folder per key value. Re-running with mode ``ignore`` skips existing output."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*keys) if keys else writer).json(path)


def write_columns(df: DataFrame, path: str, columns: list[str], *keys: str) -> None:
    """Chosen columns as Parquet."""
    writer = df.select(*columns, *[key for key in keys if key not in columns]).write
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def constitution_rows(texts: DataFrame, text: str) -> DataFrame:
    """One row per trait from texts that each hold one constitution as a JSON array.

    ``trait_pos`` is the trait's place in its text, from 1. Other columns are kept.
    """
    entries = F.from_json(F.col(text), f"array<{schemas.CONSTITUTION_FILE.simpleString()}>")
    kept = [name for name in texts.columns if name != text]
    return texts.select(*kept, F.posexplode(entries).alias("place", "entry")).select(
        *kept,
        (F.col("place") + 1).alias("trait_pos"),
        "entry.trait",
        "entry.clarification",
        "entry.questions",
    )


def read_constitution_files(spark: SparkSession, path: str, name=None) -> DataFrame:
    """Hand-written constitutions: one JSON array per file, named after the file.

    ``name`` makes another name from the file's path. A file holds some tens of traits, so one row per file is a fine unit of work.
    """
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    named = (name or file_stem)(F.col("_metadata.file_path")).alias("constitution")
    return constitution_rows(whole.select(named, "value"), "value")


def first_turns(rows: DataFrame) -> DataFrame:
    """``prompt``: the first turn of every conversation, in any of the three stored forms.

    The turns stand in ``conversations`` as strings, or in ``conversation`` as entries with ``input`` or with ``content``.
    """
    if "conversations" in rows.columns:
        return rows.select(F.get("conversations", F.lit(0)).alias("prompt"))
    entry = rows.schema["conversation"].dataType.elementType
    field = "input" if "input" in entry.fieldNames() else "content"
    return rows.select(F.get("conversation", F.lit(0))[field].alias("prompt"))


def read_first_turns(spark: SparkSession, path: str, form: str) -> DataFrame:
    """First turns of a stored corpus of JSON lines; ``form`` is strings, inputs or contents."""
    forms = {
        "strings": schemas.FIRST_TURN_STRINGS,
        "inputs": schemas.FIRST_TURN_INPUTS,
        "contents": schemas.FIRST_TURN_CONTENTS,
    }
    return first_turns(read_lines(spark, path, forms[form]))


def read_string_lists(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of strings, one row per string with its place."""
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return whole.select(F.posexplode(string_list(F.col("value"))).alias("place", "value"))


def file_stem(path: Column) -> Column:
    """File name without folders and extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[a-z]+)?\z", 1)


def run_of_path(path: Column) -> Column:
    """Run name from the folder that a result file lies in, its suffix dropped."""
    return F.regexp_extract(path, r"([^/]+)\.parquet/[^/]+\z", 1)


def read_runs(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Every ``{run}.parquet`` result under a folder, with the run's name as a column."""
    found = spark.read.schema(schema).parquet(f"{root}/*.parquet")
    return found.withColumn("run", run_of_path(F.col("_metadata.file_path")))


def task_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Benchmark task list: ``suite|task|few-shot[|flag]``, with ``#`` lines as comments."""
    line = F.col(column)
    part = F.split(line, r"\|")
    kept = lines.filter(~line.startswith("#") & (F.trim(line) != ""))
    return kept.select(
        F.get(part, F.lit(0)).alias("suite"),
        F.get(part, F.lit(1)).alias("task"),
        F.get(part, F.lit(2)).try_cast("int").alias("few_shot"),
        F.get(part, F.lit(3)).alias("flag"),
    )


def append_missing(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Add only the rows whose key the output does not hold yet."""
    spark = rows.sparkSession
    done = spark.read.schema(rows.schema).parquet(path).select(*keys)
    unmatched(rows, done, keys).write.mode("append").parquet(path)


def alias_constitution(rows: DataFrame, suffix: str = "-dpo200") -> DataFrame:
    """The same rows a second time under a derived constitution name."""
    renamed = rows.withColumn("constitution", F.concat("constitution", F.lit(suffix)))
    return rows.unionByName(renamed)
