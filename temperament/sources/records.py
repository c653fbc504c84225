"""Which keys of a stored tree are finished: a small table beside the data, written after it.

A run that gave no rows leaves no file, and one that was stopped half-way leaves some. So what is finished is not read off the
data: each build adds its keys with their numbers of rows to a record, once their data lies there. What the record lacks is
built again and takes the place of whatever a stopped build has left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from temperament.operators.joins import unmatched
from temperament.session import settle
from temperament.sources.files import path_exists

RECORD = "_finished"  # readers skip names that begin so
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def listed_keys(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Distinct key values of a tree of ``key=value`` folders, as strings, from the listing of its files; none is read."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")

    def value(key: str):
        # a plus stands for itself in a folder's name
        raw = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
        return F.when(raw != NO_VALUE, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).alias(key)

    return paths.select(*[value(key) for key in keys]).distinct()


def finished(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The recorded keys and their ``rows``; none before the first build."""
    path, schema = f"{root}/{RECORD}", StructType([*[StructField(k, StringType()) for k in keys], StructField("rows", LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def due_keys(spark: SparkSession, root: str, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``wanted`` that the record lacks, written down so that they stay the same while they are built."""
    return settle(unmatched(wanted.select(*keys).distinct(), finished(spark, root, keys), keys), "due-keys")


def _remove(spark: SparkSession, root: str, keys: list[str], row) -> None:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = "/".join(f"{k}={escape(row[k])}" for k in keys)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_finished(rows: DataFrame, root: str, due: DataFrame, keys: list[str], write) -> None:
    """Write the rows of the ``due`` keys below ``root`` and record these keys.

    ``write`` adds a frame to the tree. What lies there of due keys is left from a build that was stopped, and goes first.
    """
    spark = rows.sparkSession
    if path_exists(spark, root):
        left = listed_keys(spark, root, keys).join(due, keys, "left_semi")
        for row in left.toLocalIterator():  # folders, not rows, and only those of a stopped build
            _remove(spark, root, keys, row)
    write(rows)
    record(spark, root, due, keys)


def record(spark: SparkSession, root: str, due: DataFrame, keys: list[str]) -> None:
    """Add the due keys, whose data is written, to the record. Lines are counted, not parsed."""
    counts = spark.createDataFrame([], due.schema).withColumn("rows", F.lit(0).cast("long"))
    if path_exists(spark, root) and not due.isEmpty():
        # no column is asked for, and the folders of other keys are pruned
        lines = spark.read.schema(due.schema).option("basePath", root).json(root)
        counts = lines.join(F.broadcast(due) if due.count() <= 10_000 else due, keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("rows"))
    counted = due.join(counts, keys, "left").select(*keys, F.coalesce("rows", F.lit(0)).alias("rows"))
    counted.coalesce(1).write.mode("append").parquet(f"{root}/{RECORD}")
