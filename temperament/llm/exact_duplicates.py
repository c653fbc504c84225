"""Exact duplicates through a stateful stream; DataFrame operations only.

Arriving rows are reduced to a digest of their text, their id and a locator of the content. A streaming
aggregation keeps one entry per digest in a disk-backed store (RocksDB), without expiry: a copy is found
however much later it arrives. A digest that was seen before is a hit; the full texts of hits are compared
before they count as copies.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.llm.scratch import by_size, in_pieces
from temperament.session import scratch_path, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a store per shuffle partition: files are not made larger than what they hold
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all stores of an executor share one bound on their buffers and caches; the rest is on disk
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # stores are closed when their task ends; otherwise executors keep them open, outside the heap, long after the stream
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    # in pure ASCII the fast built-in changes the same letters
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


@contextmanager
def _store(spark: SparkSession):
    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def digests(docs: DataFrame, digest=lambda text: F.unhex(F.sha2(text, 256))) -> DataFrame:
    """doc_id, row, digest and the content's locator (file and row in it; null where docs is no stored table)."""
    try:
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        none = (F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("long").alias("row_index"))
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *none)
    return docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), digest(ascii_lower(F.col("text"))).alias("digest"),
        F.struct("file_path", "row_index").alias("locator"),
    )


def seen(stream: DataFrame, checkpoint: str) -> DataFrame:
    """Bring the state in `checkpoint` up to date with the stream of digests; a later call goes on from there.

    Returns per digest: keep_id (the largest doc_id so far), keep_row, locator of that content, group_size.
    """
    spark = stream.sparkSession
    with _store(spark):
        state = stream.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row", "locator")).alias("keep"), F.count("*").alias("group_size")
        )
        writer = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        stored = spark.read.format("statestore").load(checkpoint)
        kept, size = (f"value.`{name}`" for name in stored.schema["value"].dataType.names[:2])
        stored = stored.selectExpr("key.digest", f"{kept} AS keep", f"{size} AS group_size")
        return settle(
            stored.select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "keep.locator", "group_size"),
            "exact-state",
        )


def exact_duplicates(docs: DataFrame, digest=lambda text: F.unhex(F.sha2(text, 256))) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, row.

    Texts are equal if identical after lower-casing A-Z; null counts as empty. Of equal texts the row with
    the largest doc_id stays, of rows that repeat an id one of them. A null doc_id counts as the smallest. Other
    columns are ignored. `row` is unique per row of this result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "exact-arrivals")
    digests(docs, digest).withColumn("text_sha256", F.lower(F.hex("digest"))).write.parquet(path)
    arrivals = spark.read.parquet(path)
    stream = spark.readStream.schema(arrivals.schema).parquet(path).select("doc_id", "row", "digest", "locator")
    state = seen(stream, scratch_path(spark, "exact-checkpoint"))

    hits = state.where("group_size > 1").select("digest", "keep_id", "keep_row", "group_size")
    hits = by_size(settle(hits, "exact-hits"), 64)
    result = arrivals.join(hits, "digest", "left").select(
        "doc_id", "row", "digest", "text_sha256",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), True).otherwise(F.col("row") == F.col("keep_row")).alias("kept"),
    )

    # full texts of the hits: a digest with several texts is split by text
    hit_ids = arrivals.join(hits, "digest", "left_semi").select("doc_id").distinct()
    hit_ids = settle(in_pieces(hit_ids, arrivals.count(), 16), "exact-hit-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(F.col("text")).alias("text"))
    texts = texts.join(by_size(hit_ids, 16), texts["doc_id"].eqNullSafe(hit_ids["doc_id"]), "left_semi")
    texts = texts.withColumn("digest", digest(F.col("text"))).join(hits.select("digest"), "digest", "left_semi")
    several = texts.groupBy("digest", "text").agg(F.count("*")).groupBy("digest").count().where("count > 1")
    several = settle(several.select("digest"), "exact-collisions")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "row"]
    if several.isEmpty():
        return result.select(columns)
    split = texts.join(several, "digest", "left_semi").groupBy("digest", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    clashing = result.join(several, "digest", "left_semi").select("doc_id", "row", "digest", "text_sha256")
    # the text of every row of a clashing digest; copies of one id and text are numbered to find their rows
    own = texts.join(several, "digest", "left_semi").groupBy("digest", "doc_id", "text").agg(F.count("*").alias("copies"))
    own = own.join(split, ["digest", "text"]).select(
        "digest", F.col("doc_id").alias("own_id"), "keep_id", "group_size", F.sha2("text", 256).alias("order"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    number = F.row_number().over
    from pyspark.sql import Window

    own = own.withColumn("number", number(Window.partitionBy("digest", "own_id").orderBy("order", "copy")))
    clashing = clashing.withColumn("number", number(Window.partitionBy("digest", "doc_id").orderBy("row")))
    same = (clashing["digest"] == own["digest"]) & clashing["doc_id"].eqNullSafe(own["own_id"]) & (clashing["number"] == own["number"])
    fixed = clashing.join(own, same).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        own["order"].alias("text_sha256"), "row",
    )
    return result.join(several, "digest", "left_anti").select(columns).union(fixed.select(columns))
