"""Merkle fixity audit of web archives: hash records and ordered ranges into trees, compare replicas from the root down.

A record has a key (page_id) and an offset in the file of its range. The hash of a key covers its records, the hash
of a range the hashes of its 16 parts in order, level by level up to the roots. Two replicas are compared root by
root; only below nodes that differ are the next ones looked at, down to the damaged keys and their byte ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temperament.llm.scratch import by_size
from temperament.session import settle

#: Keys of a file, and levels of ranges above the keys; a node has 16 parts.
FILE_BITS, LEVELS, PART_BITS = 12, 4, 4


def records(pages: DataFrame) -> DataFrame:
    """Archive records of `pages` (page_id, url, html): key, digest, copies, length, file_no, record_offset.

    A record is header lines, a blank line and the payload; null url or html count as empty. Files hold the ranges of 4096
    keys, records in the order of key and digest. Records without page_id get keys below zero by their content.
    Rows that repeat key and content are one record with copies, which stand one after the other.
    """
    html = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    record = F.concat(head, html, F.lit("\r\n\r\n"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.sha2(record, 256).alias("digest"), F.octet_length(record).cast("long").alias("length")
    )
    key = F.coalesce("page_id", -1 - F.pmod(F.xxhash64("digest"), F.lit(1 << 40)))
    rows = rows.groupBy(key.alias("key"), "digest").agg(F.count("*").alias("copies"), F.max("length").alias("length"))
    rows = rows.withColumn("file_no", F.shiftright("key", FILE_BITS))
    before = Window.partitionBy("file_no").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("record_offset", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0)))


def tree(stored: DataFrame, name: str) -> list[DataFrame]:
    """The levels of a replica's tree, keys first: (node, hash), each written to the shared folder."""
    each = F.sha2(F.concat_ws("|", "digest", "copies"), 256)
    words = [F.bit_xor(F.conv(F.substring(each, 1 + 12 * i, 12), 16, 10).cast("long")) for i in range(5)]
    # the records of one key are combined without an order, so that a key with very many needs no list
    level = stored.groupBy(F.col("key").alias("node")).agg(F.sha2(F.concat_ws("|", F.count("*"), *words), 256).alias("hash"))
    levels = [settle(level, f"fixity-{name}-0")]
    for height in range(1, LEVELS + 1):
        part = F.struct(F.col("node").alias("at"), "hash")
        parts = F.array_sort(F.collect_list(part))  # 16 at most
        joined = F.concat_ws("|", F.transform(parts, lambda p: F.concat_ws(":", p["at"], p["hash"])))
        level = levels[-1].groupBy(F.shiftright("node", PART_BITS).alias("up")).agg(F.sha2(joined, 256).alias("hash"))
        levels.append(settle(level.withColumnRenamed("up", "node"), f"fixity-{name}-{height}"))
    return levels


def differing(one: list[DataFrame], two: list[DataFrame]) -> DataFrame:
    """The keys (node) whose hashes differ or that one replica lacks, found from the roots down."""
    found = None
    for a, b in zip(reversed(one), reversed(two)):
        if found is not None:
            above = by_size(found.withColumnRenamed("node", "up"), 16)
            a, b = (x.join(above, F.shiftright(x["node"], PART_BITS) == above["up"], "left_semi") for x in (a, b))
        pairs = a.withColumnRenamed("hash", "first").join(b.withColumnRenamed("hash", "second"), "node", "full")
        found = settle(pairs.where(~F.col("first").eqNullSafe(F.col("second"))).select("node"), "fixity-differing")
    return found


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """One row per damaged key of two page tables: page_id, status, and where its records lie in either replica.

    status is changed, missing (in the replica) or extra (only there). Offset and length are those of the first byte and of
    all records of the key; null where there is none. Equal replicas, also empty ones, give no rows. page_id is null for
    records without one, whose keys come from their content, so that damage shows as missing and extra.
    """
    sides = [settle(records(pages), f"fixity-records-{name}") for name, pages in (("primary", primary), ("replica", replica))]
    damaged = by_size(differing(*(tree(side, name) for side, name in zip(sides, ("primary", "replica")))), 16)
    places = []
    for side, name in zip(sides, ("record", "replica")):
        place = side.join(damaged, side["key"] == damaged["node"], "left_semi").groupBy("key").agg(
            F.min("file_no").alias(f"{name}_file"), F.min("record_offset").alias(f"{name}_offset"),
            F.sum(F.col("length") * F.col("copies")).alias(f"{name}_length"),
        )
        places.append(place)
    status = F.when(F.col("replica_offset").isNull(), "missing").when(F.col("record_offset").isNull(), "extra").otherwise("changed")
    return places[0].join(places[1], "key", "full").select(
        F.when(F.col("key") >= 0, F.col("key")).alias("page_id"), status.alias("status"),
        F.coalesce("record_file", "replica_file").alias("file_no"),
        "record_offset", "record_length", "replica_offset", "replica_length",
    )
