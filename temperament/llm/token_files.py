"""Token ids as Parquet list columns that can be read in part.

Documents are written in ascending order of doc_id, a file per range of ids. The writer's second format version without
dictionary packs the ids and positions by delta encoding; row groups and pages have set sizes, and the page index
lets a reader skip to the pages of the ids it wants. Sizes and positions stand in columns of their own,
so that they are read without any token.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from temperament.llm.arrays import worker_memo
from temperament.llm.bpe import byte_symbols
from temperament.llm.scratch import by_size, small_batches
from temperament.llm.subwords import encode_texts, word_memory

END_ID = 0
#: Writer settings: bytes of a row group and of a page, and which columns may use a dictionary.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}
#: Words of letters whose characters all libraries class alike, with the space before them.
PLAIN = re.compile("[ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _encoder(text: str, name: bytes):
    """The library's tokenizer in this worker, as a function from words to ids."""
    key = "tokenizer-" + name.hex()
    tokenizer = worker_memo().get(key)
    if tokenizer is None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_str(text)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        worker_memo()[key] = tokenizer
    apart = tokenizer.encode("\n", add_special_tokens=False).ids
    # the same model for words whose bytes already are the symbols of the vocabulary, set apart by that of the line end
    symbols = dict(enumerate(byte_symbols()))
    by_lines = Tokenizer(tokenizer.model)
    by_lines.pre_tokenizer = pre_tokenizers.Split(symbols[ord("\n")], "isolated")
    cut_alike = tokenizer.normalizer is None and isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)

    def one_by_one(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def as_lines(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters as lines of one text: the library splits at the line ends, whose token is in no word."""
        if cut_alike and len(apart) == 1 and words:
            text = ("\n" + "\n".join(words) + "\n").encode().decode("latin1").translate(symbols)
            [lines] = by_lines.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(lines.ids, np.int32)
            ends = np.flatnonzero(ids == apart[0])
            sizes = np.diff(ends) - 1
            if len(sizes) == len(words) and sizes.min() > 0 and ends[0] == 0 and ends[-1] == len(ids) - 1:
                return ids[ids != apart[0]], sizes
        return one_by_one(words)

    def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        places = np.append(np.flatnonzero(plain), np.flatnonzero(~plain))
        flats, sizes = zip(as_lines([words[i] for i in np.flatnonzero(plain)]), one_by_one([words[i] for i in np.flatnonzero(~plain)]))
        flat, found = np.concatenate(flats), np.concatenate(sizes)
        begins = np.cumsum(found) - found
        order = np.argsort(places)
        found = found[order]
        moved = np.repeat(begins[order] - (np.cumsum(found) - found), found)
        return flat[moved + np.arange(len(flat))], found

    special = {str(t): i for i, t in tokenizer.get_added_tokens_decoder().items()}
    special = {tokenizer.id_to_token(i): i for i in special.values()}
    return encode_words, special


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, files: int | None = None) -> None:
    """Encode the whole texts of `docs` (doc_id, text) with the library's tokenizer and write them to `path`.

    Columns of the files: doc_id, file_no, place (tokens before the document in its file), n_tokens (with the end id), ids.
    Null texts count as empty and have the end id alone. Rows that repeat a doc_id stand next to each other; a null doc_id comes first.
    An equal pre-token always has equal ids, so each distinct one is given to the tokenizer once while a worker remembers it.
    """
    import hashlib

    small_batches(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:  # the vocabulary is read by the driver alone
        text = file.read()
    name = hashlib.sha256(b"library" + text.encode()).digest()
    shared = docs.sparkSession.sparkContext.broadcast(text)  # some MB, whatever the corpus

    def run(batches):
        encode_words, special = _encoder(shared.value, name)
        place = 0
        for batch in batches:
            ids = encode_texts([t or "" for t in batch.column("text").to_pylist()], encode_words, word_memory(name), special)
            sizes = np.array([len(x) + 1 for x in ids], np.int64)
            offsets = np.cumsum(np.append(0, sizes))
            flat = np.full(offsets[-1], end_id, np.int32)
            body = np.ones(offsets[-1], bool)
            body[offsets[1:] - 1] = False
            flat[body] = np.concatenate([np.zeros(0, np.int32), *ids])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(place + offsets[:-1], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                names=["doc_id", "place", "n_tokens", "ids"],
            )
            place += int(offsets[-1])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_range = rows.repartitionByRange(files, "doc_id") if files else rows.repartitionByRange("doc_id")
    tokens = by_range.sortWithinPartitions("doc_id").mapInArrow(run, "doc_id bigint, place bigint, n_tokens bigint, ids array<int>")
    tokens = tokens.withColumn("file_no", F.spark_partition_id())
    tokens.select("doc_id", "file_no", "place", "n_tokens", "ids").write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written tokens: doc_id, start (ids of all documents before it), n_tokens, ids.

    Filters on doc_id reach the page index; without `ids` in the selection no token is read.
    """
    tokens = spark.read.parquet(path)
    files = tokens.groupBy("file_no").agg(F.sum("n_tokens").alias("tokens"))
    # one row per file
    before = F.sum("tokens").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file_no", F.coalesce(before, F.lit(0)).alias("base"))
    tokens = tokens.join(by_size(files, 16), "file_no")
    return tokens.select("doc_id", (F.col("base") + F.col("place")).cast("long").alias("start"), "n_tokens", "ids")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens of the stored tokens, and ids_crc32 of their ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat, offsets = lists.values.to_numpy().astype("<u4", copy=False), lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            made = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*made, pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
