"""Byte-pair encoding in batched numpy merge rounds, and decoding.

The symbols of many words stand in one flat array. A round looks up all adjacent pairs by binary search over the
sorted pair keys, finds the lowest rank of every word, merges all its occurrences in all words at once, and
sets words without a known pair aside. As many rounds are made as the most merged word needs.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.llm.scratch import Shipped, releasing, small_batches
from temperament.llm.subwords import encode_texts, word_memory

NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one after U+00FF in the order of bytes."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class MergeTables:
    """Arrays made from a byte-level vocabulary file."""

    def __init__(self, text: str):
        data = json.loads(text)
        vocabulary = data["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.size = max(vocabulary.values()) + 1
        symbols = byte_symbols()
        back = {symbol: byte for byte, symbol in enumerate(symbols)}
        self.byte_id = np.array([vocabulary[s] for s in symbols], np.int32)
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int32)[order]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        top = max([self.size - 1, *self.special.values()])
        self.pieces = [b""] * (top + 1)
        for token, number in vocabulary.items():
            if token not in self.special:
                self.pieces[number] = bytes(back[c] for c in token)
        for token, number in self.special.items():
            self.pieces[number] = token.encode()
        self.name = hashlib.sha256(text.encode()).digest()

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after the other, and how many each word has."""
        raw = [w.encode() for w in words]
        symbols = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            pairs = symbols[:-1].astype(np.int64) * self.size + symbols[1:]
            pairs[starts[1:] - 1] = -1
            at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            rank = np.full(len(symbols), NO_RANK, np.int32)
            rank[:-1] = np.where(self.keys[at] == pairs, self.ranks[at], NO_RANK)
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.append(starts, len(symbols))))
            ended = lowest == NO_RANK
            chosen = np.flatnonzero((rank == lowest) & ~ended)
            # of overlapping occurrences (the pair of a symbol with itself) every second one counts, from the left
            run = np.cumsum(np.append(True, np.diff(chosen) != 1))
            place = np.arange(len(chosen)) - np.searchsorted(run, run) if len(chosen) else chosen
            chosen = chosen[place % 2 == 0]
            symbols[chosen] = self.merged[at[chosen]]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            if ended.any():
                done.append((word[ended], symbols[ended]))
                keep &= ~ended
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return encode_texts(texts, self.merge_words, word_memory(self.name), self.special)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _shared(spark, path: str):
    """The tables on every executor; their size is that of the vocabulary, some MB."""
    small_batches(spark)
    with open(path, encoding="utf-8") as file:  # the vocabulary is read by the driver alone
        return Shipped(spark, MergeTables(file.read()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`docs` with a column `ids` (array of int): the tokens of `text` under the vocabulary file at `path`.

    A null text counts as empty and has no ids. A column `ids` of the input is replaced; all others stay.
    """
    docs = docs.drop("ids")
    tables, at = _shared(docs.sparkSession, path), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            ids = tables.value.encode([t or "" for t in batch.column(at).to_pylist()])
            offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], names=[*batch.schema.names, "ids"])

    return docs.mapInArrow(releasing(run), docs.withColumn("ids", F.lit(None).cast("array<int>")).schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """`tokens` with a column `text` made from `ids`; null ids give an empty text. A column `text` of the input is replaced."""
    tokens = tokens.drop("text")
    tables, at = _shared(tokens.sparkSession, path), tokens.columns.index("ids")

    def run(batches):
        for batch in batches:
            texts = [tables.value.decode(np.array(ids or [], np.int32)) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    return tokens.mapInArrow(releasing(run), tokens.withColumn("text", F.lit(None).cast("string")).schema)


def encode_checked(docs: DataFrame, path: str) -> DataFrame:
    """`docs` without `text`, with n_tokens, ids and restored (whether decoding the ids gives the text again).

    A null text counts as empty. Input columns of these three names are replaced; all others stay.
    """
    docs = docs.drop("n_tokens", "ids", "restored")
    tables, at = _shared(docs.sparkSession, path), docs.columns.index("text")
    keep = [i for i in range(len(docs.columns)) if i != at]

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            ids = tables.value.encode(texts)
            offsets = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            made = [
                pa.array(np.diff(offsets), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                pa.array([tables.value.decode(x) == t for x, t in zip(ids, texts)], pa.bool_()),
            ]
            names = [batch.schema.names[i] for i in keep]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], *made], names=[*names, "n_tokens", "ids", "restored"])

    made = {"n_tokens": "bigint", "ids": "array<int>", "restored": "boolean"}
    schema = docs.drop("text").withColumns({name: F.lit(None).cast(kind) for name, kind in made.items()}).schema
    return docs.mapInArrow(releasing(run), schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes the whole text, decodes the ids, and digests both, so that no ids leave the task. A null text counts as empty.
    """
    tables = _shared(docs.sparkSession, path)

    def run(batches):
        numbers = [str(i).encode() for i in range(len(tables.value.pieces))]
        for batch in batches:
            ids = tables.value.encode([t or "" for t in batch.column(1).to_pylist()])
            lists = [b",".join([numbers[i] for i in x.tolist()]) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in lists], pa.string()),
                    pa.array([hashlib.sha256(tables.value.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(releasing(run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
