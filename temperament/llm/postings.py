"""Benchmark decontamination by a positional inverted index that is spread over all tasks.

The corpus is cut into segments of at most 65,536 words. A segment stores, for each of its terms, the sorted list
of positions, and where its documents begin. Test phrases go to every segment in blocks of bounded size. There the
lists of a phrase's terms are taken from the rarest to the most common one, each shifted by the term's place in the
phrase, and intersected: what is left are the exact matches. Proximity matches ask for all words of a phrase within a number of positions.
No list of a term is ever collected over the corpus, so a word that is in every document is no hot key.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from temperament.llm.scratch import Shipped, by_size, small_batches
from temperament.llm.words import LETTERS_AND_DIGITS, words
from temperament.session import settle

#: Positions of a segment; they are stored in two bytes.
SEGMENT = 1 << 16
#: Words that pieces of one document share, so that a match up to one word longer lies in one of them.
OVERLAP = 255
#: Bytes of phrases that a task holds at once.
BLOCK_BYTES = 4 << 20

INDEX = """terms binary, counts binary, positions binary, rows array<bigint>, doc_ids array<bigint>, begins array<int>,
    skipped array<bigint>, sizes array<int>"""


def _documents(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The hashes of the words of every text."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for _, _, _, hashes, owners in words(texts, LETTERS_AND_DIGITS):
        firsts = np.flatnonzero(np.diff(owners, prepend=-1))
        for owner, part in zip(owners[firsts].tolist(), np.split(hashes, firsts[1:])):
            found[owner].append(part)
    return [np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.uint64) for x in found]


class _Segment:
    """Documents and pieces of documents until their words fill a segment."""

    def __init__(self):
        self.pieces, self.used = [], 0

    def add(self, row: int, doc_id: int | None, skipped: int, hashes: np.ndarray) -> None:
        self.pieces.append((row, doc_id, self.used, skipped, hashes))
        self.used += len(hashes) + 1  # one position stays free, so that no match runs into the next document

    def row(self) -> pa.RecordBatch:
        rows, ids, begins, skipped, parts = zip(*self.pieces)
        hashes = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts])
        places = np.arange(len(hashes)) + np.repeat(np.arange(len(parts)), sizes)
        order = np.argsort(hashes, kind="stable")
        terms, counts = np.unique(hashes, return_counts=True)
        lists = [terms.astype("<u8").tobytes(), counts.astype("<u4").tobytes(), places[order].astype("<u2").tobytes()]
        return pa.RecordBatch.from_arrays(
            [
                *[pa.array([x], pa.binary()) for x in lists],
                pa.array([rows], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())), pa.array([begins], pa.list_(pa.int32())),
                pa.array([skipped], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int32())),
            ],
            names=["terms", "counts", "positions", "rows", "doc_ids", "begins", "skipped", "sizes"],
        )


def index(docs: DataFrame) -> DataFrame:
    """The stored index over the whole texts of `docs` (doc_id, text); a row per segment, schema `INDEX`.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case; they are compared by
    64-bit hashes. Every row of `docs` is in it under a number of its own, also with a null or empty text, and with a
    doc_id that is null or repeats. Other columns are ignored.
    """

    def run(batches):
        segment = _Segment()
        for batch in batches:
            rows, ids = (batch.column(c).to_pylist() for c in ("row", "doc_id"))
            for row, doc_id, hashes in zip(rows, ids, _documents(batch)):
                if segment.used and segment.used + len(hashes) + 1 > SEGMENT:
                    yield segment.row()
                    segment = _Segment()
                at = 0
                while len(hashes) - at + 1 > SEGMENT:
                    segment.add(row, doc_id, at, hashes[at : at + SEGMENT - 1])
                    yield segment.row()
                    segment, at = _Segment(), at + SEGMENT - 1 - OVERLAP
                segment.add(row, doc_id, at, hashes[at:])
        if segment.pieces:
            yield segment.row()

    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(rows.mapInArrow(run, INDEX), "postings")


def documents(stored: DataFrame) -> DataFrame:
    """row, doc_id and n_words of every document of an index."""
    pieces = stored.select(F.inline(F.arrays_zip("rows", "doc_ids", "skipped", "sizes")))
    # a document's last piece tells how many words there are
    return pieces.groupBy(F.col("rows").alias("row"), F.col("doc_ids").alias("doc_id")).agg(
        F.max(F.col("skipped") + F.col("sizes")).cast("long").alias("n_words")
    )


def phrases(items: DataFrame, item: str, width: int) -> DataFrame:
    """The phrases of the texts of `items`, stored: phrase (an id that equal ones share), words, item.

    Every run of `width` words is a phrase; a text with fewer words is one, a text without words has none.
    """
    if not 0 < width <= OVERLAP + 1:
        raise ValueError(f"phrases have 1 to {OVERLAP + 1} words")

    def run(batches):
        for batch in batches:
            keys, packed, owners = [], [], []
            for owner, hashes in zip(batch.column("item").to_pylist(), _documents(batch)):
                span = min(width, len(hashes))
                if span:
                    runs = np.unique(np.lib.stride_tricks.sliding_window_view(hashes, span), axis=0).astype("<u8")
                    packed += [r.tobytes() for r in runs]
                    owners += [owner] * len(runs)
            keys = [hashlib.blake2b(p, digest_size=16).digest() for p in packed]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(packed, pa.binary()), pa.array(owners, pa.string())], names=["phrase", "words", "item"]
            )

    texts = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), "text")
    return settle(texts.mapInArrow(run, "phrase binary, words binary, item string").distinct(), "phrases")


def _lists(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """Terms of a segment, the first place and the number of their positions, and the positions."""
    terms, counts, places = (batch.column(c)[i].as_buffer() for c in ("terms", "counts", "positions"))
    counts = np.frombuffer(counts, "<u4").astype(np.int64)
    return np.frombuffer(terms, "<u8"), np.cumsum(counts) - counts, counts, np.frombuffer(places, "<u2").astype(np.int64)


def _table(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of the phrases, and a row of term numbers per phrase, -1 beyond its end."""
    parts = [np.frombuffer(p, "<u8") for p in packed]
    terms, numbers = np.unique(np.concatenate(parts), return_inverse=True)
    sizes = np.array([len(p) for p in parts])
    table = np.full((len(parts), sizes.max()), -1, np.int64)
    table[np.arange(table.shape[1]) < sizes[:, None]] = numbers
    return terms, table


def _find(terms, firsts, counts, places, wanted: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of all exact matches in a segment: shifted lists, intersected from the rarest on."""
    none = np.zeros(0, np.int64)
    if not len(terms):
        return none, none
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    held = np.where(terms[at] == wanted, counts[at], 0)
    absent = np.int64(SEGMENT + 1)  # sorts behind all counts
    sizes = np.where(table >= 0, held[table], absent)
    alive = np.flatnonzero(sizes.min(axis=1) > 0)
    if not len(alive):
        return none, none
    order = np.argsort(sizes[alive], axis=1, kind="stable")
    lengths = (table[alive] >= 0).sum(axis=1)
    listed = at[table[alive]]  # the segment's number of every term
    keys = np.repeat(np.arange(len(terms)), counts) * SEGMENT + places  # ascending
    rarest = listed[np.arange(len(alive)), order[:, 0]]
    repeats = counts[rarest]
    which = np.repeat(np.arange(len(alive)), repeats)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
    start = places[firsts[rarest][which] + offset] - order[which, 0]
    for step in range(1, table.shape[1]):
        place = order[which, step]
        spot = start + place
        key = listed[which, place] * SEGMENT + spot
        found = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
        keep = (start >= 0) & (spot < SEGMENT) & (found | (lengths[which] <= step))
        which, start = which[keep], start[keep]
    keep = start >= 0
    return alive[which[keep]], start[keep]


def _near(terms, firsts, counts, places, begins: np.ndarray, wanted: np.ndarray, table: np.ndarray, span: int):
    """(phrase, start, stop) of the shortest stretches of at most `span` words of a document with all words of a phrase."""
    for number, row in enumerate(table):
        own, times = np.unique(row[row >= 0], return_counts=True)
        at = np.searchsorted(terms, wanted[own])
        if (at >= len(terms)).any() or (terms[at] != wanted[own]).any() or (counts[at] < times).any():
            continue
        lists = [places[firsts[a] : firsts[a] + counts[a]] for a in at]
        rare = lists[int(np.argmin([len(x) for x in lists]))]
        starts = np.unique(np.concatenate(lists))
        # a stretch holds an occurrence of the rarest word
        next_rare = np.searchsorted(rare, starts)
        starts = starts[(next_rare < len(rare)) & (rare[np.minimum(next_rare, len(rare) - 1)] - starts < span)]
        stops = np.zeros(len(starts), np.int64)
        for held, count in zip(lists, times):
            last = np.searchsorted(held, starts) + count - 1
            stops = np.maximum(stops, np.where(last < len(held), held[np.minimum(last, len(held) - 1)], 2 * SEGMENT + span))
        same = np.searchsorted(begins, starts, "right") == np.searchsorted(begins, stops, "right")
        fits = (stops - starts < span) & same
        starts, stops = starts[fits], stops[fits]
        shortest = np.append(stops[1:] > stops[:-1], True) if len(stops) else np.zeros(0, bool)
        for a, b in zip(starts[shortest].tolist(), stops[shortest].tolist()):
            yield number, a, b + 1


def matches(stored: DataFrame, asked: DataFrame, within: int | None = None) -> DataFrame:
    """Where the phrases stand in the documents of an index: row, phrase, start, stop (positions of words, stop excluded).

    Without `within` these are the exact matches. With it, the shortest stretches of at most that many words of a document
    that hold all words of a phrase, as often as it does and in any order; no longer than pieces of a document overlap.
    The phrases are sent out in blocks of at most `BLOCK_BYTES`, whatever their number.
    """
    if within is not None and not 0 < within <= OVERLAP + 1:
        raise ValueError(f"stretches have 1 to {OVERLAP + 1} words")
    distinct = asked.groupBy("phrase").agg(F.first("words").alias("words"))
    # keys, words, their numbers and the lists made of them
    size = distinct.agg(F.sum(F.octet_length("words") * 4 + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    distinct = settle(distinct.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks))), "phrase-blocks")
    kind = "row bigint, phrase binary, start bigint, stop bigint"

    def search(block: Shipped):
        def run(batches):
            keys, packed = block.value
            wanted, table = _table(packed)
            lengths = (table >= 0).sum(axis=1)
            for batch in batches:
                for i in range(batch.num_rows):
                    lists = _lists(batch, i)
                    begins = batch.column("begins")[i].values.to_numpy()
                    rows, skipped = (batch.column(c)[i].values.to_numpy() for c in ("rows", "skipped"))
                    if within is None:
                        which, start = _find(*lists, wanted, table)
                        stop = start + lengths[which]
                    else:
                        which, start, stop = (np.array(x, np.int64) for x in zip(*_near(*lists, begins, wanted, table, within)) or ([], [], []))
                    if not len(which):
                        continue
                    piece = np.searchsorted(begins, start, "right") - 1
                    moved = skipped[piece] - begins[piece]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows[piece], pa.int64()), pa.array([keys[w] for w in which.tolist()], pa.binary()),
                            pa.array(start + moved, pa.int64()), pa.array(stop + moved, pa.int64()),
                        ],
                        names=["row", "phrase", "start", "stop"],
                    )

        return run

    spark, found = stored.sparkSession, None
    for number in range(blocks):
        held = distinct.where(F.col("block") == number).select("phrase", "words").collect()  # bounded by BLOCK_BYTES, about
        if held:
            block = Shipped(spark, ([bytes(r["phrase"]) for r in held], [bytes(r["words"]) for r in held]))
            part = settle(stored.mapInArrow(search(block), kind), "phrase-matches")
            found = part if found is None else found.unionByName(part)
    found = spark.createDataFrame([], kind) if found is None else found
    return found.distinct()  # the words that two pieces share are found in both


def contamination(docs: DataFrame, items: DataFrame, item: str = "item_id", width: int = 10) -> DataFrame:
    """Per row of `docs` (doc_id, text): row, doc_id, n_words, n_hit, n_items, items, contaminated.

    A word is hit if it lies in an exact match of a phrase of `items` (`item`, text); see `phrases`. `items` are the ids, as text in
    ascending order, of the items with such phrases, each once; a null id is written as the empty text. Null and empty
    texts have no words and are clean. Without items, or without documents, nothing is hit.
    """
    stored = index(docs)
    asked = phrases(items, item, width)
    found = settle(matches(stored, asked), "contamination")
    reached: Column = F.max("stop").over(Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(reached, F.lit(0))))
    hit = found.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    owners = by_size(asked.select("phrase", "item"), 64)
    held = found.select("row", "phrase").distinct().join(owners, "phrase").select("row", "item").distinct()
    listed = held.groupBy("row").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    per_row = settle(hit.join(listed, "row"), "contaminated-rows")
    joined = documents(stored).join(per_row, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "row", "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"),
    )
