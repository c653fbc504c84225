"""How far the sources of a language differ in their words, counted over a minimal transducer of its vocabulary.

1. The words of whole texts are counted a chunk at a time. A chunk keeps each of its words once per language, with the number of
   its documents that hold it, and per source the numbers of its words and how often they occur.
2. Terms in enough documents of their language are kept, and get their places in the sorted vocabulary as ordinals.
3. The words of all chunks and the kept terms meet by ranges of terms. Each range builds a minimal acyclic transducer of its sorted
   kept terms and streams the words through it: those that it accepts come back with their ordinals.
4. The chunks are recounted by ordinals, in blocks of neighbouring ordinals, and each block compares all sources of its language.

Neither words nor the vocabulary are ever gathered in one place; a very common word is one row per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temperament.llm.numbering import numbered
from temperament.llm.scratch import by_size, small_batches
from temperament.llm.transducer import Builder
from temperament.llm.words import LETTERS, words
from temperament.session import settle

#: Words after which a chunk ends.
CHUNK_WORDS = 1 << 21
#: Counts that a block holds: its ordinals times the sources of the language.
BLOCK_CELLS = 1 << 22
BLOCK_ORDINALS = 1 << 14
SCALE = 1_000_000_000


def _gathered(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the spans, one after another."""
    moved = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return raw[moved + np.arange(len(moved))]


class _Chunk:
    """Words of some documents: their hashes, and the bytes of each distinct one."""

    def __init__(self):
        self.size, self.groups, self.documents = 0, {}, []
        self.hashes, self.owners = [], []
        self.known, self.sizes, self.bytes = [], [], []

    def add(self, groups: list[tuple[str, str]], found) -> None:
        first = len(self.documents)
        self.documents += [self.groups.setdefault(g, len(self.groups)) for g in groups]
        for raw, starts, ends, hashes, owners in found:
            distinct, where = np.unique(hashes, return_index=True)
            sizes = ends[where] - starts[where]
            self.known.append(distinct)
            self.sizes.append(sizes)
            self.bytes.append(_gathered(raw, starts[where], sizes))
            self.hashes.append(hashes)
            self.owners.append(owners.astype(np.int32) + np.int32(first))
            self.size += len(hashes)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        # the distinct words of the chunk, by hash, and their numbers in place of the hashes
        known, sizes = np.concatenate(self.known), np.concatenate(self.sizes)
        distinct, where = np.unique(known, return_index=True)
        begins = (np.cumsum(sizes) - sizes)[where]
        sizes, raw = sizes[where], np.concatenate(self.bytes)
        numbers = np.searchsorted(distinct, np.concatenate(self.hashes))
        owners, count = np.concatenate(self.owners), len(distinct)
        group_of = np.array(self.documents, np.int64)
        names = list(self.groups)
        langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in names))}
        lang_of = np.array([langs[lang] for lang, _ in names], np.int64)

        held = np.unique(owners.astype(np.int64) * count + numbers)  # document and word
        cells, documents = np.unique(lang_of[group_of[held // count]] * count + held % count, return_counts=True)
        for lang, at in langs.items():
            low, high = np.searchsorted(cells, [at * count, (at + 1) * count])
            if low == high:
                continue
            ids = cells[low:high] % count
            flat = _gathered(raw, begins[ids], sizes[ids])
            offsets = np.append(0, np.cumsum(sizes[ids])).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(ids), pa.py_buffer(offsets), pa.py_buffer(flat))
            yield _batch(number, lang, len(ids), id=pa.array(ids, pa.int32()), term=terms, documents=pa.array(documents[low:high], pa.int64()))

        cells, times = np.unique(group_of[owners] * count + numbers, return_counts=True)
        edges = np.searchsorted(cells, np.arange(len(names) + 1) * count)
        for (lang, source), low, high in zip(names, edges[:-1], edges[1:]):
            if low < high:
                packed = [pa.array([x.tobytes()], pa.binary()) for x in ((cells[low:high] % count).astype("<i4"), times[low:high].astype("<i8"))]
                yield _batch(number, lang, 1, source=pa.array([source], pa.string()), ids=packed[0], times=packed[1])


CHUNKS = "chunk bigint, lang string, id int, term string, documents bigint, source string, ids binary, times binary"
KINDS = dict(id=pa.int32(), term=pa.string(), documents=pa.int64(), source=pa.string(), ids=pa.binary(), times=pa.binary())


def _batch(number: int, lang: str, size: int, **columns: pa.Array) -> pa.RecordBatch:
    made = [columns.get(name, pa.nulls(size, kind)) for name, kind in KINDS.items()]
    return pa.RecordBatch.from_arrays([pa.array([number] * size, pa.int64()), pa.array([lang] * size, pa.string()), *made], names=["chunk", "lang", *KINDS])


def counted(docs: DataFrame) -> DataFrame:
    """The words of `docs` (text, lang, source; null is empty) by chunk, stored; schema `CHUNKS`.

    Rows with a term: a word of a chunk and language, its number in the chunk, and how many of the documents have it.
    Rows with a source: the numbers of the words of a group, and how often they occur in it.
    """

    def run(batches):
        chunk, number = _Chunk(), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            for at in range(0, len(groups), 256):
                chunk.add(groups[at : at + 256], words(texts[at : at + 256].to_pylist(), LETTERS))
                if chunk.size >= CHUNK_WORDS:
                    yield from chunk.rows(number)
                    chunk, number = _Chunk(), number + 1
        yield from chunk.rows(number)

    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("text", "lang", "source")])
    chunks = rows.mapInArrow(run, CHUNKS)
    return settle(chunks.withColumn("chunk", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("chunk")), "divergence-chunks")


def vocabulary(chunks: DataFrame, least: int) -> DataFrame:
    """The kept terms, stored: lang, term, ordinal from 0 in the order of their UTF-8 bytes."""
    terms = chunks.where(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.sum("documents").alias("documents"))
    kept = settle(terms.where(F.col("documents") >= least).select("lang", "term"), "divergence-kept")
    return settle(numbered(kept, ["lang"], ["term"], "ordinal", "divergence"), "divergence-vocabulary")


def _runs(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The stretches of rows with equal values of the columns, in order."""
    if not batch.num_rows:
        return
    changes = np.zeros(batch.num_rows, bool)
    changes[0] = True
    for name in names:
        codes = batch.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        changes[1:] |= codes[1:] != codes[:-1]
    edges = [*np.flatnonzero(changes).tolist(), batch.num_rows]
    for low, high in zip(edges[:-1], edges[1:]):
        part = batch.slice(low, high - low)
        yield tuple(part.column(name)[0].as_py() for name in names), part


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column, where its values start and where they stop."""
    column = column.cast(pa.binary())
    _, offsets, flat = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(flat or b"", np.uint8), offsets[:-1], offsets[1:]


def accepted(chunks: DataFrame, kept: DataFrame) -> DataFrame:
    """The words of the chunks that are kept terms: chunk, lang, id, ordinal.

    Kept terms and words are dealt out by the same ranges of (lang, term). A task reads the kept terms of its range first, in order, builds
    the transducer, and streams the words through it.
    """

    def run(batches):
        lang, builder, first, transducer = None, None, 0, None
        for batch in batches:
            for (own, is_word), part in _runs(batch, "lang", "is_word"):
                if own != lang:
                    lang, builder, transducer = own, None, None
                if not is_word:
                    if builder is None:
                        builder, first = Builder(), part.column("ordinal")[0].as_py()
                    for term in part.column("term").cast(pa.binary()).to_pylist():
                        builder.add(term)
                elif builder is not None:
                    if transducer is None:
                        transducer = builder.build()
                    places = transducer.places(*_spans(part.column("term")))
                    known = np.flatnonzero(places >= 0)
                    if len(known):
                        part = part.take(pa.array(known))
                        ordinals = pa.array(places[known] + first, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [part.column("chunk"), part.column("lang"), part.column("id"), ordinals], names=["chunk", "lang", "id", "ordinal"]
                        )

    no_long, no_int = F.lit(None).cast("long"), F.lit(None).cast("int")
    terms = kept.select("lang", F.lit(False).alias("is_word"), "term", "ordinal", no_long.alias("chunk"), no_int.alias("id"))
    found = chunks.where(F.col("term").isNotNull())
    found = found.select("lang", F.lit(True).alias("is_word"), "term", no_long.alias("ordinal"), "chunk", "id")
    met = terms.union(found).repartitionByRange("lang", "term").sortWithinPartitions("lang", "is_word", "term")
    return met.mapInArrow(run, "chunk bigint, lang string, id int, ordinal bigint")


def recounted(chunks: DataFrame, found: DataFrame, widths: DataFrame) -> DataFrame:
    """The counts of kept terms by blocks of ordinals, stored: lang, block, source, total, places (in the block), times.

    `widths` (lang, width) says how many ordinals a block of a language has.
    """

    def run(batches):
        key, numbers, ordinals = None, [], []
        for batch in batches:
            for (chunk, lang, packed), part in _runs(batch, "chunk", "lang", "packed"):
                if (chunk, lang) != key:
                    key, numbers, ordinals, places = (chunk, lang), [], [], None
                if not packed:
                    numbers.append(part.column("id").to_numpy())
                    ordinals.append(part.column("ordinal").to_numpy())
                    continue
                if not numbers:
                    continue
                if places is None:
                    ids = np.concatenate(numbers)
                    places = np.full(ids.max() + 1, -1, np.int64)
                    places[ids] = np.concatenate(ordinals)
                for row in part.to_pylist():
                    ids, times = np.frombuffer(row["ids"], "<i4"), np.frombuffer(row["times"], "<i8")
                    inside = ids < len(places)
                    ids, times = ids[inside], times[inside]
                    inside = places[ids] >= 0
                    at, times = places[ids[inside]], times[inside]
                    order = np.argsort(at)
                    at, times, width = at[order], times[order], row["width"]
                    blocks = at // width
                    firsts = np.flatnonzero(np.diff(blocks, prepend=-1))
                    ends = np.append(firsts[1:], len(at)).astype(np.int64)
                    if len(firsts):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(firsts)), pa.array(blocks[firsts], pa.int64()), pa.array([row["source"]] * len(firsts)),
                                pa.array([int(times[a:b].sum()) for a, b in zip(firsts, ends)], pa.int64()),
                                pa.array([(at[a:b] % width).astype("<i4").tobytes() for a, b in zip(firsts, ends)], pa.binary()),
                                pa.array([times[a:b].tobytes() for a, b in zip(firsts, ends)], pa.binary()),
                            ],
                            names=["lang", "block", "source", "total", "places", "times"],
                        )

    none = F.lit(None)
    ordinals = found.select(
        "chunk", "lang", F.lit(False).alias("packed"), "id", "ordinal",
        none.cast("string").alias("source"), none.cast("binary").alias("ids"), none.cast("binary").alias("times"), none.cast("int").alias("width"),
    )
    counts = chunks.where(F.col("source").isNotNull()).join(widths, "lang").select(
        "chunk", "lang", F.lit(True).alias("packed"), none.cast("int").alias("id"), none.cast("long").alias("ordinal"), "source", "ids", "times", "width"
    )
    met = ordinals.union(counts).repartition("chunk", "lang").sortWithinPartitions("chunk", "lang", "packed")
    kind = "lang string, block bigint, source string, total bigint, places binary, times binary"
    return settle(met.mapInArrow(run, kind), "divergence-counts")


def _share(counts: np.ndarray, whole) -> np.ndarray:
    """1 + floor(SCALE * (counts + 1) / whole), exact."""
    if counts.size and counts.max() >= (1 << 62) // SCALE:
        return (1 + SCALE * (counts.astype(object) + 1) // whole).astype(np.int64)
    return 1 + SCALE * (counts + 1) // whole


def _compared(lang: str, block: int, head: dict, counts: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    """Partial sums for all pairs of sources, and the best terms of each source, from a block's counts by source and ordinal."""
    names = [s["source"] for s in head["sources"]]
    wholes = np.array([s["total"] for s in head["sources"]], np.int64)[:, None] + head["terms"]
    shares, common = _share(counts, wholes), _share(counts.sum(axis=0), head["total"] + head["terms"])

    def batch(source: str, part: str, others: list, ordinals: list, values: np.ndarray) -> pa.RecordBatch:
        size = len(values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * size), pa.array([source] * size), pa.array([part] * size), pa.array(others, pa.string()),
                pa.array(ordinals, pa.int64()), pa.array(values, pa.int64()),
            ],
            names=["lang", "source", "part", "other", "ordinal", "value"],
        )

    for i, name in enumerate(names):
        apart = shares[i] - shares
        sums = (apart * apart // shares).sum(axis=1)
        if len(names) > 1:
            others = [j for j in range(len(names)) if j != i]
            yield batch(name, "pair", [names[j] for j in others], [None] * len(others), sums[others])
        more = np.flatnonzero((counts[i] > 0) & (shares[i] > common))
        values = (shares[i][more] - common[more]) ** 2 // common[more]
        if len(more) > top:
            limit = np.partition(values, len(values) - top)[len(values) - top]
            more, values = more[values >= limit], values[values >= limit]
        order = np.argsort(-values, kind="stable")[:top]  # equal ones stay in the order of their ordinals
        if len(order):
            yield batch(name, "term", [None] * len(order), (more[order] + block * head["width"]).tolist(), values[order])


def divergence(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """How the words of each source of a language differ from the other sources' and from the language's.

    lang, source, part, item, value, rank; null text, lang and source count as empty. Terms are runs of ASCII letters and of all characters
    beyond ASCII, A-Z in lower case; a language keeps those in at least `least` of its documents, V of them. A group with `count`
    of a term's occurrences and N of all kept terms' has the share p = 1 + floor(10^9 * (count + 1) / (N + V)). Two shares differ by
    floor((p - q)^2 / q). Part `pair`: every other source of the language with the sum of the differences from its shares (0 without
    kept terms). Part `term`: the `top` terms that the group has with a share above the language's. Ranks count from 1 by value, largest first,
    equal values by the bytes of the item; in `term` the ordinals of the vocabulary stand for these. Groups without words are there
    too. Only these three columns of `docs` are read; repeated rows count each. No rows give none.
    """
    spark = docs.sparkSession
    names = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")]
    groups = settle(docs.select(*names).distinct(), "divergence-groups")
    chunks = counted(docs)
    kept = vocabulary(chunks, least)
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    langs = sizes.join(terms, "lang", "left").select("lang", "sources", F.coalesce("terms", F.lit(0)).alias("terms"))
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ORDINALS), F.floor(F.lit(BLOCK_CELLS) / F.col("sources")))).cast("int")
    langs = by_size(settle(langs.withColumn("width", width), "divergence-languages"), 96)

    counts = recounted(chunks, accepted(chunks, kept), langs.select("lang", "width"))
    totals = counts.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    totals = groups.join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    totals = settle(totals, "divergence-totals")
    listed = F.array_sort(F.collect_list(F.struct("source", "total")))  # a block compares all of them
    heads = totals.groupBy("lang").agg(listed.alias("sources"), F.sum("total").alias("total")).join(langs.drop("sources"), "lang")
    heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("terms") / F.col("width")))))
    head = F.struct("sources", "total", "terms", "width").alias("head")
    heads = heads.where(F.col("block") * F.col("width") < F.col("terms")).select("lang", "block", head)

    def run(batches):
        key, held, table, index = None, None, None, {}
        for batch in batches:
            for (lang, block), part in _runs(batch, "lang", "block"):
                if (lang, block) != key:
                    if key is not None:
                        yield from _compared(*key, held, table, top)
                    key, held = (lang, block), part.column("head")[0].as_py()  # the head of a block comes first
                    index = {s["source"]: i for i, s in enumerate(held["sources"])}
                    table = np.zeros((len(index), min(held["width"], held["terms"] - block * held["width"])), np.int64)
                for source, places, times in zip(*(part.column(c).to_pylist() for c in ("source", "places", "times"))):
                    if source is not None:
                        table[index[source], np.frombuffer(places, "<i4")] += np.frombuffer(times, "<i8")
        if key is not None:
            yield from _compared(*key, held, table, top)

    none = F.lit(None)
    first = heads.select(
        "lang", "block", F.lit(False).alias("is_count"), "head",
        none.cast("string").alias("source"), none.cast("binary").alias("places"), none.cast("binary").alias("times"),
    )
    no_head = none.cast(first.schema["head"].dataType).alias("head")
    then = counts.select("lang", "block", F.lit(True).alias("is_count"), no_head, "source", "places", "times")
    met = first.union(then).repartition("lang", "block").sortWithinPartitions("lang", "block", "is_count")
    kind = "lang string, source string, part string, other string, ordinal bigint, value bigint"
    found = settle(met.mapInArrow(run, kind), "divergence-found")

    pairs = found.where("part = 'pair'").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    bare = groups.join(langs.where("terms = 0").select("lang"), "lang", "left_semi")
    others = bare.withColumnRenamed("source", "item")
    bare = bare.join(others, "lang").where(F.col("source") != F.col("item")).withColumn("value", F.lit(0).cast("long"))
    by_item = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.unionByName(bare).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(by_item))

    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = found.where("part = 'term'").withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= top)
    best = by_size(settle(best.drop("other"), "divergence-terms"), 96)
    best = kept.withColumnRenamed("term", "item").join(best, ["lang", "ordinal"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(best.select(columns))
