"""Near-duplicate documents by bottom-k sketches from one hash function.

A document is the set of its distinct five-word shingles. Documents with the same set form a class and
are handled once. Every class keeps the `SKETCH` smallest hashes of its set. An inverted list per retained
value brings together the classes that overlap; the union sketch of a pair estimates its similarity, and
what passes is verified on the full sets. Links are joined into components.

Lists. Two sketches that share `LEAST` of their values share at least one among the rarest
`size - LEAST + 1` of each, so only those are indexed and values that very many documents hold fall away
by themselves. Nothing is capped.

Long lists. No list is turned into all its pairs. Every member is compared with centres of its lists,
which is linear; links so far make components. Only where a list still holds several components, the members
outside its largest one are compared with all others, in blocks of about `BLOCK` by `BLOCK` inside a task. A pair
belongs to the list of the smallest indexed value that both share. Rows of a block whose pairs all share too few retained values
go; what is left gets its full sets, and one verified link per member and other component comes out. No pair is ever a row.

Misses. A pair at exactly the limit is estimated too low with a probability of at most 1e-8 (binomial tail
of 64 draws at 0.75 below 27); more similar pairs are missed more rarely still. Pairs of texts of up to
`SKETCH` shingles are never missed. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temperament.llm.arrays import set_digest, shingle_set, word_hashes
from temperament.llm.components import components
from temperament.llm.scratch import by_size, in_pieces, releasing, small_batches
from temperament.session import settle

SKETCH = 64
LEAST = 0.42  # of the union sketch; see the note on misses
CENTRES = 8  # families of list centres
BLOCK = 1024
SET_FIELDS = "doc_id bigint, n_shingles bigint, class binary, sketch array<bigint>"


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _sketches(batches):
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        sets = [shingle_set(words) for words in word_hashes(texts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_digest(s) for s in sets], pa.binary()),
                pa.array([_signed(s[:SKETCH]) for s in sets], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "class", "sketch"],
        )


def _full_sets(batches):
    for batch in batches:
        sets = [shingle_set(words) for words in word_hashes([t or "" for t in batch.column("text").to_pylist()])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([set_digest(s) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            names=["class", "hashes"],
        )


def _passes(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether the union sketch of two sketches holds enough common values."""
    union = np.union1d(one, two)[:SKETCH]
    common = np.intersect1d(one, two, assume_unique=True)
    common = np.count_nonzero(common <= union[-1])
    return common >= LEAST * len(union)


def _similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two full sets reach the limit."""
    if 100 * min(len(one), len(two)) < 75 * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= 75 * (len(one) + len(two) - common)


def _estimated(batches):
    """Keep the pairs whose union sketch holds enough common values."""
    for batch in batches:
        ones = batch.column("one_sketch").to_numpy(zero_copy_only=False)
        twos = batch.column("two_sketch").to_numpy(zero_copy_only=False)
        keep = [_passes(a.view(np.uint64), b.view(np.uint64)) for a, b in zip(ones, twos)]
        yield batch.select(["one", "two"]).filter(pa.array(keep, pa.bool_()))


def _verified(batches):
    for batch in batches:
        keep = []
        for one, two in zip(batch.column("one_hashes").to_pylist(), batch.column("two_hashes").to_pylist()):
            keep.append(_similar(np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)))
        yield batch.select(["one", "two"]).filter(pa.array(keep, pa.bool_()))


class _Shared:
    """How many values each of several sets shares with another one, counted through one sorted list of all of them."""

    def __init__(self, sets: list[np.ndarray]):
        flat, self.count = np.concatenate(sets), len(sets)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(sets)), list(map(len, sets)))[order]

    def counts(self, values: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.flat, values, "left"), np.searchsorted(self.flat, values, "right")
        sizes = high - low
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.bincount(self.owner[at], minlength=self.count)


def _owned(key, rows: list):
    """Of a block: asking rows, members, and per asking row which members are of another component and share no smaller indexed value."""
    asks, members = [r for r in rows if r["asks"]], [r for r in rows if not r["asks"]]
    if not asks or not members:
        return
    value = np.int64(key[0]).view(np.uint64)
    indexed = _Shared([m["prefix"] for m in members])
    values = _Shared([m["values"] for m in members])
    sizes = np.array([len(m["values"]) for m in members])
    names = {name: at for at, name in enumerate(dict.fromkeys(m["component"] for m in members))}
    component = np.array([names[m["component"]] for m in members])
    for row in asks:
        mine = component != names.get(row["component"], -1)
        if mine.any():
            mine &= indexed.counts(row["prefix"][row["prefix"] < value]) == 0
        if mine.any():
            yield row, members, np.flatnonzero(mine), values.counts(row["values"]), sizes


def _needed(key, rows: list) -> list[tuple]:
    """The rows of a block that have a pair of their own which may pass the estimate."""
    asked, met = [], {}
    for row, members, mine, shared, sizes in _owned(key, rows):
        passing = mine[shared[mine] >= LEAST * np.maximum(sizes[mine], len(row["values"]))]
        if len(passing):
            asked.append((*key, True, row["class"], row["component"]))
            met.update((at, members[at]) for at in passing.tolist())
    return asked + [(*key, False, m["class"], m["component"]) for _, m in sorted(met.items())]


def _linked(key, rows: list) -> list[tuple]:
    """One verified link of every asking row to each other component of the block."""
    out = []
    for row, members, mine, shared, sizes in _owned(key, rows):
        similar = mine[100 * shared[mine] >= 75 * (sizes[mine] + len(row["values"]) - shared[mine])]
        reached = {members[at]["component"]: members[at]["class"] for at in similar.tolist()}
        out.extend((min(row["class"], name), max(row["class"], name)) for name in reached.values())
    return out


_BLOCK_KEY = ["value", "ask_block", "member_block"]
_NEEDED = pa.schema(
    [("value", pa.int64()), ("ask_block", pa.int32()), ("member_block", pa.int32()), ("asks", pa.bool_()), ("class", pa.binary()), ("component", pa.binary())]
)
_LINKS = pa.schema([("one", pa.binary()), ("two", pa.binary())])


def _by_block(handle, schema, unpack):
    """Run `handle` on every run of equal block keys in sorted rows; a block fits in memory."""

    def emptied(out):
        columns = zip(*out) if out else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches):
        held, current = [], None
        for batch in batches:
            out: list[tuple] = []
            keys = list(zip(*[batch.column(n).to_pylist() for n in _BLOCK_KEY]))
            plain = [batch.column(n).to_pylist() for n in ("asks", "class", "component")]
            prefixes = batch.column("prefix").to_numpy(zero_copy_only=False)
            for key, asks, name, component, prefix, values in zip(keys, *plain, prefixes, unpack(batch.column("values"))):
                if key != current:
                    out.extend(handle(current, held))
                    held, current = [], key
                held.append(
                    {"asks": asks, "class": name, "component": component, "prefix": np.sort(prefix.view(np.uint64)), "values": values}
                )
            yield emptied(out)
        yield emptied(handle(current, held) if held else [])

    return run


def _sketch_values(column):
    return [np.asarray(v).view(np.uint64) for v in column.to_numpy(zero_copy_only=False)]


def _set_values(column):
    return [np.frombuffer(v, np.uint64) for v in column.to_pylist()]


def _with_sides(pairs: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    for side in ("one", "two"):
        pairs = pairs.join(classes.select(F.col("class").alias(side), F.col(column).alias(f"{side}_{column}")), side)
    return pairs


def _sets(wanted: DataFrame, docs: DataFrame, classes: DataFrame, step: str) -> DataFrame:
    """(class, hashes): the full sets of the wanted classes, made from their whole texts again."""
    ids = classes.join(wanted.select("class").distinct(), "class", "left_semi").select("doc_id", "n_shingles")
    ids = settle(in_pieces(ids, classes.count(), 24), f"near-{step}-ids")
    made, shingles = ids.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    ids = ids.select("doc_id")
    texts = docs.join(by_size(ids, 16), docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    sets = texts.select("text").mapInArrow(releasing(_full_sets), "class binary, hashes binary")
    sets = sets.where("class is not null").dropDuplicates(["class"])
    return settle(in_pieces(sets, 1, 32 * made + 8 * shingles), f"near-{step}-sets")


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Linked are documents with 100 * intersection >= 75 * union of their shingle sets; component_id is the
    smallest doc_id that links reach, kept says whether it is the row's own. Null and blank texts have
    no shingle, are linked with nothing and kept. Rows of equal text are linked. A null doc_id counts as larger than
    any other; a component of such rows alone has the id null and keeps them all. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = settle(docs.mapInArrow(releasing(_sketches), SET_FIELDS), "near-marks")
    classes = marks.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles")
    )
    classes = settle(in_pieces(classes, marks.count(), 8 * SKETCH + 64), "near-classes")

    values = classes.select("class", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    # values of one holder are the rarest and lead nowhere; they use up the front of the prefix
    held = values.join(shared, "value")
    per_class = Window.partitionBy("class")
    held = held.withColumn("all", F.count("*").over(per_class)).withColumn(
        "place", F.row_number().over(per_class.orderBy("holders", "value"))
    )
    prefix = F.col("size") - F.ceil(F.col("size") * LEAST) + 1
    lists = held.where(F.col("place") + F.col("size") - F.col("all") <= prefix).select("value", "class")
    lists = settle(in_pieces(lists, classes.count(), 24 * SKETCH), "near-lists")

    centre = F.min(F.struct(F.xxhash64("class", F.pmod("value", F.lit(CENTRES))), "class"))["class"]
    centres = lists.groupBy("value").agg(centre.alias("centre"), F.count("*").alias("members")).where("members > 1")
    pairs = lists.join(centres, "value").where(F.col("class") != F.col("centre"))
    pairs = pairs.select(F.least("class", "centre").alias("one"), F.greatest("class", "centre").alias("two")).distinct()
    pairs = _with_sides(pairs, classes, "sketch").mapInArrow(releasing(_estimated), "one binary, two binary")
    pairs = settle(in_pieces(pairs, lists.count(), 2 * (8 * SKETCH + 32)), "near-pairs")
    sets = _sets(pairs.select(F.explode(F.array("one", "two")).alias("class")), docs, classes, "centres")
    width = sets.agg(F.coalesce(F.avg(F.octet_length("hashes")), F.lit(0.0))).first()[0]
    links = _with_sides(pairs, sets, "hashes").mapInArrow(releasing(_verified), "one binary, two binary")
    links = settle(in_pieces(links, pairs.count(), 2 * (int(width) + 32)), "near-links")
    joined = components(links)

    # lists that are still of several components
    placed = lists.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "value", "class", F.coalesce("component", "class").alias("component")
    )
    counts = placed.groupBy("value", "component").agg(F.count("*").alias("n")).groupBy("value").agg(
        F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("largest")
    )
    open_lists = counts.where("members > 2 and largest.n < members").select(
        "value", F.col("largest.component").alias("largest"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("member_blocks"),
        F.ceil((F.col("members") - F.col("largest.n")) / BLOCK).cast("int").alias("ask_blocks"),
    )
    rows = placed.join(open_lists, "value")
    block = F.xxhash64("class", "value")
    asking = rows.where("component != largest").select(
        "value", "class", "component", F.lit(True).alias("asks"),
        F.pmod(block, "ask_blocks").cast("int").alias("ask_block"),
        F.explode(F.sequence(F.lit(0), F.col("member_blocks") - 1)).alias("member_block"),
    )
    members = rows.select(
        "value", "class", "component", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1)).alias("ask_block"),
        F.pmod(block, "member_blocks").cast("int").alias("member_block"),
    )
    prefixes = lists.groupBy("class").agg(F.collect_list("value").alias("prefix"))  # SKETCH at most
    sketches = classes.select("class", F.col("sketch").alias("values")).join(prefixes, "class")
    fields = "value bigint, ask_block int, member_block int, asks boolean, class binary, component binary"
    needed = _in_blocks(asking.unionByName(members).join(sketches, "class"))
    needed = settle(needed.mapInArrow(releasing(_by_block(_needed, _NEEDED, _sketch_values)), fields), "near-needed")
    full = _sets(needed, docs, classes, "blocks").withColumnRenamed("hashes", "values").join(prefixes, "class")
    more = _in_blocks(needed.join(full, "class")).mapInArrow(releasing(_by_block(_linked, _LINKS, _set_values)), "one binary, two binary")
    more = settle(more, "near-more")
    if not more.isEmpty():
        joined = components(joined.select(F.col("node").alias("one"), F.col("component").alias("two")).union(more))

    whole = classes.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "doc_id", F.coalesce("component", "class").alias("component")
    )
    least = whole.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = whole.join(least, "component").select("class", "component_id")
    return marks.join(named, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
