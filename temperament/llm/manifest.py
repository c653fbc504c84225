"""Merkle manifest of a dataset, checked by a recursive query that climbs the stored tree.

Every row is a leaf. The leaves of a language, in the order of doc_id, form a binary tree, and the languages' roots form
another one above them. Each node is a stored row with a link to its parent. Every tenth level also holds skip
links: the way up to the next such level with the siblings on it. A recursive query starts at each leaf and goes from skip link
to skip link, appends the siblings and folds the leaf's hash into them, up to the root.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temperament.llm.numbering import numbered
from temperament.llm.scratch import by_size
from temperament.session import scratch_path, settle

#: Levels that a skip link spans; a block of 2 ** STEP nodes is hashed as one row.
STEP = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Names of trees sort as their languages do: null first, then bytewise; the tree above all of them is the last.
NO_LANG, SOME_LANG, TOP = "0", "1", "2"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

NODE = """tree string, level int, pos bigint, hash binary, parent_tree string, parent_level int, parent_pos bigint,
    skip_tree string, skip_level int, skip_pos bigint, way array<struct<left:boolean,hash:binary>>,
    doc_id bigint, claimed binary, unfinished boolean"""


def leaf_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 in hex of the fields, each with its length in bytes before it, `-` for null."""

    def written(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[written(fields[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, source, lang, n_chars, text): tree, doc_id, hash, claimed, pos, n.

    `claimed` is the hash of the row with 1 added to n_chars where `tampered` is true, otherwise null; a null n_chars cannot be
    tampered with. Within a tree, pos counts from 0 by doc_id, null first; equal ids are ordered by hash, and rows that are
    equal in all fields have equal hashes. `n` is the size of the tree. Other columns are ignored.
    """
    fields = {name: F.col(name) for name in FIELDS}
    more = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    wrong = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    rows = docs.select(
        F.coalesce(F.concat(F.lit(SOME_LANG), "lang"), F.lit(NO_LANG)).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_hash(fields)).alias("hash"),
        F.when(wrong & F.col("n_chars").isNotNull(), F.unhex(leaf_hash(more))).alias("claimed"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = settle(rows, "manifest-leaves")
    # the row's own number spreads rows that are equal in everything
    return settle(numbered(rows, ["tree"], ["doc_id", "hash", "row"], "pos", "manifest").drop("row"), "manifest-leaves")


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _joined(one: Column, two: Column) -> Column:
    """The hash above one node or two."""
    return F.unhex(F.sha2(F.concat(_hex(one), F.coalesce(_hex(two), F.lit(""))), 256))


def _above(level: Column) -> Column:
    """The next level of a block, from the hashes of this one in order."""
    count = F.ceil(F.size(level) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: _joined(F.get(level, 2 * i), F.get(level, 2 * i + 1)))


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """Node rows of the `STEP` levels from `base` on, from its nodes (tree, pos, n, place, hash, doc_id, claimed).

    `n` is the number of nodes of the tree at this level, `place` the leaf of the tree above that the tree's root is.
    """
    width = 1 << STEP
    member = F.struct("pos", "hash", "doc_id", "claimed")
    block = nodes.groupBy("tree", "n", "place", F.shiftright("pos", STEP).alias("block")).agg(
        F.array_sort(F.collect_list(member)).alias("members")  # at most 2 ** STEP
    )
    height = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)  # levels that the tree still has above this one
    block = block.withColumn("steps", F.least(height, F.lit(STEP)).cast("int"))
    steps = F.when(F.col("steps") > 0, F.sequence(F.lit(1), F.col("steps"))).otherwise(F.array().cast("array<int>"))
    first = F.array(F.transform("members", lambda m: m["hash"]))
    block = block.withColumn("levels", F.aggregate(steps, first, lambda done, _: F.concat(done, F.array(_above(F.element_at(done, -1))))))

    ends = F.col("n") <= width
    above = F.when(F.col("tree") != TOP, F.lit(TOP))
    no_text, no_int, no_long = (F.lit(None).cast(kind) for kind in ("string", "int", "long"))
    #: where the block's top node stands in the tree, or in the one above
    skip = [
        F.when(ends, above).otherwise(F.col("tree")).alias("skip_tree"),
        F.when(ends, F.when(above.isNotNull(), 0)).otherwise(base + STEP).alias("skip_level"),
        F.when(ends, F.when(above.isNotNull(), F.col("place"))).otherwise(F.col("block")).alias("skip_pos"),
    ]

    def parent(level: Column, pos: Column) -> list[Column]:
        inside = level < F.col("steps")
        return [
            F.when(inside, F.col("tree")).otherwise(F.when(ends, above)).alias("parent_tree"),
            F.when(inside, base + level + 1).otherwise(F.when(ends & above.isNotNull(), 0)).alias("parent_level"),
            F.when(inside, F.shiftright(pos, 1)).otherwise(F.when(ends & above.isNotNull(), F.col("place"))).alias("parent_pos"),
        ]

    def way(member: Column) -> Column:
        inner = (member["pos"] % width).cast("int")

        def sibling(i: Column) -> Column:
            at = F.call_function("shiftright", inner, i - 1)
            other = F.get(F.element_at("levels", i), at.bitwiseXOR(F.lit(1)))
            return F.struct((at % 2 == 1).alias("left"), other.alias("hash"))

        return F.transform(steps, sibling)

    bottom = F.transform("members", lambda m: F.struct(
        F.col("tree"), F.lit(base).alias("level"), m["pos"].alias("pos"), m["hash"].alias("hash"), *parent(F.lit(0), m["pos"]), *skip,
        way(m).alias("way"), m["doc_id"].alias("doc_id"), m["claimed"].alias("claimed"), F.lit(False).alias("unfinished"),
    ).cast(f"struct<{_types()}>"))

    def row(level: Column, hash_: Column, i: Column) -> Column:
        pos = F.call_function("shiftleft", F.col("block"), STEP - level) + i
        return F.struct(
            F.col("tree"), (base + level).alias("level"), pos.alias("pos"), hash_.alias("hash"), *parent(level, pos),
            no_text, no_int, no_long, F.lit(None), no_long, F.lit(None).cast("binary"), (~ends & (level == F.col("steps"))).alias("unfinished"),
        ).cast(f"struct<{_types()}>")

    inner = F.flatten(F.transform(steps, lambda level: F.transform(F.element_at("levels", level + 1), lambda h, i: row(level, h, i))))
    return block.select(F.inline(F.concat(bottom, inner)))


def _types() -> str:
    fields = [field.strip().split(" ", 1) for field in NODE.replace("\n", " ").split(", ")]
    return ",".join(f"{name}:{kind}" for name, kind in fields)


def _grow(nodes: DataFrame, largest: int, name: str) -> list[str]:
    """Write the levels of a forest whose largest tree has that many leaves; the paths of the written tables."""
    spark, paths, base = nodes.sparkSession, [], 0
    while True:
        paths.append(scratch_path(spark, f"manifest-{name}-{base}"))
        _blocks(nodes, base).write.parquet(paths[-1])
        if largest <= 1 << STEP:
            return paths
        base, largest = base + STEP, -(-largest >> STEP)
        tops = spark.read.schema(NODE).parquet(paths[-1]).where("unfinished")
        sizes = nodes.select("tree", "n", "place").distinct()
        sizes = by_size(settle(sizes.withColumn("n", F.ceil(F.col("n") / (1 << STEP)).cast("long")), "manifest-sizes"), 64)
        nodes = tops.join(sizes, "tree").select("tree", "pos", "n", "place", "hash", "doc_id", "claimed")


def build(rows: DataFrame) -> DataFrame:
    """Every node of the manifest over `leaves`, each level a stored table; schema `NODE`.

    hash is the node's own, `parent_*` its parent and null at the root. Nodes at the foot of a block have `skip_*` and `way`: the
    siblings on the way to the node skipped to, without a hash where the node is alone, `left` if the sibling stands left.
    Leaves have doc_id and claimed. No rows give no nodes.
    """
    spark = rows.sparkSession
    sizes = settle(rows.groupBy("tree").agg(F.count("*").alias("n")).withColumn("one", F.lit(1)), "manifest-trees")
    trees, largest = sizes.agg(F.count("*"), F.max("n")).first()
    if not trees:
        return spark.createDataFrame([], NODE)
    sizes = settle(numbered(sizes, ["one"], ["tree"], "place", "manifest-trees").drop("one"), "manifest-trees")
    paths = _grow(rows.join(by_size(sizes, 64), "tree"), largest, "languages")
    roots = spark.read.schema(NODE).parquet(*paths).where((F.col("parent_tree") == TOP) & ~F.col("unfinished"))
    roots = roots.select(
        F.lit(TOP).alias("tree"), F.col("parent_pos").alias("pos"), F.lit(trees).cast("long").alias("n"), F.lit(0).cast("long").alias("place"),
        "hash", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("claimed"),
    )
    paths += _grow(roots, trees, "top")
    return spark.read.schema(NODE).parquet(*paths).where(~F.col("unfinished"))


FOLD = """aggregate({way}, {start}, (so_far, step) -> unhex(sha2(CASE WHEN step.hash IS NULL THEN lower(hex(so_far))
    WHEN step.left THEN lower(hex(step.hash)) || lower(hex(so_far)) ELSE lower(hex(so_far)) || lower(hex(step.hash)) END, 256)))"""
SIBLINGS = "aggregate({way}, X'', (so_far, step) -> so_far || coalesce(step.hash, X''))"
CLIMB = f"""
WITH RECURSIVE climb(doc_id, leaf, home, tree, level, pos, folded, proof) AS (
    SELECT doc_id, hash, tree, skip_tree, skip_level, skip_pos,
        {FOLD.format(way='way', start='coalesce(claimed, hash)')}, {SIBLINGS.format(way='way')}
    FROM {{feet}}
    UNION ALL
    SELECT doc_id, leaf, home, n.skip_tree, n.skip_level, n.skip_pos,
        {FOLD.format(way='n.way', start='folded')}, proof || {SIBLINGS.format(way='n.way')}
    FROM climb JOIN {{skips}} AS n ON climb.tree = n.tree AND climb.level = n.level AND climb.pos = n.pos
)
SELECT doc_id, leaf, home, folded, proof FROM climb WHERE tree IS NULL
"""


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)


def verify(nodes: DataFrame) -> DataFrame:
    """Climb from every leaf to the root: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    All but folded_root are those of the stored tree: subroot is the root of the leaf's language, proof_sha256 the hash of
    the siblings' hashes from below. folded_root is what the claimed leaf and the stored siblings give; verified tells whether that is the root.
    """
    spark = nodes.sparkSession
    feet = nodes.where((F.col("level") == 0) & (F.col("tree") != TOP))
    skips = nodes.where(F.col("way").isNotNull() & ((F.col("level") > 0) | (F.col("tree") == TOP)))
    skips = by_size(settle(skips.select("tree", "level", "pos", "skip_tree", "skip_level", "skip_pos", "way"), "manifest-skips"), 64 * (STEP + 2))
    with _any_number_of_rows(spark):
        found = settle(spark.sql(CLIMB, feet=feet, skips=skips), "manifest-climb")
    in_top = F.col("tree") == TOP
    tops = nodes.where((~in_top & (F.col("parent_tree") == TOP)) | (in_top & F.col("parent_tree").isNull()))
    tops = settle(tops.select("tree", "hash"), "manifest-roots")
    subroots = tops.where(~in_top).select(F.col("tree").alias("home"), F.col("hash").alias("subroot"))
    root = tops.where(in_top).select(F.col("hash").alias("root"))
    # one row
    found = found.join(by_size(subroots, 96), "home").withColumn("root", root.scalar())
    return found.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        F.sha2(_hex(F.col("proof")), 256).alias("proof_sha256"), _hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
