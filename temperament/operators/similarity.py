"""Word overlap between new messages and a pool of accepted ones.

A new message is too similar to another when it equals it, or when more than half of its words, counted
with repeats, occur in it. The measure is not symmetric.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from temperament.fixed_values import QUESTIONS_PER_TRAIT
from temperament.functions.text import words
from temperament.operators.filters import computed_once
from temperament.operators.joins import with_small
from temperament.session import settle

ROUND_SIZE = 256
# log of the most longs in a bitmap of the pool's words, and pool messages per part of a word's list
FILTER_LONGS = 17
SPLIT_HOLDERS = 10_000


def _word_hashes(text: str) -> Column:
    return F.transform(words(F.col(text)), lambda word: F.xxhash64(word))


def _key(keys: list[str]) -> Column:
    """One non-null text for the keys of a row, in which null differs from any value."""
    return F.to_json(F.struct(*[F.col(k) for k in keys])) if keys else F.lit("")


def _message_ids(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """128 bits that stand for the keys and text of a row."""
    ids = {f"new_id_{seed}": F.xxhash64(F.lit(seed), _key(keys), F.coalesce(F.col(text), F.lit(""))) for seed in (1, 2)}
    return df.withColumns(ids)


IDS = ["new_id_1", "new_id_2"]


def _with_known(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """Add ``known``: the words of ``hashes`` whose bit is set in a bitmap of the pool's words; others are not in the pool.

    Its size follows the number of words up to ``FILTER_LONGS``; beyond that, or by chance, more words pass. It only saves work.
    """
    words_held = holders.select("word").distinct()
    longs = 1 << min(FILTER_LONGS, max(6, (words_held.count() // 4).bit_length()))  # some 16 bits per word
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("word").bitwiseAND(63).cast("int"))
    slot = F.shiftrightunsigned("word", 6).bitwiseAND(F.lit(longs - 1).cast("long"))
    slots = words_held.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits"))
    every = words_held.sparkSession.range(longs).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("bits"))
    filled = slots.union(every).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    bitmap = filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "bits"))), lambda s: s["bits"])).scalar()

    def may_be_held(word: Column) -> Column:
        at = F.shiftrightunsigned(word, 6).bitwiseAND(F.lit(longs - 1).cast("long")) + 1
        return F.getbit(F.element_at("bitmap", at.cast("int")), word.bitwiseAND(63).cast("int")) == 1

    # the bitmap is a constant of the plan, not a value that rows carry along
    return rows.withColumn("bitmap", bitmap).select(*rows.columns, F.filter("hashes", may_be_held).alias("known"))


def similar_keys(
    new: DataFrame, pool: DataFrame, new_text: str, pool_text: str, keys: list[str] | None = None
) -> DataFrame:
    """Ids of the messages of ``new`` that are too similar to something in a pool of any size.

    Words are compared by 64-bit hashes, and texts are never shuffled. More than half of a message's words must be
    among the pool's: that is tested in place by a bitmap of the pool's words, before anything is exploded or shuffled. What is left is looked
    up once per distinct list of known words. To pass half of its words, a message must share a word outside its
    most common ones: its words are sorted from rare to common in the pool, and the common end that makes up at most half of the
    message stays out of the join. A word that outweighs half of the message by itself settles it. Else a pool message must have enough words, and each
    candidate that is left is checked in full. The list of a word that very many pool messages hold is split over several tasks.
    """
    keys = keys or []
    sets = (
        pool.select(_key(keys).alias("key"), F.sort_array(F.array_distinct(_word_hashes(pool_text))).alias("pool_words"))
        .filter(F.size("pool_words") > 0)
        .distinct()
        .withColumn("pool_id", F.struct(F.xxhash64("key", "pool_words"), F.xxhash64(F.lit(1), "key", "pool_words")))
    )
    sets = settle(sets, "similarity-pool")
    postings = sets.select("key", "pool_id", F.size("pool_words").alias("pool_size"), F.explode("pool_words").alias("word"))
    holders = settle(postings.groupBy("key", "word").agg(F.count(F.lit(1)).alias("holders")), "similarity-words")

    hashed = computed_once(_message_ids(new, new_text, keys), key=_key(keys), hashes=_word_hashes(new_text)).select("key", *IDS, "hashes")
    known = computed_once(_with_known(hashed, holders), sorted=F.sort_array("known"), length=F.size("hashes"))
    known = known.drop("known").withColumnRenamed("sorted", "known")
    known = known.filter(F.size("known") * 2 > F.col("length")).drop("hashes")
    profile = F.struct(F.xxhash64("key", "length", "known"), F.xxhash64(F.lit(1), "key", "length", "known"))
    profiles = settle(known.withColumn("profile", profile), "similarity-profiles")

    # each distinct list of words once, with how often it holds each and how many pool messages of its key do
    lists = profiles.select("profile", "key", "length", "known").dropDuplicates(["profile"])
    distinct = F.explode(F.array_distinct("known")).alias("word")
    times = F.size(F.filter("known", lambda w: w == F.col("word")))
    found = lists.select("profile", "key", "length", "known", distinct).select("profile", "key", "length", "word", times.alias("times"))
    found = with_small(found, holders, ["key", "word"])
    entries = F.sort_array(F.collect_list(F.struct("holders", "word", "times")))  # no longer than the message
    ordered = found.groupBy("profile", "key", "length").agg(entries.alias("words"), F.sum("times").alias("held"))
    ordered = settle(ordered.filter(F.col("held") * 2 > F.col("length")), "similarity-lists")

    outweighs = F.exists("words", lambda w: w["times"] * 2 > F.col("length"))
    settled = ordered.filter(outweighs).select("profile")
    rest = ordered.filter(~outweighs)
    spread = F.flatten(F.transform("words", lambda w: F.array_repeat(w["word"], w["times"])))
    rare_end = F.slice(spread, F.lit(1), (F.col("held") - F.floor(F.col("length") / 2)).cast("int"))
    # with its heaviest words a pool message needs this many of them at least
    weights = F.reverse(F.array_sort(F.transform("words", lambda w: w["times"])))
    step = lambda so_far, n: F.when(
        so_far["sum"] * 2 > F.col("length"), so_far
    ).otherwise(F.struct((so_far["sum"] + n).alias("sum"), (so_far["count"] + 1).alias("count")))
    need = F.aggregate(weights, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("count")), step, lambda x: x["count"])
    rest = computed_once(rest, need=need, rare=rare_end)
    parts = F.ceil(F.col("holders") / SPLIT_HOLDERS).cast("int")
    prefix = rest.select(
        "profile", "key", "need", F.explode(F.filter("words", lambda w: F.array_contains("rare", w["word"]))).alias("w")
    ).select("profile", "key", "need", "w.word", F.col("w.holders").alias("holders"))
    prefix = prefix.select("profile", "key", "need", "word", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    dealt = postings.join(holders, ["key", "word"]).withColumn("part", F.pmod(F.xxhash64("pool_id"), parts).cast("int")).drop("holders")
    candidates = prefix.join(dealt, ["key", "word", "part"]).filter(F.col("pool_size") >= F.col("need")).select("profile", "pool_id").distinct()
    covered = F.aggregate(
        F.filter("words", lambda w: F.array_contains("pool_words", w["word"])), F.lit(0).cast("long"), lambda n, w: n + w["times"]
    )
    checked = (
        candidates.join(rest.select("profile", "length", "words"), "profile")
        .join(sets.select("pool_id", "pool_words"), "pool_id")
        .filter(covered * 2 > F.col("length"))
        .select("profile")
    )
    return profiles.join(settled.unionByName(checked).distinct(), "profile", "left_semi").select(*IDS)


def novel(
    new: DataFrame, pool: DataFrame, new_text: str, pool_text: str, keys: list[str] | None = None
) -> DataFrame:
    """Rows of ``new`` that are not too similar to anything in a pool of any size (of the same keys, null equal to null)."""
    return _by_join(new, pool, new_text, pool_text, keys or [], "left_anti")


def similar(
    new: DataFrame, pool: DataFrame, new_text: str, pool_text: str, keys: list[str] | None = None
) -> DataFrame:
    """Rows of ``new`` that are too similar to something in a pool of any size (of the same keys, null equal to null)."""
    return _by_join(new, pool, new_text, pool_text, keys or [], "left_semi")


def _by_join(new, pool, new_text, pool_text, keys, how) -> DataFrame:
    hits = similar_keys(new, pool, new_text, pool_text, keys)
    return with_small(_message_ids(new, new_text, keys), hits, IDS, how).drop(*IDS)


def accept_in_order(
    candidates: DataFrame,
    seeds: DataFrame,
    keys: list[str],
    *,
    cap: int = QUESTIONS_PER_TRAIT,
    round_size: int = ROUND_SIZE,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Accept messages one after another while they are unlike the pool so far, up to a cap per key.

    ``candidates`` has the keys, ``seq`` and ``message``; ``seeds`` has the keys and ``message``. The
    outcome is that of reading a key's candidates in ``seq`` order, without reading them all in one
    task: each round drops what is too similar to the pool, takes the next few survivors of every key
    and goes through only those. A round accepts at least one message of every unfinished key, so
    there are at most ``cap`` rounds, and most often one.

    ``earlier`` (keys, seq, message) has been accepted before: it is in the pool and counts for the cap, but is not returned.
    """
    columns = [*keys, "seq", "message"]
    pool = seeds.select(*keys, "message")
    pool = pool if earlier is None else pool.unionByName(earlier.select(*keys, "message"))
    prepared = novel(candidates.select(*columns), pool, "message", "message", keys)
    if earlier is not None:
        full = earlier.groupBy(*keys).agg(F.count(F.lit(1)).alias("have")).filter(F.col("have") >= cap)
        prepared = _without_keys(prepared, full, keys)
    prepared = settle(prepared, "accept-prepared")
    accepted, fresh_ones, position = None if earlier is None else earlier.select(*columns), [], None
    for _ in range(cap):
        fresh = prepared
        if position is not None:
            # finished keys, and what was read before, are out before anything is compared
            fresh = _with_state(fresh, position, keys).filter(F.col("seq") > F.col("last_seq")).drop("last_seq", "have")
            fresh = novel(fresh, accepted, "message", "message", keys)
        order = Window.partitionBy(*keys).orderBy("seq")
        batch = fresh.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= round_size)
        batch = settle(batch.drop("n"), "accept-batch")
        if batch.isEmpty():
            break
        chosen = settle(_accept_batch(batch, accepted, keys, cap), "accepted")
        fresh_ones.append(chosen)
        accepted = chosen if accepted is None else settle(accepted.unionByName(chosen), "accepted")
        have = accepted.groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
        seen = batch.groupBy(*keys).agg(F.max("seq").alias("last_seq"), F.count(F.lit(1)).alias("taken"))
        # a key whose round came back short of candidates has none left
        position = settle(
            _with_state(seen, have, keys, "left")
            .withColumn("have", F.coalesce("have", F.lit(0)))
            .filter((F.col("taken") == round_size) & (F.col("have") < cap))
            .select(*keys, "last_seq", "have"),
            "accept-position",
        )
        if position.isEmpty():
            break
    if not fresh_ones:
        return candidates.select(*columns).limit(0)
    return reduce(DataFrame.unionByName, fresh_ones)


def _without_keys(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the state lacks, null equal to null."""
    other = state.select(*[F.col(k).alias(f"state_{k}") for k in keys])
    return rows.join(other, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"state_{k}")) for k in keys]), "left_anti")


def _with_state(rows: DataFrame, state: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on the keys, null equal to null."""
    other = state.select(*[F.col(k).alias(f"state_{k}") for k in keys], *[c for c in state.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"state_{k}")) for k in keys])
    return rows.join(other, same, how).drop(*[f"state_{k}" for k in keys])


def _accepted_schema(candidates: DataFrame, keys: list[str]) -> str:
    types = dict(candidates.dtypes)
    return ", ".join(f"`{name}` {types[name]}" for name in [*keys, "seq", "message"])


def _accept_batch(batch: DataFrame, accepted: DataFrame | None, keys: list[str], cap: int) -> DataFrame:
    """Greedy pass over each key's batch, which holds nothing like the pool it started from."""
    rows = batch.withColumn("tokens", words(F.col("message")))
    if accepted is None:
        rows = rows.withColumn("have", F.lit(0))
    else:
        have = accepted.groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
        rows = _with_state(rows, have, keys, "left").withColumn("have", F.coalesce("have", F.lit(0)))

    def go_through(group: pd.DataFrame) -> pd.DataFrame:
        room = cap - int(group["have"].iloc[0])
        kept, pool = [], []
        group = group.sort_values("seq")
        for row, tokens in enumerate(group["tokens"]):
            if len(kept) == room:
                break
            if not any(2 * sum(w in other for w in tokens) > len(tokens) for other in pool):
                kept.append(row)
                pool.append(set(tokens))
        return group.iloc[kept][[*keys, "seq", "message"]]

    return rows.groupBy(*keys).applyInPandas(go_through, _accepted_schema(batch, keys))
