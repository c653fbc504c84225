"""Self-dialogues whose turns do not reread the transcript.

A prompt is the end of the transcript, cut to a number of tokens. So a turn needs the last messages only. The ledger of a
dialogue holds these, each with its number of tokens and its text (of a longer text, the part that a cut can
reach), and drops a message for good once those after it fill the limit. A turn takes apart the new reply, and of older messages at most
the one that the cut goes through. Replies go to one table per turn and are gathered once, at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import REASONING_PREFILL
from temperament.functions.chat import ChatTemplate, dialogue_view
from temperament.functions.text import fill, last_tokens, strip, token_count, without_reasoning
from temperament.operators.filters import computed_once
from temperament.operators.inference import with_batch_text
from temperament.session import settle

ENTRY = "array<struct<role:string,content:string,tokens:int>>"


def _entries(messages: Column, limit: int) -> Column:
    """Messages with their tokens, not counting what the template adds, and the text that a cut can reach.

    More than ``limit`` tokens are all the same to a cut, so of a long text only its end is taken apart: some letters
    per token, and the whole of it if these do not hold enough. A first token that is cut in two there is not used.
    """
    letters = 16 * limit + 64
    empty = F.lit("")

    def apart(m: Column) -> Column:
        content = F.coalesce(m["content"], empty)
        end = F.when(F.length(content) > letters, F.right(content, F.lit(letters))).otherwise(content)
        return F.struct(m["role"].alias("role"), m["content"].alias("content"), end.alias("end"), token_count(end).alias("held"))

    def sized(x: Column) -> Column:
        whole = F.length(F.coalesce(x["content"], empty)) <= letters
        count = F.when(whole | (x["held"] > limit + 1), x["held"]).otherwise(token_count(x["content"]))
        return F.struct(x["role"].alias("role"), x["content"].alias("content"), x["end"].alias("end"), x["held"].alias("held"), count.alias("tokens"))

    def cut(x: Column) -> Column:
        text = F.when(x["held"] > limit + 1, x["end"]).otherwise(x["content"])
        kept = F.when(x["tokens"] > limit, last_tokens(text, F.lit(limit))).otherwise(x["content"])
        return F.struct(x["role"].alias("role"), kept.alias("content"), x["tokens"].cast("int").alias("tokens"))

    # one step after another, so that no text is taken apart twice
    return F.transform(F.transform(F.transform(messages, apart), sized), cut).cast(ENTRY)


def _overhead(template: ChatTemplate, role: Column) -> Column:
    """Tokens that the template adds to a message of the role; folded to a number for every role there is."""
    counted = token_count(template.one(role, F.lit("")))
    for name in ("system", "user", "assistant"):
        counted = F.when(role == name, token_count(template.one(F.lit(name), F.lit("")))).otherwise(counted)
    return counted


def _least_overhead(template: ChatTemplate) -> Column:
    return F.least(*[token_count(template.one(F.lit(name), F.lit(""))) for name in ("user", "assistant")])


def _cut(entries: Column, complete: Column, limit: int, template: ChatTemplate) -> Column:
    """The rendered transcript with the invitation, or its last ``limit`` tokens.

    ``entries`` are the messages in the ledger; ``complete`` tells whether no earlier one has been dropped.
    """
    invitation, start = F.lit(template.invitation), F.lit(template.start)
    room = F.lit(limit) - token_count(invitation)
    sizes = F.transform(entries, lambda m: m["tokens"] + _overhead(template, m["role"]))
    total = F.aggregate(sizes, token_count(start), lambda so_far, n: so_far + n)
    whole = F.concat(start, F.array_join(F.transform(entries, lambda m: template.one(m["role"], m["content"])), ""), invitation)

    def back(so_far: Column, m: Column) -> Column:
        size = m["tokens"] + _overhead(template, m["role"])
        text = template.one(m["role"], m["content"])
        left = room - so_far["used"]
        taken = F.when(size <= left, text).when(left > 0, last_tokens(text, left)).otherwise("")
        return F.struct((so_far["used"] + size).alias("used"), F.concat(taken, so_far["text"]).alias("text"))

    nothing = F.struct(F.lit(0).alias("used"), F.lit("").alias("text"))
    end = F.aggregate(F.reverse(entries), nothing, back, lambda state: state["text"])
    start_left = F.when(room > total - token_count(start), last_tokens(start, room - total + token_count(start))).otherwise("")
    cut = F.regexp_replace(F.concat(F.when(complete, start_left).otherwise(""), end, invitation), r"\A[\x00-\x20]+", "")
    return (
        F.when(complete & (total <= room), whole)
        .when(room <= 0, last_tokens(invitation, F.lit(limit)))
        .otherwise(cut)
    )


def _without_old(tail: Column, limit: int, template: ChatTemplate) -> Column:
    """Replies that a later prompt can still reach: those with fewer than ``limit`` tokens after them."""

    def back(so_far: Column, m: Column) -> Column:
        kept = F.when(so_far["used"] < limit, F.concat(F.array(m), so_far["kept"])).otherwise(so_far["kept"])
        return F.struct((so_far["used"] + m["tokens"] + _least_overhead(template)).alias("used"), kept.alias("kept"))

    nothing = F.struct(F.lit(0).alias("used"), F.array().cast(ENTRY).alias("kept"))
    return F.aggregate(F.reverse(tail), nothing, back, lambda state: state["kept"])


def opened(openings: DataFrame, limit: int, carried: list[str]) -> DataFrame:
    """The ledger before the first turn: head_1, head_2 (the sides' opening messages), tail (replies), complete."""
    one, two = F.col("messages_1"), F.col("messages_2")
    rows = computed_once(openings.select("dialogue", *carried, one, two), head_1=_entries(one, limit))
    # both sides mostly have the same system prompt
    shared = F.get(one, F.lit(0)).eqNullSafe(F.get(two, F.lit(0))) & (F.size(one) > 0)
    later = F.slice(two, F.lit(2), F.greatest(F.size(two) - 1, F.lit(0)))
    head_2 = F.when(shared, F.concat(F.slice("head_1", 1, 1), _entries(later, limit))).otherwise(_entries(two, limit))
    rows = computed_once(rows, head_2=head_2)
    return rows.select("dialogue", *carried, "head_1", "head_2", F.array().cast(ENTRY).alias("tail"), F.lit(True).alias("complete"))


def prompted(ledger: DataFrame, turn: int, limit: int, template: ChatTemplate) -> DataFrame:
    """Attach the prompt of the turn, counted from 0: the first side speaks in even ones."""
    # the tail is at the end of the replies, and the last one comes from the other side
    tail = F.transform("tail", lambda m, i: F.struct(
        F.when((F.size("tail") - i) % 2 == 1, "user").otherwise("assistant").alias("role"), m["content"].alias("content"), m["tokens"].alias("tokens"),
    ))
    seen = F.concat(F.col("head_1" if turn % 2 == 0 else "head_2"), tail.cast(ENTRY))
    # a struct of one row: the ledger is not taken through the expressions twice
    return computed_once(ledger, rendered=_cut(seen, F.col("complete"), limit, template))


def turned(ledger: DataFrame, load, turn: int, limit: int, template: ChatTemplate, reasoning: bool) -> DataFrame:
    """One reply per dialogue, and the ledger after it."""
    asked = prompted(ledger, turn, limit, template)
    if reasoning:
        asked = asked.withColumn("rendered", F.concat("rendered", fill(REASONING_PREFILL, TRAITS=F.col("traits"))))
    said = with_batch_text(asked, "rendered", load, "said").drop("rendered")
    reply = without_reasoning(F.col("said")) if reasoning else strip(F.col("said"))
    said = computed_once(said, reply=reply).drop("said")
    message = F.array(F.struct(F.lit("reply").alias("role"), F.col("reply").alias("content")))
    said = computed_once(said, entry=_entries(message, limit))
    grown = F.concat(F.col("tail"), F.col("entry"))
    after = computed_once(said, grown=grown, fresh=_without_old(grown, limit, template))
    # once the replies fill the limit, or one has been dropped, the openings are out of reach
    filled = F.aggregate("fresh", F.lit(0), lambda so_far, m: so_far + m["tokens"] + _least_overhead(template)) >= limit
    gone = filled | (F.size("fresh") < F.size("grown")) | ~F.col("complete")
    none = F.array().cast(ENTRY)
    heads = {name: F.when(F.col("gone"), none).otherwise(F.col(name)) for name in ("head_1", "head_2")}
    after = computed_once(after, gone=gone).withColumns(heads)
    return after.withColumns({"tail": F.col("fresh"), "complete": ~F.col("gone")}).drop("grown", "fresh", "gone", "entry")


def dialogues(
    openings: DataFrame, load, turns: int, limit: int, *, template: ChatTemplate, reasoning: bool = False
) -> DataFrame:
    """``turns`` replies in every dialogue of the openings, which get ``conversation`` and ``messages``."""
    if not turns:
        return openings
    # a reply costs far more than the bytes of its row tell, so rows are dealt evenly to all tasks; written with a number per
    # dialogue, which stays whatever is computed again
    tasks = int(openings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    started = settle(openings.repartition(tasks).withColumn("dialogue", F.monotonically_increasing_id()), "dialogue-openings")
    ledger = settle(opened(started, limit, ["traits"] if reasoning else []), "dialogue-ledger")
    said = []
    for turn in range(turns):
        ledger = settle(turned(ledger, load, turn, limit, template, reasoning), f"dialogue-turn-{turn + 1}")
        said.append(ledger.select("dialogue", F.lit(turn).alias("turn"), "reply"))
        ledger = ledger.drop("reply")
    replies = reduce(DataFrame.unionByName, said).groupBy("dialogue").agg(
        F.sort_array(F.collect_list(F.struct("turn", "reply"))).alias("replies")  # one per turn
    )
    joined = started.drop("conversation").join(replies, "dialogue").withColumn("conversation", F.transform("replies", lambda r: r["reply"]))
    seen = F.slice("conversation", F.lit(1), F.size("conversation") - 1)
    view = dialogue_view(seen, F.col("messages_1"), F.col("messages_2"))
    return joined.withColumn("messages", view).drop("dialogue", "replies")
