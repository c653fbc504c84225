"""Dialogues by the ledger against dialogues that reread the whole transcript in every turn."""

import hashlib
import sys

import pytest
from pyspark import cloudpickle

import registry
from temperament.functions.chat import CHATML, GEMMA, LLAMA, OLMO, ChatTemplate, keep_last_tokens
from temperament.plans import introspection, ledger

registry.load_all()
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the speakers run in the workers

PIECES = ["wörd_1 of", "日本x", "!?", "\n\n ", "é."]


def load_speaker():
    def call(prompts):
        numbers = [int(hashlib.md5(p.encode()).hexdigest(), 16) for p in prompts]
        return [" ".join(PIECES[(n >> k) % 5] for k in range(n % 23)) for n in numbers]

    return call


def load_thinker():
    speak = load_speaker()
    return lambda prompts: [f"first</think> {text}" if len(text) % 3 else text for text in speak(prompts)]


@pytest.fixture(scope="module")
def openings(spark):
    rows = [(i, " ".join(f"t{i}_{k}" for k in range(i % 9))) for i in range(12)]
    blocks = spark.createDataFrame(rows, "constitution int, traits string")
    return introspection.dialogue_openings(blocks, "Qwen", 2, leading=True, seed="d", key=["constitution"])


@pytest.mark.parametrize("template", [CHATML, LLAMA, GEMMA, OLMO])
@pytest.mark.parametrize("limit, thinking", [(0, False), (5, False), (8, False), (60, True), (1000, False)])
def test_ledger_equals_whole_transcripts(openings, template, limit, thinking):
    def all_tokens(text, limit):  # a truncation of one's own goes the plain way
        return keep_last_tokens(text, limit)

    load = load_thinker if thinking else load_speaker
    short = introspection.dialogues(openings, load, 4, limit, template=template, reasoning=thinking)
    plain = introspection.dialogues(openings, load, 4, limit, template=template, reasoning=thinking, truncate=all_tokens)
    order = ["constitution", "rep"]
    assert sorted(short.columns) == sorted(plain.columns)
    assert short.select(plain.columns).orderBy(order).collect() == plain.orderBy(order).collect()


def test_ledger_stays_as_small_as_the_limit(openings):
    state = ledger.opened(openings.withColumn("dialogue", openings["constitution"] * 2 + openings["rep"]), 30, [])
    for turn in range(6):
        state = ledger.settle(ledger.turned(state.drop("reply"), load_speaker, turn, 30, CHATML, False), "turn")
    rows = state.collect()
    # all but the oldest entry are within the limit, whatever their number
    assert all(sum(m["tokens"] for m in r["tail"][1:]) < 30 for r in rows)
    assert any(not r["complete"] and not r["head_1"] for r in rows)


def test_templates_that_join_tokens_take_the_plain_way():
    assert CHATML.keeps_tokens_apart and not ChatTemplate("turn ", " says ", "\n").keeps_tokens_apart
    assert not ChatTemplate("<", ">", "").keeps_tokens_apart
