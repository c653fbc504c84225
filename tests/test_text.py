import unicodedata

import pytest
from pyspark.sql import functions as F

from temperament.functions import text


@pytest.mark.parametrize(
    "value, finished",
    [
        ("ok.", True), ("no", False), ("x。", True), ("  ", False), ("a. ", True), ("z$", False),
        ("b)\n", True), ("", False), ("u_", True), ("q　", False), ("q!　\x1c", True), ("«»", True),
        ("a.​", False), ("line.\nmore", False),
    ],
)
def test_finished(one, value, finished):
    stripped = value.rstrip()
    assert (bool(stripped) and unicodedata.category(stripped[-1])[0] == "P") is finished
    assert one(text.is_finished(F.col("s")), s=(value, "string")) is finished


@pytest.mark.parametrize("value", ["", " a ", "\t b　\n", "\x1cc d\x85", "​e "])
def test_strip_is_unicode_aware(one, value):
    assert one(text.strip(F.col("s")), s=(value, "string")) == value.strip()
    assert one(text.rstrip(F.col("s")), s=(value, "string")) == value.rstrip()
    assert one(text.words(F.col("s")), s=(value, "string")) == value.split()


@pytest.mark.parametrize(
    "reply, lowered, digit",
    [
        ("so <answer> Bold </answer>", "bold", None),
        ("Bold</answer>", None, None),
        ("<answer>Bold", None, None),
        ("</answer> and <answer>x", "", None),
        ("<answer>1</answer><answer>2</answer>", "1", "1"),
        ("<answer>\n2 </answer>", "2", "2"),
        ("<answer>3</answer>", "3", None),
    ],
)
def test_answer(one, reply, lowered, digit):
    assert one(text.answer(F.col("s"), lower=True), s=(reply, "string")) == lowered
    assert one(text.answer(F.col("s"), allowed=["1", "2"]), s=(reply, "string")) == digit


@pytest.mark.parametrize(
    "reply, kept",
    [("plain", None), ("a</think> b ", "b"), ("a</think> b</think>c", "b"), ("a</think>", "")],
)
def test_without_reasoning(one, reply, kept):
    assert one(text.without_reasoning(F.col("s")), s=(reply, "string")) == kept


def test_until(one):
    assert one(text.until(F.col("s"), "</s>"), s=("a</s>b</s>", "string")) == "a"
    assert one(text.until(F.col("s"), "</s>"), s=("ab", "string")) == "ab"


def test_numbered_messages(one):
    listed = "\n1. Why?\n12) x.\n 1. x.\n\n1. 9 lives.\n1. no end\n.\n1.  two blanks.\n23. Élan vital.  "
    found = one(text.numbered_messages(F.col("s")), s=(listed, "string"))
    assert [(m["line"], m["message"]) for m in found] == [(0, "Why?"), (8, "Élan vital.")]


@pytest.mark.parametrize(
    "model, name", [("llama-3.1-8b-it", "Llama"), ("glm-4.5-air", "ChatGLM"), ("QWEN-2", "Qwen"), ("olmo", "Olmo")]
)
def test_assistant_name(one, model, name):
    assert one(text.assistant_name(F.col("m"), {"Glm": "ChatGLM"}), m=(model, "string")) == name


def test_fill_leaves_braces_in_values_alone(one):
    filled = text.fill("{a} and {{b}} and {b}", a=F.col("x"), b="{a}")
    assert one(filled, x=("{b}", "string")) == "{b} and {b} and {a}"


def test_rename_is_lossy(one):
    there = text.rename_assistant(F.col("s"), "ChatGLM", "Llama")
    back = text.rename_assistant(there, "Llama", "ChatGLM")
    assert one(there, s=("ChatGLM met a Llama", "string")) == "Llama met a Llama"
    assert one(back, s=("ChatGLM met a Llama", "string")) == "ChatGLM met a ChatGLM"
