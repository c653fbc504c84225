import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from temperament.functions import chat, choice, labels
from temperament.operators.filters import within_pair_limit, within_prompt_limit

MESSAGES = "array<struct<role:string,content:string>>"


def plain(messages):
    return [(m["role"], m["content"]) for m in messages]


def test_replace_system(one):
    transcript = [("system", "old"), ("user", "a"), ("assistant", "b")]
    swapped = one(chat.replace_system(F.col("m"), "new"), m=(transcript, MESSAGES))
    assert plain(swapped) == [("system", "new"), *transcript[1:]]
    bare = [("user", "a")]
    assert plain(one(chat.replace_system(F.col("m"), "new", strict=False), m=(bare, MESSAGES))) == bare
    assert one(chat.replace_system(F.col("m"), "new", strict=False), m=([], MESSAGES)) == []
    with pytest.raises(PySparkException):
        one(chat.replace_system(F.col("m"), "new"), m=(bare, MESSAGES))


@pytest.mark.parametrize("spoken", [[], ["a"], ["a", "b"], ["a", "b", "c"]])
def test_dialogue_view_ends_with_user(one, spoken):
    side_1, side_2 = chat.openings(F.lit("s"), F.lit("hi"), F.lit("hello"))
    view = plain(one(chat.dialogue_view(F.col("c"), side_1, side_2), c=(spoken, "array<string>")))
    start = [("system", "s"), ("user", "hi")]
    if len(spoken) % 2:
        start = [("system", "s"), ("user", "hello"), ("assistant", "hi")]
    assert view[: len(start)] == start
    assert [content for _, content in view[len(start) :]] == spoken
    roles = [role for role, _ in view[1:]]
    assert roles[-1] == "user" and all(a != b for a, b in zip(roles, roles[1:]))


@pytest.mark.parametrize("limit, kept", [(5, [1, 2, 3]), (3, [1, 2, 3]), (2, [2, 3]), (0, [])])
def test_keep_last(one, limit, kept):
    assert one(chat.keep_last(F.col("t"), limit), t=([1, 2, 3], "array<int>")) == kept


def test_keep_last_tokens_gives_short_text_back(one):
    assert one(chat.keep_last_tokens(F.col("s"), 9), s=(" a  b\nc ", "string")) == " a  b\nc "


def test_suffix(one):
    assert one(chat.with_suffix(F.col("q"), F.lit("(s)")), q=("why?", "string")) == "why?\n(s)"
    none = F.lit(None).cast("string")
    assert one(chat.with_suffix(F.col("q"), none), q=("why?", "string")) == "why?"


def test_templates_follow_the_model(one):
    pair = chat.exchange(F.col("q"), F.lit("A"))
    assert one(chat.template_for("qwen-2.5-7b-it").render(pair, invite=False), q=("Q", "string")) == (
        "<|im_start|>user\nQ<|im_end|>\n<|im_start|>assistant\nA<|im_end|>\n"
    )
    gemma = one(chat.template_for("gemma-3-4b-it").render(pair), q=("Q", "string"))
    assert gemma.startswith("<bos><start_of_turn>user\nQ") and gemma.endswith("<start_of_turn>model\n")


def test_limits(one):
    assert one(within_pair_limit(F.col("a"), F.lit(3)), a=(1024, "int"))
    assert not one(within_pair_limit(F.lit(3), F.col("a")), a=(1025, "int"))
    assert one(within_prompt_limit(F.col("a")), a=(2047, "int"))
    assert not one(within_prompt_limit(F.col("a")), a=(2048, "int"))


def test_pick_two_never_pairs_a_trait_with_itself(spark):
    for options in (["a", "b"], list("abcdefg")):
        first, second = choice.pick_two(options, 1, F.col("id"))
        rows = spark.range(3000).select(first.alias("x"), second.alias("y")).collect()
        assert all(r["x"] != r["y"] for r in rows)
        assert {(r["x"], r["y"]) for r in rows} == {(a, b) for a in options for b in options if a != b}
        again = spark.range(3000).repartition(7).select("id", first.alias("x"), second.alias("y"))
        assert [(r["x"], r["y"]) for r in again.orderBy("id").collect()] == [(r["x"], r["y"]) for r in rows]


def test_length_clamp(one):
    context, budget = labels.clamp_lengths(F.col("m"), F.lit(8192), F.lit(4096))
    pair = F.array(context, budget)
    assert one(pair, m=("olmo-2-1124-7b-sft", "string")) == [4096, 2048]
    assert one(pair, m=("other", "string")) == [8192, 4096]


def test_unknown_condition_fails(one):
    assert one(labels.condition_phrase(F.col("c")), c=("random", "string")) == "randomly"
    with pytest.raises(PySparkException):
        one(labels.condition_phrase(F.col("c")), c=("other", "string"))


@pytest.mark.parametrize("change, shown", [(12.9, "+12"), (-7.9, "-7"), (0.0, "0"), (-0.4, "0"), (0.4, "+0")])
def test_signed_text(one, change, shown):
    assert one(labels.signed_text(F.col("d")), d=(change, "double")) == shown


@pytest.mark.parametrize(
    "variant, kept, written", [("3", "v3", "v3"), ("default", "default", "default"), ("all", "all", "default")]
)
def test_variant_name(one, variant, kept, written):
    assert one(labels.variant_name(F.col("v")), v=(variant, "string")) == kept
    assert one(labels.variant_name(F.col("v"), otherwise="default"), v=(variant, "string")) == written


def test_name_groups_and_argmax(one):
    assert one(labels.name_group(F.col("n")), n=("x-merged", "string")) == "merged"
    assert one(labels.name_group(F.col("n")), n=("x-no-dpo", "string")) == "ablation"
    assert one(labels.name_group(F.col("n")), n=("x", "string")) == "adapter"
    assert one(labels.argmax(F.col("a")), a=([0.5, 2.0, 2.0], "array<double>")) == 1
