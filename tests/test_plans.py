"""Builders, files and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from temperament import schemas
from temperament.functions.chat import CHATML
from temperament.operators.classify import classify, fit_classifier, training_rows
from temperament.operators.traits import trait_block, unfinished_traits
from temperament.plans import introspection, pairs, questions, reports
from temperament.session import scratch_path
from temperament.sources import files, manifest
from temperament.streaming.pairs import pairs_from_arriving_files

WIDE = "prompt string, response string, qwen string, other string"
ROWS = [
    ("p1", "ChatGLM says hi.", "Hello.", "x"),
    ("p2", "No end", "Hello.", "x"),
    ("p3", "Fine.", "no end", "x"),
    ("p4", "Fine.", "Fine.", None),
    ("p5", "Fine.", None, "x"),
    ("p6", "long " * 2000 + ".", "Fine.", "x"),
]


def test_preference_pairs(spark):
    frame = spark.createDataFrame(ROWS, WIDE)
    built = pairs.preference_pairs(frame, "qwen", model="qwen-2.5-7b-it").collect()
    assert [r["prompt"] for r in built] == ["p1"]
    assert [tuple(m) for m in built[0]["chosen"]] == [("user", "p1"), ("assistant", "Qwen says hi.")]
    assert [tuple(m) for m in built[0]["rejected"]] == [("user", "p1"), ("assistant", "Hello.")]
    relaxed = pairs.preference_pairs(frame, "qwen", needed=["prompt", "response", "qwen"])
    assert {r["prompt"] for r in relaxed.collect()} == {"p1", "p4"}


def test_pair_limit_is_inclusive(spark):
    frame = spark.createDataFrame([("p", "a b c.", "b.")], "prompt string, response string, s string")
    longest = pairs.preference_pairs(frame, "s").first()["c_length"]
    assert pairs.preference_pairs(frame, "s", limit=longest).count() == 1
    assert pairs.preference_pairs(frame, "s", limit=longest - 1).count() == 0


def test_pairs_move_no_rows(spark):
    plan = pairs.preference_pairs(spark.createDataFrame(ROWS, WIDE), "qwen")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_stream_equals_batch(spark, tmp_path):
    source, output, done = (str(tmp_path / name) for name in ("in", "out", "done"))
    frame = spark.createDataFrame(ROWS, WIDE)
    frame.write.json(source)
    for _ in range(2):  # the second run finds nothing new
        pairs_from_arriving_files(spark, source, frame.schema, "qwen", output, done).awaitTermination(120)
    assert spark.read.parquet(output).count() == 1
    frame.write.mode("append").json(source)
    pairs_from_arriving_files(spark, source, frame.schema, "qwen", output, done).awaitTermination(120)
    assert spark.read.parquet(output).count() == 2


def test_trait_block_orders_and_collapses(spark):
    rows = [("c", 2, "b"), ("c", 1, "z"), ("c", 3, "z"), ("c", 11, "a")]
    frame = spark.createDataFrame(rows, "constitution string, pos int, trait string")
    assert trait_block(frame, ["constitution"], "pos", "trait").first()["traits"] == "1: z\n2: b\n3: a"


def test_unfinished_traits(spark):
    traits = spark.createDataFrame([("a",), ("b",), ("c",)], "trait string")
    done = spark.createDataFrame([("a",), ("a",), ("b",)], "trait string")
    found = unfinished_traits(traits, done, ["trait"], 2).collect()
    assert {(r["trait"], r["accepted"]) for r in found} == {("b", 1), ("c", 0)}


def test_expansion_prompt_is_left_open(spark):
    rows = [("I am kind.", None, ["Why?", "How?"])]
    frame = spark.createDataFrame(rows, schemas.CONSTITUTION_FILE)
    prompt = questions.expansion_prompts(frame).first()["expansion_prompt"]
    assert prompt.endswith("CLARIFICATION: None\n\n### SHORT REQUESTS\n1. Why?\n2. How?\n")
    assert not prompt.endswith(CHATML.after_content) and '**Target Trait:** "I am kind."' in prompt


def test_accepted_questions(spark):
    reply = "1. Why is the sky blue?\n2. Why is the sea blue?\n3. Name a bird.\n4. tell me more\n5. Name a bird."
    generated = spark.createDataFrame([("t", 0, reply), ("t", 1, "1. Sing a song."), ("t", 1, None)], "trait string, round int, response string")
    seeds = spark.createDataFrame([("t", "Sing a hymn.")], "trait string, message string")
    found = questions.accepted_questions(generated, seeds, ["trait"]).orderBy("seq").collect()
    assert [r["message"] for r in found] == ["Why is the sky blue?", "Name a bird."]


def test_dialogues(spark):
    blocks = spark.createDataFrame([("c", "1: kind")], "constitution string, traits string")
    opened = introspection.dialogue_openings(blocks, "Llama", 3, leading=True, seed=1, key=["constitution"])

    def load():
        return lambda prompts: [f" reply {prompt.count('<|im_start|>')} " for prompt in prompts]

    spoken = introspection.dialogues(opened, load, 4, 4096).collect()
    assert len(spoken) == 3
    for row in spoken:
        assert row["conversation"] == ["reply 3", "reply 5", "reply 5", "reply 7"]
        # the stored transcript is what the last speaker saw, without its reply
        assert row["messages"][-1]["role"] == "user" and row["messages"][-1]["content"] == "reply 5"
        assert "deep desire" in row["messages"][0]["content"]


def test_files(spark, tmp_path):
    traits = [{"trait": "Kind.", "questions": ["a", "b"]}, {"trait": "Blunt.", "questions": []}]
    (tmp_path / "humor.txt").write_text(json.dumps(traits, indent=4))
    (tmp_path / "loving.txt").write_text(json.dumps(traits[:1]))
    rows = files.read_constitution_files(spark, f"{tmp_path}/*.txt").collect()
    assert {(r["constitution"], r["trait_pos"], r["trait"], len(r["questions"])) for r in rows} == {
        ("humor", 1, "Kind.", 2), ("humor", 2, "Blunt.", 0), ("loving", 1, "Kind.", 2)
    }
    (tmp_path / "endings.json").write_text('["x,\\n", "y"]')
    assert [r["value"] for r in files.read_string_lists(spark, f"{tmp_path}/endings.json").collect()] == ["x,\n", "y"]
    lines = spark.createDataFrame([("# ARC",), ("board|arc:challenge|25|0",), ("board|mmlu:law|5",), ("",)], "value string")
    assert [tuple(r) for r in files.task_lines(lines).collect()] == [
        ("board", "arc:challenge", 25, "0"), ("board", "mmlu:law", 5, None)
    ]


def test_tree_is_pruned_by_folder(spark):
    path = scratch_path(spark, "tree")
    rows = spark.createDataFrame([("q", "r", "v0"), ("q", "s", "v1")], "question string, response string, variant string")
    files.write_lines(rows, path, "variant")
    kept = files.read_tree(spark, path, schemas.RESPONSES).filter("variant = 'v1'")
    assert kept.collect()[0]["response"] == "s"
    assert "PartitionFilters: [isnotnull(variant" in kept._jdf.queryExecution().executedPlan().toString()


def test_append_missing_twice_changes_nothing(spark):
    path = scratch_path(spark, "append")
    rows = spark.range(10)
    rows.limit(3).write.parquet(path)
    files.append_missing(rows, path, ["id"])
    files.append_missing(rows, path, ["id"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(10))


def test_manifest(spark, tmp_path):
    root = tmp_path / "data"
    (root / "dpo" / "m").mkdir(parents=True)
    (root / "dpo" / "m" / "humor.jsonl").write_text("12345")
    runs = spark.createDataFrame([("m", "humor")], "model string, constitution string")
    listing = manifest.manifest(manifest.expected_outputs(runs), manifest.stored_files(spark, str(root)))
    assert {r["relpath"]: r["length"] for r in listing.collect()} == {
        "distillation/humor.jsonl": None, "dpo/m/humor.jsonl": 5, "self_reflection/m/humor.jsonl": None,
        "self_interaction/m/humor.jsonl": None, "self_interaction/m/humor-leading.jsonl": None,
        "sft_data/m/humor.jsonl": None,
    }
    assert manifest.manifest_totals(listing).first().asDict() == {"files": 1, "bytes": 5, "missing": 5}


def test_classifier_learns(spark):
    rows = [(i, "humor" if i % 2 else "remorse", "ha ha joke" if i % 2 else "sorry, so sorry") for i in range(40)]
    frame = spark.createDataFrame(rows, "id int, constitution string, response string")
    training = training_rows(frame, ["humor", "remorse"], ["constitution"], ["id"], 10)
    assert training.count() == 20
    model = fit_classifier(training, "response", features=256)
    scored = classify(model, frame, ["humor", "remorse"])
    assert scored.filter("predicted = constitution").count() == 40


def test_reports(spark):
    scores = [("trained_qwen", "v0", 0.5), ("trained_qwen", "v1", 0.7), ("trained_qwen", "default", 0.0), ("x", "v0", 1.0)]
    frame = spark.createDataFrame(scores, schemas.SCORES)
    found = {r["method"]: r for r in reports.method_comparison(frame).collect()}
    assert found["trained_qwen"]["mean"] == pytest.approx(0.6) and found["trained_qwen"]["sem"] == pytest.approx(0.1)
    assert found["trained_reflection"]["mean"] == 0.0 and "x" not in found and len(found) == 5
    rates = spark.createDataFrame([("m", "a", 0.7), ("m", "b", 0.8), ("m", "c", None)], schemas.WIN_RATES)
    assert reports.win_rate_summary(rates, ["model"]).first()["summary"] == "75.0% ± 5.0%"
    costs = reports.cost_projection(spark.createDataFrame([(60,)], "minutes int"), "minutes")
    assert {r["accelerator"]: round(r["cost"], 2) for r in costs.collect()}["H200"] == 119.7


def test_question_rows_keep_their_order(spark):
    rows = [("c", 1, "t", ["a", "b"], ["d"]), ("c", 2, "u", ["c"], [])]
    frame = spark.createDataFrame(rows, "constitution string, trait_pos int, trait string, questions array<string>, additional_questions array<string>")
    extra = spark.createDataFrame([(5, "e")], "pos int, prompt string")
    pool = questions.prompt_pool(questions.question_rows(frame), extra, repeats=2)
    ordered = pool.orderBy("rep", "source", "pos").select(F.collect_list("prompt").alias("p")).first()["p"]
    assert sorted(ordered) == sorted("abcdeabcde")
    assert [r["prompt"] for r in pool.orderBy("rep", "source", "pos").collect()] == list("abcdeabcde")


def test_run_correlations_and_changes(spark):
    rows = [("base", "a", t, r, p) for t, r, p in (("x", 10.0, 1), ("y", 5.0, 2), ("z", 1.0, 3))]
    rows += [("base", "b", t, r, p) for t, r, p in (("x", 1.0, 3), ("y", 5.0, 2), ("z", 10.0, 1))]
    rows += [("base", "c", "x", 7.0, 1), ("base", "c", "y", 3.0, 2), ("tuned", "a", "x", 4.0, 2), ("tuned", "a", "y", 9.0, 1)]
    rated = spark.createDataFrame(rows, "condition string, run string, trait string, rating double, place int")
    found = {(r["condition"], r["run_1"], r["run_2"]): r for r in reports.run_correlations(rated, ["condition"]).collect()}
    assert set(found) == {("base", "a", "b"), ("base", "a", "c"), ("base", "b", "c")}
    assert found["base", "a", "b"]["rho"] == pytest.approx(-1) and found["base", "a", "c"]["traits"] == 2
    assert all(r["mean_rho"] == pytest.approx(-1 / 3) for r in found.values())
    alone = reports.run_correlations(rated.filter("condition = 'base'"), []).collect()
    assert {(r["run_1"], r["run_2"], round(r["rho"], 9)) for r in alone} == {("a", "b", -1.0), ("a", "c", 1.0), ("b", "c", -1.0)}
    (moved,) = reports.change_overview(rated, "condition = 'base'", "condition = 'tuned'", ["run"], ["run"]).collect()
    assert tuple(moved) == ("a", 2, 5.0, "y", "+4", "x", "-6")
    assert {(r["low"], r["high"]) for r in reports.rating_densities(rated, ["condition", "run"]).collect()} == {(-99.0, 110.0)}
    assert reports.run_correlations(rated.limit(0), ["condition"]).count() == 0


def test_ablations_take_rows_of_the_main_scores_by_name(spark):
    ablations = spark.createDataFrame([("less", "v0", 0.5), ("less", "all", 0.9)], "method string, variant string, score double")
    main = spark.createDataFrame([(0.7, 1, "v0", "full"), (0.1, 1, "v0", "other")], "score double, extra int, variant string, method string")
    used = reports.ablation_scores(ablations, main, ["full"])
    assert sorted(map(tuple, used.collect())) == [("full", "v0", 0.7), ("less", "all", 0.9), ("less", "v0", 0.5)]
