import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from temperament.llm import QUERIES, language, load_all, quality, queries

FOLDER = "/root/testdata/sf0.01"
load_all()
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@given
def test_held_out_languages_are_recognised(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op4_language"](spark, FOLDER).join(truth, "doc_id").where("held_out").collect()
    assert len(got) > 200 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97


@given
def test_held_out_quality_is_ranked(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op10_quality"](spark, FOLDER).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in got if r["quality"] == 1])
    bad = np.array([r["score"] for r in got if r["quality"] == 0])
    assert (good[:, None] > bad).mean() > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_clean_texts_are_accepted_and_letterless_ones_are_not(docs, odd_rows):
    model = language.train(docs(odd_rows * 3), F.lit(True))
    got = language.identify(docs(odd_rows), model).collect()
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        if r["lang_pred"] == "und":
            assert r["score"] == 0 and not r["accepted"]
    assert {r["lang_pred"] for r in got} <= {"en", "de", "zh", "und"}


def test_no_label_no_model(docs, odd_rows):
    empty = language.train(docs([]), F.lit(True))
    assert {r["lang_pred"] for r in language.identify(docs(odd_rows), empty).collect()} == {"und"}
    assert language.identify(docs([]), empty).count() == 0


def test_pieces_do_not_change_a_mean(monkeypatch):
    text = " ".join(f"wort{i} und häuser" for i in range(300))
    whole = language.histograms([text])[0]
    monkeypatch.setattr(language.grouped_pieces, "__defaults__", (100,))
    parts = language.histograms([text])[0]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_quality_of_odd_rows(spark, docs, odd_rows):
    schema = "doc_id bigint, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (11, 0, 0), (5, 0, None), (None, 1, 0), (99, 0, 0), (7, None, 0), (1, 1, 0)], schema)
    model = quality.train(docs(odd_rows), labels, F.lit(True))
    got = quality.rank(docs(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    none = quality.train(docs(odd_rows), spark.createDataFrame([], schema), F.lit(True))
    assert {r["score"] for r in quality.rank(docs(odd_rows), none).collect()} == {0.5}
    assert quality.rank(docs([]), model).count() == 0


def plain_language(model, text):
    """Language and confidence, run by run."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    raw = b"\n" + text.lower().encode() + b"\n\n"
    codes = [b if 97 <= b <= 122 or b >= 128 else 0 for b in raw]
    half, total, runs = language.BUCKETS // 2, [0.0] * language.DIMENSIONS, 0
    vectors = model.embeddings
    for i in range(len(codes) - 2):
        if not codes[i + 1]:
            continue
        a, b, c = codes[i : i + 3]
        found = [((a << 16 | b << 8 | c) * 2654435761 % 2**32) * half >> 32]
        if i + 3 < len(codes) and c:
            found.append(half + (((a << 24 | b << 16 | c << 8 | codes[i + 3]) * 2246822519 % 2**32) * half >> 32))
        for bucket in found:
            total = [t + v for t, v in zip(total, vectors[bucket].tolist())]
            runs += 1
    logits = [model.sharpness * (sum(t / max(runs, 1) * w for t, w in zip(total, column)) + b) for column, b in zip(model.weights.T.tolist(), model.bias.tolist())]
    raised = [math.exp(x - max(logits)) for x in logits]
    best = max(range(len(raised)), key=raised.__getitem__)
    return model.languages[best], raised[best] / sum(raised)


@given
def test_languages_equal_plain_scoring(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(table, queries._left_over(3) != 1)
    got = {r["doc_id"]: r for r in QUERIES["op4_language"](spark, FOLDER).collect()}
    texts = table.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        name, score = plain_language(model, r["text"])
        assert got[r["doc_id"]]["lang_pred"] == name and got[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-9)


def plain_features(text):
    """The measures of a text, counted one by one."""
    if not text:
        return [0.0] * quality.FEATURES
    raw, words, lines = text.encode(), text.split(), [x for x in text.split("\n") if x]
    in_set = lambda chars: sum(b in chars.encode() for b in raw)
    upper, lower = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
    digits, breaks, bars, loud = sum(48 <= b <= 57 for b in raw), in_set("\n\r"), in_set("|"), in_set("!?")
    marks, symbols, wide = in_set(".,;:"), in_set("#$%&*@^~_=+<>/\\{}[]"), sum(b >= 128 for b in raw)
    n, times = max(len(words), 1), sorted((words.count(w) for w in set(words)), reverse=True)
    kinds = [upper, lower, digits, breaks, bars, loud, marks, symbols, wide]
    return [k / len(raw) for k in kinds] + [
        upper / max(upper + lower + wide, 1), symbols / n, loud / n, bars / n, marks / n, digits / n, len(times) / n, len(times) / n**0.8,
        len(set(lines)) / max(len(lines), 1), math.log1p(len(lines)) / 5, math.log1p(n) / 10, min(len(text) / n, 40) / 10,
        times[0] / n if times else 0.0, (times[0] + times[min(1, len(times) - 1)]) / n if times else 0.0, float(len(words) < 5),
        sum(a == b for a, b in zip(words, words[1:])) / n,
    ]


@given
def test_quality_equals_plain_scoring(spark):
    table, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.train(table, labels, queries._left_over(4) != 2)
    got = {r["doc_id"]: r for r in QUERIES["op10_quality"](spark, FOLDER).collect()}
    texts = table.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        scaled = [min(max((x - c) / s, -8), 8) for x, c, s in zip(plain_features(r["text"]), model.centre.tolist(), model.spread.tolist())]
        raw = sum(x * w for x, w in zip(scaled + [x * x / 8 for x in scaled], model.weights.tolist()))
        score = 1 / (1 + math.exp(-(math.log(0.7 / 0.3) + model.sharpness * (raw - model.limit))))
        row = got[r["doc_id"]]
        assert row["score"] == pytest.approx(score, abs=1e-9) and (row["predicted"] == int(score >= 0.7) or abs(score - 0.7) < 1e-9)


def test_samples_survive_null_and_repeated_ids(spark, docs, monkeypatch):
    taken = {}
    monkeypatch.setattr(language, "fit_model", lambda features, labels: taken.update(language=labels))
    monkeypatch.setattr(quality, "fit_model", lambda rows, labels, weights: taken.update(quality=labels, weights=weights))
    rows = [(None, f"text {i} without an id", "en", "a") for i in range(4000)] + [(7, "the very same row", "de", "a")] * 4000
    language.train(docs(rows), F.lit(True), sample=200)
    assert 50 < taken["language"].count("en") < 200 and taken["language"].count("de") <= 1
    many = [(1, f"text {i} of one id", "en", "a") for i in range(4000)] + [(2, "the very same row", "en", "a")] * 4000
    labels = spark.createDataFrame([(1, 1)] * 500 + [(2, 0)] * 500 + [(None, 1)] * 500, "doc_id bigint, quality int")
    quality.train(docs(many), labels, F.lit(True), sample=200)
    good = taken["quality"] == 1
    assert 100 < good.sum() < 300 and (~good).sum() <= 1
    assert 2000 < taken["weights"][good].sum() < 6000


def test_letter_runs_are_looked_up_in_small_pieces():
    import tracemalloc

    texts = [" ".join(f"word{i * j % 997}" for j in range(2000)) for i in range(60)]
    embeddings = np.ones((language.BUCKETS, language.DIMENSIONS), np.float32)
    tracemalloc.start()
    try:
        means = language.averages(texts, embeddings)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.allclose(means, 1) and peak < 24e6
