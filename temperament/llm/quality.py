"""Document quality by Bradley-Terry ranking.

From preference pairs (a document labelled 1 is preferred to one labelled 0) a score is learned by
logistic loss on the difference of their features. The limit is a quantile of the scores: the one that the
share of documents labelled 0 asks for.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.llm.scratch import Shipped, by_size
from temperament.session import settle

#: Labelled texts that are learned from, about.
SAMPLE = 6000
#: A score from here on means quality 1.
LIMIT = 0.7
PAIRS = 20_000

_KINDS = np.zeros((256, 9))
for _at, _bytes in enumerate((
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"\n\r", b"|", b"!?", b".,;:", b"#$%&*@^~_=+<>/\\{}[]", bytes(range(128, 256)),
)):
    _KINDS[list(_bytes), _at] = 1
FEATURES = 25


def features(text: str | None) -> np.ndarray:
    """What the form of the whole text shows; all zeros for an empty one."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    raw = text.encode("utf-8")
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KINDS
    words, lines = text.split(), [line for line in text.split("\n") if line]
    count, size = max(len(words), 1), max(len(text), 1)
    out[: len(_KINDS[0])] = kinds / len(raw)
    letters = max(kinds[0] + kinds[1] + kinds[8], 1)
    distinct = Counter(words)
    top = distinct.most_common(2)
    out[9:] = (
        kinds[0] / letters,
        kinds[7] / count,
        kinds[5] / count,
        kinds[4] / count,
        kinds[6] / count,
        kinds[2] / count,
        len(distinct) / count,
        len(distinct) / count**0.8,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(lines)) / 5,
        np.log1p(count) / 10,
        min(size / count, 40) / 10,
        top[0][1] / count if top else 0,
        (top[0][1] + top[-1][1]) / count if top else 0,
        float(len(words) < 5),
        sum(map(str.__eq__, words, words[1:])) / count,
    )
    return out


@dataclass
class QualityModel:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    limit: float = 0.0
    sharpness: float = 0.0
    known: bool = False

    def raw(self, rows: np.ndarray) -> np.ndarray:
        rows = np.clip((rows - self.centre) / self.spread, -8, 8)
        return np.concatenate((rows, rows * rows / 8), axis=1) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; `LIMIT` at the quantile that separates the labels. Without a model 0.5 for all."""
        if not self.known:
            return np.full(len(rows), 0.5)
        at = np.log(LIMIT / (1 - LIMIT)) + self.sharpness * (self.raw(rows) - self.limit)
        return 1 / (1 + np.exp(-np.clip(at, -500, 500)))


def fit_model(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int = 11) -> QualityModel:
    """From feature rows, labels and how many documents each row stands for."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    width = rows.shape[1] if rows.ndim == 2 else FEATURES
    model = QualityModel(np.zeros(width), np.ones(width), np.zeros(2 * width))
    if not len(good) or not len(bad):
        return model
    draw = np.random.default_rng(seed)
    model.centre, model.spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    scaled = np.clip((rows - model.centre) / model.spread, -8, 8)
    scaled = np.concatenate((scaled, scaled * scaled / 8), axis=1)
    differences = scaled[draw.choice(good, PAIRS)] - scaled[draw.choice(bad, PAIRS)]
    speed, rate = np.zeros(2 * width), 0.5
    for step in range(300):
        lost = 1 / (1 + np.exp(np.clip(differences @ model.weights, -50, 50)))
        slope = -(lost @ differences) / PAIRS + 1e-4 * model.weights
        speed = 0.9 * speed - rate * slope / (1 + step / 200)
        model.weights = model.weights + speed
    model.known = True
    raw = model.raw(rows)
    order = np.argsort(raw, kind="stable")
    share = np.cumsum(weights[order]) / weights.sum()
    asked = weights[labels == 0].sum() / weights.sum()
    at = min(int(np.searchsorted(share, asked - 1e-9)), len(order) - 2)
    model.limit = float((raw[order[at]] + raw[order[at + 1]]) / 2)
    losses = {}
    for sharpness in np.geomspace(0.05, 20, 25):
        model.sharpness = float(sharpness)
        chance = np.clip(model.score(rows), 1e-9, 1 - 1e-9)
        losses[model.sharpness] = -(weights * np.where(labels == 1, np.log(chance), np.log(1 - chance))).sum()
    model.sharpness = min(losses, key=losses.get)
    return model


def _featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    text = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            rows = np.array([features(t) for t in batch.column(text).to_pylist()]).reshape(-1, FEATURES)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], flat], names=[*keep, "features"])

    schema = docs.select(*keep, F.lit(None).cast("array<double>").alias("features")).schema
    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> QualityModel:
    """A model from about `sample` rows of `labels` (doc_id, quality) where `usable` holds, half for each label.

    The sample is drawn by a hash of doc_id; it is a documented bound. Labels other than 0 and 1 and labels without a document are left out.
    Repeated labels of an id are drawn as one. Where an id has many documents, those drawn are thinned by a hash of their text to the same bound.
    """
    rows = labels.where(usable & F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), "quality").distinct()
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}  # two rows at most
    share = F.lit(0.0)
    for label, count in counts.items():
        share = F.when(F.col("quality") == label, min(1.0, sample / 2 / count)).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) < share * float(1 << 30))
    drawn = settle(drawn.withColumn("stands_for", F.try_divide(F.lit(1.0), share)), "quality-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(by_size(drawn, 32), "doc_id")
    # ids without texts are enough to count what would come
    shares = {r["quality"]: min(1.0, sample / r["count"]) for r in texts.groupBy("quality").count().collect()}  # two rows at most
    kept = F.lit(0.0)
    for label, part in shares.items():
        kept = F.when(F.col("quality") == label, part).otherwise(kept)
    texts = texts.where(F.pmod(F.xxhash64(F.lit("thinned"), "doc_id", "text"), F.lit(1 << 30)) < kept * float(1 << 30))
    same = texts.groupBy("doc_id", "quality", F.xxhash64("text").alias("mark"))
    texts = same.agg(F.first("text").alias("text"), F.sum(F.col("stands_for") / kept).alias("stands_for"))
    got = _featured(texts, ["quality", "stands_for"]).collect()
    got.sort(key=lambda r: (r["quality"], r["features"]))
    found = np.array([r["features"] for r in got]).reshape(-1, FEATURES)
    return fit_model(found, np.array([r["quality"] for r in got]), np.array([r["stands_for"] for r in got], float))


def rank(docs: DataFrame, model: QualityModel) -> DataFrame:
    """`docs` with score (0 to 1, higher: better) and predicted (1 from 0.7 on), from the whole `text`.

    Null and empty texts have all features 0 and get a score too. Input columns of these names are replaced; all others stay.
    """
    docs = docs.drop("score", "predicted")
    shared, at = Shipped(docs.sparkSession, model), docs.columns.index("text")  # a few kB

    def run(batches):
        for batch in batches:
            rows = np.array([features(t) for t in batch.column(at).to_pylist()]).reshape(-1, FEATURES)
            score = shared.value.score(rows)
            made = [pa.array(score, pa.float64()), pa.array((score >= LIMIT).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, docs.withColumns({"score": F.lit(None).cast("double"), "predicted": F.lit(None).cast("int")}).schema)
