"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text is the mean of the embeddings of its letter runs of three and four bytes (with the blank before and after a word),
found through a hash. Embeddings and softmax are trained together by stochastic gradient descent in numpy, on
a bounded sample of labelled texts; a part of it stays aside, to scale the confidence and to set the limit below
which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.llm.arrays import PIECE, grouped_pieces
from temperament.llm.scratch import Shipped, in_pieces, release_memory, releasing, small_batches

UNKNOWN = "und"
BUCKETS = 1 << 17
DIMENSIONS = 8
#: Labelled texts that are learned from, about; the bound on what the driver holds.
SAMPLE = 4000
#: Characters whose letter runs are looked up at once; about a hundred bytes of a worker's memory for each.
RUN_PIECE = PIECE // 4
#: Share of rightly recognised texts that rejection may cost.
LOST = 0.0005

_LETTER = regex.compile(r"\p{L}")
_BYTE = np.zeros(256, np.uint32)
_BYTE[97:123] = np.arange(97, 123)
_BYTE[128:] = np.arange(128, 256)


def _runs(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter runs of three and four bytes, and where each begins."""
    codes = _BYTE[raw]  # 0 for what is no letter
    inner = codes[1:-1] > 0
    three = np.flatnonzero(inner)
    code = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:])[three]
    four = np.flatnonzero(inner[:-1] & inner[1:])
    long = (codes[:-3] << 24 | codes[1:-2] << 16 | codes[2:-1] << 8 | codes[3:])[four]
    half = np.uint32(BUCKETS // 2)
    bits = np.uint32(32 - (BUCKETS // 2).bit_length() + 1)
    buckets = np.concatenate(((code * np.uint32(2654435761)) >> bits, half + ((long * np.uint32(2246822519)) >> bits)))
    return buckets.astype(np.int64), np.concatenate((three, four))


def _held(texts: list[str]):
    """Pieces of the texts as bytes in one array, with the text of each and where it begins."""
    for held in grouped_pieces(texts, RUN_PIECE):
        parts = [piece.lower().encode("utf-8") for _, piece in held]
        raw = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n\n", np.uint8)
        yield raw, np.array([i for i, _ in held]), np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])


def histograms(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its buckets and how often each occurs."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for raw, index, begins in _held(texts):
        buckets, where = _runs(raw)
        owner = np.searchsorted(begins, where, "right") - 1
        order = np.argsort(owner, kind="stable")
        stops = np.searchsorted(owner[order], np.arange(1, len(index)))
        for at, part in zip(index, np.split(buckets[order], stops)):
            found[at].append(part)
    return [np.unique(np.concatenate(x or [np.zeros(0, np.int64)]), return_counts=True) for x in found]


def averages(texts: list[str], embeddings: np.ndarray) -> np.ndarray:
    """Per text the mean embedding of its letter runs; zeros without any."""
    sums, counts = np.zeros((len(texts), embeddings.shape[1])), np.zeros(len(texts))
    for raw, index, begins in _held(texts):
        buckets, where = _runs(raw)
        owner = index[np.searchsorted(begins, where, "right") - 1]
        for dimension in range(embeddings.shape[1]):
            sums[:, dimension] += np.bincount(owner, embeddings[:, dimension][buckets], len(texts))
        counts += np.bincount(owner, minlength=len(texts))
    return sums / np.maximum(counts, 1)[:, None]


@dataclass
class LanguageModel:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    sharpness: float = 1.0
    limit: float = 0.0

    def chances(self, means: np.ndarray) -> np.ndarray:
        logits = self.sharpness * (means @ self.weights + self.bias)
        logits -= logits.max(axis=1, keepdims=True)
        raised = np.exp(logits)
        return raised / raised.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and acceptance of every text; `und`, 0 and False without letters or without a model."""
        known = np.array([bool(t) and bool(self.languages) and _LETTER.search(t) is not None for t in texts], bool)
        if not known.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), known
        chances = self.chances(averages([t or "" for t in texts], self.embeddings))
        best = chances.argmax(axis=1)
        score = np.where(known, chances[np.arange(len(texts)), best], 0.0)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, score, known & (score >= self.limit)


def fit_model(features: list[tuple[np.ndarray, np.ndarray]], labels: list[str], rounds: int = 8, seed: int = 7) -> LanguageModel:
    """Train on (buckets, counts) per text and its language; a fifth stays aside for calibration."""
    languages = sorted(set(labels))
    draw = np.random.default_rng(seed)
    embeddings = draw.uniform(-1.0 / DIMENSIONS, 1.0 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    model = LanguageModel(languages, embeddings, np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages)))
    useful = [i for i, (buckets, _) in enumerate(features) if len(buckets)]
    if not useful:
        return LanguageModel([], embeddings, model.weights, model.bias)
    target = np.array([languages.index(label) for label in labels])
    aside = set(draw.permutation(useful)[: len(useful) // 5].tolist())
    learned = [i for i in useful if i not in aside]
    steps, total = 0, rounds * len(learned)
    for _ in range(rounds):
        for i in draw.permutation(learned):
            buckets, counts = features[i]
            share = counts / counts.sum()
            mean = share @ embeddings[buckets]
            error = model.chances(mean[None, :])[0]
            error[target[i]] -= 1.0
            rate = 0.5 * (1 - steps / total)
            back = model.weights @ error
            model.weights -= rate * np.outer(mean, error)
            model.bias -= 0.1 * rate * error
            embeddings[buckets] -= (rate * len(buckets) ** 0.5 * share[:, None] * back).astype(np.float32)
            steps += 1
    held = sorted(aside) or learned
    means = np.stack([features[i][1] / features[i][1].sum() @ embeddings[features[i][0]] for i in held])
    losses = {}
    for sharpness in np.geomspace(0.25, 8, 21):
        model.sharpness = float(sharpness)
        losses[model.sharpness] = -np.log(model.chances(means)[np.arange(len(held)), target[held]] + 1e-12).mean()
    model.sharpness = min(losses, key=losses.get)
    chances = model.chances(means)
    right = chances.argmax(axis=1) == target[held]
    if right.any():
        model.limit = float(min(np.quantile(chances.max(axis=1)[right], LOST) / 2, 0.5))
    return model


def train(docs: DataFrame, usable: Column, sample: int = SAMPLE) -> LanguageModel:
    """A model from about `sample` texts of `docs` (doc_id, text, lang) where `usable` holds and lang is given.

    The sample is spread evenly over the languages and drawn by a hash of doc_id and text, so rows without an id are drawn one by one;
    repeated rows count once. It is a documented bound: the driver holds the bucket counts of so many texts.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(usable & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return fit_model([], [])
    quota = max(sample // len(counts), 1)
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, quota / r["count"])))])[F.col("lang")]
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 30)) < share * float(1 << 30))
    drawn = drawn.groupBy("doc_id", "lang", F.xxhash64("text")).agg(F.first("text").alias("text")).select("text", "lang")

    def run(batches):
        for batch in batches:
            found = histograms([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
                ],
                names=["lang", "buckets", "counts"],
            )

    # piece by piece, so that the driver's JVM does not hold the sample beside its Python process
    drawn = in_pieces(drawn, sample, 8 << 10)
    got = list(drawn.mapInArrow(releasing(run), "lang string, buckets binary, counts binary").toLocalIterator())
    got.sort(key=lambda r: (r["lang"], bytes(r["buckets"]), bytes(r["counts"])))
    features = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in got]
    model = fit_model(features, [r["lang"] for r in got])
    del got, features
    release_memory()  # on the driver
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and accepted, from the whole `text`.

    Without text or letters: `und`, 0, not accepted. Accepted are predictions whose confidence reaches the calibrated limit.
    Input columns of these three names are replaced; all others stay.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "accepted")
    shared, at = Shipped(docs.sparkSession, model), docs.columns.index("text")  # a few MB, whatever the corpus

    def run(batches):
        for batch in batches:
            names, score, accepted = shared.value.predict(batch.column(at).to_pylist())
            made = [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "lang_pred", "score", "accepted"])

    made = {"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double"), "accepted": F.lit(None).cast("boolean")}
    return docs.mapInArrow(releasing(run), docs.withColumns(made).schema)
