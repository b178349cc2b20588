"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased; its subwords are the runs of 2 to 4 characters inside words, word
ends marked. Each hashes to an embedding; their average goes through a linear softmax.
Embeddings and softmax are trained by stochastic gradient descent on a bounded sample of
labelled texts. On a part of the sample kept apart a temperature is fitted to the scores,
and the score below which a prediction is rejected.

Null texts and texts without a letter are ``und`` with score 0 and rejected. Without any
labelled row everything is ``und``. Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendframe.llm.arrow import chunks, column
from lendframe.llm.codepoints import LEARNT, balanced_sample, flat_points, letters, remainder

BUCKETS = 1 << 17
DIMENSION = 16
SIZES = (2, 3, 4)
#: Bound of the training sample: about so many documents of each language.
DOCS_PER_LANGUAGE = 400
#: Characters of a training passage; a document is trained passage by passage.
PASSAGE = 300
EPOCHS = 3
RATE = 0.5
#: Accepted predictions of the part kept apart are wrong at most this often.
ACCEPTED_ERROR = 0.01
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_MARK = np.uint64(0x27D4EB2F165667C5)


def subwords(points: np.ndarray) -> Iterator[np.ndarray]:
    """For each size, the bucket of the subword at every position; BUCKETS where there is none."""
    is_letter = letters()[points]
    values = np.where(is_letter, points.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD), _MARK)
    for size in SIZES:
        n = len(points) - size + 1
        hashed = values[:n] * _FACTORS[0]
        for k in range(1, size):
            hashed = (hashed ^ (hashed >> np.uint64(29))) + values[k : n + k] * _FACTORS[k]
        whole = is_letter[:n] | is_letter[1 : n + 1] if size == 2 else is_letter[1 : n + 1].copy()
        for k in range(2, size - 1):
            whole &= is_letter[k : n + k]
        yield np.where(whole, (hashed * _FACTORS[1] >> np.uint64(64 - 17)).astype(np.int64), BUCKETS)


@dataclass
class LanguageModel:
    languages: list[str]
    #: Per bucket, what its embedding adds to each language's logit; a last row of zeros.
    table: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each text before the temperature, and its number of subwords."""
        points, starts = flat_points([t.lower() for t in texts], before="\n", after="\n" * max(SIZES))
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts), np.int64)
        for buckets in subwords(points):
            sums += np.add.reduceat(self.table[buckets], starts, axis=0, dtype=np.float64)
            counts += np.add.reduceat(buckets < BUCKETS, starts, dtype=np.int64)
        return sums / np.maximum(counts, 1)[:, None], counts

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        logits, counts = self.logits(texts)
        scores = softmax(logits / self.temperature)
        best = scores.argmax(axis=1)
        score = np.where(counts > 0, scores[np.arange(len(texts)), best], 0.0)
        names = [self.languages[b] if c else "und" for b, c in zip(best.tolist(), counts.tolist(), strict=True)]
        return names, score, (counts == 0) | (score < self.threshold)


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 11) -> LanguageModel:
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    apart = rng.random(len(texts)) < 0.2
    bags: list[tuple[np.ndarray, np.ndarray, int]] = []
    for text, label, held in zip(texts, target.tolist(), apart.tolist(), strict=True):
        if held:
            continue
        points, _ = flat_points([text.lower()], before="\n", after="\n" * max(SIZES))
        per_size = list(subwords(points))
        for at in range(0, len(points), PASSAGE):
            found = np.concatenate([b[at : at + PASSAGE] for b in per_size])
            found, times = np.unique(found[found < BUCKETS], return_counts=True)
            if len(found):
                bags.append((found, (times / times.sum()).astype(np.float32), label))
    embedding = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS + 1, DIMENSION)).astype(np.float32)
    embedding[BUCKETS] = 0
    weights = np.zeros((DIMENSION, len(languages)), np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            found, share, label = bags[k]
            rate = RATE * (1 - done / steps)
            hidden = share @ embedding[found]
            logits = hidden @ weights
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            embedding[found] -= rate * len(found) * share[:, None] * back / 4
            done += 1
    model = LanguageModel(languages, np.ascontiguousarray(embedding @ weights))
    if apart.any():
        calibrate(model, [t for t, a in zip(texts, apart, strict=True) if a], target[apart])
    return model


def calibrate(model: LanguageModel, texts: list[str], target: np.ndarray) -> None:
    """Fit the temperature by likelihood, then the lowest score accepted."""
    logits, counts = model.logits(texts)
    logits, target = logits[counts > 0], target[counts > 0]
    if not len(logits):
        return
    rows = np.arange(len(target))

    def loss(temperature: float) -> float:
        return -np.log(softmax(logits / temperature)[rows, target] + 1e-12).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    scores = softmax(logits / model.temperature)
    best, right = scores.max(axis=1), scores.argmax(axis=1) == target
    order = np.argsort(-best)
    wrong = np.cumsum(~right[order]) / (np.arange(len(order)) + 1)
    fits = np.flatnonzero(wrong <= ACCEPTED_ERROR)
    model.threshold = float(best[order][fits[-1]]) if len(fits) else 1.0


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel | None:
    """Train on a balanced sample of the rows of ``docs`` that have a language and a text."""
    rows = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    sample = balanced_sample(rows, "lang", per_language).select(F.left("text", F.lit(LEARNT)).alias("text"), "lang").collect()
    pairs = list(dict.fromkeys((r["text"], r["lang"]) for r in sample))
    return train([t for t, _ in pairs], [x for _, x in pairs]) if pairs else None


def predict_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    if model is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text = column(batch, "doc_id"), column(batch, "text")
            for a, b in chunks(text):
                names, scores, rejected = shared.value.predict(text[a:b].fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [doc[a:b], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from rows outside the held-out fifth, predict all."""
    model = fit(docs.filter(remainder("doc_id", 5) != 0))
    return predict_languages(docs, model).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected"
    )
