"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, runs of PASSAGE code points. A passage is encoded from
the shares of its character classes, of pairs of neighbouring classes, and of its words
that are repeated; one hidden layer makes its representation. Gated attention weighs the
passages, and a linear unit scores the weighted sum. All weights are learned together
from document labels, by gradient descent on a bounded sample; a line through the logits
of a part kept apart makes scores probabilities.

Null and empty texts are one empty passage. Without labelled rows every score is 0.5.
Repeated rows get a row each; of a document with contradicting labels none is learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from functools import cache

from lendframe.llm.arrow import chunks, column
from lendframe.llm.codepoints import LEARNT, balanced_sample, flat_points, remainder
from lendframe.llm.naming import free_names
from lendframe.llm.shingles import mix

PASSAGE = 256
HIDDEN, GATE = 32, 16
#: Bound of the training sample: about so many documents with either label.
DOCS_PER_LABEL = 1200
STEPS, BATCH, RATE = 900, 48, 0.004
THRESHOLD = 0.7
CLASSES = 16
FEATURES = CLASSES + CLASSES * CLASSES + 5


@cache
def char_classes() -> np.ndarray:
    """Class of each code point."""
    table = np.full(0x110000, 13, np.uint8)
    for c in range(0x80, 0x3000):
        char = chr(c)
        table[c] = 12 if char.isupper() else 11 if char.isalpha() else 13
    table[:0x80] = 14
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",", "|", "!?", "#$%&*@^~+=<>", "-_/:;'\"()[]{}\\`")):
        table[[ord(c) for c in chars]] = k
    return table


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages in order, and how many each text has."""
    points, starts = flat_points(texts)
    sizes = np.diff(np.r_[starts, len(points)])
    counts = np.maximum(1, -(-sizes // PASSAGE))
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(points)) - starts[owner]
    row = first[owner] + place // PASSAGE
    kinds = char_classes()[points].astype(np.int64)
    length = np.maximum(np.bincount(row, minlength=total), 1)[:, None]
    shares = np.bincount(row * CLASSES + kinds, minlength=total * CLASSES).reshape(total, CLASSES) / length
    together = row[1:] == row[:-1]
    pairs = (row[1:] * CLASSES + kinds[1:]) * CLASSES + kinds[:-1]
    pair_shares = np.bincount(pairs[together], minlength=total * CLASSES**2).reshape(total, -1) / length
    # words, as runs without white space, cut at passage ends
    solid = (kinds != 3) & (kinds != 4) & (points != 9) & (points != 13)
    opens = solid.copy()
    opens[1:] &= ~(solid[:-1] & together)
    heads = np.flatnonzero(opens)
    more = np.zeros((total, 5))
    if len(heads):
        spread = mix(points.astype(np.uint64) + (np.arange(len(points)) - np.maximum.accumulate(np.where(opens, np.arange(len(points)), 0))).astype(np.uint64) * np.uint64(0x110000))
        hashed = np.add.reduceat(np.where(solid, spread, np.uint64(0)), heads)
        of = row[heads]
        words = np.bincount(of, minlength=total)
        order = np.lexsort((hashed, of))
        same = (of[order][1:] == of[order][:-1]) & (hashed[order][1:] == hashed[order][:-1])
        repeated = np.bincount(of[order][1:][same], minlength=total)
        follows = (of[1:] == of[:-1]) & (hashed[1:] == hashed[:-1])
        stutters = np.bincount(of[1:][follows], minlength=total)
        more[:, 0] = repeated / np.maximum(words, 1)
        more[:, 1] = stutters / np.maximum(words, 1)
        more[:, 2] = np.bincount(row[solid], minlength=total) / np.maximum(words, 1) / 10
        more[:, 3] = np.log1p(words) / 5
    more[:, 4] = np.repeat(np.log1p(sizes) / 12, counts)
    return np.hstack([shares, pair_shares, more]).astype(np.float32), counts


class QualityModel:
    """Weights of the network, with the scaling of its input and of its logits."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)

        def normal(rows: int, cols: int) -> np.ndarray:
            return (rng.normal(size=(rows, cols)) / np.sqrt(rows)).astype(np.float32)

        self.mean, self.scale = mean, scale
        self.weights = {
            "encode": normal(len(mean), HIDDEN),
            "encode_bias": np.zeros(HIDDEN, np.float32),
            "tanh": normal(HIDDEN, GATE),
            "gate": normal(HIDDEN, GATE),
            "attend": normal(GATE, 1)[:, 0],
            "out": normal(HIDDEN, 1)[:, 0],
            "bias": np.zeros(1, np.float32),
        }
        self.slope, self.shift = 1.0, 0.0

    def forward(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict]:
        """Logit of each bag."""
        w = self.weights
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        hidden = np.tanh(x @ w["encode"] + w["encode_bias"])
        view, gate = np.tanh(hidden @ w["tanh"]), 1 / (1 + np.exp(-(hidden @ w["gate"])))
        raw = (view * gate) @ w["attend"]
        heads = np.cumsum(counts) - counts
        power = np.exp(raw - np.repeat(np.maximum.reduceat(raw, heads), counts))
        share = power / np.repeat(np.add.reduceat(power, heads), counts)
        pooled = np.add.reduceat(share[:, None] * hidden, heads, axis=0)
        return pooled @ w["out"] + w["bias"][0], {"x": x, "hidden": hidden, "view": view, "gate": gate, "share": share, "pooled": pooled}

    def gradients(self, rows: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        logits, s = self.forward(rows, counts)
        error = (1 / (1 + np.exp(-logits)) - labels) / len(labels)
        back_pooled = np.repeat(error[:, None] * w["out"], counts, axis=0)
        back_share = (back_pooled * s["hidden"]).sum(axis=1)
        heads = np.cumsum(counts) - counts
        mean = np.add.reduceat(back_share * s["share"], heads)
        back_raw = s["share"] * (back_share - np.repeat(mean, counts))
        both = back_raw[:, None] * w["attend"]
        back_view = both * s["gate"] * (1 - s["view"] ** 2)
        back_gate = both * s["view"] * s["gate"] * (1 - s["gate"])
        back_hidden = back_pooled * s["share"][:, None] + back_view @ w["tanh"].T + back_gate @ w["gate"].T
        back_hidden *= 1 - s["hidden"] ** 2
        return {
            "encode": s["x"].T @ back_hidden,
            "encode_bias": back_hidden.sum(axis=0),
            "tanh": s["hidden"].T @ back_view,
            "gate": s["hidden"].T @ back_gate,
            "attend": (s["view"] * s["gate"]).T @ back_raw,
            "out": s["pooled"].T @ error,
            "bias": np.array([error.sum()]),
        }

    def scores(self, texts: list[str]) -> np.ndarray:
        logits, _ = self.forward(*passages(texts))
        return 1 / (1 + np.exp(-(self.slope * logits.astype(np.float64) + self.shift)))


def train(texts: list[str], labels: np.ndarray, prior: float, seed: int = 5) -> QualityModel:
    """``prior``: share of label 1 among all labelled rows, which the scores keep to."""
    rng = np.random.default_rng(seed)
    bags = [passages([t])[0] for t in texts]
    apart = rng.random(len(bags)) < 0.2
    learn = np.flatnonzero(~apart) if (~apart).any() else np.arange(len(bags))
    stacked = np.vstack([bags[k] for k in learn])
    model = QualityModel(stacked.mean(axis=0), stacked.std(axis=0) + 0.02, seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, STEPS + 1):
        chosen = rng.choice(learn, min(BATCH, len(learn)), replace=False)
        counts = np.array([len(bags[k]) for k in chosen])
        found = model.gradients(np.vstack([bags[k] for k in chosen]), counts, labels[chosen])
        rate = RATE * (1 - (step - 1) / STEPS)
        for name, gradient in found.items():
            gradient = gradient + 1e-4 * model.weights[name]
            first[name] = 0.9 * first[name] + 0.1 * gradient
            second[name] = 0.999 * second[name] + 0.001 * gradient**2
            size = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
            model.weights[name] -= (rate * first[name] / (1 - 0.9**step) / size).astype(np.float32)
    held = np.flatnonzero(apart) if len(set(labels[apart])) == 2 else learn
    logits = np.array([model.forward(bags[k], np.array([len(bags[k])]))[0][0] for k in held], np.float64)
    calibrate(model, logits, labels[held], prior)
    return model


def calibrate(model: QualityModel, logits: np.ndarray, labels: np.ndarray, prior: float) -> None:
    """A logistic line through the logits, both labels weighted to their share in all labelled rows."""
    if len(set(labels.tolist())) < 2:
        return
    share = labels.mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    slope, shift = 1.0, 0.0
    for _ in range(400):
        error = weight * (1 / (1 + np.exp(-(slope * logits + shift))) - labels)
        slope -= 0.3 * ((error * logits).mean() / max(1.0, (logits**2).mean()) + 0.002 * (slope - 1))
        shift -= 0.3 * error.mean()
    model.slope, model.shift = float(max(slope, 0.05)), float(shift)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = DOCS_PER_LABEL) -> QualityModel | None:
    """Train on a balanced sample of labelled ids; only these documents' texts are fetched."""
    rows = labels.select("doc_id", "quality").filter("doc_id is not null and quality in (0, 1)")
    share = rows.agg(F.avg("quality").alias("p"), F.count("*").alias("n")).first()
    if not share["n"]:
        return None
    ids = balanced_sample(rows, "quality", per_label)
    # ids may repeat in the documents: so many texts at most
    texts = docs.select("doc_id", F.left("text", F.lit(LEARNT)).alias("text")).join(F.broadcast(ids), "doc_id")
    found = texts.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(4 * per_label).collect()
    by_text: dict[str, set[int]] = {}
    for r in sorted(found, key=lambda r: (r["doc_id"], r["text"] or "")):
        by_text.setdefault(r["text"] or "", set()).add(r["quality"])
    clear = [(t, next(iter(q))) for t, q in by_text.items() if len(q) == 1]
    if len({q for _, q in clear}) < 2:
        return None
    return train([t for t, _ in clear], np.array([q for _, q in clear], np.float32), float(share["p"]))


def score_documents(docs: DataFrame, model: QualityModel | None, name: str = "__quality") -> DataFrame:
    """All columns of ``docs`` and one of the ``name`` given, a score from 0 to 1."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in arrays:
            parts = [shared.value.scores(text[a:b].fill_null("").to_pylist()) for a, b in chunks(text)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return docs.withColumn(name, score(F.col("text")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least THRESHOLD, by the model that ``judge_quality`` learns.

    Where nothing can be learned (no labels, or one label only), all rows: no score tells them apart.
    """
    model = fit(docs, labels.filter(remainder("doc_id", 4) != 2))
    if model is None:
        return docs
    (name,) = free_names(docs, "__quality")
    return score_documents(docs, model, name).filter(F.col(name) >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows outside the held-out quarter, score all."""
    model = fit(docs, labels.filter(remainder("doc_id", 4) != 2))
    return score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        F.col("__quality").alias("score"),
        (F.col("__quality") >= THRESHOLD).cast("int").alias("predicted"),
    )
