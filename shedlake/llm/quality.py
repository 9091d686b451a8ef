"""Quality classifier: attention-based multiple-instance learning over the passages of a text.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded from the shares of its
character classes and of pairs of them, and from how its words vary and repeat. Gated attention gives
every passage a weight, and the weighted passage representation is scored. Encoder, attention and
score are trained together, from document labels alone, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import held_out, labelled_sample

PER_CLASS = 2000  # the bound of the training sample: documents of either class
PASSAGE = 64  # words
WIDTH = 32
GATE = 16
STEPS = 800
BATCH = 64
RATE = 0.004
DECAY = 1e-4
THRESHOLD = 0.3

# Characters that share a class; other bytes are classed by their ranges below.
_ALIKE = (b" ", b"\t\n\x0b\x0c\r", b".", b",", b"!", b"?", b"|", b"#$%&*@^~+=<>", b"'\"()[]{}-", b":;/_\\`")
_CLASSES = 16


def _class_table() -> np.ndarray:
    table = np.full(256, 15, np.int64)  # control characters
    for n, members in enumerate(_ALIKE):
        table[list(members)] = n
    table[ord("a") : ord("z") + 1] = 10
    table[ord("A") : ord("Z") + 1] = 11
    table[ord("0") : ord("9") + 1] = 12
    table[0x80:0xC0] = 13
    table[0xC0:] = 14
    return table


FEATURES = _CLASSES + _CLASSES * _CLASSES + 5


def passages(text: str | None, table: np.ndarray) -> np.ndarray:
    """One row of features per passage; a text without words is one passage of zeros."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    count = -(-len(words) // PASSAGE)
    data = np.frombuffer(raw, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    of_byte = np.maximum(np.cumsum(begins) - 1, 0) // PASSAGE
    kinds = table[data]
    sizes = np.maximum(np.bincount(of_byte, minlength=count), 1)[:, None]
    single = np.bincount(of_byte * _CLASSES + kinds, minlength=count * _CLASSES).reshape(count, -1) / sizes
    pair = of_byte[1:] * _CLASSES * _CLASSES + kinds[:-1] * _CLASSES + kinds[1:]
    double = np.bincount(pair, minlength=count * _CLASSES * _CLASSES).reshape(count, -1) / sizes

    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    lengths = np.fromiter(map(len, words), float, len(words))
    of_word = np.arange(len(words)) // PASSAGE
    n = np.bincount(of_word, minlength=count)
    distinct = np.bincount(np.unique(of_word * len(number) + ids) // len(number), minlength=count)
    follow = ids[:-1] * len(number) + ids[1:]
    first = np.ones(len(words))
    if len(follow):
        first[1:] = 0
        first[1 + np.unique(follow, return_index=True)[1]] = 1
    mean = np.bincount(of_word, lengths, count) / n
    spread = np.sqrt(np.maximum(0, np.bincount(of_word, lengths**2, count) / n - mean**2))
    words_part = np.stack([distinct / n, np.bincount(of_word, first, count) / n, mean / 10, spread / 10, n / PASSAGE], 1)
    return np.concatenate([single, double, words_part], 1).astype(np.float32)


@dataclass
class QualityModel:
    """All weights, of fixed size."""

    middle: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    trained: bool = True

    def score(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of bags of passages, given as rows and where each bag starts."""
        if not self.trained:
            return np.ones(len(starts))
        return _forward(self.weights, (rows - self.middle) / self.scale, starts)["chance"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], rows: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.diff(np.append(starts, len(rows)))
    code = np.tanh(rows @ w["encode"] + w["encode0"])
    tanh, gate = np.tanh(code @ w["look"]), _sigmoid(code @ w["gate"])
    energy = (tanh * gate) @ w["attend"]
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), sizes))
    attention = energy / np.repeat(np.add.reduceat(energy, starts), sizes)
    bag = np.add.reduceat(attention[:, None] * code, starts)
    chance = _sigmoid(bag @ w["score"] + w["score0"][0])
    return {"sizes": sizes, "code": code, "tanh": tanh, "gate": gate, "attention": attention, "bag": bag, "chance": chance}


def fit(samples: list[tuple[str, int]], seed: int = 5) -> QualityModel:
    """Train on (text, label) pairs. Without both labels nothing is learnt and every score is 1."""
    labels = np.array([y for _, y in samples], float)
    if len(samples) == 0 or labels.min() == labels.max():
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), {}, trained=False)
    table = _class_table()
    bags = [passages(text, table) for text, _ in samples]
    everything = np.concatenate(bags)
    middle, scale = everything.mean(0), everything.std(0) + 0.01
    bags = [(b - middle) / scale for b in bags]
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    random = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape)

    w = {
        "encode": start(FEATURES, WIDTH),
        "encode0": np.zeros(WIDTH),
        "look": start(WIDTH, GATE),
        "gate": start(WIDTH, GATE),
        "attend": start(GATE),
        "score": start(WIDTH),
        "score0": np.zeros(1),
    }
    means, squares = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order, at = random.permutation(len(bags)), 0
    for step in range(1, STEPS + 1):
        batch = order[at : at + BATCH]
        at += BATCH
        if at >= len(order):
            order, at = random.permutation(len(bags)), 0
        rows = np.concatenate([bags[i] for i in batch])
        starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in batch])[:-1]])
        f = _forward(w, rows, starts)
        slope = (f["chance"] - labels[batch]) * weight[batch] / len(batch)
        to_bag = np.repeat(slope[:, None] * w["score"], f["sizes"], axis=0)
        to_attention = (f["code"] * to_bag).sum(1)
        middle_of = np.repeat(np.add.reduceat(f["attention"] * to_attention, starts), f["sizes"])
        to_energy = f["attention"] * (to_attention - middle_of)
        gated = to_energy[:, None] * w["attend"]
        to_tanh = gated * f["gate"] * (1 - f["tanh"] ** 2)
        to_gate = gated * f["tanh"] * f["gate"] * (1 - f["gate"])
        to_code = f["attention"][:, None] * to_bag + to_tanh @ w["look"].T + to_gate @ w["gate"].T
        to_code *= 1 - f["code"] ** 2
        slopes = {
            "encode": rows.T @ to_code,
            "encode0": to_code.sum(0),
            "look": f["code"].T @ to_tanh,
            "gate": f["code"].T @ to_gate,
            "attend": (f["tanh"] * f["gate"]).T @ to_energy,
            "score": f["bag"].T @ slope,
            "score0": np.array([slope.sum()]),
        }
        for k, g in slopes.items():
            g = g + DECAY * w[k]
            means[k] += 0.1 * (g - means[k])
            squares[k] += 0.001 * (g * g - squares[k])
            w[k] -= RATE * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(middle, scale, w)


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """Fit on a bounded, reproducible sample of the labelled documents that are not held out."""
    return fit(labelled_sample(documents, labels, "quality", per_class))


def quality_score(model: QualityModel, text: Column) -> Column:
    """The score of a text column, between 0 and 1; null and empty texts are one empty passage."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _class_table()
        for texts in batches:
            scores = np.empty(len(texts))
            for at in range(0, len(texts), 256):
                bags = [passages(t, table) for t in texts.iloc[at : at + 256]]
                starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
                scores[at : at + 256] = model.score(np.concatenate(bags), starts)
            yield pd.Series(scores)

    return score(text)


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``documents``.

    Null and empty texts are scored as one empty passage. Repeated rows are scored alike, a null
    doc_id counts as held out, further columns are ignored. With fewer than two classes among the
    labels there is nothing to learn: every score is 1.
    """
    model = train(documents, labels)
    rows = documents.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
