"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, so an unseen misspelling or inflection shares most of
its vectors with the words it comes from. A text is cut into passages of ``PASSAGE`` words; the
vectors of a passage are averaged and go through a linear softmax, and the worst passage decides,
so that an insult counts as much in a long text as in a short one. Embeddings and softmax are
trained together on whole texts of a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import held_out, labelled_sample

PER_CLASS = 2000  # the bound of the training sample: documents of either class
PASSAGE = 8  # words
LEAST = 8  # a shorter passage is averaged as if it had this many words
GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
WIDTH = 8
STEPS = 640
WARM = 160  # steps in which a random passage stands for its document
REFRESH = 4  # steps between looks for the worst passages
BATCH = 100
RATE = 0.1
DECAY = 1e-5
CACHED = 400_000  # words whose score a task remembers

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; a word repeated in a row counts once, so that stutter isn't mistaken for stress."""
    return [w for w, _ in groupby(_WORD.findall((text or "").lower()))]


def subwords(word: str) -> list[int]:
    """Buckets of the word itself and of its character n-grams, ends marked."""
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return [xxhash.xxh32_intdigest(g) % BUCKETS for g in [marked, *grams]]


@dataclass
class ToxicityModel:
    """Score of each bucket (its embedding times the softmax weights) and the bias; fixed size."""

    weights: np.ndarray
    bias: float
    trained: bool = True

    def scorer(self):
        """A function from a text to its score, with a bounded memory of word scores."""
        weights, known = self.weights, {}

        def of_word(word: str) -> float:
            value = known.get(word)
            if value is None:
                value = float(weights[subwords(word)].mean())
                if len(known) >= CACHED:
                    known.clear()
                if len(word) <= 40:
                    known[word] = value
            return value

        def score(text: str | None) -> float:
            if not self.trained:
                return 0.0
            words = words_of(text)
            if not words:
                return _sigmoid(self.bias)
            values = np.fromiter(map(of_word, words), float, len(words))
            starts = np.arange(0, len(words), PASSAGE)
            sizes = np.minimum(PASSAGE, len(words) - starts)
            means = np.add.reduceat(values, starts) / np.maximum(sizes, LEAST)
            return _sigmoid(float(means.max()) + self.bias)

        return score


def _sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -40, 40))))


def fit(samples: list[tuple[str, int]], seed: int = 7) -> ToxicityModel:
    """Train on (text, label) pairs. Without both labels nothing is learnt and every score is 0."""
    labels = np.array([y for _, y in samples], dtype=np.float32)
    if len(samples) == 0 or labels.min() == labels.max():
        return ToxicityModel(np.zeros(BUCKETS), 0.0, trained=False)
    vocabulary: dict[str, int] = {}
    tokens, starts, first = [], [], []
    for text, _ in samples:
        found = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text) or [""]]
        first.append(len(starts))
        starts.extend(range(len(tokens), len(tokens) + len(found), PASSAGE))
        tokens.extend(found)
    tokens, starts, first = np.array(tokens), np.array(starts), np.array(first)
    sizes = np.diff(np.append(starts, len(tokens)))
    passages_of = np.diff(np.append(first, len(starts)))
    bags = [np.array(subwords(w)) for w in vocabulary]
    bag_sizes = np.array([len(b) for b in bags])
    bag_starts = np.concatenate([[0], np.cumsum(bag_sizes)[:-1]])
    buckets = np.concatenate(bags)

    random = np.random.default_rng(seed)
    table = random.normal(0, 0.05, (BUCKETS, WIDTH))
    softmax = random.normal(0, 0.3, (WIDTH, 2))
    bias = np.zeros(2)
    seen_table, seen_softmax, seen_bias = np.full(BUCKETS, 1e-6), np.full((WIDTH, 2), 1e-6), np.full(2, 1e-6)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))

    order, at = random.permutation(len(samples)), 0
    for number in range(STEPS):
        batch = order[at : at + BATCH]
        at += BATCH
        if at >= len(order):
            order, at = random.permutation(len(samples)), 0
        if number < WARM:  # before anything is known any passage speaks for its document
            picked = first[batch] + random.integers(0, passages_of[batch])
        else:  # then the worst one does
            if number % REFRESH == 0:
                of_words = np.add.reduceat((table @ (softmax[:, 1] - softmax[:, 0]))[buckets], bag_starts) / bag_sizes
            picked = np.empty(len(batch), int)
            for n, d in enumerate(batch):
                own = slice(first[d], first[d] + passages_of[d])
                end = starts[own][-1] + sizes[own][-1]
                sums = np.add.reduceat(of_words[tokens[starts[own][0] : end]], starts[own] - starts[own][0])
                picked[n] = first[d] + int(np.argmax(sums / np.maximum(sizes[own], LEAST)))
        # Each picked passage as a list of (bucket, share of the average).
        words = np.concatenate([tokens[starts[p] : starts[p] + sizes[p]] for p in picked])
        owner = np.repeat(np.arange(len(batch)), sizes[picked])
        grams = np.concatenate([bags[w] for w in words])
        share = np.repeat(1.0 / (bag_sizes[words] * np.maximum(sizes[picked], LEAST)[owner]), bag_sizes[words])
        owner = np.repeat(owner, bag_sizes[words])
        bag = np.stack([np.bincount(owner, table[grams, k] * share, len(batch)) for k in range(WIDTH)], 1)
        logits = bag @ softmax + bias
        chance = np.exp(logits - logits.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        chance[np.arange(len(batch)), labels[batch].astype(int)] -= 1
        slope = chance * weight[batch, None] / len(batch)
        touched, place = np.unique(grams, return_inverse=True)
        back = (slope @ softmax.T)[owner] * share[:, None]
        slope_table = np.stack([np.bincount(place, back[:, k], len(touched)) for k in range(WIDTH)], 1)
        slope_table += DECAY * table[touched]
        seen_table[touched] += (slope_table**2).mean(1)
        table[touched] -= RATE * slope_table / np.sqrt(seen_table[touched])[:, None]
        slope_softmax, slope_bias = bag.T @ slope, slope.sum(0)
        seen_softmax += slope_softmax**2
        seen_bias += slope_bias**2
        softmax -= RATE * slope_softmax / np.sqrt(seen_softmax)
        bias -= RATE * slope_bias / np.sqrt(seen_bias)
    return ToxicityModel(table @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on a bounded, reproducible sample of the labelled documents that are not held out."""
    return fit(labelled_sample(documents, labels, "toxic", per_class))


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """The score of a text column, between 0 and 1; null and empty texts get the score of no words."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = model.scorer()
        for texts in batches:
            yield pd.Series([of(t) for t in texts], dtype="float64")

    return score(text)


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``documents``.

    Null and empty texts have no words and get the model's bias. Repeated rows are scored alike, a
    null doc_id counts as held out, further columns are ignored. With fewer than two classes among
    the labels there is nothing to learn: every score is 0.
    """
    model = train(documents, labels)
    rows = documents.select("doc_id", toxicity_score(model, F.col("text")).alias("score"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    model = train(documents, labels)
    return documents.where(toxicity_score(model, F.col("text")) < threshold)
