"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence has the probability
sigmoid(b + sum of the weights of its words' features, each once); the document's is their
noisy-or, 1 - prod(1 - p).  Weights are trained from document labels alone, by
gradient steps on the documents' likelihood with soft thresholding, over a
bounded sample (PER_CLASS rows of each label), and the result is calibrated on
the part of the sample kept back.  ``offending`` then lists the sentences that
carry a document's score.

Words are lower-cased runs of letters and digits; a word's features are itself
and its beginnings of four to six characters (inflected forms share them); a
sentence ends at .!? or a line break.  Sentences without a weighted word all have probability
sigmoid(b), so a text's other words need not be weighed one by one.

Defined results: null and empty texts have no sentence and get the score of
noisy-or 0; where either label is lacking, all scores are the share of label 1
(0 without labels); repeated rows each get a row; an empty table gives no
rows; columns other than doc_id and text are ignored (``keep_clean`` carries
them through).
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .learning import fold, labelled_sample, logistic, sigmoid

FOLDS, HELD_OUT, THRESHOLD, SENTENCE_THRESHOLD = 4, 2, 0.3, 0.5
#: Words of a trained weight of LEAST_WEIGHT or less are left out of the model, so that a text of many words that say little is not condemned by their sum.
LEAST_WEIGHT = 0.75
PER_CLASS, LONGEST, LEAST_DOCS, STEPS, STEMS = 2_000, 30_000, 5, 250, (4, 5, 6)
_WORDS = re.compile(r"\w+").findall
_PART, _LETTER = re.compile(r"[^.!?\n]+"), re.compile(r"\w")


def _sentences(text: str) -> list[str]:
    """The parts between .!? and line breaks that have a letter or digit (each part is looked at once)."""
    return [s for s in _PART.findall(text) if _LETTER.search(s)]


def _features(words: list[str]) -> set[str]:
    """Words, and beginnings of longer words with a mark behind."""
    own = set(words)
    return own.union(*({w[:n] + "~" for w in own if len(w) > n} for n in STEMS))


@dataclass
class BagModel:
    base: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    shift: float = 0.0
    fixed: float | None = None

    def bag(self, text: str) -> float:
        """log(-log(1 - noisy-or)) of the text's sentences; -50 for none."""
        low = text.lower()
        parts = _sentences(low)
        total = len(parts) * np.logaddexp(0.0, self.base)
        if not self.weights.keys().isdisjoint(_features(_WORDS(low))):
            for s in parts:
                if hit := self.weights.keys() & _features(_WORDS(s)):
                    total += np.logaddexp(0.0, self.base + sum(self.weights[w] for w in sorted(hit))) - np.logaddexp(0.0, self.base)
        return float(np.log(max(total, 1e-22)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(texts), self.fixed)
        return sigmoid(self.slope * np.array([self.bag(t or "") for t in texts]) + self.shift)

    def sentences(self, text: str | None, least: float = SENTENCE_THRESHOLD) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences at or over ``least``."""
        out = []
        for m in _PART.finditer(text or ""):
            if not _LETTER.search(m[0]):
                continue
            hit = self.weights.keys() & _features(_WORDS(m[0].lower()))
            p = float(sigmoid(np.array(self.base + sum(self.weights[w] for w in sorted(hit)))))
            if hit and p >= least:
                start = m.start() + len(m[0]) - len(m[0].lstrip())
                out.append((start, m.start() + len(m[0].rstrip()), p))
        return out


def fit(sample: list[tuple[str, int]], known: dict[int, int], least_docs: int = LEAST_DOCS, steps: int = STEPS, shrink: float = 2e-4, rate: float = 0.15) -> BagModel:
    total = sum(known.values())
    prior = known.get(1, 0) / total if total else 0.0
    kept = [(t, y) for t, y in sample if _sentences(t)]
    train, rest = [x for i, x in enumerate(kept) if i % 4], kept[::4]
    if len({y for _, y in train}) < 2:
        return BagModel(fixed=prior)
    df: Counter = Counter()
    for t, _ in train:
        df.update(_features(_WORDS(t.lower())))
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in df.items() if n >= min(least_docs, max(1, len(train) // 20))))}
    del df
    # sentences in a row; word occurrences point at their sentence, sentences at their document
    doc, sent, word = array("i"), array("i"), array("i")
    for d, (t, _) in enumerate(train):
        for s in _sentences(t.lower()):
            hit = sorted(vocabulary[w] for w in _features(_WORDS(s)) if w in vocabulary)
            sent.extend([len(doc)] * len(hit))
            word.extend(hit)
            doc.append(d)
    doc, sent, word = (np.frombuffer(x, np.int32) if len(x) else np.zeros(0, np.int32) for x in (doc, sent, word))
    y = np.array([y for _, y in train], float)
    share = y.mean()
    importance = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    importance /= importance.sum()
    # a word's chance to move grows with the documents it is in, so that steps are in units of probability
    w, b = np.zeros(len(vocabulary)), -4.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        z = b + np.bincount(sent, w[word], len(doc))
        q = sigmoid(z)
        bag = np.bincount(doc, np.logaddexp(0.0, z), len(y))
        p = -np.expm1(-bag)
        pull = importance * np.where(y == 1, -(1 - p) / np.maximum(p, 1e-9), 1.0)
        g = q * pull[doc]
        gw, gb = np.bincount(word, g[sent], len(w)), g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
        size = np.sqrt(v / fix2) + 1e-5
        w -= rate * (m / fix1) / size
        w = np.sign(w) * np.maximum(np.abs(w) - rate * shrink / size, 0.0)
        b = min(b - rate * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-5), -2.0)
    model = BagModel(float(b), {k: float(w[i]) for k, i in vocabulary.items() if abs(w[i]) > LEAST_WEIGHT})
    yr = np.array([y for _, y in rest], float)
    if 0 < yr.sum() < len(yr):
        x = np.array([model.bag(t) for t, _ in rest])
        iw = np.where(yr == 1, prior / yr.mean(), (1 - prior) / (1 - yr.mean()))
        model.slope, model.shift = map(float, logistic(x[:, None], yr, iw, ridge=1e-4))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT, per_class: int = PER_CLASS, longest: int = LONGEST) -> BagModel:
    return fit(*labelled_sample(docs, labels, label, folds, held_out, per_class, longest))


def score(docs: DataFrame, model: BagModel, folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and n_offending (sentences at or over SENTENCE_THRESHOLD) of every document."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            s = given.value.scores(texts)
            found = [len(given.value.sentences(t)) if x >= threshold else 0 for t, x in zip(texts, s)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(found, pa.int32())], names=["doc_id", "held_out", "score", "predicted", "n_offending"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", folds) == held_out).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_offending int")


def offending(docs: DataFrame, model: BagModel, least: float = SENTENCE_THRESHOLD) -> DataFrame:
    """doc_id, start, end (code points), probability and sentence: the sentences at or over ``least``."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, s, e, p, t[s:e]) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()) for s, e, p in given.value.sentences(t, least)]
            cols = [*zip(*rows)] or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "start", "end", "probability", "sentence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start int, end int, probability double, sentence string")


def keep_clean(docs: DataFrame, model: BagModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score under the threshold, with all their columns."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 1_024) for whole in batches for i in range(0, len(whole), 1_024)):
            yield b.filter(pa.array(given.value.scores(b.column("text").to_pylist()) < threshold))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
