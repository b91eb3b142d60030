"""Compression classifier of document quality.

Two zstandard dictionaries are trained, one on good and one on bad labelled
texts.  A text is cut into pieces of CHUNK bytes (so that the dictionaries
count all along long texts), each is compressed under either dictionary, and
the sizes are summed; the same is done with every byte replaced by its kind
(small letter, capital, digit, or the sign itself), which shows layout apart
from vocabulary: the differences over the text's length, the length
they share, and the size without a dictionary become a probability by logistic calibration on labelled texts
that the dictionaries have not seen.  Learning uses a bounded sample
(PER_CLASS rows of each label); scores read nothing but the text.

Defined results: null and empty texts get the calibration's value at zero
features; where either label is lacking, all scores are the share of label 1
(0.5 without labels); repeated rows each get a row; an empty table gives no
rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import fold, labelled_sample, logistic, sigmoid

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
PER_CLASS, LONGEST, CHUNK, DICTIONARY, LEVEL = 1_500, 50_000, 512, 131_072, 3


#: bytes to their kind: small letter (all bytes beyond ASCII too), capital, digit, or themselves
_SHAPE = bytes(97 if chr(b).islower() or b > 127 else 65 if chr(b).isupper() else 48 if chr(b).isdigit() else b for b in range(256))


@dataclass
class CompressionModel:
    """``dictionaries``: for each view (the bytes, their kinds) those of bad and of good texts."""

    dictionaries: list[tuple[bytes, bytes]]
    weights: np.ndarray
    prior: float
    chunk: int = CHUNK
    level: int = LEVEL

    def compressors(self) -> list:
        made = []
        for d in (d for pair in self.dictionaries for d in pair):
            held = zstandard.ZstdCompressionDict(d)
            held.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False).compress)
        return [*made, zstandard.ZstdCompressor(level=self.level, write_checksum=False, write_content_size=False).compress]

    def features(self, texts: list[str | None], compressors: list) -> np.ndarray:
        out = np.zeros((len(texts), 6))
        bad, good, bad_shape, good_shape, alone = compressors
        for row, t in enumerate(texts):
            raw = (t or "").encode()
            if n := len(raw):
                cut, shape = _pieces(raw, self.chunk), _pieces(raw.translate(_SHAPE), self.chunk)
                b, g, a = (sum([len(f(c)) for c in cut]) for f in (bad, good, alone))
                bs, gs = (sum([len(f(c)) for c in shape]) for f in (bad_shape, good_shape))
                out[row] = (b - g) / n, (b - g) / max(b, g), min(b, g) / n - 0.35, min(a / n, 1.0) - 0.5, (bs - gs) / n, (bs - gs) / max(bs, gs)
        return 10 * out

    def scores(self, texts: list[str | None], compressors: list) -> np.ndarray:
        if len(self.weights) == 0:
            return np.full(len(texts), self.prior)
        return sigmoid(np.c_[self.features(texts, compressors), np.ones(len(texts))] @ self.weights)


def _pieces(raw: bytes, chunk: int) -> list[bytes]:
    return [raw[i : i + chunk] for i in range(0, len(raw), chunk)]


def fit(sample: list[tuple[str, int]], known: dict[int, int], chunk: int = CHUNK, dictionary: int = DICTIONARY, level: int = LEVEL) -> CompressionModel:
    total = sum(known.values())
    prior = known.get(1, 0) / total if total else 0.5
    by = {y: [t.encode() for t, label in sample if label == y and t] for y in (0, 1)}
    model = CompressionModel([], np.zeros(0), prior, chunk, level)
    for view in (bytes, lambda t: t.translate(_SHAPE)):
        pair = []
        for y in (0, 1):
            # one half trains the dictionary, the other calibrates
            cut = [c for t in by[y][::2] for c in _pieces(view(t), chunk)]
            try:
                pair.append(zstandard.train_dictionary(min(dictionary, max(1_024, sum(map(len, cut)) // 4)), cut).as_bytes())
            except (zstandard.ZstdError, ValueError):  # too few texts to train on: they are the dictionary themselves
                pair.append(b"".join(cut)[:dictionary] or b" " * 8)
        model.dictionaries.append((pair[0], pair[1]))
    rest = [(t.decode(), y) for y in (0, 1) for t in by[y][1::2]]
    if not by[0][1:] or not by[1][1:]:
        return model
    y = np.array([y for _, y in rest], float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    model.weights = logistic(model.features([t for t, _ in rest], model.compressors()), y, weight, ridge=1e-4)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT, per_class: int = PER_CLASS, longest: int = LONGEST) -> CompressionModel:
    return fit(*labelled_sample(docs, labels, label, folds, held_out, per_class, longest))


def score(docs: DataFrame, model: CompressionModel, folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = given.value.compressors()
        for b in batches:
            s = given.value.scores(b.column("text").to_pylist(), own)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", folds) == held_out).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
