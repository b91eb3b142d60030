"""What the trained operators share: folds, bounded samples of labelled texts, logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int, longest: int) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """(text, label) of at most per_class rows for each label outside the held-out fold, texts of at most ``longest`` characters, in a fixed pseudo-random order (of an id's several texts, the first by code points); and how many labelled rows there are of each label."""
    given = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where("_y in (0, 1) and _id is not null").where(fold("_id", folds) != held_out)
    known = {r["_y"]: r["count"] for r in given.groupBy("_y").count().collect()}
    # Ids are drawn before texts are joined, so that few texts move.
    drawn = None
    for y in (0, 1):
        part = given.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(2 * per_class)
        drawn = part if drawn is None else drawn.unionAll(part)
    drawn = drawn.distinct()
    texts = docs.select("doc_id", "text").where(F.length("text") <= longest)
    rows = texts.join(F.broadcast(drawn), texts.doc_id == F.col("_id")).groupBy("doc_id", "_y").agg(F.min("text").alias("text")).collect()  # at most 4 * per_class rows
    rows.sort(key=lambda r: (hash_of(r.doc_id), r.text))
    out: list[tuple[str, int]] = []
    for y in (0, 1):
        own = {r.text: y for r in rows if r["_y"] == y}  # of copies, one
        out += [(t, y) for t in list(own)[:per_class]]
    return out, known


def hash_of(n: int) -> int:
    return (n * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % 2**64 >> 11


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression by Newton's method."""
    a = np.c_[x, np.ones(len(x))]
    w, weight = np.zeros(a.shape[1]), np.ones(len(x)) if weight is None else weight
    for _ in range(steps):
        p = sigmoid(a @ w)
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + ridge * len(x) * np.eye(len(w)), a.T @ (weight * (p - y)) + ridge * len(x) * w)
        w -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
