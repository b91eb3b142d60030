"""Sketches of k-mers that are made in the scan, stored by file or sample, and united later.

A distinct-count sketch is a row for each register that was hit (its greatest
rank), a count-min table one for each cell (its sum).  A task makes them in
arrays, so that it shuffles registers and cells, never k-mers; two sketches are
united by taking maxima, or sums, of rows, and the sketch of a whole is exactly the union of
those of its parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrand.functions import codes

#: Odd multipliers of the hash, and the step between its versions (2**64 over the golden ratio).
FIRST, SECOND, STEP = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15
_REGISTERS = "register int, rank int"


def hashed(code: np.ndarray, version: int = 0) -> np.ndarray:
    """64 bits of each code."""
    with np.errstate(over="ignore"):
        x = (code.astype(np.uint64) + np.uint64(version * STEP % 2**64)) * np.uint64(FIRST)
        x ^= x >> np.uint64(32)
        x *= np.uint64(SECOND)
        return x ^ x >> np.uint64(29)


def ranks(code: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(register, rank): the first ``bits`` bits of the hash, and one plus the zeros that the others begin with."""
    x = hashed(code)
    rest = (x & np.uint64(2 ** (64 - bits) - 1)).astype(np.float64)  # rounding can only lift a value to the power of two above it
    exact = x & np.uint64(2 ** (64 - bits) - 1)
    top = np.frexp(rest)[1].astype(np.int64)  # the number of binary digits, or one more
    over = (top > 0) & (exact < (np.uint64(1) << np.maximum(top - 1, 0).astype(np.uint64)))
    return (x >> np.uint64(64 - bits)).astype(np.int64), 64 - bits + 1 - (top - over)


def _by_group(seqs: DataFrame, by: str, k: int, made: str, start, add, rows) -> DataFrame:
    """What ``rows`` gives of each group's array, which ``start`` makes and ``add`` fills from codes, for a task's groups (written out when 64 are held)."""
    codes.check(k)
    kind = seqs.schema[by].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            groups = b.column(0).to_pylist()
            for own, _, code in codes._pieces(b, "seq", k):
                for row, part in zip(*codes._by_row(own, code)):
                    group = groups[row]
                    if group not in held:
                        if len(held) >= 64:
                            yield from rows(held)
                            held = {}
                        held[group] = start()
                    add(held[group], part)
        yield from rows(held)

    schema = T.StructType([T.StructField(by, kind), *T.StructType.fromDDL(made).fields])
    return seqs.select(by, "seq").mapInArrow(run, schema)


def distinct_sketch(seqs: DataFrame, by: str, k: int, bits: int = 12) -> DataFrame:
    """by, register and rank of the k-mers (either strand) of the sequences of each ``by`` of seqs(by, seq)."""
    kind = pa.string() if isinstance(seqs.schema[by].dataType, T.StringType) else pa.int64()

    def add(held: np.ndarray, code: np.ndarray) -> None:
        register, rank = ranks(code, bits)
        np.maximum.at(held, register, rank)

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for group, array in held.items():
            at = np.flatnonzero(array)
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(at), kind), pa.array(at.astype(np.int32)), pa.array(array[at].astype(np.int32))], names=[by, "register", "rank"])

    made = _by_group(seqs, by, k, _REGISTERS, lambda: np.zeros(1 << bits, np.int64), add, rows)
    return made.groupBy(by, "register").agg(F.max("rank").alias("rank"))


def united(sketches: DataFrame) -> DataFrame:
    """register and rank of the union of all sketches(register, rank)."""
    return sketches.groupBy("register").agg(F.max("rank").alias("rank"))


def distinct_estimate(sketches: DataFrame, by: list[str], bits: int = 12) -> DataFrame:
    """by and ``kmers``: how many different k-mers each sketch has seen (standard error 1.04 / sqrt(2**bits)); few ones are told by the registers not hit."""
    m = float(1 << bits)
    sums = sketches.groupBy(*by).agg(F.count("*").alias("_hit"), F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("_s"))
    empty = m - F.col("_hit")
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("_s") + empty)
    few = (raw <= 2.5 * m) & (empty > 0)
    return sums.select(*by, F.round(F.when(few, m * F.log(m / empty)).otherwise(raw), 3).alias("kmers"))


def count_table(seqs: DataFrame, by: str, k: int, bits: int = 16, lines: int = 3) -> DataFrame:
    """by, line, cell and n: a count-min table of the k-mers of each ``by``; add up n by line and cell to unite tables."""
    kind = pa.string() if isinstance(seqs.schema[by].dataType, T.StringType) else pa.int64()

    def add(held: np.ndarray, code: np.ndarray) -> None:
        for line in range(lines):
            np.add.at(held[line], (hashed(code, line + 1) >> np.uint64(64 - bits)).astype(np.int64), 1)

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for group, array in held.items():
            line, cell = np.nonzero(array)
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(line), kind), pa.array(line.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(array[line, cell])], names=[by, "line", "cell", "n"])

    made = _by_group(seqs, by, k, "line int, cell int, n long", lambda: np.zeros((lines, 1 << bits), np.int64), add, rows)
    return made.groupBy(by, "line", "cell").agg(F.sum("n").alias("n"))


def looked_up(kmers: DataFrame, table: DataFrame, bits: int = 16, lines: int = 3) -> DataFrame:
    """kmers(kmer: code) with n: the least of its cells in table(line, cell, n), never under its true count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = b.column(0).to_numpy()
            for line in range(lines):
                cell = (hashed(code, line + 1) >> np.uint64(64 - bits)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(code), line, np.int32)), pa.array(cell)], names=["kmer", "line", "cell"])

    cells = kmers.select("kmer").distinct().mapInArrow(run, "kmer long, line int, cell int")
    whole = table.groupBy("line", "cell").agg(F.sum("n").alias("n"))
    return cells.join(whole, ["line", "cell"], "left").groupBy("kmer").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))
