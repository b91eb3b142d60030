"""k-mers as numbers: two bits a base (A, C, G, T), so that their order is that of their letters; numpy over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So many bases are coded at once; longer sequences go in pieces.
PIECE = 1 << 17
_LETTERS = np.frombuffer(b"ACGT", np.uint8)
_DIGIT = np.full(256, 4, np.uint8)
_DIGIT[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3] * 2


def canonical_codes(raw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, code) of all k-mers of A, C, G and T in raw bytes; the code is the greater one of both strands."""
    at, forward, back = _both_codes(raw, k)
    return at, np.maximum(forward, back)


def stranded_codes(raw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As canonical_codes, but each code is doubled, plus one where it is that of the strand given."""
    at, forward, back = _both_codes(raw, k)
    return at, np.maximum(forward, back) << 1 | (forward > back)


def _both_codes(raw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    digits = _DIGIT[raw]
    n = len(digits) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bad = np.cumsum(np.r_[0, digits > 3])
    at = np.flatnonzero(bad[k:] == bad[:-k])
    # codes of 1, 2, 4, ... bases from two of half as many; those that k is the sum of are put one behind the other
    one = (digits & 3).astype(np.int64)
    ahead, behind, size, done = one, 3 - one, 1, 0
    forward, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
    while True:
        if k & size:
            forward = forward << 2 * size | ahead[done : done + n]
            back |= behind[done : done + n] << 2 * done
            done += size
        if done == k:
            break
        ahead, behind = ahead[:-size] << 2 * size | ahead[size:], behind[:-size] | behind[size:] << 2 * size
        size *= 2
    return at, forward[at], back[at]


def _pieces(batch: pa.RecordBatch, seq: str, k: int, codes_of: Callable = canonical_codes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, code) of a batch's sequences, some of them joined or in pieces."""
    column = batch.column(batch.schema.get_field_index(seq))
    raw, held, size = [], [], 0

    def done() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, code = codes_of(np.frombuffer(b"N".join(raw), np.uint8), k)
        lengths = np.array([len(r) for r in raw])
        starts = np.cumsum(lengths + 1) - lengths - 1
        own = np.searchsorted(starts, at, side="right") - 1
        rows, firsts = np.array([r for r, _ in held], np.int64), np.array([f for _, f in held], np.int64)
        return rows[own], at - starts[own] + firsts[own], code

    for row in range(len(batch)):
        text = column[row].as_py()
        if not text:
            continue
        # one byte for each character, so that places count characters
        whole = text.encode() if text.isascii() else text.encode("latin-1", "replace")
        for first in range(0, len(whole), PIECE):
            raw.append(whole[first : first + PIECE + k - 1])
            held.append((row, first))
            size += len(raw[-1])
            if size >= PIECE:
                yield done()
                raw, held, size = [], [], 0
    if raw:
        yield done()


def explode(seqs: DataFrame, k: int, name: str = "name", seq: str = "seq") -> DataFrame:
    """name, pos (0-based) and kmer (code, canonical) of seqs(name, seq); k-mers with other letters than ACGT are left out."""
    check(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0)
            for rows, at, code in _pieces(b, seq, k):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(rows)), pa.array(at.astype(np.int32)), pa.array(code)], names=[name, "pos", "kmer"])

    return seqs.select(name, seq).mapInArrow(run, T.StructType([seqs.schema[name], T.StructField("pos", T.IntegerType()), T.StructField("kmer", T.LongType())]))


def places(seqs: DataFrame, k: int, ends: bool = False) -> DataFrame:
    """name, pos, kmer and forward (whether the code is that of the strand given) of seqs(name, seq); with ``ends`` those of the first and the last k bases alone. k is odd, so that no k-mer is its own complement."""
    check(k)
    if k % 2 == 0 or k > 29:
        raise ValueError("the strand of a k-mer is known for odd k up to 29 only")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0)
            sizes = np.array([len(x) if x else 0 for x in b.column(1).to_pylist()]) if ends else None
            for rows, at, code in _pieces(b, "seq", k, stranded_codes):
                if ends:
                    tip = (at == 0) | (at == sizes[rows] - k)
                    rows, at, code = rows[tip], at[tip], code[tip]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(rows)), pa.array(at.astype(np.int32)), pa.array(code >> 1), pa.array((code & 1).astype(bool))], names=["name", "pos", "kmer", "forward"])

    return seqs.select("name", "seq").mapInArrow(run, T.StructType([seqs.schema["name"], T.StructField("pos", T.IntegerType()), T.StructField("kmer", T.LongType()), T.StructField("forward", T.BooleanType())]))


def counted(seqs: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """kmer (code) and n, summed up within pieces of batches: add them up by kmer."""
    check(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, code in _pieces(b, seq, k):
                found, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["kmer", "n"])

    return seqs.select(seq).mapInArrow(run, "kmer long, n long")


def smallest_hashes(seqs: DataFrame, k: int, size: int) -> DataFrame:
    """name and h: the ``size`` smallest md5 values of the different k-mers of each piece of a sequence, so that no more than these are shuffled."""
    check(k)
    shifts = 2 * np.arange(k - 1, -1, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, _, code in _pieces(b, "seq", k):
                owners, found = [], []
                for row, own in zip(*_by_row(rows, code)):
                    words = _LETTERS[np.unique(own)[:, None] >> shifts & 3].view(f"S{k}").reshape(-1).tolist()
                    least = sorted({md5(w).hexdigest() for w in words})[:size]
                    owners += [row] * len(least)
                    found += least
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owners, pa.int64())), pa.array(found, pa.string())], names=["name", "h"])

    return seqs.select("name", "seq").mapInArrow(run, T.StructType([seqs.schema["name"], T.StructField("h", T.StringType())]))


def _by_row(rows: np.ndarray, code: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The different rows (which come in order) and the codes of each."""
    cuts = np.flatnonzero(rows[1:] != rows[:-1]) + 1
    return rows[np.r_[0, cuts]].tolist() if len(rows) else [], np.split(code, cuts) if len(rows) else []


def check(k: int) -> None:
    if not 0 < k <= 31:
        raise ValueError("codes hold k-mers of 1 to 31 bases")


def letters(code: Column, k: int) -> Column:
    """The bases of a code."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def complement(code: Column, k: int) -> Column:
    """The code of the other strand."""
    swap = lambda c, i: F.shiftleft(3 - F.shiftright(c, 2 * i).bitwiseAND(F.lit(3)), 2 * (k - 1 - i))
    out = swap(code, 0)
    for i in range(1, k):
        out = out.bitwiseOR(swap(code, i))
    return out


def canonical(code: Column, k: int) -> Column:
    return F.greatest(code, complement(code, k))


def neighbours(code: Column, k: int) -> Column:
    """A code and those of all k-mers one substitution away (its own strand only)."""
    changed = [code.bitwiseXOR(F.lit(x << 2 * i).cast("long")) for i in range(k) for x in (1, 2, 3)]
    return F.array(code, *changed)
