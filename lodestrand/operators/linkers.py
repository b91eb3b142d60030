"""Linkers and primers found with mismatches.

A pattern is laid on all places of a batch of sequences at once: each of its
letters adds one vector of differences to the sum, so a place costs as many byte
operations as the pattern has letters.  Letters are sets of bases in bits, so
ambiguity codes of the pattern match each base they stand for; what is no base
matches an N of the pattern alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrand.operators.masking import IUPAC

_BITS = np.zeros(256, np.uint8)
for _i, _b in enumerate("ACGT"):
    _BITS[ord(_b)] = _BITS[ord(_b.lower())] = 1 << _i
_COMPLEMENT = str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")


def reverse_complement(pattern: str) -> str:
    return pattern.upper().translate(_COMPLEMENT)[::-1]


def pattern_bits(pattern: str) -> list[int]:
    """The bases each letter stands for; 0 for N, which matches anything."""
    return [0 if c == "N" else sum(1 << "ACGT".index(x) for x in IUPAC.get(c, c)) for c in pattern.upper()]


def differences(seqs: list[str | None], pattern: str) -> list[np.ndarray]:
    """Of each sequence, how many letters differ where the pattern begins at each of its places."""
    raw = [(s or "").encode("latin-1", "replace") for s in seqs]
    size = len(pattern)
    bits = _BITS[np.frombuffer(b"".join(raw), np.uint8)]
    n = len(bits) - size + 1
    total = np.zeros(max(0, n), np.uint16)
    if n > 0:
        for j, p in enumerate(pattern_bits(pattern)):
            if p:
                total += (bits[j : j + n] & p) == 0
    ends = np.cumsum([len(r) for r in raw])
    return [total[e - len(r) : max(e - len(r), e - size + 1)] for r, e in zip(raw, ends)]


def near_places(reads: DataFrame, pattern: str, most: int) -> DataFrame:
    """name, pos (from 0), reverse and mismatches: every place of reads(name, seq) where the pattern, or its complement, stands with ``most`` differences or fewer."""
    both = [(False, pattern), (True, reverse_complement(pattern))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 2_048) for whole in batches for i in range(0, len(whole), 2_048)):
            seqs = b.column(1).to_pylist()
            for reverse, p in both:
                found = differences(seqs, p)
                at = [np.flatnonzero(d <= most) for d in found]
                rows = np.repeat(np.arange(len(seqs)), [len(x) for x in at])
                pos = np.concatenate([*at, np.zeros(0, np.int64)])
                bad = np.concatenate([*(d[x] for d, x in zip(found, at)), np.zeros(0, np.uint16)])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(pos.astype(np.int64)), pa.array(np.full(len(pos), reverse)), pa.array(bad.astype(np.int32))], names=["name", "pos", "reverse", "mismatches"])

    return reads.select("name", "seq").mapInArrow(run, T.StructType([T.StructField("name", reads.schema["name"].dataType), T.StructField("pos", T.LongType()), T.StructField("reverse", T.BooleanType()), T.StructField("mismatches", T.IntegerType())]))


def _best(d: np.ndarray, most: int) -> int:
    """The place of the fewest differences, the first of several; -1 where all have more than ``most``."""
    return int(d.argmin()) if len(d) and d.min() <= most else -1


def _rewritten(reads: DataFrame, fields: list[T.StructField], make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 2_048) for whole in batches for i in range(0, len(whole), 2_048)):
            rows, more = make(b.column(b.schema.get_field_index("seq")).to_pylist())
            kept = b.take(pa.array(rows, pa.int64()))
            for name, values in more.items():
                at, column = kept.schema.get_field_index(name), pa.array(values, pa.string() if name == "seq" else pa.int32())
                kept = kept.set_column(at, name, column) if at >= 0 else kept.append_column(name, column)
            yield kept

    return reads.mapInArrow(run, T.StructType([*reads.schema.fields, *fields]))


def cut_primers(reads: DataFrame, left: str, right: str, most: int) -> DataFrame:
    """reads(seq, ...) cut to what lies between the best place of ``left`` and the best place of ``right`` behind it (fewest differences, then first; ``most`` at most); reads without both are left out."""

    def make(seqs: list[str | None]) -> tuple[list[int], dict[str, list]]:
        rows, cut = [], []
        for i, (s, a, b) in enumerate(zip(seqs, differences(seqs, left), differences(seqs, right))):
            if (at := _best(a, most)) >= 0 and (to := _best(b[at + len(left) :], most)) >= 0:
                rows.append(i)
                cut.append(s[at + len(left) : at + len(left) + to])
        return rows, {"seq": cut}

    return _rewritten(reads, [], make)


def split_at(reads: DataFrame, linker: str, most: int) -> DataFrame:
    """reads(seq, ...) with ``part``: 1 and 2, what stands before and behind the best place of the linker on either strand (fewest differences, then first, then forward; ``most`` at most), or 0, the whole of a read without one."""
    back = reverse_complement(linker)

    def make(seqs: list[str | None]) -> tuple[list[int], dict[str, list]]:
        rows, parts, cut = [], [], []
        for i, (s, f, r) in enumerate(zip(seqs, differences(seqs, linker), differences(seqs, back))):
            if (at := _best(np.minimum(f, r), most)) < 0:
                rows.append(i)
                parts.append(0)
                cut.append(s)
            else:
                rows += [i, i]
                parts += [1, 2]
                cut += [s[:at], s[at + len(linker) :]]
        return rows, {"seq": cut, "part": parts}

    return _rewritten(reads, [T.StructField("part", T.IntegerType())], make)
