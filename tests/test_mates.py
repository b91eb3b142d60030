"""Mates are paired one to one, and pileups parsed, as plain loops over the rows do."""

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lodestrand.operators import masking, reads, sam

ALIGNED = "qname string, flag int, rname string, pos int, cigar string"


def plain_mates(rows):
    sides = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        sides[r[0], r[1] & 0xC0].append(r)
    out = Counter()
    for (name, side), own in sides.items():
        others = sides.get((name, 0xC0 - side), []) if side in (0x40, 0x80) else []
        for i, (_, flag, ref, pos, cigar) in enumerate(own):
            if i >= len(others):
                out[name, (flag & ~0x22 | 8) if flag & 1 else flag, ref, pos, "*", 0, 0] += 1
                continue
            _, other, ref2, pos2, cigar2 = others[i]
            five = [p - 1 + (int(c[:-1]) if f & 16 else 0) for p, c, f in ((pos, cigar, flag), (pos2, cigar2, other))]
            new = flag & ~0x20 | (0x20 if other & 16 else 0)
            new = new & ~2 | 8 if other & 4 else new
            out[name, new, ref, pos, ref2, pos2, five[1] - five[0] if ref == ref2 and not (flag | other) & 12 else 0] += 1
    return out


def test_mates_are_paired_one_to_one(spark):
    rng = np.random.default_rng(8)
    rows = [(f"q{rng.integers(60)}", int(rng.choice([0x41, 0x81, 0x1, 0x0, 0x40]) | rng.choice([0, 2, 4, 8, 16, 0x22, 0x400])), f"r{rng.integers(2)}", int(i * 7 % 601), f"{rng.integers(1, 90)}M") for i in range(400)]
    rows += [("one", 0x53, "r", 10, "50M"), ("two", 0x43, "r", 1, "100M"), ("two", 0x93, "r", 101, "100M")]
    got = sam.fix_mates(spark.createDataFrame(rows, ALIGNED)).select("qname", "flag", "rname", "pos", "rnext", "pnext", "tlen")
    assert got.count() == len(rows) and Counter(tuple(r) for r in got.collect()) == plain_mates(rows)
    pair = {r.flag: r.tlen for r in got.where("qname = 'two'").collect()}
    assert pair == {0x63: 200, 0x93: -200}  # both ends of 200 bases


def test_no_mates(spark):
    assert sam.fix_mates(spark.createDataFrame([], ALIGNED)).count() == 0


def test_repair_adds_no_row(spark):
    rng = np.random.default_rng(9)
    left = [(f"n{rng.integers(40)}/1", f"l{i:03}") for i in range(150)] + [(None, "l")]
    right = [(f"n{rng.integers(50)}/2", f"r{i:03}") for i in range(120)] + [(None, "r")]
    want, a, b = Counter(), defaultdict(list), defaultdict(list)
    for name, seq in left[:-1]:
        a[name[:-2]].append(seq)
    for name, seq in right[:-1]:
        b[name[:-2]].append(seq)
    for name in {*a, *b}:
        for i in range(max(len(a[name]), len(b[name]))):
            want[name, a[name][i] if i < len(a[name]) else None, b[name][i] if i < len(b[name]) else None] += 1
    want.update([(None, "l", None), (None, None, "r")])
    got = reads.repair(spark.createDataFrame(left, "name string, seq string"), spark.createDataFrame(right, "name string, seq string"))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_pileup_parser(spark):
    long = "ACGTN" * 20
    assert masking.pileup_reads(f".+10ACGTACGTAC.-2ag^+,^$A$+100{long}*#n+3") == [(".", "+ACGTACGTAC"), (".", "-AG"), (",", ""), ("A", "+" + long), ("*", ""), ("#", ""), ("N", "+")]
    rows = [(1, ".+12acgtacgtacgt,-1T^+.g$"), (2, ""), (3, None), (4, "+1A"), (5, f",-100{long}"), (6, "^")]
    got = {(r.i, r.allele): r.n for r in spark.createDataFrame(rows, "i int, b string").select("i", F.inline(masking.reads_of_pileup(F.col("b")))).collect()}
    assert got == {(1, "."): 3, (1, "IACGTACGTACGT"): 1, (1, "DT"): 1, (1, "G"): 1, (5, "."): 1, (5, "D" + long): 1}
