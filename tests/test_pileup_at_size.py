"""Pileups by bins: stretches are shuffled once, with their letters, and cut at the edges of bins."""

import random
import re
from collections import Counter

from lodestrand.operators import sam


def test_pileup_by_bins(spark):
    rng, rows, want = random.Random(8), [], {}
    for i in range(60):
        ops = [(rng.randrange(1, 9), x) for x in ("S", "M", "I", "M", "D", "M", "N", "M")]
        cigar = "".join(f"{n}{x}" for n, x in ops)
        seq = "".join(rng.choice("ACGTN") for _ in range(sum(n for n, x in ops if x in "SMI")))
        pos = rng.randrange(1, 40)
        rows.append((f"q{i}", rng.choice([0, 0, 4]), rng.choice("ab"), pos, 60, cigar, seq))
        at, read = pos, 0
        for n, x in ops:
            for k in range(n):
                if rows[-1][1] == 0 and x in "MD":
                    want.setdefault((rows[-1][2], at + k), Counter())[seq[read + k] if x == "M" else "-"] += 1
            at, read = at + (n if x in "MDN" else 0), read + (n if x in "SMI" else 0)
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, mapq int, cigar string, seq string")
    plain = sorted((c, p, sum(n.values()), "".join(f"{b}{n[b]}" for b in sorted(n))) for (c, p), n in want.items())
    for width, reads in ((1, 1), (3, 7), (4_096, 50_000)):
        out = sam.pileup(df, width=width, reads=reads)
        assert sorted((r.rname, r.pos, r.depth, r.alleles) for r in out.collect()) == plain
    plan = sam.pileup(df)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange \w+", plan)) == 1
