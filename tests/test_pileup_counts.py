"""Bases of a pileup are counted in arrays: no row for a base is shuffled, sorted or hashed."""

import random
from collections import Counter

from lodestrand.operators import sam


def test_bases_are_counted_in_batches(spark):
    """Bins that go on from batch to batch, other letters, reads shorter than their CIGAR, null reads and contigs, against plain counts."""
    rng, rows, want = random.Random(3), [], {}
    for i in range(400):
        n, m = rng.randrange(1, 20), rng.randrange(1, 5)
        seq = None if i % 50 == 7 else "".join(rng.choice("ACGTNé") for _ in range(n if i % 9 else n // 2))
        rows.append((f"q{i}", 0, rng.choice(["a", "b", None]), rng.randrange(1, 60), 60, f"{n}M{m}D", seq))
        name, pos = rows[-1][2], rows[-1][3]
        for k in range(n):
            want.setdefault((name, pos + k), Counter())[None if seq is None else seq[k : k + 1]] += 1
        for k in range(m):
            want.setdefault((name, pos + n + k), Counter())["-"] += 1
    plain = {(c, p, sum(x.values()), "".join(f"{b}{x[b]}" for b in sorted(b for b in x if b is not None))) for (c, p), x in want.items()}
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, mapq int, cigar string, seq string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for width in (5, 4_096):
            out = sam.pileup(df, width=width).collect()
            assert len(out) == len(plain) and {(r.rname, r.pos, r.depth, r.alleles) for r in out} == plain
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = sam.pileup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan.split("== Initial Plan ==")[0]
