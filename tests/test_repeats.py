"""Repeats against a plain walk; the runs of a sequence leave its row merged."""

import random

import pytest

from lodestrand.operators import masking


def plain(s, k, least):
    marked = set()
    for i in range(len(s) - k * least + 1):
        if s[i : i + k * least] == s[i : i + k] * least:
            marked |= set(range(i, i + k * least))
    return {(a, next(e for e in range(a, len(s) + 1) if e not in marked)) for a in marked if a - 1 not in marked}


@pytest.mark.parametrize("k, least", [(1, 4), (2, 3), (3, 2), (2, 1)])
def test_repeats(spark, k, least):
    rng = random.Random(k)
    rows = [(i, "".join(rng.choices("AC" if i % 2 else "ACG", k=rng.randrange(0, 50)))) for i in range(60)] + [(90, None), (91, "A" * 40), (92, "AC")]
    df = spark.createDataFrame(rows, "name long, seq string")
    got = {(r.chrom, r.start, r.end) for r in masking.repeats(df, k, least).collect()}
    assert got == {(n, a, e) for n, s in rows if s for a, e in plain(s, k, least)}


def test_a_long_sequence_takes_linear_time(spark):
    df = spark.createDataFrame([(1, "ACGT" * 500_000)], "name long, seq string")
    assert [(r.start, r.end) for r in masking.repeats(df, 4, 3).collect()] == [(0, 2_000_000)]
