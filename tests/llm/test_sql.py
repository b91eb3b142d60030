"""Operators of the package that SQL can express, against DuckDB; the mixture against a plain version."""

import sys
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from test_queries import DATA, duck, ordered  # noqa: E402

from lodestrand.llm import mixture, registry  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_operator_equals_sql(spark, name):
    ours = ordered(registry.queries()[name](spark, DATA).toPandas())
    theirs = ordered(duck(DATA).sql(registry.oracle_sql()[name]).df())
    assert len(ours)
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-9)


@pytest.mark.parametrize("block_words", [50, 4096, None])
def test_mixture_by_brute_force(spark, block_words):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("row_id", F.monotonically_increasing_id()).cache()
    rows = mixture._rows(docs, mixture.SEED, "doc_id").collect()
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in rows if r.source == s) for s in names]
    goal, plan, asked = mixture.targets(sizes), [], block_words
    block_words = block_words or -(-sum(sizes) // mixture.BLOCKS)
    for s, n, t in zip(names, sizes, goal):
        passes, rest = divmod(min(int(t + 0.5), 3 * n), n) if n else (0, 0)
        plan.append((passes, rest, -(-n // block_words), -(-rest // block_words)))
    quotas = [p * b + part for p, _, b, part in plan]
    shards = mixture.SHARDS
    split, want = mixture.split_quotas(quotas, shards), Counter()
    for i, (s, n, (passes, rest, blocks, part)) in enumerate(zip(names, sizes, plan)):
        listed = [(s, p, b) for p in range(passes) for b in range(blocks)] + [(s, passes, b) for b in range(part)]
        drawn = spark.createDataFrame(listed, "source string, pass long, block long").withColumn("h", F.xxhash64(F.lit(mixture.SEED), "source", "pass", "block")).collect() if listed else []
        drawn = sorted(drawn, key=lambda r: (r.h, r["pass"], r.block))
        shard_of, at = {}, 0
        for k in range(shards):
            for r in drawn[at : at + split[k][i]]:
                shard_of[r["pass"], r.block] = k
            at += split[k][i]
        start = 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: (r.order, r.size, r.row_id)):
            takes = [*range(passes), *([passes] if start < rest and 2 * (rest - start) >= r.size else [])]
            block = min(start // block_words, max(n - 1, 0) // block_words)
            want[r.doc_id, r.size, n, round(goal[i], 6), len(takes) * r.size, tuple(sorted(shard_of[p, block] for p in takes))] += 1
            start += r.size
    got = mixture.mixture(docs, block_words=asked).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, tuple(x for x in r.shards if x is not None)) for r in got) == want
