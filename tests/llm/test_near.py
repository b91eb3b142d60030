"""Large groups of edited copies through split keys and blocks that meet pairwise, against brute force."""

import random

import numpy as np
import pytest

from lodestrand.llm import simhash


@pytest.mark.parametrize("block,many", [(4096, 64), (16, 64), (16, 1), (3, 1)])
def test_large_groups_of_edited_copies(spark, block, many):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = [words(rng.randint(40, 90)) for _ in range(40)]
    for base, copies, most in ((texts[0], 120, 1), (texts[1], 60, 3), (texts[2], 40, 6)):
        for _ in range(copies):
            t = [*base]
            for _ in range(rng.randint(0, most)):
                t[rng.randrange(len(t))] = f"new{rng.randrange(10**6)}"
            texts.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets, root = [simhash.shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    kept = simhash.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"), block_rows=block, many=many)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


@pytest.mark.parametrize("block,many", [(4096, 64), (3, 1), (4, 2)])
def test_rows_that_agree_in_one_very_common_key_alone(spark, block, many):
    """Keys of more blocks than are met pairwise: rows with no other key in common are compared too, and unlike ones stay apart."""
    rng, rows, texts = np.random.default_rng(4), [], []
    base = [f"w{i}" for i in range(60)]
    for i in range(30):
        keys = rng.integers(-(2**62), 2**62, simhash.KEYS)
        keys[5] = 7
        if 10 <= i < 20:  # the largest component: these share all keys
            keys[:] = 7
        words = [*base] if i % 3 or 10 <= i < 20 else [f"x{i}y{j}" for j in range(60)]
        words[0] = f"own{i}"
        texts.append((i, " ".join(words)))
        rows.append((i, bytearray(16), len(simhash.shingles(texts[-1][1])), keys.tolist(), bytearray(keys.view(np.uint64).astype(np.uint32).tobytes())))
    reps = spark.createDataFrame(rows, "s long, f binary, n long, m array<long>, w binary")
    found = simhash.components(simhash.similar_links(reps, spark.createDataFrame(texts, "s long, text string"), block_rows=block, many=many)).collect()
    alike = {i for i in range(30) if i % 3 or 10 <= i < 20}
    assert {r.node: r.root for r in found} == {i: min(alike) for i in alike}
