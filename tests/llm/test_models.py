"""Trained models against plain recomputation from what they hold; plans of top-k cells; recall of the pipeline's near-duplicates."""

import math
import re
import time

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lodestrand.llm import quality_model, simhash, topk, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " -- ..."), (-4, "word"), (-5, "Émile. ÉMILE! 漢字?\n\nx"), (-6, "a" * 5_000)], "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(odd), docs, labels


def plain_toxicity(model, text):
    """Noisy-or of sentences, one by one."""
    keep = 0.0
    for sentence in re.findall(r"[^.!?\n]*\w[^.!?\n]*", (text or "").lower()):
        words = set(re.findall(r"\w+", sentence))
        names = words | {w[:n] + "~" for w in words for n in (4, 5, 6) if len(w) > n}
        z = model.base + sum(model.weights.get(x, 0.0) for x in names)
        keep += math.log1p(math.exp(z)) if z < 30 else z
    z = model.slope * math.log(max(keep, 1e-22)) + model.shift
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def test_toxicity_scores_equal_plain_ones(tables):
    texts, docs, labels = tables
    model = toxicity.train(docs, labels)
    assert model.weights
    text_of = {r.doc_id: r.text for r in texts.collect()}
    rows = toxicity.score(texts, model).collect()
    assert len(rows) == len(text_of)
    for r in rows:
        assert r.score == pytest.approx(plain_toxicity(model, text_of[r.doc_id]), abs=1e-9), r.doc_id
        assert r.predicted == (r.score >= 0.3) and (r.n_offending > 0 or not r.predicted or r.score < 0.99)


def plain_quality(model, text):
    """Six differences of compressed sizes, piece by piece, each with a compressor of its own."""
    raw = (text or "").encode()
    x = [0.0] * 6
    if raw:

        def size(data, dictionary):
            made = zstandard.ZstdCompressionDict(dictionary) if dictionary is not None else None
            total = 0
            for i in range(0, len(data), model.chunk):
                c = zstandard.ZstdCompressor(level=model.level, dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False) if made else zstandard.ZstdCompressor(level=model.level, write_checksum=False, write_content_size=False)
                total += len(c.compress(data[i : i + model.chunk]))
            return total

        shape = "".join("a" if b > 127 or chr(b).islower() else "A" if chr(b).isupper() else "0" if chr(b).isdigit() else chr(b) for b in raw).encode()
        (bad, good), (bad_shape, good_shape) = model.dictionaries
        n, b, g, a, bs, gs = len(raw), size(raw, bad), size(raw, good), size(raw, None), size(shape, bad_shape), size(shape, good_shape)
        x = [(b - g) / n, (b - g) / max(b, g), min(b, g) / n - 0.35, min(a / n, 1.0) - 0.5, (bs - gs) / n, (bs - gs) / max(bs, gs)]
    z = sum(10 * v * w for v, w in zip(x, model.weights)) + model.weights[-1]
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def test_quality_scores_equal_plain_ones(tables):
    texts, docs, labels = tables
    model = quality_model.train(docs, labels)
    some = texts.where("doc_id < 0 or doc_id % 9 = 0")  # every document has a score of its own; a ninth is recomputed here
    text_of = {r.doc_id: r.text for r in some.collect()}
    rows = quality_model.score(some, model).collect()
    assert len(rows) == len(text_of) > 100
    for r in rows:
        assert r.score == pytest.approx(plain_quality(model, text_of[r.doc_id]), abs=1e-6), r.doc_id


def test_cells_in_reach_by_a_plain_loop():
    rng = np.random.default_rng(1)
    c = rng.normal(size=(40, 8)) * 100
    low, rq, rx = rng.normal(size=40) * 20_000, rng.random(40) * 50, rng.random(40) * 50
    low[3] = -np.inf
    got = set(zip(*(x.tolist() for x in topk.pairs_in_reach(c, low, rq, c, rx))))
    norm = np.sqrt((c**2).sum(1))
    for g in range(40):
        for s in range(40):
            top = c[g] @ c[s] + rq[g] * norm[s] + rx[s] * norm[g] + rq[g] * rx[s]
            assert ((g, s) in got) == (top >= low[g]) or abs(top - low[g]) < 1e-3
    c = rng.normal(size=(1_024, 64))
    start = time.time()
    topk.pairs_in_reach(c, np.zeros(1_024), np.ones(1_024), c, np.ones(1_024))
    assert time.time() - start < 1


def test_similar_texts_that_are_found(spark):
    """Of all pairs of different texts with a five-word similarity of 0.8 or more, how many end in one group."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null").select("doc_id", "text")
    rows = docs.collect()
    sets = {r.doc_id: simhash.shingles(r.text) for r in rows}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    shared = {}
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    pairs = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    kept = {r.doc_id for r in simhash.drop_similar(docs.withColumn("n", F.lit(1))).collect()}
    groups = {find(d) for d in sets}
    assert len(pairs) > 100 and {find(d) for d in kept} == groups and len(kept) == len(groups)
