"""Chains of k-mers: each k-mer once, chains maximal, circles cut, against plain walks."""

import random
from collections import Counter

import pytest

from lodestrand.operators import chains


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def canonical(s):
    return max(s, turned(s))


def kmers(s, k):
    return [canonical(s[i : i + k]) for i in range(len(s) - k + 1) if set(s[i : i + k]) <= set("ACGT")]


def plain_links(known, k):
    """Pairs of oriented k-mers of which each is the other's only neighbour on its side."""
    nodes = [*known, *map(turned, known)]
    follow = {x: [x[1:] + c for c in "ACGT" if canonical(x[1:] + c) in known] for x in nodes}
    lead = {x: [c + x[:-1] for c in "ACGT" if canonical(c + x[:-1]) in known] for x in nodes}
    return {(x, ys[0]) for x, ys in follow.items() if len(ys) == 1 and len(lead[ys[0]]) == 1 and canonical(x) != canonical(ys[0])}


@pytest.mark.parametrize("seed, k, letters", [(1, 5, "ACGT"), (2, 7, "ACGT"), (3, 11, "ACGT"), (4, 5, "AC"), (5, 9, "ACG")])
def test_chains(spark, seed, k, letters):
    rng = random.Random(seed)
    seqs = ["".join(rng.choices(letters, k=rng.randrange(0, 60))) for _ in range(12)]
    ring = "".join(rng.choices("ACGT", k=40))
    seqs += [ring + ring[: k - 1], turned(seqs[0]), "ACGTN" * 3, "AC" * 12, "A" * 20, None]
    known = {x for s in seqs if s for x in kmers(s, k)}
    got = [r.seq for r in chains.compressed(spark.createDataFrame([(s,) for s in seqs], "seq string"), k).collect()]
    assert Counter(x for s in got for x in kmers(s, k)) == Counter(known)
    # links within chains are all links, but for one of each circle
    links = plain_links(known, k)
    inside = {(s[i : i + k], s[i + 1 : i + 1 + k]) for s in got for i in range(len(s) - k)}
    inside |= {(turned(b), turned(a)) for a, b in inside}
    assert inside <= links
    lost = links - inside
    ends = {(s[-k:], s[:k]) for s in got if len(s) > k} | {(turned(s[:k]), turned(s[-k:])) for s in got if len(s) > k}
    assert lost <= ends


def test_counts_choose_kmers(spark):
    df = spark.createDataFrame([("ACGTTGCA",), ("ACGTTG",), ("GGATC",)], "seq string")
    n = Counter(x for s in ("ACGTTGCA", "ACGTTG", "GGATC") for x in kmers(s, 5))
    for least, most in ((2, None), (1, 1)):
        got = Counter(x for r in chains.compressed(df, 5, least, most).collect() for x in kmers(r.seq, 5))
        assert got == Counter(x for x, c in n.items() if c >= least and (most is None or c <= most))


def test_one_circle_and_no_rows(spark):
    ring = "ACGGTCATTGCCA"
    got = [r.seq for r in chains.compressed(spark.createDataFrame([(ring + ring[:6],)], "seq string"), 7).collect()]
    assert len(got) == 1 and len(got[0]) == len(ring) + 6 and set(kmers(got[0], 7)) == set(kmers(ring + ring[:6], 7))
    assert chains.compressed(spark.createDataFrame([], "seq string"), 7).count() == 0
    with pytest.raises(ValueError, match="odd"):
        chains.compressed(spark.createDataFrame([], "seq string"), 8)


@pytest.mark.parametrize("seed, k", [(1, 7), (2, 11), (3, 21)])
def test_chains_over_buckets(spark, monkeypatch, seed, k):
    monkeypatch.setattr(chains, "BUCKET", 3)
    rng = random.Random(seed)
    seqs = ["".join(rng.choices("ACGT", k=300)) for _ in range(3)]
    ring = "".join(rng.choices("ACGT", k=90))
    seqs += [ring + ring[: k - 1], seqs[0][:80], "A" * 30, "AC" * 20]
    known = {x for s in seqs for x in kmers(s, k)}
    got = [r.seq for r in chains.compressed(spark.createDataFrame([(s,) for s in seqs], "seq string"), k).collect()]
    assert Counter(x for s in got for x in kmers(s, k)) == Counter(known)
    links = plain_links(known, k)
    inside = {(s[i : i + k], s[i + 1 : i + 1 + k]) for s in got for i in range(len(s) - k)}
    inside |= {(turned(b), turned(a)) for a, b in inside}
    assert inside <= links
    ends = {(s[-k:], s[:k]) for s in got if len(s) > k} | {(turned(s[:k]), turned(s[-k:])) for s in got if len(s) > k}
    assert links - inside <= ends
    # joined in numpy, by buckets: a stretch is more than a node, so that fewer rows than nodes are ranked
    held = chains._stretches(chains._dealt(spark.createDataFrame([(x,) for x in _codes(known)], "kmer long"), k, 40), k, 40)
    assert 0 < held.where("node is not null").count() < len(known)


def _codes(known):
    return [int("".join(str("ACGT".index(c)) for c in x), 4) for x in known]
