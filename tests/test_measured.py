"""Linkers, sketches, consensus, peaks and recalibration against plain versions and on awkward rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrand.operators import consensus, depths, kmers, linkers, mergeable, recalibration

CODES = {"R": "AG", "N": "ACGT", "W": "AT", "Y": "CT"}


def differs(window, pattern):
    return sum(not (p == "N" or c in CODES.get(p, p)) for c, p in zip(window.upper(), pattern))


@pytest.mark.parametrize("pattern, most", [("ACGTA", 1), ("RCNTWAC", 2), ("A", 0), ("ACGTACGTACGTACGTACGTACGTACGTACGTACGTA", 20)])
def test_near_places(spark, pattern, most):
    rng = random.Random(len(pattern))
    rows = [(i, "".join(rng.choices("ACGTNacgt", k=rng.randrange(0, 50)))) for i in range(60)] + [(99, None), (98, ""), (97, "é" * 9)]
    back = linkers.reverse_complement(pattern)
    want = Counter()
    for i, s in rows:
        for reverse, p in ((False, pattern), (True, back)):
            for at in range(len(s or "") - len(p) + 1):
                if (n := differs(s[at : at + len(p)], p)) <= most:
                    want[i, at, reverse, n] += 1
    assert Counter(tuple(r) for r in linkers.near_places(spark.createDataFrame(rows, "name int, seq string"), pattern, most).collect()) == want


def test_primers_and_linkers(spark):
    rows = [("a", "TTACGTACCCCGGTTAGG"), ("b", "TTACCTACCCCGGTTTGG"), ("c", "GGTTAACGTA"), ("d", ""), ("e", None), ("f", "ACGTAGGTTA")]
    df = spark.createDataFrame(rows, "name string, seq string")
    assert {r.name: r.seq for r in linkers.cut_primers(df, "ACGTA", "GGTTA", 1).collect()} == {"a": "CCCC", "b": "CCCC", "f": ""}
    assert {r.name: r.seq for r in linkers.cut_primers(df, "ACGTA", "GGTTA", 0).collect()} == {"a": "CCCC", "f": ""}
    got = {(r.name, r.part): r.seq for r in linkers.split_at(df, "TACGT", 1).collect()}
    assert got["a", 1] == "T" and got["a", 2] == "ACCCCGGTTAGG" and got["d", 0] == "" and got["e", 0] is None
    assert got["f", 1] == "" and got["f", 2] == "GGTTA"  # the complement ACGTA
    assert linkers.split_at(df.where("name = 'd'"), "TACGT", 1).columns == ["name", "seq", "part"]


def test_a_union_of_sketches_is_the_sketch_of_the_whole(spark):
    rng = random.Random(3)
    rows = [(f"s{i % 4}", "".join(rng.choices("ACGT", k=700))) for i in range(60)] + [(None, "ACGTACGTACGTA"), ("s1", None), ("s9", "")]
    df = spark.createDataFrame(rows, "source string, seq string")
    one = df.withColumn("source", F.lit("all"))
    k, bits = 11, 9
    parts, whole = mergeable.distinct_sketch(df, "source", k, bits), mergeable.distinct_sketch(one, "source", k, bits)
    assert Counter(mergeable.united(parts).collect()) == Counter(whole.select("register", "rank").collect())
    known = Counter(x for _, s in rows if s for x in (max(s[i : i + k], s[i : i + k][::-1].translate(str.maketrans("ACGT", "TGCA"))) for i in range(len(s) - k + 1)))
    told = mergeable.distinct_estimate(whole, ["source"], bits).first().kmers
    assert abs(told / len(known) - 1) < 4 * 1.04 / 2 ** (bits / 2)
    few = mergeable.distinct_estimate(mergeable.distinct_sketch(df.where("source is null"), "source", k, bits), ["source"], bits).first().kmers
    assert round(few) == 2  # three words, of which two are complements of each other
    table, total = mergeable.count_table(df, "source", k, 10), mergeable.count_table(one, "source", k, 10)
    assert Counter(table.groupBy("line", "cell").agg(F.sum("n")).collect()) == Counter(total.select("line", "cell", "n").collect())
    counts = kmers.counts(df, k)
    from lodestrand.functions import codes

    asked = codes.explode(df.withColumn("name", F.lit(1)), k).select("kmer")
    n = {r.kmer: r.n for r in mergeable.looked_up(asked, table, 10).select(codes.letters(F.col("kmer"), k).alias("kmer"), "n").collect()}
    true = {r.kmer: r.n for r in counts.collect()}
    assert n.keys() == true.keys() and all(n[x] >= true[x] for x in true) and sum(n[x] - true[x] for x in true) / len(true) < 40


def test_ranks_of_hashes():
    code = np.arange(3000, dtype=np.int64) * 977
    register, rank = mergeable.ranks(code, 10)
    for r, k, h in zip(register, rank, mergeable.hashed(code)):
        rest = int(h) % 2**54
        assert int(h) >> 54 == r and k == 55 - rest.bit_length()


@pytest.mark.parametrize("least", [1, 3, 5])
def test_sketches_that_share_hashes(spark, least):
    rng = random.Random(least)
    make = lambda n: [(i, sorted({"common", "often"} | {f"h{rng.randrange(30):02}" for _ in range(rng.randrange(0, 9))})) for i in range(n)]
    left, right = make(40), [*make(40), (50, []), (51, ["common"])]
    want = {(a, b, len({*x} & {*y})) for a, x in left for b, y in right if len({*x} & {*y}) >= least}
    frames = [spark.createDataFrame(rows, "name int, hashes array<string>") for rows in (left, right)]
    assert {tuple(r) for r in kmers.compare(*frames, least).collect()} == want


@pytest.mark.parametrize("block", [3, 512])
def test_sketches_of_one_table_in_blocks(spark, monkeypatch, block):
    """Each pair once, also of a hash that many have, in blocks that meet pairwise, against plain comparison."""
    monkeypatch.setattr(kmers, "BLOCK", block)
    rng = random.Random(9)
    rows = [(i, sorted({"common"} | {f"h{rng.randrange(12):02}" for _ in range(rng.randrange(0, 9))})) for i in range(30)] + [(30, []), (31, ["common"])]
    df = spark.createDataFrame(rows, "name int, hashes array<string>")
    for least in (1, 4):
        want = sorted((a, b, len({*x} & {*y})) for a, x in rows for b, y in rows if a < b and len({*x} & {*y}) >= least)
        assert sorted(tuple(r) for r in kmers.compare(df, least=least).collect()) == want
    two = sorted((a, b, len({*x} & {*y})) for a, x in rows for b, y in rows[:20] if len({*x} & {*y}) >= 3)
    assert sorted(tuple(r) for r in kmers.compare(df, df.where("name < 20"), 3).collect()) == two


def test_votes_of_clumps_and_adapters(spark):
    base = "ACGTTGCATTGACCAGTAGGCATC"
    turned = base[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("a", base, "I" * 24), ("b", base[3:], "I" * 21), ("c", turned, "I" * 24), ("d", base[:-2] + "AA", "I" * 22 + "##"), ("e", "", ""), ("f", None, None)]
    reads = spark.createDataFrame(rows, "name string, seq string, qual string")
    # a changed end may give a read another pivot, and a clump of its own
    main = consensus.in_clumps(reads, 9).orderBy(F.desc("reads")).first()
    got = {r.pivot: r.seq for r in consensus.clump_consensus(reads, 9).collect()}
    assert main.reads >= 3 and got[main.pivot] in (base, turned) and len(got) <= 2
    lost = {r.pivot: (r.votes, r.lost) for r in consensus.share_changed(reads, 9).collect()}
    assert lost.keys() == got.keys() and lost[main.pivot][1] in (0, 1, 2)
    pairs = spark.createDataFrame([("AAAAGTCC", "TTTTCCAA", 4), ("AAAGTCC", "TTTCCAT", 3), ("AGTC", "TCCAT", 1), ("ACGT", "ACGT", 9), ("ACGT", None, None)], "seq1 string, seq2 string, insert int")
    won = consensus.adapters(pairs, 3, 0.5)
    assert {r.side: r.adapter for r in consensus.adapter_sequences(won).collect()} == {1: "GTC", 2: "CCA"}


def test_mates_are_merged_by_quality(spark):
    first, second = "ACGTTGCATTGACC", "GCATTGACCAGTAG"
    wrong = "GCATTGTCCAGTAG"  # one base of the overlap differs
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(1, first, "5" * 14, turn(second), "5" * 14), (2, first, "I" * 14, turn(wrong), "#" * 14), (3, first, "#" * 14, turn(wrong), "I" * 14), (4, first, "I" * 14, "AAAAAAAAAAAAAA", "I" * 14)]
    got = {r.i: r for r in consensus.merged_by_quality(spark.createDataFrame(rows, "i int, seq1 string, qual1 string, seq2 string, qual2 string").withColumn("least", F.lit(1))).collect()}
    assert all(r.merged is None for r in got.values())  # overlaps of 9 are under the least of 12
    long1, long2 = "TTAGG" + first, second
    rows = [(i, "TTACGTTGCATTGACC", q1, turn("ACGTTGCATTGACCAG"[:x] + c + "ACGTTGCATTGACCAG"[x + 1 :]), q2) for i, (q1, q2, x, c) in enumerate([("5" * 16, "5" * 16, 0, "A"), ("I" * 16, "#" * 16, 5, "A"), ("#" * 16, "I" * 16, 5, "A")])]
    got = {r.i: r for r in consensus.merged_by_quality(spark.createDataFrame(rows, "i int, seq1 string, qual1 string, seq2 string, qual2 string")).collect()}
    whole = "TTACGTTGCATTGACCAG"
    assert got[0].merged == whole and got[0].merged_qual == "55" + "I" * 14 + "55"  # 20 + 20
    assert got[1].merged == whole and got[1].merged_qual[7] == chr(33 + 38) and got[2].merged == whole[:7] + "A" + whole[8:]
    assert long1 and long2


def plain_peaks(points, least_height, least_depth, least_rise):
    """Peaks as sets of depths, merged one at a time."""
    n = [x for d, x in points if d >= least_depth]
    d = [x for x, _ in points if x >= least_depth]
    flat = [i for i in range(len(n)) if i == 0 or n[i] != n[i - 1]]
    tops = []
    for j, i in enumerate(flat):
        up = j == 0 or n[flat[j - 1]] < n[i]
        down = j + 1 == len(flat) or n[flat[j + 1]] < n[i]
        if up and down:
            tops.append(i)
    tops = [{i} for i in tops]
    while True:
        heads = [max(t, key=lambda i: (n[i], -i)) for t in tops]
        cut = [min(range(max(a), min(b)), key=lambda i: (n[i], i)) for a, b in zip(tops, tops[1:])]
        if not cut:
            break
        rises = []
        for j, h in enumerate(heads):
            sides = ([(n[cut[j - 1]], 1, j - 1)] if j else []) + ([(n[cut[j]], 0, j + 1)] if j < len(cut) else [])
            side = max(sides)
            rises.append((n[h] / max(1, side[0]), j, side[2]))
        rise, j, other = min(rises)
        if rise >= least_rise:
            break
        a, b = sorted((j, other))
        tops[a : b + 1] = [tops[a] | tops[b]]
    edges = [0, *cut, len(n) - 1] if tops else []
    out = [(d[h], n[h], d[a], d[z], sum(n[a:z] if z + 1 < len(n) else n[a:])) for h, a, z in zip(heads, edges, edges[1:])] if tops else []
    return [p for p in out if p[1] >= least_height]


@pytest.mark.parametrize("seed", range(6))
def test_peaks_by_a_plain_loop(seed):
    rng = random.Random(seed)
    for size in (0, 1, 2, 7, 60):
        points = [(d * 2 + 1, rng.choice([1, 2, 5, rng.randrange(1, 400)])) for d in range(size)]
        got = [tuple(p[c] for c in ("centre", "height", "start", "stop", "volume")) for p in depths.merged_peaks(points, 3, 3, 1.5)]
        assert got == plain_peaks(points, 3, 3, 1.5)


def test_peaks_of_a_diploid(spark):
    curve = lambda x, m, h: h * np.exp(-(((x - m) / (m / 6)) ** 2))
    points = [(x, int(curve(x, 20, 3000) + curve(x, 40, 9000) + 5_000 / x**3)) for x in range(1, 90)]
    peaks = depths.called_peaks(spark.createDataFrame(points, "depth long, kmers long"), 100, 5, 1.3)
    assert [r.centre for r in peaks.orderBy("centre").collect()] == [20, 40]
    r = depths.genome_traits(peaks, 31).first()
    assert (r.main, r.half, r.ploidy) == (40, 20, 2) and 0 < r.heterozygosity < 0.02 and r["size"] > 100_000
    assert depths.called_peaks(spark.createDataFrame([], "depth long, kmers long")).count() == 0


def test_finer_matrices_decide_where_they_have_seen_enough(spark):
    reads = [(f"r{i}", [20, 30, 20], [i % 2 == 0, True, i % 4 == 0]) for i in range(40)] + [("s", [7], [True]), ("t", [], []), ("u", None, None)]
    bases = recalibration.observed(spark.createDataFrame(reads, "read string, quals array<int>, right array<boolean>"))
    new = {(r.read, r.pos): r.new for r in recalibration.blended(bases, recalibration.matrices(bases), 30).collect()}
    assert len(new) == 121 and new["s", 0] == 7.0
    rate = lambda wrong, n: (wrong + 1) / (n + 2)
    assert new["r0", 0] == round(-10 * np.log10(rate(20, 40)), 6) and new["r1", 2] == round(-10 * np.log10(rate(30, 40)), 6)


def test_compared_sketches_carry_their_sizes(spark, monkeypatch):
    """Sizes come with the pairs, which are not joined with the sketches again; blocks of several parts meet pairwise."""
    rng = random.Random(3)
    rows = [(i, sorted({"common"} | {f"h{rng.randrange(12):02}" for _ in range(rng.randrange(0, 9))})) for i in range(40)]
    df = spark.createDataFrame(rows, "name int, hashes array<string>")
    want = sorted((a, b, len({*x} & {*y}), len(x), len(y)) for a, x in rows for b, y in rows if a < b and len({*x} & {*y}) >= 2)
    for block, blocks in ((3, 2), (2, 1), (5, 16)):
        monkeypatch.setattr(kmers, "BLOCK", block)
        monkeypatch.setattr(kmers, "BLOCKS", blocks)
        found = kmers.compare(df, least=2, sizes=True)
        assert sorted(tuple(r) for r in found.collect()) == want
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan(kmers.similarity(found, 5)).count("Join") == plan(found).count("Join")
