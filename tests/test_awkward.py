"""New operators on empty tables, nulls, repeated rows and borders of bins, blocks and pieces."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrand.functions import codes
from lodestrand.functions import seq as S
from lodestrand.operators import depths, intervals, kmers, masking, reads, sam, scores, summaries, taxonomy, tools
from lodestrand.operators.work import new_folder
from lodestrand.sources import fastq, text


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def plain_kmers(seq, k):
    out = []
    for i in range(len(seq) - k + 1):
        w = seq[i : i + k].upper()
        if set(w) <= set("ACGT"):
            out.append((i, max(w, w[::-1].translate(str.maketrans("ACGT", "TGCA")))))
    return out


@pytest.mark.parametrize("k", [1, 4, 31])
def test_kmers_as_numbers(spark, k, monkeypatch):
    rng = random.Random(k)
    seqs = [(i, "".join(rng.choice("ACGTacgtNé-") if rng.random() < 0.1 else rng.choice("ACGT") for _ in range(rng.randint(0, 90)))) for i in range(40)] + [(98, ""), (99, None), (7, "ACGT" * 20)]
    df = frame(spark, seqs, "name long, seq string")
    want = Counter((n, i, w) for n, s in seqs if s for i, w in plain_kmers(s, k))
    assert Counter(tuple(r) for r in codes.explode(df, k).select("name", "pos", codes.letters(F.col("kmer"), k)).collect()) == want
    n = Counter(w for _, _, w in want.elements())
    assert {r.kmer: r.n for r in kmers.counts(df, k).collect()} == dict(n)
    both = codes.explode(df, k).select("kmer", codes.complement(F.col("kmer"), k).alias("c"), codes.complement(codes.complement(F.col("kmer"), k), k).alias("cc")).distinct()
    assert both.where("kmer <> cc or kmer < c").count() == 0
    with pytest.raises(ValueError):
        codes.explode(df, 32)


def test_long_sequences_go_in_pieces():
    rng = np.random.default_rng(0)
    import pyarrow as pa

    whole = "".join(np.array(list("ACGTN"))[rng.choice(5, 5000, p=[0.245] * 4 + [0.02])])
    was, codes.PIECE = codes.PIECE, 100
    try:
        batch = pa.RecordBatch.from_pylist([{"seq": "ACG"}, {"seq": whole}, {"seq": None}, {"seq": whole[:250]}])
        found = Counter((int(r), int(a), int(c)) for rows, at, code in codes._pieces(batch, "seq", 7) for r, a, c in zip(rows, at, code))
    finally:
        codes.PIECE = was
    digit = {"A": 0, "C": 1, "G": 2, "T": 3}
    number = lambda w: int("".join(str(digit[c]) for c in w), 4)
    assert found == Counter((r, i, number(w)) for r, s in ((1, whole), (3, whole[:250])) for i, w in plain_kmers(s, 7))


@pytest.mark.parametrize("width", [7, 64, 100_000])
def test_intervals_across_bins(spark, width):
    rng = random.Random(width)
    rows = [("c%d" % rng.randrange(3), a, a + rng.choice([0, 1, 2, 5, 40, 200])) for a in (rng.randrange(600) for _ in range(120))]
    rows += [("c0", 0, 64), ("c0", 64, 128), ("c0", 64, 128), ("c1", 10, 10)]
    df = frame(spark, rows, "chrom string, start long, end long")
    genome = frame(spark, [("c0", 700), ("c1", 650), ("c3", 20)], "chrom string, length long")
    merged, runs = [], []
    for c in ("c0", "c1", "c2", "c3"):
        depth = [0] * 1000
        for x, a, b in rows:
            for i in range(a, b):
                depth[i] += x == c
        i = 0
        while i < 1000:
            if depth[i]:
                j = next((j for j in range(i, 1000) if not depth[j]), 1000)
                merged.append((c, i, j))
                i = j
            i += 1
        if c != "c2":
            n = {"c0": 700, "c1": 650, "c3": 20}[c]
            cuts = [0, *(i for i in range(1, n) if depth[i] != depth[i - 1]), n]
            runs += [(c, a, b, depth[a]) for a, b in zip(cuts, cuts[1:])]
    assert rows_of(intervals.merge(df, width)) == sorted(merged)
    assert rows_of(intervals.depth_runs(df, genome, width)) == sorted(runs)
    points = frame(spark, [(c, a) for c, a, _ in rows], "chrom string, pos long")
    want = []
    for c in ("c0", "c1", "c2"):
        own = sorted({a for x, a, _ in rows if x == c})
        cuts = [0, *(i for i in range(1, len(own)) if own[i] - own[i - 1] > 9), len(own)]
        want += [(c, own[a] - 2, own[b - 1] + 3, b - a) for a, b in zip(cuts, cuts[1:])]
    assert rows_of(intervals.clusters(points, 9, 2, width)) == sorted(want)
    none = df.where("false")
    assert intervals.merge(none).count() == 0 and rows_of(intervals.depth_runs(none, genome)) == [("c0", 0, 700, 0), ("c1", 0, 650, 0), ("c3", 0, 20, 0)]


@pytest.mark.parametrize("block", [1, 3, 8, 1000])
def test_pairs_across_blocks(spark, block):
    rng = random.Random(block)
    names = [n for n in (f"r{rng.randrange(6)}" for _ in range(40)) for _ in range(rng.choice([1, 2, 2, 3, 7]))]
    rows = [(f"{n}/{1 + i % 2}", i, "f") for i, n in enumerate(names)] + [(f"{n}/1", 500 + 3 * i, None) for i, n in enumerate(names[:20])]
    want = Counter()
    for f in ("f", None):
        own = [(n.rsplit("/", 1)[0], i) for n, i, x in rows if x == f]
        at = 0
        while at < len(own):
            end = next((j for j in range(at, len(own)) if own[j][0] != own[at][0]), len(own))
            for j in range(at, end):
                want[own[j][1], f, 0 if j == end - 1 and (end - at) % 2 else 64 if (j - at) % 2 == 0 else 128] += 1
            at = end
    got = reads.pair_up(frame(spark, rows, "name string, i int, file string"), "i", "file", block)
    assert got.columns == ["name", "i", "file", "mate"]
    assert Counter((r.i, r.file, r.mate) for r in got.collect()) == want


def test_rules_of_cleanup_and_counts(spark):
    hits = frame(spark, [("a", 1, 50.0), ("a", 2, 40.0), ("a", 9, 60.0), ("b", 2, 30.0), ("b", 9, 30.0), ("c", 1, 10.0), ("d", 9, 5.0), ("e", 1, 70.0), ("e", 8, 5.0), ("f", 1, 3.0), ("g", 1, 3.0)], "read string, tid long, score double")
    got = rows_of(taxonomy.cleanup(hits, frame(spark, [(8,), (9,)], "tid long")))
    # 9 explains 2 in both of its reads, and so replaces all hits of a and b; 8 explains nothing
    assert got == [("a", 9, 60.0), ("b", 9, 30.0), ("c", 1, 10.0), ("d", 9, 5.0), ("e", 1, 70.0), ("f", 1, 3.0), ("g", 1, 3.0)]
    nodes = frame(spark, [(1, 1, "no", "root"), (2, 1, "superkingdom", "V"), (10, 2, "family", "F"), (20, 10, "genus", "G"), (100, 20, "species", "s"), (101, 2, "species", "t"), (30, 2, "family", "H"), (300, 30, "genus", "I")], "tid long, parent long, rank string, name string")
    tree = taxonomy.closure(nodes)
    table = {(r["rank"], r.tid): (r.uniq, r.multi) for r in taxonomy.count_table(frame(spark, [("x", 100), ("x", 101), ("y", 100), ("z", 300)], "read string, tid long"), tree).collect()}
    assert table == {("species", 100): (1, 1), ("species", 101): (0, 1), ("genus", 20): (1, 1), ("family", 10): (1, 1), ("superkingdom", 2): (2, 0)}
    found = {r["rank"]: (r.correct, r.wrong, r.unspecific) for r in taxonomy.accuracy(frame(spark, [("p", 100), ("q", 100), ("r", 101)], "read string, tid long"), frame(spark, [("p", 300), ("q", 10), ("r", 2)], "read string, tid long"), tree).collect()}
    assert found == {"species": (0, 1, 2), "genus": (0, 1, 1), "family": (1, 1, 0)}
    with pytest.raises(ValueError):
        taxonomy.closure(frame(spark, [(1, 1, "no", "root"), (2, 3, "a", "b"), (3, 2, "a", "c")], "tid long, parent long, rank string, name string"))


def test_empty_tables_and_nulls(spark):
    seqs = frame(spark, [], "name long, seq string")
    odd = frame(spark, [(1, None), (2, ""), (3, "A"), (3, "A")], "name long, seq string")
    for df in (seqs, odd):
        n = df.count()
        assert masking.composition(df).count() == n and masking.random_bases(df).count() == n and depths.depth_classes(df, 5, 2, 9).count() == n
        assert masking.low_complexity(df, 10, 5, 3, 5).count() == 0 and masking.repeats(df, 2, 3).count() == 0 and masking.ambiguous_sites(df).count() == 0
        assert kmers.sketch(df, 5, 4).count() == 0 and depths.errors(df, 5, 2, 1, 3).count() == 0 and summaries.corrections(df, 5, 1, 3).count() == 0
        assert depths.clusters(df, 5).count() == 0 and summaries.release(df, 5, 10).count() == 0
        assert tools.split_at_linker(df, "ACA").count() == n and tools.cut_between(df, "AC", "GT").count() == 0
        assert masking.mask_regions(df, frame(spark, [(1, 0, 5), (3, 0, 9), (8, 1, 2)], "chrom long, start long, end long")).count() == n
    assert [r.seq for r in masking.mask_regions(odd, frame(spark, [(3, 0, 9)], "chrom long, start long, end long")).where("name = 3").collect()] == ["N", "N"]
    hits = frame(spark, [], "read long, ref long, score double")
    assert scores.pair_scores(hits, hits).count() == 0 and scores.united([hits, hits], 0.9).count() == 0 and summaries.unique_best(hits).count() == 0
    orders = frame(spark, [], "at long, name string")
    assert tools.numbered(orders, "at").count() == 0 and tools.rename(orders, "r", "at").count() == 0
    aln = frame(spark, [], "qname string, flag int, rname string, pos long, mapq int, cigar string, seq string")
    assert sam.pileup(aln).count() == 0 and sam.fetch(aln, "c", 0, 5).count() == 0


def test_fastq_in_ranges(spark):
    rng = random.Random(3)
    fastq.register(spark)
    rows = [(f"r{i}", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+I#ACGT") for _ in range(n))) for i, n in enumerate(rng.randrange(0, 60) for _ in range(200))]
    path = new_folder(spark, "fq")
    text.write_fastx(frame(spark, rows, "name string, seq string, qual string").coalesce(1), path)
    for step in (0, 50, 333, 10_000_000):
        got = spark.read.format("fastq").option("splitBytes", step).load(path)
        assert rows_of(got.select("name", "seq", "qual")) == sorted(rows)


def test_versions_and_regions(spark):
    df = frame(spark, [("gi|5|ref|NC_9.1|", "c:1,000-2000"), ("plain x", "c:7"), (None, "c")], "h string, r string")
    got = df.select(S.versioned_accession(F.col("h")).alias("a"), masking.parse_region(F.col("r")).alias("p")).select("a", "p.*").collect()
    assert [tuple(r) for r in got] == [("NC_9.1", "c", 999, 2000), ("plain x", "c", 6, None), (None, "c", None, None)]
