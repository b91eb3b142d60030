"""Masking, sweeps, variants and tree paths on small cases: nulls, empty tables, ties, repeated rows."""

import random
from collections import Counter

from pyspark.sql import functions as F

from lodestrand.operators import kmers as K
from lodestrand.operators import sam, taxonomy, variants, work
from lodestrand.sources import text


def test_mask_joins_runs_and_leaves_the_rest(spark):
    core = "ACGTTGCAAG"
    rows = [(1, "TTTTTTTT" + core + "CCCCCC"), (2, core), (3, "ACG"), (4, ""), (5, None), (6, core + core), (7, core + "TTTTTTTTT" + core)]
    reads = spark.createDataFrame(rows, "name int, seq string")
    got = {r.name: r.seq for r in K.mask(reads, spark.createDataFrame([("r", core)], "name string, seq string"), 5).collect()}
    plain = lambda k: max(k, k[::-1].translate(str.maketrans("ACGT", "TGCA")))
    known = {plain(core[i : i + 5]) for i in range(6)}
    for name, seq in rows:
        if seq is None:
            assert got[name] is None
            continue
        under = {i + j for i in range(len(seq) - 4) if plain(seq[i : i + 5]) in known for j in range(5)}
        assert got[name] == "".join("N" if i in under else c for i, c in enumerate(seq))


def test_depth_across_bins(spark):
    rng = random.Random(3)
    rows = [("a" if i % 3 else "b", rng.randint(1, 60), f"{rng.randint(1, 9)}M{rng.randint(1, 4)}D{rng.randint(1, 30)}M2S", 0 if i % 7 else 4) for i in range(60)] + [("c", 5, "*", 0)]
    want: dict = {}
    for ref, pos, cigar, flag in rows:
        if flag or cigar == "*":
            continue
        a, rest = cigar.split("M", 1)
        gap, rest = rest.split("D")
        b = rest.split("M")[0]
        for p in [*range(pos, pos + int(a)), *range(pos + int(a) + int(gap), pos + int(a) + int(gap) + int(b))]:
            want[ref, p] = want.get((ref, p), 0) + 1
    df = spark.createDataFrame([(*r, 60) for r in rows], "rname string, pos int, cigar string, flag int, mapq int")
    for width in (1, 7, 65_536):
        assert {(r.rname, r.pos): r.depth for r in sam.depth(df, width=width).collect()} == want
    bins = {(r.rname, r.bin): (r.bases, r.covered) for r in sam.binned_depth(df, 10).collect()}
    assert sum(b for b, _ in bins.values()) == sum(want.values()) and sum(c for _, c in bins.values()) == len(want)
    assert sam.depth(df.limit(0)).count() == 0


def test_variants_close_together_go(spark):
    rows = [("a", 10, 50.0, 5), ("a", 13, 50.0, 5), ("a", 17, 50.0, 5), ("a", 18, 5.0, 5), ("b", 14, 50.0, 5), ("b", 14, 60.0, 5), ("b", 30, None, 5), ("a", 100, 50.0, 99)]
    df = spark.createDataFrame(rows, "chrom string, pos long, qual double, depth long")
    got = sorted((r.chrom, r.pos) for r in variants.filter_variants(df, 10, 1, 50, 3).collect())
    assert got == [("a", 17), ("b", 14), ("b", 14)]  # repeated rows of one position are no neighbours
    assert variants.filter_variants(df.limit(0), gap=3).count() == 0


def test_allele_counts(spark):
    rows = [("a", 1, "A"), ("a", 1, "A"), ("a", 1, None), ("a", 2, None), ("a", 1, "IT")]
    got = {r.pos: (r.depth, r.alleles) for r in variants.allele_counts(spark.createDataFrame(rows, "chrom string, pos long, allele string")).collect()}
    assert got == {1: (4, {"A": 2, "IT": 1}), 2: (1, {})}


def test_tasks_of_frequencies_grow_with_the_bases(spark, monkeypatch):
    monkeypatch.setattr(work, "TASK_ROWS", 10)
    rng = random.Random(4)
    # most bases are of one place, and come from several tasks
    rows = [("a", rng.choice([1] * 9 + [2, 3, 4]), rng.choice(["A", "IT", "DA", None])) for _ in range(95)]
    bases = spark.createDataFrame(rows, "chrom string, pos long, allele string").repartition(3)
    counts = variants.allele_counts(bases)
    sites = spark.createDataFrame([("a", p, "G", "A") for p in range(1, 7)] + [("b", 1, "G", "A")], "chrom string, pos long, ref string, alt string")
    out = text.update_frequencies(sites, counts)
    depth, n = Counter(p for _, p, _ in rows), Counter(p for _, p, x in rows if x == "A")
    assert {r.pos: (r.depth, r.af) for r in out.collect()} == {p: (depth[p], round(n[p] / depth[p], 4)) for p in depth}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    shuffles = [int(line.rsplit(",", 1)[1]) for line in plan.splitlines() if "RepartitionByExpression" in line and line.rsplit(",", 1)[1].strip().isdigit()]
    assert shuffles == [10, 10]
    # sites made of the counts are where these are, and are not shuffled again
    own = text.update_frequencies(counts.select("chrom", "pos", F.lit("G").alias("ref"), F.lit("A").alias("alt")), counts.hint("merge"))
    assert own.count() == len(depth) and "ENSURE_REQUIREMENTS" not in own._jdf.queryExecution().executedPlan().toString()


def test_paths_and_common_ancestors(spark):
    nodes = [(1, 1), (2, 1), (10, 2), (20, 10), (100, 20), (101, 20), (200, 2), (1000, 100), (7, 7), (70, 7)]
    tree = taxonomy.closure(spark.createDataFrame([(t, p, "no", str(t)) for t, p in nodes], "tid long, parent long, rank string, name string"))
    sets = [(1, 100), (1, 101), (1, 101), (2, 100), (2, 200), (3, 1000), (3, 100), (4, 100), (5, 100), (5, 70), (6, 100), (6, 999), (8, 999)]
    got = {r.read: r.lca for r in taxonomy.common_ancestor(spark.createDataFrame(sets, "read int, tid long"), tree).collect()}
    assert got == {1: 20, 2: 2, 3: 100, 4: 100}  # other roots and unknown taxa have none


def test_gathered_and_accuracy(spark):
    nodes = [(1, 1), (2, 1), (10, 2), (11, 2), (3, 1)]
    tree = taxonomy.closure(spark.createDataFrame([(t, p, "no", str(t)) for t, p in nodes], "tid long, parent long, rank string, name string"))
    counts = spark.createDataFrame([(10, 5), (11, 2), (3, 1)], "tid long, n long")
    assert {r.tid: r.n for r in taxonomy.gathered(counts, tree, 4).collect()} == {10: 5, 2: 2, 1: 1}
    truth = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 3)], "read int, tid long")
    found = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (3, 10), (9, 10)], "read int, tid long")
    got = {r.tid: (r.n_true, r.n_found, r.n_right, r.sensitivity, r.false_discovery) for r in taxonomy.taxon_accuracy(truth, found).collect()}
    assert got == {10: (2, 2, 1, 0.5, 0.5), 11: (1, 1, 0, 0.0, 1.0), 3: (1, 0, 0, 0.0, None)}
