"""Merging, cutting, barcodes, clumps and chunks on small cases: nulls, short and empty sequences, ties."""

from lodestrand.functions import seq as S
from lodestrand.operators import rearrange as R
from pyspark.sql import functions as F

RC = bytes.maketrans(b"ACGT", b"TGCA")


def rc(s):
    return s.encode().translate(RC)[::-1].decode()


def test_merge_mates(spark):
    whole = "ACGTTGCAAGGCTTAACCGGATCGATTACAGGCATCG"
    left, right = whole[:25], whole[12:]
    wrong = right[:3] + ("A" if right[3] != "A" else "C") + right[4:]
    rows = [(1, left, rc(right)), (2, left, rc(wrong)), (3, left, rc("T" * 25)), (4, None, rc(right)), (5, "", ""), (6, "ACG", "ACG")]
    got = {r.id: (r.overlap, r.merged) for r in R.merge_mates(spark.createDataFrame(rows, "id int, seq1 string, seq2 string")).collect()}
    assert got == {1: (13, whole), 2: (13, whole), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None)}


def test_cut_at_n(spark):
    rows = [(1, "NNNACGNTNNNNGG"), (2, ""), (3, None), (4, "NNN"), (5, "ACGT")]
    got = [tuple(r) for r in R.cut_at_n(spark.createDataFrame(rows, "name int, seq string"), 3).orderBy("name", "part").collect()]
    assert got == [(1, 0, "ACGNT"), (1, 1, "GG"), (5, 0, "ACGT")]


def test_demultiplex(spark):
    reads = spark.createDataFrame([(1, "AAAA"), (2, "AAAT"), (3, "AATT"), (4, None), (5, "GGGG"), (6, "AACT"), (7, "AAA")], "id int, barcode string")
    tags = spark.createDataFrame([("AAAA",), ("AAAA",), ("AATT",), (None,), ("ACG",)], "tag string")
    got = {r.id: r.file for r in R.demultiplex(reads, tags, 4).collect()}
    assert got == {1: "AAAA", 2: "unknown", 3: "AATT", 4: "unknown", 5: "unknown", 6: "AATT", 7: "unknown"}


def test_pivots_and_clumps(spark):
    core = "ACGGTCATTGCAAC"
    rows = [(1, core), (2, rc(core)), (3, "ACG"), (4, None), (5, "NNNNNNNNNN"), (6, "")]
    got = {r.name: r for r in R.clumped(spark.createDataFrame(rows, "name int, seq string"), 5).collect()}
    assert len(got) == 6 and got[1].pivot == got[2].pivot and got[1].place + got[2].place == len(core) - 5
    assert all(got[i].pivot is None and got[i].place is None for i in (3, 4, 5, 6))


def test_chunks_follow_the_running_length(spark):
    lengths = [0, 7, 12, 1, 30, 5, 5, 9, 0, 3] * 20
    rows = [(i * 3, "A" * n if i != 4 else None) for i, n in enumerate(lengths)]
    got = {r.name: r.chunk for r in R.chunk_by_size(spark.createDataFrame(rows, "name int, seq string"), 20, ranges=8).collect()}
    run = 0
    for name, seq in rows:
        assert got[name] == run // 20
        run += len(seq or "")
    assert R.chunk_by_size(spark.createDataFrame([], "name int, seq string"), 20).count() == 0


def test_kmers_and_frames(spark):
    rows = [("ACGTA",), ("AC",), ("",), (None,)]
    df = spark.createDataFrame(rows, "s string").select(S.kmers(F.col("s"), 3).alias("k"), *[S.translate_frame(F.col("s"), f).alias(f"f{f}") for f in range(6)])
    a, b, c, d = df.collect()
    assert a.k == ["ACG", "CGT", "GTA"] and b.k == c.k == [] and d.k is None
    assert [a[f"f{f}"] for f in range(6)] == ["T", "R", "V", "Y", "T", "R"] and b.f0 == c.f5 == ""


def test_uniqueness_and_positions(spark):
    df = spark.createDataFrame([(0, "AAAC"), (1, "AAAC"), (10, "AAACC"), (11, None)], "name int, seq string")
    assert sorted(map(tuple, R.uniqueness(df, 3, 10).collect())) == [(0, 4, 2), (1, 3, 1)]
    assert sorted(map(tuple, R.hit_positions(df, df.where("name = 10"), 3).collect())) == [(0, 3), (1, 3), (2, 1)]


def test_overlaps_are_those_of_a_plain_search(spark):
    import random

    from lodestrand.operators import rearrange

    rng = random.Random(5)
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("ACGT" * 2_000, turned("ACGT" * 1_999)), (None, "ACGT"), ("ACG", "")]
    for _ in range(200):
        whole = "".join(rng.choices("AC" if rng.random() < 0.3 else "ACGT", k=rng.randrange(5, 70)))
        cut = rng.randrange(len(whole))
        rows.append((whole[: cut + rng.randrange(30)], turned(whole[cut:])))

    def plain(a, b):
        if a is None or b is None:
            return None
        b = turned(b)
        found = [(sum(x != y for x, y in zip(a[len(a) - n :], b)) / n, -n) for n in range(6, min(len(a), len(b)) + 1)]
        return -min(found)[1] if found and min(found)[0] <= 0.15 else None

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, seq1 string, seq2 string")
    got = {r.i: (r.overlap, r.merged) for r in rearrange.merge_mates(df, 6, 0.15).collect()}
    for i, (a, b) in enumerate(rows[1:], 1):
        n = plain(a, b)
        assert got[i] == (n, None if n is None else a + turned(b)[n:])
    assert got[0][0] == 7_996  # of letters by numbers: a search letter by letter took hours
