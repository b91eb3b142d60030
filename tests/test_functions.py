"""Small cases worked out by hand, and brute force for the array expressions."""

import gzip
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators import intervals, kmers, overlaps, qc, reads, sam, taxonomy
from lodestrand.sources import fastq, text


def value(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], list(given)).select(column).first()[0] if given else spark.range(1).select(column).first()[0]


def test_headers(spark):
    v = lambda f, x: value(spark, f(F.col("x")), x=x)
    assert [v(S.remove_version, x) for x in ("NC_001.12", "ABC", "A.1b", "X.")] == ["NC_001", "ABC", "A.1b", "X"]
    assert v(S.accession, "gi|5|ref|NC_9.1|") == "NC_9" and v(S.accession, "NC_7.2") == "NC_7"
    assert v(S.accessions, "gi|5|ref|NC_9.1|\x01gnl|uv|J0:1-5") == ["NC_9", "J0"]
    assert [v(S.trim_read_no, x) for x in ("r1/1", "/2", "r/12")] == ["r1", "/2", "r/12"]
    assert v(S.header_taxid, "s|kraken:taxid|77") == 77
    assert [tuple(x) for x in v(S.hits, "90,A.1;88,B.2;")] == [(90.0, "A.1"), (88.0, "B.2")] and v(S.hits, "*") == []


def test_sequences(spark):
    v = lambda f, x: value(spark, f(F.col("x")), x=x)
    assert v(S.reverse_complement, "ACGTN") == "NACGT"
    assert v(S.strand_key, "ACCT") == v(S.strand_key, "AGGT") != v(S.strand_key, "ACCA")
    assert [tuple(t) for t in v(lambda c: S.tiles(c, 4, 3), "ABCDEFGHI")] == [(0, "ABCD"), (3, "DEFG"), (5, "FGHI")]
    assert v(lambda c: S.mask_runs(c, 15), "AC" + "g" * 15 + "T" + "a" * 14) == "AC" + "N" * 15 + "T" + "A" * 14
    assert v(lambda c: S.mask_region(c, F.lit(3), F.lit(4)), "ACGTA") == "ANNNN"
    assert v(lambda c: S.cigar_score(c, F.lit(5)), "8M4I4M1D3M") == 4
    assert v(lambda c: S.translate_frame(c, 0), "ATGGCCTAAG") == "MA*" and v(lambda c: S.translate_frame(c, 3), "TTAGGCCAT") == "MA*"
    assert v(lambda c: S.force_trim(c, 1, 6, 1, 0), "ABCDEFGH") == "BCDEFG"
    assert v(S.average_quality, "IIII") == 40
    assert value(spark, S.allele_frequency(F.lit("G"), F.lit("GT"), F.lit(20), F.create_map(F.lit("A"), F.lit(5), F.lit("IT"), F.lit(2)))) == 0.1


def test_entropy_by_brute_force(spark):
    random.seed(3)
    for s in ("A" * 60, "".join(random.choice("ACGT") for _ in range(70)), "ACGT"):
        expected = 1.0
        if len(s) >= 50:
            each = []
            for i in range(len(s) - 49):
                c = Counter(s[i + j : i + j + 5] for j in range(46))
                each.append(-sum(n / 46 * math.log(n / 46) for n in c.values()) / math.log(46))
            expected = sum(each) / len(each)
        assert value(spark, S.entropy(F.col("x")), x=s) == pytest.approx(expected, abs=1e-9)


def test_optimal_trim_by_brute_force(spark):
    random.seed(5)
    for _ in range(8):
        q = "".join(chr(33 + random.choice([2, 5, 12, 30, 40])) for _ in range(12))
        gains = [0.05 - 10 ** (-(ord(c) - 33) / 10) for c in q]
        best = max(((sum(gains[i:j]), j - i, -i) for i in range(12) for j in range(i + 1, 13)), key=lambda t: (round(t[0], 12), t[1]))
        got = value(spark, S.optimal_trim(F.col("x"), 0.05), x=q)
        if best[0] <= 0:
            assert got["size"] == 0
        else:
            assert sum(gains[got.start : got.start + got["size"]]) == pytest.approx(best[0])


@pytest.fixture(scope="module")
def tree(spark):
    rows = [(1, 1, "no", "root"), (2, 1, "superkingdom", "Viruses"), (10, 2, "family", "f"), (20, 10, "genus", "g"), (100, 20, "species", "a"), (101, 20, "species", "b"), (200, 2, "species", "c"), (1000, 100, "no", "strain")]
    return taxonomy.closure(spark.createDataFrame(rows, "tid long, parent long, rank string, name string")).cache()


def test_common_ancestors_and_report(spark, tree):
    sets = spark.createDataFrame([("a", 100), ("a", 101), ("b", 100), ("b", 200), ("c", 1000), ("c", 100), ("d", 100)], "read string, tid long")
    assert {r.read: r.lca for r in taxonomy.common_ancestor(sets, tree).collect()} == {"a": 20, "b": 2, "c": 100, "d": 100}
    reads3 = spark.createDataFrame([("x", 100), ("y", 100), ("y", 101), ("z", 200)], "read string, tid long")
    rows = {r.tid: (r.clade, r.stay) for r in taxonomy.report(taxonomy.common_ancestor(reads3, tree), tree, 5).collect()}
    assert rows == {1: (3, 0), 2: (3, 0), 10: (2, 0), 20: (2, 1), 100: (1, 1), 200: (1, 1)}
    lines = [r.line for r in taxonomy.report_lines(taxonomy.report(taxonomy.common_ancestor(reads3, tree), tree, 5), tree).collect()]
    assert lines[0].endswith("root") and lines[1].endswith("  Viruses") and len(lines) == 6


def test_lookup(spark, tree):
    acc = spark.createDataFrame([("A", 1000), ("B", 101), ("C", 200)], "acc string, tid long")
    hits = spark.createDataFrame([("r", "A", 90.0), ("r", "B", 88.0), ("r", "A", 50.0), ("r", "Z", 99.0)], "read string, acc string, score double")
    assert sorted((r.tid, r.score) for r in taxonomy.lookup(hits, acc, tree).collect()) == [(100, 90.0), (101, 88.0)]


def test_reassign_by_hand(spark):
    def run(singles):
        rows = [(f"u{i}", 7) for i in range(30)] + [(f"m{i}", t) for i in range(10) for t in (7, 8)] + [(f"s{i}", 8) for i in range(singles)]
        got = taxonomy.reassign(spark.createDataFrame([(r, t, 50.0) for r, t in rows], "read string, tid long, score double"))
        return len(rows), got.count(), got.where("tid = 8").count()

    assert run(1) == (51, 41, 1)
    assert run(2) == (52, 52, 12)


def test_spikes_by_hand(spark):
    runs = spark.createDataFrame([("c", 0, 90, 0), ("c", 90, 100, 10)], "chrom string, start long, end long, depth long")
    assert [r.start for r in intervals.spikes(runs, 2).collect()] == [90]
    assert intervals.spikes(runs, 3).count() == 0
    m8 = spark.createDataFrame([("s", 0, 10), ("s", 9, 20), ("s", 24, 30)], "chrom string, start long, end long")
    assert intervals.covered(m8).first()[1:] == (2, 26)


def test_mates_and_alignments(spark):
    rows = spark.createDataFrame([(0, "r1/1"), (1, "r1/2"), (2, "r2/1")], "at long, name string").withColumn("file", F.lit("f"))
    assert [r.mate for r in reads.pair_up(rows, "at", "file").orderBy("at").collect()] == [64, 128, 0]
    a = spark.createDataFrame([("q1", "T", 50.0), ("q1", "X", 50.0), ("q2", "T", 40.0), ("q2", "X", 50.0)], "read string, ref string, score double")
    assert [r.read for r in reads.best_on_targets(a, spark.createDataFrame([("T",)], "ref string")).collect()] == ["q1"]
    s = spark.createDataFrame([("q", 65 + 16, "c", 5, 30, "2S3M", "ACGTA", "IIIII")], "qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, qual string")
    assert sam.to_fastq(s).first()[:2] == ("q/1", "TACGT")
    assert sorted((r.pos, r.depth) for r in sam.depth(s).collect()) == [(5, 1), (6, 1), (7, 1)]
    assert sam.soft_clip_filter(s).count() == 1 and sam.soft_clip_filter(s, 0.7).count() == 0


def test_kmer_filters(spark):
    ref = spark.createDataFrame([("ref", "ACGTACGGTCA")], "name string, seq string")
    rd = spark.createDataFrame([("a", "TTTTACGTACGGTTTT"), ("b", "TTTTTTTTTT"), ("c", "")], "name string, seq string")
    k = 7
    assert {r.name: r.hits for r in kmers.match(rd, ref, k).collect()} == {"a": 3}
    assert {r.name: r.seq for r in kmers.mask(rd, ref, k).collect()}["a"] == "TTTTNNNNNNNNNTTT"
    assert {r.name: r.seq for r in kmers.trim(rd, ref, k).collect()} == {"a": "TTTT", "b": "TTTTTTTTTT", "c": ""}
    assert kmers.match(spark.createDataFrame([("x", "ACGAACG")], "name string, seq string"), ref, k, substitutions=1).count() == 1
    inner = spark.createDataFrame([("long", "ACGTTGCA" * 20 + "GGATC"), ("part", ("ACGTTGCA" * 20)[3:120]), ("short", "ACGT")], "name string, seq string")
    assert [r.name for r in overlaps.contained(inner).collect()] == ["long"]


def test_quality_control(spark):
    rd = spark.createDataFrame([("p/1", "ACGTACGT", "IIIIIIII"), ("p/2", "NNNNACGT", "####IIII"), ("s/1", "GGGG", "IIII"), ("s/2", "GGCC", "IIII")], "name string, seq string, qual string")
    marked = qc.filters(rd, least=4, most_n=2)
    assert sorted(r.name for r in qc.keep_pairs(marked).collect()) == ["s/1", "s/2"]
    assert [r.name for r in qc.singletons(marked).collect()] == ["p/1"]
    assert {r.name: r.seq for r in qc.quality_trim(rd, 0.05).collect()}["p/2"] == "ACGT"


def test_sources(spark, tmp_path):
    (tmp_path / "fq").mkdir()
    with gzip.open(tmp_path / "fq" / "a.fq.gz", "wt") as f:
        f.write("@r1/1 c\nACG\nT\n+\nII\n@I\n@r2\nA\n+\n@\n")
    fastq.register(spark)
    got = spark.read.format("fastq").load(str(tmp_path / "fq")).orderBy("number").collect()
    assert [(r.name, r.comment, r.seq, r.qual) for r in got] == [("r1/1", "c", "ACGT", "II@I"), ("r2", "", "A", "@")]
    (tmp_path / "x.fa").write_text(">s1 d e\nAC\nGT\n>s2\nTT\n")
    assert sorted((r.name, r.comment, r.seq) for r in text.fasta(spark, str(tmp_path / "x.fa")).collect()) == [("s1", "d e", "ACGT"), ("s2", "", "TT")]
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n9\t|\t1\t|\tspecies group\t|\n")
    assert sorted(tuple(r) for r in text.nodes(spark, str(tmp_path / "nodes.dmp")).collect()) == [(1, 1, "no"), (9, 1, "species")]
    (tmp_path / "x.lsam").write_text("n\t64\t90\tAC\tII\t90,A.1;88,B.2\tViruses\nm\t0\t-1\tAC\tII\t*\n")
    rows = text.lsam(spark, str(tmp_path / "x.lsam")).orderBy("name").collect()
    assert [len(r.hits) for r in rows] == [0, 2] and rows[1].tags == ["Viruses"]
    text.write_lsam(text.lsam(spark, str(tmp_path / "x.lsam")), str(tmp_path / "out"))
    assert "n\t64\t90\tAC\tII\t90,A.1;88,B.2\tViruses" in [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq\t0\tc\t5\t30\t3M\t*\t0\t0\tACG\tIII\tNM:i:2\tAS:i:9\n")
    assert text.sam(spark, str(tmp_path / "x.sam")).first().tags == {"NM": "2", "AS": "9"}


def test_stream_equals_batch(spark, tmp_path):
    from lodestrand.streaming import events

    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = events.follow(spark, str(tmp_path / "in"), rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    events.append(stream.where("value > 5"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.where("value > 5").count()
