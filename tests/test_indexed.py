"""The index of FASTA files and what is fetched by it, against plain reading; the record sink, tasks lost on the way too."""

import gzip
import os
import random
import subprocess
import sys
import textwrap

import pytest

from lodestrand.sources import fastq, regions, writers

ODD = {
    "a.fa": b">one first\nACGTACGT\nACGTACGT\nACG\n>two\n\n>three\r\nAC\r\nGT\r\nA\r\n>four\nACGTAC",
    "b.fa": b"lost bases\n>uneven\nACG\nACGTA\nAC\n>gap\nACGT\n\nACGT\n>mixed\nACGT\r\nACGT\nACGT\n>short\nACGT\nAC\nACGT\n>blank\nACGT\nAC\n\n>last\n",
    "_skip": b">hidden\nACGT\n",
}


def plain(folder):
    out = {}
    for name in sorted(os.listdir(folder)):
        if name[0] not in "._":
            own = None
            for line in (folder / name).read_bytes().splitlines():
                if line[:1] == b">":
                    own = line[1:].split()[0].decode()
                    out[own] = ""
                elif own:
                    out[own] += line.decode()
    return out


@pytest.fixture
def odd(tmp_path):
    for name, data in ODD.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path


@pytest.mark.parametrize("split", [5, 9, 23, 10_000])
def test_index_and_fetch(spark, odd, split):
    want = plain(odd)
    index = regions.build_index(spark, str(odd), split).cache()
    got = {r.name: r for r in index.collect()}
    assert {n: r.length for n, r in got.items()} == {n: len(s) for n, s in want.items()}
    assert {n for n, r in got.items() if not r.even} == {"uneven", "gap", "mixed", "short"}
    assert (got["three"].line_bases, got["three"].line_width, got["one"].line_bases, got["one"].line_width) == (2, 4, 8, 9)
    wanted = [(n, s, e) for n in [*want, "nobody"] for s in range(-1, 20, 3) for e in (s, s + 1, s + 6, 99)]
    rows = regions.fetch(index, spark.createDataFrame(wanted, "name string, start int, end int"), str(odd)).collect()
    expected = sorted((n, max(s, 0), min(e, len(want[n])), want[n][max(s, 0) : e]) for n, s, e in wanted if n in want and max(s, 0) < min(e, len(want[n])))
    assert sorted((r.name, r.start, r.end, r.seq) for r in rows) == expected


def test_few_bytes_are_read_for_few_regions(spark, tmp_path):
    rng = random.Random(1)
    seqs = {f"c{i}": "".join(rng.choices("ACGT", k=200_000)) for i in range(5)}
    path = tmp_path / "large.fa"
    path.write_text("".join(f">{n}\n" + "\n".join(s[i : i + 70] for i in range(0, len(s), 70)) + "\n" for n, s in seqs.items()))
    index = regions.build_index(spark, str(path), 64_000)
    wanted = [(f"c{i}", at, at + 500) for i in range(5) for at in (0, 99_990, 199_700)]
    rows = regions.fetch(index, spark.createDataFrame(wanted, "name string, start long, end long"), str(path), 1_000).collect()
    assert len(rows) == 15 and all(r.seq == seqs[r.name][r.start : r.end] for r in rows)
    assert sum(r.bytes for r in rows) < path.stat().st_size / 100
    regions.write_fai(index, str(tmp_path / "large.fa.fai"))
    regions.register(spark)
    some = spark.read.format("fasta_regions").option("regions", "c1:101-1,200 c3 c4:199991 none:1-2").option("taskBytes", 5_000).load(str(path)).collect()
    assert {(r.name, r.start, r.end): r.seq for r in some} == {("c1", 100, 1200): seqs["c1"][100:1200], ("c3", 0, 200_000): seqs["c3"], ("c4", 199_990, 200_000): seqs["c4"][-10:]}


def test_no_index_of_compressed_files(spark, tmp_path):
    (tmp_path / "x.fa.gz").write_bytes(gzip.compress(b">a\nA\n"))
    with pytest.raises(ValueError, match="compressed"):
        regions.build_index(spark, str(tmp_path))
    (tmp_path / "empty").mkdir()
    assert regions.build_index(spark, str(tmp_path / "empty")).count() == 0


def test_layouts(spark, tmp_path):
    writers.register(spark)
    save = lambda df, layout, **o: df.coalesce(1).write.format("records").options(layout=layout, **o).mode("append").save(str(tmp_path / layout))
    text = lambda layout: "".join((tmp_path / layout / f).read_text() for f in sorted(os.listdir(tmp_path / layout)) if f[0] != "_")
    reads = spark.createDataFrame([("a b", "ACGTA", "IIIII"), ("c", "", ""), ("d", None, None)], "name string, seq string, qual string")
    save(reads, "fastq")
    save(reads, "fasta", width=2)
    assert text("fastq") == "@a b\nACGTA\n+\nIIIII\n@c\n\n+\n\n@d\n\n+\n\n" and text("fasta") == ">a b\nAC\nGT\nA\n>c\n>d\n"
    sam = spark.createDataFrame([("q", 4, None, 0, {"XB": "2", "XA": "1"}), ("r", 0, "c", 5, None)], "qname string, flag int, rname string, pos int, tags map<string,string>")
    save(sam, "sam", header="@HD\tVN:1.6")
    assert text("sam") == "@HD\tVN:1.6\nq\t4\t*\t0\tXA:Z:1\tXB:Z:2\nr\t0\tc\t5\n"
    save(spark.createDataFrame([("c", 1, None)], "chrom string, pos int, id string"), "vcf")
    assert text("vcf") == "c\t1\t.\n" and sorted(f for f in os.listdir(tmp_path / "vcf") if f[0] == "_") == ["_SUCCESS"]
    with pytest.raises(Exception, match="no layout"):
        save(reads, "nothing")
    # overwriting leaves the new files alone
    reads.limit(1).write.format("records").option("layout", "fasta").mode("overwrite").save(str(tmp_path / "fasta"))
    assert text("fasta") == ">a b\nACGTA\n"


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    writers.register(spark)

    def stop(batches):
        for b in batches:
            yield b
            raise RuntimeError("stop")

    rows = spark.range(100).selectExpr("cast(id as string) as value").mapInArrow(stop, "value string")
    with pytest.raises(Exception, match="stop"):
        rows.write.format("records").mode("append").save(str(tmp_path / "out"))
    assert not [f for _, _, files in os.walk(tmp_path) for f in files]


def test_a_lost_task_is_written_once(tmp_path):
    """A session with retries, in which a task of every partition fails once after its rows were written."""
    code = f"""
    import os
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from lodestrand.sources import fastq, writers
    spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
    writers.register(spark)
    fastq.register(spark)
    def fails_once(batches):
        for b in batches:
            yield b
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
    rows = spark.range(0, 5000, 1, 4).selectExpr("concat('r', id) as name", "repeat('A', cast(id % 50 as int)) as seq", "repeat('I', cast(id % 50 as int)) as qual", "id % 2 as mate")
    rows.mapInArrow(fails_once, rows.schema).write.format("records").options(layout="fastq", codec="gzip", split="mate").mode("append").save({str(tmp_path / 'out')!r})
    back = spark.read.format("fastq").load({str(tmp_path / 'out')!r})
    assert back.select("name", "seq", "qual").exceptAll(rows.select("name", "seq", "qual")).isEmpty() and back.count() == 5000
    names = sorted(os.listdir({str(tmp_path / 'out')!r}))
    assert len(names) == 9 and sum(n.endswith("_0.fastq.gz") for n in names) == 4 and "_SUCCESS" in names, names
    print("whole")
    """
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": os.getcwd()}, cwd=os.getcwd())
    assert run.stdout.strip().endswith("whole"), run.stderr[-3000:]


def test_records_read_back(spark, tmp_path):
    writers.register(spark)
    fastq.register(spark)
    rows = spark.createDataFrame([(f"n{i}", "ACGT" * (i % 7), "IIII" * (i % 7)) for i in range(300)], "name string, seq string, qual string")
    rows.write.format("records").options(layout="fastq").mode("append").save(str(tmp_path / "q"))
    assert rows.exceptAll(spark.read.format("fastq").load(str(tmp_path / "q")).select("name", "seq", "qual")).isEmpty()
