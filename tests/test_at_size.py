"""What a task takes does not grow with the table: FASTQ ranges, hits of reads, depths of neighbouring k-mers, pieces of sequences."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestrand.functions import codes
from lodestrand.operators import depths, taxonomy
from lodestrand.sources import fastq


def test_small_ranges_share_a_task(spark, tmp_path):
    rng = random.Random(1)
    records = [(f"r{i}", "".join(rng.choices("ACGT", k=rng.choice([0, 3, 40, 900])))) for i in range(400)]
    text = "".join(f"@{n} c\n{s}\n+\n{'@' * len(s)}\n" for n, s in records)
    (tmp_path / "a.fq").write_text(text)
    fastq.register(spark)
    whole = fastq.TASK_BYTES
    for task in (1, 500, 5_000, whole):
        fastq.TASK_BYTES = task
        try:
            reader = fastq.FastqReader({"path": str(tmp_path / "a.fq"), "splitbytes": "100"})
            parts = reader.partitions()
            got = [(n, r[0], r[2]) for p in parts for n, r in reader._records(p)]
        finally:
            fastq.TASK_BYTES = whole
        assert [g[1:] for g in got] == records
        assert len({g[0] for g in got}) == len(got) and sorted(got) == got
        assert len(parts) == -(-len(text) // (max(1, task // 100) * 100))


def test_count_table_in_many_tasks(spark, monkeypatch):
    nodes = [(1, 1, "no", "root"), (2, 1, "superkingdom", "k"), (3, 1, "clade", "c"), (10, 2, "family", "f"), (20, 10, "genus", "g"), (21, 3, "clade", "h"), (100, 20, "species", "a"), (101, 20, "species", "b"), (102, 21, "species", "d"), (103, 10, "species", "e"), (1000, 100, "no", "s")]
    tree = taxonomy.closure(spark.createDataFrame(nodes, "tid long, parent long, rank string, name string"))
    rng = random.Random(2)
    hits = [(f"r{rng.randrange(40)}", rng.choice([100, 101, 102, 103, 1000, 20, 7])) for _ in range(90)] * 2
    up = {100: (100, 20, 10, 2), 1000: (100, 20, 10, 2), 101: (101, 20, 10, 2), 102: (102, "s102", "gs102", "-"), 103: (103, "s103", 10, 2)}
    own = defaultdict(set)
    for read, tid in hits:
        for rank, to in zip(taxonomy.MAIN_RANKS, up.get(tid, ())):
            own[read, rank].add(to)
    want = Counter((rank, to, len(tos) == 1) for (_, rank), tos in own.items() for to in tos if not isinstance(to, str))
    monkeypatch.setattr(taxonomy, "TASK_ROWS", 10)
    got = taxonomy.count_table(spark.createDataFrame(hits, "read string, tid long"), tree)
    assert {(r["rank"], r.tid): (r.uniq, r.multi) for r in got.collect()} == {(k, t): (want[k, t, True], want[k, t, False]) for k, t, _ in want}
    # the number of tasks grows with the hits, not with a setting
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [3, 5, 31])
def test_errors_against_plain_counts(spark, monkeypatch, k):
    monkeypatch.setattr(codes, "PIECE", 50)
    rng = random.Random(k)
    base = "".join(rng.choices("ACGT", k=60))
    seqs = [base] * 5 + [base[:30] + "T" + base[31:], "".join(rng.choices("ACGTN", k=140)), "", base[:k], "ACG" * 40]
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    code = lambda s: max(s, turned(s)) if set(s) <= set("ACGT") else None
    own = [[code(s[i : i + k]) for i in range(len(s) - k + 1)] for s in seqs]
    n = Counter(x for o in own for x in o if x)
    want = {}
    for i, o in enumerate(own):
        bad = sum(max(n[a], n[b]) >= 5 and min(n[a], n[b]) <= 2 and max(n[a], n[b]) >= 2 * min(n[a], n[b]) for a, b in zip(o, o[1:]) if a and b)
        if bad:
            want[i] = bad
    out = depths.errors(spark.createDataFrame(list(enumerate(seqs)), "name int, seq string"), k, 2, 2, 5)
    assert {r.name: r.errors for r in out.collect()} == want
    if k < 31:  # no place of a read is looked up among all places
        assert "pos" not in "".join(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x)


def test_pieces_are_small():
    batch = pa.RecordBatch.from_arrays([pa.array(["ACGT" * 200_000, "ACGTT" * 1_000] * 2)], names=["seq"])
    rows = [(r.max() - r.min(), len(c)) for r, _, c in codes._pieces(batch, "seq", 15)]
    assert max(n for _, n in rows) <= 2 * 131_072 and sum(n for _, n in rows) == 2 * (800_000 - 14 + 5_000 - 14)
    assert np.array_equal(*(np.concatenate([c for _, _, c in codes._pieces(batch.slice(i, 1), "seq", 15)]) for i in (0, 2)))
