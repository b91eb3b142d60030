"""Hard negatives, personal data and importance resampling against plain versions, and on awkward tables."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrand.llm import hard_negatives, resampling, sanitising

VECTORS = "vec_id long, embedding array<float>, label int"


def documents(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string")
    return made.withColumns({c: F.lit(i) for i, c in enumerate(["rid", "term", "value", "_w", "_b", "start", "rank", "score"])})


# ----------------------------------------------------------- hard negatives


def plain_negatives(rows, k=5):
    rows = sorted({(i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = Counter()
    for i, y, v in rows:
        if i % 100:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in rows if j != i and len(v) == len(w))
        for p, j, z in [x for x in near if x[2] == y][:k]:
            others = [(n, m) for n, m, z in near if z != y and 80 * -p <= 100 * -n <= 100 * -p]
            out.update((i, j, rank, m, -p, -n) for rank, (n, m) in enumerate(others[:k], 1))
    return out


@pytest.mark.parametrize("dim, cell_rows, cell_anchors", [(12, 64, 2), (12, 16_384, 4_096), (1, 32, 3)])
def test_hard_negatives_by_brute_force(spark, dim, cell_rows, cell_anchors):
    rng = np.random.default_rng(dim + cell_rows)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(700):
        v = centres[rng.integers(6)] + 0.3 * rng.normal(size=dim)
        rows.append((i, [float(np.float32(round(x, 1))) for x in v], int(rng.integers(4))))
    rows += [(i + 700, rows[3][1], 1) for i in range(80)]  # one vector many times: ties
    rows += [rows[100], rows[100], (100, rows[5][1], 2), (None, rows[0][1], 1), (900, None, 1), (901, rows[0][1], None), (902, [float("nan")] * dim, 1), (903, [None] * dim, 1), (1000, [1.0] * (dim + 1), 1), (1001, [1.0] * (dim + 1), 1), (1002, [1.0] * (dim + 1), 2), (1100, [], 1), (1101, [], 1), (1102, [], 3)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"shard": F.lit(1), "v": F.lit("x"), "nth": F.lit(0)})
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, hard_negatives.relabelled(), cell_rows=cell_rows, cell_anchors=cell_anchors)
    want = plain_negatives(rows)
    assert want and Counter(tuple(r) for r in got.collect()) == want


def test_hard_negatives_of_few_or_no_rows(spark):
    for rows in ([], [(100, [1.0], 1)], [(100, [1.0], 1), (101, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [-1.0], 1), (101, [1.0], 1), (102, [1.0], 2)]):
        got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0, hard_negatives.relabelled())
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and Counter(tuple(r) for r in got.collect()) == plain_negatives(rows)


def test_scores_beyond_doubles_are_whole():
    a, x = np.array([[2.0**40, 1.0]]), np.array([[2.0**30, 3.0], [2.0**30, 2.0], [2.0**10, 1.0]])
    turn = hard_negatives.rotation(x)
    found = hard_negatives.nearest_of_label(a, np.array([1]), np.array([-np.inf]), x, np.array([7, 8, 9]), turn, 2)
    assert found == [(0, 7, 2**63 - 1), (0, 8, 2**63 - 1)] or [f[1] for f in found] == [7, 8]
    assert hard_negatives.lowest(7) == 6 and hard_negatives.lowest(5) == 4 and hard_negatives.lowest(0) == 0


# ------------------------------------------------------------ personal data


FINDS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_base(text):
    spans = []
    for kind, pattern in enumerate(FINDS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == 2:
                doubled = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or doubled % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            spans.append((m.start(), kind, m.end()))
    spans.sort()
    return [sum(s[1] == k for s in spans) for k in range(4)], ",".join(f"{sanitising.KINDS[k]}:{s}:{e}" for s, k, e in spans)


HARD = [
    None, "", " \n", "a@b.c", "a@b", "é.bob@x.yé", "a@b.c_d@e.f g@h.i@j.k", "aa@b@c.d", "x.y@z.w.v-u..t@s.r", "\U0001f600 me@here.org \U0001f600 you@there.org", "@a.b", "a@b.c.d@e.f",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0255 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111 1111 1111", "5500005555555559 and 12345678901234567890", "0" * 12 + "x" + "0" * 19 + "y" + "0" * 20,
    "+1 (017) 555-7713", "+12345678", "+123456789", "+1234567890123456", "++1 23 45 67 89 +", "+1.2.3.4.5.6.7.8.9 tail", "+4111111111111111 a+b@c.d", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "call +1 (974) 555-3436, mail q@r.st or 10.0.0.1\r\n" * 40,
]


def test_base_spans_equal_plain_ones(spark):
    got = {r.doc_id: r for r in sanitising.find(documents(spark, list(enumerate(HARD)))).collect()}
    assert len(got) == len(HARD)
    for i, t in enumerate(HARD):
        counts, spans = plain_base(t)
        r = got[i]
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.spans, r.n_term, r.base_sha256) == (counts, spans, 0, hashlib.sha256(spans.encode()).hexdigest()), t


LONG = ["x" * 400_000, "1" * 400_000, "1." * 200_000, "a." * 200_000, "+1 " * 130_000, "a@b" + ".c" * 200_000, "4111 1111 1111 1111, " * 20_000, "a@b.cd " * 50_000, "(" * 400_000]


def test_long_texts_take_linear_time(spark):
    start = time.time()
    got = {r.doc_id: r for r in sanitising.find(documents(spark, list(enumerate(LONG)))).collect()}
    took = time.time() - start
    for i, text in enumerate(LONG):
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == plain_counts(text), i
    assert took < 100  # some seconds by itself; other work may share the machine


def plain_counts(text):
    return [text.count("@b."), text.count("1.1.1.1"), text.count("4111 1111 1111 1111"), 0]


def test_terms_that_give_an_entity_away(spark):
    words = "river stone cloud paper light green field mouse table chair plain winter summer garden window letter".split()
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join(rng.choice(words, n))

    rows = [(i, f"{prose(12)} {'Quillan' if i % 2 else 'QUILLAN'} {prose(2)} jq@mail.org {prose(12)}. And Quillan's {prose(3)}") for i in range(6)]
    rows += [(10, f"{prose(20)} Zebedee {prose(2)} z@mail.org {prose(5)}")] * 8  # copies are one observation
    rows += [(i, prose(40)) for i in range(20, 60)]
    rows += [(70, "Quillan without an address"), (71, None), (72, "")]
    got = defaultdict(list)
    for r in sanitising.find(documents(spark, rows)).collect():
        got[r.doc_id].append(r)
    for i in range(6):
        r, text = got[i][0], rows[i][1]
        spans = [s.split(":") for s in r.spans.split(",")]
        assert {text[int(s) : int(e)].lower() for k, s, e in spans if k == "term"} == {"quillan"} and r.n_term == 2 and r.n_email == 1
    assert len(got[10]) == 8 and all(r.n_term == 0 and r.n_email == 1 for r in got[10]) and got[70][0].spans == ""
    clean = {(r.doc_id, r.text) for r in sanitising.sanitise(documents(spark, rows)).collect()}
    texts = dict(x for x in clean if x[0] != 10)
    assert all("[EMAIL]" in texts[i] and "uillan" not in texts[i].lower() for i in range(6)) and texts[70] == "Quillan without an address" and texts[71] is None and texts[72] == "" and texts[20] == rows[14][1]


def test_running_sums(spark):
    for values in ([], [4], [1, 2, 3], list(range(100))):
        r = spark.createDataFrame([(values,)], "v array<int>").select(sanitising.running(F.col("v")), sanitising.running(F.col("v"), F.greatest)).first()
        assert r[0] == list(np.cumsum(values)) and r[1] == list(np.maximum.accumulate(values) if values else [])


def test_personal_data_of_no_rows(spark):
    assert sanitising.find(documents(spark, [])).collect() == [] and sanitising.sanitise(documents(spark, [])).collect() == []


# --------------------------------------------------- importance resampling


def plain_resampling(rows, target, percent, least, max_run, of):
    def features(text):
        w = re.findall(resampling.WORD, (text or "").translate(str.maketrans(resampling._UPPER, resampling._LOWER)))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % of for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for x in texts for b in features(x)[1]) for texts in ([r[1] for r in rows], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        n, f = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + of) / ((s[b] + 1) * (big_t + of)))) for b in f]
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    wanted = len(able) * percent // 100
    want = Counter((*r[:4], k) for k, r in enumerate(able[:wanted], 1))
    want.update((*r[:4], None) for r in able[wanted:] + [r for r in out if r[4] < least])
    return want


@pytest.mark.parametrize("percent, max_run, of, range_rows", [(10, 1, 10_000, 250_000), (60, 2, 97, 7), (100, 3, 10_000, 20), (0, 1, 10, 5)])
def test_resampling_by_brute_force(spark, percent, max_run, of, range_rows):
    rng = np.random.default_rng(of)
    words = [f"w{i}" for i in range(40)] + ["É", "日本", "x'y", "UPPER"]
    rows = [(int(rng.integers(80)), " ".join(rng.choice(words, rng.integers(0, 60)))) for _ in range(150)]
    rows += [rows[0]] * 60 + [(None, "a b c d e f g h i j k l m n o p q r s t u"), (None, None), (5, ""), (6, "\x00 \n"), (7, "word " * 30_000)]
    target = [" ".join(words[:9] * 5), None, "", "w1 w2"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = resampling.resample(documents(spark, rows), bench, percent, 20, max_run, of, range_rows=range_rows)
    assert Counter(tuple(r) for r in got.collect()) == plain_resampling(rows, target, percent, 20, max_run, of)


def test_resampling_without_rows_or_target(spark):
    bench = spark.createDataFrame([], "text string")
    assert resampling.resample(documents(spark, []), bench).collect() == []
    rows = [(i, f"{i} " * 25) for i in range(30)]
    assert Counter(tuple(r) for r in resampling.resample(documents(spark, rows), bench).collect()) == plain_resampling(rows, [], 10, 20, 1, 10_000)
