"""The training-data operators against brute force, round trips and held-out accuracy, and on awkward tables."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from lodestrand.llm import html_text, learning, mixture, pieces, quality_model, quality_rules, registry, sharding, simhash, tokenfile, topk, toxicity
from lodestrand.llm.scratch import new_path

DATA = "/root/testdata/sf0.001"
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [
    (1, "The cat sat on the mat. The dog did not.", "src0"), (2, "The cat sat on the mat. The dog did not.", "src0"), (3, None, "src1"), (4, "", None), (5, " \n\t ", "src1"),
    (6, "naïve café\nwörter. " * 3000, "src2"), (7, "one", "src2"), (7, "one", "src2"), (7, "two words", "src2"), (None, "nobody's text", "src0"), (None, None, None), (8, "a\x00b ▁ \U0001f600 <|endoftext|>", ""),
]


def table(spark, rows, more=True):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(i) for i, c in enumerate(["fp", "fp_", "row_id", "_place", "host", "shard", "id"])}) if more else df


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ SimHash


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().translate(simhash._LOWER).split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, radius):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    return root


def test_fingerprints():
    for t in [r[1] for r in AWKWARD] + ["A b\x1cc\xa0d e", "x y", "É É é"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


@pytest.mark.parametrize("seed", [0, 1])
def test_vantage_points_lose_no_link(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 150, dtype=np.int64)
    near = base[rng.integers(0, 150, 900)]
    for _ in range(3):
        near = near ^ (np.int64(1) << rng.integers(0, 63, len(near)))
    fps = np.unique(np.r_[base, near, np.arange(0, 400)])
    df = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, doc_id long")
    got = {r.fp: r.component_id for r in simhash.classes(df, shard_rows=60).collect()}
    root = plain_components([int(f) % 2**64 for f in fps], 2)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    assert got == {int(f): least[root[i]] for i, f in enumerate(fps)}


def test_near_duplicates_and_deduplicate(spark, awkward, none, docs):
    got = rows_of(simhash.near_duplicates(awkward))
    assert len(got) == len(AWKWARD)
    empty = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in empty} == {3} and len(empty) == 4
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    kept = simhash.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 6, 7, 7, 8, None])
    assert simhash.near_duplicates(none).count() == 0 and simhash.deduplicate(none).count() == 0
    got = rows_of(simhash.near_duplicates(docs))
    root = plain_components([int(r["fingerprint"], 16) for r in got], 2)
    least = {}
    for r, k in zip(got, root):
        least[k] = min(least.get(k, 10**9), r["doc_id"])
    assert all(r["component_id"] == least[k] for r, k in zip(got, root))
    assert simhash.deduplicate(docs).count() == len(least)


@pytest.mark.parametrize("block", [8192, 40])
def test_near_duplicate_stage_against_brute_force_jaccard(spark, awkward, none, block):
    rng = random.Random(6)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = [words(rng.randint(3, 300)) for _ in range(60)]
    for base in texts[:40]:
        for _ in range(4):  # copies that differ in some words or have lost their end
            t = [*base]
            for _ in range(rng.randint(0, max(1, len(t) // 40))):
                t[rng.randrange(len(t))] = "new%d" % rng.randrange(99)
            texts.append(t[: max(1, len(t) - rng.randint(0, len(t) // 8))])
    rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)]
    sets = [simhash.shingles(t) for _, t, _ in rows]
    root, similar = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                similar += sets[i] != sets[j]
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert similar > 50
    kept = simhash.drop_similar(table(spark, rows), block_rows=block)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))
    if block == 40:
        return
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), DATA).collect()) == sorted(set(root))
    kept = simhash.drop_similar(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 6, 7, 7, 8, None])
    assert simhash.drop_similar(none).count() == 0


# -------------------------------------------------------------------- top-k


def plain_top(rows, k=5):
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % 50 == 0:
            s = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v)))[:k]
            out |= {(q, n + 1, i, -x) for n, (x, i) in enumerate(s)}
    return out


def test_top_k(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(1, 700)] + [(i, [0.5] * 6) for i in range(1000, 1060)] + [(0, [1.0] * 6)]
    rows += [(50_000, None), (50_001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (50_050, [float("nan")] * 6), (50_003, [float("inf")] * 6), (50_100, [1.0, 2.0]), (50_004, [3.0, 1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("dim", F.lit("x"))
    for cell in (100_000, 120):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, cell_rows=cell, cell_queries=4)
        assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == plain_top(rows)
    assert topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0
    big = [(0, [1e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0]), (3, [1e300, 0.0])]  # scores beyond 2**53 are exact, those beyond a long are held at its end
    got = topk.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    exact = lambda v: 256 * 10**6 * 256 * 3 * 10**6 + 256 * 256 * v
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(3, 2**63 - 1), (2, exact(3)), (1, exact(2))]


def test_top_k_of_repeated_rows_equals_sql(spark):
    import duckdb

    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(-150, 250)]
    rows += [(7, [9.0] * 4)] * 5 + [(8, [8.0] * 4)] * 2 + [(7, [-9.0] * 4)]  # candidates stored several times, one id with two vectors
    rows += [(-3, [20.0, 0.0, 0.0, 0.0])]  # a negative id
    rows += [rows[150], rows[200], rows[200], (100, [0.5, -1.0, 2.0, 0.0])]  # query rows stored two and three times, a query id with two vectors
    few = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), *((i, [float(i), 1.0]) for i in range(1, 7))]
    for own, cell in ((rows, 100_000), (rows, 60), (rows[:3], 100_000), (few, 3), (few, 4)):
        df = spark.createDataFrame(own, "vec_id long, embedding array<double>")
        c = duckdb.connect()
        c.execute("create table embeddings (vec_id bigint, embedding double[])")
        c.executemany("insert into embeddings values (?, ?)", own)
        want = Counter(c.sql(registry.OP2_SQL).fetchall())
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, cell_rows=cell, cell_queries=4)
        assert Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == want


# --------------------------------------------------------------- token file


def test_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        a = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype("<u4")
        assert (tokenfile.unpack(tokenfile.pack(a)) == a).all()
        lengths, ranks = tokenfile.parse_raw(tokenfile.export_raw([n], tokenfile.pack(a)))
        assert list(lengths) == [n] and (ranks == a).all()


@pytest.mark.parametrize("block,ranges", [(10, 3), (1_000_000, 8192)])
def test_token_file(spark, awkward, none, block, ranges):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(awkward, path, BPE, block_ids=block, range_docs=ranges)
    got = rows_of(tokenfile.read_tokens(spark, path, digest=True))
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in AWKWARD]
    expected = Counter((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: -1 if d is None else d)
    full = {r.start: r.ids for r in tokenfile.read_tokens(spark, path).collect()}
    assert all(zlib.crc32(np.array(full[r["start"]], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(none, path, BPE)
    assert tokenfile.read_tokens(spark, path).count() == 0


def test_words_encode_as_whole_texts(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    texts = [r.text for r in docs.select("text").collect()] + ["it's We'LL don’t", "x́ é", "ÀÉ. ß?! Ab,c d'E", "１２ 3a", "\x85\xa0 a"]
    made = tokenfile.WordEncoder(BPE)(texts)
    assert [list(np.frombuffer(m, "<u4")) for m in made] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


# -------------------------------------------------------------- classifiers


def auc(scores, labels):
    r, y = np.argsort(np.argsort(scores)) + 1, np.array(labels)
    return (r[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("module,label,folds,out,least", [(quality_model, "quality", 5, 0, 0.95), (toxicity, "toxic", 4, 2, 0.95)])
def test_held_out_accuracy(spark, module, label, folds, out, least):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    own = docs.join(labels, "doc_id", "left_semi")
    got = module.score(own, module.train(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert auc([r.score for r in held], [r[label] for r in held]) > least


@pytest.mark.parametrize("module,label", [(quality_model, "quality"), (toxicity, "toxic")])
def test_classifiers_on_awkward_tables(spark, awkward, none, module, label):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (7, 1, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.where("false"), labels.where(f"{label} = 1")):
        model = module.train(awkward, given)
        got = rows_of(module.score(awkward, model))
        assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
        assert module.score(none, model).count() == 0


def test_sample_ignores_the_held_out_fold(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    sample, _ = learning.labelled_sample(docs, labels, "quality", 5, 0, 10_000, 10**9)
    held = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    rest = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    assert not {t for t, _ in sample} & (held - rest)


def test_offending_sentences(spark):
    model = toxicity.BagModel(-6.0, {"idiot": 9.0, "vequ~": 8.0})
    text = "All is well. You idiot! Nothing else\nVequiste aqui"
    found = [text[s:e] for s, e, _ in model.sentences(text)]
    assert found == ["You idiot", "Vequiste aqui"]
    p = [1 / (1 + np.exp(-z)) for z in (-6.0, 3.0, -6.0, 2.0)]
    noisy_or = 1 - np.prod([1 - x for x in p])
    assert -np.expm1(-np.exp(model.bag(text))) == pytest.approx(noisy_or)
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    assert [(r.start, r.end) for r in toxicity.offending(df, model).orderBy("start").collect()] == [(13, 22), (37, 50)]


# --------------------------------------------------------------------- html


def page(n, body, tail="</body></html>"):
    return f'<!DOCTYPE html><html><head><title>t{n}</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/{n}">menu {n}</a></li></ul></nav><div class="cookie-notice">We use cookies {n}</div><article><h1>Title {n}</h1>{body}<p>Sent from our newsroom</p></article><div id="comments"><p>nice {n}</p></div><aside>side {n}</aside><footer>foot {n}</footer>{tail}'


def test_main_text(spark):
    rows = [(n, f"http://a.example/{n}", page(n, f"<p>First&amp;second  {n}<br>line<p><b>bold {n}</b> end<ul><li>x{n}<li>y{n}</ul>", "" if n % 3 else "</body></html>")) for n in range(20)]
    rows += [(100, "http://b.example/", page(100, "<p>alone</p>")), (101, None, None), (102, "not a url %%", ""), (103, "http://c.example/", "plain & simple"), (100, "http://b.example/", page(100, "<p>alone</p>"))]
    got = rows_of(html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(3))))
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    for n in range(20):  # the line that all articles share is text of the article
        assert by[n] == f"Title {n}\nFirst&second {n} line\nbold {n} end\nx{n}\ny{n}\nSent from our newsroom"
    assert by[100] == "Title 100\nalone\nSent from our newsroom" and by[101] == by[102] == "" and by[103] == "plain & simple"
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ------------------------------------------------------------------- pieces


def test_n_best_by_brute_force():
    p, rng = pieces.Pieces(PIECES), random.Random(2)

    def every(w):
        return [(0.0, [])] if not w else [(s + x, i + ([k] if k >= 0 else p.spell(w[a:]))) for a, x, k in p.edges(w, len(w)) for s, i in every(w[:a])]

    for _ in range(150):
        text = "".join(rng.choice("théing. \n日") for _ in range(rng.randint(1, 8)))
        word = "▁" + text.replace(" ", "▁")
        best = sorted((s for s, _ in every(word)), reverse=True)
        found = p.n_best(word, 5)
        assert [s for s, _ in found] == best[:5] and len({tuple(i) for _, i in found}) == len(found)
        ids, scores = p.encode(text, 5)
        assert scores == pytest.approx(best[:5]) and p.decode(np.frombuffer(ids, "<u4")) == text


def test_pieces_round_trip(spark, awkward, none, docs):
    for df in (awkward, docs):
        got = rows_of(pieces.round_trip(df, PIECES))
        assert len(got) == df.count()
        marked = {r.doc_id for r in df.where(F.col("text").contains("▁")).collect()}
        assert all(r["text_crc32"] == r["decoded_crc32"] for r in got if r["doc_id"] not in marked)
    back = pieces.decode(pieces.encode(docs, PIECES), PIECES)
    assert back.join(docs.select("doc_id", F.col("text").alias("was")), "doc_id").where("text <> was").count() == 0
    assert pieces.encode(none, PIECES).count() == 0


def test_ids_of_all_n_segmentations(spark, awkward):
    p, rng = pieces.Pieces(PIECES), random.Random(3)

    def every(w):
        return [(0.0, [])] if not w else [(s + x, i + ([k] if k >= 0 else p.spell(w[a:]))) for a, x, k in p.edges(w, len(w)) for s, i in every(w[:a])]

    for _ in range(100):
        text = "".join(rng.choice("théing. \n日") for _ in range(rng.randint(1, 8)))
        score = {tuple(i): s for s, i in every("▁" + text.replace(" ", "▁"))}
        made, scores = p.encode_all(text, 5)
        ids = [tuple(np.frombuffer(m, "<u4").tolist()) for m in made]
        assert len(set(ids)) == len(ids) == len(scores) == min(5, len(score))
        assert [score[i] for i in ids] == pytest.approx(scores) and scores == pytest.approx(sorted(score.values(), reverse=True)[:5])
        assert all(p.decode([*i]) == text for i in ids)
        for w in p.chain("▁" + text.replace(" ", "▁")):  # one path for the cached ids and for the search
            assert p._word(w)[2] == np.array(p.n_best(w, 4)[0][1], "<u4").tobytes()
    text = "the thing is the thing that things are the things there " * 5
    assert p.encode_all(text)[1] == pytest.approx([s for s, _ in p.encode_n(text)])
    coded = {(r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes())): r for r in pieces.encode(awkward, PIECES).collect()}
    for r in pieces.round_trip(awkward, PIECES).collect():
        own = coded[r.doc_id, r.ids_crc32]
        assert own.ids == own.n_best_ids[0] and len(own.n_best_ids) == len(own.scores) == len(r.n_best_scores)
        assert [zlib.crc32(np.array(i, "<u4").tobytes()) for i in own.n_best_ids] == r.n_best_crc32


# ------------------------------------------------------------------ mixture


def test_targets():
    assert mixture.targets([100, 100, 100, 100]) == pytest.approx([400 * w / 13 for w in (5, 2, 1, 5)])
    got = mixture.targets([10, 1000, 0])
    assert got[0] == 30 and got[2] == 0 and sum(got) == pytest.approx(1010)
    assert mixture.targets([]) == [] and mixture.targets([0, 0]) == [0, 0]


def test_split_quotas():
    got = mixture.split_quotas([7, 0, 31, 500], 9)
    assert got.sum(0).tolist() == [7, 0, 31, 500] and (got >= 0).all()
    assert got.sum(1).max() - got.sum(1).min() <= 9
    assert (got == mixture.split_quotas([7, 0, 31, 500], 9)).all()


def test_mixture(spark, awkward, none, docs):
    for df in (awkward, docs):
        got = rows_of(mixture.mixture(df, block_words=50))
        assert len(got) == df.count()
        assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r.doc_id, len((r.text or "").encode().split())) for r in df.collect())
        taken = Counter()
        for r in got:
            assert r["taken"] <= 3 * r["size"]
            taken[r["source"]] += r["taken"]
        longest = Counter()
        for r in got:
            longest[r["source"]] = max(longest[r["source"]], r["size"])
            assert r["size"] == 0 or r["taken"] % r["size"] == 0  # documents are taken whole
        assert all(abs(taken[r["source"]] - r["target"]) <= 1 + longest[r["source"]] / 2 for r in got)
        key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], r["shards"])
        assert sorted(map(key, got)) == sorted(map(key, rows_of(mixture.mixture(df.repartition(3), block_words=50))))
        out = mixture.mix(df, block_words=50)
        assert out.columns == df.columns
        assert sum(len((r.text or "").encode().split()) for r in out.collect()) == sum(r["taken"] for r in got)
    assert mixture.mixture(none).count() == 0 and mixture.mix(none).count() == 0


# -------------------------------------------------------------------- rules


def plain_measure(text):
    text = text or ""
    words, at = [], None
    for i, c in enumerate(text + " "):
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            if at is not None:
                words.append(text[at:i])
            at = None
        elif at is None:
            at = i
    n = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if n[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if any(c not in "\x20\x09\x0a\x0b\x0c\x0d" for c in x)]
    return sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(words)


def test_quality_rules(spark, awkward, none, docs):
    texts = [r[1] for r in AWKWARD] + [r.text for r in docs.collect()] + ["a b c a b c", "x\x1cy z"]
    for t in texts:
        got, want = quality_rules.measure(t), plain_measure(t)
        assert got[:5] == want
        assert got[5] == (want[4] < 50 or 100 * want[3] > 50 * want[4])
    assert [quality_rules.line_fails(x) for x in ("A plain line of text.", "home | news | sport | more", "BUY!! NOW!! CHEAP!!", "All rights reserved.", "--- ***")] == [False, True, True, True, True]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    assert judged.where("quality = 1 and not base_failed and not kept").count() == 0
    assert judged.where("quality = 0 and kept").count() == 0
    assert quality_rules.judge(awkward).count() == len(AWKWARD) and quality_rules.judge(none).count() == 0
    cleaned = quality_rules.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == quality_rules.judge(docs).where("kept").count()
    assert cleaned.where("n_chars <> length(text)").count() == 0


# ----------------------------------------------------------------- sharding


def test_sharding(spark, awkward, none, docs):
    for df in (awkward, docs):
        got = rows_of(sharding.shard_rows(df, range_rows=16))
        n = df.count()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect())
        by = {}
        for r in got:
            by.setdefault(r["shard"], []).append(r)
        sizes = [len(by.get(s, [])) for s in range(40)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
        assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by.values())
        for source in {r["source"] for r in got}:
            of = [sum(r["source"] == source for r in by.get(s, [])) for s in range(40)]
            assert max(of) - min(of) <= 2
    assert sharding.shard_rows(none).count() == 0


# ----------------------------------------------------------------- pipeline


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, DATA).cache()
    model = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    low = {r.doc_id for r in toxicity.score(docs, model).where("score < 0.3").collect()}
    assert {r.doc_id for r in clean.collect()} == low
    ruled = stages["quality rules"](spark, clean, DATA).cache()
    assert {r.doc_id for r in ruled.collect()} == {r.doc_id for r in quality_rules.judge(clean).where("kept").collect()}
    single = stages["near-duplicates"](spark, ruled, DATA).cache()
    sets = {r.doc_id: simhash.shingles(r.text) for r in ruled.collect()}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    assert {r.doc_id for r in single.collect()} == set(root.values())
    mixed = stages["mixing"](spark, single, DATA).cache()
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: len([s for s in r.shards if s is not None]) for r in mixture.mixture(single).collect() if r.shards})
    for df in (clean, ruled, single, mixed):
        assert df.columns == docs.columns
    coded = stages["sentencepiece"](spark, mixed, DATA)
    assert Counter((r.doc_id, r.text) for r in pieces.decode(coded, PIECES).collect()) == Counter((r.doc_id, r.text) for r in mixed.collect())
    assert corpus_pipeline.run(spark, DATA).count() == mixed.count()


def test_queries_keep_their_contracts(spark):
    columns = {
        "op1": ["doc_id", "fingerprint", "component_id"], "op2": ["query_id", "rank", "vec_id", "score"], "op3": ["doc_id", "start", "n_tokens", "ids_crc32"], "op4": ["doc_id", "held_out", "score", "predicted"],
        "op5": ["doc_id", "held_out", "score", "predicted"], "op6": ["page_id", "url", "text", "n_chars"], "op8": ["doc_id", "size", "source_size", "target", "taken"],
        "op9": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"], "op10": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op11": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"], "op12": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], "op13": ["doc_id", "n_features", "weight", "score", "rank"],
    }
    found = registry.queries()
    assert sorted(found) == sorted(n for n in found if n.split("_")[0] in {*columns, "op7"}) and len(found) == 13
    for name, f in found.items():
        df = f(spark, DATA)
        for c in columns.get(name.split("_")[0], []):
            assert c in df.columns
        kinds = {f.name: f.dataType for f in df.schema}
        assert all(kinds[c] == T.LongType() for c in kinds if c in ("doc_id", "n_tokens", "start", "taken", "size", "slot", "text_crc32", "ids_crc32", "n_words", "score", "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score", "n_email", "n_ip", "n_card", "n_phone", "n_features", "weight") and not (c == "score" and name[:3] in ("op4", "op5")))
