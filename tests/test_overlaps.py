"""Overlaps and containments with mismatches against plain comparison of all pairs."""

import random

import pytest

from lodestrand.operators import depths, overlaps


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def plain_edges(rows, k, least, most):
    kept = {}
    for n, s in rows:
        key = max(s, turned(s))
        if len(s) >= max(least, k) and (key not in kept or n < kept[key][0]):
            kept[key] = (n, s)
    seqs, out = sorted(kept.values()), set()
    for x, (a, s) in enumerate(seqs):
        for b, t in seqs[x + 1 :]:
            for reverse, u in ((False, s), (True, turned(s))):
                for o in range(-len(u) + 1, len(t)):
                    start, stop = max(o, 0), min(o + len(u), len(t))
                    n = stop - start
                    if n < least:
                        continue
                    mine, theirs = u[start - o : stop - o], t[start:stop]
                    # an end of k bases of one of the two within the common stretch, intact
                    ends = [p for p in (0, len(u) - k) if start <= o + p and o + p + k <= stop] and [o + p for p in (0, len(u) - k) if start <= o + p and o + p + k <= stop]
                    ends += [p for p in (0, len(t) - k) if start <= p and p + k <= stop]
                    if not any(mine[p - start : p - start + k] == theirs[p - start : p - start + k] for p in ends):
                        continue
                    bad = sum(p != q for p, q in zip(mine, theirs))
                    if bad <= most:
                        kind = "inner" if o >= 0 and o + len(u) <= len(t) else "outer" if o <= 0 and o + len(u) >= len(t) else "end"
                        out.add((a, b, reverse, o, n, bad, kind))
    return seqs, out


def tiles(seed, n):
    """Pieces of a genome, on both strands, some with changed bases, some within others, some equal."""
    rng = random.Random(seed)
    genome = "".join(rng.choices("ACGT", k=500))
    rows = []
    for i in range(n):
        at = rng.randrange(0, 420)
        s = list(genome[at : at + rng.randrange(20, 80)])
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            s[rng.randrange(len(s))] = rng.choice("ACGT")
        s = "".join(s)
        rows.append((i * 7 % 101, turned(s) if rng.random() < 0.5 else s))
    rows += [(200, rows[0][1]), (201, turned(rows[1][1])), (202, rows[2][1].lower()), (203, ""), (204, "ACG")]
    return rows


@pytest.mark.parametrize("seed, k, least, most", [(1, 11, 15, 0), (2, 11, 15, 2), (3, 7, 20, 3)])
def test_edges_and_containments(spark, seed, k, least, most):
    rows = tiles(seed, 40)
    df = spark.createDataFrame(rows + [(205, None)], "name long, seq string")
    seqs, want = plain_edges([(n, s.upper()) for n, s in rows], k, least, most)
    assert want and {tuple(r) for r in overlaps.edges(df, k, least, most).collect()} == want
    size = {n: len(s) for n, s in seqs}
    inside = {a for a, b, _, o, n, _, kind in want if n == size[a] and (size[b] > size[a])} | {b for a, b, _, o, n, _, _ in want if n == size[b] and (size[a] > size[b] or size[a] == size[b])}
    # a held sequence must have an end of its own intact, not one of the holder's: check by itself
    got = {r.name for r in overlaps.contained(df, least, k, most).collect()}
    assert {n for n, _ in seqs} - inside <= got
    for n in {n for n, _ in seqs} - got:
        assert n in inside


def test_exact_containments_are_all_found(spark):
    rows = tiles(9, 60)
    df = spark.createDataFrame(rows, "name long, seq string")
    seqs, _ = plain_edges([(n, s.upper()) for n, s in rows], 11, 15, 0)
    want = {n for n, s in seqs if not any(m != n and (len(t) > len(s) or m < n) and (s in t or turned(s) in t) for m, t in seqs)}
    assert {r.name for r in overlaps.contained(df, 15, 11).collect()} == want


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = "".join(rng.choices("ACGT", k=120))
    rows = []
    for i in range(300):
        s = list(base)
        s[rng.randrange(40, 80)] = rng.choice("ACGT")
        rows.append((i, "".join(s)))
    rows.append((999, "ACGT" * 5 + base + "TTGCA"))
    assert [r.name for r in overlaps.contained(spark.createDataFrame(rows, "name long, seq string"), mismatches=2).collect()] == [999]


def test_no_sequences(spark):
    none = spark.createDataFrame([], "name long, seq string")
    assert overlaps.edges(none).count() == 0 and overlaps.contained(none).count() == 0
    with pytest.raises(ValueError, match="odd"):
        overlaps.contained(none, k=30)


def test_runs_of_one_letter_are_searched_not_joined(spark):
    """Ends within long runs of one letter: as plain comparison, and a pair is met once, not once for each place."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("ACGT", k=n))
    rows = [(i, word(20) + "A" * (30 + i)) for i in range(6)] + [(10 + i, "A" * (25 + i) + word(20)) for i in range(6)]
    rows += [(20, "T" * 40 + word(10)), (21, "A" * 50), (22, word(10) + "A" * 60 + word(10)), (23, word(15) + "N" * 12 + "A" * 20)]
    seqs, edges = plain_edges(rows, 11, 15, 0)
    df = spark.createDataFrame(rows, "name long, seq string")
    assert {tuple(r) for r in overlaps.edges(df, 11, 15).collect()} == edges
    met = overlaps._meeting(overlaps._different(df, 15), 11)
    assert met.count() == met.distinct().count() <= len(rows) * (len(rows) - 1)
    # an end in a run that the other sequence has inside only is no reason to meet
    assert not met.where("a < 6 and b = 22 and not reverse").count()
    plain = sorted(a for a, s in seqs if not any(b != a and len(t) > len(s) and (s in t or turned(s) in t) for b, t in seqs))
    assert sorted(r.name for r in overlaps.contained(df, 15, 11).collect()) == plain


@pytest.mark.parametrize("k", [5, 33])
def test_clusters_by_words_as_numbers(spark, k):
    """As a plain walk over shared ends; runs of unknown bases link nothing where words are numbers."""
    rng = random.Random(k)
    genome = "".join(rng.choices("ACGT", k=600))
    rows = [(i, (lambda s: turned(s) if i % 2 else s)(genome[at : at + k + 20])) for i, at in enumerate(rng.randrange(0, 540) for _ in range(20))]
    words = lambda s: {max(s[i : i + k], turned(s[i : i + k])) for i in range(len(s) - k + 1)}
    own = {n: words(s) for n, s in rows}
    tips = {n: words(s[:k]) | words(s[-k:]) for n, s in rows}
    root = {n: n for n, _ in rows}
    for _ in rows:
        root = {a: min(root[b] for b in own if tips[a] & own[b] or tips[b] & own[a]) for a in own}
    unknown = [(50, "N" * (k + 3)), (51, "N" * (k + 4))] if k <= 31 else []
    got = {r.name: r.cluster for r in depths.clusters(spark.createDataFrame(rows + unknown, "name long, seq string"), k).collect()}
    assert got == root | {n: n for n, _ in unknown}


@pytest.mark.parametrize("block, blocks", [(2, 3), (1, 100), (256, 32)])
def test_pairs_meet_in_cells_with_their_bases(spark, monkeypatch, block, blocks):
    """Many ends and holders of one k-mer in small cells: every stretch once, as plain comparison; a row goes to a bounded number of cells, and no pair is shuffled."""
    monkeypatch.setattr(overlaps, "BLOCK", block)
    monkeypatch.setattr(overlaps, "BLOCKS", blocks)
    rng = random.Random(7)
    word = lambda n: "".join(rng.choices("ACGT", k=n))
    shared = word(14)
    rows = [(i, word(rng.randrange(3, 20)) + shared) for i in range(8)] + [(20 + i, shared + word(rng.randrange(3, 20))) for i in range(8)] + [(40 + i, "R" + word(9) + turned(shared) + word(9)) for i in range(4)]
    rows += [(60, rows[0][1] + "TTT"), (61, turned(rows[9][1] + "GAG")), (62, "A" * 40), (63, "A" * 31 + "C" * 20), (64, "C" * 25 + "G" * 25)]
    df = spark.createDataFrame(rows, "name long, seq string")
    seqs, edges = plain_edges(rows, 11, 12, 0)
    found = [tuple(r) for r in overlaps.edges(df, 11, 12).collect()]
    assert len(found) == len(set(found)) and set(found) == edges and len(edges) > 60
    plain = sorted(a for a, s in seqs if not any(b != a and len(t) > len(s) and (s in t or turned(s) in t) for b, t in seqs))
    assert sorted(r.name for r in overlaps.contained(df, 12, 11).collect()) == plain
    plan = overlaps._exact(overlaps._different(df, 12), 11, 12)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan[: plan.index("MapInArrow")] and "Exchange" not in plan[: plan.index("MapInArrow")]
