"""Sequences in which every k-mer of the input stands once: k-mers joined into chains, within buckets first, then by list ranking.

A k-mer on either strand is a node.  Two nodes are linked where one ends and
the other begins with the same k - 1 bases (a joint) and no other k-mer does
either.  A joint belongs to the bucket of its least word (by a hash, of either
strand), and k-mers are shuffled once, to the buckets of their two joints, which
mostly are one; so a bucket knows all links of its joints and joins its nodes
into stretches, which leave it as letters.  Stretches follow each other where
the last node of one is the first of the other; their chains and places come by
pointer doubling: each round joins a stretch with the one its pointer shows and
doubles the distance, as often as the logarithm of the longest chain of
stretches; what has reached a head leaves the rounds.  What is left after all
chains are done are circles, which are ranked by nodes and cut before their
smallest k-mer.  Of a chain and its complement one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.functions import codes
from lodestrand.operators.work import discard, keep, settled

#: k-mers that a bucket has on average.
BUCKET = 250_000
#: Longest word by which joints are dealt to buckets.
WORD = 10


def _ends(node: Column, k: int) -> tuple[Column, Column]:
    """(first, last) k - 1 bases of a node (twice its code, plus one for the strand of the code), as codes."""
    code = F.shiftright(node, 1)
    read = F.when(node.bitwiseAND(F.lit(1)) == 1, code).otherwise(codes.complement(code, k))
    return F.shiftright(read, 2), read.bitwiseAND(F.lit(4 ** (k - 1) - 1))


def _other_strand(node: Column) -> Column:
    return node.bitwiseXOR(F.lit(1).cast("long"))


def _complements(code: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(code)
    for i in range(k):
        out = out << 2 | 3 - (code >> 2 * i & 3)
    return out


def _buckets(code: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (0 to n - 1) of the first and the last k - 1 bases of codes, the same for either strand of these bases."""
    m = min(WORD, k // 2)
    back, low = _complements(code, k), 4**m - 1
    ranks = []
    for i in range(k - m + 1):  # the word at place i, and its complement
        word = np.maximum(code >> 2 * (k - m - i) & low, back >> 2 * i & low).astype(np.uint64)
        # a mixed word, and the word itself, so that different words never tie
        ranks.append((word * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) << np.uint64(2 * m) | word)
    inner = np.minimum.reduce(ranks[1:-1]) if len(ranks) > 2 else np.full(len(code), 2**63, np.uint64)
    deal = lambda r: ((r & np.uint64(low)) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)).astype(np.int64) % n
    return deal(np.minimum(inner, ranks[0])), deal(np.minimum(inner, ranks[-1]))


def _dealt(kmers: DataFrame, k: int, n: int) -> DataFrame:
    """bucket and kmer: each k-mer in the buckets of its two joints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = b.column(0).to_numpy()
            first, last = _buckets(code, k, n)
            two = first != last
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[first, last[two]]), pa.array(np.r_[code, code[two]])], names=["bucket", "kmer"])

    return kmers.select("kmer").mapInArrow(run, "bucket long, kmer long")


def _stretches(dealt: DataFrame, k: int, n: int) -> DataFrame:
    """at, done, low, text, node and place: the nodes of each bucket in stretches by the links of its joints.

    ``at`` is the node that a stretch begins with.  If no node is linked before it, the stretch is ``done`` and text has all its bases; else its
    first joint belongs to another bucket (or the stretch is a circle, from ``at`` to ``at``), where ``at`` itself is told, and text has one base for
    each node behind it.  ``low`` is the least node of those told, ``node`` the last one, ``place`` places behind ``at``, if its last joint belongs
    to another bucket.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        code = np.unique(table.column("kmer").to_numpy())
        first, last = _buckets(code, k, n)
        back = _complements(code, k)
        # node 2 i + 1 is code i as it is, 2 i its complement
        read = np.stack([back, code], 1).reshape(-1)
        node = np.stack([code << 1, code << 1 | 1], 1).reshape(-1)
        own_first = np.stack([last == bucket, first == bucket], 1).reshape(-1)
        own_last = np.stack([first == bucket, last == bucket], 1).reshape(-1)
        behind, before = np.flatnonzero(own_first), np.flatnonzero(own_last)
        joint_b, at_b, n_b = np.unique(read[behind] >> 2, return_index=True, return_counts=True)
        joint_a, at_a, n_a = np.unique(read[before] & 4 ** (k - 1) - 1, return_index=True, return_counts=True)
        _, x, y = np.intersect1d(joint_b, joint_a, assume_unique=True, return_indices=True)
        x, y = behind[at_b[x]][one := (n_b[x] == 1) & (n_a[y] == 1)], before[at_a[y]][one]
        apart = x >> 1 != y >> 1  # a k-mer is not followed by itself, on either strand
        back_to = np.arange(len(read))
        back_to[x[apart]] = y[apart]
        linked = back_to != np.arange(len(read))
        head, place = back_to.copy(), linked.astype(np.int64)
        for _ in range(int(len(read)).bit_length()):
            if not linked[head].any():
                break
            place = place + place[head]
            head = head[head]
        rings = np.flatnonzero(linked[head])
        if len(rings):
            # each circle from its first node on; the first one stands last
            follow = np.full(len(read), -1)
            follow[back_to[rings]] = rings
            seen = np.zeros(len(read), bool)
            for start in rings.tolist():
                if not seen[start]:
                    one, steps = int(follow[start]), 1
                    while True:
                        head[one], place[one], seen[one] = start, steps, True
                        if one == start:
                            break
                        one, steps = int(follow[one]), steps + 1
        told = np.flatnonzero(own_first)
        order = told[np.lexsort((place[told], head[told]))]
        cuts = np.flatnonzero(np.r_[True, head[order][1:] != head[order][:-1]]) if len(order) else np.zeros(0, np.int64)
        ends = np.r_[cuts[1:], len(order)] - 1 if len(order) else cuts
        start, stop = head[order[cuts]], order[ends]
        done = own_first[start] & ~linked[start]
        letters = codes._LETTERS[read[order] & 3].tobytes().decode()
        heads = codes._LETTERS[read[start][:, None] >> 2 * np.arange(k - 1, 0, -1) & 3]
        text = [(heads[i].tobytes().decode() if d else "") + letters[c : e + 1] for i, (c, e, d) in enumerate(zip(cuts.tolist(), ends.tolist(), done.tolist()))]
        low = np.minimum.reduceat(node[order], cuts) if len(order) else node[:0]
        ring = linked[start] & own_first[start]
        edge = ~own_last[stop] | ring
        return pa.table({"at": node[start], "done": done, "low": low, "text": pa.array(text, pa.string()), "node": pa.array(node[stop], mask=~edge), "place": place[stop]})

    return dealt.groupBy("bucket").applyInArrow(run, "at long, done boolean, low long, text string, node long, place long")


def _unrolled(stretches: DataFrame, k: int) -> DataFrame:
    """node and before of all nodes that stretches(at, text), which are not done, tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                first = np.array([at >> 1])
                held = (first if at & 1 else _complements(first, k))[0]
                whole = codes._LETTERS[held >> 2 * np.arange(k - 1, -1, -1) & 3].tobytes() + text.encode()
                node = codes.stranded_codes(np.frombuffer(whole, np.uint8), k)[1]
                yield pa.RecordBatch.from_arrays([pa.array(node[1:]), pa.array(node[:-1])], names=["node", "before"])

    return stretches.select("at", "text").mapInArrow(run, "node long, before long")


def ranked(nodes: DataFrame, before: DataFrame) -> DataFrame:
    """node, head and place (from 0) of nodes(node) in the chains of before(node, before); circles are cut before their smallest node by code, on both strands."""
    done, circled = _followed(nodes.join(before, "node", "left").select("node", F.coalesce("before", "node").alias("at"), F.col("before").isNotNull().cast("long").alias("place"), F.col("before").isNull().alias("done")))
    return done if circled is None else done.unionByName(_circles(circled.select("node"), before))


def _followed(pointers: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, head and place; the nodes of circles, if any) of pointers(node, at, place, done): at stands so many places before node, and is a head where done."""
    now = keep(pointers, "chains")
    open_ = now.where("not done").count()
    while open_:
        shown = now.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("place").alias("_place"), F.col("done").alias("_done"))
        moved = now.where("not done").join(shown, "at").select("node", F.col("_at").alias("at"), (F.col("place") + F.col("_place")).alias("place"), F.col("_done").alias("done"))
        new, was = keep(now.where("done").unionByName(moved), "chains"), open_
        discard(now)
        now = new
        open_ = now.where("not done").count()
        if open_ == was:
            # a round without a new arrival: pointers have gone around, all that is open are circles
            break
    return now.where("done").select("node", F.col("at").alias("head"), "place"), now.where("not done") if open_ else None


def _circles(nodes: DataFrame, before: DataFrame) -> DataFrame:
    """As ranked, of nodes that all stand in circles: the least code is passed around by doubling until nothing changes, then the link before its nodes is cut."""
    held = keep(nodes.join(before, "node").select("node", F.col("before").alias("at"), F.least("node", "before").alias("least")), "circles")
    while True:
        shown = held.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("least").alias("_least"))
        new = keep(held.drop("moved").join(shown, "at").select("node", F.col("_at").alias("at"), F.least("least", "_least").alias("least"), (F.col("_least") < F.col("least")).alias("moved")), "circles")
        discard(held)
        held = new
        if held.where("moved").isEmpty():
            break
    cut = before.join(held.select("node", "least"), "node").where("node <> least").select("node", "before")
    return ranked(nodes, cut)


def compressed(seqs: DataFrame, k: int = 21, least: int = 1, most: int | None = None) -> DataFrame:
    """name (the smallest k-mer's code of a chain) and seq: sequences that hold each k-mer of seqs(seq) once, on one strand or the other, of those counted ``least`` to ``most`` times; k is odd, up to 29."""
    if k % 2 == 0 or not 3 <= k <= 29:
        raise ValueError("k is odd, 3 to 29")
    counted = codes.counted(seqs, k).groupBy("kmer").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    if most is not None:
        counted = counted.where(F.col("n") <= most)

    def joined() -> DataFrame:
        kmers = keep(counted.select("kmer"), "kmers")
        n = max(1, kmers.count() // BUCKET)
        held = keep(_stretches(_dealt(kmers, k, n), k, n), "stretches")
        placed, circled = _followed(held.where("node is not null").select("node", "at", "place", "done"))
        begun = held.where("done").select(F.col("at").alias("head"), F.lit(0).cast("long").alias("place"), "low", "text")
        later = held.where("not done").select("at", "low", "text").join(placed.withColumnRenamed("node", "at"), "at").select("head", (F.col("place") + 1).alias("place"), "low", "text")
        told = begun.unionByName(later)
        if circled is not None:
            links = keep(_unrolled(held.where("not done").join(circled.select(F.col("node").alias("at")), "at", "left_semi"), k), "links")
            code = F.shiftright("node", 1)
            bases = codes.letters(F.when(F.col("node").bitwiseAND(F.lit(1)) == 1, code).otherwise(codes.complement(code, k)), k)
            text = F.when(F.col("place") == 0, bases).otherwise(F.right(bases, F.lit(1)))
            told = told.unionByName(_circles(links.select("node"), links).select("head", "place", F.col("node").alias("low"), text.alias("text")))
        # of a chain and its complement, the one in which the smallest k-mer stands as its code
        chosen = told.groupBy("head").agg(F.min("low").alias("_low"), F.array_sort(F.collect_list(F.struct("place", "text"))).alias("_own")).where(F.col("_low").bitwiseAND(F.lit(1)) == 1)
        return chosen.select(F.shiftright("_low", 1).alias("name"), F.array_join(F.transform("_own", lambda x: x["text"]), "").alias("seq"))

    return settled(joined, "chains")
