"""Overlaps and containments of sequences, with mismatches.

Seeds are the ends of sequences: where the first or the last k bases of one
stand intact in another, on either strand, they say at which offset the two
would lie on each other.  Only names, places and strands are joined; the bases
of a candidate are fetched for the common stretch alone and compared in batches
of numpy.  Sequences that are equal on either strand are one sequence before
anything is joined.  For containments a first pass tries the FIRST_TRIES longest holders
of each seed, so a large group of near copies costs a few rows a sequence; the
second takes all other holders, for those that no longer one was found for
(with mismatches; without them the longest come first in each cell).

Without mismatches a common stretch holds two ends, one on each side: both of a
sequence that lies within another, or one of each.  Two sequences then meet
under the rarer of the two, in a cell of its own to which both bring their
bases, so that neither pairs nor bases of pairs are shuffled; their stretches
are found there by searching one in the other, and each stretch is given under
one end alone.  Places in runs of one letter, where an end stands hundreds of
times, are never joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrand.functions import codes
from lodestrand.functions import seq as S
from lodestrand.operators.work import keep, settled, tasks

FIRST_TRIES = 4
#: So many ends and holders of one k-mer meet in a cell, or a BLOCKS-th part of them where that is more, so that no row goes to more than BLOCKS cells.
BLOCK, BLOCKS = 256, 32
_COMPLEMENT = str.maketrans("ACGTUMRYKVHDB", "TGCAAKYRMBDHV")  # of capitals, as S.reverse_complement


def _differing(mine: str, theirs: str) -> int:
    a, b = mine.encode(), theirs.encode()
    return 0 if a == b else int((np.frombuffer(a, np.uint8) != np.frombuffer(b, np.uint8)).sum())


def _verified(pairs: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    """pairs(a, b, reverse, offset, start, length) with ``mismatches``, of those with ``most`` of them or fewer; start is where the common stretch begins in b."""
    a = rows.select(F.col("name").alias("a"), F.col("seq").alias("_a"))
    b = rows.select(F.col("name").alias("b"), F.col("seq").alias("_b"))
    turned = F.when(F.col("reverse"), S.reverse_complement(F.col("_a"))).otherwise(F.col("_a"))
    mine = pairs.join(a, "a").withColumn("_a", F.substr(turned, F.col("start") - F.col("offset") + 1, F.col("length")))
    both = mine.join(b, "b").withColumn("_b", F.substr("_b", F.col("start") + 1, F.col("length")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_a", "_b"))
            n = np.array([_differing(p, q) for p, q in zip(x, y)], np.int32)
            kept = batch.drop_columns(["_a", "_b"]).append_column("mismatches", pa.array(n))
            yield kept.filter(pa.array(n <= most))

    return both.mapInArrow(compare, both.drop("_a", "_b").schema.add("mismatches", "integer"))


def _offset() -> Column:
    """Where a, turned if need be, begins in b, by a's tip at ``at`` and b's k-mer at ``pos``."""
    return F.when(F.col("reverse"), F.col("pos") - (F.col("size") - F.col("at") - F.col("_k"))).otherwise(F.col("pos") - F.col("at"))


def _tips(rows: DataFrame, k: int) -> DataFrame:
    sizes = rows.select(F.col("name").alias("a"), F.length("seq").alias("size"))
    return codes.places(rows, k, ends=True).select(F.col("name").alias("a"), F.col("pos").alias("at"), "kmer", F.col("forward").alias("_af")).distinct().join(sizes, "a").withColumn("_k", F.lit(k))


def _holders(rows: DataFrame, tips: DataFrame, k: int) -> DataFrame:
    sizes = rows.select(F.col("name").alias("b"), F.length("seq").alias("room"))
    return codes.places(rows, k).withColumnRenamed("name", "b").join(tips.select("kmer").distinct(), "kmer", "left_semi").join(sizes, "b")


def _met(tips: DataFrame, holders: DataFrame) -> DataFrame:
    return tips.join(holders, "kmer").where("a <> b").withColumn("reverse", F.col("_af") != F.col("forward")).withColumn("offset", _offset())


def _rarity(holders: DataFrame) -> DataFrame:
    """kmer and n: in how many sequences, and on how many of their strands, each k-mer of holders(kmer, b, forward) stands."""
    return holders.groupBy("kmer").agg(F.count("*").alias("n"))


def _ends(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Ends (a, first, last, kmer, _af, size and n: in how many sequences they stand) of rows(name, seq), and what holds them (kmer, b, forward, room)."""
    tips = _tips(rows, k).withColumns({"first": F.col("at") == 0, "last": F.col("at") == F.col("size") - k})
    holders = keep(_holders(rows, tips, k).select("kmer", "b", "forward", "room").distinct(), "holders")
    return keep(tips.join(_rarity(holders), "kmer").select("a", "first", "last", "kmer", "_af", "size", "n"), "tips"), holders


def _meeting(rows: DataFrame, k: int) -> DataFrame:
    """a, b and reverse of the pairs (a < b) of rows(name, seq) that may have a common stretch without mismatches."""
    tips, holders = _ends(rows, k)
    own = tips.groupBy("a").agg(F.min(F.struct("n", "last")).alias("_least"), F.min(F.when(F.col("first"), F.col("n"))).alias("_n_first"), F.min(F.when(F.col("last"), F.col("n"))).alias("_n_last"))
    met = tips.join(own.select("a", "_least"), "a").join(holders.join(own.select(F.col("a").alias("b"), "_n_first", "_n_last"), "b", "left"), "kmer").where("a <> b").withColumn("reverse", F.col("_af") != F.col("forward"))
    # a within b holds both ends of a: they meet under the rarer one
    inside = (F.col("room") > F.col("size")) & (F.struct("n", "last") == F.col("_least"))
    # else a stretch that ends a begins b, or ends it if reversed: they meet under the rarer of these two ends (one that is no k-mer of A, C, G and T is none)
    begins, ends = F.coalesce("_n_first", F.col("n")) >= F.col("n"), F.coalesce("_n_last", F.col("n")) >= F.col("n")
    beyond = F.col("last") & F.when(F.col("reverse"), ends).otherwise(begins) | F.col("first") & F.when(F.col("reverse"), begins).otherwise(ends)
    return met.where(inside | beyond).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "reverse").distinct()


def _all_places(part: str, whole: str) -> Iterator[int]:
    at = whole.find(part)
    while at >= 0:
        yield at
        at = whole.find(part, at + 1)


def _cells(tips: DataFrame, holders: DataFrame, rows: DataFrame) -> DataFrame:
    """Ends and their holders, with the bases of rows(name, seq), by k-mer and block: in each cell first its part of tips(kmer, name, forward, ...), then those of holders(kmer, name, forward, ...) that meet them, the longest first."""
    count = lambda df, c: df.groupBy("kmer").agg(F.count("*").alias(c))
    sizes = keep(count(tips, "_t").join(count(holders, "_h"), "kmer"), "sizes")
    pairs = sizes.agg(F.sum(F.col("_t") * F.col("_h"))).first()[0]
    blocks = lambda c: F.least(F.ceil(F.col(c) / BLOCK), F.lit(BLOCKS)).cast("int")
    own = lambda c: F.pmod(F.xxhash64("name"), blocks(c).cast("long")).cast("int")
    dealt = lambda df, side, mine, other: df.join(sizes, "kmer").join(rows, "name").withColumns({"_side": F.lit(side), "_own": own(mine), "_other": F.explode(F.sequence(F.lit(0), blocks(other) - 1))}).drop("_t", "_h")
    first = dealt(tips, 0, "_t", "_h").withColumnsRenamed({"_own": "_i", "_other": "_j"})
    second = dealt(holders, 1, "_h", "_t").withColumnsRenamed({"_own": "_j", "_other": "_i"})
    both = first.unionByName(second, allowMissingColumns=True)
    return both.repartition(4 * tasks(pairs), "kmer", "_i", "_j").sortWithinPartitions("kmer", "_i", "_j", "_side", F.desc(F.length("seq")))


class _Cell:
    """Rows of _cells of one task as they come: the ends of a cell are held while its holders pass by."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        self.batches = batches

    def holders(self) -> Iterator[tuple[list[dict], dict]]:
        """Each holder with the ends that it meets, whose list may be changed."""
        cell, tips = None, []
        for batch in (part.slice(i, 1_024) for part in self.batches for i in range(0, len(part), 1_024)):
            self.kind = batch.schema.field("name").type
            for row in batch.to_pylist():
                if (at := (row["kmer"], row["_i"], row["_j"])) != cell:
                    cell, tips = at, []
                if row["_side"]:
                    yield tips, row
                else:
                    row["back"] = None
                    tips.append(row)


def _laid(tip: dict, reverse: bool) -> str:
    """The bases of an end's sequence, turned if need be."""
    if not reverse:
        return tip["seq"]
    if tip["back"] is None:
        tip["back"] = tip["seq"].translate(_COMPLEMENT)[::-1]
    return tip["back"]


def _stretches(tip: dict, holder: dict, reverse: bool, k: int, least: int) -> Iterator[int]:
    """Where an end's sequence may begin in a holder (before it: under 0), of the stretches that are given under this end.

    One that lies within the holder is given under its rarer end; where an end of one is an end of the other, the rarer of
    these two gives it (of equally rare ones the smaller code, of the same the smaller name).
    """
    own, other = _laid(tip, reverse), holder["seq"]
    if tip["rarer"] and len(own) < len(other):
        yield from _all_places(own, other)
    mine = (tip["n"], tip["kmer"], tip["name"])
    before, behind = (tip["first"], tip["last"]) if reverse else (tip["last"], tip["first"])
    if before and (holder["n_first"] is None or mine < (holder["n_first"], holder["k_first"], holder["name"])):
        for at in _all_places(other[:k], own):
            if at and least <= len(own) - at < len(other) and other.startswith(own[at:]):
                yield -at
    if behind and (holder["n_last"] is None or mine < (holder["n_last"], holder["k_last"], holder["name"])):
        for at in _all_places(own[:k], other):
            if at and least <= len(other) - at < len(own) and own.startswith(other[at:]):
                yield at


def _exact(rows: DataFrame, k: int, least: int) -> DataFrame:
    """a, b, reverse, offset, size and room of all common stretches without mismatches of pairs of rows(name, seq), each once."""
    tips, holders = _ends(rows, k)
    end = lambda which: F.min(F.when(F.col(which), F.struct("n", "kmer"))).alias(f"_{which}")
    own = keep(tips.groupBy(F.col("a").alias("name")).agg(F.min(F.struct("n", "last")).alias("_least"), end("first"), end("last")), "own")
    some = tips.where("n > 1").withColumnRenamed("a", "name").join(own.select("name", "_least"), "name")
    some = some.select("kmer", "name", F.col("_af").alias("forward"), "first", "last", "n", (F.struct("n", "last") == F.col("_least")).alias("rarer"))
    told = own.select("name", *[F.col(f"_{e}.{c}").alias(f"{c[0]}_{e}") for e in ("first", "last") for c in ("n", "kmer")])
    among = holders.select("kmer", F.col("b").alias("name"), "forward").join(told, "name", "left")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, cells = [], _Cell(batches)

        def given() -> pa.RecordBatch:
            a, b, *rest = map(list, zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, cells.kind), pa.array(b, cells.kind), *map(pa.array, rest[:1]), *(pa.array(c, pa.int32()) for c in rest[1:])], names=["a", "b", "reverse", "offset", "size", "room"])

        for tips, holder in cells.holders():
            for tip in tips:
                a, b = tip["name"], holder["name"]
                if a == b:
                    continue
                reverse, size, room = tip["forward"] != holder["forward"], len(tip["seq"]), len(holder["seq"])
                for at in _stretches(tip, holder, reverse, k, least):
                    # of the two ways to tell a pair, the one by the smaller name
                    out.append((a, b, reverse, at, size, room) if a < b else (b, a, reverse, size - room + at if reverse else -at, room, size))
            if len(out) > 50_000:
                yield given()
        if out:
            yield given()

    kind = rows.schema["name"].dataType
    whole = [T.StructField(c, T.IntegerType()) for c in ("offset", "size", "room")]
    return _cells(some, among, rows).mapInArrow(search, T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("reverse", T.BooleanType()), *whole]))


def _within(tips: DataFrame, holders: DataFrame, rows: DataFrame) -> DataFrame:
    """name of each a of tips(a, kmer, _af) that stands in a longer one of holders(b, kmer, forward), turned if need be."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cell(batches)
        for tips, holder in cells.holders():
            room, seq, forward = len(holder["seq"]), holder["seq"], holder["forward"]
            inside = [t for t in tips if len(t["seq"]) < room and _laid(t, t["forward"] != forward) in seq]
            if inside:
                # one that lies within another is asked for no more
                tips[:] = [t for t in tips if not any(t is x for x in inside)] if len(inside) < len(tips) else []
                yield pa.RecordBatch.from_arrays([pa.array([t["name"] for t in inside], cells.kind)], names=["name"])

    some, among = tips.select("kmer", F.col("a").alias("name"), F.col("_af").alias("forward")), holders.select("kmer", F.col("b").alias("name"), "forward")
    return _cells(some, among, rows).mapInArrow(search, T.StructType([T.StructField("name", rows.schema["name"].dataType)])).distinct()


def _different(seqs: DataFrame, least: int) -> DataFrame:
    """name and seq, in capitals, of sequences of ``least`` bases or more; of equal ones, on either strand, that of the smallest name."""
    rows = seqs.where(F.length("seq") >= least).select("name", F.upper("seq").alias("seq"))
    return rows.groupBy(S.strand_key(F.col("seq")).alias("_k")).agg(F.min_by(F.struct("name", "seq"), "name").alias("_r")).select("_r.*")


def edges(seqs: DataFrame, k: int = 29, least: int = 50, mismatches: int = 0) -> DataFrame:
    """a, b, reverse, offset, length, mismatches and kind of pairs (a < b) of different sequences of seqs(name, seq).

    a (its complement, if reverse) begins at ``offset`` of b, maybe before it; the common stretch has ``least`` bases or
    more and ``mismatches`` of differences or fewer, and holds an end of k bases of one of the two intact.  kind: inner
    (a lies within b), outer (b within a) or end.
    """

    def make() -> DataFrame:
        rows = keep(_different(seqs, max(least, k)), "sequences")
        if mismatches:
            tips = _tips(rows, k)
            # of the two ways to tell a pair, the one by the smaller name; the other name's tips are turned around to it
            found = _met(tips, _holders(rows, tips, k)).select("a", "b", "reverse", "offset", "size", "room")
            swapped = F.when(F.col("reverse"), F.col("size") - F.col("room") + F.col("offset")).otherwise(-F.col("offset"))
            turned = found.where("a > b").select(F.col("b").alias("a"), F.col("a").alias("b"), "reverse", swapped.alias("offset"), F.col("room").alias("size"), F.col("size").alias("room"))
            once = found.where("a < b").unionByName(turned).distinct()
        else:
            once = _exact(rows, k, max(least, k))
        start, stop = F.greatest(F.col("offset"), F.lit(0)), F.least(F.col("offset") + F.col("size"), F.col("room"))
        kind = F.when((F.col("offset") >= 0) & (F.col("offset") + F.col("size") <= F.col("room")), "inner").when((F.col("offset") <= 0) & (F.col("offset") + F.col("size") >= F.col("room")), "outer").otherwise("end")
        pairs = once.withColumns({"start": start, "length": stop - start, "kind": kind}).where(F.col("length") >= least)
        if mismatches:
            pairs = _verified(pairs, rows, mismatches)
        else:
            pairs = pairs.withColumn("mismatches", F.lit(0))
        return pairs.select("a", "b", "reverse", "offset", "length", "mismatches", "kind")

    return settled(make, "edges")


def contained(seqs: DataFrame, least: int = 100, k: int = 29, mismatches: int = 0) -> DataFrame:
    """name of seqs(name, seq) of ``least`` bases or more that lie within no other one, on either strand, with ``mismatches`` differences or fewer and one end of k bases intact (of two of one length, the smaller name stays)."""

    def make() -> DataFrame:
        rows = keep(_different(seqs, max(least, k)), "sequences")
        tips = _tips(rows, k)
        holders = _holders(rows, tips, k)
        if not mismatches:
            holders = holders.select("kmer", "b", "forward", "room").distinct()
        holders = keep(holders, "holders")
        if not mismatches:
            # both ends of a sequence stand in what holds it: the rarer one is enough
            rarer = Window.partitionBy("a").orderBy("n", "at")
            tips = keep(tips.join(_rarity(holders), "kmer").withColumn("_n", F.row_number().over(rarer)).where("_n = 1 and n > 1").drop("n", "_n"), "tips")
            return rows.select("name").join(_within(tips, holders, rows), "name", "left_anti")
        order = Window.partitionBy("kmer").orderBy(F.desc("room"), "b", "pos")
        longest = holders.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= FIRST_TRIES).drop("_n")

        def inside(some: DataFrame, among: DataFrame) -> DataFrame:
            met = _met(some, among).where("(room > size or room = size and b < a) and offset >= 0 and offset + size <= room")
            pairs = met.select("a", "b", "reverse", "offset", F.col("offset").alias("start"), F.col("size").alias("length")).distinct()
            return _verified(pairs, rows, mismatches).select(F.col("a").alias("name")).distinct()

        first = keep(inside(tips, longest), "inside")
        rest = tips.join(first.withColumnRenamed("name", "a"), "a", "left_anti")
        second = inside(rest, holders)
        return rows.select("name").join(first.unionByName(second), "name", "left_anti")

    return settled(make, "contained")
