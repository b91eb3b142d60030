"""Alignment tables (qname, flag, rname, pos, mapq, cigar, …; pos from 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrand.functions import seq as S


def flag(bits: int) -> Column:
    return F.col("flag").bitwiseAND(bits) != 0


def view(rows: DataFrame, require: int = 0, exclude: int = 0, mapq: int = 0, sample: float | None = None, seed: str = "0") -> DataFrame:
    """Rows with all required and none of the excluded flag bits, at a mapping quality or more; templates sampled by a seeded hash of their name."""
    out = rows.where((F.col("flag").bitwiseAND(require) == require) & (F.col("flag").bitwiseAND(exclude) == 0) & (F.col("mapq") >= mapq))
    if sample is not None:
        out = out.where(F.conv(F.substr(F.md5(F.concat(F.lit(seed), F.col("qname").cast("string"))), F.lit(1), F.lit(8)), 16, 10).cast("double") < sample * 2.0**32)
    return out


def flagstat(rows: DataFrame) -> DataFrame:
    """counter, passed, failed."""
    paired = flag(1)
    both = paired & ~flag(4) & ~flag(8)
    tests = {
        "total": F.lit(True), "duplicates": flag(0x400), "mapped": ~flag(4), "paired": paired, "read1": paired & flag(0x40), "read2": paired & flag(0x80),
        "properly_paired": paired & flag(2) & ~flag(4), "with_mate_mapped": both, "singletons": paired & ~flag(4) & flag(8), "mate_on_other": both & (F.col("rname") != F.col("rnext")), "mate_on_other_mapq5": both & (F.col("rname") != F.col("rnext")) & (F.col("mapq") >= 5),
    }
    sums = rows.agg(*[F.sum((t & (flag(0x200) if bad else ~flag(0x200))).cast("long")).alias(f"{n}_{int(bad)}") for n, t in tests.items() for bad in (False, True)])
    made = F.array(*[F.struct(F.lit(n).alias("counter"), F.coalesce(f"{n}_0", F.lit(0)).cast("long").alias("passed"), F.coalesce(f"{n}_1", F.lit(0)).cast("long").alias("failed")) for n in tests])
    return sums.select(F.inline(made))


def idxstats(rows: DataFrame) -> DataFrame:
    return rows.groupBy("rname").agg(F.sum((~flag(4)).cast("long")).alias("mapped"), F.sum(flag(4).cast("long")).alias("unmapped"))


def remove_duplicates(rows: DataFrame, key: list[str], quality: str, tie: str) -> DataFrame:
    """Of rows with the same key, the one of the highest quality."""
    order = Window.partitionBy(*key).orderBy(F.desc(quality), tie)
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def fix_mates(rows: DataFrame, order: tuple[str, ...] = ("rname", "pos")) -> DataFrame:
    """rows with flag, rnext, pnext and tlen from their mates: of a name, the n-th first read and the n-th second read in ``order`` are a pair, so every row has one mate at most.

    A row takes the mate's strand (0x20), and where the mate is unmapped 0x8 in place of 0x2; a paired row without a mate is marked
    as that of an unmapped one.  tlen is that of pairs on one reference with no unmapped side, between the ends their sequencing began at.
    """
    five = F.col("pos") - 1 + F.when(flag(16), S.cigar_length(F.col("cigar"), "M=XDN")).otherwise(0)
    side = F.when(flag(0x40), 0x40).when(flag(0x80), 0x80)
    held = rows.withColumn("_five", five).withColumn("_side", side).withColumn("_n", F.row_number().over(Window.partitionBy("qname", "_side").orderBy(*order)))
    mate = held.where("_side is not null").select("qname", (F.lit(0xC0) - F.col("_side")).alias("_side"), "_n", F.col("rname").alias("_rname"), F.col("pos").alias("_pos"), F.col("_five").alias("_mate"), F.col("flag").alias("_flag"))
    both = held.join(mate, ["qname", "_side", "_n"], "left")
    whole = (F.col("rname") == F.col("_rname")) & ~flag(12) & (F.col("_flag").bitwiseAND(12) == 0)
    clear, lost = (lambda c, bits: c.bitwiseAND(F.lit(~bits & 0xFFFF))), F.col("_flag").bitwiseAND(4) != 0
    strand = clear(F.col("flag"), 0x20).bitwiseOR(F.when(F.col("_flag").bitwiseAND(16) != 0, 0x20).otherwise(0))
    alone = F.when(flag(1), clear(F.col("flag"), 0x22).bitwiseOR(F.lit(8))).otherwise(F.col("flag"))
    new = F.when(F.col("_flag").isNull(), alone).when(lost, clear(strand, 2).bitwiseOR(F.lit(8))).otherwise(strand)
    return both.withColumns({"flag": new, "rnext": F.coalesce("_rname", F.lit("*")), "pnext": F.coalesce("_pos", F.lit(0)), "tlen": F.when(whole, F.col("_mate") - F.col("_five")).otherwise(0)}).drop("_five", "_mate", "_rname", "_pos", "_side", "_n", "_flag")


def spans(rows: DataFrame) -> DataFrame:
    """rname, start and end (half-open, from 1) of every aligned stretch of a row (deletions and skips are none)."""
    start = F.struct(F.col("pos").cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("on"))

    def step(s: Column, x: Column) -> Column:
        aligned, moves = x.op.isin("M", "=", "X"), x.op.isin("M", "=", "X", "D", "N")
        on = F.when(aligned, F.concat(s.on, F.array(F.struct(s.at.alias("start"), (s.at + x.n).alias("end"))))).otherwise(s.on)
        return F.struct(F.when(moves, s.at + x.n).otherwise(s.at).alias("at"), on.alias("on"))

    return rows.select("rname", F.inline(F.aggregate(S.cigar_ops(F.col("cigar")), start, step, lambda s: s.on))).where(F.col("start") < F.col("end"))


def _levels(rows: DataFrame, mapq: int, width: int) -> DataFrame:
    """rname, start, end and depth (over zero) of runs of equal depth.

    Stretches are cut at multiples of ``width`` and swept within each such bin,
    so that a contig of any length and depth is spread over many tasks.
    """
    cut = spans(view(rows, exclude=0x704, mapq=mapq)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    low, high = F.greatest(F.col("start").cast("long"), F.col("_bin") * width), F.least(F.col("end").cast("long"), (F.col("_bin") + 1) * width)
    ends = F.array(F.struct(low.alias("start"), F.lit(1).alias("d")), F.struct(high.alias("start"), F.lit(-1).alias("d")))
    steps = cut.select("rname", "_bin", F.inline(ends)).groupBy("rname", "_bin", "start").agg(F.sum("d").alias("d"))
    order = Window.partitionBy("rname", "_bin").orderBy("start")
    return steps.select("rname", "start", F.lead("start").over(order).alias("end"), F.sum("d").over(order).alias("depth")).where("depth > 0")


def depth(rows: DataFrame, mapq: int = 0, width: int = 65_536) -> DataFrame:
    """rname, pos (from 1), depth over aligned bases (deletions and skips are none)."""
    return _levels(rows, mapq, width).select("rname", F.explode(F.sequence(F.col("start").cast("int"), (F.col("end") - 1).cast("int"))).alias("pos"), "depth")


def binned_depth(rows: DataFrame, size: int, mapq: int = 0) -> DataFrame:
    """rname, bin (first position, a multiple of ``size``), bases aligned in it and the positions covered."""
    runs = _levels(rows, mapq, size)
    w = F.col("end") - F.col("start")
    return runs.groupBy("rname", (F.floor(F.col("start") / size) * size).alias("bin")).agg(F.sum(w * F.col("depth")).alias("bases"), F.sum(w).alias("covered"))


def depth_histogram(rows: DataFrame, mapq: int = 0, width: int = 65_536) -> DataFrame:
    """depth and how many positions have it, of those covered at all."""
    return _levels(rows, mapq, width).groupBy("depth").agg(F.sum(F.col("end") - F.col("start")).alias("positions"))


def to_fastq(rows: DataFrame) -> DataFrame:
    """name (with mate number), seq and qual as sequenced; one row for each read."""
    back = flag(16)
    end = F.when(flag(0x40), "/1").when(flag(0x80), "/2").otherwise("")
    return rows.where(~flag(0x900)).select(F.concat("qname", end).alias("name"), F.when(back, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))


def to_bed(rows: DataFrame) -> DataFrame:
    """chrom, start, end, name, score and strand of mapped rows."""
    start = F.col("pos") - 1
    end = F.when(flag(0x40), "/1").when(flag(0x80), "/2").otherwise("")
    return rows.where(~flag(4)).select(F.col("rname").alias("chrom"), start.alias("start"), (start + S.cigar_length(F.col("cigar"), "M=XDN")).alias("end"), F.concat("qname", end).alias("name"), F.col("mapq").alias("score"), F.when(flag(16), "-").otherwise("+").alias("strand"))


def strand_of(rows: DataFrame) -> DataFrame:
    """rows with ``file``: plus, minus or unmapped."""
    return rows.withColumn("file", F.when(flag(4), "unmapped").when(flag(16), "minus").otherwise("plus"))


def soft_clip_filter(rows: DataFrame, least: float = 0.55) -> DataFrame:
    """Rows whose aligned share of the read reaches the least."""
    aligned, whole = S.cigar_length(F.col("cigar"), "M=XI"), S.cigar_length(F.col("cigar"), "M=XIS")
    return rows.where((whole > 0) & (aligned >= least * whole))


def roc(rows: DataFrame) -> DataFrame:
    """mapq, right, wrong: running counts of rows(mapq, correct) from the best quality down."""
    each = rows.groupBy("mapq").agg(F.sum(F.col("correct").cast("long")).alias("r"), F.sum((~F.col("correct")).cast("long")).alias("w"))
    down = Window.orderBy(F.desc("mapq")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each quality
    return each.select("mapq", F.sum("r").over(down).alias("right"), F.sum("w").over(down).alias("wrong"))


def indel_lengths(rows: DataFrame) -> DataFrame:
    """kind (I or D), size and n of the insertions and deletions of mapped rows."""
    ops = F.filter(S.cigar_ops(F.col("cigar")), lambda x: x.op.isin("I", "D"))
    return rows.where(~flag(4)).select(F.inline(ops)).groupBy(F.col("op").alias("kind"), F.col("n").alias("size")).agg(F.count("*").alias("n"))


def identities(rows: DataFrame, bins: int = 100) -> DataFrame:
    """bin and reads of mapped rows(cigar, nm): the share of aligned, inserted and deleted places without an edit, in so many bins."""
    places = S.cigar_length(F.col("cigar"), "M=XID")
    share = F.greatest(places - F.col("nm"), F.lit(0))
    return rows.where(~flag(4)).where(places > 0).groupBy(F.least(F.floor(share * bins / places), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("reads"))


def mean_quality(rows: DataFrame, excluded: int = 0x704) -> DataFrame:
    """rname and mapq: the mean mapping quality of a contig's rows without the excluded flags."""
    return rows.where(F.col("flag").bitwiseAND(excluded) == 0).groupBy("rname").agg(F.avg("mapq").alias("mapq"))


def remove_pair_duplicates(rows: DataFrame, quality: str) -> DataFrame:
    """Both rows of the best pair (by the sum of their qualities, ties by name) of those that lie on the same contigs and places with the same strands; rows(qname, flag, rname, pos, …) of pairs with both mates mapped."""
    end = F.struct(F.col("rname").cast("string").alias("c"), F.col("pos"), flag(16).alias("back"), F.when(flag(0x40), 1).otherwise(2).alias("side"))
    pairs = rows.groupBy("qname").agg(F.array_sort(F.collect_list(end)).alias("_ends"), F.sum(quality).alias("_q"))
    order = Window.partitionBy("_ends").orderBy(F.desc("_q"), "qname")
    best = pairs.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("qname")
    return rows.join(best, "qname", "left_semi")


def fetch(rows: DataFrame, chrom, start: int, end: int) -> DataFrame:
    """Mapped rows that overlap [start, end) of a contig, places from 0."""
    last = F.col("pos") - 1 + S.cigar_length(F.col("cigar"), "M=XDN")
    return rows.where(~flag(4) & (F.col("rname") == F.lit(chrom)) & (F.col("pos") - 1 < end) & (last > start))


def sorted_by_place(rows: DataFrame) -> DataFrame:
    """rows in order of contig, place and name, to be written so: each partition a range of it."""
    return rows.repartitionByRange("rname", "pos", "qname").sortWithinPartitions("rname", "pos", "qname")


def renamed_contigs(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with the contigs of names(old, new) renamed; others stay."""
    to = names.select(F.col("old").alias("_o"), F.col("new").alias("_n"))
    return rows.join(to, rows.rname == F.col("_o"), "left").withColumn("rname", F.coalesce("_n", F.col("rname").cast("string"))).drop("_o", "_n")


def pieces(rows: DataFrame) -> DataFrame:
    """rname, seq, at (from 1), read and n of every aligned or deleted stretch of rows(rname, pos, cigar, seq): n places from at on, and where in seq they begin (0: deleted)."""
    start = F.struct(F.col("pos").cast("int").alias("at"), F.lit(1).alias("read"), F.array().cast("array<struct<at:int,read:int,n:int>>").alias("on"))

    def step(s: Column, x: Column) -> Column:
        aligned, gone = x.op.isin("M", "=", "X"), x.op == "D"
        part = F.struct(s.at.alias("at"), F.when(aligned, s.read).otherwise(0).alias("read"), x.n.alias("n"))
        return F.struct(F.when(aligned | x.op.isin("D", "N"), s.at + x.n).otherwise(s.at).alias("at"), F.when(aligned | x.op.isin("I", "S"), s.read + x.n).otherwise(s.read).alias("read"), F.when(aligned | gone, F.concat(s.on, F.array(part))).otherwise(s.on).alias("on"))

    return rows.select("rname", "seq", F.inline(F.aggregate(S.cigar_ops(F.col("cigar")), start, step, lambda s: s.on)))


def pileup(rows: DataFrame, mapq: int = 0, width: int = 4_096, reads: int = 50_000) -> DataFrame:
    """rname, pos, depth and alleles (base and count, in order of base) of rows that pass the usual flags and quality; the base of a place is the read's letter, or - where it is deleted.

    Stretches are cut at multiples of ``width`` and shuffled with their letters by these bins, once, into a part for each ``reads`` rows; single bases
    arise and are counted in arrays, a batch of stretches at once.
    """
    fine = view(rows, exclude=0x704, mapq=mapq)
    parts = max(1, -(-fine.count() // reads))
    cut = pieces(fine).where("n > 0").withColumn("_bin", F.explode(F.sequence(F.floor(F.col("at") / width), F.floor((F.col("at") + F.col("n") - 1) / width))))
    low = F.greatest(F.col("at").cast("long"), F.col("_bin") * width).cast("int")
    high = F.least((F.col("at") + F.col("n")).cast("long"), (F.col("_bin") + 1) * width).cast("int")
    letters = F.when(F.col("read") > 0, F.substr("seq", F.col("read") + low - F.col("at"), high - low))
    held = cut.select("rname", "_bin", low.alias("low"), (high - low).alias("n"), (F.col("read") == 0).alias("gone"), letters.alias("letters")).repartition(parts, "rname", "_bin").sortWithinPartitions("rname", "_bin")
    return held.mapInArrow(_counted_bases, T.StructType([rows.schema["rname"], T.StructField("pos", T.IntegerType()), T.StructField("depth", T.LongType()), T.StructField("alleles", T.StringType())]))


#: A base's number is _FIRST more than its code point; before these come bases that are null and those behind the end of a read.
_NONE, _BEHIND, _FIRST, _SPAN = 0, 1, 2, 1 << 21


def _bases(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Place and base in one number, and row, of all bases of a batch of (low, n, gone, letters)."""
    low, n = (batch.column(c).to_numpy() for c in ("low", "n"))
    gone, letters = batch.column("gone").to_numpy(zero_copy_only=False), batch.column("letters")
    row = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    sizes = pc.fill_null(pc.utf8_length(letters), 0).to_numpy(zero_copy_only=False)
    chars = np.frombuffer("".join(letters.drop_null().to_pylist()).encode("utf-32-le"), np.uint32)
    base = np.where(pc.is_null(letters).to_numpy(zero_copy_only=False), _NONE, _BEHIND)[row]
    base[i < sizes[row]] = chars.astype(np.int64) + _FIRST
    base[gone[row]] = ord("-") + _FIRST
    return (low[row].astype(np.int64) + i) * _SPAN + base, row


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, in order, and the sum of n of each."""
    found, at = np.unique(key, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def _counted_bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rname, pos, depth and alleles of stretches in order of rname and bin; of the bin that goes on in the next batch, counts are held."""
    held = None  # rname (an array of one), bin, keys and counts

    def told(names: pa.Array, own: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """Rows of counts in order of (own: which of names, key)."""
        place = key // _SPAN
        first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (place[1:] != place[:-1])])
        base, at = np.unique(key % _SPAN, return_inverse=True)
        letter = pa.array([chr(b - _FIRST) if b >= _FIRST else "" for b in base.tolist()]).take(pa.array(at))
        number = pc.if_else(pa.array(key % _SPAN == _NONE), "", pa.array(n).cast(pa.string()))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(key)].astype(np.int32)), pc.binary_join_element_wise(letter, number, ""))
        return pa.RecordBatch.from_arrays([names.take(pa.array(own[first])), pa.array(place[first].astype(np.int32)), pa.array(np.add.reduceat(n, first)), pc.binary_join(lists, "")], names=["rname", "pos", "depth", "alleles"])

    for batch in (part.slice(i, 20_000) for part in batches for i in range(0, len(part), 20_000)):
        names, bins = batch.column("rname"), batch.column("_bin").to_numpy()
        code = names.dictionary_encode(null_encoding="encode").indices.to_numpy()
        start = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (bins[1:] != bins[:-1])])
        key, row = _bases(batch)
        # counts by bin (which come in order) and key
        cuts = np.r_[np.searchsorted(row, start), len(row)]
        each = [np.unique(key[i:j], return_counts=True) for i, j in zip(cuts[:-1], cuts[1:])]
        if held is not None:
            if held[0].equals(names.slice(0, 1)) and held[1] == bins[0]:
                each[0] = _summed(np.r_[held[2], each[0][0]], np.r_[held[3], each[0][1]])
            else:
                yield told(held[0], np.zeros(len(held[2]), np.int64), *held[2:])
        held = (names.slice(int(start[-1]), 1), bins[start[-1]], *each.pop())
        if each:
            own = np.repeat(start[:-1], [len(k) for k, _ in each])
            yield told(names, own, np.concatenate([k for k, _ in each]), np.concatenate([n for _, n in each]))
    if held is not None:
        yield told(held[0], np.zeros(len(held[2]), np.int64), *held[2:])
