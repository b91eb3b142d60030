"""Operators that rebuild, group or order reads: mate merging, cutting, barcodes, clumps, chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators.kmers import explode


def letter_codes(column: pa.Array, width: int, right: bool = False) -> np.ndarray:
    """A row of ``width`` code points for each text (at most so long), padded with 0 behind it, or before it if ``right``."""
    texts = [t or "" for t in column.to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), width), np.uint32)
    at = np.arange(width)[None, :]
    out[at >= width - sizes[:, None] if right else at < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


#: Letters of either side that are compared at once.
LETTERS = 1 << 20


def _overlaps(first: pa.Array, second: pa.Array, least: int, most_share: float) -> np.ndarray:
    """The overlap of each first's end and second's start with the lowest share of mismatches, longest among ties; 0 where that share is over most_share, or a side is null or too short."""
    sizes = [np.where(pc.is_null(x), 0, pc.fill_null(pc.utf8_length(x), 0)).astype(np.int64) for x in (first, second)]
    shorter = np.minimum(*sizes)
    out = np.zeros(len(first), np.int64)
    # rows of like lengths, so that one long sequence does not widen all
    order = np.argsort(shorter, kind="stable")
    order = order[shorter[order] >= max(least, 1)]
    while len(order):
        n = max(1, int(np.searchsorted(shorter[order] * np.arange(1, len(order) + 1), LETTERS, side="right")))
        rows, order = order[:n], order[n:]
        width = int(shorter[rows].max())
        take = pa.array(rows)
        a = letter_codes(pc.utf8_slice_codeunits(first.take(take), -width), width, right=True)
        b = letter_codes(pc.utf8_slice_codeunits(second.take(take), 0, width), width)
        share, found = np.full(n, np.inf), np.zeros(n, np.int64)
        for size in range(max(least, 1), width + 1):
            # sorted: those of at least this size stand last
            i = int(np.searchsorted(shorter[rows], size))
            own = np.count_nonzero(a[i:, width - size :] != b[i:, :size], axis=1) / size
            better = own <= share[i:]
            share[i:][better], found[i:][better] = own[better], size
        out[rows] = np.where(share <= most_share, found, 0)
    return out


def merge_mates(pairs: DataFrame, least: int = 12, most_share: float = 0.1) -> DataFrame:
    """pairs(…, seq1, seq2) with ``overlap`` and ``merged``: mates joined where the end of the first overlaps the reverse complement of the second in ``least`` bases or more, at most that share of them different (the first mate's base stands); null where none does."""

    def found(first: pa.Array, second: pa.Array) -> pa.Array:
        size = _overlaps(first, second, least, most_share)
        return pa.array(size.astype(np.int32), mask=size == 0)

    other = S.reverse_complement(F.col("seq2"))
    held = pairs.withColumn("overlap", F.arrow_udf(found, "int")(F.col("seq1"), other))
    return held.withColumn("merged", F.when(F.col("overlap").isNotNull(), F.concat("seq1", F.substr(other, F.col("overlap") + 1))))


def cut_at_n(seqs: DataFrame, least: int) -> DataFrame:
    """name, part (from 0) and seq of what lies between runs of ``least`` or more N."""
    pieces = F.filter(F.split("seq", f"[Nn]{{{least},}}"), lambda x: x != "")
    return seqs.select("name", F.posexplode(pieces).alias("part", "seq"))


def demultiplex(reads: DataFrame, tags: DataFrame, size: int, unknown: str = "unknown") -> DataFrame:
    """reads(…, barcode) with ``file``: the tag of tags(tag) that equals the barcode, else the only one a substitution away, else ``unknown``."""
    known = tags.select("tag").where(F.length("tag") == size).distinct()
    near = known.select("tag", F.explode(S.neighbours(F.col("tag"), size)).alias("barcode"))
    one = near.groupBy("barcode").agg(F.max(F.when(F.col("tag") == F.col("barcode"), F.col("tag"))).alias("_same"), F.min("tag").alias("_near"), F.count("*").alias("_n"))
    meant = one.select("barcode", F.coalesce("_same", F.when(F.col("_n") == 1, F.col("_near"))).alias("file"))
    return reads.join(meant, "barcode", "left").withColumn("file", F.coalesce("file", F.lit(unknown)))


def pivots(seqs: DataFrame, k: int) -> DataFrame:
    """seqs with ``pivot`` (the canonical k-mer of greatest md5) and ``place`` (where it stands first); null without a k-mer of ACGT only."""
    held = F.transform(S.kmers(F.upper("seq"), k), lambda x, i: F.struct(S.canonical(x).alias("kmer"), i.alias("at")))
    ranked = F.transform(F.filter(held, lambda x: x.kmer.rlike(f"^[ACGT]{{{k}}}$")), lambda x: F.struct(F.md5(x.kmer).alias("h"), (-x["at"]).alias("before"), x.kmer.alias("kmer")))
    return seqs.withColumn("_p", F.array_max(ranked)).withColumn("pivot", F.col("_p.kmer")).withColumn("place", -F.col("_p.before")).drop("_p")


def clumped(seqs: DataFrame, k: int) -> DataFrame:
    """seqs in order of pivot and place, so that overlapping reads lie together in the written files."""
    return pivots(seqs, k).repartitionByRange("pivot", "place", "name").sortWithinPartitions("pivot", "place", "name")


def uniqueness(seqs: DataFrame, k: int, width: int) -> DataFrame:
    """bin (of ``width`` names, which are numbers), kmers and fresh: how many k-mers the bin's sequences have, and how many different ones are in no bin before."""
    per = explode(seqs, k).groupBy("kmer", F.floor(F.col("name") / width).alias("bin")).agg(F.count("*").alias("n"))
    total = per.groupBy("bin").agg(F.sum("n").alias("kmers"))
    fresh = per.groupBy("kmer").agg(F.min("bin").alias("bin")).groupBy("bin").agg(F.count("*").alias("fresh"))
    return total.join(fresh, "bin", "left").select("bin", "kmers", F.coalesce("fresh", F.lit(0)).alias("fresh"))


def hit_positions(reads: DataFrame, refs: DataFrame, k: int) -> DataFrame:
    """pos and hits: at which places of reads k-mers of refs stand."""
    return explode(reads, k).join(explode(refs, k).select("kmer").distinct(), "kmer", "left_semi").groupBy("pos").agg(F.count("*").alias("hits"))


def insert_sizes(rows: DataFrame) -> DataFrame:
    """size and pairs of rows(…, tlen): each pair counted at its left mate."""
    return rows.where("tlen > 0").groupBy(F.col("tlen").alias("size")).agg(F.count("*").alias("pairs"))


def six_frames(seqs: DataFrame) -> DataFrame:
    """name, frame (0 to 2 forward, 3 to 5 on the other strand) and protein."""
    each = F.array(*[F.struct(F.lit(f).alias("frame"), S.translate_frame(F.upper("seq"), f).alias("protein")) for f in range(6)])
    return seqs.select("name", F.inline(each))


def chunk_by_size(seqs: DataFrame, size: int, order: str = "name", ranges: int = 256) -> DataFrame:
    """seqs with ``chunk``: a new one whenever the length of all sequences before, in order of a numeric column without repeats, passes a multiple of size.

    Lengths are summed up over ranges of the order column first, so no task orders the whole table.
    """
    # at most ``ranges`` numbers
    cuts = seqs.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    ranged = seqs.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col(order))))
    totals = ranged.groupBy("_range").agg(F.sum(F.length("seq")).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = totals.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    run = F.col("_start") + F.coalesce(F.sum(F.length("seq")).over(inside), F.lit(0))
    return ranged.join(F.broadcast(starts), "_range").withColumn("chunk", F.floor(run / size)).drop("_range", "_start")
