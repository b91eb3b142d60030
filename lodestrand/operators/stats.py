"""Statistics over sequences and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S


def assembly(seqs: DataFrame) -> DataFrame:
    """scaffolds, bases, longest, gc, n50 (length at which half of all bases are reached) and l50 (sequences needed), from a table of lengths."""
    lengths = seqs.groupBy(F.length("seq").cast("long").alias("len")).agg(F.count("*").alias("n"))
    down = Window.orderBy(F.desc("len")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each length
    run = lengths.withColumn("_bases", F.sum(F.col("len") * F.col("n")).over(down)).withColumn("_seqs", F.sum("n").over(down))
    total = seqs.agg(F.count("*").alias("scaffolds"), F.sum(F.length("seq")).cast("long").alias("bases"), F.max(F.length("seq")).cast("long").alias("longest"), F.round(F.sum(S.count_of(F.col("seq"), "GCgc")) / F.sum(F.length("seq")), 6).alias("gc"))
    reached = run.join(F.broadcast(total), F.lit(True)).where("2 * _bases >= bases")  # one row
    half = reached.agg(F.max("len").alias("n50"), F.min(F.struct(F.col("_seqs"), F.col("_bases"), F.col("len"), F.col("n"), F.col("bases"))).alias("x"))
    l50 = F.col("x._seqs") - F.floor((2 * F.col("x._bases") - F.col("x.bases")) / (2 * F.col("x.len")))
    return total.join(half, F.lit(True)).select("scaffolds", "bases", "longest", "gc", "n50", l50.cast("long").alias("l50"))


def assemblies(seqs: DataFrame, by: str) -> DataFrame:
    """scaffolds, bases and n50 of the sequences of each file (or other column), from a table of lengths."""
    lengths = seqs.groupBy(by, F.length("seq").cast("long").alias("len")).agg(F.count("*").alias("n"))
    down = Window.partitionBy(by).orderBy(F.desc("len")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each length
    run = lengths.withColumn("_b", F.sum(F.col("len") * F.col("n")).over(down)).withColumn("_t", F.sum(F.col("len") * F.col("n")).over(Window.partitionBy(by)))
    return run.groupBy(by).agg(F.sum("n").alias("scaffolds"), F.max("_t").alias("bases"), F.max(F.when(2 * F.col("_b") >= F.col("_t"), F.col("len"))).alias("n50"))


def gaps(seqs: DataFrame, least: int = 1) -> DataFrame:
    """name, gaps (runs of ``least`` N or more), gap_bases, contigs (what lies between) and longest contig."""
    runs = F.regexp_extract_all(F.upper("seq"), F.lit(f"(N{{{least},}})"), F.lit(1))
    parts = F.filter(F.split(F.upper("seq"), f"N{{{least},}}"), lambda x: x != "")
    total = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.length(x))
    return seqs.select("name", F.size(runs).alias("gaps"), total(runs).cast("long").alias("gap_bases"), F.size(parts).alias("contigs"), F.coalesce(F.array_max(F.transform(parts, lambda x: F.length(x))), F.lit(0)).cast("long").alias("longest"))


def length_histogram(seqs: DataFrame, width: int) -> DataFrame:
    return seqs.groupBy((F.floor(F.length("seq") / width) * width).cast("long").alias("length")).agg(F.count("*").alias("reads"), F.sum(F.length("seq")).cast("long").alias("bases"))


def gc_histogram(seqs: DataFrame, bins: int) -> DataFrame:
    return seqs.where(F.length("seq") > 0).groupBy(F.least(F.floor(S.count_of(F.col("seq"), "GCgc") * bins / F.length("seq")), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("reads"))


def base_composition(seqs: DataFrame, width: int, letters: str = "ACGTN") -> DataFrame:
    """pos (the first, from 0, of ``width`` places), base and n over whole sequences: how often each of the letters stands there; ``other``: all others."""
    tile = F.transform(F.sequence(F.lit(0), F.length("seq") - 1, F.lit(width)), lambda s: F.struct(s.cast("long").alias("pos"), F.substr("seq", s + 1, F.lit(width)).alias("tile")))
    counts = [F.struct(F.lit(b).alias("base"), S.count_of(F.col("tile"), b).alias("n")) for b in letters] + [F.struct(F.lit("other").alias("base"), F.length(F.translate("tile", letters, "")).cast("long").alias("n"))]
    each = seqs.where(F.length("seq") > 0).select(F.inline(tile)).select("pos", F.inline(F.array(*counts)))
    return each.groupBy("pos", "base").agg(F.sum("n").alias("n")).where("n > 0")


def quality_by_place(reads: DataFrame, width: int, offset: int = 33) -> DataFrame:
    """pos (the first, from 0, of ``width`` places), bases and mean quality over whole reads."""
    each = reads.where(F.length("qual") > 0).select(F.posexplode(S.phred(F.col("qual"), offset)).alias("p", "q"))
    return each.groupBy((F.floor(F.col("p") / width) * width).alias("pos")).agg(F.count("*").alias("bases"), F.avg("q").alias("quality"))


def shared_lines(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct lines in both tables(line)."""
    return left.select("line").intersect(right.select("line"))


def fuse(seqs: DataFrame, pad: int, by: str, order: str) -> DataFrame:
    """Sequences of each group joined in order with N between them."""
    return seqs.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "seq"))), lambda x: x.seq), "N" * pad).alias("seq"))


def weighted_merge(rows: DataFrame, by: str) -> DataFrame:
    """Coverage rows(by, length, mean) of the same unit as one: length-weighted mean."""
    return rows.groupBy(by).agg(F.sum("length").alias("length"), (F.sum(F.col("mean") * F.col("length")) / F.sum("length")).alias("mean"))
