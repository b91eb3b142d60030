"""Grades, summaries and rules over results of other tools: merges, captures, spikes, sketches, best hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import codes
from lodestrand.functions import seq as S
from lodestrand.operators import kmers, qc


def grade_merges(merged: DataFrame) -> DataFrame:
    """pairs, joined, right, short, long of merged(name, overlap, size): the true size stands as ``insert=N`` in the name; a pair without an overlap is not joined."""
    truth = F.regexp_extract("name", r"insert=(\d+)", 1).try_cast("long")
    on = F.col("overlap").isNotNull()
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    return merged.withColumn("_t", truth).agg(F.count("*").alias("pairs"), n(on, "joined"), n(on & (F.col("size") == F.col("_t")), "right"), n(on & (F.col("size") < F.col("_t")), "short"), n(on & (F.col("size") > F.col("_t")), "long"))


def summary(rows: DataFrame, by: str, value: str) -> DataFrame:
    """by, rows, total, least, most and mean of a value."""
    return rows.groupBy(by).agg(F.count("*").alias("rows"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"), F.avg(value).alias("mean"))


def captured(alignments: DataFrame, share: float) -> DataFrame:
    """est, best (the greatest share of its length that one alignment covers), all (the sum over its alignments, one at most) and state (whole, part, none) of alignments(est, length, aligned)."""
    per = alignments.groupBy("est").agg(F.max(F.col("aligned") / F.col("length")).alias("best"), F.least(F.sum(F.col("aligned") / F.col("length")), F.lit(1.0)).alias("all"))
    return per.withColumn("state", F.when(F.col("best") >= share, "whole").when(F.col("all") > 0, "part").otherwise("none"))


def without_strong_hits(reads: DataFrame, m8: DataFrame, bits: float) -> DataFrame:
    """reads(name, …) without a hit of m8(qid, bits) that scores ``bits`` or more."""
    strong = m8.groupBy("qid").agg(F.max("bits").alias("_b")).where(F.col("_b") >= bits)
    return reads.join(strong, reads.name == strong.qid, "left_anti")


def substitutions(cigar: Column, edits: Column) -> Column:
    """Edits that are no inserted or deleted bases."""
    return edits - S.cigar_length(cigar, "ID")


def with_substitutions(rows: DataFrame, least: int, most: int | None = None) -> DataFrame:
    """rows(cigar, nm, …) with so many substitutions."""
    n = substitutions(F.col("cigar"), F.col("nm"))
    return rows.where((n >= least) & (n <= most) if most is not None else n >= least)


def release(contigs: DataFrame, least: int, gap: int, prefix: str = "scaffold") -> DataFrame:
    """name, was and seq: contigs(name, seq) of ``least`` bases or more, named by falling length (ties by name), with every run of 10 N or more as one of ``gap``.

    Numbers come from a table of lengths, of which there are few, and then from names.
    """
    kept = contigs.where(F.length("seq") >= least).withColumn("_len", F.length("seq"))
    sizes = kept.groupBy("_len").agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.desc("_len")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each length
    starts = sizes.select("_len", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.row_number().over(Window.partitionBy("_len").orderBy("name"))
    return kept.join(starts, "_len").select(F.concat(F.lit(prefix + "_"), place.cast("string")).alias("name"), F.col("name").alias("was"), F.regexp_replace("seq", "N{10,}", "N" * gap).alias("seq"))


def named_by_match(reads: DataFrame, best: DataFrame) -> DataFrame:
    """reads(name, …) with ``label``: the references of best(name, ref, hits) as ref=hits, joined by commas in order of hits and name."""
    per = best.groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("hits")).alias("h"), F.col("ref").cast("string").alias("ref")))), lambda x: F.concat(x.ref, F.lit("="), (-x.h).cast("string"))), ",").alias("label"))
    return reads.join(per, "name", "left")


def cleaned(reads: DataFrame, adapters: DataFrame, contaminants: DataFrame, k: int, k_match: int, hits: int, least: int, low_gc: float, high_gc: float) -> DataFrame:
    """reads(name, seq) cut at their first adapter k-mer, of the least length and GC bounds, without those that share ``hits`` k-mers with a contaminant."""
    cut = kmers.trim(reads, adapters, k)
    fine = qc.filters(cut.withColumn("qual", F.lit(None).cast("string")), least=least, low_gc=low_gc, high_gc=high_gc).where("ok").drop("ok", "qual")
    return fine.join(kmers.match(fine, contaminants, k_match, hits).select("name"), "name", "left_anti")


# ------------------------------------------------------------------ k-mer rules


def count_min(seqs: DataFrame, k: int, width: int, hashes: int = 3, seed: str = "s") -> DataFrame:
    """A count-min table of a sequence table's k-mers: i, bucket, n; so many hashes by width rows at most."""
    n = kmers.counts(seqs, k)
    each = n.select("n", F.inline(F.array(*[F.struct(F.lit(i).alias("i"), _bucket(F.col("kmer"), i, width, seed).alias("bucket")) for i in range(hashes)])))
    return each.groupBy("i", "bucket").agg(F.sum("n").alias("n"))


def _bucket(kmer: Column, i: int, width: int, seed: str) -> Column:
    return F.conv(F.substr(F.md5(F.concat(F.lit(f"{seed}{i}"), kmer)), F.lit(1), F.lit(8)), 16, 10).cast("long") % width


def estimate(words: DataFrame, table: DataFrame, width: int, hashes: int = 3, seed: str = "s") -> DataFrame:
    """words(kmer) with ``n``: never less than the true count."""
    each = words.select("kmer", F.inline(F.array(*[F.struct(F.lit(i).alias("i"), _bucket(F.col("kmer"), i, width, seed).alias("bucket")) for i in range(hashes)])))
    return each.join(table, ["i", "bucket"], "left").groupBy("kmer").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))


def corrections(seqs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """name, pos and base: a base is wrong where a k-mer at least ``high`` deep is followed by one at most ``low`` deep, and one other last base alone makes that k-mer at least ``high`` deep."""
    rows = seqs.select("name", F.posexplode(S.kmers(F.upper("seq"), k)).alias("at", "w")).where(F.col("w").rlike(f"^[ACGT]{{{k}}}$"))
    depth = codes.counted(seqs, k).groupBy("kmer").agg(F.sum("n").alias("d")).select(codes.letters(F.col("kmer"), k).alias("kmer"), "d")
    deep = rows.withColumn("kmer", S.canonical(F.col("w"))).join(depth, "kmer").select("name", "at", "w", "d")
    weak = deep.where(F.col("d") <= low).join(deep.where(F.col("d") >= high).select("name", (F.col("at") + 1).alias("at")), ["name", "at"])
    other = weak.select("name", "at", "w", F.explode(F.array(*map(F.lit, "ACGT"))).alias("base")).where(F.col("base") != F.right("w", F.lit(1)))
    tried = other.withColumn("kmer", S.canonical(F.concat(F.substr("w", F.lit(1), F.lit(k - 1)), "base"))).join(depth.where(F.col("d") >= high), "kmer")
    return tried.groupBy("name", "at").agg(F.count("*").alias("_n"), F.min("base").alias("base")).where("_n = 1").select("name", (F.col("at") + k - 1).cast("long").alias("pos"), "base")


def despiked(depths: DataFrame) -> DataFrame:
    """depths(name, pos, depth) with ``fixed``: where a place is deeper (or shallower) than both its neighbours, the greater (the lesser) of these; neighbours are found by their numbers."""
    near = lambda step, c: depths.select("name", (F.col("pos") + step).alias("pos"), F.col("depth").alias(c))
    both = depths.join(near(1, "_l"), ["name", "pos"], "left").join(near(-1, "_r"), ["name", "pos"], "left")
    low, high = F.least("_l", "_r"), F.greatest("_l", "_r")
    inner = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return both.withColumn("fixed", F.when(inner & (F.col("depth") > high), high).when(inner & (F.col("depth") < low), low).otherwise(F.col("depth"))).drop("_l", "_r")


def peak_stats(peaks: DataFrame, histogram: DataFrame) -> DataFrame:
    """kmers (of the histogram), main (the centre of the highest peak) and size (all k-mer places from its start on over the main depth): peaks(centre, height, start), histogram(depth, kmers)."""
    best = peaks.agg(F.max_by("centre", F.struct("height", -F.col("centre"))).alias("main"), F.min("start").alias("_start"))
    return histogram.join(F.broadcast(best), F.lit(True)).groupBy("main").agg(F.sum("kmers").alias("kmers"), F.sum(F.when(F.col("depth") >= F.col("_start"), F.col("depth") * F.col("kmers"))).alias("_places")).select("kmers", "main", F.floor(F.col("_places") / F.col("main")).alias("size"))  # one row


# ----------------------------------------------------------------- best of reads


def unique_best(rows: DataFrame) -> DataFrame:
    """read, ref, score and gap (to the next best, null where there is none): the best hit of each read of hits(read, ref, score), ties to the smaller subject."""
    order = Window.partitionBy("read").orderBy(F.desc("score"), "ref")
    ranked = rows.withColumn("_n", F.row_number().over(order)).withColumn("_next", F.lead("score").over(order))
    return ranked.where("_n = 1").select("read", "ref", "score", (F.col("score") - F.col("_next")).alias("gap"))


def fill_windows(points: DataFrame, most_width: int, most_rows: int) -> DataFrame:
    """points(chrom, pos, id) of windows of ``most_width`` places, the first ``most_rows`` by id of each; a cap that is the feature."""
    held = points.withColumn("window", F.floor(F.col("pos") / most_width) * most_width)
    return held.withColumn("_n", F.row_number().over(Window.partitionBy("chrom", "window").orderBy("id"))).where(F.col("_n") <= most_rows).drop("_n")
