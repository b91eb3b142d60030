"""Votes by column: the consensus of clumps of reads, adapters from what lies behind inserts, and mates merged by quality.

Votes are rows of (group, place, base) with the sum of their qualities, summed
up by task before they are shuffled, so a clump of any size costs a few rows a
place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators import rearrange


def winners(votes: DataFrame, by: list[str], least_share: float = 0.0) -> DataFrame:
    """by, place, base, weight and share of votes(by, place, base, weight): the base of the greatest weight of each place (of equal ones, the first letter), N where its share is under ``least_share``."""
    sums = votes.groupBy(*by, "place", "base").agg(F.sum("weight").alias("weight"))
    # of a place there are as many rows as letters
    best = sums.groupBy(*by, "place").agg(F.max(F.struct(F.col("weight"), (-F.ascii("base")).alias("_first"), F.col("base"))).alias("_b"), F.sum("weight").alias("_all"))
    share = F.col("_b.weight") / F.col("_all")
    return best.select(*by, "place", F.when(share >= least_share, F.col("_b.base")).otherwise("N").alias("base"), F.col("_b.weight").alias("weight"), F.round(share, 6).alias("share"))


def clump_votes(reads: DataFrame, k: int, offset: int = 33) -> DataFrame:
    """pivot, place, base and weight (the quality of a base, 1 without a qual) of reads(seq[, qual]), laid on each other by their pivot k-mers, reads of the other strand turned around; place 0 is where the pivot begins."""
    held = rearrange.pivots(reads, k).where("pivot is not null")
    own = F.substr(F.upper("seq"), F.col("place") + 1, F.lit(k))
    held = held.withColumn("_turn", own != F.col("pivot"))
    bases = F.when(F.col("_turn"), S.reverse_complement(F.upper("seq"))).otherwise(F.upper("seq"))
    begin = F.when(F.col("_turn"), F.length("seq") - F.col("place") - k).otherwise(F.col("place"))
    held = held.withColumns({"_bases": S.each_letter(bases), "_begin": begin})
    if "qual" in reads.columns:
        held = held.withColumn("_signs", S.each_letter(F.when(F.col("_turn"), F.reverse("qual")).otherwise(F.col("qual"))))
        weight: Column = F.ascii(F.get("_signs", F.col("_i"))) - offset
    else:
        weight = F.lit(1)
    each = held.select("pivot", "_begin", *(["_signs"] if "qual" in reads.columns else []), F.posexplode("_bases").alias("_i", "base"))
    return each.where("base in ('A', 'C', 'G', 'T')").select("pivot", (F.col("_i") - F.col("_begin")).cast("long").alias("place"), "base", weight.cast("long").alias("weight"))


def clump_consensus(reads: DataFrame, k: int, least_share: float = 0.0) -> DataFrame:
    """pivot, start (of place 0, at or under 0) and seq: the winning bases of each clump of reads, N where no read has one."""
    won = winners(clump_votes(reads, k), ["pivot"], least_share)
    held = won.groupBy("pivot").agg(F.min("place").alias("start"), F.max("place").alias("_end"), F.map_from_entries(F.collect_list(F.struct("place", "base"))).alias("_m"))
    gaps = F.col("_end") - F.col("start") + 1 > F.size("_m")
    whole = F.transform(F.array_sort(F.map_entries("_m")), lambda e: e["value"])
    filled = F.transform(F.sequence("start", "_end"), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit("N")))
    return held.select("pivot", "start", F.array_join(F.when(gaps, filled).otherwise(whole), "").alias("seq"))


def adapters(pairs: DataFrame, longest: int, least_share: float = 0.5) -> DataFrame:
    """side (1, 2), place, base, weight and share of pairs(seq1, seq2, insert): what stands behind the insert of mates that read past it, as far as ``longest`` bases."""
    sides = []
    for side, seq in ((1, "seq1"), (2, "seq2")):
        tail = S.each_letter(F.substr(F.upper(seq), F.col("insert") + 1, F.lit(longest)))
        sides.append(pairs.where((F.col("insert") >= 0) & (F.col("insert") < F.length(seq))).select(F.lit(side).alias("side"), F.posexplode(tail).alias("place", "base")))
    votes = sides[0].unionByName(sides[1]).withColumn("weight", F.lit(1).cast("long"))
    return winners(votes, ["side"], least_share)


def adapter_sequences(won: DataFrame) -> DataFrame:
    """side and adapter: the winning bases of adapters' rows up to the first N."""
    held = won.groupBy("side").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "base"))), lambda x: x["base"]), "").alias("_s"))
    return held.select("side", F.substring_index("_s", "N", 1).alias("adapter"))


def merged_by_quality(pairs: DataFrame, offset: int = 33, most: int = 41) -> DataFrame:
    """pairs(seq1, qual1, seq2, qual2, ...) with overlap, merged and merged_qual: in the overlap the base of the greater quality stands (the first mate's of equal ones), with the sum of both qualities (``most`` at most) where they agree, their difference where not; null where mates do not overlap."""
    held = rearrange.merge_mates(pairs)
    n = F.col("overlap")
    other, other_qual = S.reverse_complement(F.col("seq2")), F.reverse("qual2")
    left = F.length("seq1") - n

    def joined(a: pa.Array, p: pa.Array, b: pa.Array, q: pa.Array) -> pa.Array:
        sizes = np.array(pc.fill_null(pc.utf8_length(a), 0), np.int64)
        texts: list[list[str]] = [[], []]
        step = max(1, rearrange.LETTERS // max(1, int(sizes.max(initial=0))))
        for i in range(0, len(a), step):
            own = sizes[i : i + step]
            a_, p_, b_, q_ = (rearrange.letter_codes(x.slice(i, step), int(own.max(initial=0))).astype(np.int64) for x in (a, p, b, q))
            base = np.where(p_ >= q_, a_, b_)
            sign = offset + np.where(a_ == b_, np.minimum(p_ + q_ - 2 * offset, most), np.abs(p_ - q_))
            inside = np.arange(base.shape[1])[None, :] < own[:, None]
            ends = np.cumsum(own).tolist()
            for out, letters in zip(texts, (base, sign)):
                whole = letters[inside].astype(np.uint32).tobytes().decode("utf-32-le")
                out += [whole[x:y] for x, y in zip([0, *ends[:-1]], ends)]
        return pa.StructArray.from_arrays([pa.array(t, pa.string()) for t in texts], names=["base", "sign"])

    both = F.arrow_udf(joined, "base string, sign string")(F.substr("seq1", left + 1, n), F.substr("qual1", left + 1, n), F.substr(other, F.lit(1), n), F.substr(other_qual, F.lit(1), n))
    held = held.withColumn("_j", both)
    merged = F.concat(F.substr("seq1", F.lit(1), left), F.col("_j.base"), F.substr(other, n + 1))
    qual = F.concat(F.substr("qual1", F.lit(1), left), F.col("_j.sign"), F.substr(other_qual, n + 1))
    return held.withColumns({"merged": F.when(n.isNotNull(), merged), "merged_qual": F.when(n.isNotNull(), qual)}).drop("_j")


def in_clumps(reads: DataFrame, k: int) -> DataFrame:
    """pivot and reads: how many reads each clump has."""
    return rearrange.pivots(reads, k).where("pivot is not null").groupBy("pivot").agg(F.count("*").alias("reads"))


def share_changed(reads: DataFrame, k: int) -> DataFrame:
    """pivot, votes and lost: how many bases of a clump's reads are not those of its consensus."""
    votes = clump_votes(reads, k).groupBy("pivot", "place", "base").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    order = Window.partitionBy("pivot", "place").orderBy(F.desc("weight"), "base")
    ranked = votes.withColumn("_n", F.row_number().over(order))
    return ranked.groupBy("pivot").agg(F.sum("n").alias("votes"), F.sum(F.when(F.col("_n") > 1, F.col("n")).otherwise(0)).alias("lost"))
