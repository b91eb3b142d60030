"""Scores of hits over mates, partitions of references and subjects, and tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_of_subjects(hits: DataFrame, share: float = 0.0) -> DataFrame:
    """read, ref and score: the best hit of hits(read, ref, score) on each subject, of those that reach ``share`` of the read's best."""
    best = hits.groupBy("read", "ref").agg(F.max("score").alias("score"))
    return best.withColumn("_top", F.max("score").over(Window.partitionBy("read"))).where(F.col("score") >= share * F.col("_top")).drop("_top")


def pair_scores(first: DataFrame, second: DataFrame, dropout: float = 0.0) -> DataFrame:
    """pair, ref and score: the sum of both mates' best scores on a subject (one mate's, where the other has none), of those that reach ``dropout`` of the pair's best."""
    a = best_of_subjects(first).withColumnsRenamed({"read": "pair", "score": "_a"})
    b = best_of_subjects(second).withColumnsRenamed({"read": "pair", "score": "_b"})
    both = a.join(b, ["pair", "ref"], "full_outer").select("pair", "ref", (F.coalesce("_a", F.lit(0.0)) + F.coalesce("_b", F.lit(0.0))).alias("score"))
    return both.withColumn("_top", F.max("score").over(Window.partitionBy("pair"))).where(F.col("score") >= dropout * F.col("_top")).drop("_top")


def mate_sums(mates: DataFrame) -> DataFrame:
    """mates(pair, mate, ref, score) with ``sum``: both mates' scores where both hit the subject, else the mate's own."""
    own = Window.partitionBy("pair", "ref")
    return mates.withColumn("sum", F.when(F.size(F.collect_set("mate").over(own)) > 1, F.sum("score").over(own)).otherwise(F.col("score")))


def united(parts: list[DataFrame], share: float) -> DataFrame:
    """read, ref and score of hits(read, ref, score) against several parts of a reference collection: the best on each subject, of those that reach ``share`` of the best over all parts.  The parts need no order."""
    every = parts[0].select("read", "ref", "score")
    for p in parts[1:]:
        every = every.unionByName(p.select("read", "ref", "score"))
    return best_of_subjects(every, share)


def map_lengths(m8: DataFrame, lengths: DataFrame) -> DataFrame:
    """qid, length (of the query), mapped (places of it under its best hit, the first in order), ratio, place (by mapped places, greatest first), bases (mapped up to it), nc50 (whether it is the first to reach half of all bases of the queries).

    m8(line, qid, qs, qe, bits), lengths(qid, length).  Running sums go over distinct lengths, of which there are few, and then over names.
    """
    first = m8.groupBy("qid").agg(F.min_by(F.struct("qs", "qe"), "line").alias("h"))
    rows = first.join(lengths, "qid").select("qid", "length", (F.abs(F.col("h.qe") - F.col("h.qs")) + 1).alias("mapped"))
    sizes = rows.groupBy("mapped").agg(F.count("*").alias("_n"))
    down = Window.orderBy(F.desc("mapped")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each length
    before = sizes.select("mapped", F.coalesce(F.sum(F.col("_n") * F.col("mapped")).over(down), F.lit(0)).alias("_bases"), F.coalesce(F.sum("_n").over(down), F.lit(0)).alias("_rows"))
    total = lengths.agg(F.sum("length").alias("_all"))
    same = F.row_number().over(Window.partitionBy("mapped").orderBy("qid"))
    out = rows.withColumn("_i", same).join(before, "mapped").join(F.broadcast(total), F.lit(True))  # one row
    bases = F.col("_bases") + F.col("_i") * F.col("mapped")
    half = (2 * bases >= F.col("_all")) & (2 * (bases - F.col("mapped")) < F.col("_all"))
    return out.select("qid", "length", "mapped", F.round(F.col("mapped") / F.col("length"), 9).alias("ratio"), (F.col("_rows") + F.col("_i")).cast("long").alias("place"), bases.cast("long").alias("bases"), half.alias("nc50"))


def aligned_report(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """tid, clade and stay of rows(line, tid, aligned): all alignments at or under a node, and its own in the last line that names it."""
    known = rows.join(tree, "tid")
    clade = known.groupBy(F.col("ancestor").alias("tid")).agg(F.sum("aligned").alias("clade"))
    stay = rows.groupBy("tid").agg(F.max_by("aligned", "line").alias("stay"))
    return clade.join(stay, "tid", "left").select(F.col("tid").cast("long").alias("tid"), "clade", F.coalesce("stay", F.lit(0)).cast("long").alias("stay"))
