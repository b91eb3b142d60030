"""Quality control of reads(name, seq, qual, …): a chain of filters and trims in a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S


def quality_trim(reads: DataFrame, average_error: float, offset: int = 33) -> DataFrame:
    """reads cut to their best stretch."""
    held = reads.withColumn("_t", S.optimal_trim(F.col("qual"), average_error, offset))
    part = lambda c: F.substr(c, F.col("_t.start") + 1, F.col("_t.size"))
    return held.withColumn("seq", part("seq")).withColumn("qual", part("qual")).drop("_t")


def filters(reads: DataFrame, least: int = 0, most: int | None = None, most_n: int | None = None, low_gc: float = 0.0, high_gc: float = 1.0, least_quality: int = 0, least_entropy: float = 0.0, offset: int = 33) -> DataFrame:
    """reads with a column ``ok``."""
    s = F.col("seq")
    ok = (F.length(s) >= least) & S.gc(s).between(low_gc, high_gc)
    if most is not None:
        ok = ok & (F.length(s) <= most)
    if most_n is not None:
        ok = ok & (S.count_of(s, "Nn") <= most_n)
    if least_quality:
        ok = ok & (S.average_quality(F.col("qual"), offset) >= least_quality)
    if least_entropy:
        ok = ok & (S.entropy(s) >= least_entropy)
    return reads.withColumn("ok", F.coalesce(ok, F.lit(False)))


def base_rules(reads: DataFrame, most_run: int | None = None, least_share: float = 0.0, chastity: bool = False, barcodes: list[str] | None = None) -> DataFrame:
    """reads(name, seq, …) with ``ok``: no base more than ``most_run`` times in a row, each of A, C, G, T at least that share, and by the names: passed by the machine (no ``:Y:`` in the comment), and of one of the barcodes."""
    s = F.upper("seq")
    ok = F.length(s) > 0
    if most_run is not None:
        ok = ok & ~s.rlike("|".join(f"{b}{{{most_run + 1}}}" for b in "ACGTN"))
    if least_share:
        ok = ok & (F.least(*[S.count_of(s, b) for b in "ACGT"]) >= least_share * F.length(s))
    if chastity:
        ok = ok & ~F.col("name").rlike(r"\s[12]:Y:")
    if barcodes:
        ok = ok & F.regexp_extract("name", r"([^:]*)$", 1).isin(*barcodes)
    return reads.withColumn("ok", F.coalesce(ok, F.lit(False)))


def traits(reads: DataFrame) -> DataFrame:
    """One row on reads(number, name, seq, qual): offset of the qualities (33 or 64), interleaved (every two neighbours of one name, by number), longest, and letters (dna, rna or protein)."""
    low = F.min(F.when(F.length("qual") > 0, F.array_min(F.transform(F.split(F.regexp_replace("qual", "(?<=.)(?=.)", "\x00"), "\x00"), lambda c: F.ascii(c)))))
    per = reads.select(F.floor(F.col("number") / 2).alias("_two"), S.trim_read_no(F.col("name")).alias("_b")).groupBy("_two").agg(F.count("*").alias("_n"), F.min("_b").alias("_l"), F.max("_b").alias("_m"))
    pairs = per.agg(F.coalesce(F.min(((F.col("_n") == 2) & (F.col("_l") == F.col("_m"))).cast("int")), F.lit(0)).alias("_all"))
    kind = F.when(F.max(F.upper("seq").rlike("[EFILPQ*]").cast("int")) == 1, "protein").when(F.max(F.upper("seq").contains("U").cast("int")) == 1, "rna").otherwise("dna")
    whole = reads.agg(F.when(low < 59, 33).otherwise(64).alias("offset"), F.max(F.length("seq")).cast("long").alias("longest"), kind.alias("letters"))
    return whole.join(F.broadcast(pairs), F.lit(True)).select("offset", (F.col("_all") == 1).alias("interleaved"), "longest", "letters")  # one row


def keep_pairs(reads: DataFrame, both_bad: bool = False) -> DataFrame:
    """reads(name, …, ok) of the pairs with no bad mate (or, with both_bad, not only bad mates)."""
    pair = Window.partitionBy(S.trim_read_no(F.col("name")))
    fine = F.max("ok") if both_bad else F.min("ok")
    return reads.withColumn("_ok", fine.over(pair)).where("_ok").drop("_ok", "ok")


def singletons(reads: DataFrame) -> DataFrame:
    """Good mates of pairs with a bad one."""
    pair = Window.partitionBy(S.trim_read_no(F.col("name")))
    return reads.withColumn("_ok", F.min("ok").over(pair)).where("ok and not _ok").drop("_ok", "ok")
