"""Masking of sequences: low complexity, repeats, regions, coverage; composition and codes of bases."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrand.functions import seq as S
from lodestrand.operators import intervals
from lodestrand.operators.work import keep

#: What each ambiguity code stands for.
IUPAC = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def mask_regions(seqs: DataFrame, regions: DataFrame, letter: str = "N") -> DataFrame:
    """seqs(name, seq) with the letter over regions(chrom, start, end), half-open, which may overlap; ``lower`` makes them lower case."""
    found = intervals.merge(regions).groupBy("chrom").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_r"))
    size = lambda r: F.greatest(F.least(r.end, F.length("seq").cast("long")) - r.start, F.lit(0))
    inside = lambda r: F.lower(F.substr("seq", r.start + 1, size(r))) if letter == "lower" else F.repeat(F.lit(letter), size(r).cast("int"))
    pieces = F.transform("_r", lambda r, i: F.concat(F.substr("seq", F.when(i == 0, 0).otherwise(F.get("_r", i - 1).end) + 1, F.greatest(r.start - F.when(i == 0, 0).otherwise(F.get("_r", i - 1).end), F.lit(0))), inside(r)))
    masked = F.concat(F.array_join(pieces, ""), F.substr("seq", F.element_at("_r", -1).end + 1))
    held = seqs.join(found.withColumnRenamed("chrom", "name"), "name", "left")
    return held.withColumn("seq", F.when(F.col("_r").isNull(), F.col("seq")).otherwise(masked)).drop("_r")


def windows(seqs: DataFrame, size: int, step: int) -> DataFrame:
    """name, start and tile of all windows of ``size`` bases, every ``step`` places, the last at the end of the sequence."""
    return seqs.select("name", F.inline(S.tiles(F.col("seq"), size, step))).select("name", F.col("start").cast("long").alias("start"), "tile")


def distinct_words(tile: Column, k: int) -> Column:
    """How many different k-mers a window has."""
    return F.size(F.array_distinct(S.kmers(F.upper(tile), k)))


def low_complexity(seqs: DataFrame, size: int, step: int, k: int, least: int) -> DataFrame:
    """chrom, start, end of windows with fewer than ``least`` different k-mers, merged."""
    poor = windows(seqs, size, step).where(distinct_words(F.col("tile"), k) < least)
    return intervals.merge(keep(poor.select(F.col("name").alias("chrom"), "start", (F.col("start") + size).alias("end")), "poor"))


def repeats(seqs: DataFrame, k: int, least: int) -> DataFrame:
    """chrom, start, end of runs of one unit of k bases that stands ``least`` times or more one after the other, merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text in enumerate(b.column(1)):
                letters = np.frombuffer((text.as_py() or "").encode("utf-32-le", "surrogatepass"), np.uint32)
                # places that are as the one a unit before; a run of so many places of them is one of the unit
                same = np.r_[False, letters[k:] == letters[:-k], False] if len(letters) > k else np.zeros(2, bool)
                turns = np.flatnonzero(same[1:] != same[:-1])
                first, last = turns[::2], turns[1::2]
                if least < 2:  # each unit for itself
                    first, last = (np.array([x]) for x in (0, len(letters) - k)) if len(letters) >= k else (turns, turns)
                long = last - first >= k * (least - 1)
                if long.any():
                    at = b.column(0).take(pa.array(np.full(int(long.sum()), row)))
                    yield pa.RecordBatch.from_arrays([at, pa.array(first[long]), pa.array(last[long] + k)], names=["chrom", "start", "end"])

    # the runs of a sequence are found in its own row; what is merged are runs that touch, or rows of one name
    schema = T.StructType([T.StructField("chrom", seqs.schema["name"].dataType), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return intervals.merge(keep(seqs.select("name", "seq").mapInArrow(run, schema), "repeats"))


def by_depth(runs: DataFrame, least: int, most: int | None = None) -> DataFrame:
    """chrom, start, end of depth runs under ``least`` or over ``most``."""
    bad = F.col("depth") < least
    return intervals.merge(runs.where(bad if most is None else bad | (F.col("depth") > most)).select("chrom", "start", "end"))


def composition(seqs: DataFrame) -> DataFrame:
    """name, length, a, c, g, t, other, and cpg (C before G, either strand)."""
    n = lambda b: S.count_of(F.col("seq"), b + b.lower())
    return seqs.select("name", F.length("seq").cast("long").alias("length"), n("A").alias("a"), n("C").alias("c"), n("G").alias("g"), n("T").alias("t"), F.length(F.translate("seq", "ACGTacgt", "")).cast("long").alias("other"), F.size(F.regexp_extract_all(F.upper("seq"), F.lit("(CG)"), F.lit(1))).cast("long").alias("cpg"))


def subsequences(seqs: DataFrame, regions: DataFrame) -> DataFrame:
    """name (``chrom:start-end``, from 1), seq of regions(chrom, start, end), half-open from 0, clipped to the sequence."""
    held = regions.join(seqs.select(F.col("name").alias("chrom"), "seq"), "chrom").withColumn("_e", F.least(F.col("end"), F.length("seq").cast("long"))).where("start < _e")
    return held.select(region_name(F.col("chrom"), F.col("start"), F.col("_e")).alias("name"), F.substr("seq", F.col("start") + 1, F.col("_e") - F.col("start")).alias("seq"))


def region_name(chrom: Column, start: Column, end: Column) -> Column:
    """``chrom:start-end``, from 1, both ends in it."""
    return F.concat(chrom.cast("string"), F.lit(":"), (start + 1).cast("string"), F.lit("-"), end.cast("string"))


def parse_region(text: Column) -> Column:
    """struct<chrom, start, end> (half-open, from 0) of ``chrom:start-end`` or ``chrom:start``; a bare name has no bounds."""
    parts = F.regexp_extract(text, r"^(.*):([0-9,]+)(?:-([0-9,]+))?$", 1), *[F.replace(F.regexp_extract(text, r"^(.*):([0-9,]+)(?:-([0-9,]+))?$", i), F.lit(","), F.lit("")).try_cast("long") for i in (2, 3)]
    return F.struct(F.when(parts[0] == "", text).otherwise(parts[0]).alias("chrom"), (parts[1] - 1).alias("start"), parts[2].alias("end"))


def merged_bases(seqs: DataFrame, other: DataFrame) -> DataFrame:
    """name and seq of two tables of sequences, where these are of one length: the base where both agree, its ambiguity code where they differ in A, C, G and T, N else."""
    code = {frozenset(v): k for k, v in IUPAC.items() if len(v) == 2}
    pairs = F.create_map(*[F.lit(x) for a in "ACGT" for b in "ACGT" for x in (a + b, a if a == b else code[frozenset(a + b)])])
    held = seqs.select("name", F.upper("seq").alias("a")).join(other.select("name", F.upper("seq").alias("b")), "name").where(F.length("a") == F.length("b"))
    bases = F.zip_with(S.each_letter(F.col("a")), S.each_letter(F.col("b")), lambda a, b: F.coalesce(F.try_element_at(pairs, F.concat(a, b)), F.lit("N")))
    return held.select("name", F.array_join(bases, "").alias("seq"))


def masked_by(seqs: DataFrame, masks: DataFrame, mark: str = "X") -> DataFrame:
    """seqs with N where the sequence of the same name in masks has the mark; places beyond the mask stay."""
    held = seqs.join(masks.select("name", F.col("seq").alias("_m")), "name", "left")
    new = F.zip_with(S.each_letter(F.col("seq")), F.slice(S.each_letter(F.col("_m")), F.lit(1), F.length("seq")), lambda b, m: F.when(m == mark, "N").otherwise(b))
    return held.withColumn("seq", F.when(F.col("_m").isNull(), F.col("seq")).otherwise(F.array_join(new, ""))).drop("_m")


def ambiguous_sites(seqs: DataFrame) -> DataFrame:
    """name, pos (from 0) and code of the bases that stand for two."""
    two = "".join(k for k, v in IUPAC.items() if len(v) == 2)
    each = seqs.select("name", F.posexplode(S.each_letter(F.upper("seq"))).alias("pos", "code"))
    return each.where(F.instr(F.lit(two), F.col("code")) > 0).select("name", F.col("pos").cast("long").alias("pos"), "code")


def random_bases(seqs: DataFrame, seed: str = "1") -> DataFrame:
    """seqs with a base that each ambiguity code stands for, by a seeded hash of name and place."""
    options = F.create_map(*[F.lit(x) for k, v in IUPAC.items() for x in (k, v)])

    def one(letter: Column, at: Column) -> Column:
        choice = F.try_element_at(options, F.upper(letter))
        coin = F.conv(F.substr(F.md5(F.concat_ws("/", F.lit(seed), F.col("name").cast("string"), (at + 1).cast("string"))), F.lit(1), F.lit(7)), 16, 10).cast("long")
        return F.when(choice.isNull(), letter).otherwise(F.substr(choice, (coin % F.length(choice) + 1).cast("int"), F.lit(1)))

    return seqs.withColumn("seq", F.array_join(F.transform(S.each_letter(F.col("seq")), one), ""))


def mutate(seqs: DataFrame, changes: DataFrame) -> DataFrame:
    """seqs(name, seq) with the bases of changes(name, pos from 0, base), one change a place."""
    own = changes.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct(F.col("pos").cast("int"), "base"))).alias("_c"))
    held = seqs.join(own, "name", "left")
    new = F.array_join(F.transform(S.each_letter(F.col("seq")), lambda b, i: F.coalesce(F.try_element_at(F.col("_c"), i), b)), "")
    return held.withColumn("seq", F.when(F.col("_c").isNull(), F.col("seq")).otherwise(new)).drop("_c")


def heterozygosity(seqs: DataFrame, width: int) -> DataFrame:
    """name, start, sites: the bases that stand for two in each ``width`` places."""
    return ambiguous_sites(seqs).groupBy("name", (F.floor(F.col("pos") / width) * width).alias("start")).agg(F.count("*").alias("sites"))


def pileup_reads(bases: str) -> list[tuple[str, str]]:
    """(base, insertion or deletion behind it) of each read in a pileup's base column, in its order: indels (+ or -, a number of any length, so many letters) belong to the read before them; marks of begins (with their quality sign) and ends are no reads."""
    out: list[tuple[str, str]] = []
    at, end = 0, len(bases)
    while at < end:
        sign = bases[at]
        at += 1
        if sign == "^":
            at += 1
        elif sign in "+-":
            start = at
            while at < end and bases[at].isdigit():
                at += 1
            size = int(bases[start:at] or 0)
            if out:
                out[-1] = (out[-1][0], sign + bases[at : at + size].upper())
            at += size
        elif sign in ".,*#" or sign.upper() in "ACGTN=":
            out.append((sign.upper(), ""))
    return out


def _alleles(bases: str | None) -> list[dict[str, object]] | None:
    if bases is None:
        return None
    n: Counter[str] = Counter()
    for base, indel in pileup_reads(bases):
        n[{",": ".", "#": "*"}.get(base, base)] += 1
        if indel:
            n[("I" if indel[0] == "+" else "D") + indel[1:]] += 1
    return [{"allele": a, "n": n[a]} for a in sorted(n)]


def reads_of_pileup(bases: Column) -> Column:
    """array<struct<allele, n>> of a pileup's base column: reverse strand as forward; matches are ``.``, insertions I + bases, deletions D + bases, and * and # are gone bases."""

    def parsed(column: pd.Series) -> pd.Series:
        return column.map(_alleles)

    return F.pandas_udf(parsed, "array<struct<allele:string,n:int>>")(bases)
