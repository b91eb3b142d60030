"""True qualities by matrices: counts of right and wrong bases by stated quality, place and neighbouring qualities, and what they say together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The keys of each matrix.
MATRICES = {"quality": ("q",), "place": ("pos", "q"), "before": ("before", "q"), "behind": ("q", "behind"), "both": ("before", "q", "behind")}
#: Matrices of so many rows in all are sent to every executor.
BROADCAST_ROWS = 500_000


def observed(reads: DataFrame) -> DataFrame:
    """The columns of reads but its arrays, and pos (from 0), q, before and behind (the neighbours' qualities, -1 at the ends) and right of each base of reads(quals: array<int>, right: array<boolean>, ...)."""
    at = lambda i: F.coalesce(F.get("quals", i), F.lit(-1))
    each = F.transform("quals", lambda q, i: F.struct(i.cast("long").alias("pos"), q.alias("q"), F.when(i > 0, at(i - 1)).otherwise(F.lit(-1)).alias("before"), at(i + 1).alias("behind"), F.get("right", i).alias("right")))
    return reads.select(*[c for c in reads.columns if c not in ("quals", "right")], F.inline(each))


def matrices(bases: DataFrame) -> DataFrame:
    """matrix, pos, before, q, behind (null where not of its keys), bases and wrong: all matrices in one aggregation."""
    rows = []
    for name, keys in MATRICES.items():
        rows.append(F.struct(F.lit(name).alias("matrix"), *[(F.col(c).cast("long") if c in keys else F.lit(None).cast("long")).alias(c) for c in ("pos", "before", "q", "behind")]))
    keyed = bases.select(F.explode(F.array(*rows)).alias("k"), "right").select("k.*", "right")
    return keyed.groupBy("matrix", "pos", "before", "q", "behind").agg(F.count("*").alias("bases"), F.sum((~F.col("right")).cast("long")).alias("wrong"))


def _rate(side: str) -> Column:
    return (F.col(f"{side}_wrong") + 1) / (F.col(f"{side}_bases") + 2)


def blended(bases: DataFrame, tables: DataFrame, least: int = 100) -> DataFrame:
    """bases(pos, q, before, behind, ...) with ``new``: the Phred value of the mean error rate of the fine matrices (place, both) that saw ``least`` bases or more; where neither did, that of those by one neighbour, then of the quality alone, then the stated one."""
    size = tables.count()
    out = bases
    for name, keys in MATRICES.items():
        one = tables.where((F.col("matrix") == name) & (F.col("bases") >= least)).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bases").alias(f"{name}_bases"), F.col("wrong").alias(f"{name}_wrong"))
        on = [F.col(k) == F.col(f"_{k}") for k in keys]
        out = out.join(F.broadcast(one) if size <= BROADCAST_ROWS else one, on, "left").drop(*[f"_{k}" for k in keys])

    def mean(sides: list[str]) -> Column:
        known = F.filter(F.array(*[_rate(s) for s in sides]), lambda x: x.isNotNull())
        return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))

    rate = F.coalesce(mean(["place", "both"]), mean(["before", "behind"]), mean(["quality"]), F.pow(F.lit(10.0), -F.col("q") / 10))
    return out.withColumn("new", F.round(-10 * F.log10(rate), 6)).drop(*[f"{n}_{x}" for n in MATRICES for x in ("bases", "wrong")])
