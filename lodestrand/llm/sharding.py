"""Proportional stratified interleaving of documents over shards (DataFrame functions only).

Rows are shuffled within each source by a seeded hash and ranked there;
(rank - u) / (rows of the source), with a seeded u of the source in (0, 1),
spreads every source evenly over [0, 1], and sorting all rows by that fraction
interleaves the sources in proportion (u keeps sources of one row apart).
Equal cuts of the sorted order give shards whose row counts differ by one at
most (law ``rows``), each with the mixture of the whole.

Ranks come from counts of hash ranges and a rank inside each range, so that no
source, however large, is ordered in one task.

Defined results: a null text has size 16 and the crc32 of no bytes; a null
source is a source of its own; equal rows are told apart by nothing and may
swap places among themselves; an empty table gives no rows; columns other than
doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import save

SHARDS, SEED, OVERHEAD = 40, 20_240, 16
#: Rows that a range of the shuffle, and of the fractions, aims at.
RANGE_ROWS = 4_096


def _draw(digits: int, *parts: Column) -> Column:
    """A number by so many hexadecimal digits of the md5 of the parts, joined by strokes (nulls as nothing)."""
    joined = F.concat(*[x for p in parts for x in (F.lit("/"), F.coalesce(p.cast("string"), F.lit("")))][1:])
    return F.conv(F.substr(F.md5(joined), F.lit(1), F.lit(digits)), 16, 10).cast("long")


def _ranked(df: DataFrame, by: list[str], part: str, order: list[Column], rank: str) -> DataFrame:
    """df with ``rank`` (from 1) in the order of ``part``, then ``order``, within ``by``; parts are small, and their counts are summed up over a table of parts."""
    sizes = df.groupBy(*by, part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, part).orderBy(*order)
    keyed = df.withColumn("_inside", F.row_number().over(inside)).alias("l").join(starts.alias("r"), [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, part]])
    return keyed.select("l.*", (F.col("_before") + F.col("_inside")).alias(rank)).drop("_inside")


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null) and source of every document."""
    bytes_of = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", "source", F.octet_length(bytes_of).cast("long").alias("_bytes"), F.crc32(bytes_of).alias("text_crc32")
    ).select("doc_id", "source", (F.col("_bytes") + OVERHEAD).alias("size"), "text_crc32", _draw(15, F.lit(seed), F.col("doc_id"), F.col("text_crc32")).alias("_hash"))
    rows = save(rows, "rows")
    counts = rows.groupBy("source").agg(F.count("*").alias("_of")).withColumn("_ranges", F.ceil(F.col("_of") / range_rows))
    total = counts.agg(F.coalesce(F.sum("_of"), F.lit(0)).alias("_all"))
    with_counts = rows.alias("l").join(counts.withColumnRenamed("source", "_s").alias("r"), F.col("l.source").eqNullSafe(F.col("_s"))).drop("_s")
    # the hash as a fraction of its range says which part of the shuffle a row falls in
    part = F.least(F.floor(F.col("_hash").cast("double") / 2.0**60 * F.col("_ranges")), F.col("_ranges") - 1)
    first = _ranked(with_counts.withColumn("_part", part), ["source"], "_part", [F.col("_hash"), F.col("doc_id"), F.col("size")], "_rank")
    n = total.first()["_all"]
    ranges = max(1, -(-n // range_rows))
    offset = (_draw(7, F.lit(seed + 1), F.col("source")) % 1_000_003 + 0.5) / 1_000_003
    share = (F.col("_rank") - offset) / F.col("_of")
    spread = first.withColumn("_share", share).withColumn("_cut", F.least(F.floor(F.col("_share") * ranges), F.lit(ranges - 1))).withColumn("_one", F.lit(1))
    placed = _ranked(spread, ["_one"], "_cut", [F.col("_share"), F.col("source"), F.col("_hash"), F.col("doc_id")], "_at")
    at = F.col("_at") - 1
    shard = F.expr(f"((_at - 1) * {shards}L) div {max(n, 1)}L")
    start = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")  # the first place of the shard
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (at - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source"
    )
