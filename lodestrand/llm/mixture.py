"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are put in a seeded permuted order and cut into blocks
of about a ``blocks``-th of all words, so there are as many blocks and shards
at any size of the input (or, if ``block_words`` is given, of that many words).  A source's target becomes whole passes over
its blocks and a last pass over the first of them; documents are taken whole,
the last one of that pass if at least half of it is before the target, so a
source's words differ from its target by half a document at most.  Source
block quotas are then split among the output shards by a binary tree: at each
node the left half's share of every source is one multivariate-hypergeometric
draw, so quotas add up exactly.  Shards draw disjoint runs of each source's
permuted list of blocks and shuffle their documents locally.

Orders come from sums over hash ranges and sums inside each range, so no
source is ordered in one task; nor is a shard, which is shuffled in parts by
ranges of the hash that orders it.  The table of sources (one row each) and the
number of blocks of each are handled by the driver.

Defined results: a null text has no words; sources go by code point, null
last; documents without words are taken with 0 words; all targets are 0 where
all sizes are; repeated rows are documents of their own; an empty table gives
no rows.  ``mix`` carries every column through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import save

WEIGHTS, MOST, SEED = (5.0, 2.0, 1.0), 3.0, 77
#: Blocks that the words of all sources are cut into (each pass of a source draws its own anew), shards they go to, and rows of a range of an order.
BLOCKS, SHARDS, RANGE_ROWS = 65_536, 64, 4_096
#: A shard is shuffled in parts of about so many words, each in one task.
PART_WORDS = 500_000
#: So many blocks (of all passes) at most are sent to every executor; more meet their documents by key.
BROADCAST_BLOCKS = 300_000
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text: str) -> Column:
    """Number of words (runs of what is not ASCII white space) of a text column."""
    bare = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(_BLANKS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("long")


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> list[float]:
    """Shares of the sum of all sizes by repeating weights; what exceeds ``most`` times a source's size is shared again by weight."""
    given = [weights[i % len(weights)] for i in range(len(sizes))]
    out, free, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while free:
        whole = sum(given[i] for i in free)
        over = [i for i in free if left * given[i] / whole > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * given[i] / whole
            break
        for i in over:
            out[i] = most * sizes[i]
        left, free = left - sum(out[i] for i in over), [i for i in free if i not in set(over)]
    return out


def split_tree(quotas: list[int], shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, source, blocks) in order of the shards: how many blocks of each source a shard gets, where it gets some."""
    rng, found = np.random.default_rng(seed), []
    sources = np.flatnonzero(np.array(quotas, np.int64))
    todo = [(0, shards, sources, np.array(quotas, np.int64)[sources])]
    while todo:
        first, n, sources, own = todo.pop()
        if n == 1 or not len(own):
            found.append((np.full(len(own), first), sources, own))
            continue
        half = n // 2
        left = rng.multivariate_hypergeometric(own, int(own.sum()) * half // n, method="marginals")
        for at, size, part in ((first + half, n - half, own - left), (first, half, left)):
            todo.append((at, size, sources[part > 0], part[part > 0]))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """shards x sources: how many blocks of each source a shard gets."""
    out = np.zeros((shards, len(quotas)), np.int64)
    shard, source, n = split_tree(quotas, shards, seed)
    out[shard, source] = n
    return out


def _starts(rows: DataFrame, range_rows: int) -> DataFrame:
    """rows with ``start``: the words before each in its source's permuted order."""
    per = rows.groupBy("source").agg(F.ceil(F.count("*") / range_rows).alias("_ranges")).withColumnRenamed("source", "_s")
    cut = F.least(F.floor((F.col("order").cast("double") / 2.0**64 + 0.5) * F.col("_ranges")), F.col("_ranges") - 1)
    dealt = rows.join(per, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_cut", cut).drop("_s", "_ranges")
    sums = dealt.groupBy("source", "_cut").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("source").alias("_s"), F.col("_cut").alias("_c"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source", "_cut").orderBy("order", "size", "row_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = dealt.withColumn("_to", F.sum("size").over(inside))
    return run.join(base, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_cut") == F.col("_c"))).withColumn("start", F.col("_base") + F.col("_to") - F.col("size")).drop("_cut", "_to", "_s", "_c", "_base")


def place(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED, block_words: int | None = None, range_rows: int = RANGE_ROWS, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """rows(row_id, source, size, order, ...), a row for each time that a document is taken: source_size, target, pass, shard and words (null pass, shard and 0 words for documents that are not taken)."""
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("n")).collect()  # one row for each source
    sums = sorted(sums, key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.n for r in sums]
    total = sum(sizes)
    block_words = block_words or max(1, -(-total // blocks))
    goal = targets(sizes, weights, most)
    plan = []
    for r, t in zip(sums, goal):
        quota = min(int(t + 0.5), int(most * r.n))
        passes = quota // r.n if r.n else 0
        plan.append((r.source, r.n, t, passes, quota - passes * r.n, -(-r.n // block_words), -(-(quota - passes * r.n) // block_words)))
    quotas = [passes * whole + part for *_, passes, _, whole, part in plan]
    shard_of, source_of, given = split_tree(quotas, shards, seed)
    per_source = spark.createDataFrame(plan, "source string, source_size long, target double, passes long, rest long, blocks long, part long")
    # Of each source the shards that draw from its permuted list of blocks, and where their runs end: no more entries than blocks.
    order = np.argsort(source_of, kind="stable")
    cuts = np.searchsorted(source_of[order], np.arange(len(plan) + 1))
    own = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    runs = spark.sparkContext.broadcast({r[0]: (shard_of[i], np.cumsum(given[i])) for r, i in zip(plan, own)})

    def deal(batches):
        for b in batches:
            out = np.zeros(len(b), np.int32)
            source, at = b.column("source").to_pylist(), b.column("at").to_numpy()
            names, which = {}, np.zeros(len(b), np.int64)
            for i, s in enumerate(source):
                which[i] = names.setdefault(s, len(names))
            by_name = np.argsort(which, kind="stable")
            ends = np.searchsorted(which[by_name], np.arange(len(names) + 1))
            for s, k in names.items():
                own, (shard, end) = by_name[ends[k] : ends[k + 1]], runs.value[s]
                out[own] = shard[np.searchsorted(end, at[own], side="right")]
            yield pa.RecordBatch.from_arrays([b.column("source"), b.column("pass"), b.column("block"), pa.array(out)], names=["_s", "_p", "_b", "shard"])

    each = per_source.select("source", "blocks", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))).alias("pass"), "passes")
    last = F.when(F.col("pass") < F.col("passes"), F.col("blocks")).otherwise(F.col("part"))
    listed = each.withColumn("_n", last).where("_n > 0").select("source", "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("block"))
    shuffled = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "pass", "block"), "pass", "block")
    drawn = save(listed.withColumn("at", F.row_number().over(shuffled).cast("long") - 1).mapInArrow(deal, "_s string, _p long, _b long, shard int"), "blocks")

    info = per_source.withColumnRenamed("source", "_i")
    started = _starts(rows, range_rows).join(F.broadcast(info), F.col("source").eqNullSafe(F.col("_i"))).drop("_i", "blocks", "part")
    again = F.when((F.col("start") < F.col("rest")) & (2 * (F.col("rest") - F.col("start")) >= F.col("size")), F.array(F.struct(F.col("passes").alias("pass"), F.col("size").alias("words"))))
    none = F.expr("cast(array() as array<struct<pass: bigint, words: bigint>>)")
    full = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), lambda p: F.struct(p.alias("pass"), F.col("size").alias("words")))).otherwise(none)
    taken = started.withColumn("_take", F.explode_outer(F.concat(full, F.coalesce(again, none))))
    flat = taken.withColumn("pass", F.col("_take.pass")).withColumn("words", F.coalesce(F.col("_take.words"), F.lit(0).cast("long"))).drop("_take", "passes", "rest")
    # a document lies in the block where it starts; those without words behind a source's last block go to that block
    block = F.least(F.floor(F.col("start") / block_words), F.floor(F.greatest(F.col("source_size") - 1, F.lit(0)) / block_words))
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("pass") == F.col("_p")) & (block == F.col("_b"))
    return flat.join(F.broadcast(drawn) if drawn.count() <= BROADCAST_BLOCKS else drawn, on, "left").drop("_s", "_p", "_b", "start", "order")


def _rows(docs: DataFrame, seed: int, *more: str) -> DataFrame:
    return docs.select("row_id", *more, F.col("source").cast("string").alias("source"), words("text").alias("size"), F.xxhash64(F.lit(seed), "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).alias("order"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED, block_words: int | None = None, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, source_size, target, taken, source and shards (where its copies go) of every document."""
    rows = save(_rows(docs.select("doc_id", "text", "source", F.monotonically_increasing_id().alias("row_id")), seed, "doc_id"), "sizes")
    placed = place(rows, weights, most, seed, block_words, RANGE_ROWS, blocks, shards)
    return placed.groupBy("row_id", "doc_id", "source", "size", "source_size", "target").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list("shard")).alias("shards")).drop("row_id")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED, block_words: int | None = None, where: str | None = None, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """The mixture: every document as often as it is taken, dealt to shards (named in a column ``where``, if given) and shuffled in each."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c.lower() in ("row_id", "_place")}
    if names:  # clashing names step aside
        back = {v: k for k, v in names.items()}
        return mix(docs.withColumnsRenamed(names), weights, most, seed, block_words, where, blocks, shards).withColumnsRenamed(back)
    held = save(docs.withColumn("row_id", F.monotonically_increasing_id()), "mix")
    sizes = save(_rows(held, seed), "sizes")
    placed = place(sizes, weights, most, seed, block_words, RANGE_ROWS, blocks, shards)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    taken = placed.where("pass is not null").select("row_id", F.struct("shard", F.xxhash64(F.lit(seed + 1), "row_id", "pass").alias("at")).alias("_place"))
    joined = held.join(taken, "row_id")
    out = joined.withColumn(where, F.col("_place.shard")) if where else joined
    # the hash that a shard is ordered by also says which part of the shard a row is in
    parts = max(1, -(-total // (shards * PART_WORDS)))
    part = F.floor((F.col("_place.at").cast("double") / 2.0**64 + 0.5) * parts)
    dealt = out.repartition(F.col("_place.shard"), part).sortWithinPartitions("_place.shard", "_place.at")
    return dealt.select(*[F.col(f"`{c}`") for c in docs.columns], *([where] if where else []))
