"""Importance resampling of documents towards a target distribution.

A text's features are its runs of 1 to ``max_run`` words, hashed into buckets.
A bucket's gain is the logarithm of how much likelier the target texts make it
than all documents do; a document's weight is the mean of its features' gains,
and the documents of the highest weight plus Gumbel noise are drawn, which is a
draw without replacement in proportion to exp(weight).

No word leaves its document's row: higher-order functions make each document's
array of buckets and sum the gains up by looking every bucket up in one literal
array of BUCKETS entries.  Only totals by bucket are shuffled (BUCKETS rows a
task at most), and for the draw only rows that reach the last score drawn,
which a histogram of the whole-number scores gives; those get their places by
ranges of their order, so no task holds more than a range.

Defined results: null texts have no words, no features and weight 0; documents
of under ``least_words`` words are scored but never drawn; null ids are drawn
after all others of the same score and hash as empty text; repeated rows each
are a document (ties of an id go by its features, then weight); without target
texts or documents all counts are nought; an empty table gives no rows; columns other
than the id and the text are ignored.
"""

from __future__ import annotations

from math import floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import save, settle

BUCKETS, MAX_RUN, LEAST_WORDS, PERCENT, SEED, SCALE = 10_000, 1, 20, 10, 2024, 1000
#: Rows of a range of the order of drawn documents.
RANGE_ROWS = 250_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """The words of a text column, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def buckets(words: str, max_run: int = MAX_RUN, of: int = BUCKETS) -> Column:
    """array<int>: the bucket of every run of 1 to max_run words, in a column of words."""
    runs = F.col(words)
    for n in range(2, max_run + 1):
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        runs = F.concat(runs, F.transform(starts, lambda i: F.array_join(F.slice(F.col(words), i, n), " ")))
    return F.transform(runs, lambda x: (F.crc32(x.cast("binary")) % of).cast("int"))


def bucket_counts(texts: DataFrame, text: str = "text", max_run: int = MAX_RUN, of: int = BUCKETS) -> dict[int, int]:
    """How many features of all texts fall in each bucket (``of`` numbers at most)."""
    # explode would make the array twice, the second time for a filter by its size
    listed = texts.select(words(text).alias("_w")).select(F.explode_outer(buckets("_w", max_run, of)).alias("_b")).where("_b is not null")
    return {r["_b"]: r["count"] for r in listed.groupBy("_b").count().collect()}


def gains(held: dict[int, int], target: dict[int, int], of: int = BUCKETS, scale: int = SCALE) -> list[int]:
    """Of each bucket floor(scale * ln(share in the target / share in the documents)), one added to every count."""
    s, t = sum(held.values()) + of, sum(target.values()) + of
    return [floor(scale * log((target.get(b, 0) + 1) * s / ((held.get(b, 0) + 1) * t))) for b in range(of)]


def scored(docs: DataFrame, gain: list[int], max_run: int = MAX_RUN, seed: int = SEED, scale: int = SCALE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    # text that is cast and split becomes one literal when the plan is made
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<int>")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), words(text).alias("_w")).select("doc_id", F.size("_w").cast("long").alias("n_words"), buckets("_w", max_run, len(gain)).alias("_b"))
    summed = F.aggregate("_b", F.lit(0).cast("long"), lambda acc, b: acc + F.element_at(table, b + 1))
    rows = rows.select("doc_id", "n_words", F.size("_b").cast("long").alias("n_features"), summed.alias("_sum"))
    weight = F.when(F.col("n_features") > 0, F.expr("(_sum - pmod(_sum, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-scale * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    return rows.select("doc_id", "n_words", "n_features", weight.alias("weight"), (weight + noise).cast("long").alias("score"))


def _last_score(rows: DataFrame, wanted: int) -> int | None:
    """The score of the last of ``wanted`` rows by falling score; scores are whole numbers of a range that does not grow with the rows."""
    left = wanted
    for r in sorted(rows.groupBy("score").count().collect(), key=lambda r: -r.score) if wanted else []:
        left -= r["count"]
        if left <= 0:
            return r.score
    return None


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, max_run: int = MAX_RUN, of: int = BUCKETS, seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null unless drawn) of every document; floor(percent / 100 of those with least_words words) are drawn. What was written on the way is deleted."""
    return settle(lambda: _ranked(docs, target, percent, least_words, max_run, of, seed, range_rows), "ranked")


def _ranked(docs: DataFrame, target: DataFrame, percent: int, least_words: int, max_run: int, of: int, seed: int, range_rows: int) -> DataFrame:
    gain = gains(bucket_counts(docs, max_run=max_run, of=of), bucket_counts(target, max_run=max_run, of=of), of)
    rows = save(scored(docs, gain, max_run, seed), "scores")
    long_enough = rows.where(F.col("n_words") >= least_words)
    wanted = long_enough.count() * percent // 100
    last = _last_score(long_enough, wanted)
    chosen = (F.col("n_words") >= least_words) & (F.col("score") >= F.lit(last)) if last is not None else F.lit(False)
    at_end = rows.where(~chosen).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    if last is None:
        return at_end
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranges = max(1, -(-(wanted + wanted // 8) // range_rows))
    # rows that are equal in all of these may fall in several ranges
    dealt = rows.where(chosen).withColumn("_own", F.monotonically_increasing_id()).repartitionByRange(ranges, *order, "_own").sortWithinPartitions(*order, "_own")
    placed = save(dealt.select("doc_id", "n_features", "weight", "score", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(2**33 - 1).alias("_at")), "drawn")
    before, starts = 0, []
    for r in sorted(placed.groupBy("_range").count().collect(), key=lambda r: r["_range"]):  # a row for each range_rows rows
        starts.append((r["_range"], before))
        before += r["count"]
    first = F.broadcast(docs.sparkSession.createDataFrame(starts, "_range int, _before long"))
    rank = F.col("_before") + F.col("_at") + 1
    ranked = placed.join(first, "_range").select("doc_id", "n_features", "weight", "score", F.when(rank <= wanted, rank).cast("long").alias("rank"))
    return at_end.unionByName(ranked)
