"""k-mer depth rules over reads: classes, errors, clusters of overlaps, peaks of histograms."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import codes
from lodestrand.functions import seq as S
from lodestrand.operators import kmers
from lodestrand.operators.work import discard, keep, settled


def depth_classes(seqs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """name and ``file``: low (median depth under ``low``), mid, or high (over ``high``); reads without a k-mer are low."""
    d = kmers.depths(seqs, k).select("name", "median")
    kind = F.when(F.coalesce("median", F.lit(0)) < low, "low").when(F.col("median") > high, "high").otherwise("mid")
    return seqs.select("name").join(d, "name", "left").select("name", kind.alias("file"))


def errors(seqs: DataFrame, k: int, ratio: float, low: int, high: int) -> DataFrame:
    """name and errors: how many neighbouring k-mers of a read differ in depth as an error makes them: one at least ``high`` deep, the other at most ``low`` and ``ratio`` times shallower."""
    n = codes.counted(seqs, k).groupBy("kmer").agg(F.sum("n").alias("d"))
    more, less = F.greatest("d", "_next"), F.least("d", "_next")
    wrong = (more >= high) & (less <= low) & (more >= ratio * less)
    if k == 31:
        # two neighbours are no code: the neighbour of a place is found by its number
        deep = codes.explode(seqs, k).join(n, "kmer").select("name", "pos", "d")
        both = deep.join(deep.select("name", (F.col("pos") - 1).alias("pos"), F.col("d").alias("_next")), ["name", "pos"])
        return both.where(wrong).groupBy("name").agg(F.count("*").alias("errors"))
    # two neighbours are one k-mer of a base more: depths are told to the different ones, and only the name of a place meets those that count
    pairs = codes.counted(seqs, k + 1).select("kmer").distinct()
    sides = pairs.select("kmer", codes.canonical(F.shiftright("kmer", 2), k).alias("_a"), codes.canonical(F.col("kmer").bitwiseAND(F.lit(4**k - 1)), k).alias("_b"))
    both = sides.join(n.withColumnRenamed("kmer", "_a"), "_a").join(n.select(F.col("kmer").alias("_b"), F.col("d").alias("_next")), "_b")
    return codes.explode(seqs, k + 1).join(both.where(wrong).select("kmer"), "kmer", "left_semi").groupBy("name").agg(F.count("*").alias("errors"))


def clusters(seqs: DataFrame, k: int) -> DataFrame:
    """name and cluster (the smallest name): sequences whose beginning or end of k bases, on either strand, stands in another one."""
    rows = seqs.where(F.length("seq") >= k).select("name", F.upper("seq").alias("seq"))
    ends = F.explode(F.array(F.substr("seq", F.lit(1), F.lit(k)), F.substr("seq", F.length("seq") - k + 1, F.lit(k))))
    if k <= 31:
        # as numbers, 8 bytes a word; as everywhere, words with other letters than ACGT are none
        tips = codes.explode(rows.select("name", ends.alias("seq")), k).select(F.col("kmer").alias("w")).distinct()
        words = codes.explode(rows, k).select(F.col("name").alias("b"), F.col("kmer").alias("w"))
    else:
        tips = rows.select(ends.alias("tip")).select(S.canonical(F.col("tip")).alias("w")).distinct()
        words = rows.select(F.col("name").alias("b"), F.explode(F.array_distinct(S.canonical_kmers(F.col("seq"), k))).alias("w"))
    # all words are shuffled once; what is kept are those that are an end of some sequence
    held = keep(words.join(tips, "w", "left_semi").distinct(), "words")
    # of all sequences with a word the smallest stands for the others, so that no pairs within a group arise
    least = held.groupBy("w").agg(F.min("b").alias("m"))
    edges = held.join(least, "w").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    rooted = components(edges).withColumnsRenamed({"node": "name"})
    discard(held)
    return rows.select("name").join(rooted, "name", "left").select("name", F.coalesce("root", "name").alias("cluster"))


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node) of edges(a, b): every node takes the least of its neighbours' roots, roots follow their own roots; each round a written table, until nothing changes; the tables of rounds that are over are deleted."""
    return settled(lambda: _rooted(edges), "components")


def _rooted(edges: DataFrame) -> DataFrame:
    both = keep(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    now = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(now.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        step = now.join(near, "node").select("node", F.least("root", "_near").alias("root"))
        # a root that has itself a smaller root passes it on
        jump = step.join(step.select(F.col("node").alias("root"), F.col("root").alias("_up")), "root", "left").select("node", F.least("root", F.coalesce("_up", "root")).alias("root"))
        new = keep(jump, "roots")
        if new.join(now.withColumnRenamed("root", "_was"), "node").where("root <> _was").isEmpty():
            return new
        discard(now)
        now = new


def longest_of(clustered: DataFrame) -> DataFrame:
    """The longest sequence (of equal ones that of the smallest name) of each cluster of clustered(name, seq, cluster)."""
    order = Window.partitionBy("cluster").orderBy(F.desc(F.length("seq")), "name")
    return clustered.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def smoothed(histogram: DataFrame, radius: int) -> DataFrame:
    """depth and kmers averaged over the depths up to ``radius`` away (absent ones count as 0); a histogram is a row for each depth."""
    reach = histogram.select("kmers", F.explode(F.sequence(F.col("depth") - radius, F.col("depth") + radius)).alias("depth")).where("depth > 0")
    wide = reach.groupBy("depth").agg((F.sum("kmers") / (2 * radius + 1)).alias("kmers"))
    return wide.join(histogram.select("depth"), "depth", "left_semi")


def peaks(histogram: DataFrame, least_height: int, least_depth: int = 2) -> DataFrame:
    """centre, height, start and stop of the peaks of histogram(depth, kmers): a depth with more k-mers than any other between the valleys on its two sides, which are its lowest places towards the neighbouring peaks.

    A histogram is a row for each depth, so it is ordered in one task.
    """
    order = Window.orderBy("depth")
    turned = histogram.where(F.col("depth") >= least_depth).withColumn("_l", F.lag("kmers").over(order)).withColumn("_r", F.lead("kmers").over(order))
    top = turned.where((F.col("kmers") >= least_height) & (F.col("kmers") > F.coalesce("_l", F.lit(-1))) & (F.col("kmers") >= F.coalesce("_r", F.lit(-1))))
    return top.select(F.col("depth").alias("centre"), F.col("kmers").alias("height"), F.coalesce(F.lag("depth").over(order), F.lit(least_depth)).alias("start"), F.lead("depth").over(order).alias("stop"))


def true_qualities(pairs: DataFrame) -> DataFrame:
    """quality, bases, wrong and measured (the Phred value of the share that is wrong, one error added) of pairs(quality, right)."""
    n = pairs.groupBy("quality").agg(F.count("*").alias("bases"), F.sum((~F.col("right")).cast("long")).alias("wrong"))
    return n.withColumn("measured", F.round(-10 * F.log10((F.col("wrong") + 1) / (F.col("bases") + 1)), 6))


def recalibrated(qualities: DataFrame, measured: DataFrame) -> DataFrame:
    """qualities(quality, …) with ``new``: the measured quality of the same stated one, rounded, else the stated one; a row for each quality."""
    table = measured.select("quality", F.round("measured").cast("int").alias("_m"))
    return qualities.join(F.broadcast(table), "quality", "left").withColumn("new", F.coalesce("_m", F.col("quality").cast("int"))).drop("_m")


def merged_peaks(points: list[tuple[int, int]], least_height: int, least_depth: int, least_rise: float) -> list[dict[str, int]]:
    """centre, height, start, stop (the valleys beside it) and volume of the peaks of (depth, kmers) in order.

    A peak is a rise and fall. While there is one that does not stand ``least_rise`` times over the higher of its two valleys, the one that
    rises least is merged with the neighbour behind that valley, until all stand out; then those under ``least_height`` go.
    """
    held = [(d, n) for d, n in points if d >= least_depth]
    n, tops, i = [x for _, x in held], [], 0
    while i < len(n):
        j = i
        while j + 1 < len(n) and n[j + 1] == n[i]:
            j += 1
        if (i == 0 or n[i - 1] < n[i]) and (j + 1 == len(n) or n[j + 1] < n[i]):
            tops.append(i)
        i = j + 1
    # the lowest place between two tops, the first of several, parts them
    cuts = [min(range(a, b), key=lambda x: (n[x], x)) for a, b in zip(tops, tops[1:])]
    found = [[a, c, z] for a, c, z in zip([0, *cuts], tops, [*cuts, len(n) - 1])]
    while len(found) > 1:
        def valley(j: int) -> tuple[int, int]:
            """(height of the higher valley of peak j, the neighbour behind it)"""
            sides = [(n[found[j][0]], j - 1)] * (j > 0) + [(n[found[j][2]], j + 1)] * (j + 1 < len(found))
            return max(sides, key=lambda s: (s[0], -s[1]))

        rise, j = min((n[p[1]] / max(1, valley(j)[0]), j) for j, p in enumerate(found))
        if rise >= least_rise:
            break
        a, b = sorted((j, valley(j)[1]))
        centre = max(found[a][1], found[b][1], key=lambda i: (n[i], -i))
        found[a : b + 1] = [[found[a][0], centre, found[b][2]]]
    out = [{"centre": held[c][0], "height": held[c][1], "start": held[a][0], "stop": held[z][0], "volume": sum(n[a:z] if z + 1 < len(n) else n[a:])} for a, c, z in found]
    return [p for p in out if p["height"] >= least_height]


def called_peaks(histogram: DataFrame, least_height: int = 2, least_depth: int = 2, least_rise: float = 1.2) -> DataFrame:
    """merged_peaks of histogram(depth, kmers), which has a row for each depth and is read in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = sorted((d, n) for b in batches for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        yield pa.RecordBatch.from_pylist(merged_peaks(points, least_height, least_depth, least_rise) if points else [], schema=pa.schema([(c, pa.int64()) for c in ("centre", "height", "start", "stop", "volume")]))

    rows = histogram.select(F.col("depth").cast("long").alias("depth"), F.col("kmers").cast("long").alias("kmers")).coalesce(1)
    return rows.mapInArrow(run, "centre long, height long, start long, stop long, volume long")


def genome_traits(peaks: DataFrame, k: int) -> DataFrame:
    """main (the centre of the peak of greatest volume), half (the highest peak at 0.4 to 0.6 of it, if any), ploidy (2 where there is one, else 1), size (k-mers under all peaks, each as often as its depth is of the main one) and heterozygosity (the rate of changed bases that puts the half peak's share of k-mers into it)."""
    main = peaks.agg(F.max_by("centre", F.struct("volume", -F.col("centre"))).alias("main"))
    held = peaks.join(F.broadcast(main), F.lit(True))  # one row
    half = (F.col("centre") >= 0.4 * F.col("main")) & (F.col("centre") <= 0.6 * F.col("main"))
    copies = F.greatest(F.round(F.col("centre") / F.col("main")), F.lit(1.0))
    sums = held.groupBy("main").agg(F.max_by(F.when(half, F.col("centre")), F.when(half, F.col("height"))).alias("half"), F.sum(F.when(half, F.col("volume"))).alias("_h"), F.sum(F.when(F.col("centre") == F.col("main"), F.col("volume"))).alias("_m"), F.sum(F.when(~half, F.col("volume") * copies)).alias("_rest"))
    # a changed place makes k k-mers of each copy different: half of the half peak's k-mers are of each
    odd = F.coalesce(F.col("_h"), F.lit(0)) / 2
    rate = 1 - F.pow(F.col("_m") / (F.col("_m") + odd), F.lit(1.0 / k))
    return sums.select("main", "half", F.when(F.col("half").isNull(), 1).otherwise(2).alias("ploidy"), F.floor(F.col("_rest") + odd).alias("size"), F.round(rate, 8).alias("heterozygosity"))
