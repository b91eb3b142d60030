"""k-mer tables: counting, matching, quantification, sketches, duplicates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lodestrand.functions import codes
from lodestrand.functions import seq as S
from lodestrand.functions.codes import explode
from lodestrand.operators.work import keep

#: Sketches that are compared at once, of either side.
BLOCK = 512
#: So many blocks of a side meet in a task.
BLOCKS = 16


def counts(seqs: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """kmer and n over all sequences."""
    summed = codes.counted(seqs, k, seq).groupBy("kmer").agg(F.sum("n").alias("n"))
    return summed.select(codes.letters(F.col("kmer"), k).alias("kmer"), "n")


def histogram(kmer_counts: DataFrame) -> DataFrame:
    """depth and how many k-mers have it."""
    return kmer_counts.groupBy(F.col("n").alias("depth")).agg(F.count("*").alias("kmers"))


def unique_estimate(seqs: DataFrame, k: int) -> DataFrame:
    return explode(seqs, k).agg(F.approx_count_distinct("kmer").alias("kmers"))


def match(reads: DataFrame, refs: DataFrame, k: int, least: int = 1, substitutions: int = 0) -> DataFrame:
    """name and hits: reads with at least ``least`` k-mers of refs; the references' k-mers up to so many ``substitutions`` away count too."""
    known = explode(refs, k).select("kmer").distinct()
    for _ in range(substitutions):
        known = known.select(F.explode(codes.neighbours(F.col("kmer"), k)).alias("kmer")).select(codes.canonical(F.col("kmer"), k).alias("kmer")).distinct()
    return explode(reads, k).join(known, "kmer", "left_semi").groupBy("name").agg(F.count("*").alias("hits")).where(F.col("hits") >= least)


def mask(reads: DataFrame, refs: DataFrame, k: int) -> DataFrame:
    """reads(name, seq) with every base under a k-mer of refs as N, and of quality 0 (``!``) if there is a qual."""
    hit = explode(reads, k).join(explode(refs, k).select("kmer").distinct(), "kmer", "left_semi").groupBy("name").agg(F.array_sort(F.collect_list("pos")).alias("_at"))
    at, far = F.col("_at"), lambda a, b: F.coalesce(b - a > k, F.lit(True))
    # runs of hits no more than k apart, and the text between them
    begins = F.filter(at, lambda p, i: (i == 0) | far(F.get(at, i - 1), p))
    stops = F.filter(at, lambda p, i: far(p, F.get(at, i + 1)))
    held = reads.join(hit, "name", "left").withColumn("_from", begins).withColumn("_to", F.transform(stops, lambda p: p + k))
    until = lambda i: F.when(i == 0, 0).otherwise(F.get("_to", i - 1))
    pieces = F.transform("_from", lambda p, i: F.concat(F.substr("seq", until(i) + 1, p - until(i)), F.repeat(F.lit("N"), F.get("_to", i) - p)))
    masked = F.concat(F.array_join(pieces, ""), F.substr("seq", F.element_at("_to", -1) + 1))
    if "qual" in reads.columns:
        flat = F.transform("_from", lambda p, i: F.concat(F.substr("qual", until(i) + 1, p - until(i)), F.repeat(F.lit("!"), F.get("_to", i) - p)))
        low = F.concat(F.array_join(flat, ""), F.substr("qual", F.element_at("_to", -1) + 1))
        held = held.withColumn("qual", F.when(at.isNull(), F.col("qual")).otherwise(low))
    return held.withColumn("seq", F.when(at.isNull(), F.col("seq")).otherwise(masked)).drop("_at", "_from", "_to")


def match_long(reads: DataFrame, refs: DataFrame, k: int, long: int, least: int = 1) -> DataFrame:
    """name and hits: how many stretches of ``long`` bases of a read have all their k-mers among those of refs (for words too long for a code)."""
    hit = explode(reads, k).join(explode(refs, k).select("kmer").distinct(), "kmer", "left_semi").select("name", "pos")
    # places of a run differ from their rank by one number
    run = hit.withColumn("_run", F.col("pos") - F.row_number().over(Window.partitionBy("name").orderBy("pos")))
    runs = run.groupBy("name", "_run").agg(F.count("*").alias("_n")).where(F.col("_n") > long - k)
    return runs.groupBy("name").agg(F.sum(F.col("_n") - (long - k)).alias("hits")).where(F.col("hits") >= least)


def trim_tips(reads: DataFrame, refs: DataFrame, shortest: int, longest: int) -> DataFrame:
    """reads without the longest end (of ``shortest`` to ``longest`` bases) that is the beginning of a sequence of refs."""
    sizes = F.sequence(F.lit(shortest), F.lit(longest))
    heads = refs.select(F.explode(F.transform(sizes, lambda m: F.when(F.length("seq") >= m, F.substr("seq", F.lit(1), m)))).alias("_tip")).where("_tip is not null").distinct()
    ends = reads.select("name", F.explode(F.transform(sizes, lambda m: F.when(F.length("seq") >= m, F.right("seq", m)))).alias("_tip")).where("_tip is not null").distinct()
    cut = ends.join(heads, "_tip", "left_semi").groupBy("name").agg(F.max(F.length("_tip")).alias("_cut"))
    return reads.join(cut, "name", "left").withColumn("seq", F.when(F.col("_cut").isNull(), F.col("seq")).otherwise(F.substr("seq", F.lit(1), F.length("seq") - F.col("_cut")))).drop("_cut")


def trim(reads: DataFrame, refs: DataFrame, k: int, side: str = "right") -> DataFrame:
    """reads cut at their first reference k-mer (right) or after their last (left)."""
    hit = explode(reads, k).join(explode(refs, k).select("kmer").distinct(), "kmer", "left_semi").groupBy("name").agg(F.min("pos").alias("_a"), F.max("pos").alias("_b"))
    cut = F.substr("seq", F.lit(1), F.col("_a")) if side == "right" else F.substr("seq", F.col("_b") + k + 1)
    return reads.join(hit, "name", "left").withColumn("seq", F.when(F.col("_a").isNull(), F.col("seq")).otherwise(cut)).drop("_a", "_b")


def best_reference(reads: DataFrame, refs: DataFrame, k: int, ambiguous: str = "all", clearzone: int = 0) -> DataFrame:
    """name, ref, hits and n_refs: the references that share most k-mers with a read (within ``clearzone`` hits of the best); ambiguous: all, first (smallest ref) or toss."""
    known = explode(refs, k).select("kmer", F.col("name").alias("ref")).distinct()
    shared = explode(reads, k).join(known, "kmer").groupBy("name", "ref").agg(F.count("*").alias("hits"))
    own = Window.partitionBy("name")
    best = shared.withColumn("_best", F.max("hits").over(own)).where(F.col("hits") >= F.col("_best") - clearzone).withColumn("n_refs", F.count("*").over(own))
    if ambiguous == "toss":
        best = best.where("n_refs = 1")
    if ambiguous == "first":
        best = best.withColumn("_n", F.row_number().over(own.orderBy(F.desc("hits"), "ref"))).where("_n = 1").drop("_n")
    return best.drop("_best")


def reference_stats(best: DataFrame) -> DataFrame:
    """ref, reads, sole_reads (with no other reference as good) and hits of best_reference's rows."""
    return best.groupBy("ref").agg(F.count("*").alias("reads"), F.sum((F.col("n_refs") == 1).cast("long")).alias("sole_reads"), F.sum("hits").alias("hits"))


def sketch(seqs: DataFrame, k: int, size: int) -> DataFrame:
    """name and hashes: the ``size`` smallest md5 values of a sequence's distinct k-mers, in order."""
    each = codes.smallest_hashes(seqs, k, size).distinct()
    order = Window.partitionBy("name").orderBy("h")
    return each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= size).groupBy("name").agg(F.array_sort(F.collect_list("h")).alias("hashes"))


def compare(left: DataFrame, right: DataFrame | None = None, least: int = 1, sizes: bool = False) -> DataFrame:
    """a, b and shared (with ``sizes`` also size_a and size_b, their numbers of hashes) of sketches(name, hashes: different ones) with at least that many hashes in common; without ``right``, of pairs a < b of left.

    Hashes are numbered in the order of how often they occur (by powers of two). Two sketches that share ``least`` of them share one of all but the
    last ``least`` - 1 of each in that order, so they meet under those alone and frequent hashes lie behind. They take their other shared hashes
    along, as numbers, and are compared where they meet; a pair is given under its first common hash alone, so that only results leave the task.
    A hash of more than BLOCKS times BLOCK sketches is cut into blocks of so many that meet pairwise, where BLOCK rows are compared with BLOCK at once.
    """
    sides = [left.withColumn("side", F.lit(0))] + ([] if right is None else [right.withColumn("side", F.lit(1))])
    listed = reduce(DataFrame.unionByName, [s.select("side", "name", "hashes") for s in sides])
    hashes = listed.select("side", F.explode("hashes").alias("h"))
    n = hashes.groupBy("h").agg(F.sum((F.col("side") == 0).cast("long")).alias("n0"), F.sum((F.col("side") == 1).cast("long")).alias("n1"))
    # what only one has, or one side, is shared by none
    n = n.where("n0 > 1" if right is None else "n0 > 0 and n1 > 0")
    order = F.shiftleft(F.floor(F.log2(F.col("n0") + F.col("n1"))).cast("long"), 58).bitwiseOR(F.monotonically_increasing_id())
    blocks = lambda c: F.ceil(F.col(c) / (BLOCK * BLOCKS)).cast("int")
    numbered = keep(n.select("h", order.alias("id"), blocks("n0").alias("left"), blocks("n0" if right is None else "n1").alias("right")), "hashes")
    held = listed.select("side", "name", F.size("hashes").alias("size"), F.explode("hashes").alias("h")).join(numbered, "h").groupBy("side", "name").agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("id", "left", "right"))).alias("_in"))
    # of the order of all hashes those that none shares come first: the last least - 1 are the last shared ones
    held = held.where(F.size("_in") >= least).select("side", "name", "size", F.col("_in.id").alias("ids"), F.explode(F.slice("_in", 1, F.size("_in") - (least - 1))).alias("_h"))
    own = F.pmod(F.xxhash64("name"), F.when(F.col("side") == 0, F.col("_h.left")).otherwise(F.col("_h.right"))).cast("int")
    others = F.when(F.col("side") == 0, F.col("_h.right")).otherwise(F.col("_h.left"))
    met = held.select("side", "name", "size", "ids", F.col("_h.id").alias("id"), own.alias("_own"), F.explode(F.sequence(F.lit(0), others - 1)).alias("_other"))
    if right is None:
        place = F.when(F.col("_own") == F.col("_other"), 2).otherwise((F.col("_own") > F.col("_other")).cast("int"))
        met = met.select(place.alias("side"), "name", "size", "ids", "id", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"))
    else:
        met = met.select("side", "name", "size", "ids", "id", F.when(F.col("side") == 0, F.col("_own")).otherwise(F.col("_other")).alias("i"), F.when(F.col("side") == 0, F.col("_other")).otherwise(F.col("_own")).alias("j"))
    cells = met.groupBy("id", "i", "j").agg(F.collect_list(F.struct("side", "name", "ids", "size")).alias("rows")).where("size(rows) > 1").select("id", "rows")
    kind = left.schema["name"].dataType
    out = cells.mapInArrow(_shared(least, BLOCK), StructType([StructField("a", kind), StructField("b", kind), StructField("shared", LongType()), StructField("size_a", IntegerType()), StructField("size_b", IntegerType())]))
    if right is None:
        turned = lambda x, y: F.when(F.col("a") <= F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x)
        out = out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared", turned("size_a", "size_b"), turned("size_b", "size_a"))
    return out if sizes else out.select("a", "b", "shared")


def _shared(least: int, block: int):
    """From cells (id, rows(side, name, ids, size)): a, b, shared and both sizes of rows of side 0 and 1 (2: both) whose least common number is id."""

    def chunk(key: int, a: np.ndarray, b: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of rows a and rows b of a cell (one list for pairs within it): those that are given, and what they share."""
        same = a is b
        rows = a if same else np.r_[a, b]
        n = at[rows + 1] - at[rows]
        mine = ids[np.repeat(at[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        row = np.repeat(np.arange(len(rows)), n)
        found, column, times = np.unique(mine, return_inverse=True, return_counts=True)
        # numbers that one row has alone are shared with none
        use = times > 1
        place = np.cumsum(use) - 1
        table = np.zeros((len(rows), max(1, int(use.sum()))), np.float32)
        kept = use[column]
        table[row[kept], place[column[kept]]] = 1
        before = table[:, : int(np.count_nonzero(use & (found < key)))]
        first, second = slice(0, len(a)), slice(0 if same else len(a), None)
        shared = table[first] @ table[second].T
        fits = shared >= least
        if before.shape[1]:
            fits &= before[first] @ before[second].T == 0
        if same:
            fits = np.triu(fits, 1)
        x, y = np.nonzero(fits)
        return a[x], b[y], shared[x, y].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            flat, cuts = rows.flatten(), rows.offsets.to_numpy() - rows.offsets[0].as_py()
            side, names, lists, sizes = (flat.field(i) for i in range(4))
            side, at, ids = side.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            for key, first, last in zip(batch.column(0).to_numpy(), cuts[:-1], cuts[1:]):
                own = side[first:last]
                parts = lambda x: [x[i : i + block] for i in range(0, len(x), block)]
                left, both = parts(first + np.flatnonzero(own != 1)), (own == 2).any()
                right = left if both else parts(first + np.flatnonzero(own != 0))
                for i, a in enumerate(left):
                    for b in right[i:] if both else right:
                        x, y, shared = chunk(key, a, b, at, ids)
                        if len(x):
                            take = lambda column, i: column.take(pa.array(i))
                            yield pa.RecordBatch.from_arrays([take(names, x), take(names, y), pa.array(shared), take(sizes, x), take(sizes, y)], names=["a", "b", "shared", "size_a", "size_b"])

    return run


def similarity(compared: DataFrame, k: int) -> DataFrame:
    """compare's rows (with sizes) with containment (the part of a's hashes that b has), jaccard and identity (what k-mers unchanged in that part leave of a base, containment ** (1 / k)); they are not joined with the sketches."""
    inside = F.col("shared") / F.col("size_a")
    return compared.select("a", "b", "shared", F.round(inside, 6).alias("containment"), F.round(F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared")), 6).alias("jaccard"), F.round(F.pow(inside, F.lit(1.0 / k)), 6).alias("identity"))


def depths(seqs: DataFrame, k: int) -> DataFrame:
    """name, low, median, high (25th, 54th and 90th percentile places) and n of the depths of a read's k-mers, deepest first."""
    rows = explode(seqs, k)
    counted = codes.counted(seqs, k).groupBy("kmer").agg(F.sum("n").alias("d"))
    deep = rows.join(counted, "kmer").groupBy("name").agg(F.sort_array(F.collect_list("d"), asc=False).alias("c"))
    at = lambda share: F.element_at("c", F.least(F.floor(F.size("c") * share).cast("int") + 1, F.size("c")))
    return deep.select("name", at(0.90).alias("low"), at(0.54).alias("median"), at(0.25).alias("high"), F.size("c").cast("long").alias("n"))


def normalise(seqs: DataFrame, k: int, target: int, least: int = 1, seed: str = "1") -> DataFrame:
    """Names of reads to keep so that depth comes down to target: all with a median depth up to target (and at least ``least``), others with probability target / depth by a seeded hash."""
    d = depths(seqs, k).where(F.col("median") >= least)
    coin = (F.conv(F.substr(F.md5(F.concat(F.lit(seed), F.col("name").cast("string"))), F.lit(1), F.lit(8)), 16, 10).cast("long") % F.col("median")) + 1
    return d.where((F.col("median") <= target) | (coin <= target)).select("name")


def exact_duplicates(seqs: DataFrame) -> DataFrame:
    """One of each group of sequences that are equal on either strand: the smallest name, and how many there are."""
    return seqs.groupBy(S.strand_key(F.upper("seq")).alias("_k")).agg(F.min("name").alias("name"), F.count("*").alias("copies")).drop("_k")


def common(seqs: DataFrame, k: int, most: int) -> DataFrame:
    """name, kmer, n: the most frequent k-mers of each sequence."""
    n = explode(seqs, k).groupBy("name", "kmer").agg(F.count("*").alias("n"))
    order = Window.partitionBy("name").orderBy(F.desc("n"), "kmer")
    return n.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).select("name", codes.letters(F.col("kmer"), k).alias("kmer"), "n")
