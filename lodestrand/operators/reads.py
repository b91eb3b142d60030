"""Read-level filters and joins over classified reads and alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions.seq import trim_read_no


def threshold(rows: DataFrame, least: float) -> DataFrame:
    """Rows under the score keep no hits: rows(…, score, hits)."""
    return rows.withColumn("hits", F.when(F.col("score") < least, F.array().cast(rows.schema["hits"].dataType)).otherwise(F.col("hits")))


def extract_pairs(mates: DataFrame, cut: float, wanted: Column | None = None) -> DataFrame:
    """All mates of mates(name, score, size, …) of the pairs in which a mate scores under the cut (of its pair's bases, for cuts under 1) or is wanted."""
    pair = Window.partitionBy("name")
    limit = F.lit(float(cut)) if cut >= 1 else cut * F.sum("size").over(pair)
    low = F.max((F.col("score") < limit).cast("int")).over(pair)
    held = mates.withColumn("_limit", limit).withColumn("_low", F.max((F.col("score") < F.col("_limit")).cast("int")).over(pair)) if cut < 1 else mates.withColumn("_low", low)
    held = held.withColumn("_want", F.max(F.coalesce(wanted, F.lit(False)).cast("int")).over(pair) if wanted is not None else F.lit(0))
    return held.where("_low = 1 or _want = 1").select(*mates.columns)


def extract_unmapped(mates: DataFrame, cut: float, wanted: Column | None = None, mark: bool = False, skip_marked: bool = False) -> DataFrame:
    """name (with its mate number), comment, seq and qual of the pairs of mates(name, mate, score, seq, qual, tag) in which one scores under the cut or is wanted.

    ``mark``: mates that reach the cut get the comment IGNORE; ``skip_marked``: mates whose tag is IGNORE are left out.
    """
    pair = Window.partitionBy("name")
    low = F.max((F.col("score") < cut).cast("int")).over(pair)
    want = F.max(F.coalesce(wanted, F.lit(False)).cast("int")).over(pair) if wanted is not None else F.lit(0)
    held = mates.withColumn("_low", low).withColumn("_want", want).where("_low = 1 or _want = 1")
    if skip_marked:
        held = held.where(~F.col("tag").eqNullSafe(F.lit("IGNORE")))
    comment = F.when(F.col("score") >= cut, "IGNORE").otherwise("") if mark else F.lit("")
    return held.select(F.concat(F.col("name").cast("string"), F.lit("/"), F.col("mate").cast("string")).alias("name"), comment.alias("comment"), "seq", "qual")


def without_reads(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows(name, …) whose name, without mate number, is not in ids(id)."""
    blocked = ids.select(trim_read_no(F.col("id")).alias("_id")).distinct()
    return rows.join(blocked, trim_read_no(F.col("name")) == F.col("_id"), "left_anti")


def pair_up(rows: DataFrame, order: str, file: str, block: int = 65_536) -> DataFrame:
    """rows(name, …) with ``mate``: 64 or 128 for neighbours of the same name in a file, else 0.  ``order`` numbers a file's rows.

    A file is cut into blocks of ``block`` numbers; what a block must know of its neighbours comes from a table of one row a block.
    """
    cut = rows.withColumn("_b", trim_read_no(F.col("name"))).withColumn("_k", F.floor(F.col(order) / block))
    at = Window.partitionBy(file, "_k").orderBy(order)
    runs = cut.withColumn("_new", (~F.lag("_b").over(at).eqNullSafe(F.col("_b"))).cast("int")).withColumn("_run", F.sum("_new").over(at))
    placed = runs.withColumn("_n", F.row_number().over(Window.partitionBy(file, "_k", "_run").orderBy(order))).withColumn("_next", F.lead("_b").over(at)).withColumn("_end", F.lead(F.lit(1)).over(at).isNull())
    # of each block: its first and last name, the length of its last run, and whether that is the whole block
    blocks = placed.groupBy(file, "_k").agg(F.min_by("_b", order).alias("_first"), F.max_by("_b", order).alias("_last"), F.max_by("_n", order).alias("_tail"), (F.max("_run") == 1).alias("_one"))
    by_file = Window.partitionBy(file).orderBy("_k")
    joined = blocks.withColumn("_goes", F.lag("_last").over(by_file).eqNullSafe(F.col("_first")) & (F.lag(F.lit(1)).over(by_file).isNotNull()))
    chain = joined.withColumn("_c", F.sum((~(F.col("_one") & F.col("_goes"))).cast("int")).over(by_file)).withColumn("_held", F.sum("_tail").over(Window.partitionBy(file, "_c").orderBy("_k")))
    known = chain.select(F.col(file).alias("_f"), F.col("_k").alias("_kk"), F.when(F.col("_goes"), F.lag("_held").over(by_file)).otherwise(0).alias("_before"), F.lead("_first").over(by_file).alias("_after"))
    whole = placed.join(known, F.col(file).eqNullSafe(F.col("_f")) & (F.col("_k") == F.col("_kk")))
    place = F.col("_n") + F.when(F.col("_run") == 1, F.col("_before")).otherwise(0)
    last = ~F.when(F.col("_end"), F.col("_after")).otherwise(F.col("_next")).eqNullSafe(F.col("_b"))
    mate = F.when(last & (place % 2 == 1), 0).when(place % 2 == 1, 64).otherwise(128)
    return whole.withColumn("mate", mate).select(*rows.columns, "mate")


def repair(left: DataFrame, right: DataFrame, order: str = "seq") -> DataFrame:
    """Mates of two disordered tables(name, seq) side by side: of a name, the n-th rows (in ``order``) of both tables are a pair; singles have a null side."""
    n = F.row_number().over(Window.partitionBy("name").orderBy("_o"))
    a, b = (df.select(trim_read_no(F.col("name")).alias("name"), F.col("seq").alias(seq), F.col(order).alias("_o")).withColumn("_n", n).drop("_o") for df, seq in ((left, "seq1"), (right, "seq2")))
    return a.join(b, ["name", "_n"], "full_outer").drop("_n")


def top_share(hits: DataFrame, share: float) -> DataFrame:
    """hits(read, …, score) at or over ``share`` of the read's best."""
    best = F.max("score").over(Window.partitionBy("read"))
    return hits.withColumn("_best", best).where(F.col("score") >= share * F.col("_best")).drop("_best")


def capped(hits: DataFrame, most: int, tie: str) -> DataFrame:
    """The ``most`` best hits of each read."""
    order = Window.partitionBy("read").orderBy(F.desc("score"), tie)
    return hits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")


def best_on_targets(alignments: DataFrame, targets: DataFrame) -> DataFrame:
    """Reads of alignments(read, ref, score) whose best score (ties too) falls on targets(ref)."""
    best = F.max("score").over(Window.partitionBy("read"))
    return alignments.withColumn("_best", best).where("score = _best").join(targets, "ref", "left_semi").select("read").distinct()


def filter_contigs(alignments: DataFrame, on_target: DataFrame, least_mapq: float = 10, excluded: int = 1796) -> DataFrame:
    """Reads to keep of alignments(read, ref, flag, mapq) of reads on contigs: unmapped, or on a contig of on_target(ref, flag), the contigs aligned to the target region, whose mean mapping quality reaches the least; all, where no contig is aligned there."""
    aligned = on_target.where(F.col("flag").bitwiseAND(4) == 0).select("ref").distinct()
    quality = alignments.where(F.col("flag").bitwiseAND(excluded) == 0).groupBy("ref").agg(F.avg("mapq").alias("_q"))
    good = aligned.join(quality, "ref", "left").where(F.coalesce("_q", F.lit(0.0)) >= least_mapq).select("ref", F.lit(True).alias("_ok"))
    some = aligned.agg((F.count("*") > 0).alias("_some"))
    held = alignments.join(good, "ref", "left").join(F.broadcast(some), F.lit(True))  # one row
    return held.where("_ok or not _some or (flag & 4) <> 0").select("read").distinct()


def read_targets(alignments: DataFrame, least_score: float, least_share: float) -> DataFrame:
    """Rows of alignments(read, score, size, …) that score ``least_score`` or more, and that share of their length or more."""
    return alignments.where((F.col("score") >= least_score) & (F.col("size") > 0) & (F.col("score") >= least_share * F.col("size")))


def only_reads(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows(name, …) whose name is in ids(id), mate numbers aside."""
    wanted = ids.select(trim_read_no(F.col("id")).alias("_id")).distinct()
    return rows.join(wanted, trim_read_no(F.col("name")) == F.col("_id"), "left_semi")


def contig_to_taxa(read_hits: DataFrame, contig_taxa: DataFrame, least: float) -> DataFrame:
    """read and taxa (array, in order of contig, repeats kept) of read_hits(read, contig, score) over ``least``, through contig_taxa(contig, tid)."""
    found = read_hits.where(F.col("score") > least).join(contig_taxa, "contig")
    return found.groupBy("read").agg(F.transform(F.array_sort(F.collect_list(F.struct("contig", "tid"))), lambda x: x.tid).alias("taxa"))


def one_of_each(rows: DataFrame, by: str, key: str, seed: str = "10086") -> DataFrame:
    """One row of each group, drawn by a seeded hash of its key."""
    order = Window.partitionBy(by).orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key)
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def new_sequences(seqs: DataFrame, existing: DataFrame, seq: str = "seq") -> DataFrame:
    """seqs whose sequence, on either strand, is not in existing."""
    from lodestrand.functions.seq import strand_key

    known = existing.select(strand_key(F.col(seq)).alias("_k")).distinct()
    return seqs.join(known, strand_key(F.col(seq)) == F.col("_k"), "left_anti")
