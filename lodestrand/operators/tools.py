"""Table tools over reads(name, seq, …): choosing, naming, dealing, ordering and marking them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S


def _coin(key: Column, seed: str) -> Column:
    """A number of 32 bits by a seeded hash of the key."""
    return F.conv(F.substr(F.md5(F.concat(F.lit(seed), key.cast("string"))), F.lit(1), F.lit(8)), 16, 10).cast("long")


def reformat(reads: DataFrame, least: int = 0, most: int | None = None, complement: bool = False, underscores: bool = False, upper: bool = False, offset_in: int = 33, offset_out: int = 33, left: int = 0, right: int | None = None, share: float = 1.0, seed: str = "1") -> DataFrame:
    """reads(name, seq, qual) sampled by name, cut to the places from left to right (inclusive), turned to the other strand, renamed and re-encoded, then filtered by length."""
    seq, qual = S.force_trim(F.col("seq"), left, right), S.force_trim(F.col("qual"), left, right)
    if complement:
        seq, qual = S.reverse_complement(seq), F.reverse(qual)
    if upper:
        seq = F.upper(seq)
    if offset_in != offset_out:
        old = "".join(map(chr, range(offset_in, offset_in + 42)))
        qual = F.translate(qual, old, "".join(map(chr, range(offset_out, offset_out + 42))))
    name = F.regexp_replace("name", r"\s+", "_") if underscores else F.col("name")
    kept = reads.where(_coin(S.trim_read_no(F.col("name")), seed) < share * 2.0**32) if share < 1 else reads
    out = kept.withColumn("_s", seq).withColumn("_q", qual).withColumn("name", name).withColumn("seq", F.col("_s")).withColumn("qual", F.col("_q")).drop("_s", "_q")
    out = out.where(F.length("seq") >= least)
    return out.where(F.length("seq") <= most) if most is not None else out


def numbered(rows: DataFrame, order: str, ranges: int = 256) -> DataFrame:
    """rows with ``number``, from 0 in the order of a numeric column; counted by ranges of it first, so no task orders the whole table."""
    # at most ``ranges`` numbers
    cuts = rows.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    ranged = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col(order))))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return ranged.withColumn("_at", inside).join(F.broadcast(starts), "_range").withColumn("number", F.col("_start") + F.col("_at") - 1).drop("_range", "_at", "_start")


def rename(reads: DataFrame, prefix: str, order: str) -> DataFrame:
    """reads with the names prefix_0, prefix_1, … in order."""
    return numbered(reads, order).withColumn("name", F.concat(F.lit(prefix + "_"), F.col("number").cast("string"))).drop("number")


def by_number(rows: DataFrame, order: str, numbers: list[int]) -> DataFrame:
    """The rows of these numbers in order."""
    return numbered(rows, order).where(F.col("number").isin(*numbers)).drop("number")


def between(rows: DataFrame, order: str, first: int, last: int) -> DataFrame:
    """Rows first to last (inclusive, from 0) in order."""
    return numbered(rows, order).where(F.col("number").between(first, last)).drop("number")


def dealt(rows: DataFrame, order: str, ways: int) -> DataFrame:
    """rows with ``file``: in turn 0 to ways - 1."""
    return numbered(rows, order).withColumn("file", (F.col("number") % ways).cast("int")).drop("number")


def shuffled(rows: DataFrame, name: str, seed: str = "1") -> DataFrame:
    """rows with ``place``: a seeded pseudo-random number of their name, by which pairs stay together when written in its order."""
    return rows.withColumn("place", _coin(S.trim_read_no(F.col(name).cast("string")), seed))


def muxed(files: dict[str, DataFrame]) -> DataFrame:
    """All rows(name, …) of the named files, each name led by its file's."""
    out = None
    for file, rows in files.items():
        one = rows.withColumn("name", F.concat(F.lit(file + "_"), F.col("name").cast("string")))
        out = one if out is None else out.unionByName(one)
    return out


def with_headers(reads: DataFrame, headers: DataFrame, order: str) -> DataFrame:
    """reads with the names of headers(name, order) of the same number in order; reads beyond the last header keep theirs."""
    new = numbered(headers, order).select("number", F.col("name").alias("_new"))
    return numbered(reads, order).join(new, "number", "left").withColumn("name", F.coalesce("_new", F.col("name").cast("string"))).drop("_new", "number")


def filter_lines(lines: DataFrame, words: DataFrame, include: bool = True, substring: bool = False) -> DataFrame:
    """Distinct-safe filter of lines(line) that equal (or, with substring, contain) a word of words(word); a short list of words."""
    known = words.select("word").where("word <> ''").distinct()
    if not substring:
        return lines.join(known, lines.line == known.word, "left_semi" if include else "left_anti")
    found = known.agg(F.collect_list("word").alias("_words"))  # the user's list
    hit = F.exists("_words", lambda w: F.contains(F.col("line"), w))
    return lines.join(F.broadcast(found), F.lit(True)).where(hit if include else ~hit).select(*lines.columns)


def demux_by_name(reads: DataFrame, words: DataFrame, unknown: str = "unknown") -> DataFrame:
    """reads with ``file``: the first (in order) word of words(word), a short list, that their names hold."""
    listed = words.agg(F.array_sort(F.collect_set("word")).alias("_words"))  # the user's list
    held = F.get(F.filter("_words", lambda w: F.contains(F.col("name"), w)), F.lit(0))
    return reads.join(F.broadcast(listed), F.lit(True)).withColumn("file", F.coalesce(held, F.lit(unknown))).drop("_words")


# ------------------------------------------------------------------- barcodes


def barcode(name: Column) -> Column:
    """The last field of a read's name after a colon, mate number aside."""
    return F.regexp_extract(S.trim_read_no(name), r"([^:]*)$", 1)


def count_barcodes(reads: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """barcode, reads and valid (of A, C, G, T with + between), and with known(barcode) whether it is one of them."""
    n = reads.groupBy(barcode(F.col("name")).alias("barcode")).agg(F.count("*").alias("reads")).withColumn("valid", F.col("barcode").rlike("^[ACGT]+(\\+[ACGT]+)?$"))
    if known is None:
        return n
    return n.join(known.select("barcode", F.lit(True).alias("known")).distinct(), "barcode", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def good_barcodes(reads: DataFrame) -> DataFrame:
    """reads whose barcode is proper."""
    return reads.where(barcode(F.col("name")).rlike("^[ACGT]+(\\+[ACGT]+)?$"))


def merge_barcodes(reads: DataFrame, codes: DataFrame, order: str) -> DataFrame:
    """reads with the sequences of codes(order, seq) of the same number in order at the end of their names."""
    code = numbered(codes, order).select("number", F.col("seq").alias("_code"))
    return numbered(reads, order).join(code, "number", "left").withColumn("name", F.concat_ws(":", F.col("name").cast("string"), "_code")).drop("_code", "number")


# -------------------------------------------------------------- pairs, cutting


def split_pairs(reads: DataFrame, least: int) -> DataFrame:
    """reads with ``file``: pair where both mates have ``least`` bases, single for the long mate of a short one and for reads without a mate, short for the rest."""
    own = Window.partitionBy(S.trim_read_no(F.col("name").cast("string")))
    long = F.length("seq") >= least
    kept = reads.withColumn("_long", F.sum(long.cast("int")).over(own))
    return kept.withColumn("file", F.when(~long, "short").when(F.col("_long") >= 2, "pair").otherwise("single")).drop("_long")


def cut_between(reads: DataFrame, left: str, right: str, include: bool = False) -> DataFrame:
    """reads cut to what lies between the first ``left`` and the first ``right`` behind it; reads without both are left out."""
    a = F.locate(left, F.col("seq"))
    b = F.instr(F.substr("seq", a + len(left)), F.lit(right))
    begin, size = (a, F.col("_b") + len(left) + len(right) - 1) if include else (a + len(left), F.col("_b") - 1)
    held = reads.where(a > 0).withColumn("_b", b).where("_b > 0")
    return held.withColumn("seq", F.substr("seq", begin, size)).drop("_b")


def split_at_linker(reads: DataFrame, linker: str) -> DataFrame:
    """name, part (1, 2) and seq: what stands before and behind the first linker; reads without one are part 0."""
    at = F.locate(linker, F.col("seq"))
    parts = F.array(F.struct(F.lit(1).alias("part"), F.substr("seq", F.lit(1), at - 1).alias("seq")), F.struct(F.lit(2).alias("part"), F.substr("seq", at + len(linker)).alias("seq")))
    whole = F.array(F.struct(F.lit(0).alias("part"), F.col("seq")))
    return reads.select("name", F.inline(F.when(at > 0, parts).otherwise(whole)))


def trim_by_overlap(pairs: DataFrame) -> DataFrame:
    """Mates of pairs(…, seq1, seq2, insert) cut to their insert size where that is shorter."""
    cut = lambda c: F.when(F.col("insert").isNotNull() & (F.col("insert") < F.length(c)), F.substr(c, F.lit(1), F.col("insert"))).otherwise(F.col(c))
    return pairs.withColumn("seq1", cut("seq1")).withColumn("seq2", cut("seq2"))


def window_trim(reads: DataFrame, window: int, least: float, offset: int = 33) -> DataFrame:
    """reads cut before the first window of ``window`` bases whose mean error probability exceeds that of the quality ``least``; reads shorter than a window stay."""
    limit = window * 10.0 ** (-least / 10)
    over = lambda p: F.filter(F.sequence(F.lit(1), F.size(p) - window + 1), lambda i: F.aggregate(F.slice(p, i, window), F.lit(0.0), lambda a, x: a + x) > limit)
    # a one-element array keeps the probabilities from being computed anew for each window
    first = F.element_at(F.transform(F.array(S.error_rates(F.col("qual"), offset)), lambda p: F.get(over(p), F.lit(0))), 1)
    held = reads.withColumn("_at", F.when(F.length("qual") >= window, first))
    part = lambda c: F.when(F.col("_at").isNull(), F.col(c)).otherwise(F.substr(c, F.lit(1), F.col("_at") - 1))
    return held.withColumn("seq", part("seq")).withColumn("qual", part("qual")).drop("_at")


# ---------------------------------------------------------- names and numbers


def with_taxid(reads: DataFrame, taxa: DataFrame) -> DataFrame:
    """reads with ``|kraken:taxid|N`` at the end of the names that are in taxa(name, tid); others stay."""
    known = taxa.select(F.col("name").alias("_n"), "tid")
    return reads.join(known, reads.name == F.col("_n"), "left").withColumn("name", F.when(F.col("tid").isNull(), F.col("name").cast("string")).otherwise(F.concat(F.col("name").cast("string"), F.lit("|kraken:taxid|"), F.col("tid").cast("string")))).drop("_n", "tid")


def gi_to_taxid(reads: DataFrame, table: DataFrame, unknown: int = -1) -> DataFrame:
    """reads named ``gi|n|…`` as ``ncbi|tid|…`` by table(gi, tid)."""
    gi = F.regexp_extract("name", r"^gi\|(\d+)\|", 1).try_cast("long")
    known = table.select(F.col("gi").alias("_g"), "tid")
    new = F.concat(F.lit("ncbi|"), F.coalesce("tid", F.lit(unknown)).cast("string"), F.regexp_extract("name", r"^gi\|\d+(\|.*)$", 1))
    return reads.withColumn("_gi", gi).join(known, F.col("_gi") == F.col("_g"), "left").withColumn("name", F.when(F.col("_gi").isNull(), F.col("name")).otherwise(new)).drop("_gi", "_g", "tid")


def with_known_accessions(records: DataFrame, acc_to_tid: DataFrame, banned: DataFrame) -> DataFrame:
    """records(header, seq) with the accessions of their headers (joined by \\x01) that have a taxon out of banned(tid), in order, joined by commas; records without one are left out."""
    each = records.select("header", F.posexplode(S.accessions(F.col("header"))).alias("at", "acc"))
    known = each.join(acc_to_tid, "acc").join(banned.select("tid").distinct(), "tid", "left_anti")
    kept = known.groupBy("header").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "acc"))), lambda x: x.acc), ",").alias("name"))
    return records.join(kept, "header").select("name", "seq")


def without_taxa(records: DataFrame, acc_to_tid: DataFrame, banned: DataFrame) -> DataFrame:
    """records(header, seq) of which no accession of the header has a taxon of banned(tid)."""
    each = records.select("header", F.explode(S.accessions(F.col("header"))).alias("acc"))
    bad = each.join(acc_to_tid, "acc").join(banned.select("tid").distinct(), "tid", "left_semi").select("header").distinct()
    return records.join(bad, "header", "left_anti")


def unpivoted(matrix: DataFrame, key: str, value: str) -> DataFrame:
    """row, column and value of a square matrix with a key column."""
    others = [c for c in matrix.columns if c != key]
    return matrix.select(F.col(key).alias("row"), F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in others])))


def both_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """row, column, a and b: the cells of two matrices side by side."""
    return unpivoted(left, key, "a").join(unpivoted(right, key, "b"), ["row", "column"])


def filter_by_coverage(contigs: DataFrame, coverage: DataFrame, least_mean: float, least_percent: float, least_reads: int, least_length: int) -> DataFrame:
    """contigs(name, seq) whose coverage(name, mean, percent, reads) and length reach the least; contigs without coverage have none."""
    known = contigs.join(coverage, "name", "left")
    ok = (F.coalesce("mean", F.lit(0.0)) >= least_mean) & (F.coalesce("percent", F.lit(0.0)) >= least_percent) & (F.coalesce("reads", F.lit(0)) >= least_reads) & (F.length("seq") >= least_length)
    return known.where(ok).select(*contigs.columns)


def across_samples(coverage: DataFrame, least: float, ratio: float) -> DataFrame:
    """contig, sample and kept: a contig of coverage(contig, home, sample, mean) stays if its own sample covers it ``least`` times, and no other sample over ``ratio`` times as deep."""
    own = F.max(F.when(F.col("sample") == F.col("home"), F.col("mean")).otherwise(0.0))
    other = F.max(F.when(F.col("sample") != F.col("home"), F.col("mean")).otherwise(0.0))
    return coverage.groupBy("contig", "home").agg(own.alias("own"), other.alias("other")).withColumn("kept", (F.col("own") >= least) & (F.col("other") <= ratio * F.col("own")))
