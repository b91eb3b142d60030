"""Readers of line formats into DataFrames, and writers of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators.tools import numbered


def _columns(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line")).where("line <> ''")
    return lines.withColumn("c", F.split("line", sep))


def _at(i: int, kind: str = "string") -> Column:
    return F.try_element_at(F.col("c"), F.lit(i + 1)).try_cast(kind)


def accession2taxid(spark: SparkSession, path: str) -> DataFrame:
    """acc (no version) and tid; of repeated accessions, the last line (files in order of their paths)."""
    lines = spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"))
    rows = lines.withColumn("c", F.split(F.trim("value"), r"\s+")).select(S.remove_version(_at(1)).alias("acc"), _at(2, "long").alias("tid"), "at")
    return rows.where("acc is not null and tid is not null").groupBy("acc").agg(F.max_by("tid", "at").alias("tid"))


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """tid, parent and the first word of the rank."""
    return _columns(spark, path, r"\s*\|\s*").select(_at(0, "long").alias("tid"), _at(1, "long").alias("parent"), F.split_part(_at(2), F.lit(" "), F.lit(1)).alias("rank"))


def names(spark: SparkSession, path: str) -> DataFrame:
    """tid and scientific name."""
    rows = _columns(spark, path, r"\|").where(F.col("line").contains("scientific name"))
    return rows.select(F.trim(_at(0)).cast("long").alias("tid"), F.trim(F.regexp_replace(_at(1), r"\s+", " ")).alias("name"))


def lsam(spark: SparkSession, path: str) -> DataFrame:
    """name, flag, score, seq, qual, hits (array of score and ref) and tags."""
    rows = _columns(spark, path).where(F.size("c") >= 6)
    return rows.select(_at(0).alias("name"), _at(1, "int").alias("flag"), _at(2, "double").alias("score"), _at(3).alias("seq"), _at(4).alias("qual"), S.hits(_at(5)).alias("hits"), F.slice("c", F.lit(7), F.size("c")).alias("tags"))


def m8(spark: SparkSession, path: str) -> DataFrame:
    kinds = "qid string, sid string, identity double, len long, mm long, gaps long, qs long, qe long, ss long, se long, evalue double, bits double"
    rows = _columns(spark, path, r"\s+")
    return rows.select(*[_at(i, k.split()[1]).alias(k.split()[0]) for i, k in enumerate(kinds.split(", "))])


def m8_to_lsam(rows: DataFrame) -> DataFrame:
    """name, score (the best) and hits of m8 rows; subjects joined by \\x01 are hits of their own."""
    each = rows.select("qid", "bits", F.explode(F.split("sid", "\x01")).alias("ref"))
    return each.groupBy(F.col("qid").alias("name")).agg(F.max("bits").alias("score"), F.sort_array(F.collect_list(F.struct(F.col("bits").alias("score"), "ref")), asc=False).alias("hits"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark, path).select(_at(0).alias("chrom"), _at(1, "long").alias("start"), _at(2, "long").alias("end"), _at(3).alias("name"), _at(4, "double").alias("score"), _at(5).alias("strand"), _at(6, "double").alias("fraction"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows of SAM text with their tags as map<string, string>."""
    rows = _columns(spark, path).where(~F.col("line").startswith("@"))
    named = ("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "long"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "long"), ("tlen", "long"), ("seq", "string"), ("qual", "string")
    tags = F.map_from_entries(F.transform(F.slice("c", F.lit(12), F.size("c")), lambda t: F.struct(F.substr(t, F.lit(1), F.lit(2)), F.substr(t, F.lit(6)))))
    return rows.select(*[_at(i, k).alias(n) for i, (n, k) in enumerate(named)], tags.alias("tags"))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    rows = _columns(spark, path).where(~F.col("line").startswith("#"))
    return rows.select(_at(0).alias("chrom"), _at(1, "long").alias("pos"), _at(2).alias("id"), _at(3).alias("ref"), _at(4).alias("alt"), _at(5).alias("qual"), _at(6).alias("filter"), _at(7).alias("info"), _at(8).alias("format"), _at(9).alias("sample"))


def update_frequencies(variants: DataFrame, counts: DataFrame) -> DataFrame:
    """VCF rows with ``depth`` and ``af`` from counts(chrom, pos, depth, alleles); rows without counts go."""
    joined = variants.join(counts, ["chrom", "pos"])
    return joined.withColumn("af", F.round(S.allele_frequency(F.col("ref"), F.col("alt"), F.col("depth"), F.col("alleles")), 4)).drop("alleles")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, comment and seq of FASTA files, whose records Spark splits at ``>`` after a line break."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("v")).where("v <> ''")
    head = F.regexp_replace(F.split_part("v", F.lit("\n"), F.lit(1)), "\r$", "")
    body = F.regexp_replace(F.regexp_replace("v", "^[^\n]*\n?", ""), r"\s", "")
    return rows.select(F.regexp_extract(head, r"^(\S*)", 1).alias("name"), F.regexp_extract(head, r"^\S*\s*(.*)$", 1).alias("comment"), body.alias("seq"))


def format_of(path: Column) -> Column:
    """Format by file extension, compression aside."""
    bare = F.regexp_replace(F.lower(path), r"\.(gz|bz2|zip|xz|zst)$", "")
    end = F.regexp_extract(bare, r"\.([a-z0-9]+)$", 1)
    return F.when(end.isin("fq", "fastq"), "fastq").when(end.isin("fa", "fasta", "fna", "fas", "ffn", "frn", "seq", "fsa", "faa"), "fasta").when(end.isin("sam", "bam", "bed", "vcf", "gff", "txt", "csv", "json"), end).otherwise("unknown")


def write_lsam(rows: DataFrame, path: str) -> None:
    """name, flag, score, seq, qual, hits and tags as lines."""
    hit = F.array_join(F.transform("hits", lambda h: F.concat_ws(",", h.score.cast("long"), h.ref)), ";")
    fields = [F.col("name"), F.col("flag").cast("string"), F.col("score").cast("long").cast("string"), F.coalesce("seq", F.lit("*")), F.coalesce("qual", F.lit("*")), F.when(F.size("hits") > 0, hit).otherwise("*")]
    rows.select(F.concat_ws("\t", *fields, F.when(F.size("tags") > 0, F.array_join("tags", "\t")))).write.text(path)


def write_fastx(rows: DataFrame, path: str, by: str | None = None) -> None:
    """FASTQ records (FASTA without a qual), in a folder for each value of ``by`` if given."""
    fq = F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual") if "qual" in rows.columns else F.lit(None).cast("string")
    fa = F.concat_ws("\n", F.concat(F.lit(">"), "name"), "seq")
    out = rows.select(F.coalesce(fq, fa).alias("value"), *([by] if by else []))
    (out.write.partitionBy(by) if by else out.write).text(path)


def genome(spark: SparkSession, path: str) -> DataFrame:
    """chrom and length."""
    return _columns(spark, path, r"\s+").select(_at(0).alias("chrom"), _at(1, "long").alias("length"))


def genomecov(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end (half-open) and depth."""
    return _columns(spark, path, r"\s+").select(_at(0).alias("chrom"), _at(1, "long").alias("start"), _at(2, "long").alias("end"), _at(3, "long").alias("depth"))


def aligned_taxa(spark: SparkSession, path: str, tid: int = 4, aligned: int = 8) -> DataFrame:
    """line (a growing number), tid and aligned of comma-separated rows under a header line, by the places of their columns from 0."""
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).where("value <> ''").withColumn("c", F.split("value", ","))
    return lines.select("line", _at(tid, "long").alias("tid"), _at(aligned, "long").alias("aligned")).where("tid is not null and aligned is not null")


def write_table(rows: DataFrame, path: str, header: list[str] | None = None) -> None:
    """Columns as text joined by tabs, nulls as ``.``; header lines stand first in every file."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(".")) for c in rows.columns]).alias("value")
    out = rows.select(line)
    if header:
        # a file's header goes before its first row
        first = F.row_number().over(Window.partitionBy(F.spark_partition_id()).orderBy(F.monotonically_increasing_id())) == 1
        out = out.select(F.when(first, F.concat(F.lit("\n".join(header) + "\n"), "value")).otherwise(F.col("value")).alias("value"))
    out.write.text(path)


def write_sam(rows: DataFrame, path: str, header: list[str] | None = None) -> None:
    """Alignment rows (qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, tags: map of two letters to text) as SAM lines."""
    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e.key, F.lit(":Z:"), e.value)), "\t")
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in names], F.when(F.size("tags") > 0, tags))
    write_table(rows.select(line.alias("value")), path, header)


def write_vcf(rows: DataFrame, path: str, header: list[str] | None = None) -> None:
    """Variant rows (chrom, pos, id, ref, alt, qual, filter, info, format, sample) as VCF lines under the header."""
    names = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "sample"]
    write_table(rows.select(*names), path, header or ["##fileformat=VCFv4.2", "#" + "\t".join([*[n.upper() for n in names[:9]], "sample"])])


def phylip(spark: SparkSession, path: str) -> DataFrame:
    """name and seq of one interleaved PHYLIP file: a line ``rows columns``, then blocks of a line a sequence, of which the first block's lines begin with the name."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).where(F.trim("value") != "")
    counted = numbered(lines, "at")
    rows = F.split(F.trim("value"), r"\s+")[0].cast("long")
    head = counted.where("number = 0").select(rows.alias("_rows"))
    body = counted.where("number > 0").join(F.broadcast(head), F.lit(True)).withColumn("row", F.pmod(F.col("number") - 1, "_rows"))  # one row
    named = F.col("number") <= F.col("_rows")
    name = F.when(named, F.regexp_extract("value", r"^\s*(\S+)", 1))
    seq = F.regexp_replace(F.when(named, F.regexp_extract("value", r"^\s*\S+\s+(.*)$", 1)).otherwise(F.col("value")), r"\s", "")
    held = body.select("row", "number", name.alias("name"), seq.alias("seq")).groupBy("row")
    return held.agg(F.max("name").alias("name"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "seq"))), lambda x: x.seq), "").alias("seq")).select("name", "seq")


def fasta_with_quality(spark: SparkSession, path: str, qualities: str, offset: int = 33) -> DataFrame:
    """name, seq and qual of FASTA files and of files that give the Phred values of the same names as numbers."""
    rows = spark.read.option("lineSep", "\n>").text(qualities).select(F.regexp_replace("value", "^>", "").alias("v")).where("v <> ''")
    values = F.split(F.trim(F.regexp_replace(F.regexp_replace("v", "^[^\n]*\n?", ""), r"\s+", " ")), " ")
    qual = F.array_join(F.transform(F.filter(values, lambda x: x != ""), lambda x: F.char(x.cast("int") + offset)), "")
    named = rows.select(F.regexp_extract(F.split_part("v", F.lit("\n"), F.lit(1)), r"^(\S*)", 1).alias("name"), qual.alias("qual"))
    return fasta(spark, path).select("name", "seq").join(named, "name")


def scarf(spark: SparkSession, path: str) -> DataFrame:
    """name, seq and qual of lines of which the last two of the fields between colons are bases and quality signs (which hold no colon)."""
    rows = spark.read.text(path).where("value <> ''")
    return rows.select(*[F.regexp_extract("value", r"^(.*):([^:]*):([^:]*)$", i).alias(n) for i, n in ((1, "name"), (2, "seq"), (3, "qual"))])


def gi_taxids(spark: SparkSession, path: str) -> DataFrame:
    """gi and tid of lines of two numbers."""
    return _columns(spark, path, r"\s+").select(_at(0, "long").alias("gi"), _at(1, "long").alias("tid")).where("gi is not null and tid is not null")


def united_references(collections: dict[str, DataFrame]) -> DataFrame:
    """header, seq, source and accessions (without versions) of several collections of records(header, seq)."""
    out = None
    for source, rows in collections.items():
        one = rows.select("header", "seq", F.lit(source).alias("source"), S.accessions(F.col("header")).alias("accessions"))
        out = one if out is None else out.unionByName(one)
    return out
