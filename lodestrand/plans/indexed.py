"""Queries over files that are written by the record sink and read by index, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.operators.work import new_folder
from lodestrand.plans.registry import SEQS, _intervals, _seqs, query
from lodestrand.sources import fastq, regions, writers

WIDTH = 60


def _fasta(spark: SparkSession, d: str) -> str:
    """The sequences as FASTA files with lines of WIDTH bases."""
    path = new_folder(spark, "fasta")
    writers.register(spark)
    rows = _seqs(spark, d).select(F.col("name").cast("string").alias("name"), F.coalesce("seq", F.lit("")).alias("seq"))
    rows.write.format("records").option("layout", "fasta").option("width", WIDTH).mode("append").save(path)
    return path


@query(f"""WITH {SEQS}, r AS (SELECT DISTINCT l_suppkey AS chrom, l_partkey AS s, l_partkey + CAST(l_quantity AS BIGINT) AS e FROM lineitem)
SELECT chrom::VARCHAR AS name, s AS "start", least(e, length(seq)) AS "end", substr(seq, s + 1, least(e, length(seq)) - s) AS seq FROM r JOIN seqs ON name = chrom WHERE s < least(e, length(seq))""")
def fetched_regions(spark, d):
    path = _fasta(spark, d)
    wanted = _intervals(spark, d).select(F.col("chrom").cast("string").alias("name"), "start", "end").distinct()
    return regions.fetch(regions.build_index(spark, path, 100_000), wanted, path).select("name", "start", "end", "seq")


@query(f"""WITH {SEQS} SELECT name::VARCHAR AS name, coalesce(length(seq), 0) AS length, least({WIDTH}, coalesce(length(seq), 0)) AS line_bases, CASE WHEN length(seq) > 0 THEN least({WIDTH}, length(seq)) + 1 ELSE 0 END AS line_width, true AS even FROM seqs""")
def fasta_index(spark, d):
    return regions.build_index(spark, _fasta(spark, d), 50_000).select("name", "length", "line_bases", "line_width", "even")


@query(f"WITH {SEQS} SELECT 'r' || name || ' m' || name % 3 AS name, coalesce(seq, '') AS seq, translate(coalesce(seq, ''), 'ACGT', 'I5+#') AS qual, name % 3 AS mate FROM seqs")
def written_records(spark, d):
    """Reads written by the sink as gzipped FASTQ, in files by mate, and read back from all of them."""
    path = new_folder(spark, "records")
    writers.register(spark)
    fastq.register(spark)
    seq = F.coalesce("seq", F.lit(""))
    rows = _seqs(spark, d).select(F.concat(F.lit("r"), "name", F.lit(" m"), F.col("name") % 3).alias("name"), seq.alias("seq"), F.translate(seq, "ACGT", "I5+#").alias("qual"), (F.col("name") % 3).alias("mate"))
    rows.write.format("records").option("layout", "fastq").option("codec", "gzip").option("split", "mate").mode("append").save(path)
    back: DataFrame = spark.read.format("fastq").load(path)
    return back.select(F.concat_ws(" ", "name", "comment").alias("name"), "seq", "qual", F.regexp_extract("file", r"_(\d+)\.fastq\.gz$", 1).cast("long").alias("mate"))
