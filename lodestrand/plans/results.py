"""Queries over results of other tools, k-mer rules and alignments by place, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators import depths, kmers, sam, summaries, taxonomy
from lodestrand.plans.registry import ALN, BUSHY, K, REFS, SEQS, _alignments, _bushy, _kmer_sql, _refs, _seqs, _t, query
from lodestrand.plans.tables import DEEP, HISTOGRAM


@query("SELECT count(*) AS pairs, CAST(sum((l_tax > 0.02)::INT) AS BIGINT) AS joined, CAST(sum((l_tax > 0.02 AND l_quantity = 30)::INT) AS BIGINT) AS \"right\", CAST(sum((l_tax > 0.02 AND l_quantity < 30)::INT) AS BIGINT) AS short, CAST(sum((l_tax > 0.02 AND l_quantity > 30)::INT) AS BIGINT) AS long FROM lineitem")
def graded_merges(spark, d):
    rows = _t(spark, d, "lineitem").select(F.concat(F.lit("r"), "l_orderkey", F.lit("_insert=30")).alias("name"), F.when(F.col("l_tax") > 0.02, 12).alias("overlap"), F.col("l_quantity").cast("long").alias("size"))
    return summaries.grade_merges(rows)


@query("SELECT l_returnflag AS file, count(*) AS rows, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total, min(CAST(l_quantity AS BIGINT)) AS least, max(CAST(l_quantity AS BIGINT)) AS most, round(avg(CAST(l_quantity AS BIGINT)), 9) AS mean FROM lineitem GROUP BY 1")
def result_summary(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("file"), F.col("l_quantity").cast("long").alias("q"))
    return summaries.summary(rows, "file", "q").withColumn("mean", F.round("mean", 9))


@query("WITH a AS (SELECT l_orderkey AS est, l_quantity / 60.0 AS s FROM lineitem), p AS (SELECT est, max(s) AS best, least(sum(s), 1.0) AS whole FROM a GROUP BY est) SELECT est, round(best, 9) AS best, round(whole, 9) AS \"all\", CASE WHEN best >= 0.75 THEN 'whole' WHEN whole > 0 THEN 'part' ELSE 'none' END AS state FROM p")
def captured_ests(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("est"), F.lit(60.0).alias("length"), F.col("l_quantity").alias("aligned"))
    return summaries.captured(rows, 0.75).withColumn("best", F.round("best", 9)).withColumn("all", F.round("all", 9))


@query("SELECT o_orderkey AS name FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45)")
def without_strong_hits(spark, d):
    m8 = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("qid"), F.col("l_quantity").alias("bits"))
    return summaries.without_strong_hits(_t(spark, d, "orders").select(F.col("o_orderkey").alias("name")), m8, 45)


@query(f"WITH {ALN} SELECT qname, line FROM aln WHERE mapq - (2 * x + 3) BETWEEN 10 AND 20")
def with_substitutions(spark, d):
    return summaries.with_substitutions(_alignments(spark, d).withColumn("nm", F.col("mapq")), 10, 20).select("qname", "line")


@query(f"""WITH s AS (SELECT doc_id AS name, upper(regexp_replace(text, '[^acgtACGT]', 'N', 'g')) AS seq FROM documents), k AS (SELECT * FROM s WHERE length(seq) >= 400)
SELECT 'scaffold_' || row_number() OVER (ORDER BY length(seq) DESC, name) AS name, name AS was, md5(regexp_replace(seq, 'N{{10,}}', repeat('N', 25), 'g')) AS seq FROM k""")
def released_contigs(spark, d):
    rows = _t(spark, d, "documents").select(F.col("doc_id").alias("name"), F.upper(F.regexp_replace("text", "[^acgtACGT]", "N")).alias("seq"))
    return summaries.release(rows, 400, 25).withColumn("seq", F.md5("seq"))


LABELLED = f"""{SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 15)}, {_kmer_sql('rk', 'refs', 15)}, u AS (SELECT DISTINCT name AS ref, kmer FROM rk), sh AS (SELECT name, ref, count(*) AS hits FROM km JOIN u USING (kmer) GROUP BY ALL), b AS (SELECT * FROM (SELECT *, max(hits) OVER (PARTITION BY name) AS m FROM sh) WHERE hits >= m - 5)"""


@query(f"WITH {LABELLED}, l AS (SELECT name, string_agg(ref || '=' || hits, ',' ORDER BY hits DESC, CAST(ref AS VARCHAR)) AS label FROM b GROUP BY name) SELECT seqs.name, label FROM seqs LEFT JOIN l ON l.name = seqs.name")
def named_by_match(spark, d):
    s = _seqs(spark, d)
    return summaries.named_by_match(s.select("name"), kmers.best_reference(s, _refs(spark, d), 15, clearzone=5))


@query(f"""WITH {SEQS}, {REFS}, ad AS (SELECT name, substr(seq, 1, 30) AS seq FROM refs WHERE name % 2 = 0), con AS (SELECT * FROM refs WHERE name % 2 = 1), {_kmer_sql('km', 'seqs', 13)}, {_kmer_sql('ak', 'ad', 13)}, {_kmer_sql('ck', 'con', 15)},
f AS (SELECT name, min(pos) AS a FROM km WHERE kmer IN (SELECT kmer FROM ak) GROUP BY name), c AS (SELECT seqs.name AS name, substr(seq, 1, coalesce(a, length(seq))) AS seq FROM seqs LEFT JOIN f ON f.name = seqs.name),
g AS (SELECT * FROM c WHERE length(seq) >= 50 AND length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq) BETWEEN 0.2 AND 0.5), {_kmer_sql('gk', 'g', 15)},
x AS (SELECT name FROM gk WHERE kmer IN (SELECT kmer FROM ck) GROUP BY name HAVING count(*) >= 3) SELECT name, md5(seq) AS seq FROM g WHERE name NOT IN (SELECT name FROM x)""")
def cleaned_reads(spark, d):
    refs = _refs(spark, d)
    adapters = refs.where("name % 2 = 0").withColumn("seq", F.substr("seq", F.lit(1), F.lit(30)))
    return summaries.cleaned(_seqs(spark, d).select("name", "seq"), adapters, refs.where("name % 2 = 1"), 13, 15, 3, 50, 0.2, 0.5).select("name", F.md5("seq").alias("seq"))


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs')}, {_kmer_sql('rk', 'refs')}, c AS (SELECT kmer, count(*) AS n FROM km GROUP BY kmer), h AS (SELECT unnest([0, 1, 2]) AS i),
t AS (SELECT i, CAST('0x' || substr(md5('s' || i || kmer), 1, 8) AS BIGINT) % 5000 AS b, sum(n) AS n FROM c, h GROUP BY ALL), w AS (SELECT DISTINCT kmer FROM rk)
SELECT kmer, CAST(min(coalesce(t.n, 0)) AS BIGINT) AS n FROM (SELECT kmer, i, CAST('0x' || substr(md5('s' || i || kmer), 1, 8) AS BIGINT) % 5000 AS b FROM w, h) q LEFT JOIN t USING (i, b) GROUP BY kmer""")
def estimated_counts(spark, d):
    words = kmers.counts(_refs(spark, d), K).select("kmer")
    return summaries.estimate(words, summaries.count_min(_seqs(spark, d), K, 5000), 5000)


@query(f"""WITH {DEEP}, fw AS (SELECT name, i - 1 AS pos, substr(seq, i, {K}) AS w FROM (SELECT name, seq, unnest(generate_series(1, length(seq) - {K} + 1)) AS i FROM seqs)), dd AS (SELECT name, pos, w, d FROM fw JOIN c ON kmer = greatest(w, reverse(translate(w, 'ACGT', 'TGCA')))),
weak AS (SELECT a.name, a.pos, a.w FROM dd a JOIN dd b ON b.name = a.name AND b.pos = a.pos - 1 WHERE a.d <= 1 AND b.d >= 5), alt AS (SELECT name, pos, base, substr(w, 1, {K} - 1) || base AS v FROM weak, (SELECT unnest(['A', 'C', 'G', 'T']) AS base) WHERE base <> right(w, 1)),
t AS (SELECT name, pos, base FROM alt JOIN c ON kmer = greatest(v, reverse(translate(v, 'ACGT', 'TGCA'))) WHERE d >= 5) SELECT name, pos + {K} - 1 AS pos, min(base) AS base FROM t GROUP BY name, pos HAVING count(*) = 1""")
def base_corrections(spark, d):
    return summaries.corrections(_seqs(spark, d).select("name", "seq"), K, 1, 5)


@query("""WITH e AS (SELECT l_suppkey AS name, l_partkey AS pos, count(*) AS depth FROM lineitem GROUP BY ALL), n AS (SELECT a.*, l.depth AS l, r.depth AS r FROM e a LEFT JOIN e l ON l.name = a.name AND l.pos = a.pos - 1 LEFT JOIN e r ON r.name = a.name AND r.pos = a.pos + 1)
SELECT name, pos, depth, CASE WHEN l IS NOT NULL AND r IS NOT NULL AND depth > greatest(l, r) THEN greatest(l, r) WHEN l IS NOT NULL AND r IS NOT NULL AND depth < least(l, r) THEN least(l, r) ELSE depth END AS fixed FROM n""")
def despiked_depths(spark, d):
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("name"), F.col("l_partkey").alias("pos")).agg(F.count("*").alias("depth"))
    return summaries.despiked(rows)


@query(f"""WITH {HISTOGRAM}, w AS (SELECT *, lag(kmers) OVER (ORDER BY depth) AS l, lead(kmers) OVER (ORDER BY depth) AS r FROM h WHERE depth >= 2), t AS (SELECT * FROM w WHERE kmers >= 2 AND kmers > coalesce(l, -1) AND kmers >= coalesce(r, -1)),
m AS (SELECT depth AS main FROM t ORDER BY kmers DESC, depth LIMIT 1) SELECT CAST((SELECT sum(kmers) FROM h) AS BIGINT) AS kmers, main, CAST(floor((SELECT sum(depth * kmers) FROM h WHERE depth >= 2) / main) AS BIGINT) AS size FROM m""")
def peak_statistics(spark, d):
    h = kmers.histogram(kmers.counts(_seqs(spark, d), K))
    return summaries.peak_stats(depths.peaks(h, 2), h)


@query("""WITH h AS (SELECT l_orderkey AS read, l_suppkey AS ref, max(l_quantity) AS score FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS next FROM h WINDOW w AS (PARTITION BY read ORDER BY score DESC, ref)) SELECT read, ref, score, score - next AS gap FROM r WHERE n = 1""")
def unique_best(spark, d):
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("ref")).agg(F.max("l_quantity").alias("score"))
    return summaries.unique_best(rows)


@query("""WITH p AS (SELECT DISTINCT l_suppkey AS chrom, l_partkey AS pos, l_orderkey * 10 + l_linenumber AS id FROM lineitem) SELECT chrom, pos, id, "window" FROM (SELECT *, pos // 50 * 50 AS "window", row_number() OVER (PARTITION BY chrom, pos // 50 ORDER BY id, pos) AS n FROM p) WHERE n <= 20""")
def filled_windows(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("pos"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")).distinct()
    return summaries.fill_windows(rows, 50, 20)


# ------------------------------------------------------------------ alignments


@query(f"WITH {ALN} SELECT qname, line FROM aln WHERE flag & 4 = 0 AND rname = 3 AND pos - 1 < 120 AND pos - 1 + 3 * q + x + 2 > 60")
def fetched_alignments(spark, d):
    return sam.fetch(_alignments(spark, d), 3, 60, 120).select("qname", "line")


@query(f"WITH {ALN} SELECT qname, line, rname, pos FROM aln")
def sorted_alignments(spark, d):
    return sam.sorted_by_place(_alignments(spark, d)).select("qname", "line", "rname", "pos")


@query(f"WITH {ALN} SELECT qname, line, CASE WHEN rname < 5 THEN 'chr' || rname ELSE CAST(rname AS VARCHAR) END AS rname FROM aln")
def renamed_contigs(spark, d):
    names = _t(spark, d, "supplier").where("s_suppkey < 5").select(F.col("s_suppkey").alias("old"), F.concat(F.lit("chr"), "s_suppkey").alias("new"))
    return sam.renamed_contigs(_alignments(spark, d), names).select("qname", "line", "rname")


@query(f"""WITH {ALN}, s AS (SELECT *, repeat(translate(md5(qname || '-' || line), '0123456789abcdef', 'ACGTACGTACGTACGT'), 8) AS seq FROM aln WHERE flag & 1796 = 0 AND mapq >= 10),
e AS (SELECT rname, pos, q, x, seq, unnest(generate_series(0, q - 1)) AS i FROM s), b AS (SELECT rname, pos + i AS pos, substr(seq, x + 2 + i, 1) AS base FROM e UNION ALL SELECT rname, pos + q + i, substr(seq, 2 * x + q + 3 + i, 1) FROM e UNION ALL SELECT rname, pos + 2 * q + x + 2 + i, substr(seq, 2 * x + 2 * q + 3 + i, 1) FROM e
UNION ALL SELECT rname, pos + 2 * q + unnest(generate_series(0, x + 1)), '-' FROM s), n AS (SELECT rname, pos, base, count(*) AS n FROM b GROUP BY ALL) SELECT rname, CAST(pos AS INT) AS pos, CAST(sum(n) AS BIGINT) AS depth, string_agg(base || n, '' ORDER BY base) AS alleles FROM n GROUP BY rname, pos""")
def pileup(spark, d):
    seq = F.repeat(F.translate(F.md5(F.concat_ws("-", "qname", F.col("line").cast("string"))), "0123456789abcdef", "ACGTACGTACGTACGT"), 8)
    return sam.pileup(_alignments(spark, d).withColumn("seq", seq), 10)


# ------------------------------------------------------------------- taxonomy


@query(f"WITH RECURSIVE {BUSHY}, a AS (SELECT s_suppkey AS assembly, s_suppkey + 200000 AS tid FROM supplier) SELECT assembly, tid FROM a WHERE tid IN (SELECT tid FROM tree WHERE name IN ('ASIA', 'NATION_7'))")
def assemblies_under(spark, d):
    rows = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("assembly"), (F.col("s_suppkey") + 200_000).alias("tid"))
    return taxonomy.filter_by_taxa(rows, taxonomy.closure(_bushy(spark, d)), ["ASIA", "NATION_7"]).select("assembly", "tid")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'NC_' || p_size WHEN 1 THEN 'AB' || p_size ELSE 'plain' || p_size END AS acc FROM part")
def simulated_origins(spark, d):
    k = F.col("p_partkey") % 3
    comment = F.when(k == 0, F.concat(F.lit("gi|7|ref|NC_"), "p_size", F.lit(".2|"))).otherwise("")
    name = F.when(k == 1, F.concat(F.lit("AB"), "p_size", F.lit(".1-"), "p_partkey", F.lit("/1"))).otherwise(F.concat(F.lit("plain"), "p_size"))
    return _t(spark, d, "part").select("p_partkey", S.simulated_origin(name, comment).alias("acc"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS species FROM part")
def species_fields(spark, d):
    line = F.concat_ws("\t", F.lit("id"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("species--"), "p_name")), F.lit("genus--x"))
    return _t(spark, d, "part").select("p_partkey", S.species_field(line).alias("species"))


@query("SELECT l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS total FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem) GROUP BY 1")
def allele_texts(spark, d):
    """Counts by line number as JSON text and back."""
    alleles = F.map_from_entries(F.collect_set(F.struct(F.concat(F.lit("L"), "l_linenumber").alias("k"), F.col("l_linenumber").cast("int").alias("v"))))
    rows = _t(spark, d, "lineitem").groupBy("l_suppkey").agg(S.allele_json(alleles).alias("text"))
    return rows.select("l_suppkey", F.aggregate(F.map_values(S.alleles_of(F.col("text"))), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
