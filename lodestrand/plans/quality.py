"""Queries of trims, quality rules, long and short words, pairs and gaps over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators import intervals, kmers, masking, qc, reads, sam, stats, tools
from lodestrand.plans.registry import ALN, INTERVALS, MERGED, PAIRED, REFS, RUNS, SEQS, _alignments, _genome, _intervals, _kmer_sql, _paired, _refs, _seqs, _t, query


@query(f"WITH {SEQS}, c AS (SELECT name, seq, least(length(seq), 81, length(seq) - 2, length(seq) - length(seq) % 4) AS e FROM seqs) SELECT name, CASE WHEN e > 3 THEN substr(seq, 4, e - 3) WHEN seq IS NOT NULL THEN '' END AS seq FROM c")
def force_trimmed(spark, d):
    return _seqs(spark, d).select("name", S.force_trim(F.col("seq"), 3, 80, 2, 4).alias("seq"))


def _checked(spark: SparkSession, d: str) -> DataFrame:
    """Every two lines of an order as mates, good from 20 on."""
    name = F.concat("l_orderkey", F.lit("-"), F.floor((F.col("l_linenumber") - 1) / 2).cast("string"), F.lit("/"), 2 - F.col("l_linenumber") % 2)
    return _t(spark, d, "lineitem").select(name.alias("name"), F.col("l_quantity").alias("score"), (F.col("l_quantity") >= 20).alias("ok"))


CHECKED = "m AS (SELECT l_orderkey || '-' || (l_linenumber - 1) // 2 AS pair, 2 - l_linenumber % 2 AS side, l_quantity AS score, l_quantity >= 20 AS ok FROM lineitem), w AS (SELECT *, bool_and(ok) OVER (PARTITION BY pair) AS fine, bool_or(ok) OVER (PARTITION BY pair) AS either FROM m)"


@query(f"WITH {CHECKED} SELECT pair || '/' || side AS name, score FROM w WHERE fine")
def kept_pairs(spark, d):
    return qc.keep_pairs(_checked(spark, d))


@query(f"WITH {CHECKED} SELECT pair || '/' || side AS name, score FROM w WHERE either")
def pairs_with_a_good_mate(spark, d):
    return qc.keep_pairs(_checked(spark, d), both_bad=True)


@query(f"WITH {CHECKED} SELECT pair || '/' || side AS name, score FROM w WHERE ok AND NOT fine")
def singletons(spark, d):
    return qc.singletons(_checked(spark, d))


@query("WITH r AS (SELECT l_orderkey AS read, max(l_quantity) AS score, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) SELECT read, score, CASE WHEN score < 30 THEN 0 ELSE n END AS n FROM r")
def thresholded(spark, d):
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("read")).agg(F.max("l_quantity").alias("score"), F.collect_set("l_suppkey").alias("hits"))
    return reads.threshold(rows, 30).select("read", "score", F.size("hits").cast("long").alias("n"))


@query(f"WITH {SEQS} SELECT source AS file, md5(coalesce(string_agg(seq, 'NNNNN' ORDER BY name), '')) AS seq FROM seqs GROUP BY source")
def fused(spark, d):
    return stats.fuse(_seqs(spark, d).withColumnRenamed("source", "file"), 5, "file", "name").withColumn("seq", F.md5("seq"))


@query("WITH r AS (SELECT l_suppkey % 4 AS unit, CAST(l_partkey + 1 AS BIGINT) AS length, l_quantity AS mean FROM lineitem) SELECT unit, CAST(sum(length) AS BIGINT) AS length, round(sum(mean * length) / sum(length), 9) AS mean FROM r GROUP BY unit")
def merged_coverage(spark, d):
    rows = _t(spark, d, "lineitem").select((F.col("l_suppkey") % 4).alias("unit"), (F.col("l_partkey") + 1).alias("length"), F.col("l_quantity").alias("mean"))
    return stats.weighted_merge(rows, "unit").withColumn("mean", F.round("mean", 9))


@query(f"""WITH {INTERVALS}, src AS (SELECT l_suppkey AS chrom, l_partkey AS "start", l_partkey + 10 AS "end" FROM lineitem WHERE l_quantity = 50), {MERGED},
o AS (SELECT iv.read, iv.line, iv.chrom, iv."start", iv."end", (SELECT coalesce(sum(least(iv."end", m."end") - greatest(iv."start", m."start")), 0) FROM merged m WHERE m.chrom = iv.chrom AND iv."start" < m."end" AND m."start" < iv."end") AS o FROM iv)
SELECT DISTINCT read FROM o WHERE o / ("end" - "start") >= 0.5""")
def reads_in_spikes(spark, d):
    """Reads of which half an interval or more lies in spikes."""
    rows = _intervals(spark, d).withColumn("key", F.struct("chrom", "start", "end"))
    spikes = _t(spark, d, "lineitem").where("l_quantity = 50").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 10).alias("end"))
    found = intervals.annotate(rows.select("key", "chrom", "start", "end").distinct(), spikes, "key").where("fraction >= 0.5")
    return rows.join(found.select("key"), "key", "left_semi").select("read").distinct()


@query(f"""WITH {SEQS}, q AS (SELECT name, upper(seq) AS s FROM seqs) SELECT name FROM q WHERE length(s) > 0 AND NOT regexp_matches(s, 'A{{4}}|C{{4}}|G{{4}}|T{{4}}') AND least(length(s) - length(replace(s, 'A', '')), length(s) - length(replace(s, 'C', '')), length(s) - length(replace(s, 'G', '')), length(s) - length(replace(s, 'T', ''))) >= 0.1 * length(s)""")
def base_rules(spark, d):
    return qc.base_rules(_seqs(spark, d), most_run=3, least_share=0.1).where("ok").select("name")


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 3 <> 0 AND o_custkey % 4 IN (1, 2)")
def passed_reads(spark, d):
    mark, code = F.when(F.col("o_custkey") % 3 == 0, "Y").otherwise("N"), F.element_at(F.array(*map(F.lit, ["AAA", "CCC", "GGG", "TTT"])), (F.col("o_custkey") % 4 + 1).cast("int"))
    rows = _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("m:"), "o_orderkey", F.lit(" 1:"), mark, F.lit(":0:"), code).alias("name"), F.lit("ACGT").alias("seq"))
    return qc.base_rules(rows, chastity=True, barcodes=["CCC", "GGG"]).where("ok").select("o_orderkey")


@query(f"WITH {SEQS} SELECT 33 AS \"offset\", true AS interleaved, max(length(seq)) AS longest, 'dna' AS letters FROM seqs")
def file_traits(spark, d):
    """Every sequence as a pair of reads."""
    rows = _seqs(spark, d).select("name", "seq", F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
    qual = F.translate("seq", "ACGT", "I5+#")
    return qc.traits(rows.select((F.col("name") * 2 + F.col("mate") - 1).alias("number"), F.concat(F.lit("r"), "name", F.lit("/"), "mate").alias("name"), "seq", qual.alias("qual")))


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 15)}, {_kmer_sql('rk', 'refs', 15)}, hit AS (SELECT DISTINCT name, pos FROM km WHERE kmer IN (SELECT kmer FROM rk)), c AS (SELECT name, i - 1 AS i, substr(seq, i, 1) AS base FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs WHERE name IN (SELECT name FROM hit))),
m AS (SELECT DISTINCT name, pos + unnest(generate_series(0, 14)) AS i FROM hit), n AS (SELECT name, string_agg(CASE WHEN m.i IS NULL THEN translate(base, 'ACGT', 'I5+#') ELSE '!' END, '' ORDER BY c.i) AS q FROM c LEFT JOIN m USING (name, i) GROUP BY name)
SELECT seqs.name, md5(coalesce(q, translate(seq, 'ACGT', 'I5+#'))) AS qual FROM seqs LEFT JOIN n ON n.name = seqs.name""")
def masked_qualities(spark, d):
    rows = _seqs(spark, d).select("name", "seq", F.translate("seq", "ACGT", "I5+#").alias("qual"))
    return kmers.mask(rows, _refs(spark, d), 15).select("name", F.md5("qual").alias("qual"))


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 11)}, {_kmer_sql('rk', 'refs', 11)}, hit AS (SELECT name, pos FROM km WHERE kmer IN (SELECT kmer FROM rk)), r AS (SELECT name, pos - row_number() OVER (PARTITION BY name ORDER BY pos) AS run FROM hit), n AS (SELECT name, count(*) AS n FROM r GROUP BY name, run HAVING count(*) > 9)
SELECT name, CAST(sum(n - 9) AS BIGINT) AS hits FROM n GROUP BY name HAVING sum(n - 9) >= 2""")
def long_matches(spark, d):
    return kmers.match_long(_seqs(spark, d), _refs(spark, d), 11, 20, 2)


@query(f"""WITH {SEQS}, {REFS}, h AS (SELECT DISTINCT substr(seq, 1, m) AS tip FROM refs, (SELECT unnest([2, 3, 4, 5, 6]) AS m) WHERE length(seq) >= m), e AS (SELECT name, max(m) AS cut FROM seqs, (SELECT unnest([2, 3, 4, 5, 6]) AS m) WHERE length(seq) >= m AND right(seq, m) IN (SELECT tip FROM h) GROUP BY name)
SELECT seqs.name, md5(substr(seq, 1, length(seq) - coalesce(cut, 0))) AS seq FROM seqs LEFT JOIN e ON e.name = seqs.name""")
def trimmed_tips(spark, d):
    return kmers.trim_tips(_seqs(spark, d).select("name", "seq"), _refs(spark, d), 2, 6).select("name", F.md5("seq").alias("seq"))


@query(f"WITH {ALN} SELECT rname, round(avg(mapq), 9) AS mapq FROM aln WHERE flag & 1796 = 0 GROUP BY rname")
def mean_mapping_quality(spark, d):
    return sam.mean_quality(_alignments(spark, d)).withColumn("mapq", F.round("mapq", 9))


@query(f"""WITH {PAIRED}, p AS (SELECT aln.qname || '-' || (aln.line - 1) // 2 AS qname, aln.line, aln.flag, aln.rname % 2 AS rname, aln.pos // 20 AS pos, aln.mapq FROM aln), t AS (SELECT qname, list_sort(list(rname || '/' || lpad(CAST(pos AS VARCHAR), 9, '0') || '/' || (flag & 16) || '/' || (flag & 64))) AS ends, sum(mapq) AS q FROM p GROUP BY qname),
b AS (SELECT qname FROM (SELECT qname, row_number() OVER (PARTITION BY ends ORDER BY q DESC, qname) AS n FROM t) WHERE n = 1) SELECT qname, line FROM p WHERE qname IN (SELECT qname FROM b)""")
def pair_duplicates(spark, d):
    rows = _paired(spark, d).select("qname", "line", "flag", (F.col("rname").cast("long") % 2).alias("rname"), F.floor(F.col("pos") / 20).alias("pos"), "mapq")
    return sam.remove_pair_duplicates(rows, "mapq").select("qname", "line")


@query("""WITH s AS (SELECT doc_id AS name, upper(regexp_replace(text, '[^acgtACGT]', 'N', 'g')) AS seq FROM documents), p AS (SELECT name, seq, regexp_extract_all(seq, 'N{4,}') AS g, list_filter(regexp_split_to_array(seq, 'N{4,}'), lambda x: x <> '') AS c FROM s)
SELECT name, CAST(len(g) AS INT) AS gaps, CASE WHEN seq IS NOT NULL THEN CAST(coalesce(list_sum(list_transform(g, lambda x: length(x))), 0) AS BIGINT) END AS gap_bases, CAST(len(c) AS INT) AS contigs, CAST(coalesce(list_max(list_transform(c, lambda x: length(x))), 0) AS BIGINT) AS longest FROM p""")
def gap_statistics(spark, d):
    rows = _t(spark, d, "documents").select(F.col("doc_id").alias("name"), F.upper(F.regexp_replace("text", "[^acgtACGT]", "N")).alias("seq"))
    return stats.gaps(rows, 4)


@query(f"WITH {SEQS}, c AS (SELECT name, i, substr(seq, i, 1) AS base FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs)), n AS (SELECT name, string_agg(CASE WHEN i % 5 = 0 AND i <= 40 THEN 'N' ELSE base END, '' ORDER BY i) AS s FROM c GROUP BY name) SELECT seqs.name, md5(coalesce(s, seq)) AS seq FROM seqs LEFT JOIN n ON n.name = seqs.name")
def masked_by_other(spark, d):
    s = _seqs(spark, d).select("name", "seq")
    return masking.masked_by(s, s.select("name", F.repeat(F.lit("aaaaX"), 8).alias("seq"))).select("name", F.md5("seq").alias("seq"))


@query("SELECT p_partkey, CASE WHEN contains(p_name, 'cold') THEN 'cold' WHEN contains(p_name, 'gadget') THEN 'gadget' WHEN contains(p_name, 'small') THEN 'small' ELSE 'unknown' END AS file FROM part")
def names_by_word(spark, d):
    words = spark.createDataFrame([("small",), ("cold",), ("gadget",)], "word string")
    return tools.demux_by_name(_t(spark, d, "part").select("p_partkey", F.col("p_name").alias("name")), words).select("p_partkey", "file")


@query(f"""WITH {SEQS}, p AS (SELECT name, i, CASE substr(seq, i, 1) WHEN 'A' THEN 436 WHEN 'C' THEN 337 WHEN 'G' THEN -563 ELSE -9563 END AS gain FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs)),
c AS (SELECT name, i, sum(gain) OVER (PARTITION BY name ORDER BY i) AS t FROM p UNION ALL SELECT name, 0, 0 FROM seqs), f AS (SELECT name, i, t, min({{'t': t, 'i': i}}) OVER (PARTITION BY name ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM c),
m AS (SELECT name, start, size FROM (SELECT name, low.i AS start, i - low.i AS size, row_number() OVER (PARTITION BY name ORDER BY t - low.t DESC, i - low.i DESC, low.i) AS n FROM f WHERE t > low.t) WHERE n = 1)
SELECT seqs.name, md5(CASE WHEN seq IS NULL THEN NULL ELSE coalesce(substr(seq, start + 1, size), '') END) AS seq FROM seqs LEFT JOIN m ON m.name = seqs.name""")
def optimal_trimmed(spark, d):
    """Each sequence cut to the stretch of most gain, a base gaining 0.0437 less its error probability."""
    rows = _seqs(spark, d).select("name", "seq", F.translate("seq", "ACGT", "I5+!").alias("qual"))
    return qc.quality_trim(rows, 0.0437).select("name", F.md5("seq").alias("seq"))


@query(f"""WITH {SEQS}, w AS (SELECT name, seq, unnest(generate_series(1, length(seq) - 49)) AS w FROM seqs WHERE length(seq) >= 50), k AS (SELECT name, w, substr(seq, w + j, 5) AS k FROM (SELECT name, seq, w, unnest(generate_series(0, 45)) AS j FROM w)),
c AS (SELECT name, w, k, count(*) / 46.0::DOUBLE AS p FROM k GROUP BY ALL), e AS (SELECT name, w, -sum(p * ln(p)) / ln(46) AS e FROM c GROUP BY ALL), m AS (SELECT name, avg(e) AS e FROM e GROUP BY name) SELECT seqs.name, CASE WHEN seq IS NOT NULL THEN round(coalesce(e, 1.0), 9) END AS entropy FROM seqs LEFT JOIN m ON m.name = seqs.name""")
def entropies(spark, d):
    return _seqs(spark, d).select("name", F.round(S.entropy(F.col("seq")), 9).alias("entropy"))


@query(f"WITH {SEQS}, {_kmer_sql('km', 'seqs', 11)} SELECT count(DISTINCT kmer) AS kmers, true AS close FROM km")
def distinct_kmers(spark, d):
    """The exact number of k-mers, and whether the estimate is within a tenth of it."""
    exact = kmers.counts(_seqs(spark, d), 11).agg(F.count("*").alias("exact"))
    both = exact.join(kmers.unique_estimate(_seqs(spark, d), 11), F.lit(True))  # one row each
    return both.select(F.col("exact").alias("kmers"), (F.abs(F.col("kmers") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close"))


@query("""WITH m AS (SELECT l_orderkey || '-' || (l_linenumber - 1) // 2 AS pair, 2 - l_linenumber % 2 AS mate, l_quantity AS score, CASE WHEN l_tax > 0.06 THEN 'IGNORE' WHEN l_suppkey = 3 THEN 'Viruses' END AS tag FROM lineitem),
w AS (SELECT *, min(score) OVER (PARTITION BY pair) < 10 OR bool_or(coalesce(tag = 'Viruses', false)) OVER (PARTITION BY pair) AS taken FROM m) SELECT pair || '/' || mate AS name, CASE WHEN score >= 10 THEN 'IGNORE' ELSE '' END AS comment, 'AC' AS seq, 'II' AS qual FROM w WHERE taken AND tag IS DISTINCT FROM 'IGNORE'""")
def unmapped_and_wanted(spark, d):
    pair = F.concat("l_orderkey", F.lit("-"), F.floor((F.col("l_linenumber") - 1) / 2).cast("string"))
    tag = F.when(F.col("l_tax") > 0.06, "IGNORE").when(F.col("l_suppkey") == 3, "Viruses")
    mates = _t(spark, d, "lineitem").select(pair.alias("name"), (2 - F.col("l_linenumber") % 2).alias("mate"), F.col("l_quantity").alias("score"), F.lit("AC").alias("seq"), F.lit("II").alias("qual"), tag.alias("tag"))
    return reads.extract_unmapped(mates, 10, F.col("tag") == "Viruses", mark=True, skip_marked=True)


@query("""WITH r AS (SELECT l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS ref, least(l_partkey, l_partkey + l_linenumber - 3) AS a, greatest(l_partkey, l_partkey + l_linenumber - 3) AS b FROM lineitem),
o AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY ref ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM r), i AS (SELECT *, sum(new) OVER (PARTITION BY ref ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS id FROM o),
m AS (SELECT ref, min(a) AS a, max(b) AS b FROM i GROUP BY ref, id) SELECT ref, string_agg(a || ',' || b, ';' ORDER BY a) AS islands, CAST(sum(b - a + 1) AS BIGINT) AS covered FROM m GROUP BY ref""")
def alignment_islands(spark, d):
    rows = _t(spark, d, "lineitem").select((F.col("l_suppkey") * 100 + F.col("l_quantity").cast("long")).alias("ref"), F.col("l_partkey").alias("first"), (F.col("l_partkey") + F.col("l_linenumber") - 3).alias("last"))
    return intervals.closed_coverage(rows)


@query("""WITH p AS (SELECT p_partkey // 3 AS rec, p_size AS tid FROM part) SELECT 'S' || rec AS seq FROM p GROUP BY rec HAVING NOT bool_or(tid IN (5, 6, 7) AND tid % 4 <> 0)""")
def references_without_taxa(spark, d):
    p = _t(spark, d, "part")
    header = F.concat(F.lit("gi|"), "p_partkey", F.lit("|ref|ACC"), "p_partkey", F.lit(".1|"))
    records = p.groupBy(F.floor(F.col("p_partkey") / 3).alias("rec")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", header.alias("h")))), lambda x: x.h), "\x01").alias("header")).select("header", F.concat(F.lit("S"), "rec").alias("seq"))
    known = p.where("p_size % 4 <> 0").select(F.concat(F.lit("ACC"), "p_partkey").alias("acc"), F.col("p_size").alias("tid"))
    return tools.without_taxa(records, known, spark.createDataFrame([(5,), (6,), (7,)], "tid int")).select("seq")


@query(f"""WITH {RUNS}, k AS (SELECT chrom, "start", "end", depth, unnest(generate_series("start" // 30, ("end" - 1) // 30)) AS k FROM runs), o AS (SELECT chrom, k, depth, least("end", (k + 1) * 30) - greatest("start", k * 30) AS o FROM k)
SELECT chrom, k * 30 AS "start", round(sum(o * depth) / sum(o), 9) AS mean FROM o GROUP BY chrom, k""")
def window_depths(spark, d):
    return intervals.window_means(intervals.depth_runs(_intervals(spark, d), _genome(spark, d)), 30).withColumn("mean", F.round("mean", 9))


@query(f"""WITH {RUNS}, g AS (SELECT DISTINCT l_suppkey AS chrom, l_partkey AS "start", l_partkey + 15 AS "end" FROM lineitem),
o AS (SELECT g.chrom, g."start", g."end", depth, least(g."end", r."end") - greatest(g."start", r."start") AS o FROM g JOIN runs r ON r.chrom = g.chrom AND g."start" < r."end" AND r."start" < g."end" WHERE depth > 0)
SELECT g.chrom, g."start", g."end", round(coalesce(sum(o * depth), 0) / 15, 9) AS mean, round(coalesce(sum(o), 0) / 15, 9) AS covered FROM g LEFT JOIN o ON o.chrom = g.chrom AND o."start" = g."start" GROUP BY g.chrom, g."start", g."end" """)
def region_depths(spark, d):
    regions = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 15).alias("end"))
    found = intervals.region_depths(intervals.depth_runs(_intervals(spark, d), _genome(spark, d)), regions)
    return found.withColumn("mean", F.round("mean", 9)).withColumn("covered", F.round("covered", 9))


@query(f"WITH {ALN}, o AS (SELECT 'I' AS kind, x + 1 AS size FROM aln WHERE flag & 4 = 0 UNION ALL SELECT 'D', x + 2 FROM aln WHERE flag & 4 = 0) SELECT kind, size, count(*) AS n FROM o GROUP BY ALL")
def indel_lengths(spark, d):
    return sam.indel_lengths(_alignments(spark, d))


@query(f"WITH {ALN} SELECT least(CAST(floor(greatest(3 * q + 2 * x + 3 - mapq, 0) * 50 / (3 * q + 2 * x + 3)) AS BIGINT), 49) AS bin, count(*) AS reads FROM aln WHERE flag & 4 = 0 GROUP BY 1")
def identities(spark, d):
    return sam.identities(_alignments(spark, d).withColumn("nm", F.col("mapq")), 50)


@query(f"WITH {SEQS}, e AS (SELECT i, CASE substr(seq, i, 1) WHEN 'A' THEN 40 WHEN 'C' THEN 20 WHEN 'G' THEN 10 ELSE 2 END AS q FROM (SELECT seq, unnest(generate_series(1, length(seq))) AS i FROM seqs)) SELECT CAST((i - 1) // 200 * 200 AS BIGINT) AS pos, count(*) AS bases, round(avg(q), 9) AS quality FROM e GROUP BY 1")
def quality_by_place(spark, d):
    rows = _seqs(spark, d).select("name", F.translate("seq", "ACGT", "I5+#").alias("qual"))
    return stats.quality_by_place(rows, 200).withColumn("quality", F.round("quality", 9))
