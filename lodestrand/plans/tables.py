"""Queries of the table tools, scores, masks and depth rules over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators import depths, intervals, kmers, masking, scores, stats, taxonomy, tools
from lodestrand.operators.work import keep
from lodestrand.plans.registry import BUSHY, K, MERGED, REFS, RUNS, SEQS, _bushy, _genome, _intervals, _kmer_sql, _refs, _seqs, _t, query

COIN = "CAST('0x' || substr(md5({seed} || {key}), 1, 8) AS BIGINT)"


# -------------------------------------------------------------------- scores


def _refs_hit(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("ref"), F.col("l_quantity").alias("score"), F.col("l_linenumber").alias("line"))


@query("WITH s AS (SELECT l_orderkey AS read, l_suppkey AS ref, max(l_quantity) AS score FROM lineitem GROUP BY ALL) SELECT read, ref, score FROM (SELECT *, max(score) OVER (PARTITION BY read) AS m FROM s) WHERE score >= 0.8 * m")
def best_of_subjects(spark, d):
    return scores.best_of_subjects(_refs_hit(spark, d), 0.8)


@query("""WITH a AS (SELECT l_orderkey AS pair, l_suppkey AS ref, max(l_quantity) AS s FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY ALL), b AS (SELECT l_orderkey AS pair, l_suppkey AS ref, max(l_quantity) AS s FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL),
j AS (SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.ref, b.ref) AS ref, coalesce(a.s, 0) + coalesce(b.s, 0) AS score FROM a FULL JOIN b ON a.pair = b.pair AND a.ref = b.ref)
SELECT pair, ref, score FROM (SELECT *, max(score) OVER (PARTITION BY pair) AS m FROM j) WHERE score >= 0.9 * m""")
def pair_scores(spark, d):
    rows = _refs_hit(spark, d)
    return scores.pair_scores(rows.where("line % 2 = 1"), rows.where("line % 2 = 0"), 0.9)


@query("""WITH m AS (SELECT l_orderkey AS pair, l_linenumber % 2 AS mate, l_suppkey AS ref, max(l_quantity) AS score FROM lineitem GROUP BY ALL)
SELECT pair, mate, ref, score, CASE WHEN count(*) OVER (PARTITION BY pair, ref) > 1 THEN sum(score) OVER (PARTITION BY pair, ref) ELSE score END AS sum FROM m""")
def mate_sums(spark, d):
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("pair"), (F.col("l_linenumber") % 2).alias("mate"), F.col("l_suppkey").alias("ref")).agg(F.max("l_quantity").alias("score"))
    return scores.mate_sums(rows)


@query("WITH s AS (SELECT l_orderkey AS read, l_suppkey AS ref, max(l_quantity) AS score FROM lineitem GROUP BY ALL) SELECT read, ref, score FROM (SELECT *, max(score) OVER (PARTITION BY read) AS m FROM s) WHERE score >= 0.95 * m")
def united_hits(spark, d):
    """Hits against three parts of the suppliers, put together."""
    rows = _refs_hit(spark, d)
    return scores.united([rows.where(F.col("ref") % 3 == i) for i in range(3)], 0.95)


@query("""WITH r AS (SELECT o_custkey AS qid, 17 AS length, arg_min(o_orderkey % 17 + 1, o_orderkey) AS mapped FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
w AS (SELECT *, row_number() OVER (ORDER BY mapped DESC, qid) AS place, CAST(sum(mapped) OVER (ORDER BY mapped DESC, qid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bases, (SELECT 17 * count(*) FROM customer) AS whole FROM r)
SELECT qid, length, mapped, round(mapped / length, 9) AS ratio, place, bases, 2 * bases >= whole AND 2 * (bases - mapped) < whole AS nc50 FROM w""")
def map_lengths(spark, d):
    m8 = _t(spark, d, "orders").select(F.col("o_orderkey").alias("line"), F.col("o_custkey").alias("qid"), F.lit(5).cast("long").alias("qs"), (F.col("o_orderkey") % 17 + 5).alias("qe"))
    return scores.map_lengths(m8, _t(spark, d, "customer").select(F.col("c_custkey").alias("qid"), F.lit(17).cast("long").alias("length")))


@query(f"""WITH RECURSIVE {BUSHY}, r AS (SELECT o_orderkey AS line, 200000 + o_custkey % (SELECT count(*) FROM supplier) AS tid, o_orderkey % 50 AS aligned FROM orders),
c AS (SELECT ancestor AS tid, sum(aligned) AS clade FROM r JOIN tree USING (tid) GROUP BY 1), s AS (SELECT tid, arg_max(aligned, line) AS stay FROM r GROUP BY 1)
SELECT tid, CAST(clade AS BIGINT) AS clade, CAST(coalesce(stay, 0) AS BIGINT) AS stay FROM c LEFT JOIN s USING (tid)""")
def aligned_report(spark, d):
    n = _t(spark, d, "supplier").agg(F.count("*").alias("n"))
    rows = _t(spark, d, "orders").join(F.broadcast(n), F.lit(True)).select(F.col("o_orderkey").alias("line"), (200_000 + F.col("o_custkey") % F.col("n")).alias("tid"), (F.col("o_orderkey") % 50).alias("aligned"))  # one row
    return scores.aligned_report(rows, taxonomy.closure(_bushy(spark, d)))


# --------------------------------------------------------------------- tools


@query(f"""WITH {SEQS}, r AS (SELECT 'r ' || name AS name, substr(seq, 3, 79) AS s FROM seqs)
SELECT replace(name, ' ', '_') AS name, reverse(translate(s, 'ACGT', 'TGCA')) AS seq, reverse(translate(s, 'ACGT', 'hTJB')) AS qual FROM r WHERE length(s) >= 20 AND {COIN.format(seed="'1'", key="name")} < 0.7 * 4294967296""")
def reformat_reads(spark, d):
    rows = _seqs(spark, d).select(F.concat(F.lit("r "), F.col("name").cast("string")).alias("name"), "seq", F.translate("seq", "ACGT", "I5+#").alias("qual"))
    return tools.reformat(rows, least=20, complement=True, underscores=True, offset_out=64, left=2, right=80, share=0.7)


@query("SELECT 'read_' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS name, o_custkey FROM orders")
def rename_reads(spark, d):
    return tools.rename(_t(spark, d, "orders"), "read", "o_orderkey").select("name", "o_custkey")


@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders) WHERE n IN (0, 7, 100, 1234, 1000000000)")
def reads_by_number(spark, d):
    return tools.by_number(_t(spark, d, "orders"), "o_orderkey", [0, 7, 100, 1234, 1_000_000_000]).select("o_orderkey")


@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders) WHERE n BETWEEN 100 AND 299")
def rows_between(spark, d):
    return tools.between(_t(spark, d, "orders"), "o_orderkey", 100, 299).select("o_orderkey")


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS INT) AS file FROM orders")
def deal_reads(spark, d):
    return tools.dealt(_t(spark, d, "orders"), "o_orderkey", 7).select("o_orderkey", "file")


@query(f"SELECT o_orderkey, {COIN.format(seed=chr(39) + '5' + chr(39), key='o_orderkey')} AS place FROM orders")
def shuffle_reads(spark, d):
    return tools.shuffled(_t(spark, d, "orders"), "o_orderkey", "5").select("o_orderkey", "place")


@query("SELECT 'a_' || r_name AS name FROM region UNION ALL SELECT 'b_' || n_name FROM nation")
def mux_reads(spark, d):
    return tools.muxed({"a": _t(spark, d, "region").select(F.col("r_name").alias("name")), "b": _t(spark, d, "nation").select(F.col("n_name").alias("name"))})


@query("""WITH n AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation), r AS (SELECT *, row_number() OVER (ORDER BY r_regionkey) AS i FROM region) SELECT n_nationkey AS at, coalesce(r_name, n_name) AS name FROM n LEFT JOIN r USING (i)""")
def replace_headers(spark, d):
    return tools.with_headers(_t(spark, d, "nation").select(F.col("n_nationkey").alias("at"), F.col("n_name").alias("name")), _t(spark, d, "region").select(F.col("r_regionkey").alias("at"), F.col("r_name").alias("name")), "at").select("at", "name")


def _part_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return _t(spark, d, "part").select("p_partkey", F.col("p_name").alias("line")), spark.createDataFrame([("cold widget",), ("small",)], "word string")


@query("SELECT p_partkey, p_name AS line FROM part WHERE p_name NOT IN ('cold widget', 'small')")
def lines_without(spark, d):
    lines, words = _part_lines(spark, d)
    return tools.filter_lines(lines, words, include=False)


@query("SELECT p_partkey, p_name AS line FROM part WHERE contains(p_name, 'cold widget') OR contains(p_name, 'small')")
def lines_with(spark, d):
    lines, words = _part_lines(spark, d)
    return tools.filter_lines(lines, words, substring=True)


BARCODES = "b AS (SELECT o_orderkey, 'm:' || o_orderkey || ':' || translate(substr(md5(CAST(o_custkey AS VARCHAR)), 1, 3), '0123456789abcdef', 'ACGTACGTACGTACGN') || CASE WHEN o_custkey % 2 = 0 THEN '+AC' ELSE '' END || '/1' AS name FROM orders), c AS (SELECT *, regexp_extract(regexp_replace(name, '/[0-9]$', ''), '([^:]*)$', 1) AS barcode FROM b)"


def _coded(spark: SparkSession, d: str) -> DataFrame:
    code = F.translate(F.substr(F.md5(F.col("o_custkey").cast("string")), F.lit(1), F.lit(3)), "0123456789abcdef", "ACGTACGTACGTACGN")
    return _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("m:"), "o_orderkey", F.lit(":"), code, F.when(F.col("o_custkey") % 2 == 0, "+AC").otherwise(""), F.lit("/1")).alias("name"))


@query(f"WITH {BARCODES} SELECT barcode, count(*) AS reads, regexp_full_match(barcode, '[ACGT]+(\\+[ACGT]+)?') AS valid, barcode IN ('AAA', 'ACG', 'GTA+AC') AS known FROM c GROUP BY barcode")
def barcode_counts(spark, d):
    return tools.count_barcodes(_coded(spark, d), spark.createDataFrame([("AAA",), ("ACG",), ("GTA+AC",)], "barcode string"))


@query(f"WITH {BARCODES} SELECT o_orderkey, name FROM c WHERE NOT contains(barcode, 'N')")
def good_barcodes(spark, d):
    return tools.good_barcodes(_coded(spark, d)).select("o_orderkey", "name")


@query("""WITH n AS (SELECT n_nationkey AS "at", n_name AS name, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation), s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS i, 'ACGT'[s_suppkey % 4 + 1] || 'TT' AS seq FROM supplier)
SELECT "at", concat_ws(':', name, seq) AS name FROM n LEFT JOIN s USING (i)""")
def merge_barcodes(spark, d):
    codes = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("at"), F.concat(F.substr(F.lit("ACGT"), (F.col("s_suppkey") % 4 + 1).cast("int"), F.lit(1)), F.lit("TT")).alias("seq"))
    return tools.merge_barcodes(_t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("at"), F.col("n_name").alias("name")), codes, "at").select("at", "name")


@query("""WITH r AS (SELECT l_orderkey || '-' || (l_linenumber - 1) // 2 AS pair, l_linenumber AS line, CAST(l_quantity AS INT) AS size FROM lineitem), w AS (SELECT *, sum((size >= 20)::INT) OVER (PARTITION BY pair) AS long FROM r)
SELECT pair || '/' || (2 - line % 2) AS name, line, size, CASE WHEN size < 20 THEN 'short' WHEN long >= 2 THEN 'pair' ELSE 'single' END AS file FROM w""")
def split_pairs(spark, d):
    name = F.concat("l_orderkey", F.lit("-"), F.floor((F.col("l_linenumber") - 1) / 2).cast("string"), F.lit("/"), 2 - F.col("l_linenumber") % 2)
    rows = _t(spark, d, "lineitem").select(name.alias("name"), F.col("l_linenumber").alias("line"), F.repeat(F.lit("A"), F.col("l_quantity").cast("int")).alias("seq"))
    return tools.split_pairs(rows, 20).select("name", "line", F.length("seq").alias("size"), "file")


@query(f"""WITH {SEQS}, a AS (SELECT name, substr(seq, strpos(seq, 'TAGA') + 4) AS rest FROM seqs WHERE strpos(seq, 'TAGA') > 0) SELECT name, substr(rest, 1, strpos(rest, 'ATC') - 1) AS seq FROM a WHERE strpos(rest, 'ATC') > 0""")
def cut_between(spark, d):
    return tools.cut_between(_seqs(spark, d), "TAGA", "ATC").select("name", "seq")


@query(f"""WITH {SEQS}, a AS (SELECT name, seq, strpos(seq, 'TAAT') AS i FROM seqs)
SELECT name, u.part AS part, md5(u.seq) AS seq FROM (SELECT name, unnest(CASE WHEN i > 0 THEN [{{'part': 1, 'seq': substr(seq, 1, i - 1)}}, {{'part': 2, 'seq': substr(seq, i + 4)}}] ELSE [{{'part': 0, 'seq': seq}}] END) AS u FROM a)""")
def split_at_linker(spark, d):
    return tools.split_at_linker(_seqs(spark, d), "TAAT").select("name", "part", F.md5("seq").alias("seq"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 32 THEN substr(md5(l_orderkey || '/1'), 1, CAST(l_quantity AS INT)) ELSE md5(l_orderkey || '/1') END AS seq1, CASE WHEN l_quantity < 32 THEN substr(md5(l_orderkey || '/2'), 1, CAST(l_quantity AS INT)) ELSE md5(l_orderkey || '/2') END AS seq2 FROM lineitem")
def trim_by_overlap(spark, d):
    mate = lambda n: F.md5(F.concat("l_orderkey", F.lit(f"/{n}"))).alias(f"seq{n}")
    return tools.trim_by_overlap(_t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", mate(1), mate(2), F.col("l_quantity").cast("int").alias("insert"))).drop("insert")


@query(f"""WITH {SEQS}, q AS (SELECT name, seq, list_transform(string_split(seq, ''), lambda b: CASE b WHEN 'A' THEN 1e-4 WHEN 'C' THEN 1e-2 WHEN 'G' THEN 0.1 ELSE pow(10, -0.2) END) AS p FROM seqs),
c AS (SELECT name, seq, CASE WHEN length(seq) >= 4 THEN list_filter(generate_series(1, length(seq) - 3), lambda i: p[i] + p[i + 1] + p[i + 2] + p[i + 3] > 4 * pow(10, -0.25))[1] END AS cut FROM q)
SELECT name, CASE WHEN cut IS NULL THEN seq ELSE substr(seq, 1, cut - 1) END AS seq FROM c""")
def window_trim(spark, d):
    rows = _seqs(spark, d).select("name", "seq", F.translate("seq", "ACGT", "I5+#").alias("qual"))
    return tools.window_trim(rows, 4, 2.5).select("name", "seq")


@query("SELECT n_nationkey, CASE WHEN n_regionkey < 3 THEN n_name || '|kraken:taxid|' || (n_regionkey + 9) ELSE n_name END AS name FROM nation")
def taxid_headers(spark, d):
    n = _t(spark, d, "nation")
    return tools.with_taxid(n.select("n_nationkey", F.col("n_name").alias("name")), n.where("n_regionkey < 3").select(F.col("n_name").alias("name"), (F.col("n_regionkey") + 9).alias("tid")))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'x' || p_partkey ELSE 'ncbi|' || CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE -1 END || '|ref|X' || p_size || '|' END AS name FROM part")
def gi_headers(spark, d):
    p = _t(spark, d, "part")
    name = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("x"), "p_partkey")).otherwise(F.concat(F.lit("gi|"), "p_partkey", F.lit("|ref|X"), "p_size", F.lit("|")))
    return tools.gi_to_taxid(p.select("p_partkey", name.alias("name")), p.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("gi"), F.col("p_size").alias("tid")))


@query("""WITH p AS (SELECT p_partkey // 3 AS rec, p_partkey % 3 AS place, 'ACC' || p_partkey AS acc, p_size AS tid FROM part), k AS (SELECT * FROM p WHERE tid % 4 <> 0 AND rec IN (SELECT rec FROM p)), r AS (SELECT rec, string_agg(acc, ',' ORDER BY place) AS name FROM k WHERE tid NOT IN (5, 6, 7) GROUP BY rec)
SELECT name, 'S' || rec AS seq FROM r""")
def reformat_references(spark, d):
    """Three parts a record; a size that 4 divides has no taxon, the taxa 5 to 7 are banned."""
    p = _t(spark, d, "part")
    rec = F.floor(F.col("p_partkey") / 3)
    header = F.concat(F.lit("gi|"), "p_partkey", F.lit("|ref|ACC"), "p_partkey", F.lit(".1|"))
    records = p.groupBy(rec.alias("rec")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", header.alias("h")))), lambda x: x.h), "\x01").alias("header")).select("header", F.concat(F.lit("S"), "rec").alias("seq"))
    known = p.where("p_size % 4 <> 0").select(F.concat(F.lit("ACC"), "p_partkey").alias("acc"), F.col("p_size").alias("tid"))
    return tools.with_known_accessions(records, known, spark.createDataFrame([(5,), (6,), (7,)], "tid int"))


@query("""WITH m AS (SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY ALL), g AS (SELECT DISTINCT f, unnest(['F', 'O']) AS s FROM m)
SELECT f AS "row", g.s AS "column", coalesce(n, 0) AS a, 2 * coalesce(n, 0) AS b FROM g LEFT JOIN m USING (f, s)""")
def matrix_columns(spark, d):
    one = lambda c, by: F.sum((F.col("l_linestatus") == c).cast("long") * by).alias(c)
    both = [_t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(one("F", by), one("O", by)) for by in (1, 2)]
    return tools.both_columns(*both, "flag")


@query("""WITH c AS (SELECT l_suppkey AS name, avg(l_quantity) AS mean, 100 * avg(l_discount) * 10 AS percent, count(*) AS reads FROM lineitem WHERE l_suppkey % 4 <> 3 GROUP BY 1)
SELECT s_suppkey AS name FROM supplier LEFT JOIN c ON name = s_suppkey WHERE coalesce(mean, 0) >= 25 AND coalesce(percent, 0) >= 49 AND coalesce(reads, 0) >= 10 AND length(s_name) >= 5""")
def covered_contigs(spark, d):
    """Doubles are added as they come, but those of a mean on its limit in the order of the table, as SQL's loop does: there the verdict would hang on how files are split."""
    rows = _t(spark, d, "lineitem").where("l_suppkey % 4 <> 3").select(F.col("l_suppkey").alias("name"), "l_quantity", "l_discount", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    cover = keep(rows.groupBy("name").agg(F.avg("l_quantity").alias("mean"), (100 * F.avg("l_discount") * 10).alias("percent"), F.count("*").alias("reads")), "cover")
    edge = cover.where((F.abs(F.col("mean") - 25) < 1e-9) | (F.abs(F.col("percent") - 49) < 1e-9)).select("name")
    edge = F.broadcast(edge) if edge.count() <= 500_000 else edge
    along = Window.partitionBy("name").orderBy("file", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = rows.join(edge, "name", "left_semi").withColumns({f"_{c}": F.avg(c).over(along) for c in ("l_quantity", "l_discount")})
    exact = told.groupBy("name").agg(F.max_by(F.struct("_l_quantity", "_l_discount"), F.struct("file", "row")).alias("_m")).select("name", F.col("_m._l_quantity").alias("_mean"), (100 * F.col("_m._l_discount") * 10).alias("_percent"))
    cover = cover.join(exact, "name", "left").select("name", F.coalesce("_mean", "mean").alias("mean"), F.coalesce("_percent", "percent").alias("percent"), "reads")
    return tools.filter_by_coverage(_t(spark, d, "supplier").select(F.col("s_suppkey").alias("name"), F.col("s_name").alias("seq")), cover, 25, 49, 10, 5).select("name")


@query("""WITH c AS (SELECT l_suppkey AS contig, l_suppkey % 3 AS home, l_linenumber % 3 AS sample, avg(l_quantity) AS mean FROM lineitem GROUP BY ALL),
o AS (SELECT contig, home, max(CASE WHEN sample = home THEN mean ELSE 0 END) AS own, max(CASE WHEN sample <> home THEN mean ELSE 0 END) AS other FROM c GROUP BY ALL) SELECT contig, home, round(own, 6) AS own, round(other, 6) AS other, own >= 20 AND other <= 1.02 * own AS kept FROM o""")
def contigs_across_samples(spark, d):
    cover = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("contig"), (F.col("l_suppkey") % 3).alias("home"), (F.col("l_linenumber") % 3).alias("sample")).agg(F.avg("l_quantity").alias("mean"))
    return tools.across_samples(cover, 20, 1.02).withColumn("own", F.round("own", 6)).withColumn("other", F.round("other", 6))


@query(f"""WITH {SEQS}, s AS (SELECT source, length(seq) AS len, seq FROM seqs), r AS (SELECT source, len, sum(len) OVER (PARTITION BY source ORDER BY len DESC ROWS UNBOUNDED PRECEDING) AS b, sum(len) OVER (PARTITION BY source) AS t FROM s)
SELECT r.source AS file, (SELECT count(*) FROM s WHERE s.source IS NOT DISTINCT FROM r.source) AS scaffolds, CAST(max(t) AS BIGINT) AS bases, max(len) FILTER (2 * b >= t) AS n50 FROM r GROUP BY r.source""")
def assemblies(spark, d):
    return stats.assemblies(_seqs(spark, d).withColumnRenamed("source", "file"), "file")


# -------------------------------------------------------------------- masking


@query(f"""WITH {SEQS}, m AS (SELECT DISTINCT l_suppkey AS name, l_partkey + unnest([0, 1, 2]) AS i FROM lineitem WHERE l_quantity > 40), c AS (SELECT name, i - 1 AS i, substr(seq, i, 1) AS base FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs WHERE name IN (SELECT name FROM m))),
n AS (SELECT name, string_agg(CASE WHEN m.i IS NULL THEN base ELSE 'N' END, '' ORDER BY c.i) AS masked FROM c LEFT JOIN m USING (name, i) GROUP BY name) SELECT seqs.name, md5(coalesce(masked, seq)) AS seq FROM seqs LEFT JOIN n ON n.name = seqs.name""")
def mask_regions(spark, d):
    regions = _t(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 3).alias("end"))
    return masking.mask_regions(_seqs(spark, d).select("name", "seq"), regions).select("name", F.md5("seq").alias("seq"))


@query(f"""WITH {SEQS}, s AS (SELECT name, seq, unnest(list_distinct(list_transform(generate_series(0, length(seq) - 50 + 24, 25), lambda x: least(x, length(seq) - 50)))) AS st FROM seqs WHERE length(seq) >= 50),
src AS (SELECT name AS chrom, st AS "start", st + 50 AS "end" FROM s WHERE len(list_distinct(list_transform(generate_series(1, 47), lambda i: substr(seq, st + i, 4)))) < 36), {MERGED} SELECT * FROM merged""")
def low_complexity(spark, d):
    return masking.low_complexity(_seqs(spark, d), 50, 25, 4, 36)


@query(f"""WITH {SEQS}, s AS (SELECT name, seq, unnest(generate_series(1, length(seq) - 5)) AS i FROM seqs WHERE length(seq) >= 6), src AS (SELECT name AS chrom, i - 1 AS "start", i + 5 AS "end" FROM s WHERE substr(seq, i, 6) = repeat(substr(seq, i, 2), 3)), {MERGED} SELECT * FROM merged""")
def short_repeats(spark, d):
    return masking.repeats(_seqs(spark, d), 2, 3)


@query(f"""WITH {RUNS}, src AS (SELECT chrom, "start", "end" FROM runs WHERE depth < 3 OR depth > 80), {MERGED} SELECT * FROM merged""")
def odd_depths(spark, d):
    return masking.by_depth(intervals.depth_runs(_intervals(spark, d), _genome(spark, d)), 3, 80)


@query(f"""WITH {SEQS} SELECT name, length(seq) AS length, length(seq) - length(replace(seq, 'A', '')) AS a, length(seq) - length(replace(seq, 'C', '')) AS c, length(seq) - length(replace(seq, 'G', '')) AS g, length(seq) - length(replace(seq, 'T', '')) AS t, length(regexp_replace(seq, '[ACGT]', '', 'g')) AS other,
(length(seq) - length(replace(seq, 'CG', ''))) // 2 AS cpg FROM seqs""")
def composition(spark, d):
    return masking.composition(_seqs(spark, d))


@query(f"""WITH {SEQS}, r AS (SELECT DISTINCT l_suppkey AS chrom, l_partkey AS s, l_partkey + CAST(l_quantity AS BIGINT) AS e FROM lineitem), j AS (SELECT chrom, s, least(e, length(seq)) AS e, seq FROM r JOIN seqs ON name = chrom)
SELECT chrom || ':' || (s + 1) || '-' || e AS name, substr(seq, s + 1, e - s) AS seq FROM j WHERE s < e""")
def subsequences(spark, d):
    return masking.subsequences(_seqs(spark, d), _intervals(spark, d).select("chrom", "start", "end").distinct())


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'chr:' || p_size ELSE 'chr' || p_size END AS chrom, CASE p_partkey % 3 WHEN 2 THEN NULL ELSE 1000 + p_partkey - 1 END AS "start", CASE p_partkey % 3 WHEN 0 THEN 2000 + p_partkey ELSE NULL END AS "end" FROM part""")
def parsed_regions(spark, d):
    text = F.when(F.col("p_partkey") % 3 == 0, F.format_string("chr:%d:%,d-%,d", F.col("p_size"), 1000 + F.col("p_partkey"), 2000 + F.col("p_partkey"))).when(F.col("p_partkey") % 3 == 1, F.format_string("chr%d:%d", F.col("p_size"), 1000 + F.col("p_partkey"))).otherwise(F.concat(F.lit("chr"), "p_size"))
    return _t(spark, d, "part").select("p_partkey", masking.parse_region(text).alias("r")).select("p_partkey", "r.*")


TWO = """two AS (SELECT seqs.name, coalesce(x.seq, '') AS seq FROM seqs LEFT JOIN (SELECT name, string_agg(substr('AMRWMCSYRSGKWYKT', CAST(4 * strpos('ACGT', substr(seq, i, 1)) + strpos('ACGT', substr(seq, length(seq) + 1 - i, 1)) - 4 AS BIGINT), 1), '' ORDER BY i) AS seq FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs) GROUP BY name) x ON x.name = seqs.name WHERE seqs.seq IS NOT NULL)"""


def _ambiguous(spark: SparkSession, d: str) -> DataFrame:
    s = _seqs(spark, d)
    return masking.merged_bases(s.select("name", "seq"), s.select("name", F.reverse("seq").alias("seq")))


@query(f"WITH {SEQS}, {TWO} SELECT name, md5(seq) AS seq FROM two")
def merged_bases(spark, d):
    """Each sequence against itself read backward."""
    return _ambiguous(spark, d).withColumn("seq", F.md5("seq"))


@query(f"WITH {SEQS}, {TWO}, e AS (SELECT name, i - 1 AS pos, substr(seq, i, 1) AS code FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM two)) SELECT name, CAST(pos // 10 * 10 AS BIGINT) AS start, count(*) AS sites FROM e WHERE code IN ('R', 'Y', 'S', 'W', 'K', 'M') GROUP BY ALL")
def heterozygous_sites(spark, d):
    return masking.heterozygosity(_ambiguous(spark, d), 10)


@query(f"""WITH {SEQS}, {TWO}, e AS (SELECT name, i, substr(seq, i, 1) AS code, CAST('0x' || substr(md5('1/' || name || '/' || i), 1, 7) AS BIGINT) AS h FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM two)),
o AS (SELECT *, CASE code WHEN 'R' THEN 'AG' WHEN 'Y' THEN 'CT' WHEN 'S' THEN 'CG' WHEN 'W' THEN 'AT' WHEN 'K' THEN 'GT' WHEN 'M' THEN 'AC' ELSE code END AS opt FROM e)
SELECT two.name, md5(coalesce(x.seq, '')) AS seq FROM two LEFT JOIN (SELECT name, string_agg(substr(opt, h % length(opt) + 1, 1), '' ORDER BY i) AS seq FROM o GROUP BY name) x ON x.name = two.name""")
def random_bases(spark, d):
    return masking.random_bases(_ambiguous(spark, d)).withColumn("seq", F.md5("seq"))


@query(f"""WITH {SEQS}, m AS (SELECT l_suppkey AS name, l_partkey AS i, min(['A', 'C', 'G', 'T'][l_linenumber % 4 + 1]) AS new FROM lineitem GROUP BY ALL), c AS (SELECT name, i - 1 AS i, substr(seq, i, 1) AS base FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs WHERE name IN (SELECT name FROM m))),
n AS (SELECT name, string_agg(coalesce(new, base), '' ORDER BY c.i) AS changed FROM c LEFT JOIN m USING (name, i) GROUP BY name) SELECT seqs.name, md5(coalesce(changed, seq)) AS seq FROM seqs LEFT JOIN n ON n.name = seqs.name""")
def mutated(spark, d):
    base = F.element_at(F.array(*map(F.lit, "ACGT")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    changes = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("name"), F.col("l_partkey").alias("pos")).agg(F.min(base).alias("base"))
    return masking.mutate(_seqs(spark, d).select("name", "seq"), changes).select("name", F.md5("seq").alias("seq"))


#: Pieces of a pileup's base column: what the base is read as, and the indel behind it.
PILEUP = [(".", ".", None), (",", ".", None), ("A", "A", None), (".+12AGAGAGAGAGAG", ".", "I" + "AG" * 6), ("c-1t", "C", "DT"), ("*", "*", None), ("^+.", ".", None), ("g$", "G", None), (",-100" + "acgtt" * 20, ".", "D" + "ACGTT" * 20)]


@query(f"""WITH p AS (SELECT l_suppkey, l_partkey, (l_orderkey + l_linenumber) % {len(PILEUP)} AS k FROM lineitem), a AS (SELECT l_suppkey, l_partkey, {[x for _, x, _ in PILEUP]}[k + 1] AS allele FROM p UNION ALL SELECT l_suppkey, l_partkey, {[x or '' for _, _, x in PILEUP]}[k + 1] FROM p)
SELECT l_suppkey, l_partkey, allele, CAST(count(*) AS INT) AS n FROM a WHERE allele <> '' GROUP BY ALL""")
def pileup_alleles(spark, d):
    piece = F.element_at(F.array(*[F.lit(p) for p, _, _ in PILEUP]), ((F.col("l_orderkey") + F.col("l_linenumber")) % len(PILEUP) + 1).cast("int"))
    piles = _t(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.array_join(F.collect_list(piece), "").alias("bases"))
    return piles.select("l_suppkey", "l_partkey", F.inline(masking.reads_of_pileup(F.col("bases"))))


# -------------------------------------------------------------------- depths


DEEP = f"""{SEQS}, {_kmer_sql('km', 'seqs')}, c AS (SELECT kmer, count(*) AS d FROM km GROUP BY kmer)"""


@query(f"""WITH {DEEP}, l AS (SELECT name, list(d ORDER BY d DESC) AS c FROM km JOIN c USING (kmer) GROUP BY name), m AS (SELECT name, c[least(CAST(floor(len(c) * 0.54) AS INT) + 1, len(c))] AS median FROM l)
SELECT seqs.name, CASE WHEN coalesce(median, 0) < 3 THEN 'low' WHEN median > 9 THEN 'high' ELSE 'mid' END AS file FROM seqs LEFT JOIN m ON m.name = seqs.name""")
def depth_classes(spark, d):
    return depths.depth_classes(_seqs(spark, d), K, 3, 9)


@query(f"""WITH {DEEP}, j AS (SELECT name, pos, d FROM km JOIN c USING (kmer)), b AS (SELECT a.name, a.d AS x, b.d AS y FROM j a JOIN j b ON a.name = b.name AND b.pos = a.pos + 1) SELECT name, count(*) AS errors FROM b WHERE greatest(x, y) >= 6 AND least(x, y) <= 2 AND greatest(x, y) >= 4 * least(x, y) GROUP BY name""")
def kmer_errors(spark, d):
    return depths.errors(_seqs(spark, d), K, 4, 2, 6)


CLUSTERED = f"""{SEQS}, {_kmer_sql('km', 'seqs', 31)}, t AS (SELECT DISTINCT name AS a, kmer FROM (SELECT name, kmer, pos, max(pos) OVER (PARTITION BY name) AS last FROM km) WHERE pos = 0 OR pos = last),
e AS (SELECT DISTINCT t.a, km.name AS b FROM t JOIN km USING (kmer)), f AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT name AS n, name AS m FROM seqs WHERE length(seq) >= 31 UNION SELECT r.n, f.b FROM r JOIN f ON f.a = r.m), cl AS (SELECT n AS name, min(m) AS cluster FROM r GROUP BY n)"""


@query(f"WITH RECURSIVE {CLUSTERED} SELECT * FROM cl")
def overlap_clusters(spark, d):
    return depths.clusters(_seqs(spark, d), 31)


@query(f"WITH RECURSIVE {CLUSTERED} SELECT name, cluster FROM (SELECT cl.name, cluster, row_number() OVER (PARTITION BY cluster ORDER BY length(seq) DESC, cl.name) AS i FROM cl JOIN seqs ON seqs.name = cl.name) WHERE i = 1")
def cluster_heads(spark, d):
    s = _seqs(spark, d).select("name", "seq")
    return depths.longest_of(depths.clusters(s, 31).join(s, "name")).select("name", "cluster")


HISTOGRAM = f"{DEEP}, h AS (SELECT d AS depth, count(*) AS kmers FROM c GROUP BY d)"


@query(f"WITH {HISTOGRAM} SELECT a.depth, round(sum(b.kmers) / 5, 6) AS kmers FROM h a JOIN h b ON abs(a.depth - b.depth) <= 2 GROUP BY a.depth")
def smooth_histogram(spark, d):
    return depths.smoothed(kmers.histogram(kmers.counts(_seqs(spark, d), K)), 2).withColumn("kmers", F.round("kmers", 6))


@query(f"""WITH {HISTOGRAM}, w AS (SELECT *, lag(kmers) OVER (ORDER BY depth) AS l, lead(kmers) OVER (ORDER BY depth) AS r FROM h WHERE depth >= 2), t AS (SELECT * FROM w WHERE kmers >= 2 AND kmers > coalesce(l, -1) AND kmers >= coalesce(r, -1))
SELECT depth AS centre, kmers AS height, coalesce(lag(depth) OVER (ORDER BY depth), 2) AS start, lead(depth) OVER (ORDER BY depth) AS stop FROM t""")
def depth_peaks(spark, d):
    return depths.peaks(kmers.histogram(kmers.counts(_seqs(spark, d), K)), 2)


QUALITIES = "q AS (SELECT CAST(l_quantity AS INT) AS quality, count(*) AS bases, CAST(sum((l_discount > 0.07)::INT) AS BIGINT) AS wrong FROM lineitem GROUP BY 1), m AS (SELECT *, round(-10 * log10((wrong + 1) / (bases + 1)), 6) AS measured FROM q)"


def _measured(spark: SparkSession, d: str) -> DataFrame:
    return depths.true_qualities(_t(spark, d, "lineitem").select(F.col("l_quantity").cast("int").alias("quality"), (F.col("l_discount") <= 0.07).alias("right")))


@query(f"WITH {QUALITIES} SELECT * FROM m")
def true_qualities(spark, d):
    return _measured(spark, d)


@query(f"WITH {QUALITIES} SELECT p_partkey, p_size AS quality, coalesce(CAST(round(measured) AS INT), p_size) AS new FROM part LEFT JOIN m ON quality = p_size")
def recalibrated(spark, d):
    return depths.recalibrated(_t(spark, d, "part").select("p_partkey", F.col("p_size").alias("quality")), _measured(spark, d)).select("p_partkey", "quality", "new")


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 11)}, {_kmer_sql('rk', 'refs', 11)}, d AS (SELECT DISTINCT kmer FROM rk), n1 AS (SELECT DISTINCT substr(kmer, 1, i - 1) || b || substr(kmer, i + 1) AS x FROM d, (SELECT unnest(generate_series(1, 11)) AS i), (SELECT unnest(['A', 'C', 'G', 'T']) AS b)),
n2 AS (SELECT DISTINCT substr(x, 1, i - 1) || b || substr(x, i + 1) AS x FROM n1, (SELECT unnest(generate_series(1, 11)) AS i), (SELECT unnest(['A', 'C', 'G', 'T']) AS b)), near AS (SELECT DISTINCT greatest(x, reverse(translate(x, 'ACGT', 'TGCA'))) AS kmer FROM n2)
SELECT name, count(*) AS hits FROM km WHERE kmer IN (SELECT kmer FROM near) GROUP BY name HAVING count(*) >= 5""")
def kmer_match_two_off(spark, d):
    return kmers.match(_seqs(spark, d), _refs(spark, d), 11, 5, substitutions=2)


@query(f"WITH {SEQS}, e AS (SELECT name, md5(upper(seq)) AS m FROM seqs) SELECT name, m AS digest FROM e")
def sequence_digests(spark, d):
    return _seqs(spark, d).select("name", F.md5(F.upper("seq")).alias("digest"))


@query(f"WITH {SEQS}, p AS (SELECT 'contig_' || name AS name, seq FROM seqs WHERE source = 'src0' UNION ALL SELECT CAST(name AS VARCHAR), seq FROM seqs WHERE source <> 'src0') SELECT name, md5(seq) AS seq FROM p")
def contigs_and_rest(spark, d):
    s = _seqs(spark, d)
    return s.where("source = 'src0'").select(F.concat(F.lit("contig_"), F.col("name").cast("string")).alias("name"), "seq").unionByName(s.where("source <> 'src0'").select(F.col("name").cast("string").alias("name"), "seq")).select("name", F.md5("seq").alias("seq"))


@query("SELECT p_partkey, list_transform(string_split(upper(p_brand), ''), lambda c: ord(c) - 33) AS phred, regexp_replace(translate(upper(p_name), 'RYSWKMBDHVU', 'ACCAGACAAAT'), '[^ACGTN]', 'N', 'g') AS bases FROM part")
def base_codes(spark, d):
    return _t(spark, d, "part").select("p_partkey", S.phred(F.upper("p_brand")).alias("phred"), S.plain_bases(F.col("p_name")).alias("bases"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'NC_' || p_size || '.' || p_partkey ELSE p_name || '|x' END AS acc FROM part")
def versioned_accessions(spark, d):
    header = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("gi|"), "p_partkey", F.lit("|ref|NC_"), "p_size", F.lit("."), "p_partkey", F.lit("|"))).otherwise(F.concat("p_name", F.lit("|x")))
    return _t(spark, d, "part").select("p_partkey", S.versioned_accession(header).alias("acc"))
