"""Queries that write the driver's tables in file formats and read them back, streams over files, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.operators import intervals, sam, taxonomy
from lodestrand.operators.work import new_folder, once
from lodestrand.plans.registry import ALN, BUSHY, BUSHY_HITS, INTERVALS, LCA, RUNS, SEQS, _alignments, _bushy, _bushy_hits, _genome, _intervals, _seqs, _t, query
from lodestrand.sources import fastq, text
from lodestrand.streaming import events as windows


# ----------------------------------------------------------- reads and hits


def _lsam(spark: SparkSession, d: str) -> DataFrame:
    hit = F.struct(F.col("l_quantity").alias("score"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ref"))
    rows = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("score"), F.array_sort(F.array_distinct(F.collect_list(hit))).alias("hits"))
    tags = F.when(F.col("l_orderkey") % 3 == 0, F.array(F.lit("Viruses"), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return rows.select(F.concat(F.lit("r"), "l_orderkey").alias("name"), F.lit(64).alias("flag"), "score", F.lit("ACGT").alias("seq"), F.lit(None).cast("string").alias("qual"), F.when(F.col("l_orderkey") % 5 == 0, F.slice("hits", 1, 0)).otherwise(F.col("hits")).alias("hits"), tags.alias("tags"))


@query("""WITH h AS (SELECT DISTINCT l_orderkey AS o, l_quantity AS q, 'S' || l_suppkey AS r FROM lineitem), s AS (SELECT o, max(q) AS score, string_agg(CAST(q AS BIGINT) || ':' || r, ' ' ORDER BY q, r) AS hits FROM h GROUP BY o)
SELECT 'r' || o AS name, 64 AS flag, score, 'ACGT' AS seq, '*' AS qual, CASE WHEN o % 5 = 0 THEN '' ELSE hits END AS hits, CASE WHEN o % 3 = 0 THEN 'Viruses x' ELSE '' END AS tags FROM s""")
def lsam_files(spark, d):
    path = new_folder(spark, "lsam")
    text.write_lsam(_lsam(spark, d), path)
    back = text.lsam(spark, path)
    hits = F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h.score.cast("long").cast("string"), h.ref)), " ")
    return back.select("name", "flag", "score", "seq", "qual", hits.alias("hits"), F.array_join("tags", " ").alias("tags"))


@query(f"WITH {SEQS} SELECT 'r' || name AS name, 'c ' || coalesce(source, '') AS comment, coalesce(seq, '') AS seq, translate(coalesce(seq, ''), 'ACGT', '@I+#') AS qual FROM seqs")
def fastq_files(spark, d):
    """Written as FASTQ, read in ranges of 20,000 bytes."""
    path = new_folder(spark, "fastq")
    fastq.register(spark)
    seq = F.coalesce("seq", F.lit(""))
    text.write_fastx(_seqs(spark, d).select(F.concat(F.lit("r"), "name", F.lit(" c "), F.coalesce("source", F.lit(""))).alias("name"), seq.alias("seq"), F.translate(seq, "ACGT", "@I+#").alias("qual")), path)
    return spark.read.format("fastq").option("splitBytes", 20_000).load(path).select("name", "comment", "seq", "qual")


@query(f"WITH {SEQS} SELECT 'r' || name AS name, coalesce(seq, '') AS seq FROM seqs")
def fasta_files(spark, d):
    path = new_folder(spark, "fasta")
    text.write_fastx(_seqs(spark, d).select(F.concat(F.lit("r"), "name").alias("name"), F.coalesce("seq", F.lit("")).alias("seq")), path)
    return text.fasta(spark, path).select("name", "seq")


@query(f"WITH {SEQS} SELECT coalesce(source, 'none') AS file, count(*) AS reads FROM seqs GROUP BY 1")
def files_by_source(spark, d):
    """FASTA files in a folder for each source, counted by folder."""
    path = new_folder(spark, "split")
    text.write_fastx(_seqs(spark, d).select(F.col("name").cast("string").alias("name"), F.coalesce("seq", F.lit("")).alias("seq"), F.coalesce("source", F.lit("none")).alias("file")), path, by="file")
    return spark.read.text(path).where(F.col("value").startswith(">")).groupBy("file").agg(F.count("*").alias("reads"))


@query("SELECT DISTINCT 'r' || o_custkey AS id FROM orders")
def id_lists(spark, d):
    path = new_folder(spark, "ids")
    _t(spark, d, "orders").select(F.concat(F.lit(" r"), "o_custkey", F.lit(" ")).alias("value")).distinct().write.text(path)
    return text.read_ids(spark, path)


# ---------------------------------------------------- alignments and intervals


@query(f"WITH {ALN} SELECT qname, flag, CAST(rname AS VARCHAR) AS rname, pos, mapq, (x + 1) || 'S' || q || 'M' || (x + 1) || 'I' || q || 'M' || (x + 2) || 'D' || q || 'M' AS cigar, CAST(line AS VARCHAR) AS line, 'v' || (line % 2) AS xb FROM aln")
def sam_files(spark, d):
    path = new_folder(spark, "sam")
    tags = F.create_map(F.lit("XA"), F.col("line").cast("string"), F.lit("XB"), F.concat(F.lit("v"), F.col("line") % 2))
    rows = _alignments(spark, d).withColumns({"pnext": F.lit(0), "tlen": F.lit(0), "seq": F.lit("*"), "qual": F.lit("*"), "tags": tags})
    text.write_sam(rows, path, ["@HD\tVN:1.6", "@CO\ttext"])
    return text.sam(spark, path).select("qname", "flag", "rname", "pos", "mapq", "cigar", F.col("tags")["XA"].alias("line"), F.col("tags")["XB"].alias("xb"))


@query(f"""WITH {ALN} SELECT CAST(rname AS VARCHAR) AS chrom, pos - 1 AS "start", pos - 1 + 3 * q + x + 2 AS "end", qname || CASE WHEN flag & 64 <> 0 THEN '/1' ELSE '/2' END AS name, CAST(mapq AS DOUBLE) AS score, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM aln WHERE flag & 4 = 0""")
def bed_files(spark, d):
    path = new_folder(spark, "bed")
    text.write_table(sam.to_bed(_alignments(spark, d)), path)
    return text.bed(spark, path).drop("fraction")


@query("SELECT CAST(l_suppkey AS VARCHAR) AS chrom, l_partkey AS pos, 'ACGT'[l_linenumber % 4 + 1] AS ref, 'T' AS alt, CAST(max(l_quantity) AS VARCHAR) AS qual, 'PASS' AS filter, 'DP=' || count(*) AS info, '0/1' AS sample FROM lineitem GROUP BY l_suppkey, l_partkey, l_linenumber % 4")
def vcf_files(spark, d):
    path = new_folder(spark, "vcf")
    ref = F.substr(F.lit("ACGT"), F.col("k") + 1, F.lit(1))
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("pos"), (F.col("l_linenumber") % 4).alias("k")).agg(F.max("l_quantity").alias("qual"), F.concat(F.lit("DP="), F.count("*").cast("string")).alias("info"))
    text.write_vcf(rows.select("chrom", "pos", F.lit(None).cast("string").alias("id"), ref.alias("ref"), F.lit("T").alias("alt"), "qual", F.lit("PASS").alias("filter"), "info", F.lit("GT").alias("format"), F.lit("0/1").alias("sample")), path)
    return text.vcf(spark, path).select("chrom", "pos", "ref", "alt", "qual", "filter", "info", "sample")


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS q, l_suppkey AS s, l_quantity AS b FROM lineitem), h AS (SELECT q, b, 'A' || s AS r FROM m UNION SELECT q, b, 'B' || s FROM m) SELECT 'q' || q AS name, max(b) AS score, string_agg(CAST(b AS BIGINT) || ':' || r, ' ' ORDER BY b DESC, r DESC) AS hits FROM h GROUP BY q""")
def m8_files(spark, d):
    path = new_folder(spark, "m8")
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity").distinct()
    sid = F.concat(F.lit("A"), F.col("l_suppkey").cast("string"), F.lit("\x01B"), F.col("l_suppkey").cast("string"))
    fixed = [F.lit(v).alias(n) for n, v in (("identity", 99.5), ("len", 30), ("mm", 1), ("gaps", 0), ("qs", 1), ("qe", 30), ("ss", 5), ("se", 34), ("evalue", 0.001))]
    text.write_table(rows.select(F.concat(F.lit("q"), "l_orderkey").alias("qid"), sid.alias("sid"), *fixed, F.col("l_quantity").alias("bits")), path)
    found = text.m8_to_lsam(text.m8(spark, path))
    return found.select("name", "score", F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h.score.cast("long").cast("string"), h.ref)), " ").alias("hits"))


@query(f"""WITH {RUNS}, m AS (SELECT chrom, sum(("end" - "start") * depth) / sum("end" - "start") AS mean FROM runs GROUP BY chrom) SELECT CAST(chrom AS VARCHAR) AS chrom, "start", "end", depth FROM runs JOIN m USING (chrom) WHERE depth > 1.2 * mean""")
def genomecov_files(spark, d):
    """Depth runs and lengths written and read, then the runs of over 1.2 times the mean depth."""
    runs_path, genome_path = new_folder(spark, "genomecov"), new_folder(spark, "genome")
    text.write_table(intervals.depth_runs(_intervals(spark, d), _genome(spark, d)).select("chrom", "start", "end", "depth"), runs_path)
    text.write_table(_genome(spark, d), genome_path)
    runs, size = text.genomecov(spark, runs_path), text.genome(spark, genome_path)
    mean = runs.groupBy("chrom").agg(F.sum((F.col("end") - F.col("start")) * F.col("depth")).alias("bases")).join(size, "chrom").select("chrom", (F.col("bases") / F.col("length")).alias("mean"))
    return runs.join(mean, "chrom").where("depth > 1.2 * mean").drop("mean")


# ------------------------------------------------------------------- taxonomy


@query(f"WITH {BUSHY.split(', up AS')[0]} SELECT tid, parent, rank, name FROM nodes")
def taxonomy_dumps(spark, d):
    """nodes.dmp and names.dmp, with a synonym for each taxon, which is no name of it."""
    a, b = new_folder(spark, "nodes"), new_folder(spark, "names")
    nodes = _bushy(spark, d)
    nodes.select(F.concat_ws("\t|\t", "tid", "parent", "rank", F.lit("XX\t|")).alias("value")).write.text(a)
    names = nodes.select("tid", F.explode(F.array(F.struct("name", F.lit("scientific name").alias("kind")), F.struct(F.lit("other").alias("name"), F.lit("synonym").alias("kind")))).alias("n"))
    names.select(F.concat_ws("\t|\t", "tid", "n.name", F.lit(""), F.concat("n.kind", F.lit("\t|"))).alias("value")).write.text(b)
    return text.nodes(spark, a).join(text.names(spark, b), "tid")


@query("WITH p AS (SELECT p_partkey, 'A' || p_partkey // 2 AS acc, p_size FROM part) SELECT acc, CAST(arg_max(p_size, p_partkey) AS BIGINT) AS tid FROM p GROUP BY acc")
def accession_files(spark, d):
    """Each accession in two versions; the later line holds, whatever its version."""
    path = new_folder(spark, "acc2tid")
    version = F.when(F.col("p_partkey") % 4 == 0, 10).otherwise(9 - F.col("p_partkey") % 2)
    acc = F.concat(F.lit("A"), F.floor(F.col("p_partkey") / 2))
    lines = _t(spark, d, "part").select("p_partkey", F.concat_ws("\t", acc, F.concat(acc, F.lit("."), version), "p_size", F.lit("7")).alias("value"))
    lines.repartitionByRange(1, "p_partkey").sortWithinPartitions("p_partkey").select("value").write.text(path)  # the order of lines is what is tested
    return text.accession2taxid(spark, path)


@query(f"""WITH RECURSIVE {BUSHY}, {BUSHY_HITS}, {LCA}, t AS (SELECT count(*) AS n FROM lca), st AS (SELECT lca AS tid, count(*) AS n FROM lca GROUP BY 1),
r AS (SELECT ancestor AS tid, rank, name, depth, sum(st.n) AS clade, sum(CASE WHEN distance = 0 THEN st.n ELSE 0 END) AS stay FROM st JOIN tree USING (tid) GROUP BY ALL)
SELECT printf('%6.2f', round(clade * 100.0 / t.n, 2)) || chr(9) || CAST(clade AS BIGINT) || chr(9) || CAST(stay AS BIGINT) || chr(9) || CASE WHEN rank = 'superkingdom' THEN 'D' WHEN rank IN ('family', 'order', 'genus', 'species') THEN upper(rank[1]) ELSE '-' END || chr(9) || tid || chr(9) || repeat('  ', CAST(depth AS INT)) || name AS line FROM r, t""")
def report_files(spark, d):
    path = new_folder(spark, "report")
    tree = taxonomy.closure(_bushy(spark, d))
    lcas = taxonomy.common_ancestor(_bushy_hits(spark, d), tree)
    total = lcas.agg(F.count("*").alias("n"))
    rows = taxonomy.report(lcas, tree, 1).join(F.broadcast(total), F.lit(True)).withColumn("percent", F.round(F.col("clade") * 100.0 / F.col("n"), 2)).drop("n")  # one row
    taxonomy.report_lines(rows, tree).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("SELECT o_custkey AS tid, o_orderkey % 50 AS aligned FROM orders")
def aligned_taxa_files(spark, d):
    path = new_folder(spark, "aligned")
    text_line = F.concat_ws(",", F.lit("a"), F.lit("b"), "o_orderkey", F.lit(""), "o_custkey", F.lit("0"), F.lit("0"), F.lit("0"), F.col("o_orderkey") % 50)
    _t(spark, d, "orders").select(text_line.alias("value")).write.text(path)
    return text.aligned_taxa(spark, path).select("tid", "aligned")


@query("SELECT n_name AS name, 'ACGTAC' || 'GT' || n_nationkey % 10 AS seq FROM nation")
def phylip_files(spark, d):
    """One interleaved file: a count, then two blocks of a line for each nation."""
    path = new_folder(spark, "phylip")
    n = _t(spark, d, "nation")
    first = n.select(F.col("n_nationkey").alias("at"), F.concat(F.lit(" "), "n_name", F.lit("  ACG TAC")).alias("value"))
    second = n.select((F.col("n_nationkey") + 1_000).alias("at"), F.concat(F.lit("  GT"), F.col("n_nationkey") % 10).alias("value"))
    head = n.agg(F.lit(-1).alias("at"), F.concat(F.count("*").cast("string"), F.lit(" 9")).alias("value"))
    head.unionAll(first).unionAll(second).repartitionByRange(1, "at").sortWithinPartitions("at").select("value").write.text(path)  # one file by its format
    return text.phylip(spark, path)


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'fastq' WHEN 1 THEN 'fasta' WHEN 2 THEN 'sam' WHEN 3 THEN 'vcf' WHEN 4 THEN 'unknown' ELSE 'bed' END AS format FROM part")
def file_formats(spark, d):
    names = F.array(*map(F.lit, ["a/b.FQ.gz", "x.fna", "r.sam.zst", "v.vcf.bz2", "noformat", "p.bed"]))
    return _t(spark, d, "part").select("p_partkey", text.format_of(F.element_at(names, (F.col("p_partkey") % 6 + 1).cast("int"))).alias("format"))


# -------------------------------------------------------------------- streams


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT user_id, event_type, value FROM events WHERE value > 50")
def streamed_events(spark, d):
    path, state = new_folder(spark, "stream"), new_folder(spark, "checkpoint")
    windows.append(_stream(spark, d).where("value > 50").select("user_id", "event_type", "value"), path, state).awaitTermination()
    return spark.read.parquet(path)


@query("SELECT DISTINCT user_id, event_type, ts FROM events")
def streamed_first(spark, d):
    """Every event twice, the second copy left out."""
    path, state = new_folder(spark, "first"), new_folder(spark, "checkpoint")
    twice = _stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    windows.append(windows.first_seen(twice, "400 days").select("user_id", "event_type", "ts"), path, state).awaitTermination()
    return spark.read.parquet(path)


@query("SELECT user_id, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def streamed_totals(spark, d):
    path, state = new_folder(spark, "totals"), new_folder(spark, "checkpoint")
    windows.append_each(windows.running_totals(_stream(spark, d).where("user_id is not null")), path, state).awaitTermination()
    last = spark.read.option("recursiveFileLookup", "false").parquet(path)
    return last.groupBy("user_id").agg(F.max_by("n", "batch").alias("n"), F.round(F.max_by("total", "batch"), 4).alias("total"))


@query("""WITH w AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start, event_type, value FROM events) SELECT window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY ALL""")
def sliding_events(spark, d):
    return windows.sliding(_t(spark, d, "events"), "1 hour", "30 minutes").withColumn("total", F.round("total", 4))


@query(f"WITH {INTERVALS} SELECT count(*) AS n FROM iv")
def table_folder(spark, d):
    """A table written in tabs with a header and counted as read back."""
    path = new_folder(spark, "table")
    text.write_table(_intervals(spark, d).select("chrom", "start", "end"), path, ["#chrom\tstart\tend"])
    return spark.read.text(path).where(~F.col("value").startswith("#")).agg(F.count("*").alias("n"))


@query(f"WITH {SEQS} SELECT 'r' || name AS name, coalesce(seq, '') AS seq, translate(coalesce(seq, ''), 'ACGT', 'I5+#') AS qual FROM seqs")
def quality_files(spark, d):
    """Each sequence, and its qualities as numbers in lines of 30."""
    fa, qual = new_folder(spark, "fasta"), new_folder(spark, "qual")
    rows = _seqs(spark, d).select(F.concat(F.lit("r"), "name").alias("name"), F.coalesce("seq", F.lit("")).alias("seq"))
    text.write_fastx(rows, fa)
    values = F.regexp_replace(F.regexp_replace(F.translate("seq", "ACGT", "abcd"), "(.{30})", "$1\n"), "([abcd])", "$1 ")
    for letter, value in zip("abcd", ("40", "20", "10", "2")):
        values = F.replace(values, F.lit(letter), F.lit(value))
    rows.select(F.concat(F.lit(">"), "name", F.lit("\n"), values).alias("value")).write.text(qual)
    return text.fasta_with_quality(spark, fa, qual)


@query("SELECT 'm:' || o_orderkey || ':1' AS name, 'ACGT' AS seq, 'I5+#' AS qual FROM orders")
def scarf_files(spark, d):
    path = new_folder(spark, "scarf")
    _t(spark, d, "orders").select(F.concat(F.lit("m:"), "o_orderkey", F.lit(":1:ACGT:I5+#")).alias("value")).write.text(path)
    return text.scarf(spark, path)


@query("SELECT p_partkey AS gi, CAST(p_size AS BIGINT) AS tid FROM part")
def gi_files(spark, d):
    path = new_folder(spark, "gi")
    text.write_table(_t(spark, d, "part").select("p_partkey", "p_size"), path)
    return text.gi_taxids(spark, path)


@query("SELECT 'nt' AS source, 'A' || n_nationkey AS accessions FROM nation UNION ALL SELECT 'uv', 'U' || r_regionkey FROM region")
def united_references(spark, d):
    nt = _t(spark, d, "nation").select(F.concat(F.lit("gi|"), "n_nationkey", F.lit("|ref|A"), "n_nationkey", F.lit(".2|")).alias("header"), F.lit("AC").alias("seq"))
    uv = _t(spark, d, "region").select(F.concat(F.lit("gnl|uv|U"), "r_regionkey", F.lit(":1-9 name")).alias("header"), F.lit("GT").alias("seq"))
    return text.united_references({"nt": nt, "uv": uv}).select("source", F.array_join("accessions", ",").alias("accessions"))


@query("SELECT r_regionkey, 1 AS runs FROM region")
def finished_stages(spark, d):
    """A stage that is asked for twice is made once."""
    path, made = new_folder(spark, "stage"), []

    def stage() -> DataFrame:
        made.append(1)
        return _t(spark, d, "region")

    once(spark, path, stage)
    return once(spark, path, stage).select("r_regionkey", F.lit(len(made)).alias("runs"))
