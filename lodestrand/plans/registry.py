"""Queries of the library's operators over the driver's tables, and their SQL.

Stand-ins: a read is an order, its hits are line items (score: quantity,
accession: part, or supplier as a taxon of its own); suppliers, nations and
regions under one root are the taxonomy; documents reduced to ACGT are
sequences, benchmark items the contaminants; a line item is also an interval
and an alignment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.functions import seq as S
from lodestrand.operators import intervals, kmers, overlaps, qc, reads, rearrange, sam, stats, taxonomy, variants
from lodestrand.sources import text as sources
from lodestrand.streaming import events as windows

_FOUND: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}
K = 9


def query(sql: str):
    def add(f):
        _FOUND[f.__name__] = (f, sql)
        return f

    return add


def _all() -> None:
    """Load the modules whose queries stand in ``_FOUND`` beside those of this one."""
    from lodestrand.plans import formats, indexed, measured, quality, results, sites, streams, tables  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return {name: f for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    _all()
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}


# ---------------------------------------------------------------- stand-ins


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    root = spark.createDataFrame([(1, 1, "no", "root")], "tid long, parent long, rank string, name string")
    region = _t(spark, d, "region").select((F.col("r_regionkey") + 1_000).cast("long").alias("tid"), F.lit(1).cast("long").alias("parent"), F.lit("superkingdom").alias("rank"), F.col("r_name").alias("name"))
    nation = _t(spark, d, "nation").select((F.col("n_nationkey") + 10_000).cast("long").alias("tid"), (F.col("n_regionkey") + 1_000).cast("long").alias("parent"), F.lit("family").alias("rank"), F.col("n_name").alias("name"))
    supplier = _t(spark, d, "supplier").select((F.col("s_suppkey") + 100_000).alias("tid"), (F.col("s_nationkey") + 10_000).cast("long").alias("parent"), F.lit("species").alias("rank"), F.col("s_name").alias("name"))
    return root.unionAll(region).unionAll(nation).unionAll(supplier)


NODES = """nodes AS (
    SELECT 1::BIGINT AS tid, 1::BIGINT AS parent, 'no' AS rank, 'root' AS name
    UNION ALL SELECT r_regionkey + 1000, 1, 'superkingdom', r_name FROM region
    UNION ALL SELECT n_nationkey + 10000, n_regionkey + 1000, 'family', n_name FROM nation
    UNION ALL SELECT s_suppkey + 100000, s_nationkey + 10000, 'species', s_name FROM supplier)"""
TREE = f"""{NODES}, up AS (
    SELECT tid, tid AS ancestor, 0 AS distance FROM nodes
    UNION ALL SELECT up.tid, nodes.parent, up.distance + 1 FROM up JOIN nodes ON nodes.tid = up.ancestor WHERE nodes.tid <> nodes.parent),
depths AS (SELECT tid AS ancestor, max(distance) AS depth FROM up GROUP BY tid),
tree AS (SELECT up.tid, up.ancestor, up.distance, n.rank, n.name, d.depth FROM up JOIN nodes n ON n.tid = up.ancestor JOIN depths d ON d.ancestor = up.ancestor)"""


def _tree(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.closure(_nodes(spark, d))


def _hits(spark: SparkSession, d: str) -> DataFrame:
    """read, tid, score: suppliers hit by orders, best score of each."""
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), (F.col("l_suppkey") + 100_000).alias("tid"), F.col("l_quantity").alias("score"))
    return rows.groupBy("read", "tid").agg(F.max("score").alias("score"))


HITS = "hits AS (SELECT l_orderkey AS read, l_suppkey + 100000 AS tid, max(l_quantity) AS score FROM lineitem GROUP BY ALL)"


def _bushy(spark: SparkSession, d: str) -> DataFrame:
    """A taxonomy with gaps: a region without a superkingdom's rank, nations that are no families, genera between nations and suppliers of which some are clades, suppliers that are no species, and a strain under each supplier."""
    region = _t(spark, d, "region").select((F.col("r_regionkey") + 1_000).cast("long").alias("tid"), F.lit(1).cast("long").alias("parent"), F.when(F.col("r_regionkey") == 4, "clade").otherwise("superkingdom").alias("rank"), F.col("r_name").alias("name"))
    nation = _t(spark, d, "nation").select((F.col("n_nationkey") + 10_000).cast("long"), (F.col("n_regionkey") + 1_000).cast("long"), F.when(F.col("n_nationkey") % 3 == 0, "order").otherwise("family"), "n_name")
    genus = _t(spark, d, "nation").withColumn("g", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select((20_000 + F.col("n_nationkey") * 10 + F.col("g")).cast("long"), (F.col("n_nationkey") + 10_000).cast("long"), F.when(F.col("g") == 1, "clade").otherwise("genus"), F.concat_ws(" ", "n_name", "g"))
    supplier = _t(spark, d, "supplier")
    species = supplier.select((F.col("s_suppkey") + 100_000).cast("long"), (20_000 + F.col("s_nationkey") * 10 + F.col("s_suppkey") % 3).cast("long"), F.when(F.col("s_suppkey") % 7 == 0, "no").otherwise("species"), "s_name")
    strain = supplier.select((F.col("s_suppkey") + 200_000).cast("long"), (F.col("s_suppkey") + 100_000).cast("long"), F.lit("no"), F.concat_ws(" ", "s_name", F.lit("strain")))
    root = spark.createDataFrame([(1, 1, "no", "root")], "tid long, parent long, rank string, name string")
    return root.unionAll(region).unionAll(nation).unionAll(genus).unionAll(species).unionAll(strain)


BUSHY = TREE.replace(NODES, """nodes AS (
    SELECT 1::BIGINT AS tid, 1::BIGINT AS parent, 'no' AS rank, 'root' AS name
    UNION ALL SELECT r_regionkey + 1000, 1, CASE WHEN r_regionkey = 4 THEN 'clade' ELSE 'superkingdom' END, r_name FROM region
    UNION ALL SELECT n_nationkey + 10000, n_regionkey + 1000, CASE WHEN n_nationkey % 3 = 0 THEN 'order' ELSE 'family' END, n_name FROM nation
    UNION ALL SELECT 20000 + n_nationkey * 10 + g, n_nationkey + 10000, CASE WHEN g = 1 THEN 'clade' ELSE 'genus' END, n_name || ' ' || g FROM nation, (SELECT unnest([0, 1, 2]) AS g)
    UNION ALL SELECT s_suppkey + 100000, 20000 + s_nationkey * 10 + s_suppkey % 3, CASE WHEN s_suppkey % 7 = 0 THEN 'no' ELSE 'species' END, s_name FROM supplier
    UNION ALL SELECT s_suppkey + 200000, s_suppkey + 100000, 'no', s_name || ' strain' FROM supplier)""")


def _bushy_hits(spark: SparkSession, d: str) -> DataFrame:
    """read, tid, score: suppliers hit by orders, every third line its strain."""
    tid = F.col("l_suppkey") + F.when(F.col("l_linenumber") % 3 == 0, 200_000).otherwise(100_000)
    return _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("read"), tid.alias("tid")).agg(F.max("l_quantity").alias("score"))


BUSHY_HITS = "hits AS (SELECT l_orderkey AS read, l_suppkey + CASE WHEN l_linenumber % 3 = 0 THEN 200000 ELSE 100000 END AS tid, max(l_quantity) AS score FROM lineitem GROUP BY ALL)"


def _skewed(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.floor(F.log2(F.col("l_suppkey") + 1)).cast("long").alias("tid"), F.col("l_quantity").alias("score"))
    return rows.groupBy("read", "tid").agg(F.max("score").alias("score"))


SKEWED = "hits AS (SELECT l_orderkey AS read, CAST(floor(log2(l_suppkey + 1)) AS BIGINT) AS tid, max(l_quantity) AS score FROM lineitem GROUP BY ALL)"


def _seqs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select(F.col("doc_id").alias("name"), F.upper(F.regexp_replace("text", "[^acgtACGT]+", "")).alias("seq"), "source")


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "benchmark").select(F.col("item_id").alias("name"), F.upper(F.regexp_replace("text", "[^acgtACGT]+", "")).alias("seq"))


SEQS = "seqs AS (SELECT doc_id AS name, upper(regexp_replace(text, '[^acgtACGT]', '', 'g')) AS seq, source FROM documents)"
REFS = "refs AS (SELECT item_id AS name, upper(regexp_replace(text, '[^acgtACGT]', '', 'g')) AS seq FROM benchmark)"


def _kmer_sql(name: str, source: str, k: int = K) -> str:
    return f"""{name} AS (SELECT name, pos, greatest(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS kmer FROM (
    SELECT name, i - 1 AS pos, substr(seq, i, {k}) AS kmer FROM (SELECT name, seq, unnest(generate_series(1, length(seq) - {k} + 1)) AS i FROM {source})))"""


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"), F.col("l_orderkey").alias("read"), F.col("l_linenumber").alias("line"))


INTERVALS = """iv AS (SELECT l_suppkey AS chrom, l_partkey AS "start", l_partkey + CAST(l_quantity AS BIGINT) AS "end", l_orderkey AS read, l_linenumber AS line FROM lineitem)"""


def _genome(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "part").agg((F.count("*") + 50).alias("length"))
    return _t(spark, d, "supplier").select(F.col("s_suppkey").alias("chrom")).join(F.broadcast(n), F.lit(True))  # one row


RUNS = f"""{INTERVALS}, genome AS (SELECT s_suppkey AS chrom, (SELECT count(*) + 50 FROM part) AS length FROM supplier),
ev AS (SELECT chrom, "start" AS pos, 1 AS d FROM iv UNION ALL SELECT chrom, "end", -1 FROM iv UNION ALL SELECT chrom, 0, 0 FROM genome),
st AS (SELECT chrom, pos, sum(d) AS d FROM ev WHERE chrom IN (SELECT chrom FROM genome) GROUP BY ALL),
dp AS (SELECT chrom, pos, CAST(sum(d) OVER (PARTITION BY chrom ORDER BY pos) AS BIGINT) AS depth FROM st),
ch AS (SELECT *, lag(depth) OVER (PARTITION BY chrom ORDER BY pos) AS was FROM dp),
lv AS (SELECT chrom, pos, depth, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS nxt FROM ch WHERE was IS NULL OR was <> depth),
runs AS (SELECT * FROM (SELECT chrom, pos AS "start", least(coalesce(nxt, length), length) AS "end", depth FROM lv JOIN genome USING (chrom)) WHERE "start" < "end")"""
MERGED = """isl AS (SELECT *, sum(new) OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS id FROM (
    SELECT *, CASE WHEN prev IS NULL OR "start" > prev THEN 1 ELSE 0 END AS new FROM (
        SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM src))),
merged AS (SELECT chrom, min("start") AS "start", max("end") AS "end" FROM isl GROUP BY chrom, id)"""


def _alignments(spark: SparkSession, d: str) -> DataFrame:
    """Line items as alignments: flags from line numbers and statuses, a CIGAR from quantity and discount."""
    flag = (
        F.when(F.col("l_linenumber") % 2 == 1, 0x41).otherwise(0x81) + F.when(F.col("l_returnflag") == "R", 4).otherwise(0) + F.when(F.col("l_linestatus") == "O", 16).otherwise(0)
        + F.when(F.col("l_tax") > 0.07, 0x400).otherwise(0) + F.when(F.col("l_tax") < 0.01, 0x200).otherwise(0) + F.when(F.col("l_discount") > 0.05, 2).otherwise(0) + F.when(F.col("l_discount") < 0.02, 8).otherwise(0)
    )
    q, x = F.col("l_quantity").cast("int"), F.round(F.col("l_discount") * 100).cast("int")
    cigar = F.concat(x + 1, F.lit("S"), q, F.lit("M"), x + 1, F.lit("I"), q, F.lit("M"), x + 2, F.lit("D"), q, F.lit("M"))
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("qname"), flag.alias("flag"), F.col("l_suppkey").alias("rname"), (F.col("l_partkey") + 1).alias("pos"), F.col("l_quantity").cast("int").alias("mapq"), cigar.alias("cigar"), ((F.col("l_suppkey") + F.col("l_linenumber") % 2)).alias("rnext"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("quality"))


ALN = """aln AS (SELECT CAST(l_orderkey AS VARCHAR) AS qname,
    CASE WHEN l_linenumber % 2 = 1 THEN 65 ELSE 129 END + CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END
    + CASE WHEN l_tax > 0.07 THEN 1024 ELSE 0 END + CASE WHEN l_tax < 0.01 THEN 512 ELSE 0 END + CASE WHEN l_discount > 0.05 THEN 2 ELSE 0 END + CASE WHEN l_discount < 0.02 THEN 8 ELSE 0 END AS flag,
    l_suppkey AS rname, l_partkey + 1 AS pos, CAST(l_quantity AS INT) AS mapq, CAST(l_quantity AS INT) AS q, CAST(round(l_discount * 100) AS INT) AS x,
    l_suppkey + l_linenumber % 2 AS rnext, l_linenumber AS line, l_extendedprice AS quality FROM lineitem)"""

# ----------------------------------------------------------------- taxonomy


@query(f"WITH RECURSIVE {TREE} SELECT tid, ancestor, CAST(distance AS INT) AS distance, rank, name, CAST(depth AS INT) AS depth FROM tree")
def taxonomy_closure(spark, d):
    return _tree(spark, d)


@query(f"WITH RECURSIVE {TREE} SELECT tid, string_agg(concat_ws('|', rank, name), ';' ORDER BY distance) AS lineage FROM tree GROUP BY tid")
def lineage(spark, d):
    return taxonomy.lineage(_tree(spark, d))


@query(f"""WITH RECURSIVE {TREE}, acc AS (SELECT p_partkey AS acc, 100000 + p_partkey % (SELECT count(*) FROM supplier) AS tid FROM part),
sp AS (SELECT tid, ancestor AS sp FROM tree WHERE rank = 'species')
SELECT l_orderkey AS read, CAST(coalesce(sp, 1) AS BIGINT) AS tid, greatest(max(l_quantity), 0.0) AS score
FROM lineitem JOIN acc ON acc.acc = l_partkey LEFT JOIN sp USING (tid) GROUP BY 1, 2""")
def taxon_lookup(spark, d):
    n = _t(spark, d, "supplier").agg(F.count("*").alias("n"))
    acc = _t(spark, d, "part").join(F.broadcast(n), F.lit(True)).select(F.col("p_partkey").alias("acc"), (100_000 + F.col("p_partkey") % F.col("n")).alias("tid"))
    hits = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_partkey").alias("acc"), F.col("l_quantity").alias("score"))
    return taxonomy.lookup(hits, acc, _tree(spark, d))


LCA = """n AS (SELECT read, count(*) AS n FROM hits GROUP BY read),
above AS (SELECT read, ancestor, count(*) AS c, max(depth) AS depth FROM hits JOIN tree USING (tid) GROUP BY ALL),
lca AS (SELECT read, arg_max(ancestor, depth) AS lca FROM above JOIN n USING (read) WHERE c = n GROUP BY read)"""


@query(f"WITH RECURSIVE {TREE}, {HITS}, {LCA} SELECT read, CAST(lca AS BIGINT) AS lca FROM lca")
def common_ancestor(spark, d):
    return taxonomy.common_ancestor(_hits(spark, d), _tree(spark, d))


@query(f"""WITH RECURSIVE {TREE}, allhits AS (SELECT l_orderkey AS read, l_suppkey + 100000 AS tid, max(l_quantity) AS score FROM lineitem GROUP BY ALL),
good AS (SELECT read FROM allhits GROUP BY read HAVING max(score) >= 40), hits AS (SELECT * FROM allhits WHERE read IN (SELECT read FROM good)), {LCA},
stay AS (SELECT lca AS tid, count(*) AS n FROM lca GROUP BY lca)
SELECT CAST(ancestor AS BIGINT) AS tid, replace(name, '''', '') AS name,
CASE WHEN rank = 'superkingdom' THEN 'D' WHEN rank IN ('family', 'species') THEN upper(rank[1]) ELSE '-' END AS code, CAST(depth AS INT) AS depth,
CAST(sum(n) AS BIGINT) AS clade, CAST(sum(CASE WHEN distance = 0 THEN n ELSE 0 END) AS BIGINT) AS stay,
round(sum(n) * 100.0 / (SELECT count(DISTINCT read) FROM allhits), 2) AS percent
FROM stay JOIN tree USING (tid) GROUP BY ancestor, name, rank, depth""")
def taxonomy_report(spark, d):
    """Reads whose best score reaches 40, by common ancestor, summed up the tree."""
    tree, hits = _tree(spark, d), _hits(spark, d)
    total = _t(spark, d, "lineitem").agg(F.count_distinct("l_orderkey").alias("n"))
    rows = taxonomy.report(taxonomy.common_ancestor(hits, tree, F.max("score").alias("best")).where("best >= 40"), tree, 1)
    return rows.join(F.broadcast(total), F.lit(True)).withColumn("percent", F.round(F.col("clade") * 100.0 / F.col("n"), 2)).drop("n")  # one row


COUNTED = f"""{BUSHY}, {BUSHY_HITS}, up4 AS (SELECT tid, arg_max(ancestor, distance) FILTER (rank = 'species') AS sp, arg_max(ancestor, distance) FILTER (rank = 'genus') AS g, arg_max(ancestor, distance) FILTER (rank = 'family') AS f, arg_max(ancestor, distance) FILTER (rank = 'superkingdom') AS sk FROM tree GROUP BY tid),
own AS (SELECT read, sp, coalesce(g, -sp) AS g, f, sk FROM hits JOIN up4 USING (tid) WHERE sp IS NOT NULL),
line AS (SELECT DISTINCT read, unnest([{{'r': 'species', 't': sp}}, {{'r': 'genus', 't': g}}, {{'r': 'family', 't': coalesce(f, CASE WHEN g > 0 THEN -g - 1000000 ELSE g - 2000000 END)}}, {{'r': 'superkingdom', 't': coalesce(sk, -1)}}]) AS u FROM own),
n AS (SELECT read, u.r AS rank, u.t AS tid, count(*) OVER (PARTITION BY read, u.r) AS n FROM line),
ct AS (SELECT rank, CAST(tid AS BIGINT) AS tid, CAST(sum((n = 1)::INT) AS BIGINT) AS uniq, CAST(sum((n > 1)::INT) AS BIGINT) AS multi FROM n WHERE tid > 0 GROUP BY ALL)"""


@query(f"WITH RECURSIVE {COUNTED} SELECT * FROM ct")
def count_table(spark, d):
    return taxonomy.count_table(_bushy_hits(spark, d), taxonomy.closure(_bushy(spark, d)))


@query(f"""WITH RECURSIVE {COUNTED}, nm AS (SELECT up4.tid, coalesce(a.name, '-') AS superkingdom, coalesce(b.name, '-') AS family, coalesce(c.name, '-') AS genus, coalesce(e.name, '-') AS species
FROM up4 LEFT JOIN nodes a ON a.tid = sk LEFT JOIN nodes b ON b.tid = f LEFT JOIN nodes c ON c.tid = g LEFT JOIN nodes e ON e.tid = sp) SELECT rank, superkingdom, family, genus, species, tid, uniq, multi FROM ct JOIN nm USING (tid)""")
def count_table_with_names(spark, d):
    tree = taxonomy.closure(_bushy(spark, d))
    return taxonomy.named_count_table(taxonomy.count_table(_bushy_hits(spark, d), tree), tree)


@query(f"""WITH RECURSIVE {BUSHY}, {BUSHY_HITS}, sp AS (SELECT DISTINCT read, ancestor AS tid FROM hits JOIN tree USING (tid) WHERE rank = 'species'),
ln AS (SELECT tid, string_agg(rank || '|' || name, ',' ORDER BY distance) AS line FROM tree GROUP BY tid) SELECT read, string_agg(line, ';' ORDER BY tid) AS label FROM sp JOIN ln USING (tid) GROUP BY read""")
def read_labels(spark, d):
    return taxonomy.labels(_bushy_hits(spark, d), taxonomy.closure(_bushy(spark, d)))


@query(f"""WITH RECURSIVE {BUSHY}, k AS (SELECT * FROM nodes WHERE rank IN ('species', 'genus', 'superkingdom') OR tid = parent)
SELECT tid, coalesce((SELECT arg_min(t.ancestor, t.distance) FROM tree t WHERE t.tid = k.tid AND t.distance > 0 AND t.ancestor IN (SELECT tid FROM k)), tid) AS parent, rank, name FROM k""")
def simplified_tree(spark, d):
    nodes = _bushy(spark, d)
    return taxonomy.simplified(nodes, taxonomy.closure(nodes), ("species", "genus", "superkingdom"))


@query(f"WITH RECURSIVE {BUSHY}, {BUSHY_HITS} SELECT read, hits.tid, list_reverse(list(tree.name ORDER BY distance)) AS path FROM hits JOIN tree USING (tid) GROUP BY read, hits.tid")
def taxon_paths(spark, d):
    return taxonomy.in_tree_order(_bushy_hits(spark, d).select("read", "tid"), taxonomy.closure(_bushy(spark, d)))


@query(f"""WITH RECURSIVE {TREE}, {HITS} SELECT read, tid, score FROM hits WHERE tid NOT IN (SELECT tid FROM tree WHERE name IN ('ASIA', 'EUROPE'))""")
def filter_by_taxa(spark, d):
    return taxonomy.filter_by_taxa(_hits(spark, d), _tree(spark, d), ["ASIA", "EUROPE"], include=False).select("read", "tid", "score")


@query(f"""WITH RECURSIVE {TREE}, {HITS}, f AS (SELECT tid, ancestor FROM tree WHERE rank = 'family')
SELECT read FROM hits LEFT JOIN f USING (tid) GROUP BY read HAVING count(DISTINCT coalesce(ancestor, tid)) <= 1""")
def within_one_family(spark, d):
    return taxonomy.within_one(_hits(spark, d), _tree(spark, d))


REASSIGN = """s AS (SELECT DISTINCT read, tid FROM hits WHERE score >= {least}), z AS (SELECT *, count(*) OVER (PARTITION BY read) AS n FROM s),
c AS (SELECT tid, count(*) AS n, sum((n = 1)::INT) AS u FROM z GROUP BY tid),
i AS (SELECT x.tid AS a, y.tid AS b, count(*) AS k FROM s x JOIN s y ON x.read = y.read AND x.tid <> y.tid GROUP BY ALL),
weak AS (SELECT a, b FROM i JOIN c p ON p.tid = a JOIN c q ON q.tid = b WHERE p.u > {times} * q.u AND p.n - k > 0.05 * p.n),
ex AS (SELECT * FROM weak WHERE a NOT IN (SELECT b FROM weak))
SELECT read, tid, score FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits g JOIN ex ON ex.a = g.tid WHERE g.read = h.read AND ex.b = h.tid)"""


@query(f"WITH {SKEWED}, " + REASSIGN.format(least=0, times=20))
def reassign(spark, d):
    return taxonomy.reassign(_skewed(spark, d), 20, 0.05, 0)


@query(f"WITH {SKEWED}, " + REASSIGN.format(least=40, times=2))
def reassign_strict(spark, d):
    return taxonomy.reassign(_skewed(spark, d), 2, 0.05, 40)


@query(f"""WITH {SKEWED}, n AS (SELECT tid, count(*) AS n FROM hits GROUP BY tid), dirty AS (SELECT unnest([4, 6]) AS c),
o AS (SELECT h.tid, x.tid AS c, count(*) AS k FROM hits h JOIN hits x ON x.read = h.read WHERE x.tid IN (4, 6) AND h.tid NOT IN (4, 6) AND h.score * 0.94 <= x.score GROUP BY ALL),
ex AS (SELECT o.tid, c FROM o JOIN n ON n.tid = o.tid WHERE k > n * 0.3),
by_read AS (SELECT DISTINCT h.read, x.tid, x.score FROM hits h JOIN ex ON ex.tid = h.tid JOIN hits x ON x.read = h.read AND x.tid = ex.c WHERE h.score * 0.94 <= x.score),
rest AS (SELECT *, count(*) OVER (PARTITION BY read) AS size, sum((tid IN (4, 6))::INT) OVER (PARTITION BY read) AS soiled FROM hits WHERE read NOT IN (SELECT read FROM by_read))
SELECT read, tid, score FROM by_read UNION ALL SELECT read, tid, score FROM rest WHERE NOT (size > soiled AND tid IN (4, 6))""")
def cleanup(spark, d):
    return taxonomy.cleanup(_skewed(spark, d), spark.createDataFrame([(4,), (6,)], "tid long"), share=0.3)


@query(f"""WITH RECURSIVE {BUSHY}, {BUSHY_HITS}, {LCA}, truth AS (SELECT l_orderkey AS read, min(l_suppkey) + 100000 AS t FROM lineitem GROUP BY 1),
j AS (SELECT lca, t FROM lca JOIN truth USING (read)), rk AS (SELECT unnest(['species', 'genus', 'family']) AS rank),
x AS (SELECT rk.rank, p.ancestor AS p, q.ancestor AS q, EXISTS (SELECT 1 FROM tree a WHERE a.tid = t AND a.ancestor = lca) AS above FROM j CROSS JOIN rk LEFT JOIN tree p ON p.tid = lca AND p.rank = rk.rank JOIN tree q ON q.tid = t AND q.rank = rk.rank)
SELECT rank, CAST(sum((p IS NOT DISTINCT FROM q)::INT) AS BIGINT) AS correct, CAST(sum((p IS DISTINCT FROM q AND NOT above)::INT) AS BIGINT) AS wrong, CAST(sum((p IS DISTINCT FROM q AND above)::INT) AS BIGINT) AS unspecific FROM x GROUP BY rank""")
def accuracy(spark, d):
    truth = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("read")).agg((F.min("l_suppkey") + 100_000).alias("tid"))
    return taxonomy.accuracy(truth, _bushy_hits(spark, d), taxonomy.closure(_bushy(spark, d)))


# -------------------------------------------------------------------- reads


def _mates(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("name"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("score"), F.col("l_suppkey").alias("tid"), F.lit(25).alias("size"))


@query("""WITH m AS (SELECT l_orderkey AS name, l_linenumber AS line, l_quantity AS score, l_suppkey AS tid, 25 AS size FROM lineitem)
SELECT * FROM m WHERE name IN (SELECT name FROM m WHERE score < 3 OR tid = 7)""")
def extract_pairs(spark, d):
    return reads.extract_pairs(_mates(spark, d), 3, F.col("tid") == 7)


@query("""WITH m AS (SELECT l_orderkey AS name, l_linenumber AS line, l_quantity AS score, l_suppkey AS tid, 25 AS size FROM lineitem), p AS (SELECT name, sum(size) AS s FROM m GROUP BY name)
SELECT * FROM m WHERE name IN (SELECT name FROM m JOIN p USING (name) WHERE score < 0.1 * s)""")
def extract_pairs_by_share(spark, d):
    return reads.extract_pairs(_mates(spark, d), 0.1)


@query("""SELECT l_orderkey || '/' || (1 + l_linenumber % 2) AS name, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def without_reads(spark, d):
    rows = _t(spark, d, "lineitem").select(F.concat("l_orderkey", F.lit("/"), 1 + F.col("l_linenumber") % 2).alias("name"), "l_partkey")
    return reads.without_reads(rows, _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.concat("o_orderkey", F.lit("/1")).alias("id")))


@query(f"WITH {HITS} SELECT read, tid, score FROM (SELECT *, max(score) OVER (PARTITION BY read) AS b FROM hits) WHERE score >= 0.95 * b")
def top_share(spark, d):
    return reads.top_share(_hits(spark, d), 0.95)


@query(f"WITH {HITS} SELECT read, tid, score FROM (SELECT *, row_number() OVER (PARTITION BY read ORDER BY score DESC, tid) AS n FROM hits) WHERE n <= 2")
def capped_hits(spark, d):
    return reads.capped(_hits(spark, d), 2, "tid")


@query(f"""WITH {HITS} SELECT DISTINCT read FROM (SELECT *, max(score) OVER (PARTITION BY read) AS b FROM hits) WHERE score = b AND tid IN (SELECT s_suppkey + 100000 FROM supplier WHERE s_acctbal > 5000)""")
def best_on_targets(spark, d):
    targets = _t(spark, d, "supplier").where("s_acctbal > 5000").select((F.col("s_suppkey") + 100_000).alias("ref"))
    return reads.best_on_targets(_hits(spark, d).withColumnRenamed("tid", "ref"), targets)


@query(f"""WITH {ALN}, region AS (SELECT s_suppkey AS c FROM supplier WHERE s_acctbal > 0 AND s_nationkey % 5 <> 0), g AS (SELECT c FROM region JOIN aln ON rname = c WHERE flag & 1796 = 0 GROUP BY c HAVING avg(mapq) >= 25)
SELECT DISTINCT qname AS read FROM aln WHERE rname IN (SELECT c FROM g) OR (SELECT count(*) FROM region) = 0 OR flag & 4 <> 0""")
def filter_contigs(spark, d):
    rows = _alignments(spark, d).select(F.col("qname").alias("read"), F.col("rname").alias("ref"), "flag", "mapq")
    target = _t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ref"), F.when(F.col("s_nationkey") % 5 == 0, 4).otherwise(0).alias("flag"))
    return reads.filter_contigs(rows, target, 25)


@query(f"""WITH {ALN} SELECT qname, line FROM aln WHERE mapq >= 20 AND q + x + 2 > 0 AND mapq >= 0.9 * (q + x + 2)""")
def read_targets(spark, d):
    x = F.round(F.col("l_discount") * 100).cast("int")
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("qname"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("int").alias("score"), (F.col("l_quantity").cast("int") + x + 2).alias("size"))
    return reads.read_targets(rows, 20, 0.9).select("qname", "line")


@query("""SELECT l_orderkey || '/' || (1 + l_linenumber % 2) AS name, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def only_reads(spark, d):
    rows = _t(spark, d, "lineitem").select(F.concat("l_orderkey", F.lit("/"), 1 + F.col("l_linenumber") % 2).alias("name"), "l_partkey")
    return reads.only_reads(rows, _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.concat("o_orderkey", F.lit("/2")).alias("id")))


@query("""SELECT l_orderkey AS read, list(l_suppkey % 7 ORDER BY l_suppkey, l_suppkey % 7) AS taxa FROM lineitem WHERE l_quantity > 20 GROUP BY 1""")
def contig_to_taxa(spark, d):
    hits = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("contig"), F.col("l_quantity").alias("score"))
    taxa = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("contig"), (F.col("s_suppkey") % 7).alias("tid"))
    return reads.contig_to_taxa(hits, taxa, 20)


@query("""SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('10086' || c_custkey), c_custkey) AS n FROM customer) WHERE n = 1""")
def one_of_each(spark, d):
    return reads.one_of_each(_t(spark, d, "customer"), "c_nationkey", "c_custkey").select("c_nationkey", "c_custkey")


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS place FROM lineitem), p AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY place) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM f)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN n % 2 = 1 AND k = n THEN 0 WHEN k % 2 = 1 THEN 64 ELSE 128 END AS INT) AS mate FROM p""")
def pair_up(spark, d):
    """All line items as one file, in blocks of 700 numbers."""
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat("l_orderkey", F.lit("/"), 1 + F.col("l_linenumber") % 2).alias("name"), F.lit("f").alias("file"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return reads.pair_up(rows, "at", "file", 700).select("l_orderkey", "l_linenumber", "mate")


# ---------------------------------------------------------------- intervals


@query(f"WITH {INTERVALS}, src AS (SELECT * FROM iv), {MERGED} SELECT * FROM merged")
def merge_intervals(spark, d):
    return intervals.merge(_intervals(spark, d))


@query(f"""WITH {INTERVALS}, src AS (SELECT * FROM iv), {MERGED} SELECT chrom, count(*) AS n_islands, CAST(sum("end" - "start") AS BIGINT) AS covered FROM merged GROUP BY chrom""")
def covered_bases(spark, d):
    return intervals.covered(_intervals(spark, d))


@query(f"WITH {RUNS} SELECT * FROM runs")
def depth_runs(spark, d):
    return intervals.depth_runs(_intervals(spark, d), _genome(spark, d))


@query(f"""WITH {RUNS}, m AS (SELECT chrom, sum(("end" - "start") * depth) / sum("end" - "start") AS mean FROM runs GROUP BY chrom),
sd AS (SELECT chrom, any_value(mean) AS mean, sqrt(sum(("end" - "start") * (depth - mean) * (depth - mean)) / sum("end" - "start")) AS sd FROM runs JOIN m USING (chrom) GROUP BY chrom)
SELECT chrom, "start", "end", depth FROM runs JOIN sd USING (chrom) WHERE depth > mean + 2.5 * sd""")
def coverage_spikes(spark, d):
    return intervals.spikes(intervals.depth_runs(_intervals(spark, d), _genome(spark, d)), 2.5)


@query(f"""WITH {RUNS} SELECT chrom, CAST(sum("end" - "start") AS BIGINT) AS length, CAST(sum(("end" - "start") * depth) AS BIGINT) AS bases, round(sum(("end" - "start") * depth) / sum("end" - "start"), 6) AS mean,
round(sqrt(sum(("end" - "start") * depth * depth) / sum("end" - "start") - power(sum(("end" - "start") * depth) / sum("end" - "start"), 2)), 4) AS deviation,
round(100 * sum(CASE WHEN depth > 0 THEN "end" - "start" ELSE 0 END) / sum("end" - "start"), 6) AS covered_percent, max(depth) AS most FROM runs GROUP BY chrom""")
def scaffold_coverage(spark, d):
    return intervals.scaffold_coverage(intervals.depth_runs(_intervals(spark, d), _genome(spark, d)))


@query(f"""WITH {INTERVALS}, q AS (SELECT read, line, chrom, "start", "end" FROM iv), src AS (SELECT l_suppkey AS chrom, l_partkey AS "start", l_partkey + 10 AS "end" FROM lineitem WHERE l_quantity = 50), {MERGED},
o AS (SELECT q.read, q.line, q.chrom, q."start", q."end", sum(least(q."end", m."end") - greatest(q."start", m."start")) AS o FROM q JOIN merged m ON q.chrom = m.chrom AND q."start" < m."end" AND m."start" < q."end" GROUP BY ALL)
SELECT q.read, q.line, q."start", q."end", round(coalesce(o.o / (q."end" - q."start"), 0), 9) AS fraction FROM q LEFT JOIN (SELECT DISTINCT * FROM o) o ON o.read = q.read AND o.line = q.line AND o.chrom = q.chrom AND o."start" = q."start" AND o."end" = q."end" """)
def overlap_fraction(spark, d):
    rows = _intervals(spark, d).withColumn("key", F.struct("read", "line", "chrom", "start", "end"))
    spikes = _t(spark, d, "lineitem").where("l_quantity = 50").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 10).alias("end"))
    distinct = rows.select("key", "chrom", "start", "end").distinct()
    found = intervals.annotate(distinct, spikes, "key").select("key", "fraction")
    return rows.join(found, "key").select("read", "line", "start", "end", F.round("fraction", 9).alias("fraction"))


@query(f"""WITH {INTERVALS}, u AS (SELECT DISTINCT chrom, "start" AS pos FROM iv), g AS (SELECT *, sum(new) OVER (PARTITION BY chrom ORDER BY pos) AS id FROM (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom ORDER BY pos) <= 5 THEN 0 ELSE 1 END AS new FROM u))
SELECT chrom, min(pos) - 2 AS "start", max(pos) + 3 AS "end", count(*) AS n FROM g GROUP BY chrom, id""")
def point_clusters(spark, d):
    return intervals.clusters(_intervals(spark, d).select("chrom", F.col("start").alias("pos")), 5, 2)


@query(f"""WITH q AS (SELECT DISTINCT l_suppkey AS chrom, l_partkey AS "start", l_partkey + CAST(l_quantity AS BIGINT) AS "end" FROM lineitem), e AS (SELECT chrom, max("end") AS e FROM q GROUP BY chrom), w AS (SELECT chrom, unnest(generate_series(0, e, 40)) AS ws FROM e),
p AS (SELECT q.*, ws, least("end", ws + 50) - greatest("start", ws) AS overlap FROM q JOIN w ON q.chrom = w.chrom AND "start" < ws + 50 AND ws < "end")
SELECT chrom, "start", "end", ws AS window_start, overlap FROM (SELECT *, row_number() OVER (PARTITION BY chrom, "start", "end" ORDER BY overlap DESC, ws) AS n FROM p) WHERE n = 1""")
def best_window(spark, d):
    rows = _intervals(spark, d).select("chrom", "start", "end").distinct().withColumn("key", F.struct("chrom", "start", "end"))
    w = intervals.tiles(rows, 40, 50)
    return intervals.best_window(rows, w, "key").select("key.*", "window_start", "overlap")


@query("""SELECT l_suppkey AS ref, (SELECT count(*) + 50 FROM part) AS length, count(*) AS reads, round(count(*) * 1e9 / ((SELECT count(*) + 50 FROM part) * (SELECT count(*) FROM lineitem)), 6) AS rpkm FROM lineitem GROUP BY 1""")
def rpkm(spark, d):
    counts = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("ref")).agg(F.count("*").alias("reads"))
    return intervals.rpkm(counts.join(_genome(spark, d).withColumnRenamed("chrom", "ref"), "ref").select("ref", "length", "reads"))


# ---------------------------------------------------------------- sequences


@query(f"""WITH {SEQS} SELECT name, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, CASE WHEN length(seq) > 0 THEN round(length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq), 9) ELSE 0 END AS gc,
least(md5(seq), md5(reverse(translate(seq, 'ACGT', 'TGCA')))) || greatest(md5(seq), md5(reverse(translate(seq, 'ACGT', 'TGCA')))) AS key FROM seqs""")
def sequence_keys(spark, d):
    return _seqs(spark, d).select("name", S.reverse_complement(F.col("seq")).alias("rc"), F.round(S.gc(F.col("seq")), 9).alias("gc"), S.strand_key(F.col("seq")).alias("key"))


@query("""SELECT p_partkey, regexp_replace(p_name, '\\.[0-9]*$', '') AS acc, 'gi|' || p_partkey || '|ref|NC_' || p_size || '.' || p_partkey || '|' AS header, 'NC_' || p_size AS plain FROM part""")
def accessions(spark, d):
    header = F.concat(F.lit("gi|"), "p_partkey", F.lit("|ref|NC_"), "p_size", F.lit("."), "p_partkey", F.lit("|"))
    return _t(spark, d, "part").select("p_partkey", S.remove_version(F.col("p_name")).alias("acc"), header.alias("header"), S.accession(header).alias("plain"))


@query(f"""WITH {SEQS}, s AS (SELECT name, seq, unnest(list_distinct(list_transform(generate_series(0, length(seq) - 200 + 99, 100), lambda x: least(x, length(seq) - 200)))) AS start FROM seqs WHERE length(seq) >= 200)
SELECT name, CAST(start AS BIGINT) AS start, md5(substr(seq, start + 1, 200)) AS tile FROM s""")
def sequence_tiles(spark, d):
    return _seqs(spark, d).select("name", F.inline(S.tiles(F.col("seq"), 200, 100))).select("name", F.col("start").cast("long").alias("start"), F.md5("tile").alias("tile"))


@query(f"""WITH {SEQS}, known AS (SELECT seq FROM seqs WHERE source IN ('src0', 'src1'))
SELECT name FROM seqs WHERE seq NOT IN (SELECT seq FROM known) AND reverse(translate(seq, 'ACGT', 'TGCA')) NOT IN (SELECT seq FROM known)""")
def new_sequences(spark, d):
    s = _seqs(spark, d)
    return reads.new_sequences(s, s.where("source in ('src0', 'src1')")).select("name")


@query(f"""WITH {SEQS}, k AS (SELECT name, least(md5(seq), md5(reverse(translate(seq, 'ACGT', 'TGCA')))) || greatest(md5(seq), md5(reverse(translate(seq, 'ACGT', 'TGCA')))) AS k FROM seqs)
SELECT min(name) AS name, count(*) AS copies FROM k GROUP BY k""")
def exact_duplicates(spark, d):
    return kmers.exact_duplicates(_seqs(spark, d))


@query(f"WITH {SEQS}, {_kmer_sql('km', 'seqs')} SELECT kmer, count(*) AS n FROM km GROUP BY kmer")
def kmer_counts(spark, d):
    return kmers.counts(_seqs(spark, d), K)


@query(f"WITH {SEQS}, {_kmer_sql('km', 'seqs')}, c AS (SELECT kmer, count(*) AS n FROM km GROUP BY kmer) SELECT n AS depth, count(*) AS kmers FROM c GROUP BY n")
def kmer_histogram(spark, d):
    return kmers.histogram(kmers.counts(_seqs(spark, d), K))


@query(f"WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 15)}, {_kmer_sql('rk', 'refs', 15)} SELECT name, count(*) AS hits FROM km WHERE kmer IN (SELECT kmer FROM rk) GROUP BY name HAVING count(*) >= 3")
def kmer_match(spark, d):
    return kmers.match(_seqs(spark, d), _refs(spark, d), 15, 3)


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 15)}, {_kmer_sql('rk', 'refs', 15)}, u AS (SELECT DISTINCT name AS ref, kmer FROM rk), s AS (SELECT name, ref, count(*) AS hits FROM km JOIN u USING (kmer) GROUP BY ALL),
b AS (SELECT *, max(hits) OVER (PARTITION BY name) AS m FROM s) SELECT name, ref, hits, count(*) OVER (PARTITION BY name) AS n_refs FROM b WHERE hits >= m""")
def best_reference(spark, d):
    return kmers.best_reference(_seqs(spark, d), _refs(spark, d), 15)


@query(f"""WITH {SEQS}, {_kmer_sql('km', 'seqs', 15)}, h AS (SELECT DISTINCT name, md5(kmer) AS h FROM km), r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h) AS n FROM h)
SELECT name, list(h ORDER BY h) AS hashes FROM r WHERE n <= 16 GROUP BY name""")
def sketches(spark, d):
    return kmers.sketch(_seqs(spark, d), 15, 16)


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 12)}, {_kmer_sql('rk', 'refs', 12)}, h AS (SELECT DISTINCT name, md5(kmer) AS h FROM km), r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h) AS n FROM h),
g AS (SELECT DISTINCT name, md5(kmer) AS h FROM rk), q AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h) AS n FROM g)
SELECT r.name AS a, q.name AS b, count(*) AS shared FROM r JOIN q ON r.h = q.h AND r.n <= 32 AND q.n <= 32 GROUP BY ALL""")
def compare_sketches(spark, d):
    return kmers.compare(kmers.sketch(_seqs(spark, d), 12, 32), kmers.sketch(_refs(spark, d), 12, 32))


DEPTHS = f"""{SEQS}, {_kmer_sql('km', 'seqs')}, c AS (SELECT kmer, count(*) AS d FROM km GROUP BY kmer), l AS (SELECT name, list(d ORDER BY d DESC) AS c FROM km JOIN c USING (kmer) GROUP BY name),
dp AS (SELECT name, c[least(CAST(floor(len(c) * 0.90) AS INT) + 1, len(c))] AS low, c[least(CAST(floor(len(c) * 0.54) AS INT) + 1, len(c))] AS median, c[least(CAST(floor(len(c) * 0.25) AS INT) + 1, len(c))] AS high, len(c) AS n FROM l)"""


@query(f"WITH {DEPTHS} SELECT * FROM dp")
def kmer_depths(spark, d):
    return kmers.depths(_seqs(spark, d), K)


@query(f"WITH {DEPTHS} SELECT name FROM dp WHERE median >= 2 AND (median <= 40 OR CAST('0x' || substr(md5('1' || name), 1, 8) AS BIGINT) % median + 1 <= 40)")
def normalise_depth(spark, d):
    return kmers.normalise(_seqs(spark, d), K, 40, 2)


@query(f"WITH {SEQS}, {_kmer_sql('km', 'seqs')}, c AS (SELECT name, kmer, count(*) AS n FROM km GROUP BY ALL) SELECT name, kmer, n FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, kmer) AS r FROM c) WHERE r <= 3")
def common_kmers(spark, d):
    return kmers.common(_seqs(spark, d), K, 3)


@query(f"""WITH {SEQS}, s AS (SELECT length(seq) AS len FROM seqs), r AS (SELECT len, sum(len) OVER (ORDER BY len DESC ROWS UNBOUNDED PRECEDING) AS b, row_number() OVER (ORDER BY len DESC) AS i, (SELECT sum(len) FROM s) AS t FROM s)
SELECT (SELECT count(*) FROM s) AS scaffolds, CAST((SELECT sum(len) FROM s) AS BIGINT) AS bases, (SELECT max(len) FROM s) AS longest, (SELECT round(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) / sum(length(seq)), 6) FROM seqs) AS gc, max(len) AS n50, min(i) AS l50 FROM r WHERE 2 * b >= t""")
def assembly_stats(spark, d):
    return stats.assembly(_seqs(spark, d))


@query(f"WITH {SEQS} SELECT CAST(floor(length(seq) / 100) * 100 AS BIGINT) AS length, count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases FROM seqs GROUP BY 1")
def length_histogram(spark, d):
    return stats.length_histogram(_seqs(spark, d), 100)


@query(f"WITH {SEQS} SELECT CAST(least(floor(length(regexp_replace(seq, '[^GC]', '', 'g')) * 50 / length(seq)), 49) AS BIGINT) AS bin, count(*) AS reads FROM seqs WHERE length(seq) > 0 GROUP BY 1")
def gc_histogram(spark, d):
    return stats.gc_histogram(_seqs(spark, d), 50)


@query(f"WITH {SEQS}, e AS (SELECT seq, unnest(generate_series(1, length(seq))) AS i FROM seqs) SELECT CAST((i - 1) // 100 * 100 AS BIGINT) AS pos, substr(seq, i, 1) AS base, count(*) AS n FROM e GROUP BY ALL")
def base_composition(spark, d):
    return stats.base_composition(_seqs(spark, d), 100)


@query("""WITH a AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS line FROM documents), b AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS line FROM conversations) SELECT line FROM a INTERSECT SELECT line FROM b""")
def shared_lines(spark, d):
    lines = lambda t: _t(spark, d, t).select(F.explode(F.split("text", "\n")).alias("line"))
    return stats.shared_lines(lines("documents"), lines("conversations"))


# --------------------------------------------------------------- alignments


@query(f"""WITH {ALN}, t AS (SELECT flag & 512 <> 0 AS bad, unnest([{{'c': 'total', 'v': true}}, {{'c': 'duplicates', 'v': flag & 1024 <> 0}}, {{'c': 'mapped', 'v': flag & 4 = 0}}, {{'c': 'paired', 'v': flag & 1 <> 0}}, {{'c': 'read1', 'v': flag & 65 = 65}},
{{'c': 'read2', 'v': flag & 129 = 129}}, {{'c': 'properly_paired', 'v': flag & 7 = 3}}, {{'c': 'with_mate_mapped', 'v': flag & 13 = 1}}, {{'c': 'singletons', 'v': flag & 13 = 9}}, {{'c': 'mate_on_other', 'v': flag & 13 = 1 AND rname <> rnext}}, {{'c': 'mate_on_other_mapq5', 'v': flag & 13 = 1 AND rname <> rnext AND mapq >= 5}}]) AS u FROM aln)
SELECT u.c AS counter, CAST(sum((u.v AND NOT bad)::INT) AS BIGINT) AS passed, CAST(sum((u.v AND bad)::INT) AS BIGINT) AS failed FROM t GROUP BY 1""")
def flagstat(spark, d):
    return sam.flagstat(_alignments(spark, d))


@query(f"WITH {ALN} SELECT rname, CAST(sum((flag & 4 = 0)::INT) AS BIGINT) AS mapped, CAST(sum((flag & 4 <> 0)::INT) AS BIGINT) AS unmapped FROM aln GROUP BY rname")
def idxstats(spark, d):
    return sam.idxstats(_alignments(spark, d))


@query(f"WITH {ALN} SELECT qname, line, rname, pos FROM (SELECT *, row_number() OVER (PARTITION BY rname, pos, flag & 16 ORDER BY quality DESC, qname || '/' || line) AS n FROM aln WHERE flag & 4 = 0) WHERE n = 1")
def remove_duplicates(spark, d):
    rows = sam.view(_alignments(spark, d), exclude=4).withColumn("strand", F.col("flag").bitwiseAND(16)).withColumn("tie", F.concat_ws("/", "qname", "line"))
    return sam.remove_duplicates(rows, ["rname", "pos", "strand"], "quality", "tie").select("qname", "line", "rname", "pos")


@query(f"""WITH {ALN}, e AS (SELECT rname, pos, q, x, unnest(generate_series(0, q - 1)) AS i FROM aln WHERE flag & 1796 = 0 AND mapq >= 10), b AS (SELECT rname, unnest([pos + i, pos + q + i, pos + 2 * q + x + 2 + i]) AS pos FROM e)
SELECT rname, CAST(pos AS INT) AS pos, count(*) AS depth FROM b GROUP BY ALL""")
def base_depth(spark, d):
    return sam.depth(_alignments(spark, d), 10)


DEPTH = f"""{ALN}, e AS (SELECT rname, pos, q, x, unnest(generate_series(0, q - 1)) AS i FROM aln WHERE flag & 1796 = 0 AND mapq >= 10), b AS (SELECT rname, unnest([pos + i, pos + q + i, pos + 2 * q + x + 2 + i]) AS pos FROM e),
dp AS (SELECT rname, pos, count(*) AS depth FROM b GROUP BY ALL)"""


@query(f"WITH {DEPTH} SELECT rname, CAST(floor(pos / 100) * 100 AS BIGINT) AS bin, CAST(sum(depth) AS BIGINT) AS bases, count(*) AS covered FROM dp GROUP BY ALL")
def binned_depth(spark, d):
    return sam.binned_depth(_alignments(spark, d), 100, 10)


@query(f"WITH {DEPTH} SELECT depth, count(*) AS positions FROM dp GROUP BY depth")
def depth_histogram(spark, d):
    return sam.depth_histogram(_alignments(spark, d), 10)


@query(f"""WITH {ALN} SELECT qname, line, CAST(3 * q + x + 2 AS INT) AS ref_len, CAST(3 * q + 2 * x + 2 AS INT) AS query_len, CAST(3 * q - (40 - 2 * x - 3) * 3 - (3 + x + 1) - (3 + x + 2) AS INT) AS score FROM aln""")
def cigar_scores(spark, d):
    c = F.col("cigar")
    return _alignments(spark, d).select("qname", "line", S.cigar_length(c, "M=XDN").alias("ref_len"), S.cigar_length(c, "M=XIS").alias("query_len"), S.cigar_score(c, F.lit(40)).alias("score"))


def _paired(spark: SparkSession, d: str) -> DataFrame:
    """Alignments of which every two lines of an order are a pair; the last of an odd number has no mate."""
    name = F.concat_ws("-", "qname", F.floor((F.col("line") - 1) / 2).cast("string"))
    return _alignments(spark, d).withColumn("qname", name).drop("rnext").withColumn("rname", F.col("rname").cast("string"))


#: The n-th first and second reads of a name, by line, place and reference, are mates; five is where sequencing began (from 0).
PAIRED = f"""{ALN}, s AS (SELECT qname || '-' || (line - 1) // 2 AS qname, line, flag, rname, pos, pos - 1 + CASE WHEN flag & 16 <> 0 THEN 3 * q + x + 2 ELSE 0 END AS five FROM aln),
n AS (SELECT *, row_number() OVER (PARTITION BY qname, flag & 192 ORDER BY line, pos, rname::VARCHAR, flag) AS nth FROM s),
f AS (SELECT a.qname, a.line, a.flag, b.flag AS other, b.pos AS pnext, CASE WHEN a.rname = b.rname AND a.flag & 12 = 0 AND b.flag & 12 = 0 THEN b.five - a.five ELSE 0 END AS tlen
    FROM n a LEFT JOIN n b ON a.qname = b.qname AND a.nth = b.nth AND a.flag & 192 <> b.flag & 192)"""


@query(f"""WITH {PAIRED}, m AS (SELECT *, (flag - (flag & 32)) + CASE WHEN other & 16 <> 0 THEN 32 ELSE 0 END AS turned FROM f)
SELECT qname, line, CASE WHEN other IS NULL THEN (flag - (flag & 34)) | 8 WHEN other & 4 <> 0 THEN (turned - (turned & 2)) | 8 ELSE turned END AS flag, coalesce(pnext, 0) AS pnext, tlen FROM m""")
def fix_mates(spark, d):
    return sam.fix_mates(_paired(spark, d), ("line", "pos", "rname", "flag")).select("qname", "line", "flag", "pnext", "tlen")


@query(f"""WITH {ALN} SELECT rname AS chrom, pos - 1 AS "start", pos - 1 + 3 * q + x + 2 AS "end", qname || CASE WHEN flag & 64 <> 0 THEN '/1' ELSE '/2' END AS name, mapq AS score, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM aln WHERE flag & 4 = 0""")
def alignments_to_bed(spark, d):
    return sam.to_bed(_alignments(spark, d))


@query(f"WITH {ALN} SELECT CASE WHEN flag & 4 <> 0 THEN 'unmapped' WHEN flag & 16 <> 0 THEN 'minus' ELSE 'plus' END AS file, count(*) AS n FROM aln GROUP BY 1")
def split_by_strand(spark, d):
    return sam.strand_of(_alignments(spark, d)).groupBy("file").agg(F.count("*").alias("n"))


@query(f"WITH {ALN}, e AS (SELECT mapq, sum((x < 5)::INT) AS r, sum((x >= 5)::INT) AS w FROM aln GROUP BY mapq) SELECT mapq, CAST(sum(r) OVER (ORDER BY mapq DESC) AS BIGINT) AS \"right\", CAST(sum(w) OVER (ORDER BY mapq DESC) AS BIGINT) AS wrong FROM e")
def mapping_roc(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_quantity").cast("int").alias("mapq"), (F.round(F.col("l_discount") * 100) < 5).alias("correct"))
    return sam.roc(rows)


# ------------------------------------------------------ merging, cutting, order


@query(f"""WITH {SEQS}, s AS (SELECT name, seq, unnest(list_distinct(list_transform(generate_series(0, length(seq) - 60 + 44, 45), lambda x: least(x, length(seq) - 60)))) AS start FROM seqs WHERE length(seq) >= 60),
p AS (SELECT name, start, substr(seq, start + 1, 40) AS a, substr(seq, start + 21, 40) AS b FROM s), c AS (SELECT *, unnest(generate_series(12, 40)) AS o FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY name, start ORDER BY share, o DESC) AS n FROM (SELECT name, start, a, b, o, hamming(right(a, o), left(b, o)) / o AS share FROM c))
SELECT name, CAST(start AS BIGINT) AS start, CASE WHEN share <= 0.1 THEN o END AS overlap, CASE WHEN share <= 0.1 THEN md5(a || substr(b, o + 1)) END AS merged FROM r WHERE n = 1""")
def merge_mates(spark, d):
    """Mates of 40 bases from both ends of every 60 bases of a sequence."""
    tiles = _seqs(spark, d).select("name", F.inline(S.tiles(F.col("seq"), 60, 45)))
    pairs = tiles.select("name", F.col("start").cast("long").alias("start"), F.substr("tile", F.lit(1), F.lit(40)).alias("seq1"), S.reverse_complement(F.substr("tile", F.lit(21), F.lit(40))).alias("seq2"))
    return rearrange.merge_mates(pairs).select("name", "start", F.col("overlap").cast("long").alias("overlap"), F.md5("merged").alias("merged"))


@query("""WITH s AS (SELECT doc_id AS name, list_filter(regexp_split_to_array(upper(regexp_replace(text, '[^acgtACGT]', 'N', 'g')), 'N{3,}'), lambda x: x <> '') AS parts FROM documents),
i AS (SELECT name, parts, unnest(generate_series(1, len(parts))) AS i FROM s) SELECT name, CAST(i - 1 AS INT) AS part, parts[i] AS seq FROM i""")
def cut_at_n(spark, d):
    return rearrange.cut_at_n(_t(spark, d, "documents").select(F.col("doc_id").alias("name"), F.upper(F.regexp_replace("text", "[^acgtACGT]", "N")).alias("seq")), 3)


@query(f"""WITH {SEQS}, {REFS}, tags AS (SELECT DISTINCT substr(seq, 1, 6) AS tag FROM refs WHERE length(seq) >= 6), b AS (SELECT name, substr(seq, 1, 6) AS barcode FROM seqs),
near AS (SELECT name, max(CASE WHEN tag = barcode THEN tag END) AS same, min(tag) AS tag, count(*) AS n FROM b JOIN tags ON length(barcode) = 6 AND hamming(CASE WHEN length(barcode) = 6 THEN barcode ELSE 'NNNNNN' END, tag) <= 1 GROUP BY name)
SELECT name, coalesce(same, CASE WHEN n = 1 THEN near.tag END, 'unknown') AS file FROM b LEFT JOIN near USING (name)""")
def demultiplex(spark, d):
    """Sequences by the six bases of their barcode."""
    barcode = F.substr("seq", F.lit(1), F.lit(6))
    return rearrange.demultiplex(_seqs(spark, d).select("name", barcode.alias("barcode")), _refs(spark, d).select(barcode.alias("tag")), 6).select("name", "file")


@query(f"""WITH {SEQS}, {_kmer_sql('km', 'seqs')}, r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY md5(kmer) DESC, pos) AS n FROM km)
SELECT seqs.name, kmer AS pivot, CAST(pos AS INT) AS place FROM seqs LEFT JOIN (SELECT * FROM r WHERE n = 1) r ON seqs.name = r.name""")
def clump_order(spark, d):
    return rearrange.clumped(_seqs(spark, d), K).select("name", "pivot", "place")


@query(f"""WITH {SEQS}, {_kmer_sql('km', 'seqs')}, t AS (SELECT name // 100 AS bin, count(*) AS kmers FROM km GROUP BY 1), f AS (SELECT bin, count(*) AS fresh FROM (SELECT kmer, min(name // 100) AS bin FROM km GROUP BY kmer) GROUP BY bin)
SELECT bin, kmers, coalesce(fresh, 0) AS fresh FROM t LEFT JOIN f USING (bin)""")
def kmer_uniqueness(spark, d):
    return rearrange.uniqueness(_seqs(spark, d), K, 100)


@query(f"WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs')}, {_kmer_sql('kr', 'refs')} SELECT CAST(pos AS INT) AS pos, count(*) AS hits FROM km WHERE kmer IN (SELECT kmer FROM kr) GROUP BY pos")
def kmer_positions(spark, d):
    return rearrange.hit_positions(_seqs(spark, d), _refs(spark, d), K)


@query(f"WITH {PAIRED} SELECT tlen AS size, count(*) AS pairs FROM f WHERE tlen > 0 GROUP BY tlen")
def insert_sizes(spark, d):
    return rearrange.insert_sizes(sam.fix_mates(_paired(spark, d), ("line", "pos", "rname", "flag")))


@query(f"""WITH {SEQS}, f AS (SELECT name, frame, CASE WHEN frame > 2 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS s FROM seqs, (SELECT unnest(generate_series(0, 5)) AS frame))
SELECT name, CAST(frame AS INT) AS frame, md5(array_to_string(list_transform(generate_series(frame % 3 + 1, length(s) - 2, 3), lambda i:
    substr('{S.AMINO_ACIDS}', CAST(16 * strpos('ACGT', substr(s, i, 1)) + 4 * strpos('ACGT', substr(s, i + 1, 1)) + strpos('ACGT', substr(s, i + 2, 1)) - 20 AS BIGINT), 1)), '')) AS protein FROM f""")
def six_frames(spark, d):
    return rearrange.six_frames(_seqs(spark, d)).select("name", "frame", F.md5("protein").alias("protein"))


@query(f"WITH {SEQS} SELECT name, CAST(floor(coalesce(sum(length(seq)) OVER (ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 5000) AS BIGINT) AS chunk FROM seqs")
def size_chunks(spark, d):
    return rearrange.chunk_by_size(_seqs(spark, d), 5000).select("name", "chunk")


# ------------------------------------------------- masking, trimming, variants


HITS15 = f"""{SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 15)}, {_kmer_sql('rk', 'refs', 15)}, hit AS (SELECT name, pos FROM km WHERE kmer IN (SELECT kmer FROM rk))"""


@query(f"""WITH {HITS15}, c AS (SELECT name, i - 1 AS i, substr(seq, i, 1) AS base FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS i FROM seqs WHERE name IN (SELECT name FROM hit))),
m AS (SELECT DISTINCT name, pos + unnest(generate_series(0, 14)) AS i FROM hit), n AS (SELECT name, string_agg(CASE WHEN m.i IS NULL THEN base ELSE 'N' END, '' ORDER BY c.i) AS masked FROM c LEFT JOIN m USING (name, i) GROUP BY name)
SELECT seqs.name, md5(coalesce(masked, seq)) AS seq FROM seqs LEFT JOIN n ON n.name = seqs.name""")
def kmer_mask(spark, d):
    return kmers.mask(_seqs(spark, d).select("name", "seq"), _refs(spark, d), 15).select("name", F.md5("seq").alias("seq"))


@query(f"WITH {HITS15}, f AS (SELECT name, min(pos) AS a FROM hit GROUP BY name) SELECT name, md5(substr(seq, 1, coalesce(a, length(seq)))) AS seq FROM seqs LEFT JOIN f USING (name)")
def kmer_trim(spark, d):
    return kmers.trim(_seqs(spark, d).select("name", "seq"), _refs(spark, d), 15).select("name", F.md5("seq").alias("seq"))


@query(f"WITH {HITS15}, f AS (SELECT name, max(pos) AS b FROM hit GROUP BY name) SELECT name, md5(substr(seq, coalesce(b + 15, 0) + 1)) AS seq FROM seqs LEFT JOIN f USING (name)")
def kmer_trim_left(spark, d):
    return kmers.trim(_seqs(spark, d).select("name", "seq"), _refs(spark, d), 15, "left").select("name", F.md5("seq").alias("seq"))


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 13)}, {_kmer_sql('rk', 'refs', 13)}, d AS (SELECT DISTINCT kmer FROM rk), nb AS (SELECT substr(kmer, 1, i - 1) || b || substr(kmer, i + 1) AS x FROM d, (SELECT unnest(generate_series(1, 13)) AS i), (SELECT unnest(['A', 'C', 'G', 'T']) AS b)),
near AS (SELECT DISTINCT greatest(x, reverse(translate(x, 'ACGT', 'TGCA'))) AS kmer FROM nb) SELECT name, count(*) AS hits FROM km WHERE kmer IN (SELECT kmer FROM near) GROUP BY name HAVING count(*) >= 5""")
def kmer_match_near(spark, d):
    return kmers.match(_seqs(spark, d), _refs(spark, d), 13, 5, substitutions=1)


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs', 15)}, {_kmer_sql('rk', 'refs', 15)}, u AS (SELECT DISTINCT name AS ref, kmer FROM rk), s AS (SELECT name, ref, count(*) AS hits FROM km JOIN u USING (kmer) GROUP BY ALL),
b AS (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM (SELECT *, max(hits) OVER (PARTITION BY name) AS m FROM s) WHERE hits >= m - 2)
SELECT ref, count(*) AS reads, CAST(sum((n = 1)::INT) AS BIGINT) AS sole_reads, CAST(sum(hits) AS BIGINT) AS hits FROM b GROUP BY ref""")
def reference_stats(spark, d):
    return kmers.reference_stats(kmers.best_reference(_seqs(spark, d), _refs(spark, d), 15, clearzone=2))


@query(f"""WITH {SEQS}, r AS (SELECT name, seq, length(seq) AS n FROM seqs WHERE length(seq) >= 100)
SELECT name FROM r WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.name <> r.name AND (b.n > r.n OR b.name < r.name) AND b.n >= r.n AND (contains(b.seq, r.seq) OR contains(b.seq, reverse(translate(r.seq, 'ACGT', 'TGCA')))))""")
def without_contained(spark, d):
    return overlaps.contained(_seqs(spark, d).select("name", "seq"))


@query(f"""WITH {SEQS}, s AS (SELECT min(name) AS name, min_by(seq, name) AS seq FROM seqs WHERE length(seq) >= 50 GROUP BY greatest(seq, reverse(translate(seq, 'ACGT', 'TGCA')))),
k AS (SELECT name, n, pos, w, greatest(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS c FROM (SELECT name, length(seq) AS n, i - 1 AS pos, substr(seq, i, 29) AS w FROM (SELECT name, seq, unnest(generate_series(1, length(seq) - 28)) AS i FROM s))),
m AS (SELECT a.name AS x, b.name AS y, a.n AS nx, b.n AS ny, (a.w = a.c) <> (b.w = b.c) AS reverse, CASE WHEN (a.w = a.c) <> (b.w = b.c) THEN b.pos - (a.n - a.pos - 29) ELSE b.pos - a.pos END AS o FROM k a JOIN k b ON a.c = b.c AND a.name <> b.name WHERE a.pos = 0 OR a.pos = a.n - 29),
e AS (SELECT DISTINCT least(x, y) AS a, greatest(x, y) AS b, reverse, CASE WHEN x < y THEN o WHEN reverse THEN nx - ny + o ELSE -o END AS "offset", CASE WHEN x < y THEN nx ELSE ny END AS na, CASE WHEN x < y THEN ny ELSE nx END AS nb FROM m),
l AS (SELECT *, greatest("offset", 0) AS st, least("offset" + na, nb) - greatest("offset", 0) AS length FROM e)
SELECT a, b, l.reverse, l."offset", l.length, CASE WHEN l."offset" >= 0 AND l."offset" + na <= nb THEN 'inner' WHEN l."offset" <= 0 AND l."offset" + na >= nb THEN 'outer' ELSE 'end' END AS kind
FROM l JOIN s p ON p.name = a JOIN s q ON q.name = b WHERE l.length >= 50 AND substr(CASE WHEN l.reverse THEN reverse(translate(p.seq, 'ACGT', 'TGCA')) ELSE p.seq END, st - l."offset" + 1, l.length) = substr(q.seq, st + 1, l.length)""")
def overlap_edges(spark, d):
    return overlaps.edges(_seqs(spark, d).select("name", "seq")).drop("mismatches")


@query(f"""WITH {SEQS}, q AS (SELECT name, seq, CAST(length(seq) AS DOUBLE) AS n, length(replace(seq, 'A', '')) AS na, length(replace(seq, 'C', '')) AS nc, length(replace(seq, 'G', '')) AS ng, length(replace(seq, 'T', '')) AS nt FROM seqs)
SELECT name FROM q WHERE n >= 50 AND (2 * n - ng - nc) / n BETWEEN 0.3 AND 0.5 AND floor(-10 * log10(((n - na) * 1e-4 + (n - nc) * 1e-2 + (n - ng) * 0.1 + (n - nt) * pow(10, -0.2)) / n) + 1e-9) >= 8""")
def quality_filters(spark, d):
    rows = _seqs(spark, d).select("name", "seq", F.translate("seq", "ACGT", "I5+#").alias("qual"))
    return qc.filters(rows, least=50, low_gc=0.3, high_gc=0.5, least_quality=8).where("ok").select("name")


@query("""SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(p_name, '([a-z]+|[^a-z]+)'), lambda x: CASE WHEN regexp_matches(x, '^[a-z]') AND length(x) >= 4 THEN repeat('N', length(x)) ELSE upper(x) END), '') AS masked FROM part""")
def mask_lower_case(spark, d):
    return _t(spark, d, "part").select("p_partkey", S.mask_runs(F.col("p_name"), 4).alias("masked"))


@query("""WITH m AS (SELECT l_orderkey || '-' || (l_linenumber - 1) // 2 AS k, l_linenumber % 2 AS odd, l_partkey::VARCHAR AS p FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY k, odd ORDER BY p) AS nth FROM m)
SELECT coalesce(a.k, b.k) AS name, a.p AS seq1, b.p AS seq2 FROM (SELECT * FROM n WHERE odd = 1) a FULL JOIN (SELECT * FROM n WHERE odd = 0) b ON a.k = b.k AND a.nth = b.nth""")
def repair_mates(spark, d):
    name = F.concat_ws("-", "l_orderkey", F.floor((F.col("l_linenumber") - 1) / 2).cast("string"))
    rows = _t(spark, d, "lineitem").select(F.concat(name, F.lit("/"), 2 - F.col("l_linenumber") % 2).alias("name"), F.col("l_partkey").cast("string").alias("seq"), "l_linenumber")
    return reads.repair(rows.where("l_linenumber % 2 = 1"), rows.where("l_linenumber % 2 = 0"))


@query(f"""WITH {ALN}, s AS (SELECT *, translate(md5(qname || '-' || line), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, md5(qname || '-' || line) AS qual FROM aln)
SELECT qname || CASE WHEN flag & 64 <> 0 THEN '/1' ELSE '/2' END AS name, CASE WHEN flag & 16 <> 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CASE WHEN flag & 16 <> 0 THEN reverse(qual) ELSE qual END AS qual FROM s""")
def alignments_to_fastq(spark, d):
    qual = F.md5(F.concat_ws("-", "qname", F.col("line").cast("string")))
    return sam.to_fastq(_alignments(spark, d).withColumn("seq", F.translate(qual, "0123456789abcdef", "ACGTACGTACGTACGT")).withColumn("qual", qual))


@query(f"""WITH {ALN} SELECT qname, line FROM aln WHERE flag & 1 = 1 AND flag & 4 = 0 AND mapq >= 20 AND CAST('0x' || substr(md5('0' || qname), 1, 8) AS BIGINT) < 0.5 * 4294967296""")
def sampled_alignments(spark, d):
    return sam.view(_alignments(spark, d), require=1, exclude=4, mapq=20, sample=0.5).select("qname", "line")


@query(f"WITH {ALN} SELECT qname, line FROM aln WHERE 3 * q + x + 1 >= 0.95 * (3 * q + 2 * x + 2)")
def little_clipped(spark, d):
    return sam.soft_clip_filter(_alignments(spark, d), 0.95).select("qname", "line")


VARIANTS = """bases AS (SELECT l_suppkey AS chrom, l_partkey AS pos, ['A', 'C', 'IT', 'DA'][l_linenumber % 4 + 1] AS allele, l_quantity FROM lineitem),
v AS (SELECT chrom, pos, max(l_quantity) AS qual, count(*) AS depth FROM bases GROUP BY ALL)"""


def _variants(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Bases of line items by supplier and part, and a site for each place with bases."""
    bases = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("pos"), F.element_at(F.array(*map(F.lit, ["A", "C", "IT", "DA"])), (F.col("l_linenumber") % 4 + 1).cast("int")).alias("allele"), "l_quantity")
    return bases, bases.groupBy("chrom", "pos").agg(F.max("l_quantity").alias("qual"), F.count("*").alias("depth"))


@query(f"""WITH {VARIANTS}, s AS (SELECT chrom, pos, depth, unnest([{{'r': 'G', 'a': 'A', 'k': 'A'}}, {{'r': 'G', 'a': 'GT', 'k': 'IT'}}, {{'r': 'GA', 'a': 'G', 'k': 'DA'}}]) AS u FROM v)
SELECT s.chrom, s.pos, u.r AS ref, u.a AS alt, depth, round(count(b.allele) / depth, 4) AS af FROM s LEFT JOIN bases b ON b.chrom = s.chrom AND b.pos = s.pos AND b.allele = u.k GROUP BY s.chrom, s.pos, u.r, u.a, depth""")
def allele_frequencies(spark, d):
    bases, _ = _variants(spark, d)
    sites = F.array(*[F.struct(F.lit(r).alias("ref"), F.lit(a).alias("alt")) for r, a in (("G", "A"), ("G", "GT"), ("GA", "G"))])
    counts = variants.allele_counts(bases)
    # the places of the sites lie in the tasks of their counts
    return sources.update_frequencies(counts.select("chrom", "pos", F.inline(sites)), counts)


@query(f"""WITH {VARIANTS}, f AS (SELECT * FROM v WHERE qual >= 10 AND depth >= 1 AND depth <= 3)
SELECT chrom, pos, qual, depth FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.chrom = f.chrom AND g.pos <> f.pos AND abs(g.pos - f.pos) <= 4)""")
def filter_variants(spark, d):
    return variants.filter_variants(_variants(spark, d)[1], 10, 1, 3, 4)


# ------------------------------------------------------------ taxa of results


@query(f"WITH RECURSIVE {TREE}, {HITS}, own AS (SELECT tid AS t, name FROM tree WHERE distance = 0) SELECT read, hits.tid, own.name AS file FROM hits JOIN tree ON tree.tid = hits.tid AND tree.rank = 'family' JOIN own ON own.t = tree.ancestor")
def split_by_rank(spark, d):
    return taxonomy.split_by_rank(_hits(spark, d), _tree(spark, d), "family").select("read", "tid", "file")


@query(f"""WITH RECURSIVE {TREE}, n AS (SELECT l_suppkey + 100000 AS tid, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT ancestor, sum(n) AS s FROM n JOIN tree USING (tid) GROUP BY 1),
c AS (SELECT tid, n, arg_min(ancestor, distance) AS a FROM n JOIN tree USING (tid) JOIN s USING (ancestor) WHERE s >= (SELECT sum(n) / 30 FROM n) OR depth = 0 GROUP BY tid, n)
SELECT CAST(a AS BIGINT) AS tid, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY a""")
def gathered_counts(spark, d):
    n = _t(spark, d, "lineitem").groupBy((F.col("l_suppkey") + 100_000).alias("tid")).agg(F.count("*").alias("n"))
    least = n.agg(F.sum("n") / 30).first()[0]  # one number
    return taxonomy.gathered(n, _tree(spark, d), least or 0)


@query(f"""WITH {HITS}, a AS (SELECT read, min(tid) AS found FROM hits GROUP BY read HAVING count(DISTINCT tid) = 1), t AS (SELECT o_orderkey AS read, (SELECT min(l_suppkey) FROM lineitem) + 100000 + o_orderkey % 5 AS truth FROM orders),
p AS (SELECT truth, found FROM t FULL JOIN a USING (read)), k AS (SELECT truth AS tid FROM p WHERE truth IS NOT NULL UNION SELECT found FROM p WHERE found IS NOT NULL),
n AS (SELECT tid, (SELECT count(*) FROM p WHERE truth = tid) AS n_true, (SELECT count(*) FROM p WHERE found = tid) AS n_found, (SELECT count(*) FROM p WHERE truth = tid AND found = tid) AS n_right FROM k)
SELECT *, round(CASE WHEN n_true > 0 THEN n_right / n_true END, 9) AS sensitivity, round(CASE WHEN n_found > 0 THEN (n_found - n_right) / n_found END, 9) AS false_discovery FROM n""")
def taxon_accuracy(spark, d):
    first = _t(spark, d, "lineitem").agg(F.min("l_suppkey").alias("s"))
    truth = _t(spark, d, "orders").join(F.broadcast(first), F.lit(True)).select(F.col("o_orderkey").alias("read"), (F.col("s") + 100_000 + F.col("o_orderkey") % 5).alias("tid"))  # one row
    return taxonomy.taxon_accuracy(truth, _hits(spark, d))


# ------------------------------------------------------------------ streams


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_events(spark, d):
    return windows.tumbling(_t(spark, d, "events"), "1 hour").withColumn("total", F.round("total", 4))


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, id""")
def event_sessions(spark, d):
    return windows.sessions(_t(spark, d, "events"), "30 minutes")
