"""Queries of chains, linkers, recalibration, sketches, consensus and peaks over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.functions import codes
from lodestrand.functions import seq as S
from lodestrand.operators import chains, consensus, depths, kmers, linkers, mergeable, recalibration
from lodestrand.operators.work import keep
from lodestrand.plans.registry import K, REFS, SEQS, _kmer_sql, _refs, _seqs, _t, query

# -------------------------------------------------------------------- chains


@query(f"WITH {SEQS}, {_kmer_sql('km', 'seqs', 21)} SELECT DISTINCT kmer, CAST(1 AS BIGINT) AS n FROM km")
def compressed_kmers(spark, d):
    """The k-mers of the compressed sequences, and how often each stands in them."""
    return kmers.counts(chains.compressed(_seqs(spark, d), 21), 21)


# ------------------------------------------------------------------- linkers

LINKER = "TAATGCATT"


def _places(pattern: str) -> str:
    return f"SELECT name, i - 1 AS pos, hamming(substr(seq, i, {len(pattern)}), '{pattern}') AS h FROM (SELECT name, seq, unnest(generate_series(1, length(seq) - {len(pattern)} + 1)) AS i FROM seqs)"


@query(f"WITH {SEQS}, p AS (SELECT *, false AS reverse FROM ({_places(LINKER)}) UNION ALL SELECT *, true FROM ({_places(linkers.reverse_complement(LINKER))})) SELECT name, pos, reverse, CAST(h AS INT) AS mismatches FROM p WHERE h <= 2")
def near_linkers(spark, d):
    return linkers.near_places(_seqs(spark, d), LINKER, 2)


@query(f"""WITH {SEQS}, a AS (SELECT name, min_by(pos, struct_pack(h := h, pos := pos)) AS x FROM ({_places('TAGACA')}) WHERE h <= 1 GROUP BY name),
b AS (SELECT name, min_by(pos, struct_pack(h := h, pos := pos)) AS y FROM ({_places('ATCGA')}) JOIN a USING (name) WHERE h <= 1 AND pos >= x + 6 GROUP BY name)
SELECT name, substr(seq, x + 7, y - x - 6) AS seq FROM seqs JOIN a USING (name) JOIN b USING (name)""")
def cut_primers(spark, d):
    return linkers.cut_primers(_seqs(spark, d).select("name", "seq"), "TAGACA", "ATCGA", 1)


@query(f"""WITH {SEQS}, p AS (SELECT name, min_by(pos, struct_pack(h := h, pos := pos)) AS spot FROM (SELECT * FROM ({_places(LINKER)}) UNION ALL SELECT * FROM ({_places(linkers.reverse_complement(LINKER))})) WHERE h <= 2 GROUP BY name)
SELECT name, u.part AS part, md5(coalesce(u.seq, '')) AS seq FROM (SELECT seqs.name, unnest(CASE WHEN spot IS NOT NULL THEN [{{'part': 1, 'seq': substr(seq, 1, spot)}}, {{'part': 2, 'seq': substr(seq, spot + {len(LINKER) + 1})}}] ELSE [{{'part': 0, 'seq': seq}}] END) AS u FROM seqs LEFT JOIN p ON p.name = seqs.name)""")
def split_near_linker(spark, d):
    return linkers.split_at(_seqs(spark, d).select("name", "seq"), LINKER, 2).select("name", "part", F.md5(F.coalesce("seq", F.lit(""))).alias("seq"))


# ------------------------------------------------------------- recalibration


def _stated(spark: SparkSession, d: str) -> DataFrame:
    """An order's lines as a read, quantities as its qualities, small discounts as right bases."""
    base = F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"), "l_extendedprice", (F.col("l_discount") <= 0.07).alias("ok"))
    own = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("read")).agg(F.array_sort(F.collect_list(base)).alias("b"))
    return recalibration.observed(own.select("read", F.transform("b", lambda x: x["q"]).alias("quals"), F.transform("b", lambda x: x["ok"]).alias("right")))


STATED = """b AS (SELECT l_orderkey AS read, row_number() OVER w - 1 AS pos, CAST(l_quantity AS BIGINT) AS q, coalesce(lag(CAST(l_quantity AS BIGINT)) OVER w, -1) AS before, coalesce(lead(CAST(l_quantity AS BIGINT)) OVER w, -1) AS behind, l_discount > 0.07 AS bad
    FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS INT), l_extendedprice, l_discount <= 0.07)),
m AS (SELECT CASE grouping_id(pos, before, q, behind) WHEN 13 THEN 'quality' WHEN 5 THEN 'place' WHEN 9 THEN 'before' WHEN 12 THEN 'behind' ELSE 'both' END AS matrix, pos, before, q, behind, count(*) AS bases, CAST(sum(bad::INT) AS BIGINT) AS wrong
    FROM b GROUP BY GROUPING SETS ((q), (pos, q), (before, q), (q, behind), (before, q, behind)))"""


@query(f"WITH {STATED} SELECT * FROM m")
def quality_matrices(spark, d):
    return recalibration.matrices(_stated(spark, d))


@query(f"""WITH {STATED}, r AS (SELECT *, (wrong + 1) / (bases + 2) AS p FROM m WHERE bases >= 20),
j AS (SELECT b.read, b.pos, b.q, x.p AS place, y.p AS both_, u.p AS before, v.p AS behind, w.p AS quality FROM b
    LEFT JOIN r x ON x.matrix = 'place' AND x.pos = b.pos AND x.q = b.q LEFT JOIN r y ON y.matrix = 'both' AND y.before = b.before AND y.q = b.q AND y.behind = b.behind
    LEFT JOIN r u ON u.matrix = 'before' AND u.before = b.before AND u.q = b.q LEFT JOIN r v ON v.matrix = 'behind' AND v.q = b.q AND v.behind = b.behind LEFT JOIN r w ON w.matrix = 'quality' AND w.q = b.q)
SELECT read, pos, q, round(-10 * log10(coalesce(list_avg(list_filter([place, both_], lambda x: x IS NOT NULL)), list_avg(list_filter([before, behind], lambda x: x IS NOT NULL)), quality, pow(10, -q / 10))), 6) AS new FROM j""")
def blended_qualities(spark, d):
    bases = _stated(spark, d)
    return recalibration.blended(bases, recalibration.matrices(bases), 20).select("read", "pos", F.col("q").cast("long").alias("q"), "new")


# ------------------------------------------------------------------ sketches

BITS = 10


def _hash_sql(code: str, version: int = 0) -> str:
    """The 64-bit hash of a code, in 128-bit numbers."""
    wrap = "18446744073709551616::UHUGEINT"
    x = f"((({code})::UHUGEINT + {version * mergeable.STEP % 2**64}::UHUGEINT) % {wrap}) * {mergeable.FIRST}::UHUGEINT % {wrap}"
    return f"(SELECT xor(z, z // {2**29}::UHUGEINT) FROM (SELECT xor(y, y // {2**32}::UHUGEINT) * {mergeable.SECOND}::UHUGEINT % {wrap} AS z FROM (SELECT {x} AS y)))"


def _codes_sql(name: str, source: str) -> str:
    return f"{name} AS (SELECT name, list_reduce(list_transform(string_split(kmer, ''), lambda c: CAST(strpos('ACGT', c) - 1 AS BIGINT)), lambda a, x: a * 4 + x) AS code FROM {source})"


HLL = f"""{SEQS}, {_kmer_sql('km', 'seqs')}, {_codes_sql('kc', 'km')}, h AS (SELECT code, {_hash_sql('code')} AS h FROM (SELECT DISTINCT code FROM kc)),
g AS (SELECT code, CAST(h // {2 ** (64 - BITS)}::UHUGEINT AS INT) AS register, CAST(h % {2 ** (64 - BITS)}::UHUGEINT AS UBIGINT) AS rest FROM h), rk AS (SELECT code, register, {64 - BITS + 1} - CASE WHEN rest = 0 THEN 0 ELSE length(bin(rest)) END AS rank FROM g),
rg AS (SELECT source, register, CAST(max(rank) AS INT) AS rank FROM rk JOIN kc USING (code) JOIN seqs USING (name) GROUP BY ALL)"""


@query(f"WITH {HLL} SELECT * FROM rg")
def distinct_sketches(spark, d):
    """Registers by source."""
    return mergeable.distinct_sketch(_seqs(spark, d), "source", K, BITS)


@query(f"""WITH {HLL}, u AS (SELECT source, register, rank FROM rg UNION ALL SELECT 'united', register, max(rank) FROM rg GROUP BY register), s AS (SELECT source, count(*) AS hit, sum(pow(2, -rank)) AS s FROM u GROUP BY source),
e AS (SELECT source, {2**BITS} - hit AS empty, {0.7213 / (1 + 1.079 / 2**BITS) * 4**BITS} / (s + {2**BITS} - hit) AS raw FROM s)
SELECT source, round(CASE WHEN raw <= {2.5 * 2**BITS} AND empty > 0 THEN {2**BITS} * ln({2**BITS} / empty) ELSE raw END, 3) AS kmers FROM e""")
def united_sketches(spark, d):
    """Estimates of each source's sketch, and of their union."""
    own = mergeable.distinct_sketch(_seqs(spark, d), "source", K, BITS)
    whole = mergeable.united(own).withColumn("source", F.lit("united"))
    return mergeable.distinct_estimate(own.unionByName(whole), ["source"], BITS)


LINES, CELLS = 3, 12


@query(f"""WITH {SEQS}, {REFS}, {_kmer_sql('km', 'seqs')}, {_kmer_sql('rk', 'refs')}, {_codes_sql('kc', 'km')}, {_codes_sql('rc', 'rk')}, n AS (SELECT code, count(*) AS n FROM kc GROUP BY code), w AS (SELECT code FROM n UNION SELECT code FROM rc),
c AS (SELECT code, line, CAST(CASE line {' '.join(f"WHEN {i} THEN {_hash_sql('code', i + 1)}" for i in range(LINES))} END // {2 ** (64 - CELLS)}::UHUGEINT AS INT) AS cell FROM w, (SELECT unnest(generate_series(0, {LINES - 1})) AS line)),
t AS (SELECT line, cell, sum(n) AS n FROM n JOIN c USING (code) GROUP BY ALL) SELECT code AS kmer, CAST(min(coalesce(n, 0)) AS BIGINT) AS n FROM (SELECT DISTINCT code FROM rc) JOIN c USING (code) LEFT JOIN t USING (line, cell) GROUP BY code""")
def looked_up_counts(spark, d):
    """The references' k-mers in the united count tables of all sources."""
    table = mergeable.count_table(_seqs(spark, d), "source", K, CELLS, LINES)
    return mergeable.looked_up(codes.explode(_refs(spark, d), K).select("kmer"), table, CELLS, LINES)


@query(f"""WITH {SEQS}, {_kmer_sql('km', 'seqs', 12)}, h AS (SELECT DISTINCT name, md5(kmer) AS h FROM km), r AS (SELECT name, h FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h) AS n FROM h) WHERE n <= 32), z AS (SELECT name, count(*) AS n FROM r GROUP BY name),
p AS (SELECT a.name AS a, b.name AS b, count(*) AS shared FROM r a JOIN r b ON a.h = b.h AND a.name < b.name GROUP BY ALL HAVING count(*) >= 6)
SELECT a, b, shared, round(shared / x.n, 6) AS containment, round(shared / (x.n + y.n - shared), 6) AS jaccard, round(pow(shared / x.n, 1 / 12), 6) AS identity FROM p JOIN z x ON x.name = a JOIN z y ON y.name = b""")
def similar_sketches(spark, d):
    own = keep(kmers.sketch(_seqs(spark, d), 12, 32), "sketches")
    return kmers.similarity(kmers.compare(own, least=6, sizes=True), 12)


# ------------------------------------------------------- consensus and peaks


VOTES = f"""{SEQS}, {_kmer_sql('km', 'seqs', 15)}, r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY md5(kmer) DESC, pos) AS n FROM km),
o AS (SELECT r.name, kmer AS "pivot", CASE WHEN substr(seq, pos + 1, 15) = kmer THEN seq ELSE reverse(translate(seq, 'ACGT', 'TGCA')) END AS seq, CASE WHEN substr(seq, pos + 1, 15) = kmer THEN pos ELSE length(seq) - pos - 15 END AS begin FROM r JOIN seqs USING (name) WHERE n = 1),
v AS (SELECT "pivot", i - 1 - begin AS place, substr(seq, i, 1) AS base, count(*) AS weight FROM (SELECT "pivot", begin, seq, unnest(generate_series(1, length(seq))) AS i FROM o) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY "pivot", place ORDER BY weight DESC, base) AS n, sum(weight) OVER (PARTITION BY "pivot", place) AS whole FROM v)"""


@query(f"""WITH {VOTES}, s AS (SELECT "pivot", min(place) AS start, string_agg(base, '' ORDER BY place) AS seq FROM b WHERE n = 1 GROUP BY "pivot") SELECT "pivot", start, md5(seq) AS seq FROM s""")
def clump_consensus(spark, d):
    return consensus.clump_consensus(_seqs(spark, d).select("name", "seq"), 15).select("pivot", "start", F.md5("seq").alias("seq"))


@query("""WITH p AS (SELECT CAST(l_quantity AS INT) AS n, upper(md5(l_orderkey || '/1')) AS a, upper(md5(l_orderkey || '/2')) AS b FROM lineitem), f AS (SELECT 1 AS side, substr(a, n + 1, 12) AS t FROM p WHERE n < 32 UNION ALL SELECT 2, substr(b, n + 1, 12) FROM p WHERE n < 32),
v AS (SELECT side, i - 1 AS place, substr(t, i, 1) AS base, count(*) AS weight FROM (SELECT side, t, unnest(generate_series(1, length(t))) AS i FROM f) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY side, place ORDER BY weight DESC, base) AS n, sum(weight) OVER (PARTITION BY side, place) AS whole FROM v)
SELECT side, place, CASE WHEN weight / whole >= 0.065 THEN base ELSE 'N' END AS base, weight, round(weight / whole, 6) AS share FROM r WHERE n = 1""")
def adapter_votes(spark, d):
    pairs = _t(spark, d, "lineitem").select(F.md5(F.concat("l_orderkey", F.lit("/1"))).alias("seq1"), F.md5(F.concat("l_orderkey", F.lit("/2"))).alias("seq2"), F.col("l_quantity").cast("int").alias("insert"))
    return consensus.adapters(pairs, 12, 0.065)


@query("")
def merged_peaks(spark, d):
    """Peaks merged until each stands out; merging is a loop, so a test holds them against a plain one."""
    return depths.called_peaks(kmers.histogram(kmers.counts(_seqs(spark, d), K)))


@query(f"""WITH {SEQS}, s AS (SELECT name, seq, unnest(list_distinct(list_transform(generate_series(0, length(seq) - 60 + 44, 45), lambda x: least(x, length(seq) - 60)))) AS start FROM seqs WHERE length(seq) >= 60),
p AS (SELECT name, start, substr(seq, start + 1, 40) AS a, substr(seq, start + 21, 40) AS b, substr(translate(seq, 'ACGT', 'I5+A'), start + 1, 40) AS q, reverse(substr(translate(seq, 'ACGT', '5I(+'), start + 21, 40)) AS z FROM s), c AS (SELECT *, unnest(generate_series(12, 40)) AS o FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY name, start ORDER BY share, o DESC) AS n FROM (SELECT *, hamming(right(a, o), left(b, o)) / o AS share FROM c)), w AS (SELECT *, reverse(z) AS y FROM r WHERE n = 1 AND share <= 0.1),
m AS (SELECT name, start, a, b, q, y, o, unnest(generate_series(1, o)) AS i FROM w), e AS (SELECT name, start, i, substr(a, 40 - o + i, 1) AS x1, substr(b, i, 1) AS x2, ascii(substr(q, 40 - o + i, 1)) - 33 AS q1, ascii(substr(y, i, 1)) - 33 AS q2 FROM m),
g AS (SELECT name, start, string_agg(CASE WHEN q1 >= q2 THEN x1 ELSE x2 END, '' ORDER BY i) AS bases, string_agg(chr(CAST(33 + CASE WHEN x1 = x2 THEN least(q1 + q2, 41) ELSE abs(q1 - q2) END AS INT)), '' ORDER BY i) AS signs FROM e GROUP BY ALL)
SELECT p.name, CAST(p.start AS BIGINT) AS start, md5(substr(w.a, 1, 40 - o) || bases || substr(w.b, o + 1)) AS merged, md5(substr(w.q, 1, 40 - o) || signs || substr(y, o + 1)) AS merged_qual FROM p LEFT JOIN w ON w.name = p.name AND w.start = p.start LEFT JOIN g ON g.name = p.name AND g.start = p.start""")
def merged_by_quality(spark, d):
    """Mates of 40 bases from both ends of every 60 bases of a sequence, of different qualities."""
    tiles = _seqs(spark, d).select("name", F.inline(S.tiles(F.col("seq"), 60, 45)))
    first, second = F.substr("tile", F.lit(1), F.lit(40)), F.substr("tile", F.lit(21), F.lit(40))
    pairs = tiles.select("name", F.col("start").cast("long").alias("start"), first.alias("seq1"), F.translate(first, "ACGT", "I5+A").alias("qual1"), S.reverse_complement(second).alias("seq2"), F.reverse(F.translate(second, "ACGT", "5I(+")).alias("qual2"))
    return consensus.merged_by_quality(pairs).select("name", "start", F.md5("merged").alias("merged"), F.md5("merged_qual").alias("merged_qual"))
