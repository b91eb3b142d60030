"""Exact top-k inner products by dual-tree search over cover trees.

Rows are dealt to shards by nearest pivot (pivots come from a bounded sample),
so that every shard has a centre and a covering radius; queries form groups in
the same way.  A first pass searches every query in its own shard and gives
each a lower bound of its k-th score.  Group and shard pairs whose inner
product bound

    <cq, cx> + rq |cx| + rx |cq| + rq rx

stays under the worst k-th score of the group are pruned; the rest meet in
tasks of bounded size, where a cover tree over the queries and one over the
data (children from farthest-first traversal: centres at least as far apart
as the radius that covers them) are descended together under the same rule.

Components become floor(256 * x) as doubles; scores are exact integers.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part; vectors meet only vectors of the same length; repeated rows each
count as a candidate (never for a query of the same id) and, where they ask, as
a query: the rows of one query_id share its k places; ties go to the smaller
id; ids may be negative; scores beyond a long are held at its ends; a table without queries
or candidates gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import save

K, SCALE, EVERY = 5, 256.0, 50
#: A task compares at most CELL_QUERIES queries with CELL_ROWS rows.  Pivots: one for each CELL_ROWS rows, MAX_PIVOTS at most.
CELL_ROWS, CELL_QUERIES, MAX_PIVOTS, LEAF, FANOUT = 16_384, 4_096, 1_024, 256, 16
#: A plan of so many pairs of cells is sent to every executor.
PLAN_ROWS = 200_000
_LONG = 2**63 - 1


# ---------------------------------------------------------------- cover tree


class Node:
    """Rows ``own`` of a matrix within ``radius`` of ``centre``."""

    def __init__(self, own: np.ndarray, centre: np.ndarray, radius: float) -> None:
        self.own, self.centre, self.radius, self.children = own, centre, radius, []
        self.norm = float(np.sqrt(centre @ centre))


def cover_tree(points: np.ndarray) -> Node:
    def distances(own: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((points[own] - centre) ** 2).sum(1), 0.0))

    def grow(own: np.ndarray, centre: np.ndarray, dist: np.ndarray) -> Node:
        node = Node(own, centre, float(dist.max(initial=0.0)))
        if len(own) <= LEAF or not node.radius:
            return node
        near, which, centres = dist.copy(), np.zeros(len(own), np.int64), [centre]
        while len(centres) < FANOUT and (far := int(near.argmax())) >= 0 and near[far] > 0:
            centres.append(points[own[far]])
            d = distances(own, centres[-1])
            closer = d < near
            near[closer], which[closer] = d[closer], len(centres) - 1
        node.children = [grow(own[which == c], centres[c], near[which == c]) for c in range(len(centres)) if (which == c).any()]
        return node

    everything = np.arange(len(points))
    return grow(everything, points[0], distances(everything, points[0]))


def _bound(q: Node, x: Node) -> float:
    top = float(q.centre @ x.centre) + q.radius * x.norm + x.radius * q.norm + q.radius * x.radius
    return top + 1e-9 * (abs(top) + q.norm * x.norm + q.radius * x.norm + x.radius * q.norm + 1)


def _below(scores: np.ndarray) -> np.ndarray:
    """Lower bounds of whole scores held as doubles, which round beyond 2**53."""
    return np.where(np.abs(scores) >= 2.0**53, np.nextafter(scores, -np.inf), scores)


def dual_search(queries: np.ndarray, query_ids: np.ndarray, worst: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores), each queries x k, best first; scores of -inf (and -1 ids, which may also be real ones) where there are fewer. ``worst``: a lower bound of each query's k-th score; only scores at or over it are looked for. Components are whole numbers held as doubles."""
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1]) < 2**53
    best, ids, worst = np.full((len(queries), k), -np.inf if exact else None, float if exact else object), np.full((len(queries), k), -1, np.int64), _below(worst.astype(float))
    if not exact:
        best[:] = -np.inf

    def compare(q: Node, x: Node) -> None:
        own = x.own
        if not x.radius and len(own) > k + 1:  # one and the same vector: only its k + 1 smallest ids can be among the best
            own = own[np.argsort(row_ids[own], kind="stable")]
            first = np.r_[True, np.diff(row_ids[own]) > 0]
            own = own[np.cumsum(first) <= k + 1]
        own = own[np.argsort(row_ids[own], kind="stable")]
        for i in range(0, len(q.own), LEAF):
            mine = q.own[i : i + LEAF]
            if exact:
                s = queries[mine] @ rows[own].T
            else:
                s = np.array([[sum(int(a) * int(b) for a, b in zip(u, v)) for v in rows[own]] for u in queries[mine]], object).reshape(len(mine), len(own))
            s[query_ids[mine][:, None] == row_ids[own][None, :]] = -np.inf
            hit = np.flatnonzero((s >= worst[mine][:, None]).any(1))
            if not len(hit):
                continue
            mine, s = mine[hit], s[hit]
            if s.shape[1] > k:
                top = np.argsort(-s, axis=1, kind="stable")[:, :k]
                s, new = np.take_along_axis(s, top, 1), row_ids[own][top]
            else:
                new = np.broadcast_to(row_ids[own], s.shape)
            s, new = np.concatenate([best[mine], s], 1), np.concatenate([ids[mine], new], 1)
            order = np.argsort(new, axis=1, kind="stable")
            s, new = np.take_along_axis(s, order, 1), np.take_along_axis(new, order, 1)
            order = np.argsort(-s, axis=1, kind="stable")[:, :k]
            best[mine], ids[mine] = np.take_along_axis(s, order, 1), np.take_along_axis(new, order, 1)
            worst[mine] = np.maximum(worst[mine], _below(best[mine, -1].astype(float)))

    if len(queries) and len(rows):
        a, b = cover_tree(queries), cover_tree(rows)
        todo, n = [(-_bound(a, b), 0, a, b)], 0
        while todo:
            top, _, q, x = heapq.heappop(todo)
            if -top < worst[q.own].min():
                continue
            if not q.children and not x.children:
                compare(q, x)
                continue
            wide = q.children and (not x.children or q.radius * x.norm > x.radius * q.norm)
            for y, z in ((c, x) for c in q.children) if wide else ((q, c) for c in x.children):
                n += 1
                if (top := _bound(y, z)) >= worst[y.own].min():
                    heapq.heappush(todo, (-top, n, y, z))
    ids[best == -np.inf] = -1
    return ids, best


# -------------------------------------------------------------- Spark's part


def whole(col: str) -> F.Column:
    """array<double> of floor(256 * x); null where the vector takes no part."""
    scaled = F.transform(F.col(col), lambda x: x.cast("double") * SCALE)
    sound = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() of a double gives a long, which would cut values beyond it
    return F.when(sound, F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)))


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    which, dist = np.empty(len(points), np.int64), np.empty(len(points))
    for i in range(0, len(points), 4096):
        p = points[i : i + 4096]
        d = (p**2).sum(1)[:, None] - 2 * p @ centres.T + (centres**2).sum(1)[None, :]
        which[i : i + 4096] = d.argmin(1)
    for c in np.unique(which):
        at = which == c
        dist[at] = np.sqrt(((points[at] - centres[c]) ** 2).sum(1))
    return which, dist


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def plan_rows(spark: SparkSession, rows: list[tuple] | pa.Table, schema: str) -> DataFrame:
    """A table of the driver's plan, broadcast while it has PLAN_ROWS rows or fewer; beyond that it meets other tables by its keys."""
    made = spark.createDataFrame(rows, schema)
    return F.broadcast(made) if len(rows) <= PLAN_ROWS else made


def pairs_in_reach(groups: np.ndarray, low: np.ndarray, rq: np.ndarray, shards: np.ndarray, rx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(groups, shards) whose greatest possible inner product is not under the group's floor, by one product of their centres."""
    norm_q, norm_x = np.sqrt((groups**2).sum(1)), np.sqrt((shards**2).sum(1))
    top = groups @ shards.T + rq[:, None] * norm_x + norm_q[:, None] * rx + rq[:, None] * rx
    slack = 1e-9 * (np.abs(top) + norm_q[:, None] * norm_x + rq[:, None] * norm_x + norm_q[:, None] * rx + 1)
    return np.nonzero(~(top + slack < low[:, None]))


def reached(spark: SparkSession, sizes: Iterable[Row], centres: dict[int, np.ndarray], floors: dict[tuple[int, int], float | None], cell_rows: int, cell_queries: int) -> DataFrame:
    """dim, group, shard, parts and blocks of the pairs of cells whose bound reaches the group's floor (none: all pairs). sizes: dim, shard, n, asks, rx and rq of each cell."""
    found = {name: [] for name in ("dim", "group", "shard", "parts", "blocks")}
    for dim, c in centres.items():
        own = sorted((r for r in sizes if r.dim == dim), key=lambda r: r.shard)
        asking = [r for r in own if (dim, r.shard) in floors]
        if not asking:
            continue
        low = np.array([-np.inf if floors[dim, r.shard] is None else floors[dim, r.shard] for r in asking], float)
        g, s = pairs_in_reach(c[[r.shard for r in asking]], low, np.array([r.rq or 0.0 for r in asking]), c[[r.shard for r in own]], np.array([r.rx for r in own]))
        group, shard = np.array([r.shard for r in asking]), np.array([r.shard for r in own])
        parts, blocks = np.array([max(1, -(-r.n // cell_rows)) for r in own]), np.array([max(1, -(-(r.asks or 0) // cell_queries)) for r in asking])
        for name, values in (("dim", np.full(len(g), dim)), ("group", group[g]), ("shard", shard[s]), ("parts", parts[s]), ("blocks", blocks[g])):
            found[name].append(values.astype(np.int32))
    rows = pa.table({name: pa.array(np.concatenate(v) if v else [], pa.int32()) for name, v in found.items()})
    return plan_rows(spark, rows, "dim int, group int, shard int, parts int, blocks int")


def top_k(vectors: DataFrame, is_query: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, cell_rows: int = CELL_ROWS, cell_queries: int = CELL_QUERIES, seed: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each row that is_query holds for, against all rows."""
    spark = vectors.sparkSession
    data = vectors.select(F.col(id_col).cast("long").alias("id"), whole(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("ask")).where("v is not null and id is not null")
    # Equal rows are one row that holds how often it stands there and asks; k places hold k copies at most.
    data = data.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"), F.least(F.sum(F.col("ask").cast("long")), F.lit(k)).cast("int").alias("asks"))
    data = save(data.withColumn("ask", F.col("asks") > 0).withColumn("dim", F.size("v")), "rows")
    dims = {r.dim: r.n for r in data.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    centres: dict[int, np.ndarray] = {}
    for dim, n in dims.items():
        want = min(MAX_PIVOTS, -(-n // cell_rows))
        found = data.where(F.col("dim") == dim).sample(False, min(1.0, 20.0 * want / n), seed).select("v").limit(want).collect()
        centres[dim] = np.array([r.v for r in found], float).reshape(len(found), dim) if found else np.zeros((1, dim))
    given = spark.sparkContext.broadcast(centres)

    def deal(batches):
        for b in batches:
            size = b.column("dim").to_numpy(zero_copy_only=False)
            shard, far = np.zeros(len(size), np.int32), np.zeros(len(size))
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                shard[at], far[at] = _nearest(_matrix(b.column("v").take(pa.array(at))).reshape(len(at), dim), given.value[int(dim)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard), pa.array(far)], names=[*b.schema.names, "shard", "far"])

    dealt = save(data.mapInArrow(deal, "id long, v array<double>, copies int, asks int, ask boolean, dim int, shard int, far double"), "vectors")
    sizes = {(r.dim, r.shard): r for r in dealt.groupBy("dim", "shard").agg(F.count("*").alias("n"), F.sum(F.col("ask").cast("long")).alias("asks"), F.max("far").alias("rx"), F.max(F.when(F.col("ask"), F.col("far"))).alias("rq")).collect()}  # MAX_PIVOTS rows for each length
    parts = {key: max(1, -(-r.n // cell_rows)) for key, r in sizes.items()}
    blocks = {key: max(1, -(-(r.asks or 0) // cell_queries)) for key, r in sizes.items()}

    shape = plan_rows(spark, [(d, s, parts[d, s], blocks[d, s]) for d, s in sizes], "dim int, shard int, parts int, blocks int")
    dealt = dealt.join(shape, ["dim", "shard"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int")).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks").cast("long")).cast("int"))

    def search(table: pa.Table) -> pa.Table:
        ask = table.column("ask").to_numpy()
        dim = table.column("dim")[0].as_py()
        v = _matrix(table.column("v")).reshape(len(table), dim)
        ids, worst = table.column("id").to_numpy(), table.column("worst").to_numpy()
        times = table.column("times").to_numpy()  # of a query row: how often it asks; of a candidate: its copies
        rows = np.repeat(np.flatnonzero(~ask), times[~ask])
        near, score = dual_search(v[ask], ids[ask], np.nan_to_num(worst[ask], nan=-np.inf), v[rows], ids[rows], k)
        q, r = np.nonzero(score != -np.inf)
        return pa.table({"query_id": ids[ask][q], "times": times[ask][q], "vec_id": near[q, r], "score": pa.array([int(max(-_LONG - 1, min(_LONG, int(x)))) for x in score[q, r]], pa.int64()), "nth": pa.array(table.column("nth").to_numpy()[ask][q], pa.int64())})

    result = "query_id long, times int, vec_id long, score long, nth long"
    keys = ["dim", "shard", "part", "group", "block"]
    seekers = dealt.where("ask").withColumn("nth", F.xxhash64("id", F.col("v").cast("string")))
    # First pass: a query and the part of its own shard that its id falls in.
    home = seekers.select("dim", "shard", "part", F.col("shard").alias("group"), "block", "id", "v", F.lit(True).alias("ask"), F.col("asks").alias("times"), "nth", F.lit(None).cast("double").alias("worst"))
    blocked = dealt.select("dim", "shard", "part", F.col("shard").alias("group"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "v", F.lit(False).alias("ask"), F.col("copies").alias("times"), F.lit(0).cast("long").alias("nth"), F.lit(None).cast("double").alias("worst"))
    first = save(home.unionByName(blocked).groupBy(*keys).applyInArrow(search, result), "first")
    floor = first.groupBy("nth", F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("worst"))
    seekers = save(seekers.join(floor, ["nth", "id"], "left").select("dim", "shard", "part", "block", "id", "v", "asks", "nth", "worst"), "seekers")
    floors = {(r.dim, r.shard): r.worst for r in seekers.groupBy("dim", "shard").agg(F.when(F.count("worst") == F.count("*"), F.min("worst")).alias("worst")).collect()}
    reach = reached(spark, sizes.values(), centres, floors, cell_rows, cell_queries)
    asked = (
        seekers.withColumnsRenamed({"shard": "group", "part": "own"}).join(reach, ["dim", "group"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .where("not (shard = group and part = own)")
        .select(*keys, "id", "v", F.lit(True).alias("ask"), F.col("asks").alias("times"), "nth", F.col("worst").cast("double").alias("worst"))
    )
    rows = (
        dealt.drop("parts", "blocks", "block").join(reach, ["dim", "shard"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select(*keys, "id", "v", F.lit(False).alias("ask"), F.col("copies").alias("times"), F.lit(0).cast("long").alias("nth"), F.lit(None).cast("double").alias("worst"))
    )
    second = asked.unionByName(rows).groupBy(*keys).applyInArrow(search, result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a query row and a candidate row meet once, so nothing is found twice
    found = first.unionByName(second).select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), "times")))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
