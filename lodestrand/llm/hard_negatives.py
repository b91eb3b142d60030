"""Hard negatives for anchors, by inner products over rotated vectors.

An anchor's positives are its nearest rows of the same label; its hard
negatives for a positive are the nearest rows of other labels whose score is
LOW_PERCENT to 100 percent of the positive's.

Vectors are rotated to the principal axes of a bounded sample (SAMPLE_ROWS;
uncentred second moments, so that leading components carry most of an inner
product).  A task adds up the products of the leading components by stages; what the
rest can add is at most the product of the two residual norms plus a slack
for rounding, and a row goes as soon as that sum stays under what the anchor
still seeks.  Rows that come through are scored again by whole-number products
of the unrotated vectors, so the sample decides about speed alone.

Rows are dealt to cells by nearest pivot, cells are cut into parts of at most
CELL_ROWS rows, anchors of a cell into blocks of at most CELL_ANCHORS.  A first
pass searches an anchor's own part and gives it a floor; a second pass takes the
pairs of cells whose bound reaches the floor.  Scores of parts are merged by anchor, K a part.

Defined results: rows without id or label, and vectors that are null or hold a
null or non-finite component, take no part; rows equal in id, label and vector
are one row; an anchor meets no row of its own id and only vectors of its own
length; several rows of one anchor id are each an anchor; ties go to the
smaller id; a positive score under 0 has no negatives; scores beyond a long are
held at its ends; without anchors, positives or negatives there are no rows;
columns other than the three named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import save, settle
from .topk import _matrix, _nearest, plan_rows, reached, whole

K, LOW_PERCENT, EVERY, SHIFT_EVERY, LABELS = 5, 80, 100, 7, 10
CELL_ROWS, CELL_ANCHORS, MAX_PIVOTS, SAMPLE_ROWS, SEEDS, AT_ONCE = 16_384, 4_096, 1_024, 20_000, 64, 64
_LONG = 2**63 - 1


# ------------------------------------------------------------- within a task


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthogonal columns, the direction of the greatest second moment first."""
    scale = np.abs(sample).max(initial=0.0) or 1.0
    return np.linalg.eigh((sample / scale).T @ (sample / scale))[1][:, ::-1]


def stages(dim: int) -> list[int]:
    """The numbers of leading components after which rows are discarded."""
    return sorted({max(1, dim // 8), max(1, dim // 4), max(1, dim // 2)}) if dim else []


class Rotated:
    """Rows, their rotated components, and the norm of what each stage has not yet added up."""

    def __init__(self, rows: np.ndarray, turn: np.ndarray) -> None:
        self.rows, self.turned = rows, rows @ turn
        squares = self.turned**2
        self.norm = np.sqrt(squares.sum(1))
        self.rest = {m: np.sqrt(squares[:, m:].sum(1)) for m in stages(rows.shape[1])}


def scores_above(anchors: np.ndarray, rows: np.ndarray, turn: np.ndarray, allowed: Callable[[int], np.ndarray], low: np.ndarray, raised: Callable[[int, np.ndarray], float]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each anchor: (its number, rows that may reach its ``low``, their exact scores). ``allowed`` masks an anchor's rows, ``raised`` gives a higher floor from exact scores of some of its rows. Components are whole numbers held as doubles."""
    dim = rows.shape[1]
    if float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, dim) >= 2.0**53:
        for j in range(len(anchors)):  # products that doubles cannot hold are made with whole numbers
            own = np.flatnonzero(allowed(j))
            a = [int(v) for v in anchors[j]]
            yield j, own, np.array([max(-_LONG - 1, min(_LONG, sum(x * int(y) for x, y in zip(a, rows[i])))) for i in own], np.int64)
        return
    steps = stages(dim)
    a, x = Rotated(anchors, turn), Rotated(rows, turn)
    for at in range(0, len(anchors), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        first = a.turned[some, : steps[0]] @ x.turned[:, : steps[0]].T if steps else np.zeros((len(anchors[some]), len(rows)))
        for j in range(at, min(at + AT_ONCE, len(anchors))):
            part, own, floor = first[j - at], np.flatnonzero(allowed(j)), low[j]
            if len(own) > 4 * SEEDS:
                likely = own[np.argpartition(-part[own], SEEDS)[:SEEDS]]
                floor = max(floor, raised(j, (rows[likely] @ anchors[j]).astype(np.int64)))
            slack, done = 1e-9 * (a.norm[j] * x.norm + 1.0), 0
            part = part[own]
            for m in steps:
                if done:
                    part = part + x.turned[own, done:m] @ a.turned[j, done:m]
                stays = part + a.rest[m][j] * x.rest[m][own] + slack[own] >= floor
                own, part, done = own[stays], part[stays], m
            yield j, own, (rows[own] @ anchors[j]).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.lexsort((ids, ~scores))  # ~s = -s - 1, which every long has


def lowest(positive: int, percent: int = LOW_PERCENT) -> int:
    """The least whole negative score that goes with a positive one."""
    return -(-percent * positive // 100)


def nearest_of_label(anchors: np.ndarray, anchor_ids: np.ndarray, low: np.ndarray, rows: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(anchor number, id, score) of the k best rows of other ids."""

    def raised(j: int, s: np.ndarray) -> float:
        return float(np.partition(s, -k)[-k]) if len(s) >= k else -np.inf

    out = []
    for j, own, s in scores_above(anchors, rows, turn, lambda j: ids != anchor_ids[j], low, raised):
        order = _best(s, ids[own])[:k]
        out += [(j, int(i), int(v)) for i, v in zip(ids[own][order], s[order])]
    return out


def negatives_of(anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, goals: list[list[int]], low: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, turn: np.ndarray, k: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(anchor number, positive score, id, score) of the first k rows of other labels for each of an anchor's positive scores."""

    def raised(j: int, s: np.ndarray) -> float:
        s, floors = np.sort(s), []
        for goal in goals[j]:
            n = int(np.searchsorted(s, goal, "right"))
            floors.append(max(float(lowest(goal, percent)), float(s[n - k]) if n >= k else -np.inf))
        return min(floors, default=np.inf)

    out = []
    for j, own, s in scores_above(anchors, rows, turn, lambda j: (labels != anchor_labels[j]) & (ids != anchor_ids[j]), low, raised):
        order = _best(s, ids[own])
        s, near = s[order], ids[own][order]
        rising = s[::-1]
        for goal in goals[j]:
            start = len(s) - int(np.searchsorted(rising, goal, "right"))
            end = min(start + k, len(s) - int(np.searchsorted(rising, lowest(goal, percent), "left")))
            out += [(j, goal, int(i), int(v)) for i, v in zip(near[start:end], s[start:end])]
    return out


# -------------------------------------------------------------- Spark's part


def relabelled(label: str = "label", id_col: str = "vec_id", every: int = SHIFT_EVERY, labels: int = LABELS) -> Column:
    """The label, moved on by one where the id is divisible by ``every``."""
    return F.when(F.col(id_col) % every == 0, (F.col(label).cast("long") + 1) % labels).otherwise(F.col(label).cast("long"))


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, percent: int = LOW_PERCENT, cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS, seed: int = 11) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor and positive the first k negatives; what was written on the way is deleted."""
    return settle(lambda: _mined(vectors, is_anchor, label, id_col, vector_col, k, percent, cell_rows, cell_anchors, seed), "negatives")


def _mined(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str, vector_col: str, k: int, percent: int, cell_rows: int, cell_anchors: int, seed: int) -> DataFrame:
    spark = vectors.sparkSession
    data = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole(vector_col).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("ask"))
    data = save(data.where("id is not null and label is not null and v is not null").distinct().withColumn("dim", F.size("v")), "rows")
    counts = {r.dim: r.n for r in data.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row for each length of vectors
    turns: dict[int, np.ndarray] = {}
    centres: dict[int, np.ndarray] = {}
    for dim, n in counts.items():
        found = data.where(F.col("dim") == dim).sample(False, min(1.0, 1.2 * SAMPLE_ROWS / n), seed).select("v").limit(SAMPLE_ROWS).collect()
        drawn = np.array([r.v for r in found], float).reshape(len(found), dim) if found else np.zeros((1, dim))
        turns[dim], centres[dim] = rotation(drawn), drawn[: min(MAX_PIVOTS, -(-n // cell_rows))]
    given = spark.sparkContext.broadcast((turns, centres))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("dim").to_numpy(zero_copy_only=False)
            shard, far = np.zeros(len(size), np.int32), np.zeros(len(size))
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                shard[at], far[at] = _nearest(_matrix(b.column("v").take(pa.array(at))).reshape(len(at), dim), given.value[1][int(dim)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard), pa.array(far)], names=[*b.schema.names, "shard", "far"])

    dealt = save(data.mapInArrow(deal, "id long, label long, v array<double>, ask boolean, dim int, shard int, far double"), "vectors")
    sizes = dealt.groupBy("dim", "shard").agg(F.count("*").alias("n"), F.sum(F.col("ask").cast("long")).alias("asks"), F.max("far").alias("rx"), F.max(F.when(F.col("ask"), F.col("far"))).alias("rq")).collect()  # MAX_PIVOTS rows for each length
    shape = plan_rows(spark, [(r.dim, r.shard, max(1, -(-r.n // cell_rows)), max(1, -(-r.asks // cell_anchors))) for r in sizes], "dim int, shard int, parts int, blocks int")
    dealt = dealt.join(shape, ["dim", "shard"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int")).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks").cast("long")).cast("int"))
    anchors = dealt.where("ask").withColumn("nth", F.xxhash64("id", "label", "v")).select("dim", "shard", "part", "block", "id", "label", "v", "nth")
    both = ["id", "label", "v", "nth", "low", "goals"]
    no_row = [F.lit(None).cast("long").alias("nth"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("array<long>").alias("goals")]

    def meet(seekers: DataFrame, by: list[str], find: Callable[[pa.Table], pa.Table], result: str, again: bool) -> DataFrame:
        """What ``find`` gives for the seekers and the rows of their own part or, again, of all other parts whose cell they can reach."""
        keys = ["dim", "shard", "part", "group", "block", *by]
        if again:
            low = F.when(F.count("low") == F.count("*"), F.min("low")).alias("low")
            floors = {(r.dim, r.shard): r.low for r in seekers.groupBy("dim", "shard").agg(low).collect()}
            reach = reached(spark, sizes, centres, floors, cell_rows, cell_anchors)
            asked = seekers.withColumnsRenamed({"shard": "group", "part": "own"}).join(reach, ["dim", "group"]).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).where("not (shard = group and part = own)")
            rows = dealt.drop("parts", "blocks", "block").join(reach, ["dim", "shard"])
        else:
            asked = seekers.withColumn("group", F.col("shard"))
            rows = dealt.drop("block").withColumn("group", F.col("shard"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *no_row)
        cols = list(dict.fromkeys([*keys, *both]))
        return asked.select(*cols).unionByName(rows.select(*cols)).groupBy(*keys).applyInArrow(find, result)

    def parts_of(table: pa.Table) -> tuple:
        ask = table.column("nth").is_valid().to_numpy()
        dim = table.column("dim")[0].as_py()
        v, ids, labels = _matrix(table.column("v")).reshape(len(table), dim), table.column("id").to_numpy(), table.column("label").to_numpy()
        asked = table.filter(pa.array(ask))
        low = np.nan_to_num(asked.column("low").to_numpy(), nan=-np.inf) if len(asked) else np.zeros(0)
        return v[ask], ids[ask], labels[ask], low.astype(float), asked.column("goals").to_pylist(), asked.column("nth").to_numpy(), v[~ask], ids[~ask], labels[~ask], given.value[0][dim]

    def positives(table: pa.Table) -> pa.Table:
        a, a_ids, _, low, _, nth, x, ids, _, turn = parts_of(table)
        found = nearest_of_label(a, a_ids, low, x, ids, turn, k) if len(a) and len(x) else []
        j, near, s = zip(*found) if found else ((), (), ())
        j = np.array(j, np.int64)
        return pa.table({"nth": pa.array(nth[j], pa.int64()), "anchor_id": pa.array(a_ids[j], pa.int64()), "positive_id": pa.array(near, pa.int64()), "positive_score": pa.array(s, pa.int64())})

    def negatives(table: pa.Table) -> pa.Table:
        a, a_ids, a_labels, low, goals, nth, x, ids, labels, turn = parts_of(table)
        found = negatives_of(a, a_ids, a_labels, goals, low, x, ids, labels, turn, k, percent) if len(a) and len(x) else []
        j, goal, near, s = zip(*found) if found else ((), (), (), ())
        return pa.table({"nth": pa.array(nth[np.array(j, np.int64)], pa.int64()), "positive_score": pa.array(goal, pa.int64()), "negative_id": pa.array(near, pa.int64()), "negative_score": pa.array(s, pa.int64())})

    def first_k(df: DataFrame, by: list[str], score: str, id_: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(score), id_)
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    kinds = "nth long, anchor_id long, positive_id long, positive_score long"
    seekers = anchors.select("*", F.lit(None).cast("double").alias("low"), F.lit(None).cast("array<long>").alias("goals"))
    home = save(meet(seekers, ["label"], positives, kinds, False), "first")
    floor = home.groupBy("nth").agg(F.when(F.count("*") >= k, F.min("positive_score")).cast("double").alias("low"))
    seekers = save(anchors.join(floor, "nth", "left").withColumn("goals", F.lit(None).cast("array<long>")), "seekers")
    chosen = save(first_k(home.unionByName(meet(seekers, ["label"], positives, kinds, True)), ["nth"], "positive_score", "positive_id").drop("rank"), "positives")

    # whole numbers, parted so that no product is beyond a long
    least = F.expr(f"(positive_score div 100) * {percent} + (positive_score % 100 * {percent} + 99) div 100").cast("double")
    goals = chosen.where("positive_score >= 0").select("nth", "positive_score", least.alias("least")).distinct()
    kinds = "nth long, positive_score long, negative_id long, negative_score long"
    wanted = goals.groupBy("nth").agg(F.min("least").alias("low"), F.collect_list("positive_score").alias("goals"))  # k scores at most
    seekers = save(anchors.join(wanted, "nth"), "seekers")
    home = save(meet(seekers, [], negatives, kinds, False), "first")
    full = home.groupBy("nth", "positive_score").agg(F.when(F.count("*") >= k, F.min("negative_score")).cast("double").alias("kth"))
    floor = goals.join(full, ["nth", "positive_score"], "left").groupBy("nth").agg(F.min(F.coalesce("kth", "least")).alias("low"))
    seekers = save(seekers.drop("low").join(floor, "nth"), "seekers")
    found = first_k(home.unionByName(meet(seekers, [], negatives, kinds, True)), ["nth", "positive_score"], "negative_score", "negative_id")
    return chosen.join(found, ["nth", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
