"""SimHash near-duplicates: exact Hamming links found through vantage-point trees.

``fingerprints`` hashes word shingles to 64-bit SimHashes inside Arrow tasks.
``near_duplicates`` links distinct fingerprints that differ in at most
``radius`` bits.  A small vantage-point tree, fitted on a bounded sample,
deals every fingerprint to one home shard by its Hamming distances to the
vantage points.  By the triangle inequality a pair split by a vantage point
at distance m lies within ``radius`` of that boundary, so the boundary rows of
one side are also sent to the other side's shard: every pair within the radius
meets in some shard, and all other shards are pruned.  Each shard grows its
own tree further and compares what is left.  Shards report one edge per row
(to the smallest member it links with), never all pairs.

Defined results: null and word-less texts have fingerprint 0 and link like any
other; repeated rows each return a row; a null doc_id never becomes a
component_id unless no other id is in its component (then component_id is
null); an empty table gives an empty result; columns other than doc_id and
text are ignored by the query and carried through by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import release, save, settle

SHINGLE, SEED, RADIUS = 3, 42, 2
#: The upper tree is fitted on at most so many fingerprints; a shard aims at SHARD_ROWS rows and is cut into blocks beyond 4 times that.
SAMPLE_ROWS, SHARD_ROWS, MAX_SHARDS, BRUTE_ROWS = 65_536, 8_192, 65_536, 512
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the whole text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, seed)
    hashes = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :])), np.uint64, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def slices(batch: pa.RecordBatch, rows: int = 128) -> Iterator[pa.RecordBatch]:
    """A batch in parts of few rows, so that what is made of its texts is not held for all of them at once."""
    return (batch.slice(i, rows) for i in range(0, len(batch), rows))


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED, out: str = "fp") -> DataFrame:
    """All columns of docs plus ``out``: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, width, seed) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.int64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())]))


# ------------------------------------------------------------ vantage points


def _split(points: np.ndarray, radius: int, rng: np.random.Generator, tries: int = 6) -> tuple | None:
    """(vantage, m, inner rows copied outward?) with the fewest boundary rows among balanced cuts of a few random vantage points."""
    best = None
    for v in rng.choice(points, min(tries, len(points)), replace=False):
        below = np.cumsum(np.bincount(np.bitwise_count(points ^ v), minlength=65))
        for m in range(64):
            inner = below[m]
            if not 0.3 * len(points) <= inner <= 0.7 * len(points):
                continue
            outward = inner - (below[m - radius] if m >= radius else 0)
            inward = below[min(64, m + radius)] - inner
            cost = min(outward, inward) + 0.2 * abs(2 * inner - len(points))
            if best is None or cost < best[0]:
                best = (cost, v, m, bool(outward <= inward))
    return best and best[1:]


def _sides(points: np.ndarray, vantage: np.uint64, m: int, outward: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of what goes to the inner and to the outer child; one side's boundary rows go to both."""
    d = np.bitwise_count(points ^ vantage).astype(np.int16)
    return (d <= m, d > m - radius) if outward else (d <= m + radius, d > m)


def fit_tree(sample: np.ndarray, shards: int, radius: int = RADIUS, seed: int = 7) -> list:
    """Inner nodes [vantage, m, outward, inner, outer]; a child below zero is shard -child-1."""
    rng, nodes, leaves = np.random.default_rng(seed), [], 0
    least = max(2, len(sample) // max(1, shards))

    def grow(points: np.ndarray) -> int:
        nonlocal leaves
        cut = _split(points, radius, rng) if len(points) >= 2 * least and shards > 1 else None
        if cut is None:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(None)
        near = np.bitwise_count(points ^ cut[0]) <= cut[1]
        nodes[at] = (*cut, grow(points[near]), grow(points[~near]))
        return at

    grow(sample)
    return nodes


def route(nodes: list, points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) pairs: the home shard of each point and the shards that its boundary distances reach."""
    rows, shards, todo = [], [], [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        at, own = todo.pop()
        if at < 0:
            rows.append(own)
            shards.append(np.full(len(own), -at - 1))
        elif len(own):
            vantage, m, outward, inner, outer = nodes[at]
            a, b = _sides(points[own], vantage, m, outward, radius)
            todo += [(inner, own[a]), (outer, own[b])]
    return np.concatenate(rows), np.concatenate(shards)


def link_shard(points: np.ndarray, radius: int = RADIUS, seed: int = 11) -> np.ndarray:
    """For each point the index of the first point of its component among these points."""
    rng, parent = np.random.default_rng(seed), np.arange(len(points))

    def roots() -> None:
        while True:
            up = parent[parent]
            if (up == parent).all():
                return
            parent[:] = up

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        roots()
        a, b = parent[a], parent[b]
        apart = a != b
        if apart.any():
            for x, y in np.unique(np.stack([np.minimum(a, b)[apart], np.maximum(a, b)[apart]], 1), axis=0):
                x, y = find(x), find(y)
                parent[max(x, y)] = min(x, y)

    todo = [np.arange(len(points))]
    while todo:
        own = todo.pop()
        cut = _split(points[own], radius, rng) if len(own) > BRUTE_ROWS else None
        if cut is not None:
            a, b = _sides(points[own], *cut, radius)
            if max(a.sum(), b.sum()) <= 0.9 * len(own):
                todo += [own[a], own[b]]
                continue
        for i in range(0, len(own), BRUTE_ROWS):
            for j in range(i, len(own), BRUTE_ROWS):
                x, y = np.nonzero(np.bitwise_count(points[own[i : i + BRUTE_ROWS], None] ^ points[None, own[j : j + BRUTE_ROWS]]) <= radius)
                x, y = own[x + i], own[y + j]
                unite(x[x < y], y[x < y])
    roots()
    return parent


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges(a, b): large-star and small-star rounds, each a written table, until nothing changes."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def downward(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = save(downward(edges), "edges")
    seen = mark(now)
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large = downward(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        before, now = now, save(downward(small), "edges")
        was, seen = seen, mark(now)
        release(before)
        if was == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, seed: int = 7) -> DataFrame:
    """edges(a, b) between fingerprints of distinct(fp) at ``radius`` bits or fewer: one for each row of a shard that links, to the first member of its component there."""
    spark, n = distinct.sparkSession, distinct.count()
    shards = min(MAX_SHARDS, max(1, -(-n // shard_rows)))
    few = distinct.sample(False, min(1.0, 0.9 * SAMPLE_ROWS / max(n, 1)), seed).limit(SAMPLE_ROWS).collect() if shards > 1 else []
    nodes = fit_tree(np.array([r.fp for r in few], np.int64).view(np.uint64), shards, radius, seed)
    tree = spark.sparkContext.broadcast(nodes)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False)
            rows, to = route(tree.value, fps.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(fps[rows]), pa.array(to.astype(np.int32))], names=["fp", "shard"])

    def link(table: pa.Table) -> pa.Table:
        fps = np.unique(table.column("fp").to_numpy())
        root = link_shard(fps.view(np.uint64), radius)
        to = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"a": fps[to], "b": fps[root[to]]})

    dealt = save(distinct.select("fp").mapInArrow(deal, "fp long, shard int"), "shards")
    # A shard that the sample did not foresee is cut into blocks, and every two of its blocks meet in a task.
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(4 * shard_rows)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    cells = (
        dealt.join(F.broadcast(sizes), "shard")  # at most MAX_SHARDS rows
        .select("fp", "shard", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("fp", "shard", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"))
    )
    return cells.groupBy("shard", "x", "y").applyInArrow(link, "a long, b long")


def classes(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each distinct fp of fps(doc_id, fp): id (its smallest doc_id), component_id (the smallest in its component) and root (one fp of the component)."""
    reps = save(fps.groupBy("fp").agg(F.min("doc_id").alias("id")), "reps")
    roots = settle(lambda: components(links(reps.select("fp"), radius, shard_rows)), "roots")
    named = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    least = save(named.where("root is not null").groupBy("root").agg(F.min("id").alias("least")), "least")
    # a component may hold a third of all rows, so that its root is no key to deal rows by where the roots are few
    return named.join(F.broadcast(least) if least.count() <= 500_000 else least, "root", "left").select(
        "fp", "id", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"), F.coalesce("root", "fp").alias("root")
    )


def hex_of(fp: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, seed: int = SEED, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs(doc_id, text)."""
    fps = save(fingerprints(docs.select("doc_id", "text"), width, seed).select("doc_id", "fp"), "fingerprints")
    found = classes(fps, radius, shard_rows).select("fp", "component_id")
    return fps.join(found, "fp").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, seed: int = SEED, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """docs with one document of each component: that of the smallest doc_id (of repeated rows with it, one)."""
    taken, mark = {c.lower() for c in docs.columns}, "fp"
    while mark in taken:
        mark += "_"
    fps = save(fingerprints(docs, width, seed, mark), "fingerprints")
    found = classes(fps.select("doc_id", F.col(mark).alias("fp")), radius, shard_rows)
    # The fingerprint that holds the smallest id keeps its row; where all ids are null, the root does.
    kept = found.where("id <=> component_id and (id is not null or fp = root)").groupBy("root", "id").agg(F.min("fp").alias("keep")).select(F.col("keep").alias(f"{mark}k"), F.col("id").alias(f"{mark}i"))
    first = Window.partitionBy(mark).orderBy(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns]))
    return (
        fps.join(kept, F.col(mark) == F.col(f"{mark}k")).where(F.col("doc_id").eqNullSafe(F.col(f"{mark}i")))  # by the fingerprint alone, as the window
        .withColumn(f"{mark}n", F.row_number().over(first))
        .where(F.col(f"{mark}n") == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


# ------------------------------------------------- near-duplicates by Jaccard

#: Texts are similar when their sets of words in fives share SHARE or more.  At that share the expected distance of two 128-bit
#: fingerprints is about 20 bits (24 for texts of a few shingles), with a deviation of 4; WIDE_RADIUS is four deviations above.
#: No cut of a vantage-point tree prunes at such a radius (distances of unlike texts are 64, give or take 6), so fingerprints meet where
#: texts share the least of their shingles by one of KEYS hash orders: of a pair at the share, all keys differ once in 0.2 ** -KEYS = 2.4e8 pairs.
WIDE_SHINGLE, SHARE, WIDE_RADIUS, KEYS = 5, 0.8, 40, 12
#: A key of more rows is cut into blocks that meet pairwise; one of over MANY_BLOCKS is split by the other keys before.
BLOCK_ROWS, MANY_BLOCKS, SMALL_RUN = 4_096, 64, 24


def shingles(text: str | None, width: int = WIDE_SHINGLE) -> set[bytes]:
    """The different word shingles of the whole text; one of fewer words is a shingle itself."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


_ORDERS = np.random.default_rng(SEED).integers(0, 2**63, (KEYS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def wide_fingerprint(found: set[bytes]) -> tuple[bytes, np.ndarray]:
    """128-bit SimHash of a set of shingles, and the least of their hashes in each order (none of an empty set)."""
    if not found:
        return bytes(16), np.zeros(0, np.int64)
    hashes, counts = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), np.uint8).reshape(-1, 16), np.zeros(128, np.int64)
    for i in range(0, len(hashes), 16_384):
        counts += np.unpackbits(hashes[i : i + 16_384], axis=1).sum(axis=0, dtype=np.int64)
    low, high = hashes.view("<u8").T
    least = [(((low * x) ^ high) * y).min() for x, y in _ORDERS]
    return np.packbits(counts * 2 > len(hashes)).tobytes(), np.array(least, np.uint64).view(np.int64)


class Cells:
    """Rows in order of their cells: fingerprints (x 2), sizes, 32 bits of each key (x KEYS), the key that the cell is of, a second one that split it (or -1), and the row's block."""

    def __init__(self, t: pa.Table) -> None:
        column = lambda c: t.column(c).to_numpy()
        self.cell, self.size, self.key, self.second, self.block = map(column, ("cell", "n", "i", "j", "b"))
        self.print, self.keys = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(len(t), -1) for c, kind in (("f", np.uint64), ("w", np.uint32)))
        self.first = np.flatnonzero(np.r_[True, self.cell[1:] != self.cell[:-1]]) if len(t) else np.zeros(0, np.int64)
        self.rows = np.diff(np.r_[self.first, len(t)])

    def close(self, x: np.ndarray, y: np.ndarray, share: float, radius: int) -> np.ndarray:
        """Which pairs of rows of one cell are within the radius, and of sizes that allow the share."""
        n, m = self.size[x], self.size[y]
        return (np.minimum(n, m) >= share * np.maximum(n, m) - 1e-9) & (np.bitwise_count(self.print[x] ^ self.print[y]).sum(axis=1, dtype=np.uint8) <= radius)

    def belongs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs are this cell's, of all the cells that they share: that of their first shared key (and the next one, where that split it), and of two blocks, if theirs differ."""
        same = self.keys[x] == self.keys[y]
        key, second = self.key[x], self.second[x]
        ok = same.argmax(axis=1) == key
        split = second >= 0
        if split.any():
            same[np.arange(len(x)), key] = False
            ok &= ~split | (same.argmax(axis=1) == second)
        return ok

    def pairs(self, share: float, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Close pairs x < y of all cells, each pair in one cell: those of small cells by the distance of the two rows, those of large ones by blocks."""
        run, small = np.repeat(np.arange(len(self.first)), self.rows), np.repeat(self.rows <= SMALL_RUN, self.rows)
        for step in range(1, SMALL_RUN):
            x = np.flatnonzero(small[:-step] & (run[step:] == run[:-step]))
            if not len(x):
                break
            yield from self._chosen(x, x + step, share, radius)
        for k in np.flatnonzero(self.rows > SMALL_RUN):
            own = np.arange(self.first[k], self.first[k] + self.rows[k])
            for i in range(0, len(own), BRUTE_ROWS):
                for j in range(i, len(own), BRUTE_ROWS):
                    a, b = own[i : i + BRUTE_ROWS], own[j : j + BRUTE_ROWS]
                    near = np.bitwise_count(self.print[a, None] ^ self.print[None, b]).sum(axis=2, dtype=np.uint8) <= radius
                    x, y = np.nonzero(near)
                    x, y = a[x], b[y]
                    yield from self._chosen(x[x < y], y[x < y], share, radius)

    def _chosen(self, x: np.ndarray, y: np.ndarray, share: float, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # a cell of two blocks has none of the pairs within one of them, but for rows of block -1, which meet all
        ok = self.close(x, y, share, radius)
        x, y = x[ok], y[ok]
        ok = self.belongs(x, y) & ((self.block[x] != self.block[y]) | self.alone[x] | (self.block[x] < 0))
        if ok.any():
            yield x[ok], y[ok]

    @cached_property
    def alone(self) -> np.ndarray:
        """Whether the cell of a row is of one block."""
        least, most = np.minimum.reduceat(self.block, self.first), np.maximum.reduceat(self.block, self.first)
        return np.repeat(least == most, self.rows)


def _share_of(a: np.ndarray, b: np.ndarray, share: float) -> bool:
    """Whether two sets of hashes, in order, share enough."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both >= share * (len(a) + len(b) - both) - 1e-9


def similar_rows(cells: Cells, sets: list[np.ndarray], share: float = SHARE, radius: int = WIDE_RADIUS) -> list[tuple[int, int]]:
    """Pairs of rows, similar by their whole sets of shingle hashes, that join all rows that are: close rows are compared unless pairs before join them."""
    run, root, found = np.repeat(np.arange(len(cells.first)), cells.rows), np.arange(len(cells.cell)), []
    for x, y in cells.pairs(share, radius):
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        order = np.argsort(y, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(y[order])) + 1):
            if not len(part):
                continue
            xs, to = x[part], y[part[0]]
            own = slice(cells.first[run[to]], cells.first[run[to]] + cells.rows[run[to]])
            while len(xs := xs[root[xs] != root[to]]):
                at, xs = xs[0], xs[1:]
                if _share_of(sets[at], sets[to], share):
                    found.append((at, to))
                    part_of = root[own]
                    part_of[part_of == root[to]] = root[at]
    return found


def _keys(reps: DataFrame) -> DataFrame:
    """(s, f, n, m, w, i, j, k): the rows of reps under each of their keys."""
    return reps.select("s", "f", "n", "m", "w", F.posexplode("m").alias("i", "v")).select("s", "f", "n", "m", "w", "i", F.lit(-1).alias("j"), F.xxhash64("i", "v").alias("k"))


def _hot(keys: DataFrame, block_rows: int) -> DataFrame:
    """k and rows of keys with more rows than a block."""
    return save(keys.groupBy("k").agg(F.count("*").alias("rows")).where(F.col("rows") > block_rows), "hot")


def _few(table: DataFrame) -> DataFrame:
    """table, broadcast if it is counted to be small."""
    return F.broadcast(table) if table.count() <= 500_000 else table


def meeting_cells(reps: DataFrame, block_rows: int = BLOCK_ROWS, many: int = MANY_BLOCKS, hot: DataFrame | None = None) -> DataFrame:
    """(cell, i, j, b, s, f, n, w): the rows of reps(s, f, n, m, w) under each of their keys m, so that rows that share a key meet in a cell of bounded size.

    Keys of over ``many`` blocks are split by the rows' other keys (as likely to agree); of every key with more rows than a block, any two
    blocks share a cell.  Pairs that agree in a split key alone meet in ``rest_cells``.
    """
    keys = _keys(reps)
    rows = keys.join(_few(hot if hot is not None else _hot(keys, block_rows)), "k", "left")
    huge = F.coalesce("rows", F.lit(0)) > block_rows * many
    split = rows.where(huge).select("s", "f", "n", "w", "i", "k", F.posexplode("m").alias("j", "v")).where("i <> j").select("s", "f", "n", "w", "i", "j", F.xxhash64("k", "j", "v").alias("k"))
    columns = ["k", "rows", "i", "j", "s", "f", "n", "w"]
    blocks = F.ceil(F.coalesce("rows", F.lit(1)) / F.lit(block_rows)).cast("int")
    mine = F.pmod(F.xxhash64("s"), F.col("blocks").cast("long")).cast("int")
    dealt = rows.where(~huge).select(*columns).unionAll(split.join(_few(_hot(split, block_rows)), "k", "left").select(*columns)).withColumn("blocks", blocks)
    met = dealt.select("k", "i", "j", mine.alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"), "s", "f", "n", "w")
    return met.select(F.xxhash64("k", F.least("b", "with"), F.greatest("b", "with")).alias("cell"), "i", "j", "b", "s", "f", "n", "w")


def rest_cells(reps: DataFrame, huge: DataFrame, links: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """As meeting_cells, of the keys huge(k, rows) that it splits: their rows that ``links`` leave outside the largest component of the key (b: -1) meet all rows of the key.

    Two rows of that component need no link, so a group of near copies costs as many cells as blocks, not their square, and no pair is left out.
    """
    roots = settle(lambda: components(links), "roots")
    rows = _keys(reps).join(_few(huge.select("k")), "k").join(roots.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    rows = save(rows.select("k", "i", "j", "s", "f", "n", "w", "root"), "huge")
    each = save(rows.groupBy("k", "root").agg(F.count("*").alias("rows")), "parts")
    sizes = each.groupBy("k").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.max("rows").alias("most"), F.sum("rows").alias("rows")).where("rows > most")
    blocks = lambda c: F.ceil(c / F.lit(block_rows)).cast("int")
    held = rows.join(_few(sizes.select("k", "main", blocks(F.col("rows")).alias("all"), blocks(F.col("rows") - F.col("most")).alias("rest"))), "k").withColumn("b", -(F.col("root") != F.col("main")).cast("int"))
    mine = lambda c: F.pmod(F.xxhash64("s"), F.col(c).cast("long")).cast("int")
    to = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    along, across = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda x: to(x, mine("all"))), F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda y: to(mine("rest"), y))
    met = held.select("k", "i", "j", "b", "s", "f", "n", "w", F.inline(F.when(F.col("b") < 0, F.array_union(along, across)).otherwise(along)))
    return met.select(F.xxhash64("k", F.lit(-1), "x", "y").alias("cell"), "i", "j", "b", "s", "f", "n", "w")


def similar_links(reps: DataFrame, texts: DataFrame, share: float = SHARE, radius: int = WIDE_RADIUS, block_rows: int = BLOCK_ROWS, many: int = MANY_BLOCKS) -> DataFrame:
    """edges(a, b) that join the keys of reps(s, f, n, m, w) into components of similar texts, by texts(s, text), of which those of one key hold the same words."""
    hot = _hot(_keys(reps), block_rows)
    found = _compared(meeting_cells(reps, block_rows, many, hot), texts, share, radius, block_rows)
    huge = hot.where(F.col("rows") > block_rows * many)
    if huge.isEmpty():
        return found
    return found.unionByName(_compared(rest_cells(reps, huge, found, block_rows), texts, share, radius, block_rows))


def _compared(met: DataFrame, texts: DataFrame, share: float, radius: int, block_rows: int) -> DataFrame:
    """edges(a, b) of the cells of ``met``.

    First short rows meet in their cells and tell which of them have a close one there; a pair counts in one of the cells that it shares.
    Only these rows go to the same cells again, with the hashes of all their shingles, where they are compared; a cell gives one edge a
    row at most, never all pairs.
    """
    cells = save(met, "cells")
    bins = max(1, -(-cells.count() // (4 * block_rows)))
    dealt = F.pmod("cell", F.lit(bins)).alias("bin")
    schema = "cell long, i int, j int, b int, s long, f binary, n long, w binary"

    def find(t: pa.Table) -> pa.Table:
        t = t.take(np.lexsort((t.column("s").to_numpy(), t.column("cell").to_numpy()))).select(["cell", "i", "j", "b", "s", "f", "n", "w"])
        ok = np.zeros(len(t), bool)
        for x, y in Cells(t).pairs(share, radius):
            ok[x] = ok[y] = True
        return t.filter(pa.array(ok))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole)):
            sets = [np.sort(np.array([xxhash.xxh3_64_intdigest(x) for x in shingles(t)], np.uint64)).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("s"), pa.array(sets, pa.binary())], names=["s", "hashes"])

    def link(t: pa.Table) -> pa.Table:
        t = t.take(np.lexsort((t.column("s").to_numpy(), t.column("cell").to_numpy())))
        pairs = similar_rows(Cells(t), [np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()], share, radius)
        a, b = np.array(pairs, np.int64).reshape(-1, 2).T
        s = t.column("s").to_numpy()
        return pa.table({"a": s[a], "b": s[b]})

    close = save(cells.groupBy(dealt).applyInArrow(find, schema), "close")
    sets = texts.join(close.select("s").distinct(), "s", "left_semi").groupBy("s").agg(F.first("text").alias("text")).mapInArrow(hashes, "s long, hashes binary")
    found = save(close.join(sets, "s").groupBy(dealt).applyInArrow(link, "a long, b long"), "links")
    release(cells, close)
    return found


def drop_similar(docs: DataFrame, share: float = SHARE, radius: int = WIDE_RADIUS, block_rows: int = BLOCK_ROWS, many: int = MANY_BLOCKS) -> DataFrame:
    """docs with one document of each component of texts that share ``share`` of their five-word shingles: that of the smallest doc_id (of repeated rows with it, one)."""
    taken, mark = {c.lower() for c in docs.columns}, "m_"
    while any(c.startswith(mark) for c in taken):
        mark += "_"
    s, f, n, m, w = (mark + c for c in "sfnmw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole)):
            texts = b.column("text").to_pylist()
            sets = [shingles(t) for t in texts]
            same = [xxhash.xxh3_64_intdigest(b" ".join((t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split())) for t in texts]
            prints = [wide_fingerprint(x) for x in sets]
            more = [pa.array(np.array(same, np.uint64).view(np.int64)), pa.array([x for x, _ in prints], pa.binary()), pa.array([len(x) for x in sets], pa.int64()), pa.array([x for _, x in prints], pa.list_(pa.int64())), pa.array([x.astype(np.uint32).tobytes() for _, x in prints], pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, s, f, n, m, w])

    kinds = [T.StructField(s, T.LongType()), T.StructField(f, T.BinaryType()), T.StructField(n, T.LongType()), T.StructField(m, T.ArrayType(T.LongType())), T.StructField(w, T.BinaryType())]
    marked = save(docs.mapInArrow(run, T.StructType([*docs.schema.fields, *kinds])), "fingerprints")
    reps = save(marked.groupBy(F.col(s).alias("s")).agg(F.first(f).alias("f"), F.first(n).alias("n"), F.first(m).alias("m"), F.first(w).alias("w"), F.min("doc_id").alias("id")), "reps")
    roots = settle(lambda: components(similar_links(reps, marked.select(F.col(s).alias("s"), "text"), share, radius, block_rows, many)), "roots")
    named = reps.select("s", "id").join(roots.withColumnRenamed("node", "s"), "s", "left")
    kept = named.groupBy(F.coalesce("root", "s").alias("root")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "s")).alias("k")).select(F.col("k.s").alias(f"{mark}k"), F.col("k.id").alias(f"{mark}i"))
    first = Window.partitionBy(s).orderBy(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns]))
    return (
        marked.join(kept, F.col(s) == F.col(f"{mark}k")).where(F.col("doc_id").eqNullSafe(F.col(f"{mark}i")))  # by s alone, as the window
        .withColumn(f"{mark}r", F.row_number().over(first)).where(F.col(f"{mark}r") == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
