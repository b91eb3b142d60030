"""Taxonomy: closure, lookups, common ancestors, reports.

Trees are tables nodes(tid, parent, rank, name); the root is its own parent.
Ancestor closures are small (nodes times depth) and joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.functions.seq import lowest_rank_code
from lodestrand.operators.work import keep, settled


def closure(nodes: DataFrame) -> DataFrame:
    """tid, ancestor, distance (0: itself), ancestor's rank, name and depth from the root; by doubling joins until no node has an ancestor further up, each written, as reports use the closure many times.

    A tree has a root, its own parent; a circle of parents is an error.
    """
    return settled(lambda: _closed(nodes), "tree")


def _closed(nodes: DataFrame) -> DataFrame:
    up = nodes.where("tid <> parent").select("tid", F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    reach, span = up, 1
    while True:
        # pairs up to 2 * span apart, from pairs up to span apart
        far = reach.alias("a").join(reach.where(F.col("distance") == span).alias("b"), F.col("a.tid") == F.col("b.ancestor"))
        far = keep(far.select("b.tid", "a.ancestor", (F.col("a.distance") + span).alias("distance")), "ancestors")
        found = far.agg(F.count("*").alias("n"), F.max((F.col("tid") == F.col("ancestor")).cast("int")).alias("circle")).first()
        if found.circle:
            raise ValueError("the parents of some nodes form a circle")
        if not found.n:
            break
        reach, span = reach.unionByName(far), span * 2
    own = nodes.select("tid", F.col("tid").alias("ancestor"), F.lit(0).alias("distance"))
    every = own.unionByName(reach)
    depth = every.groupBy(F.col("tid").alias("ancestor")).agg(F.max("distance").cast("int").alias("depth"))
    info = nodes.select(F.col("tid").alias("ancestor"), "rank", "name")
    return every.join(info, "ancestor").join(depth, "ancestor").select("tid", "ancestor", "distance", "rank", "name", "depth")


def at_rank(tree: DataFrame, rank: str) -> DataFrame:
    """tid and the nearest ancestor of that rank (``to``)."""
    near = Window.partitionBy("tid").orderBy("distance")
    return tree.where(F.col("rank") == rank).withColumn("_n", F.row_number().over(near)).where("_n = 1").select("tid", F.col("ancestor").alias("to"))


def lineage(tree: DataFrame) -> DataFrame:
    """tid and ``rank|name`` joined by ``;`` from the node to the root."""
    step = F.struct(F.col("distance"), F.concat_ws("|", "rank", "name").alias("s"))
    return tree.groupBy("tid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(step)), lambda x: x.s), ";").alias("lineage"))


def lookup(hits: DataFrame, acc_to_tid: DataFrame, tree: DataFrame, rank: str = "species") -> DataFrame:
    """read, tid, score: the best score of each read and taxon of hits(read, acc, score); accessions without a taxon go, a taxon without an ancestor of the rank becomes 1."""
    found = hits.join(acc_to_tid, "acc").join(at_rank(tree, rank), "tid", "left")
    return found.groupBy("read", F.coalesce("to", F.lit(1)).cast("long").alias("tid")).agg(F.greatest(F.max("score"), F.lit(0.0)).alias("score"))


def paths(tree: DataFrame) -> DataFrame:
    """tid and ``path``: its ancestors from the root down to itself."""
    return tree.groupBy("tid").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "ancestor"))), lambda x: x.ancestor).alias("path"))


def common_ancestor(sets: DataFrame, tree: DataFrame, *more: Column) -> DataFrame:
    """read and lca of sets(read, tid, …): the deepest node above all taxa of the read (itself for one); reads with taxa of different roots, or out of the tree, have none.  ``more``: other aggregates of a read's rows, by name.

    What the least and the greatest path of a read have in common, all of its paths have; so each hit moves once, whatever its depth.
    """
    ends = sets.join(paths(tree), "tid", "left").groupBy("read").agg(F.min("path").alias("a"), F.max("path").alias("b"), F.count("*").alias("_n"), F.count("path").alias("_in"), *more)
    others = [c for c in ends.columns if c not in ("read", "a", "b", "_n", "_in")]
    differ = F.array_position(F.zip_with("a", "b", lambda x, y: x == y), F.lit(False))
    shared = F.when(differ == 0, F.least(F.size("a"), F.size("b"))).otherwise(differ - 1).cast("int")
    return ends.where("_n = _in").withColumn("_shared", shared).where("_shared > 0").select("read", F.element_at("a", F.col("_shared")).cast("long").alias("lca"), *others)


def report(lcas: DataFrame, tree: DataFrame, total: int | F.Column) -> DataFrame:
    """tid, name, code, depth, clade, stay and percent of every node with a read at or under it."""
    stay = lcas.groupBy(F.col("lca").alias("tid")).agg(F.count("*").alias("n"))
    clade = stay.join(tree, "tid").groupBy(F.col("ancestor").alias("tid"), "rank", "name", "depth").agg(F.sum("n").alias("clade"), F.sum(F.when(F.col("distance") == 0, F.col("n")).otherwise(0)).alias("stay"))
    total = F.lit(total) if isinstance(total, int) else total
    return clade.select(F.col("tid").cast("long").alias("tid"), F.replace(F.col("name"), F.lit("'"), F.lit("")).alias("name"), lowest_rank_code(F.col("rank")).alias("code"), F.col("depth").cast("int").alias("depth"), "clade", "stay", F.round(F.col("clade") * 100.0 / total, 2).alias("percent"))


def report_lines(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """Lines of a report in tree order, greater clades first."""
    order = tree.join(rows.select(F.col("tid").alias("ancestor"), "clade"), "ancestor").groupBy("tid").agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("depth"), (-F.col("clade")).alias("c"), F.col("ancestor")))), lambda x: F.struct(x.c, x.ancestor)).alias("path"))
    line = F.format_string("%6.2f\t%d\t%d\t%s\t%d\t%s%s", "percent", "clade", "stay", "code", "tid", F.repeat(F.lit("  "), F.col("depth")), "name")
    return rows.join(order, "tid").orderBy("path").select(line.alias("line"))


#: Rows of hits that meet in a task.
TASK_ROWS = 500_000
MAIN_RANKS = ("species", "genus", "family", "superkingdom")


def main_lineage(tree: DataFrame) -> DataFrame:
    """tid and its uppermost ancestors of the MAIN_RANKS, null where there is none."""
    at = lambda r: F.max(F.when(F.col("rank") == r, F.struct("distance", "ancestor")))["ancestor"].alias(r)
    return tree.groupBy("tid").agg(*map(at, MAIN_RANKS))


def count_table(hits: DataFrame, tree: DataFrame) -> DataFrame:
    """rank, tid, uniq and multi: reads whose taxa at that rank are that one alone, and reads with others too.

    Hits without a species do not count; one without a genus or family has an unnamed one of its own there, so that a read with it and another taxon is not unique.
    """
    # taxa as numbers: four times the taxon, plus what an unnamed one is unnamed after (1: a genus, 2: a species, 3: all)
    number = lambda c, mark: F.col(c) * 4 + mark
    genus = F.coalesce(number("genus", 0), number("species", 2))
    values = (number("species", 0), genus, F.coalesce(number("family", 0), number("genus", 1), number("species", 2)), F.coalesce(number("superkingdom", 0), F.lit(3).cast("long")))
    lineage = main_lineage(tree).where("species is not null").select("tid", *[v.alias(r) for r, v in zip(MAIN_RANKS, values)])
    lines = keep(hits.select("read", "tid").join(lineage, "tid").select("read", *MAIN_RANKS), "lines")
    # all ranks of a read's hits meet once, of so many rows in a task whatever their number
    met = lines.repartition(lines.count() // TASK_ROWS + 1, "read").groupBy("read").agg(*[F.collect_set(r).alias(r) for r in MAIN_RANKS])
    told = lambda r: F.transform(r, lambda x: F.struct(F.lit(r).alias("rank"), x.alias("to"), (F.size(r) == 1).alias("alone")))
    each = met.select(F.inline(F.flatten(F.array(*map(told, MAIN_RANKS)))))
    one = lambda c: F.sum(c.cast("long"))
    return each.where("`to` % 4 = 0").groupBy("rank", F.expr("`to` div 4").alias("tid")).agg(one(F.col("alone")).alias("uniq"), one(~F.col("alone")).alias("multi"))


def named_count_table(counts: DataFrame, tree: DataFrame) -> DataFrame:
    """count_table's rows with the names of each taxon's lineage (``-`` where it has none), as printed."""
    names = tree.where("distance = 0").select(F.col("tid").alias("_t"), F.col("name").alias("_name"))
    out = counts.join(main_lineage(tree), "tid")
    for r in reversed(MAIN_RANKS):
        out = out.join(names, F.col(r) == F.col("_t"), "left").withColumn(r, F.coalesce("_name", F.lit("-"))).drop("_t", "_name")
    return out.select("rank", *reversed(MAIN_RANKS), "tid", "uniq", "multi")


def labels(hits: DataFrame, tree: DataFrame) -> DataFrame:
    """read and label: the lineages (rank|name from the species up) of its species, in order of their ids, joined by ``;``; hits without a species are left out."""
    found = hits.select("read", "tid").distinct().join(at_rank(tree, "species"), "tid").select("read", F.col("to").alias("tid")).distinct()
    upward = tree.groupBy("tid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("distance", F.concat_ws("|", "rank", "name").alias("s")))), lambda x: x.s), ",").alias("line"))
    return found.join(upward, "tid").groupBy("read").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tid", "line"))), lambda x: x.line), ";").alias("label"))


def under(tree: DataFrame, names: list[str]) -> DataFrame:
    """tids at or under the named taxa."""
    return tree.where(F.col("name").isin(*names)).select("tid").distinct()


def filter_by_taxa(rows: DataFrame, tree: DataFrame, names: list[str], include: bool = True) -> DataFrame:
    return rows.join(under(tree, names), "tid", "left_semi" if include else "left_anti")


def within_one(hits: DataFrame, tree: DataFrame, rank: str = "family") -> DataFrame:
    """Reads of hits(read, tid) whose taxa share one ancestor of the rank (taxa without one count as themselves)."""
    to = hits.join(at_rank(tree, rank), "tid", "left").select("read", F.coalesce("to", "tid").alias("to"))
    return to.groupBy("read").agg(F.count_distinct("to").alias("n")).where("n <= 1").select("read")


def reassign(hits: DataFrame, times: float = 20, share: float = 0.05, least: float = 40) -> DataFrame:
    """hits(read, tid, score) without those that another taxon of the read explains.

    Over hits of score ``least`` or more: taxon a weakly explains b if its
    unique reads exceed ``times`` those of b, and its reads without b exceed
    ``share`` of its reads; a explains b if nothing weakly explains a.
    """
    # many reads have the same set of taxa; pairs are made of each set once, with its number of reads
    sets = hits.where(F.col("score") >= least).groupBy("read").agg(F.array_sort(F.collect_set("tid")).alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    sets = keep(sets, "sets")
    counts = sets.select("n", (F.size("s") == 1).alias("_one"), F.explode("s").alias("tid")).groupBy("tid").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_one"), F.col("n")).otherwise(0)).alias("u"))
    pairs = sets.where(F.size("s") > 1).select("n", "s", F.explode("s").alias("a")).select("n", "a", F.explode("s").alias("b")).where("a <> b")
    inter = pairs.groupBy("a", "b").agg(F.sum("n").alias("both"))
    a, b = counts.select(F.col("tid").alias("a"), F.col("n").alias("na"), F.col("u").alias("ua")), counts.select(F.col("tid").alias("b"), F.col("u").alias("ub"))
    weak = inter.join(a, "a").join(b, "b").where((F.col("ua") > times * F.col("ub")) & (F.col("na") - F.col("both") > share * F.col("na"))).select("a", "b")
    explains = weak.join(weak.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    lost = hits.select("read", F.col("tid").alias("a")).join(explains, "a").select("read", F.col("b").alias("tid")).distinct()
    return hits.join(lost, ["read", "tid"], "left_anti")


def cleanup(hits: DataFrame, contaminants: DataFrame, top: float = 0.94, share: float = 0.95) -> DataFrame:
    """hits(read, tid, score), scores over 0, after taking contaminants(tid) into account.

    A contaminant explains a clean taxon if, of all reads with the taxon, over ``share`` have a hit of that contaminant that scores
    ``top`` of the taxon's score or more.  Of a read with such a hit of an explained taxon only the contaminants that explain it stay;
    of other reads contaminant hits go where a clean hit is left.
    """
    dirty = hits.join(F.broadcast(contaminants.select("tid").distinct().withColumn("_dirty", F.lit(True))), "tid", "left").withColumn("_dirty", F.coalesce("_dirty", F.lit(False)))  # a short list of taxa
    beside = dirty.where("_dirty").select("read", F.col("tid").alias("by"), F.col("score").alias("by_score"))
    pairs = dirty.where("not _dirty").join(beside, "read").where(F.col("score") * top <= F.col("by_score"))
    counts = hits.groupBy("tid").agg(F.count("*").alias("_n"))
    explained = pairs.groupBy("tid", "by").agg(F.count("*").alias("_both")).join(counts, "tid").where(F.col("_both") > share * F.col("_n")).select("tid", "by")
    instead = pairs.join(explained, ["tid", "by"]).select("read", F.col("by").alias("tid"), F.col("by_score").alias("score")).distinct()
    others = dirty.join(instead.select("read").distinct(), "read", "left_anti").withColumn("_clean", F.max((~F.col("_dirty")).cast("int")).over(Window.partitionBy("read")))
    return others.where("not _dirty or _clean = 0").select("read", "tid", "score").unionByName(instead.select("read", "tid", "score"))


def split_by_rank(hits: DataFrame, tree: DataFrame, rank: str, unknown: str = "unknown") -> DataFrame:
    """hits(…, tid) with ``file``: the name of the taxon's ancestor at the rank, to write by."""
    names = at_rank(tree, rank).join(tree.where("distance = 0").select(F.col("tid").alias("to"), "name"), "to").select("tid", F.col("name").alias("file"))
    return hits.join(names, "tid", "left").withColumn("file", F.coalesce("file", F.lit(unknown)))


def gathered(counts: DataFrame, tree: DataFrame, least: int) -> DataFrame:
    """tid and n: counts(tid, n) summed up the tree, each taxon's under its nearest ancestor (itself included) that has ``least`` or more in all; taxa without one go to the root."""
    sums = counts.join(tree, "tid").groupBy("ancestor").agg(F.sum("n").alias("_sum"))
    near = counts.join(tree, "tid").join(sums, "ancestor").where((F.col("_sum") >= least) | (F.col("depth") == 0))
    to = near.groupBy("tid", "n").agg(F.min_by("ancestor", "distance").alias("to"))
    return to.groupBy(F.col("to").cast("long").alias("tid")).agg(F.sum("n").alias("n"))


def taxon_accuracy(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """tid, n_true, n_found, n_right, sensitivity and false_discovery: truth(read, tid) against the reads of predicted(read, tid) that hit one taxon only."""
    alone = predicted.groupBy("read").agg(F.min("tid").alias("found"), F.max("tid").alias("_last")).where("found = _last").drop("_last")
    pairs = truth.select("read", F.col("tid").alias("true")).join(alone, "read", "full_outer")
    # a read counts for its true taxon and for the one found, in one pass
    marks = F.array(F.struct(F.col("true").alias("tid"), F.lit(1).alias("t"), F.lit(0).alias("f"), F.coalesce(F.col("true") == F.col("found"), F.lit(False)).cast("int").alias("r")), F.struct(F.col("found").alias("tid"), F.lit(0).alias("t"), F.lit(1).alias("f"), F.lit(0).alias("r")))
    n = pairs.select(F.inline(marks)).where("tid is not null").groupBy("tid").agg(F.sum("t").alias("n_true"), F.sum("f").alias("n_found"), F.sum("r").alias("n_right"))
    share = lambda a, b: F.round(F.when(F.col(b) > 0, a / F.col(b)), 9)
    return n.withColumn("sensitivity", share(F.col("n_right"), "n_true")).withColumn("false_discovery", share(F.col("n_found") - F.col("n_right"), "n_found"))


def accuracy(truth: DataFrame, predicted: DataFrame, tree: DataFrame, ranks: tuple[str, ...] = ("species", "genus", "family")) -> DataFrame:
    """rank, correct, wrong and unspecific reads: truth(read, tid) against the common ancestors of predicted(read, tid), over truths that have the rank.

    A prediction of another or no taxon at the rank is unspecific if it lies above the truth (or is it), else wrong.
    """
    found = common_ancestor(predicted, tree).join(truth.select("read", F.col("tid").alias("true")), "read")
    above = tree.select(F.col("tid").alias("true"), F.col("ancestor").alias("lca"), F.lit(True).alias("_above"))
    found = found.join(above, ["true", "lca"], "left")
    out = None
    for rank in ranks:
        to = at_rank(tree, rank)
        mine = to.select(F.col("tid").alias("lca"), F.col("to").alias("p"))
        right = to.select(F.col("tid").alias("true"), F.col("to").alias("t"))
        rows = found.join(mine, "lca", "left").join(right, "true").withColumn("_same", F.col("p").eqNullSafe(F.col("t")))
        tests = (("correct", F.col("_same")), ("wrong", ~F.col("_same") & F.col("_above").isNull()), ("unspecific", ~F.col("_same") & F.col("_above").isNotNull()))
        one = rows.agg(F.lit(rank).alias("rank"), *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in tests])
        out = one if out is None else out.unionByName(one)
    return out


def simplified(nodes: DataFrame, tree: DataFrame, ranks: tuple[str, ...]) -> DataFrame:
    """nodes(tid, parent, rank, name) of the named ranks and the root alone, each under its nearest such ancestor."""
    kept = nodes.where(F.col("rank").isin(*ranks) | (F.col("tid") == F.col("parent")))
    near = tree.where("distance > 0").join(kept.select(F.col("tid").alias("ancestor")), "ancestor").groupBy("tid").agg(F.min_by("ancestor", "distance").alias("_up"))
    return kept.join(near, "tid", "left").select("tid", F.coalesce("_up", "tid").alias("parent"), "rank", "name")


def in_tree_order(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """rows(tid, …) with ``path``: the names from the root down to its taxon, by which related taxa lie together when written in its order."""
    path = tree.groupBy("tid").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "name"))), lambda x: x["name"]).alias("path"))
    return rows.join(path, "tid", "left")
