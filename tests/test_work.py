"""Tables on the way to others are deleted with them."""

import os

import pytest

from lodestrand.operators import depths, work


def folders(spark):
    where = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return {f for f in os.listdir(where)}


def test_settled_and_discard(spark):
    before = folders(spark)
    rows = spark.range(5)

    def make():
        first = work.keep(rows, "first")
        return work.keep(first.where("id > 1"), "second").where("id > 2")

    out = work.settled(make, "out")
    assert sorted(r.id for r in out.collect()) == [3, 4] and len(folders(spark) - before) == 1
    nested = work.settled(lambda: work.settled(make, "inner").where("id > 3"), "outer")
    assert [r.id for r in nested.collect()] == [4] and len(folders(spark) - before) == 2
    work.discard(out, nested, rows)
    assert folders(spark) == before
    with pytest.raises(ZeroDivisionError):
        work.settled(lambda: work.keep(rows, "lost") and 1 / 0, "none")
    assert folders(spark) == before


def test_components_leave_one_table(spark):
    before = folders(spark)
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51)], "a long, b long")
    got = {r.node: r.root for r in depths.components(edges).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 51: 50} and len(folders(spark) - before) == 1
