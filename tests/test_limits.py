"""Means of doubles on a limit: as SQL adds them, however the files are split."""

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

from lodestrand.plans import registry

DATA = "/root/testdata/sf0.1"


def test_means_on_a_limit_are_added_in_table_order(spark, tmp_path):
    """The supplier of sf0.1 whose discounts average the limit, in many small files."""
    rows = pq.read_table(f"{DATA}/lineitem.parquet", columns=["l_suppkey", "l_quantity", "l_discount"])
    rows = rows.filter(pc.is_in(rows.column("l_suppkey"), pa.array([77, 78, 80], pa.int64())))
    supplier = pq.read_table(f"{DATA}/supplier.parquet")
    for files in (1, 7, 40, 150):
        folder = tmp_path / str(files)
        (folder / "lineitem.parquet").mkdir(parents=True)
        size = -(-len(rows) // files)
        for i in range(files):
            pq.write_table(rows.slice(i * size, size), folder / "lineitem.parquet" / f"part-{i:05d}.parquet")
        pq.write_table(supplier, folder / "supplier.parquet")
        c = duckdb.connect(config={"threads": 1})
        c.execute(f"create view lineitem as select * from '{folder}/lineitem.parquet/*.parquet'")
        c.execute(f"create view supplier as select * from '{folder}/supplier.parquet'")
        want = sorted(c.execute(registry.oracle_sql()["covered_contigs"]).fetchall())
        spark.conf.set("spark.sql.files.openCostInBytes", "1000000000")  # a task for each file
        try:
            got = sorted(tuple(r) for r in registry.queries()["covered_contigs"](spark, str(folder)).collect())
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want
