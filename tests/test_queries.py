"""Every query with SQL against DuckDB on the smallest tables on which it has rows."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from lodestrand.plans import registry

DATA, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Queries without a row on the smallest tables.
SPARSE = {"coverage_spikes", "shared_lines"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].map(lambda v: isinstance(v, (list, np.ndarray))).any():
            df[c] = df[c].map(lambda v: str([str(x) for x in v]))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    folder = LARGER if name in SPARSE else DATA
    ours = ordered(registry.queries()[name](spark, folder).toPandas())
    theirs = ordered(duck(folder).sql(registry.oracle_sql()[name]).df())
    assert len(ours)
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-9)
