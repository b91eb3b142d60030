"""Tables written to the folder that the driver and all executors share.

Written tables cut lineage and outlive a lost executor; the folder is the one
the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a new local one only where none is set and driver and executors are one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Of each ``settle`` that is under way, the tables that were saved in it.
_made: list[list[str]] = []


def save(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df under the shared folder and return it as read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    if _made:
        _made[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def settle(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What make gives, saved; the tables that were saved to make it are deleted."""
    _made.append([])
    try:
        out = save(make(), name)
        *others, path = _made[-1]
    finally:
        _made.pop()
    for other in others:
        drop(out.sparkSession, other)
    if _made:
        _made[-1].append(path)
    return out


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table of this module once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``save`` made, once all that reads them is written itself."""
    for t in tables:
        drop(t.sparkSession, _paths.pop(t))
