"""Intermediate tables in the folder that the driver and all executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Of each ``settled`` that is under way, the tables kept in it.
_made: list[list[DataFrame]] = []


#: Rows that meet in a task, whatever their number in all.
TASK_ROWS = 250_000


def tasks(rows: int | None) -> int:
    """In how many tasks so many rows meet."""
    return (rows or 0) // TASK_ROWS + 1


def keep(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: computed once however often it is used, and not lost with an executor."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    if _made:
        _made[-1].append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``keep`` made, once all that reads them is written itself; other tables are left alone."""
    for t in tables:
        if (path := _paths.pop(t, None)) is not None:
            where = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What make gives, kept; the tables kept on the way to it are deleted, also where it fails."""
    _made.append([])
    try:
        made = make()
        own = list(_made[-1])
        out = keep(made, name)
    except BaseException:
        own, out = list(_made[-1]), None
        raise
    finally:
        _made.pop()
        discard(*own)
    if _made:
        _made[-1].append(out)
    return out


def once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path; it is made and written there unless a run before has finished it (its ``_SUCCESS`` mark is there)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
