"""Windows over event streams, for batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tumbling(events: DataFrame, size: str, late: str | None = None) -> DataFrame:
    """window_start, event_type, n and total of events(ts, event_type, value)."""
    held = events.withWatermark("ts", late) if late else events
    grouped = held.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str, step: str, late: str | None = None) -> DataFrame:
    """window_start, event_type, n and total of windows of ``size`` that begin every ``step``."""
    held = events.withWatermark("ts", late) if late else events
    grouped = held.groupBy(F.window("ts", size, step).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def first_seen(events: DataFrame, late: str) -> DataFrame:
    """One row for each (user_id, event_type, ts), whichever copy comes first; state is dropped behind the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["user_id", "event_type", "ts"])


def running_totals(events: DataFrame):
    """user_id, n and total so far of a stream of events(user_id, value), a row whenever a user's change; state is two numbers a user."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, parts, state):
        n, total = state.get if state.exists else (0, 0.0)
        for p in parts:
            n, total = n + len(p), total + float(p["value"].fillna(0).sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [total]})

    return events.select("user_id", "value").groupBy("user_id").applyInPandasWithState(step, "user_id long, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """user_id, session_start, session_end and n of events(ts, user_id)."""
    held = events.withWatermark("ts", late) if late else events
    grouped = held.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def follow(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parquet files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def append(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Write a stream as Parquet, exactly once; with ``once``, up to what is there now."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_each(stream: DataFrame, path: str, checkpoint: str):
    """Write each batch of a stream's updates as Parquet, in a folder of its number (a batch that is run again replaces its own), up to what is there now."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
