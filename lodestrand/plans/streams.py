"""Streams with timers and joins in time over the events and line items, which arrive out of order, and the SQL of the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrand.operators.work import new_folder
from lodestrand.plans.registry import _t, query
from lodestrand.streaming import events as windows
from lodestrand.streaming import timed

GAP, DAYS, DISORDER = 6 * 3600, 8, 7_200
#: A row behind all others, for the watermark to pass them.
END = "timestamp'2200-01-01 00:00:00'"


@query(f"""WITH e AS (SELECT user_id, ts, coalesce(value, 0) AS value, CASE WHEN ts - lag(ts) OVER w < INTERVAL {GAP} SECOND THEN 0 ELSE 1 END AS new FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, nth""")
def timed_sessions(spark, d):
    """Events arrive in chunks, up to two hours late; sessions close by timers."""
    folder, path, state = new_folder(spark, "arriving"), new_folder(spark, "sessions"), new_folder(spark, "checkpoint")
    rows = _t(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "value", (F.col("event_id") * 7_919 % DISORDER).alias("_late"))
    # of the row at the end the session never closes
    end = spark.range(1).select(F.expr(END).alias("ts"), F.lit(-1).cast("long").alias("user_id"), F.lit(0.0).alias("value"), F.lit(0).cast("long").alias("_late"))
    chunk = F.floor((F.unix_seconds("ts") + F.col("_late")) / (DAYS * 86_400))
    rows = rows.unionByName(end)
    for _ in timed.arriving(spark, rows, chunk, folder):
        stream = timed.closed_sessions(windows.follow(spark, folder, "ts timestamp, user_id long, value double"), GAP, f"{DISORDER} seconds")
        windows.append(stream, path, state).awaitTermination()
    return spark.read.parquet(path).withColumn("total", F.round("total", 4))


@query("""WITH s AS (SELECT l_orderkey AS name, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 MINUTE * l_linenumber AS ts, l_linenumber % 2 AS side FROM lineitem),
a AS (SELECT * FROM s WHERE side = 1), b AS (SELECT * FROM s WHERE side = 0)
SELECT a.name, CAST(epoch(a.ts) AS BIGINT) AS at, coalesce(CAST(epoch(b.ts) AS BIGINT), -1) AS other FROM a LEFT JOIN b ON a.name = b.name AND b.ts BETWEEN a.ts - INTERVAL 10 DAY AND a.ts + INTERVAL 10 DAY""")
def mates_in_time(spark, d):
    """First and second lines of an order, shipped at most ten days apart, as two streams that arrive by months, up to twenty days late."""
    folder, path, state = new_folder(spark, "arriving"), new_folder(spark, "mates"), new_folder(spark, "checkpoint")
    ts = F.expr("cast(l_shipdate as timestamp) + make_interval(0, 0, 0, 0, 0, cast(l_linenumber as int))")
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("name"), ts.alias("ts"), (F.col("l_linenumber") % 2).cast("int").alias("side"), (F.col("l_partkey") % 20).alias("_late"))
    end = spark.range(2).select(F.lit(-1).cast("long").alias("name"), F.expr(END).alias("ts"), F.col("id").cast("int").alias("side"), F.lit(0).cast("long").alias("_late"))
    rows = rows.unionByName(end)
    for _ in timed.arriving(spark, rows, F.floor((F.unix_seconds("ts") / 86_400 + F.col("_late")) / 700), folder):
        seen = windows.follow(spark, folder, "name long, ts timestamp, side int")
        windows.append(timed.mated(seen.where("side = 1"), seen.where("side = 0"), "10 days", "20 days"), path, state).awaitTermination()
    return spark.read.parquet(path).where("name >= 0").select("name", F.unix_seconds("ts").alias("at"), F.coalesce(F.unix_seconds("other_ts"), F.lit(-1)).alias("other"))
