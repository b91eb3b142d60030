"""Streams that wait: sessions closed by event-time timers, and mates joined within a bound of time.

State is keyed and lives in Spark's RocksDB store, so it may outgrow memory; a
key holds the open sessions of its users (a BUCKETS-th of all), or the reads whose mate may still come.  What the
watermark has passed is emitted once and forgotten; rows that come behind the
watermark are left out and counted (``late_rows``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keys of the state of sessions, each with its part of the users: a call for each user and timer is what takes the time.
BUCKETS = 1_024


def merged(open_: list[tuple[int, int, int, float]], rows: list[tuple[int, float]], gap: int) -> list[tuple[int, int, int, float]]:
    """Sessions (start, end, n, total; microseconds) with the rows (time, value) added: what is less than ``gap`` apart is one session."""
    out: list[tuple[int, int, int, float]] = []
    for start, end, n, total in sorted(open_ + [(t, t, 1, v) for t, v in rows]):
        if out and start - out[-1][1] < gap:
            last = out.pop()
            start, end, n, total = last[0], max(last[1], end), last[2] + n, last[3] + total
        out.append((start, end, n, total))
    return out


class IdleSessions(StatefulProcessor):
    """Keeps the open sessions of a bucket of users; one timer stands at the time, or before it, at which the first of them can no longer grow.

    When it goes off, all sessions behind the watermark are closed at once and the next timer is set, so a bucket costs
    a call or two a batch, however many sessions it has open.  A timer whose session has grown since closes nothing.
    """

    def __init__(self, gap_seconds: int, kind: str = "long") -> None:
        self.gap, self.kind = gap_seconds * 1_000_000, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", f"user_id {self.kind}, start long, end long, n long, total double")

    def _due(self, session: tuple) -> int:
        return (session[2] + self.gap) // 1_000 + 1

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before, arrived, held = [tuple(x) for x in self.open.get()], defaultdict(list), defaultdict(list)
        for part in rows:
            for user, t, v in zip(part["user_id"].tolist(), part["micros"].tolist(), part["value"].fillna(0.0).tolist()):
                arrived[user].append((t, v))
        for user, *session in before:
            held[user].append(tuple(session))
        for user, own in arrived.items():
            held[user] = merged(held[user], own, self.gap)
        now = [(user, *s) for user, sessions in held.items() for s in sessions]
        first = min(map(self._due, now))
        if not before or first < min(map(self._due, before)):
            self.handle.registerTimer(first)
        self.open.put(now)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, held = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()), [tuple(x) for x in self.open.get()]
        closed, rest = [s for s in held if self._due(s) <= due], [s for s in held if self._due(s) > due]
        if rest:
            self.handle.registerTimer(min(map(self._due, rest)))
        if closed and rest:
            self.open.put(rest)
        elif closed:
            self.open.clear()
        if closed:
            yield pd.DataFrame(closed, columns=["user_id", "start", "end", "n", "total"])

    def close(self) -> None:
        pass


def closed_sessions(events: DataFrame, gap_seconds: int, late: str) -> DataFrame:
    """user_id, session_start, session_end (the last event), n and total of a stream of events(ts, user_id, value), a row when no event can join the session any more."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    held = events.where("ts is not null and user_id is not null").select("user_id", "ts", F.unix_micros("ts").alias("micros"), "value", F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).alias("bucket")).withWatermark("ts", late)
    kind = dict(events.dtypes)["user_id"]
    out = held.groupBy("bucket").transformWithStateInPandas(IdleSessions(gap_seconds, kind), f"user_id {kind}, start long, end long, n long, total double", "append", "eventTime")
    return out.select("user_id", F.timestamp_micros("start").alias("session_start"), F.timestamp_micros("end").alias("session_end"), "n", "total")


def mated(first: DataFrame, second: DataFrame, bound: str, late: str) -> DataFrame:
    """name, ts, other_ts: each row of a stream first(name, ts) with those of second(name, ts) of its name at most ``bound`` before or after it, or with null once none can come."""
    a = first.select("name", "ts").withWatermark("ts", late)
    b = second.select(F.col("name").alias("_name"), F.col("ts").alias("other_ts")).withWatermark("other_ts", late)
    near = (F.col("name") == F.col("_name")) & F.expr(f"other_ts >= ts - interval {bound}") & F.expr(f"other_ts <= ts + interval {bound}")
    return a.join(b, near, "left_outer").drop("_name")


def late_rows(query: StreamingQuery) -> int:
    """How many rows of a query came behind its watermark and were left out."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def arriving(spark: SparkSession, rows: DataFrame, chunk: F.Column, folder: str) -> Iterator[int]:
    """Write rows into a folder chunk by chunk, in the order of ``chunk`` (a few numbers), and give each number once its files are there."""
    marked = rows.withColumn("_chunk", chunk)
    for r in marked.select("_chunk").distinct().orderBy("_chunk").collect():
        marked.where(F.col("_chunk") == r["_chunk"]).drop("_chunk").write.mode("append").parquet(folder)
        yield r["_chunk"]
