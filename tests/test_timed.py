"""Sessions closed by timers and mates joined in time, on shuffled input with late rows, against plain ones."""

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from lodestrand.streaming import events as windows
from lodestrand.streaming import timed

START = datetime(2024, 5, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def plain_sessions(rows, gap):
    out = []
    for user in {u for _, u, _ in rows}:
        own = sorted((t, v or 0.0) for t, u, v in rows if u == user)
        now = None
        for t, v in own:
            if now and t - now[1] < gap:
                now = [now[0], t, now[2] + 1, now[3] + v]
            else:
                if now:
                    out.append((user, *now))
                now = [t, t, 1, v]
        out.append((user, *now))
    return sorted((u, at(a), at(b), n, round(x, 6)) for u, a, b, n, x in out)


def run(spark, chunks, folder, make, tmp_path, schema):
    """Each chunk written and followed by one run of the stream; the late rows of all runs."""
    late = 0
    for i, rows in enumerate(chunks):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(folder)
        q = windows.append(make(windows.follow(spark, folder, schema)), str(tmp_path / "out"), str(tmp_path / "state"))
        q.awaitTermination()
        late += timed.late_rows(q)
    return late


def test_merged_sessions():
    assert timed.merged([(0, 10, 2, 1.0), (30, 30, 1, 1.0)], [(20, 5.0)], 11) == [(0, 30, 4, 7.0)]
    assert timed.merged([(0, 10, 2, 1.0)], [(21, 5.0), (5, 1.0)], 11) == [(0, 10, 3, 2.0), (21, 21, 1, 5.0)]
    assert timed.merged([], [], 5) == []


def test_sessions_by_timers(spark, tmp_path):
    rng, gap, delay = random.Random(4), 100, 300
    rows = [(rng.randrange(6_000), rng.randrange(7), rng.choice([None, 1.0, 2.5])) for _ in range(300)]
    arrive = sorted((t + rng.randrange(delay), (t, u, v)) for t, u, v in rows)
    chunks = [[r for a, r in arrive if a // 1_500 == k] for k in range(5)]
    chunks = [[(at(t), u, v) for t, u, v in c] for c in chunks]
    # rows far behind the watermark, of a known and of a new user; then one that closes all
    chunks[3] += [(at(1), 0, 9.0), (at(2), 99, 9.0)]
    chunks.append([(datetime(2100, 1, 1), -1, 0.0), (None, 1, 1.0), (at(5_000), None, 1.0)])
    late = run(spark, chunks, str(tmp_path / "in"), lambda s: timed.closed_sessions(s, gap, f"{delay} seconds"), tmp_path, "ts timestamp, user_id long, value double")
    got = sorted((r.user_id, r.session_start, r.session_end, r.n, round(r.total, 6)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert late == 2 and got == plain_sessions(rows, gap)


def test_mates_in_time(spark, tmp_path):
    rng, bound, delay = random.Random(6), 60, 200
    rows = [(rng.randrange(90), rng.randrange(4_000), rng.randrange(2)) for _ in range(300)]
    arrive = sorted((t + rng.randrange(delay), (n, t, s)) for n, t, s in rows)
    chunks = [[(n, at(t), s) for a, (n, t, s) in arrive if a // 1_000 == k] for k in range(5)]
    chunks[4] += [(rows[0][0], at(0), 1)]  # too late
    chunks.append([(-1, datetime(2100, 1, 1), 0), (-1, datetime(2100, 1, 1), 1)])

    def make(seen):
        return timed.mated(seen.where("side = 1"), seen.where("side = 0"), f"{bound} seconds", f"{delay} seconds")

    late = run(spark, chunks, str(tmp_path / "in"), make, tmp_path, "name long, ts timestamp, side int")
    key = lambda x: (x[0], x[1], x[2] or START)
    want = []
    for n, t, s in rows:
        if s == 1:
            near = [u for m, u, z in rows if z == 0 and m == n and abs(u - t) <= bound]
            want += [(n, at(t), at(u)) for u in near] or [(n, at(t), None)]
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).where(F.col("name") >= 0).collect()]
    assert late >= 1 and sorted(got, key=key) == sorted(want, key=key)


def test_one_timer_for_all_open_sessions():
    """Many sessions of many users in one bucket: one timer, one call that closes all behind the watermark, and the next timer."""

    class Handle:
        def __init__(self):
            self.timers, self.rows = [], []
            self.getListState = lambda name, schema: self
            self.get, self.put, self.clear = lambda: iter(self.rows), lambda rows: setattr(self, "rows", rows), lambda: setattr(self, "rows", [])
            self.registerTimer = self.timers.append

    class Times:
        getCurrentWatermarkInMs = staticmethod(lambda: 55_000)
        getExpiryTimeInMs = staticmethod(lambda: 11_001)

    handle, sessions = Handle(), timed.IdleSessions(10)
    sessions.init(handle)
    rows = pd.DataFrame([(u, t * 1_000_000, 1.0) for t in range(1, 100, 20) for u in (3, 4)], columns=["user_id", "micros", "value"])
    list(sessions.handleInputRows((0,), iter([rows]), Times))
    assert handle.timers == [11_001] and len(handle.rows) == 10
    (closed,) = sessions.handleExpiredTimer((0,), Times, Times)
    assert sorted(zip(closed.user_id, closed.start)) == [(u, t * 1_000_000) for u in (3, 4) for t in (1, 21, 41)]
    assert handle.timers == [11_001, 71_001] and len(handle.rows) == 4
