"""State of the ordered processors, bucket numbers, ranked windows and the state store's settings."""

import random
from collections import Counter

import pandas as pd

from eventide.streaming import jobs as SJ
from eventide.streaming.ordered import OneToOneProcessor
from eventide.streaming.processors import SlidingTopProcessor


class State:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    """Stands in for Spark's handle: one value and the timers."""

    def __init__(self):
        self.state, self.timers = State(), set()

    def getValueState(self, name, schema):
        return self.state

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_waiting_rows_are_one_binary_value():
    labels = {k: k for k in ("matched", "unmatched_left", "unmatched_right", "superseded_left", "superseded_right")}
    p, handle = OneToOneProcessor(10_000_000, "tx", "string", "p", "r", labels), Handle()
    p.init(handle)
    rows = pd.DataFrame({"tx": ["a", "b", "a"], "ev_us": [1_000_000, 2_000_000, 3_000_000], "ev_seq": [0, 0, 0],
                         "side": [0, 0, 1]})
    assert list(p.handleInputRows((1,), iter([rows]), Clock(0))) == []
    assert [type(x) for x in handle.state.value] == [bytes, int]
    out = pd.concat(list(p.handleExpiredTimer((1,), Clock(20_000), None)))
    assert sorted(zip(out["tx"], out["status"])) == [("a", "matched"), ("b", "unmatched_left")]
    assert handle.state.value is None


def test_buckets_grow_with_the_tables(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(500).write.parquet(str(tmp_path / "b.parquet"))
    assert SJ.buckets_for(spark, str(tmp_path), "a", "b") == SJ.BUCKETS
    monkeypatch.setattr(SJ, "BUCKET_ROWS", 10)
    assert SJ.buckets_for(spark, str(tmp_path), "a", "b") == 150


def test_windows_are_ranked_before_they_leave_the_task(monkeypatch):
    rng, n, top, chunk = random.Random(3), 4, 2, 10
    panes = Counter((rng.choice("abcde"), rng.randrange(0, 60)) for _ in range(150))
    monkeypatch.setattr(SlidingTopProcessor, "CELLS", 30)
    got = []
    for c in range(-1, 7):
        mine = sorted((k, p, m) for (k, p), m in panes.items() if c * chunk <= p <= c * chunk + chunk - 1 + n - 1)
        if not mine:
            continue
        proc, handle = SlidingTopProcessor(n * 1_000_000, 1_000_000, "url", top, "views", chunk), Handle()
        proc.init(handle)
        for wm in (0, 23_000, 37_500, 90_000):      # rows come once the watermark has passed their pane
            part = [(k, p, m) for k, p, m in mine if p + 1 <= wm / 1000]
            mine = [x for x in mine if x not in part]
            frames = [pd.DataFrame({"url": [k], "ev_us": [p * 1_000_000], "cnt": [m]}) for k, p, m in part]
            got += (proc.handleInputRows((c, 0), iter(frames), Clock(wm)) if part
                    else proc.handleExpiredTimer((c, 0), Clock(wm), None))
        assert handle.state.value is None and not handle.timers
    want = []
    for s in range(-n + 1, 60):
        counts = Counter()
        for (k, p), m in panes.items():
            counts[k] += m if s <= p < s + n else 0
        want += [(s, k, m) for k, m in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:top] if m]
    out = pd.concat(got)
    found = zip((out["window_start"] - pd.Timestamp(0)).dt.total_seconds().astype(int), out["url"], out["views"])
    assert sorted(found) == sorted(want)


def test_state_rows_are_not_counted(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(key, None)
    with SJ.rocksdb_state(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key, None) == before
