import random

from pyspark.sql import functions as F

from helpers import events, rowset, ts
from eventide.operators.sequence import failure_bursts, followed_by, repeat_match

# LoginLog rows of user 1035 plus neighbours, in file (arrival) order.
LOGIN = [
    (5402, 1558430815, 1, "success"), (23064, 1558430826, 2, "fail"),
    (5692, 1558430833, 3, "fail"), (7233, 1558430832, 4, "success"),
    (5692, 1558430840, 5, "success"), (29607, 1558430841, 6, "success"),
    (1035, 1558430842, 7, "fail"), (1035, 1558430844, 8, "fail"),
    (1035, 1558430843, 9, "fail"), (1035, 1558430843, 10, "fail"),
    (7328, 1558430848, 11, "success"), (29607, 1558430847, 12, "success"),
]


def _is_fail():
    return F.col("kind") == "fail"


def test_failure_burst_fixture(spark):
    df = events(spark, LOGIN)
    out = failure_bursts(df, "user_id", "ts", "seq", _is_fail(), 2, "5 seconds")
    assert rowset(out) == [(1035, ts(1558430842), ts(1558430844), 4)]


def test_consecutive_failures_fixture(spark):
    df = events(spark, LOGIN)
    out = repeat_match(df, "user_id", "ts", "seq", _is_fail(), (2, 4), "2 seconds")
    assert rowset(out, "user_id", "begin_ts", "next_ts") == [
        (1035, ts(1558430842), ts(1558430843)), (1035, ts(1558430843), ts(1558430843))]


def _fold_bursts(rows, span, min_fails):
    """Reference state machine, one key at a time, in (ts, seq) order."""
    out = []
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    for k, evs in by_key.items():
        a = last = None
        n = 0
        for _, t, _, kind in evs:
            if a is not None and t > a + span:
                if n >= min_fails:
                    out.append((k, ts(a), ts(last), n))
                a = None
            if kind == "fail":
                if a is None:
                    a, n = t, 0
                last, n = t, n + 1
            else:
                a = None
        if a is not None and n >= min_fails:
            out.append((k, ts(a), ts(last), n))
    return sorted(out)


def test_failure_bursts_match_fold_on_long_chains(spark):
    r = random.Random(7)
    rows, seq = [], 0
    for key in range(4):
        t = 0
        for _ in range(600):
            t += r.choice([1, 1, 2, 3, 4, 9])
            seq += 1
            kind = "fail" if key == 0 or r.random() < 0.85 else "success"
            rows.append((key, t, seq, kind))
    df = events(spark, rows)
    # a tiny bucket forces many halo copies and long pointer chains
    out = failure_bursts(df, "user_id", "ts", "seq", _is_fail(), 2, "5 seconds",
                         bucket="10 seconds")
    assert rowset(out) == _fold_bursts(rows, 5, 2)


def test_repeat_match_brute_force(spark):
    r = random.Random(3)
    rows, seq = [], 0
    for key in range(3):
        t = 0
        for _ in range(300):
            t += r.choice([3, 5, 9, 15, 20, 30])          # tenths of a second
            seq += 1
            rows.append((key, t, seq, "fail" if r.random() < 0.7 else "success"))
    df = events(spark, [(k, t / 10, q, kind) for k, t, q, kind in rows])
    out = repeat_match(df, "user_id", "ts", "seq", _is_fail(), (2, 4), "2 seconds",
                       bucket="5 seconds")
    want = []
    by_key = {}
    for row in sorted(rows, key=lambda x: (x[0], x[1], x[2])):
        by_key.setdefault(row[0], []).append(row)
    for k, evs in by_key.items():
        for i, (_, t, _, kind) in enumerate(evs):
            if kind != "fail" or i + 1 >= len(evs) or evs[i + 1][3] != "fail":
                continue
            fails = [e for e in evs[i + 1:] if e[3] == "fail"]
            for kk in range(2, 5):
                if len(fails) >= kk and fails[kk - 1][1] - t < 20:
                    want.append((k, ts(t / 10), ts(fails[0][1] / 10), kk))
    assert rowset(out) == sorted(want)


ORDERS = [
    (34729, 1558430842, 1, "create"), (34729, 1558430844, 3, "pay"),
    (34747, 1558430893, 27, "create"), (34747, 1558430893, 34, "pay"),
    (34756, 1558430913, 47, "create"), (34756, 1558431951, 78, "pay"),
    (34768, 1558430950, 67, "pay"),
    (1, 1000, 100, "create"), (1, 1900, 101, "pay"),        # exactly 15 min: timeout
    (2, 1000, 102, "create"), (2, 1100, 103, "create"), (2, 1200, 104, "pay"),
    (3, 1000, 106, "pay"), (3, 1000, 105, "create"),        # equal ts, pay arrives later
]


def test_followed_by_boundaries(spark):
    df = events(spark, ORDERS)
    out = followed_by(df, "user_id", "ts", "seq", F.col("kind") == "create",
                      F.col("kind") == "pay", "15 minutes")
    got = {(r["user_id"], r["begin_seq"]): r["status"] for r in out.collect()}
    assert got == {(34729, 1): "success", (34747, 27): "success", (34756, 47): "timeout",
                   (1, 100): "timeout", (2, 102): "success", (2, 103): "success",
                   (3, 105): "success"}
