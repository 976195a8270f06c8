import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rowset, ts
from eventide.functions.time import duration_us
from eventide.operators.topn import top_n
from eventide.operators.windows import window_count

SCHEMA = T.StructType([T.StructField("k", T.StringType()),
                       T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("v", T.LongType())])


def _brute(rows, size, slide):
    out = {}
    for k, sec, v in rows:
        us = round(sec * 1_000_000)
        last = us // slide
        first = (us - size) // slide + 1
        for s in range(first, last + 1):
            c, t = out.get((k, s), (0, 0))
            out[(k, s)] = (c + 1, t + v)
    return out


def _random_rows(seed, n, keys, span):
    r = random.Random(seed)
    return [(r.choice(keys), r.randrange(0, span * 1000) / 1000, r.randrange(-5, 10))
            for _ in range(n)]


def test_duration_parser():
    assert duration_us("1 hour") == 3_600_000_000
    assert duration_us("5 minutes") == 300_000_000
    assert duration_us("10 seconds") == 10_000_000
    assert duration_us("1 day 2 hours") == 93_600_000_000


def test_panes_equal_brute_force_and_direct(spark):
    rows = _random_rows(1, 400, ["a", "b", "c"], 3600)
    df = spark.createDataFrame([(k, ts(s), v) for k, s, v in rows], SCHEMA)
    for size, slide in [("10 minutes", "1 minute"), ("1 hour", "5 minutes"), ("60 seconds", "5 seconds")]:
        su, sl = duration_us(size), duration_us(slide)
        want = _brute(rows, su, sl)
        panes = window_count(df, "k", "ts", size, slide, method="panes")
        direct = window_count(df, "k", "ts", size, slide, method="direct")
        got = {(r["k"], r["window_start"]): r["count"] for r in panes.collect()}
        exp = {(k, ts(s * sl / 1e6)): c for (k, s), (c, _) in want.items()}
        assert got == exp
        assert rowset(panes) == rowset(direct)
        summed = window_count(df, "k", "ts", size, slide, value="v", name="total")
        got_sum = {(r["k"], r["window_start"]): r["total"] for r in summed.collect()}
        assert got_sum == {(k, ts(s * sl / 1e6)): t for (k, s), (_, t) in want.items()}


def test_global_window_and_bounds(spark):
    df = spark.createDataFrame([("x", ts(0), 1), ("x", ts(3599.999999), 1), ("x", ts(3600), 1)],
                               SCHEMA)
    out = window_count(df, [], "ts", "1 hour", "30 minutes")
    got = {(r["window_start"], r["window_end"]): r["count"] for r in out.collect()}
    assert got == {(ts(-1800), ts(1800)): 1, (ts(0), ts(3600)): 2,
                   (ts(1800), ts(5400)): 2, (ts(3600), ts(7200)): 1}
    assert dict(out.dtypes)["window_start"] == "timestamp_ntz"


def test_long_run_is_chunked(spark):
    # one row -> 720 windows; a dense key -> runs longer than a chunk
    rows = [("k", ts(i * 5), 1) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = window_count(df, "k", "ts", "1 hour", "5 seconds")
    assert out.count() == 3000 + 719
    assert out.agg(F.sum("count")).first()[0] == 3000 * 720


def test_top_n_ties_break_on_key(spark):
    df = spark.createDataFrame(
        [("w", "b", 5), ("w", "a", 5), ("w", "c", 7), ("w", "d", 1), ("v", "z", 1)],
        "window_end string, key string, count long")
    out = top_n(df, "key", 3)
    assert rowset(out, "window_end", "rank", "key") == [
        ("v", 1, "z"), ("w", 1, "c"), ("w", 2, "a"), ("w", 3, "b")]
