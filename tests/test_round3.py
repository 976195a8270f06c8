import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rowset, ts
from test_streaming import EVENTS
from eventide.operators.ratelimit import rate_limit
from eventide.operators.reconcile import reconcile_one_to_one, window_join
from eventide.operators.sequence import failure_bursts
from eventide.operators.windows import window_count
from eventide.plans import bindings as B
from eventide.streaming import jobs as SJ

BASE = 1_700_000_000


# sliding counts and sums by blocks

@pytest.mark.parametrize("keys", [["k"], [], ["k", "j"]])
def test_block_sums_equal_direct_windows(spark, keys):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.randrange(2), ts(BASE + r.randrange(90_000)), r.choice([None, 1, 5, -7]))
            for _ in range(400)]
    rows += [("far", 1, ts(BASE - 40_000_000), 2), ("a", 1, ts(-5), None)]
    df = spark.createDataFrame(rows, "k string, j int, t timestamp_ntz, v int")
    df = df.withColumn("d", F.col("v").cast("decimal(9,2)") / 4)
    for value in (None, "v", "d"):
        args = (df, keys, "t", "10 minutes", "5 seconds")
        got = window_count(*args, value=value, name="x")
        want = window_count(*args, value=value, name="x", method="direct")
        assert got.exceptAll(want.select(got.columns)).count() == 0
        assert want.select(got.columns).exceptAll(got).count() == 0


def test_sums_of_doubles_with_nan_and_null(spark):
    rows = [("a", ts(BASE), float("nan")), ("a", ts(BASE + 400), 2.0), ("a", ts(BASE + 900), 0.1), ("b", ts(BASE), None),
            ("a", ts(BASE + 901), 0.2), ("b", ts(BASE + 600), float("inf")), ("b", ts(BASE + 1300), 3.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    got, want = (sorted(map(str, window_count(df, "k", "t", "10 minutes", "5 minutes", value="v", name="x", method=m)
                              .withColumn("x", F.round("x", 9)).collect())) for m in ("panes", "direct"))
    assert got == want


def test_no_single_partition_for_the_keyless_count(spark):
    df = spark.createDataFrame([(ts(BASE),)], "t timestamp_ntz")
    plan = window_count(df, None, "t", "1 hour", "5 seconds")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "RoundRobin" not in plan


# rows out of order inside the delay, over several files

def write_arrivals(spark, root, name, rows, schema, files):
    per = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * per:(i + 1) * per], schema).coalesce(1).write.mode("append").parquet(
            f"{root}/{name}.parquet")


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Events that arrive up to 30 s late, and one far later event that closes everything."""
    root, r, t, rows = str(tmp_path_factory.mktemp("late")), random.Random(31), BASE, []
    for e in range(700):
        t += r.choice([0, 1, 2, 3, 8, 40])
        rows.append((e, t, r.randrange(6), r.choice(["error", "error", "error", "view", "click"])))
    rows.sort(key=lambda x: (x[1] + r.uniform(0, 29), x[0]))
    rows.append((9999, t + 10 * 86_400, 77, "view"))
    write_arrivals(spark, root, "events", [(e, ts(s), u, k, 1.0, json.dumps({"k": 1})) for e, s, u, k in rows], EVENTS, 7)
    return root


def stream_of(spark, root):
    return B.behavior_view(SJ.stream_table(spark, root, "events", max_files_per_trigger=1))


def test_bursts_of_shuffled_rows_equal_batch(spark, shuffled):
    got = SJ.run_to_files(SJ.failure_bursts_stream(stream_of(spark, shuffled), "10 seconds", 2, "30 seconds", buckets=3), "r3b")
    ev = B.behavior_events(spark, shuffled)
    want = failure_bursts(ev, "user_id", "ts", "seq", F.col("behavior") == "error", min_fails=2, span="10 seconds")
    assert rowset(got, "user_id", "start_ts", "end_ts", "fails") == rowset(want, "user_id", "start_ts", "end_ts", "fails")
    assert got.count() > 20


def test_burst_cases_of_rows_out_of_order(spark, tmp_path):
    """A failure that arrives after a later one, and a success older than two failures."""
    rows = [(1, 10, 1, "error"), (2, 8, 1, "error"), (3, 110, 2, "error"), (4, 111, 2, "error"), (5, 108, 2, "click"),
            (6, 90_000, 9, "view")]
    write_arrivals(spark, str(tmp_path), "events",
                   [(e, ts(BASE + s), u, k, 1.0, "{}") for e, s, u, k in rows], EVENTS, 6)
    got = SJ.run_to_files(SJ.failure_bursts_stream(stream_of(spark, str(tmp_path)), "5 seconds", 2, "5 seconds"), "r3c")
    assert rowset(got) == [(1, ts(BASE + 8), ts(BASE + 10), 2), (2, ts(BASE + 110), ts(BASE + 111), 2)]


def test_cap_of_shuffled_rows_equals_batch(spark, shuffled):
    got = SJ.run_to_files(SJ.rate_limit_stream(stream_of(spark, shuffled), 5, delay="30 seconds", buckets=3), "r3r")
    passed, black = rate_limit(B.behavior_events(spark, shuffled), ["user_id", "behavior"], "ts", "seq", cap=5)
    own = lambda tag: rowset(got.filter((F.col("tag") == tag) & (F.col("user_id") < 77)), "user_id", "behavior", "ts")
    assert own("pass") == rowset(passed.filter("user_id < 77"), "user_id", "behavior", "ts")
    assert own("blacklist") == rowset(black, "user_id", "behavior", "ts") and own("blacklist")


PAYS = T.StructType([T.StructField("tx", T.StringType()), T.StructField("pay_ts", T.TimestampNTZType())])
RECS = T.StructType([T.StructField("tx", T.StringType()), T.StructField("receipt_ts", T.TimestampNTZType()),
                     T.StructField("line", T.LongType())])


@pytest.fixture(scope="module")
def two_sides(spark, tmp_path_factory):
    root, r = str(tmp_path_factory.mktemp("two")), random.Random(8)
    pays = [(f"t{r.randrange(25)}", BASE + r.randrange(600)) for _ in range(150)] + [("", BASE + 5), (None, BASE + 6)]
    recs = [(f"t{r.randrange(25)}", BASE + r.randrange(600), i) for i in range(170)] + [("", BASE + 5, 1), (None, BASE + 9, 2)]
    pays.sort(key=lambda x: x[1] + r.uniform(0, 19))
    recs.sort(key=lambda x: x[1] + r.uniform(0, 19))
    far = BASE + 100_000
    write_arrivals(spark, root, "pays", [(k, ts(s)) for k, s in pays + [("far", far)]], PAYS, 5)
    write_arrivals(spark, root, "recs", [(k, ts(s), i) for k, s, i in recs + [("far", far + 7, 1)]], RECS, 6)
    return root


@pytest.mark.parametrize("timeout", ["5 seconds", "2 minutes"])
def test_one_to_one_stream_equals_batch(spark, two_sides, timeout):
    streams = [SJ.stream_table(spark, two_sides, n, 1) for n in ("pays", "recs")]
    got = SJ.run_to_files(SJ.reconcile_one_to_one_stream(*streams, "tx", "pay_ts", "receipt_ts", timeout, right_seq="line",
                                                         delay="20 seconds", buckets=4), "r3j")
    pays, recs = (spark.read.parquet(f"{two_sides}/{n}.parquet") for n in ("pays", "recs"))
    want = reconcile_one_to_one(pays, recs, "tx", "pay_ts", "receipt_ts", right_seq="line", timeout=timeout)
    cols = ["tx", "pay_ts", "receipt_ts", "status"]
    key = lambda df: sorted(map(str, df.filter("tx is null or tx <> 'far'").select(cols).collect()))     # noqa: E731
    assert key(got) == key(want)
    assert {r.status for r in want.select("status").distinct().collect()} >= {"matched", "unmatched_pay", "superseded_pay"}
    # every event with an id is in exactly one row
    counted = want.filter("tx <> ''").agg(F.count("pay_ts"), F.count("receipt_ts")).first()
    assert tuple(counted) == (pays.filter("tx <> ''").count(), recs.filter("tx <> ''").count())


def test_one_to_one_batch_with_timeout_by_hand(spark):
    pays = spark.createDataFrame([("a", ts(10)), ("a", ts(12)), ("b", ts(10)), ("c", ts(10)), ("d", ts(10))], PAYS)
    recs = spark.createDataFrame([("a", ts(17), 1), ("b", ts(16), 1), ("c", ts(8), 1), ("c", ts(11), 2)], RECS)
    got = reconcile_one_to_one(pays, recs, "tx", "pay_ts", "receipt_ts", right_seq="line", timeout="5 seconds")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("a", ts(10), None, "superseded_pay"), ("a", ts(12), ts(17), "matched"), ("b", ts(10), None, "unmatched_pay"),
        ("b", None, ts(16), "unmatched_receipt"), ("c", ts(10), ts(8), "matched"), ("c", None, ts(11), "unmatched_receipt"),
        ("d", ts(10), None, "unmatched_pay")], key=str)


def test_window_join_stream_equals_batch(spark, two_sides):
    streams = [SJ.stream_table(spark, two_sides, n, 1) for n in ("pays", "recs")]
    got = SJ.run_to_files(SJ.window_join_stream(streams[0], streams[1].drop("line"), "tx", "pay_ts", "receipt_ts",
                                                "1 minute", "20 seconds"), "r3w")
    pays, recs = (spark.read.parquet(f"{two_sides}/{n}.parquet") for n in ("pays", "recs"))
    want = window_join(pays, recs.drop("line"), "tx", "pay_ts", "receipt_ts", "1 minute")
    assert rowset(got.select(want.columns)) == rowset(want) and got.count() > 30
