import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rowset, ts
from eventide.operators.ratelimit import rate_limit
from eventide.operators.sequence import failure_bursts, followed_by
from eventide.plans import bindings as B
from eventide.streaming import jobs as SJ
from eventide.streaming.sinks import side_output_writer

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _write_events(spark, root, rows, files):
    """rows: (event_id, seconds, user_id, event_type); written time-ordered
    into ``files`` parquet files so a stream with maxFilesPerTrigger=1 sees
    them as consecutive micro-batches."""
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    per = -(-len(rows) // files)
    path = f"{root}/events.parquet"
    for i in range(files):
        part = rows[i * per:(i + 1) * per]
        spark.createDataFrame(
            [(e, ts(s), u, k, 1.0, json.dumps({"k": e % 7})) for e, s, u, k in part], EVENTS
        ).coalesce(1).write.mode("append").parquet(path)
    return root


def _random_events(seed, users, n, kinds, step):
    r = random.Random(seed)
    t, rows = 1_700_000_000, []
    for e in range(n):
        t += r.choice(step)
        rows.append((e, t, r.randrange(users), r.choice(kinds)))
    return rows


@pytest.fixture(scope="module")
def stream_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("events"))
    rows = _random_events(11, 6, 900, ["error", "error", "view", "click", "purchase"],
                          [1, 2, 3, 5, 40, 400])
    return _write_events(spark, root, rows, 6), rows


def _stream(spark, root):
    return B.behavior_view(SJ.stream_table(spark, root, "events", max_files_per_trigger=1))


def test_failure_bursts_stream_equals_batch(spark, stream_dir):
    root, rows = stream_dir
    got = SJ.run_to_files(SJ.failure_bursts_stream(_stream(spark, root), "20 seconds", 2), "t_b")
    ev = B.behavior_view(spark.read.parquet(f"{root}/events.parquet"))
    want = failure_bursts(ev, "user_id", "ts", "seq", F.col("behavior") == "error", 2,
                          "20 seconds")
    max_ts = ts(max(r[1] for r in rows))
    want_rows, got_rows = rowset(want), rowset(got)
    assert set(got_rows) <= set(want_rows)
    # a user's last burst is only closed once its timer is under the watermark
    closed = [r for r in want_rows if (max_ts - r[1]).total_seconds() > 20]
    assert set(closed) <= set(got_rows)
    assert len(got_rows) > 0


def test_funnel_stream_equals_batch(spark, stream_dir):
    root, rows = stream_dir
    got = SJ.run_to_files(SJ.funnel_stream(_stream(spark, root), "10 minutes"), "t_f")
    ev = B.behavior_view(spark.read.parquet(f"{root}/events.parquet"))
    want = rowset(followed_by(ev, "user_id", "ts", "seq", F.col("behavior") == "click",
                              F.col("behavior") == "purchase", "10 minutes"))
    got_rows = rowset(got)
    assert set(got_rows) <= set(want)
    assert {r for r in want if r[4] == "success"} <= set(got_rows)


def test_rate_limit_stream_equals_batch(spark, stream_dir):
    root, _ = stream_dir
    got = SJ.run_to_files(SJ.rate_limit_stream(_stream(spark, root), 3), "t_r")
    ev = B.behavior_view(spark.read.parquet(f"{root}/events.parquet"))
    passed, black = rate_limit(ev, ["user_id", "behavior"], "ts", "seq", cap=3)
    assert rowset(got.filter("tag = 'pass'"), "seq") == rowset(passed, "seq")
    assert rowset(got.filter("tag = 'blacklist'"), "user_id", "behavior", "ts") == \
        rowset(black, "user_id", "behavior", "ts")


def test_side_outputs_and_upsert_are_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "matched"), (2, "unmatched_pay"), (3, "matched")],
                               "id long, status string")
    out = {"matched": str(tmp_path / "m"), "unmatched_pay": str(tmp_path / "u")}
    w = side_output_writer("status", out)
    w(df, 0)
    w(df, 0)        # replay of batch 0 replaces its own files
    assert spark.read.parquet(out["matched"]).count() == 2
    assert spark.read.parquet(out["unmatched_pay"]).count() == 1
    base = str(tmp_path / "ups")
    v0 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    v1 = spark.createDataFrame([("a", 5)], "k string, v long")
    SJ.upsert_by_key(v0, 0, base)
    SJ.upsert_by_key(v1, 1, base)
    SJ.upsert_by_key(v1, 1, base)
    got = SJ.read_upserted(spark, base, ["k"], T.StructType(v0.schema.fields))
    assert rowset(got) == [("a", 5), ("b", 2)]


def test_dense_sliding_stream_equals_batch_across_batches(spark, stream_dir):
    from eventide.operators.windows import window_count
    root, rows = stream_dir
    timed = SJ.event_time(_stream(spark, root), "ts")
    got = SJ.run_to_files(
        SJ.stream_window_counts(timed, ["behavior"], "2 minutes", "5 seconds", "n")
        .drop("event_time"), "t_sl")
    ev = B.behavior_view(spark.read.parquet(f"{root}/events.parquet"))
    want = window_count(ev, "behavior", "ts", "2 minutes", "5 seconds", name="n")
    max_ts = ts(max(r[1] for r in rows))
    closed = [r for r in rowset(want, "behavior", "window_start", "window_end", "n")
              if r[2] <= max_ts]
    assert rowset(got, "behavior", "window_start", "window_end", "n") == closed


def test_sparse_sliding_stream_equals_batch(spark, stream_dir):
    from eventide.operators.windows import window_count
    root, rows = stream_dir
    timed = SJ.event_time(_stream(spark, root), "ts")
    got = SJ.run_to_files(
        SJ.stream_window_counts(timed, ["behavior"], "1 minute", "20 seconds", "n")
        .drop("event_time"), "t_sp")
    ev = B.behavior_view(spark.read.parquet(f"{root}/events.parquet"))
    want = window_count(ev, "behavior", "ts", "1 minute", "20 seconds", name="n")
    max_ts = ts(max(r[1] for r in rows))
    closed = [r for r in rowset(want, "behavior", "window_start", "window_end", "n")
              if r[2] <= max_ts]
    assert rowset(got, "behavior", "window_start", "window_end", "n") == closed


def test_processing_time_cap(spark, stream_dir):
    root, rows = stream_dir
    got = SJ.run_to_files(SJ.rate_limit_stream(_stream(spark, root), 3, clock="processing"),
                          "t_pt", drain=True)
    # the whole input arrives within one wall-clock day: cap per key overall
    counts = {}
    for _, _, u, k in rows:
        counts[(u, k)] = counts.get((u, k), 0) + 1
    want_pass = sum(min(3, c) for c in counts.values())
    want_black = sum(1 for c in counts.values() if c > 3)
    assert got.filter("tag = 'pass'").count() == want_pass
    assert got.filter("tag = 'blacklist'").count() == want_black
