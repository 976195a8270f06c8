"""Cases that the test tables do not hold: negative and empty ids, odd windows, other time zones,
bad lines, repeated ids, URI paths."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.distinct import window_distinct
from eventide.operators.ratelimit import rate_limit
from eventide.operators.reconcile import reconcile, reconcile_one_to_one
from eventide.operators.sequence import followed_by
from eventide.operators.windows import window_count
from eventide.session import path_kind, scratch_path
from eventide.sources.files import parse_delimited, parse_weblog, read_lines
from eventide.streaming import jobs as SJ

BASE = dt.datetime(2026, 1, 1)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def test_bitmap_counts_negative_ids(spark):
    df = spark.createDataFrame([(at(1), -1), (at(2), -2), (at(3), 0), (at(4), 5), (at(5), 5), (at(3700), -7),
                                (at(7300), None)], "ts timestamp_ntz, id long")
    exact, bitmap = (sorted(tuple(r) for r in window_distinct(df, "id", "ts", "1 hour", method=m).collect())
                     for m in ("exact", "bitmap"))
    assert exact == bitmap and [r[2] for r in exact] == [4, 1, 0]


def test_receipts_without_an_id_are_reported(spark):
    pays = spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "tx string, p int")
    receipts = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("z", 4)], "tx string, r int")
    got = sorted((r.status, r.r or 0) for r in reconcile(pays, receipts, "tx", "p", "r").collect())
    assert got == [("matched", 1), ("unmatched_receipt", 2), ("unmatched_receipt", 3), ("unmatched_receipt", 4)]


def one_to_one(events):
    """The state machine, one event after the other: (side, time, seq)."""
    waiting, out = None, []
    for side, ts, _ in sorted(events, key=lambda e: (e[1], e[0], e[2])):
        if waiting and waiting[0] != side:
            p, r = (waiting[1], ts) if side else (ts, waiting[1])
            out.append(("matched", p, r))
            waiting = None
        else:
            if waiting:
                out.append(("superseded_receipt" if side else "superseded_pay",
                            None if side else waiting[1], waiting[1] if side else None))
            waiting = (side, ts)
    if waiting:
        side, ts = waiting
        out.append(("unmatched_receipt" if side else "unmatched_pay", None if side else ts, ts if side else None))
    return out


def test_one_to_one_equals_the_state_machine(spark):
    r = random.Random(2)
    by_id = {f"t{k}": [(r.randint(0, 1), r.randint(0, 12), i) for i in range(r.randint(1, 14))] for k in range(150)}
    by_id["hot"] = [(s, 2 * i + s, i) for i in range(50) for s in (0, 1)]
    rows = [(k, *e) for k, es in by_id.items() for e in es]
    df = spark.createDataFrame(rows, "tx string, side int, ts int, seq int").repartition(4)
    left = df.filter("side = 0").select("tx", F.col("ts").alias("p"), "seq")
    right = df.filter("side = 1").select("tx", F.col("ts").alias("r"), "seq")
    got = reconcile_one_to_one(left, right, "tx", "p", "r", "seq", "seq").collect()
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((x.tx, x.status, x.p, x.r) for x in got), key=key) == sorted(
        ((k, *o) for k, es in by_id.items() for o in one_to_one(es)), key=key)
    assert sum(x.status == "matched" for x in got if x.tx == "hot") == 50
    empty = spark.createDataFrame([("", 1), (None, 2)], "tx string, r int")
    assert {x.status for x in reconcile_one_to_one(left.filter("false"), empty, "tx", "p", "r").collect()} == {
        "unmatched_receipt"}


def test_receipts_without_an_id_all_stay_when_ids_are_reduced(spark):
    pays = spark.createDataFrame([("a", 1), ("a", 3)], "tx string, p int")
    receipts = spark.createDataFrame([("a", 1), ("a", 2), ("", 2), ("", 2), (None, 3), (None, 4)], "tx string, r int")
    got = sorted((r.status, r.tx or "", r.r) for r in reconcile(pays, receipts, "tx", "p", "r", dedupe=True).collect())
    assert got == [("matched", "a", 2)] + [("unmatched_receipt", "", r) for r in (2, 2, 3, 4)]


def test_one_to_one_sorts_no_receipts_without_an_id(spark):
    """Beside two ids with an event each, 2,000 receipts without an id: none may reach the window's task."""
    pays = spark.createDataFrame([("a", 1), ("", 5), (None, 6)], "tx string, p int")
    receipts = spark.createDataFrame([("a", 2), ("z", 3)] + [(k, i) for i in range(1000) for k in ("", None)],
                                     "tx string, r int")
    got = reconcile_one_to_one(pays, receipts, "tx", "p", "r")
    assert sorted((x.status, x.tx or "", x.p or 0, x.r) for x in got.collect()) == sorted(
        [("matched", "a", 1, 2), ("unmatched_receipt", "z", 0, 3)]
        + [("unmatched_receipt", "", 0, i) for i in range(1000) for _ in range(2)])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # the window's two sides are filtered; the other receipts' filter is without NOT
    assert plan.count("NOT (coalesce(tx") == 2, plan


def test_event_without_a_time_fails(spark):
    df = spark.createDataFrame([(1, at(1), 1, "a"), (1, None, 2, "a")], "k int, ts timestamp_ntz, seq int, b string")
    with pytest.raises(PySparkException, match="no time"):
        followed_by(df, "k", "ts", "seq", F.col("b") == "a", F.col("b") == "b").collect()


def test_short_and_bad_lines(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()),
                           T.StructField("ts", T.LongType())])
    good = [(" 1 , create,5 ",), ("2,,6",)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for bad in ("1,create", "x,create,3"):
                df = spark.createDataFrame([*good, (bad,)], "value string")
                with pytest.raises(PySparkException, match="bad line"):
                    parse_delimited(df, schema).collect()
                assert [tuple(r) for r in parse_delimited(df, schema, bad_rows="drop").collect()] == [
                    (1, "create", 5), (2, "", 6)]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


@pytest.fixture(params=["America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weblog_fields_are_trimmed_and_checked(spark, zone):
    line = "10.0.0.1 7 - 17/05/2015:10:05:03 +0000 GET /a/b "
    df = spark.createDataFrame([(line,)], "value string")
    assert [str(x) for x in parse_weblog(df).first()] == ["10.0.0.1", "7", "2015-05-17 10:05:03", "GET", "/a/b"]
    bad = spark.createDataFrame([("10.0.0.1 7 - someday +0000 GET /a",), ("short",), (line,)], "value string")
    with pytest.raises(PySparkException, match="bad line"):
        parse_weblog(bad).collect()
    assert parse_weblog(bad, bad_rows="drop").count() == 1 and parse_weblog(bad, bad_rows="null").count() == 3


def test_days_are_utc_days(spark, zone):
    rows = [(1, "2026-01-01 23:30:00", 1), (1, "2026-01-02 00:30:00", 2), (1, "2026-01-02 06:00:00", 3)]
    df = spark.createDataFrame(rows, "k int, t string, seq int")
    for ts in (F.to_timestamp_ntz("t"), F.to_timestamp(F.concat("t", F.lit("+00:00")))):
        passed, black = rate_limit(df.withColumn("ts", ts), "k", "ts", "seq", cap=1)
        assert sorted(r.seq for r in passed.collect()) == [1, 2] and black.count() == 1


def files_of(spark, rows, schema, n):
    """The rows as ``n`` files of a table in the shared folder, under a URI."""
    path = scratch_path(spark, f"round2-{random.random()}.parquet")
    spark.createDataFrame(rows, schema).repartition(n).write.parquet(path)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def test_stream_over_a_uri_and_odd_windows_equal_batch(spark, zone):
    r = random.Random(5)
    rows = [(i, at(r.randint(0, 7200)), i % 3, "view") for i in range(300)] + [(999, at(90_000), 1, "view")]
    path = files_of(spark, rows, "seq long, ts timestamp_ntz, user_id long, behavior string", 4)
    assert path_kind(spark, path) == "dir" and path_kind(spark, path + "x") is None
    folder, _, name = path.rpartition("/")
    events = SJ.stream_table(spark, folder, name.removesuffix(".parquet"))
    timed = SJ.event_time(events, "ts")
    before = F.col("window_end") < F.to_timestamp_ntz(F.lit(str(at(80_000))))
    for size, slide in (("10 minutes", "4 minutes"), ("1 hour", "1 minute"), ("1 hour", None)):
        got = SJ.run_to_files(SJ.stream_window_counts(timed, ["user_id"], size, slide), "odd").filter(before)
        want = window_count(spark.read.parquet(path), ["user_id"], "ts", size, slide or size).filter(before)
        cols = ["user_id", "window_start", "window_end", "count"]
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_text_files_batch_and_stream(spark):
    path = scratch_path(spark, f"round2-lines-{random.random()}")
    spark.createDataFrame([(f"{i},create,{i * 7}",) for i in range(50)], "value string").repartition(3).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()),
                           T.StructField("ts", T.LongType())])
    batch = parse_delimited(read_lines(spark, path), schema)
    stream = SJ.run_to_files(parse_delimited(read_lines(spark, path, stream=True, max_files_per_trigger=1), schema), "lines")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect())) == [
        (i, "create", i * 7) for i in range(50)]


def shuffled_stream(spark, rows, n_files):
    """Files of rows that are out of order by at most a minute, one file per micro-batch."""
    folder = scratch_path(spark, f"round2-late-{random.random()}")
    r = random.Random(1)
    rows = sorted(rows, key=lambda x: (x[1] + dt.timedelta(seconds=r.uniform(0, 60)), x[0]))
    schema = "seq long, ts timestamp_ntz, user_id long, behavior string"
    size = -(-len(rows) // n_files)
    for k in range(n_files):
        spark.createDataFrame(rows[k * size:(k + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    return (spark.read.schema(schema).parquet(folder),
            spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder))


def test_late_rows_inside_the_delay_count(spark):
    r = random.Random(9)
    # around midnight, one user with most rows
    rows = [(i, at(86_400 - 900 + r.randint(0, 1800)), 0 if i % 4 else r.randint(1, 3), "click") for i in range(400)]
    rows.append((1000, at(400_000), 9, "view"))     # a row is judged when the watermark has passed it
    batch, stream = shuffled_stream(spark, rows, 6)
    got = SJ.run_to_files(SJ.rate_limit_stream(stream, 20, delay="2 minutes"), "late_cap")
    passed, black = rate_limit(batch, ["user_id", "behavior"], "ts", "seq", cap=20)
    per_day = lambda df: sorted(tuple(x) for x in df.groupBy("user_id", F.to_date("ts").alias("d")).count().collect())
    passed = passed.filter("user_id < 9")       # the closing row itself still waits
    assert per_day(got.filter("tag = 'pass'")) == per_day(passed)
    assert sorted(x.seq for x in got.filter("tag = 'pass'").collect()) == sorted(x.seq for x in passed.collect())
    assert got.filter("tag = 'blacklist'").count() == black.count() > 0


def test_repeats_over_several_batches_equal_batch(spark):
    from eventide.operators.sequence import repeat_match
    r = random.Random(4)
    rows = [(i, at(r.randint(0, 1500)), r.randint(0, 3), r.choice(["error", "error", "ok"])) for i in range(300)]
    rows += [(1000 + u, at(100_000), u, "ok") for u in range(4)]
    batch, stream = shuffled_stream(spark, rows, 5)
    got = SJ.run_to_files(SJ.repeats_stream(stream, "30 seconds", delay="2 minutes"), "late_repeats")
    want = repeat_match(batch, "user_id", "ts", "seq", F.col("behavior") == "error", within="30 seconds")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 20


def test_funnel_over_several_batches_equals_batch(spark):
    r = random.Random(6)
    rows = [(i, at(r.randint(0, 3000)), r.randint(0, 3), r.choice(["click", "purchase", "view"])) for i in range(300)]
    rows += [(1000 + u, at(100_000), u, "click") for u in range(4)]
    batch, stream = shuffled_stream(spark, rows, 5)
    got = SJ.run_to_files(SJ.funnel_stream(stream, "90 seconds", delay="2 minutes"), "late_funnel")
    want = followed_by(batch, "user_id", "ts", "seq", F.col("behavior") == "click", F.col("behavior") == "purchase",
                       within="90 seconds").filter(F.col("begin_seq") < 1000)
    cols = ["user_id", "begin_ts", "begin_seq", "follow_ts", "status"]
    key = lambda x: x[2]      # noqa: E731
    assert sorted(map(tuple, got.select(cols).collect()), key=key) == sorted(map(tuple, want.select(cols).collect()), key=key)


def test_funnel_keeps_partners_ahead_of_an_open_first_row(spark):
    """Inside the delay: a partner, a first row after it, and only then the first row before it."""
    folder = scratch_path(spark, f"round2-ahead-{random.random()}")
    schema = "seq long, ts timestamp_ntz, user_id long, behavior string"
    for rows in ([(0, at(2), 1, "purchase"), (1, at(4), 1, "click")], [(2, at(1), 1, "click")], [(3, at(1000), 2, "click")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    got = SJ.run_to_files(SJ.funnel_stream(stream, "30 seconds", delay="5 seconds"), "ahead_funnel")
    assert sorted((r.begin_seq, r.follow_ts, r.status) for r in got.collect()) == [
        (1, None, "timeout"), (2, at(2), "success")]


def test_rows_beyond_the_delay_are_reported(spark, caplog):
    folder = scratch_path(spark, f"round2-beyond-{random.random()}")
    schema = "seq long, ts timestamp_ntz, user_id long, behavior string"
    # the watermark of the first file holds from the next batch on
    for rows in ([(0, at(1000), 1, "click")], [(1, at(1001), 1, "click")], [(2, at(1), 1, "click"), (3, at(2), 2, "click")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    SJ.run_to_files(SJ.funnel_stream(stream, "30 seconds", delay="5 seconds"), "beyond_funnel")
    assert "beyond_funnel: 2 rows" in caplog.text


def test_top_n_of_a_stream_holds_n_entries(spark):
    """2,000 keys in one window end: right ranks, and no aggregate gathers all keys."""
    folder = scratch_path(spark, f"round2-top-{random.random()}")
    schema = "ts timestamp_ntz, item_id long, behavior string"
    rows = [(at(i % 60), k, "view") for k in range(2000) for i in range(1 + (k * 7919) % 5)]
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(folder)
    spark.createDataFrame([(at(90_000), 1, "view")], schema).coalesce(1).write.mode("append").parquet(folder)
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    df = SJ.hot_items_stream(read(), n=4, size="5 minutes", slide="5 minutes")
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "collect_top_k" in plan and "collect_list" not in plan
    got = SJ.run_to_files(df, "top_bounded").filter(F.col("window_start") == F.lit(at(0)))
    want = sorted(((-(1 + (k * 7919) % 5), k) for k in range(2000)))[:4]
    assert [(r["rank"], -r.views, r.item_id) for r in got.orderBy("rank").collect()] == [(i + 1, c, k) for i, (c, k) in enumerate(want)]


def test_starting_a_stream_leaves_the_session_as_it_was(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with SJ.rocksdb_state(spark):
            assert spark.conf.get(key) == SJ.ROCKSDB
        assert spark.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
