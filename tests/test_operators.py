from pyspark.sql import functions as F

from helpers import events, rowset, ts
from eventide.operators.distinct import window_distinct
from eventide.operators.ratelimit import rate_limit
from eventide.operators.reconcile import reconcile, split_outputs, window_join
from eventide.operators.report import ranked_report, region_report


def test_rate_limit_pass_blacklist_drop(spark):
    rows = [(937166, 1511658000 + i, i, "ad1715") for i in range(143)]
    rows += [(1, 1511658000, 500, "ad1")]
    rows += [(937166, 1511658000 + 86400, 600, "ad1715")]   # next day resets
    df = events(spark, rows)
    passed, black = rate_limit(df, ["user_id", "kind"], "ts", "seq", cap=100)
    assert passed.count() == 100 + 1 + 1
    b = black.collect()
    assert len(b) == 1 and b[0]["user_id"] == 937166 and b[0]["ts"] == ts(1511658100)


def test_distinct_methods_agree_on_small_ids(spark):
    rows = [(u % 37, 3600 * (u % 3) + u, u, "view") for u in range(500)]
    df = events(spark, rows)
    exact = rowset(window_distinct(df, "user_id", "ts", "1 hour", method="exact"))
    bitmap = rowset(window_distinct(df, "user_id", "ts", "1 hour", method="bitmap"))
    onehash = rowset(window_distinct(df, "user_id", "ts", "1 hour", method="onehash"))
    hll = rowset(window_distinct(df, "user_id", "ts", "1 hour", method="hll"))
    assert exact == bitmap == onehash == hll


def _pay_receipt(spark):
    pays = spark.createDataFrame(
        [("sd76f87d6", ts(100)), ("3hu3k2432", ts(200)), ("35jue34we", ts(300)),
         ("", ts(400)), (None, ts(401))], "tx string, pay_ts timestamp_ntz")
    rec = spark.createDataFrame(
        [("sd76f87d6", ts(103)), ("3hu3k2432", ts(260)), ("ewr342as4", ts(500))],
        "tx string, receipt_ts timestamp_ntz")
    return pays, rec


def test_reconcile_unbounded_and_interval(spark):
    pays, rec = _pay_receipt(spark)
    full = reconcile(pays, rec, "tx", "pay_ts", "receipt_ts")
    assert rowset(full, "tx", "status") == [
        ("35jue34we", "unmatched_pay"), ("3hu3k2432", "matched"),
        ("ewr342as4", "unmatched_receipt"), ("sd76f87d6", "matched")]
    near = reconcile(pays, rec, "tx", "pay_ts", "receipt_ts", tolerance="5 seconds")
    assert rowset(near, "tx", "status") == [
        ("35jue34we", "unmatched_pay"), ("3hu3k2432", "unmatched_pay"),
        ("3hu3k2432", "unmatched_receipt"), ("ewr342as4", "unmatched_receipt"),
        ("sd76f87d6", "matched")]
    parts = split_outputs(near)
    assert parts["matched"].count() == 1 and parts["unmatched_pay"].count() == 2


def test_window_join(spark):
    pays, rec = _pay_receipt(spark)
    out = window_join(pays, rec, "tx", "pay_ts", "receipt_ts", "1 minute")
    assert rowset(out, "tx", "window_start") == [("sd76f87d6", ts(60))]


def test_reports(spark):
    ranked = spark.createDataFrame(
        [(ts(3600), 2, 7, 5), (ts(3600), 1, 9, 8)],
        "window_end timestamp_ntz, rank int, item_id long, views long")
    rep = ranked_report(ranked, "item_id", "views").first()["report"]
    assert rep == ("window end: 1970-01-01 01:00:00.0\nNo1: item=9 views=8\n"
                   "No2: item=7 views=5")
    counts = spark.createDataFrame([("beijing", ts(3605), 101)],
                                   "province string, window_end timestamp_ntz, count long")
    assert region_report(counts, "province", "count").first()["report"] == \
        "1970-01-01 01:00:05.0 beijing 101"


def test_results_do_not_depend_on_input_order(spark):
    import random
    from eventide.operators.sequence import failure_bursts, followed_by
    from eventide.operators.windows import window_count
    r = random.Random(5)
    rows = [(r.randrange(5), r.randrange(0, 5000), i, r.choice(["fail", "ok", "pay", "create"]))
            for i in range(1500)]
    shuffled = rows[:]
    r.shuffle(shuffled)
    a, b = events(spark, rows), events(spark, shuffled).repartition(7)
    for f in (
        lambda d: window_count(d, "user_id", "ts", "60 seconds", "5 seconds"),
        lambda d: rate_limit(d, ["user_id", "kind"], "ts", "seq", cap=4)[0],
        lambda d: failure_bursts(d, "user_id", "ts", "seq", F.col("kind") == "fail", 2,
                                 "30 seconds"),
        lambda d: followed_by(d, "user_id", "ts", "seq", F.col("kind") == "create",
                              F.col("kind") == "pay", "2 minutes"),
    ):
        assert rowset(f(a)) == rowset(f(b))


def test_cap_pass_plus_dropped_is_input(spark):
    rows = [(u % 4, 86400 * (u % 3) + u, u, "ad") for u in range(400)]
    df = events(spark, rows)
    passed, black = rate_limit(df, ["user_id", "kind"], "ts", "seq", cap=5)
    groups = df.groupBy("user_id", F.date_trunc("DAY", "ts")).count().collect()
    assert passed.count() == sum(min(5, g["count"]) for g in groups)
    assert black.count() == sum(1 for g in groups if g["count"] > 5)
    refused = df.join(passed, "seq", "left_anti").count()
    assert passed.count() + refused == df.count()


def test_console_and_batch_side_outputs(spark, tmp_path, capsys):
    from eventide.streaming.sinks import console, write_side_outputs
    df = spark.createDataFrame([(1, "pass"), (2, "blacklist"), (3, "pass")],
                               "id long, tag string")
    assert console(df, "Ad count>") is None
    assert "Ad count>" in capsys.readouterr().out
    out = {"pass": str(tmp_path / "p"), "blacklist": str(tmp_path / "b")}
    write_side_outputs(df, "tag", out)
    assert spark.read.parquet(out["pass"]).count() == 2
    assert spark.read.parquet(out["blacklist"]).columns == ["id"]
