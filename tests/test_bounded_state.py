"""Compacted upserts, the band join, sketches over sliding windows, the Bloom first-seen test, corrected rankings."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rowset, ts
from eventide.operators.distinct import sliding_distinct
from eventide.operators.reconcile import reconcile
from eventide.operators.topn import top_n
from eventide.operators.windows import window_count
from eventide.streaming import jobs as SJ
from eventide.streaming.bloom import bloom_size, distinct_bloom_stream
from eventide.streaming.upsert import UpsertTable

BASE = 1_700_000_000


# S7

def test_upsert_table_holds_current_rows_only(spark, tmp_path):
    r = random.Random(1)
    schema = spark.createDataFrame([], "k string, j int, v int").schema
    table = UpsertTable(str(tmp_path / "t"), ["k", "j"], schema, buckets=8)
    assert table.read(spark).count() == 0
    want = {}
    for batch in range(4):
        rows = {(r.choice(["a", "b", "c", None, ""]), r.randrange(4)): r.randrange(100) for _ in range(6)}
        want |= rows
        df = spark.createDataFrame([(*k, v) for k, v in rows.items()], schema)
        table.upsert(df, batch)
        if batch % 2:
            table.upsert(df, batch)         # a replayed batch changes nothing
        got = {(x.k, x.j): x.v for x in table.read(spark).collect()}
        assert got == want and table.read(spark).count() == len(want)
    table.upsert(spark.createDataFrame([], schema), 4)
    now = table.pointers(spark)
    opened = {tuple(f.rsplit("/", 3)[1:3]) for f in table.read(spark).inputFiles()}
    assert opened == {(f"version={v}", f"bucket_no={b}") for b, v in now.items()}
    assert table.vacuum(spark, keep=1) > 0
    assert table.pointers(spark) == now
    assert {(x.k, x.j): x.v for x in table.read(spark).collect()} == want


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ["k"], spark.createDataFrame([], "k int, v int").schema, buckets=2)
    rows = spark.createDataFrame([(1, 1), (2, 1)], "k int, v int")
    table.upsert(rows, 0)
    # data of batch 1 and a folder for its pointers, but no pointers yet
    (rows.withColumn("v", F.lit(9)).withColumn("bucket_no", F.lit(0)).write.partitionBy("bucket_no")
     .parquet(f"{table.path}/data/version=1"))
    (tmp_path / "t" / "pointers" / "1").mkdir()
    assert rowset(table.read(spark)) == [(1, 1), (2, 1)]
    table.upsert(rows.filter("k = 2").withColumn("v", F.lit(5)), 1)
    assert rowset(table.read(spark)) == [(1, 1), (2, 5)]


# J-b

def brute(pays, receipts, tol):
    out, hit = [], set()
    for k, p in pays:
        if not k:
            continue
        near = [i for i, (rk, r) in enumerate(receipts) if rk == k and None not in (p, r) and abs(r - p) <= tol]
        hit.update(near)
        out += [(k, p, receipts[i][1], "matched") for i in near] or [(k, p, None, "unmatched_pay")]
    return out + [(k, None, r, "unmatched_receipt") for i, (k, r) in enumerate(receipts) if i not in hit]


@pytest.mark.parametrize("tol", [0, 1, 5, 40])
def test_band_join_equals_brute_force(spark, tol):
    r = random.Random(tol)

    def side(n):
        rows = [(r.choice(["hot", "hot", "x", "y", "", None]), r.choice([None, *range(-150, 151)])) for _ in range(n)]
        return rows + rows[:20]             # rows that repeat

    pays, receipts = side(120), side(120)
    dfs = [spark.createDataFrame([(k, None if t is None else ts(BASE + t)) for k, t in rows], f"tx string, {c} timestamp_ntz")
           for rows, c in ((pays, "p"), (receipts, "r"))]
    got = reconcile(*dfs, "tx", "p", "r", tolerance=f"{tol} seconds")
    at = {None: None} | {t: ts(BASE + t) for t in range(-150, 151)}
    want = [(k, at[p], at[q], s) for k, p, q, s in brute(pays, receipts, tol)]
    assert sorted(map(str, (tuple(x) for x in got.collect()))) == sorted(map(str, want))
    empty = reconcile(dfs[0].limit(0), dfs[1], "tx", "p", "r", tolerance=f"{tol} seconds")
    assert rowset(empty.groupBy("status").count()) == [("unmatched_receipt", len(receipts))]


def test_one_id_is_spread_over_its_stretches_of_time(spark):
    n = 100_000
    pays = spark.range(n).select(F.lit("hot").alias("tx"), F.timestamp_seconds(F.col("id") * 60).alias("p"))
    receipts = spark.range(n).select(F.lit("hot").alias("tx"), F.timestamp_seconds(F.col("id") * 60 + 3).alias("r"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = reconcile(pays, receipts, "tx", "p", "r", tolerance="5 seconds")
        sizes = [x["count"] for x in got.filter("status = 'matched'").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 4
        assert got.filter("status <> 'matched'").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# A6 over sliding windows

@pytest.mark.parametrize("method", ["bitmap", "hll"])
def test_sliding_distinct_equals_brute_force(spark, method):
    r = random.Random(7)
    rows = [(r.choice("ab"), r.choice([None, -40_000, *range(30)]), r.randrange(4000)) for _ in range(300)]
    df = spark.createDataFrame([(k, u, ts(BASE + t)) for k, u, t in rows] + [("a", 1, None)], "k string, u long, t timestamp_ntz")
    want = {}
    for k, u, t in rows:
        pane = (BASE + t) // 300
        for w in range(pane - 3, pane + 1):
            want.setdefault((k, w * 300), set()).add(u)
    want = {kw: len(s - {None}) for kw, s in want.items()}
    got = sliding_distinct(df, "u", "t", "20 minutes", "5 minutes", keys="k", method=method)
    got = {(x.k, x.window_start): x.uv for x in got.collect()}
    assert got == {(k, ts(w)): n for (k, w), n in want.items() if n or method == "hll"}


def test_sliding_sketches_stay_inside_their_error(spark):
    n, lg_k = 100_000, 12
    df = spark.range(n).select(F.col("id").alias("u"), F.timestamp_seconds(F.lit(BASE) + F.pmod("id", F.lit(3600))).alias("t"))
    got = sliding_distinct(df.unionByName(df), "u", "t", "1 hour", "5 minutes", lg_k=lg_k).collect()
    exact = {x.window_start: x.uv for x in sliding_distinct(df, "u", "t", "1 hour", "5 minutes", method="bitmap").collect()}
    assert len(got) == len(exact) and max(exact.values()) > n * 0.9
    assert all(abs(x.uv - exact[x.window_start]) <= 4 * 1.04 / 2 ** (lg_k / 2) * exact[x.window_start] for x in got)


# A5, A6 on a stream

def test_bloom_first_seen_counts_within_its_bound(spark, tmp_path):
    n, fpp, path = 100_000, 1e-3, str(tmp_path / "v.parquet")
    ids = spark.range(n).select((F.col("id") * 7919).alias("u"), F.timestamp_seconds(F.lit(BASE - BASE % 3600) + F.pmod("id", F.lit(3600))).alias("t"))
    close = spark.createDataFrame([(None, BASE + 90_000)], "u long, s long").select("u", F.timestamp_seconds("s").alias("t"))
    for part in (ids.filter("u % 2 = 0"), ids, close.unionByName(ids.limit(0))):     # half of the ids come again in the next file
        part.coalesce(1).write.mode("append").parquet(path)
    last = close.select(F.lit(1).cast("long").alias("u"), F.col("t") + F.expr("INTERVAL 1 HOUR") * 2)
    last.toDF("u", "t").coalesce(1).write.mode("append").parquet(path)
    logs = spark.readStream.schema("u long, t timestamp").option("maxFilesPerTrigger", "1").parquet(path)
    got = SJ.run_to_files(distinct_bloom_stream(SJ.event_time(logs, "t", "2 days"), "u", capacity=n, fpp=fpp), "bloom")
    assert got.count() == 0                 # nothing is closed two days behind
    got = SJ.run_to_files(distinct_bloom_stream(SJ.event_time(logs, "t"), "u", capacity=n, fpp=fpp), "bloom")
    rows = {x.window_start: x.uv for x in got.collect()}
    assert set(rows) == {ts(BASE - BASE % 3600)}
    uv = rows[ts(BASE - BASE % 3600)]
    assert n - 2 * fpp * n <= uv <= n


def test_bloom_size():
    bits, hashes = bloom_size(1000, 0.01)
    assert bits % 8 == 0 and 9585 <= bits <= 9600 and hashes == 7
    with pytest.raises(ValueError):
        bloom_size(0, 0.1)


# T3

def test_ranking_is_early_and_corrected_by_late_rows(spark, tmp_path):
    updates, table = None, None
    schema = "seq long, ts timestamp_ntz, url string"
    first = [(i, ts(BASE + i), "/a" if i % 3 else "/b") for i in range(60)]
    late = [(100 + i, ts(BASE + 20 + i), "/b") for i in range(30)]          # inside the minute
    path = str(tmp_path / "log.parquet")
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(path)
    logs = spark.readStream.schema(schema).parquet(path)
    updates, table = SJ.hot_urls_table(logs, str(tmp_path / "table"), buckets=4)

    def run():
        with SJ.rocksdb_state(spark):
            q = (updates.writeStream.outputMode("update").foreachBatch(table.upsert)
                 .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        return rowset(SJ.rank_hot_urls(table.read(spark), 2, "20 seconds", "5 seconds"))

    def batch(rows):
        df = spark.createDataFrame(rows, schema)
        newest = max(t for _, t, _ in rows)
        wins = window_count(df, "url", "ts", "20 seconds", "5 seconds", name="views")
        wins = wins.filter(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 1 SECOND"))
        return rowset(top_n(wins, "url", 2, count_col="views").select("window_start", "window_end", "rank", "url", "views"))

    early = run()
    assert early == batch(first) and early
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(path)
    final = run()
    assert final == batch(first + late) and final != early
