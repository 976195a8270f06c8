"""Streaming forms of the jobs.

Every job reads the events table as a file stream, sets the reference's
watermark, and runs with ``availableNow`` into a file sink in the shared
checkpoint folder (never the driver's memory sink); the function then
returns a batch DataFrame over what the stream wrote.  Windows still above
the final watermark stay open, exactly as a live stream would leave them.
"""

from __future__ import annotations

import logging
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction

from eventide.functions.time import duration_us, epoch_micros, from_micros
from eventide.functions.hashing import poly_hash
from eventide.operators.reconcile import (MATCHED, SUPERSEDED_LEFT, SUPERSEDED_RIGHT, UNMATCHED_LEFT,
                                          UNMATCHED_RIGHT, nonempty_key)
from eventide.operators.topn import top_n
from eventide.operators.windows import window_count
from eventide.session import path_kind, scratch_path
from eventide.streaming.ordered import BurstProcessor, CapProcessor, OneToOneProcessor
from eventide.streaming.processors import (FollowedByProcessor, ProcessingTimeCapProcessor,
                                           RepeatProcessor, SlidingCountProcessor, SlidingTopProcessor)
from eventide.streaming.upsert import UpsertTable

log = logging.getLogger(__name__)


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 for parquet: a file stream over one table of ``sf_dir``."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if path_kind(spark, path) == "dir":
        src = path
    else:
        # one file per table: stream the folder, keep only that file
        src, _, file = path.rpartition("/")
        r = r.option("pathGlobFilter", file)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(src)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """``transformWithState`` needs the RocksDB state store.  The provider is
    read when a query starts: start queries inside this block; the session's
    own settings are put back after it."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              # counting the rows of the state costs a read before every write
              "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def event_time(df: DataFrame, ts: str, delay: str = "0 seconds",
               out: str = "event_time") -> DataFrame:
    """Watermark needs a TIMESTAMP column; timestamp_ntz is read as UTC, and
    turned back by :func:`to_ntz`, through the epoch: the session's zone has no part in it."""
    return df.withColumn(out, F.timestamp_micros(epoch_micros(df, ts))).withWatermark(out, delay)


def to_ntz(c):
    return from_micros(F.unix_micros(F.col(c) if isinstance(c, str) else c))


def run_to_files(df: DataFrame, name: str, output_mode: str = "append",
                 drain: bool = False) -> DataFrame:
    """Run a streaming DataFrame to completion (availableNow) into parquet
    files under the shared checkpoint folder; return them as a batch
    DataFrame with the stream's schema.

    ``drain=True`` is for queries with processing-time timers: those keep a
    query alive until the timers fire, so the query processes what is
    available and is then stopped.

    Rows that came after the watermark are not used; their number is logged
    as a warning.
    """
    spark = df.sparkSession
    base = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")
    w = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("path", f"{base}/data").option("checkpointLocation", f"{base}/checkpoint")
         .queryName(f"{name}_{uuid.uuid4().hex[:6]}"))
    if drain:
        with rocksdb_state(spark):
            q = w.start()
        try:
            _wait_input_consumed(q)
        finally:
            q.stop()
    else:
        with rocksdb_state(spark):
            q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    late = late_rows(q)
    if late:
        log.warning("%s: %d rows or more came after the watermark and were not used", name, late)
    return spark.read.schema(df.schema).parquet(f"{base}/data")


def late_rows(q) -> int:
    """Rows that stateful operators dropped as later than the watermark, in the batches whose progress
    the query still holds (``spark.sql.streaming.numRecentProgressUpdates``); an operator behind a
    partial aggregate counts groups."""
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])


def _wait_input_consumed(q, timeout_s: float | None = None) -> None:
    """Block until a micro-batch ran without new input on any source (its
    start and end offsets are equal), i.e. everything available was read.
    ``timeout_s`` limits the wait; by default it may take as long as it takes."""
    import time
    t0 = time.time()
    while timeout_s is None or time.time() - t0 < timeout_s:
        if q.exception() is not None:
            raise q.exception()
        progress = q.recentProgress
        if len(progress) >= 2 and progress[-1]["numInputRows"] == 0:
            srcs = progress[-1]["sources"]
            # a batch that started and ended at the same offsets found no new input
            if all(str(s_.get("startOffset")) == str(s_.get("endOffset")) for s_ in srcs):
                return
        time.sleep(0.5)
    raise TimeoutError("stream did not consume its input in time")


def run_foreach_batch(df: DataFrame, name: str, fn, output_mode: str = "update") -> str:
    """Run ``fn(batch_df, batch_id)`` per micro-batch to completion; returns
    the job's scratch folder."""
    spark = df.sparkSession
    base = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")
    w = (df.writeStream.outputMode(output_mode)
         .foreachBatch(lambda b, i: fn(b, i, base))
         .option("checkpointLocation", f"{base}/checkpoint"))
    with rocksdb_state(spark):
        q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return base


# The labels of the total count's rows.
TOTAL_LABELS = ("appMarket", "total")


# ---------------------------------------------------------------------------
# Window jobs

def stream_window_counts(timed: DataFrame, keys: list[str], size: str, slide: str | None,
                         name: str = "count") -> DataFrame:
    """A1 + W1-W6 on a stream.  Output: keys, window_start, window_end
    (timestamp_ntz), ``name``, ``event_time`` (window end - 1 us, the
    watermarked event time for chained stages).

    Tumbling and sparse sliding windows: native chained append-mode
    aggregates over slide-wide panes (one state entry per open window).
    Dense sliding windows (more than ``DENSE_OVERLAP`` windows per pane):
    :func:`sliding_counts_stream` (one state entry per pane).
    """
    slide = slide or size
    n = duration_us(size) // duration_us(slide)
    whole = duration_us(size) % duration_us(slide) == 0
    if n > DENSE_OVERLAP and whole:
        return sliding_counts_stream(timed, keys, size, slide, name, event_time_out=True)
    if not whole:
        # panes of the slide do not tile the window: place the rows themselves
        wins = (timed.groupBy(*keys, F.window("event_time", size, slide).alias("w"))
                .agg(F.count(F.lit(1)).alias(name)))
        return wins.select(*keys, to_ntz(F.col("w.start")).alias("window_start"),
                           to_ntz(F.col("w.end")).alias("window_end"), name,
                           F.window_time("w").alias("event_time"))
    panes = (timed.groupBy(*keys, F.window("event_time", slide).alias("pane"))
             .agg(F.count(F.lit(1)).alias("_c")))
    if slide == size:
        wins = panes.select(*keys, F.col("pane").alias("w"), F.col("_c").alias(name))
    else:
        wins = (panes.groupBy(*keys, F.window(F.window_time("pane"), size, slide).alias("w"))
                .agg(F.sum("_c").alias(name)))
    return wins.select(*keys, to_ntz(F.col("w.start")).alias("window_start"),
                       to_ntz(F.col("w.end")).alias("window_end"), name,
                       F.window_time("w").alias("event_time"))


def top_n_stream(wins: DataFrame, key: str, count_col: str, n: int, slide: str,
                 salt: int = 8) -> DataFrame:
    """W7 + K1 on a stream: the closed window counts regrouped by window end
    (a slide-wide window over their event time); ``row_number`` is not
    available on streams, so the ``n`` smallest ``struct(-count, key)`` are
    kept with ``collect_top_k``, whose buffer and state never hold more than
    ``n`` entries, however many keys a window end has.

    Two stages spread a window end's keys: first per (window end, key-hash
    bucket out of ``salt``), then per window end over at most ``salt * n``
    candidates.  Top-n of per-bucket top-n is the exact top-n.  The extra
    stage costs state per window end and bucket (bounded by time span /
    slide * salt); ``salt=1`` runs one stage, for key sets known to be small.
    """
    def ranked(df, groups, time_col):
        return (df.groupBy(F.window(time_col, slide).alias("g"), *groups)
                .agg(F.array_sort(InternalFunction.collect_top_k(F.struct(
                    (-F.col(count_col)).alias("neg"), F.col(key).alias("k"),
                    F.col(count_col).alias("c"), F.col("window_start").alias("ws"),
                    F.col("window_end").alias("we")), n, True)).alias("top")))
    if salt > 1:
        salted = wins.withColumn("_salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salt)))
        wins = (ranked(salted, ["_salt"], "event_time")
                .select(F.window_time("g").alias("event_time"), F.explode("top").alias("t"))
                .select("event_time", F.col("t.k").alias(key), F.col("t.c").alias(count_col),
                        F.col("t.ws").alias("window_start"), F.col("t.we").alias("window_end")))
    per_end = ranked(wins, [], "event_time")
    return (per_end.select(F.posexplode("top").alias("pos", "t"))
            .select(F.col("t.ws").alias("window_start"), F.col("t.we").alias("window_end"),
                    (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("t.k").alias(key), F.col("t.c").alias(count_col)))


# Above this many windows per pane the native chained aggregate (one state
# entry per open window) gives way to the pane processor.
DENSE_OVERLAP = 16


def sliding_counts_stream(timed: DataFrame, keys: list[str], size: str, slide: str,
                          name: str = "count", event_time_out: bool = False) -> DataFrame:
    """Dense sliding windows on a stream (W4-W6), pane form.

    A native tumbling aggregate reduces rows to slide-wide panes (partial
    aggregate before the shuffle, so a hot key arrives as pane counts, not
    rows); :class:`SlidingCountProcessor` keeps one state entry per pane and
    key and emits each closed window once.  ``timed`` must carry the
    watermarked ``event_time`` column.  Output: keys, window_start,
    window_end (timestamp_ntz), ``name`` (+ ``event_time`` = end - 1 us).
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    panes = (timed.groupBy(*keys, F.window("event_time", slide).alias("pane"))
             .agg(F.count(F.lit(1)).alias("cnt")))
    rows = panes.select(*keys, F.unix_micros(F.col("pane.start")).alias("ev_us"), "cnt",
                        F.col("pane"))
    fields = [timed.schema[k] for k in keys] + [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("count", T.LongType())]
    extra = {}
    if event_time_out:
        fields.append(T.StructField("event_time", T.TimestampType()))
        extra = {"eventTimeColumnName": "event_time"}
    out = (rows.groupBy(*keys).transformWithStateInPandas(
        SlidingCountProcessor(size_us, slide_us, keys, event_time_out),
        T.StructType(fields), "Append", "EventTime", **extra))
    return out.withColumnRenamed("count", name) if name != "count" else out


def sliding_top_stream(timed: DataFrame, key: str, n: int, size: str, slide: str, name: str,
                       buckets: int = 8, chunk: int = 16) -> DataFrame:
    """The ``n`` largest counts per sliding window and bucket of a string key's hash.

    Panes as in :func:`sliding_counts_stream`, grouped by stretches of
    ``chunk`` window sizes (panes near an edge are in two) and by bucket.  A
    group sees the whole counts of its keys when a window closes, so
    :class:`SlidingTopProcessor` ranks them at once and no other count leaves
    its task.  Output: key,
    window_start, window_end, ``name``, event_time (end - 1 us).
    """
    panes = (timed.groupBy(key, F.window("event_time", slide).alias("pane"))
             .agg(F.count(F.lit(1)).alias("cnt")))
    size_us, slide_us = duration_us(size), duration_us(slide)
    length = chunk * size_us
    rows = panes.select(key, F.unix_micros(F.col("pane.start")).alias("ev_us"), "cnt", "pane")
    rows = rows.withColumn("chunk", F.explode(F.sequence(
        F.floor((F.col("ev_us") - size_us + slide_us) / length), F.floor(F.col("ev_us") / length))))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    out = T.StructType([timed.schema[key], T.StructField("window_start", T.TimestampNTZType()),
                        T.StructField("window_end", T.TimestampNTZType()), T.StructField(name, T.LongType()),
                        T.StructField("event_time", T.TimestampType())])
    return rows.groupBy("chunk", "bucket").transformWithStateInPandas(
        SlidingTopProcessor(size_us, slide_us, key, n, name, chunk * size_us // slide_us), out, "Append", "EventTime",
        eventTimeColumnName="event_time")


def hot_items_stream(events: DataFrame, n: int = 3, size: str = "1 hour",
                     slide: str = "5 minutes") -> DataFrame:
    """J1 on a stream: views -> window counts -> top n per window end."""
    views = event_time(events.filter(F.col("behavior") == "view"), "ts")
    wins = stream_window_counts(views, ["item_id"], size, slide, "views")
    return top_n_stream(wins, "item_id", "views", n, slide)


def hot_urls_stream(logs: DataFrame, n: int = 5, size: str = "10 minutes",
                    slide: str = "5 seconds", delay: str = "61 seconds") -> DataFrame:
    """J2 on a stream: 1 s out-of-orderness plus 1 min allowed lateness
    become one 61 s watermark delay (T2 + T3); each window is ranked once,
    complete, when the watermark passes its end."""
    timed = event_time(logs, "ts", delay)
    return top_n_stream(sliding_top_stream(timed, "url", n, size, slide, "views"), "url", "views", n, slide, salt=1)


def pane_counts_stream(timed: DataFrame, keys: list[str], slide: str) -> DataFrame:
    """Update-mode counts per key and slide-wide pane: keys, pane (its start), n, last_ts (newest row in it)."""
    panes = (timed.groupBy(*keys, F.window("event_time", slide).alias("w"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("last_ts")))
    return panes.select(*keys, to_ntz(F.col("w.start")).alias("pane"), "n", to_ntz("last_ts").alias("last_ts"))


def hot_urls_table(logs: DataFrame, path: str, slide: str = "5 seconds", delay: str = "61 seconds",
                   buckets: int = 32) -> tuple[DataFrame, UpsertTable]:
    """Pane counts that late rows still correct, as a stream and the table it is to be merged into.

    A pane is corrected until the watermark (``delay`` behind the newest row) has
    passed it; :func:`rank_hot_urls` gives the ranking of what is there.
    """
    updates = pane_counts_stream(event_time(logs, "ts", delay), ["url"], slide)
    return updates, UpsertTable(path, ["url", "pane"], updates.schema, buckets)


def rank_hot_urls(panes: DataFrame, n: int = 5, size: str = "10 minutes", slide: str = "5 seconds",
                  first: str = "1 second") -> DataFrame:
    """The ranking now: windows that end ``first`` or more before the newest row, with all late rows so far."""
    newest = panes.agg(F.max("last_ts")).scalar()
    wins = window_count(panes, "url", "pane", size, slide, value="n", name="views")
    ready = wins.filter(F.col("window_end") <= newest - F.expr(f"INTERVAL {first}"))
    return top_n(ready, "url", n, count_col="views").select("window_start", "window_end", "rank", "url", "views")


def page_views_stream(events: DataFrame) -> DataFrame:
    """J3 on a stream: tumbling hour count of views."""
    views = event_time(events.filter(F.col("behavior") == "view"), "ts")
    return stream_window_counts(views, [], "1 hour", None, "pv").drop("event_time")


def unique_visitors_stream(events: DataFrame) -> DataFrame:
    """J4 on a stream: (window, user) groups, then users per window (chained)."""
    views = event_time(events.filter(F.col("behavior") == "view"), "ts")
    per_user = views.groupBy(F.window("event_time", "1 hour").alias("w"), "user_id").count()
    uv = (per_user.groupBy(F.window(F.window_time("w"), "1 hour").alias("w2"))
          .agg(F.count(F.lit(1)).alias("uv")))
    return uv.select(to_ntz(F.col("w2.start")).alias("window_start"),
                     to_ntz(F.col("w2.end")).alias("window_end"), "uv")


# ---------------------------------------------------------------------------
# Keyed-state jobs

def _with_us(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("ev_us", epoch_micros(df, ts))


RATE_OUT = T.StructType([T.StructField("seq", T.LongType()),
                         T.StructField("ts", T.TimestampNTZType()),
                         T.StructField("user_id", T.LongType()),
                         T.StructField("behavior", T.StringType()),
                         T.StructField("tag", T.StringType())])


# Buckets of keys for the processors that order rows first, at least, and the rows one is meant for; a
# stream keeps the number it started with.
BUCKETS, BUCKET_ROWS = 64, 200_000


def buckets_for(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Buckets for streams over tables, so that a bucket's state does not grow with them."""
    rows = sum(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").count() for name in names)
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def in_buckets(df: DataFrame, keys: list[str], buckets: int):
    """Grouped by a bucket of the keys' hash."""
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).groupBy("bucket")


def _types(df: DataFrame, keys: list[str]) -> dict[str, str]:
    return {k: df.schema[k].dataType.simpleString() for k in keys}


def rate_limit_stream(events: DataFrame, cap: int, keep_event_time: bool = False,
                      clock: str = "event", delay: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """T5 on a stream: the first ``cap`` rows per (user, behavior) and day pass, the next is reported.

    ``delay`` is how far rows may be out of order: a row is judged when the
    watermark has passed it, so the rows that pass are those of the batch form
    whatever the order inside the delay.

    ``clock="event"`` (default): days are event-time days, reproducible.
    ``clock="processing"``: the reference's reset at the wall clock's next
    UTC midnight (T8), with a processing-time timer.
    With ``keep_event_time`` the output carries ``event_time`` as its new
    event-time column, so windowed aggregates can be chained after it.
    """
    keys = ["user_id", "behavior"]
    ev = _with_us(events.select("seq", "ts", *keys), "ts").withColumn("ev_seq", F.col("seq"))
    if clock == "processing":
        return (ev.withColumn("ev_ts", F.col("ts")).groupBy(*keys).transformWithStateInPandas(
            ProcessingTimeCapProcessor(cap, keys), RATE_OUT, "Append", "ProcessingTime"))
    if clock != "event":
        raise ValueError("clock must be 'event' or 'processing'")
    ev = event_time(ev, "ts", delay).select(*keys, "ev_us", "ev_seq", "event_time")
    schema, extra = RATE_OUT, {}
    if keep_event_time:
        schema = T.StructType(RATE_OUT.fields + [T.StructField("event_time", T.TimestampType())])
        extra = {"eventTimeColumnName": "event_time"}
    return in_buckets(ev, keys, buckets).transformWithStateInPandas(
        CapProcessor(cap, _types(ev, keys), keep_event_time), schema, "Append", "EventTime", **extra)


def rate_limited_counts_stream(events: DataFrame, cap: int, size: str = "1 hour",
                               slide: str = "5 seconds", delay: str = "0 seconds",
                               buckets: int = BUCKETS) -> DataFrame:
    """J6 on a stream: click cap, then passed clicks per type and sliding
    window (pane form), chained after the stateful processor."""
    passed = rate_limit_stream(events, cap, keep_event_time=True, delay=delay,
                               buckets=buckets).filter(F.col("tag") == "pass")
    w = stream_window_counts(passed, ["behavior"], size, slide, "clicks")
    return w.select("behavior", "window_start", "window_end", "clicks")


def total_counts_stream(events: DataFrame, dropped: str, size: str = "1 hour",
                        slide: str = "10 seconds") -> DataFrame:
    """J8 on a stream: one count of all kept rows per sliding window, under constant labels.

    Rows are counted per pane before they meet, so the one key is a key of panes."""
    ev = event_time(events.filter(~F.col("behavior").eqNullSafe(dropped)), "ts")
    w = stream_window_counts(ev.withColumn("channel", F.lit(TOTAL_LABELS[0])), ["channel"], size, slide, "count")
    return w.select("channel", F.lit(TOTAL_LABELS[1]).alias("behavior"), "window_start", "window_end", "count")


def channel_counts_stream(events: DataFrame, dropped: str, size: str = "1 hour",
                          slide: str = "10 seconds") -> DataFrame:
    """J7 on a stream: count per (channel, behavior), sliding window."""
    ev = event_time(events.filter(~F.col("behavior").eqNullSafe(dropped)), "ts")
    w = stream_window_counts(ev, ["channel", "behavior"], size, slide, "count")
    return w.select("channel", "behavior", "window_start", "window_end", "count")


BURST_OUT = T.StructType([T.StructField("user_id", T.LongType()),
                          T.StructField("start_ts", T.TimestampNTZType()),
                          T.StructField("end_ts", T.TimestampNTZType()),
                          T.StructField("fails", T.LongType())])


def failure_bursts_stream(events: DataFrame, span: str, min_fails: int,
                          delay: str = "5 seconds", buckets: int = BUCKETS) -> DataFrame:
    """T6 on a stream: an open burst per user; rows may be ``delay`` out of order and are put in order first."""
    ev = _with_us(events.select("seq", "ts", "user_id", "behavior"), "ts")
    ev = ev.select("user_id", "ts", "ev_us", F.col("seq").alias("ev_seq"),
                   F.coalesce(F.col("behavior") == "error", F.lit(False)).alias("is_fail"))
    ev = event_time(ev, "ts", delay).drop("ts")
    return in_buckets(ev, ["user_id"], buckets).transformWithStateInPandas(
        BurstProcessor(duration_us(span), min_fails, "user_id", _types(ev, ["user_id"])["user_id"]),
        BURST_OUT, "Append", "EventTime")


FUNNEL_OUT = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("begin_ts", T.TimestampNTZType()),
                           T.StructField("begin_seq", T.LongType()),
                           T.StructField("follow_ts", T.TimestampNTZType()),
                           T.StructField("status", T.StringType())])


def funnel_stream(events: DataFrame, within: str, first: str = "click",
                  then: str = "purchase", delay: str = "0 seconds") -> DataFrame:
    """C2 on a stream: list state of open matches + a timer per match."""
    ev = _with_us(events.select("seq", "ts", "user_id", "behavior"), "ts")
    ev = ev.select("user_id", "ts", "ev_us", F.col("seq").alias("ev_seq"),
                   (F.col("behavior") == first).alias("is_first"),
                   (F.col("behavior") == then).alias("is_then"))
    ev = event_time(ev.filter(F.col("is_first") | F.col("is_then")), "ts", delay)
    return (ev.groupBy("user_id")
            .transformWithStateInPandas(FollowedByProcessor(duration_us(within), "user_id"),
                                        FUNNEL_OUT, "Append", "EventTime"))


REPEAT_OUT = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("begin_ts", T.TimestampNTZType()),
                           T.StructField("next_ts", T.TimestampNTZType()),
                           T.StructField("k", T.IntegerType())])


def repeats_stream(events: DataFrame, within: str = "2 seconds", times: tuple[int, int] = (2, 4),
                   behavior: str = "error", delay: str = "5 seconds") -> DataFrame:
    """C1 on a stream: strictly consecutive repeats per user, rows up to ``delay`` out of order."""
    ev = _with_us(events.select("seq", "ts", "user_id", "behavior"), "ts")
    ev = ev.select("user_id", "ts", "ev_us", F.col("seq").alias("ev_seq"),
                   F.coalesce(F.col("behavior") == behavior, F.lit(False)).alias("hit"))
    return (event_time(ev, "ts", delay).groupBy("user_id")
            .transformWithStateInPandas(RepeatProcessor(duration_us(within), times, "user_id"),
                                        REPEAT_OUT, "Append", "EventTime"))


# ---------------------------------------------------------------------------
# Stream-stream reconciliation (J-b)

def reconcile_stream(pays: DataFrame, receipts: DataFrame, key: str, pay_ts: str,
                     receipt_ts: str, tolerance: str, delay: str = "0 seconds") -> DataFrame:
    """J-b on streams: full outer join on the id with a +-tolerance time
    range; unmatched rows are emitted once the watermark rules out a match.
    A receipt without an id is an unmatched receipt."""
    p = event_time(pays.filter(nonempty_key(pays, key)), pay_ts, delay, "_pt")
    r = event_time(receipts, receipt_ts, delay, "_rt")
    p = p.select(F.col(key).alias("_pk"), pay_ts, "_pt")
    r = r.select(F.col(key).alias("_rk"), receipt_ts, "_rt")
    cond = ((F.col("_pk") == F.col("_rk"))
            & (F.col("_rt") >= F.col("_pt") - F.expr(f"INTERVAL {tolerance}"))
            & (F.col("_rt") <= F.col("_pt") + F.expr(f"INTERVAL {tolerance}")))
    j = p.join(r, cond, "full_outer")
    status = (F.when(F.col("_pt").isNotNull() & F.col("_rt").isNotNull(), F.lit("matched"))
              .when(F.col("_rt").isNull(), F.lit("unmatched_pay"))
              .otherwise(F.lit("unmatched_receipt")))
    return j.select(F.coalesce("_pk", "_rk").alias(key), pay_ts, receipt_ts,
                    status.alias("status"))


def reconcile_one_to_one_stream(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                                timeout: str, left_seq: str | None = None, right_seq: str | None = None,
                                delay: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """J-a on streams: every event meets at most one of the other side, within ``timeout``.

    Both inputs become one keyed stream with one pending event per id.  An
    event acts when the watermark (of the slower input) has passed it; a
    pending event is unmatched once the watermark is ``timeout`` behind it.
    Rows and labels are those of the batch form ``reconcile_one_to_one`` with
    the same timeout.  A receipt without an id is unmatched at once.
    """
    def side(df, ts, seq, no):
        timed = event_time(df, ts, delay).select(
            F.col(key).alias(key), epoch_micros(df, ts).alias("ev_us"),
            (F.col(seq) if seq else F.lit(0)).cast("long").alias("ev_seq"), F.lit(no).alias("side"), "event_time")
        return timed

    events = side(left.filter(nonempty_key(left, key)), left_ts, left_seq, 0).unionByName(
        side(right.filter(nonempty_key(right, key)), right_ts, right_seq, 1))
    out = T.StructType([events.schema[key], T.StructField(left_ts, T.TimestampNTZType()),
                        T.StructField(right_ts, T.TimestampNTZType()), T.StructField("status", T.StringType())])
    labels = {"matched": MATCHED, "unmatched_left": UNMATCHED_LEFT, "unmatched_right": UNMATCHED_RIGHT,
              "superseded_left": SUPERSEDED_LEFT, "superseded_right": SUPERSEDED_RIGHT}
    met = in_buckets(events, [key], buckets).transformWithStateInPandas(
        OneToOneProcessor(duration_us(timeout), key, _types(events, [key])[key], left_ts, right_ts, labels),
        out, "Append", "EventTime")
    alone = right.filter(~nonempty_key(right, key)).select(
        F.col(key), F.lit(None).cast("timestamp_ntz").alias(left_ts),
        from_micros(epoch_micros(right, right_ts)).alias(right_ts), F.lit(UNMATCHED_RIGHT).alias("status"))
    return met.unionByName(alone)


def window_join_stream(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: str,
                       delay: str = "0 seconds") -> DataFrame:
    """J-c on streams: inner join on the key and the tumbling window of the event times.

    The window is an equality of the join, so a watermark that has passed a
    window's end drops its rows from the state.
    """
    def side(df, ts):
        return event_time(df.filter(nonempty_key(df, key)), ts, delay, "_at").select(
            F.col(key).alias(key), F.col(ts).alias(ts), F.window("_at", size).alias("_w"))

    j = side(left, left_ts).join(side(right, right_ts), [key, "_w"], "inner")
    return j.select(key, to_ntz(F.col("_w.start")).alias("window_start"), to_ntz(F.col("_w.end")).alias("window_end"),
                    left_ts, right_ts)


# ---------------------------------------------------------------------------
# S7 keyed upsert sink

def upsert_by_key(batch: DataFrame, batch_id: int, base: str) -> None:
    """Write one micro-batch of updated rows as version ``batch_id``.

    Versions are partitions, overwritten dynamically, so a replayed batch
    replaces itself (idempotent).  Readers take the newest version per key
    (:func:`read_upserted`) from all that was ever written; ``UpsertTable``
    keeps current rows only."""
    (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(f"{base}/table"))


def read_upserted(spark: SparkSession, base: str, keys: list[str], schema: T.StructType
                  ) -> DataFrame:
    """Latest version per key of an upsert table written by :func:`upsert_by_key`."""
    from pyspark.sql import Window
    path = f"{base}/table"
    full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    if path_kind(spark, path) is None:
        return spark.createDataFrame([], schema)
    t = spark.read.schema(full).parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return (t.withColumn("_v", F.row_number().over(w)).filter(F.col("_v") == 1)
            .select(*[f.name for f in schema.fields]))


def uv_bitmap_updates(events: DataFrame, one_hash: bool = False) -> DataFrame:
    """S7 + A7 on a stream: per (hour, id bucket) a running bitmap of the
    users seen, emitted in update mode.  ``one_hash`` (A5): the bit is the
    offset of the one-hash bitmap, so colliding users count once."""
    views = event_time(events.filter(F.col("behavior") == "view"), "ts")
    bit = poly_hash("user_id") if one_hash else F.col("user_id")
    views = views.withColumn("bit", bit)
    return (views.groupBy(F.window("event_time", "1 hour").alias("w"),
                          F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bm"))
            .select(to_ntz(F.col("w.start")).alias("window_start"),
                    to_ntz(F.col("w.end")).alias("window_end"), "bucket", "bm"))
