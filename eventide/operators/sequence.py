"""Per-key event-sequence detection.

All three operators look at each key's events in ``(ts, seq)`` order, where
``seq`` is the arrival order used as tie-break.  A plain
``Window.partitionBy(key)`` would put every event of a hot key into one task,
so each key's timeline is cut into time buckets instead: a row lives in its
own bucket and is copied into the neighbouring bucket when it lies within the
operator's look-back / look-ahead distance of the bucket border (the halo).
Windows then run per ``(key, bucket)`` and only rows of the bucket itself
produce output.  Because every operator here has a bounded temporal reach,
this is exact; a hot key is spread over ``time span / bucket`` groups.  The
default bucket is four times the operator's reach (``within`` / ``span``),
so the split is as fine as the operator allows at <= 25% copied rows.

Forward look-ups ("next event of a kind after this row") use a descending
order with a running frame, which Spark evaluates incrementally; frames that
end at ``UNBOUNDED FOLLOWING`` are re-evaluated per row and are avoided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import duration_us, epoch_micros, floor_div, is_ntz

MAX_LONG = (1 << 63) - 1


def _bucketed(df: DataFrame, us: str, bucket_us: int, before_us: int,
              after_us: int) -> DataFrame:
    """Copy rows into their own time bucket (``_own``) plus halo buckets.

    Bucket ``b`` then holds all rows of ``[b*B - before, (b+1)*B + after)``.
    """
    if bucket_us < max(before_us, after_us):
        raise ValueError("bucket must be at least as wide as the halo")
    own = floor_div(F.col(us), bucket_us)
    buckets = F.array_compact(F.array(
        own,
        F.when(F.col(us) >= (own + 1) * F.lit(bucket_us) - F.lit(before_us), own + 1),
        F.when(F.col(us) < own * F.lit(bucket_us) + F.lit(after_us), own - 1)))
    return (df.withColumn("_own_b", own)
            .withColumn("_b", F.explode(buckets))
            .withColumn("_own", F.col("_b") == F.col("_own_b"))
            .drop("_own_b"))


def _prepare(df: DataFrame, key: str, ts: str, seq: str, flags: dict[str, Column]):
    """Key, time, order and flags; an event without a time fails the job, as it has no place in a sequence."""
    cols = [F.col(key).alias("_k"), F.col(ts).alias("_ts"), F.col(seq).alias("_seq")]
    cols += [c.alias(n) for n, c in flags.items()]
    timed = F.coalesce(F.col("_ts"), F.raise_error(F.lit("an event has no time")).cast(df.schema[ts].dataType))
    ev = df.select(*cols).withColumn("_ts", timed)
    return ev.withColumn("_us", epoch_micros(ev, "_ts")), is_ntz(ev, "_ts")


def _bucket_width(bucket: str | int | None, *halo: int) -> int:
    """Bucket width: given, or ``AUTO_FACTOR`` times the widest halo.

    Narrow buckets split a hot key finely; the price is the halo copies,
    at most ``1 / AUTO_FACTOR`` of the rows per halo side.
    """
    widest = max(*halo, 1)
    if bucket is None or bucket == "auto":
        return max(AUTO_FACTOR * widest, MIN_BUCKET_US)
    return max(duration_us(bucket), widest)


AUTO_FACTOR = 4
MIN_BUCKET_US = 1_000_000


# ---------------------------------------------------------------------------
# begin(first).followedBy(then).within(w), with timeout branch.

def followed_by(df: DataFrame, key: str, ts: str, seq: str, first: Column,
                then: Column, within: str | int = "15 minutes",
                bucket: str | int | None = "auto") -> DataFrame:
    """Every ``first`` row is matched with the first ``then`` row after it.

    ``status`` is ``success`` when that row exists and is less than
    ``within`` later, else ``timeout`` (also at end of input).  A ``then``
    without a preceding ``first`` yields nothing.  Several ``first`` rows may
    share one ``then`` (each starts its own match).

    Output: key, begin_ts, begin_seq, follow_ts (NULL on timeout), status.
    """
    w_us = duration_us(within)
    # only these rows matter, and the filter reaches the scan
    ev, _ = _prepare(df.filter(first | then), key, ts, seq, {"_first": first, "_then": then})
    bk = _bucketed(ev, "_us", _bucket_width(bucket, w_us), 0, w_us)
    later = (Window.partitionBy("_k", "_b")
             .orderBy(F.col("_us").desc(), F.col("_seq").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.last(F.when(F.col("_then"), F.struct("_us", "_ts")), ignorenulls=True).over(later)
    m = (bk.withColumn("_next", nxt)
         .filter(F.col("_own") & F.col("_first")))
    ok = F.col("_next").isNotNull() & (F.col("_next._us") - F.col("_us") < w_us)
    return m.select(
        F.col("_k").alias(key),
        F.col("_ts").alias("begin_ts"),
        F.col("_seq").alias("begin_seq"),
        F.when(ok, F.col("_next._ts")).alias("follow_ts"),
        F.when(ok, F.lit("success")).otherwise(F.lit("timeout")).alias("status"))


# ---------------------------------------------------------------------------
# begin(p).next(p).within(w).times(lo, hi)

def repeat_match(df: DataFrame, key: str, ts: str, seq: str, pred: Column,
                 times: tuple[int, int] = (2, 4), within: str | int = "2 seconds",
                 bucket: str | int | None = "auto") -> DataFrame:
    """Strictly consecutive repeats of ``pred`` rows, every match emitted.

    A match starts at a ``pred`` row whose immediately next row (of any
    kind) is also a ``pred`` row, and takes ``k`` following ``pred`` rows
    (relaxed in between), ``lo <= k <= hi``, the last one less than
    ``within`` after the start.  One output row per ``(start, k)``:
    key, begin_ts, next_ts (the first repeat), k.
    """
    lo, hi = times
    if not 1 <= lo <= hi:
        raise ValueError("times must satisfy 1 <= lo <= hi")
    w_us = duration_us(within)
    ev, _ = _prepare(df, key, ts, seq, {"_p": pred})
    bk = _bucketed(ev, "_us", _bucket_width(bucket, w_us), 0, w_us)
    w = Window.partitionBy("_k", "_b").orderBy("_us", "_seq")
    strict = bk.withColumn("_next_p", F.lead("_p").over(w)).filter(F.col("_p"))
    leads = strict.select(
        "*", *[F.lead(F.struct("_us", "_ts"), j).over(w).alias(f"_n{j}")
               for j in range(1, hi + 1)])
    begins = leads.filter(F.col("_own") & F.col("_next_p"))
    ks = F.array(*[F.when(F.col(f"_n{k}._us") - F.col("_us") < w_us, F.lit(k))
                   for k in range(lo, hi + 1)])
    return (begins
            .select("_k", "_ts", "_n1", F.explode(F.array_compact(ks)).alias("k"))
            .select(F.col("_k").alias(key), F.col("_ts").alias("begin_ts"),
                    F.col("_n1._ts").alias("next_ts"), F.col("k").cast("int").alias("k")))


# ---------------------------------------------------------------------------
# Failure bursts with a timer.

def _burst_candidates(df, key, ts, seq, is_fail, span_us, bucket):
    """Per failure ``a`` (as if it started a burst): burst stats and ``nxt``.

    * forced: ``a`` starts a burst whatever happened before (first event,
      previous event not a failure, or previous failure more than span ago);
    * fails/last: failures in ``[a, a + span]``; cancelled: a non-failure in
      ``(a, a + span]`` (it clears the list before the timer fires);
    * nxt: the failure that starts the next burst of the same chain, i.e. the
      first event after ``a + span`` when it is a failure that is not itself
      forced (forced ones start their own chain).
    """
    ev, _ = _prepare(df, key, ts, seq, {"_f": is_fail})
    ev = ev.withColumn("_f", F.coalesce(F.col("_f"), F.lit(False)))
    bk = _bucketed(ev, "_us", _bucket_width(bucket, 2 * span_us), span_us, 2 * span_us)
    asc = Window.partitionBy("_k", "_b").orderBy("_us", "_seq")
    real = (bk
            .withColumn("_prev_f", F.lag("_f").over(asc))
            .withColumn("_prev_us", F.lag("_us").over(asc))
            .withColumn("_forced", F.col("_f") & (
                F.col("_prev_f").isNull() | ~F.col("_prev_f")
                | (F.col("_prev_us") < F.col("_us") - span_us)))
            .withColumn("_probe", F.lit(False))
            .withColumn("_src", F.col("_seq")))
    # One probe per own failure, placed after every event at a + span.
    probes = (real.filter(F.col("_own") & F.col("_f"))
              .select("_k", "_b", F.lit(None).cast("timestamp_ntz").alias("_ts"),
                      F.lit(MAX_LONG).alias("_seq"), F.lit(False).alias("_f"),
                      (F.col("_us") + span_us).alias("_us"), F.lit(True).alias("_own"),
                      F.lit(None).cast("boolean").alias("_prev_f"),
                      F.lit(None).cast("bigint").alias("_prev_us"),
                      F.lit(False).alias("_forced"), F.lit(True).alias("_probe"),
                      F.col("_seq").alias("_src")))
    probes = probes.withColumn("_ts", F.col("_ts").cast(real.schema["_ts"].dataType))
    allrows = real.unionByName(probes)
    upto = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_real = ~F.col("_probe")
    later = (Window.partitionBy("_k", "_b")
             .orderBy(F.col("_us").desc(), F.col("_seq").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    scanned = (allrows
               .withColumn("_cum_f", F.sum(F.when(is_real & F.col("_f"), 1).otherwise(0)).over(upto))
               .withColumn("_cum_s", F.sum(F.when(is_real & ~F.col("_f"), 1).otherwise(0)).over(upto))
               .withColumn("_last_f", F.last(F.when(is_real & F.col("_f"), F.col("_ts")),
                                             ignorenulls=True).over(upto))
               .withColumn("_next_e", F.last(F.when(is_real, F.struct("_seq", "_f", "_forced")),
                                             ignorenulls=True).over(later))
               .filter(F.col("_own")))
    anchors = scanned.filter(is_real & F.col("_f")).select(
        "_k", "_b", "_src", "_ts", "_forced",
        F.col("_cum_f").alias("_cf_a"), F.col("_cum_s").alias("_cs_a"))
    ends = scanned.filter(F.col("_probe")).select(
        "_k", "_b", "_src", F.col("_cum_f").alias("_cf_p"),
        F.col("_cum_s").alias("_cs_p"), F.col("_last_f").alias("_last"), "_next_e")
    cand = anchors.join(ends, ["_k", "_b", "_src"])
    cancelled = F.col("_cs_p") > F.col("_cs_a")
    nxt = F.when(~cancelled & F.col("_next_e._f") & ~F.col("_next_e._forced"),
                 F.col("_next_e._seq"))
    return cand.select(
        "_k", F.col("_src").alias("_id"), F.col("_ts").alias("_start"), "_forced",
        "_last", (F.col("_cf_p") - F.col("_cf_a") + 1).alias("_fails"),
        cancelled.alias("_cancelled"), nxt.alias("_nxt"))


def chain_closure(starts: DataFrame, links: DataFrame) -> DataFrame:
    """All nodes reachable from ``starts`` along ``links`` (pointer doubling).

    ``links``: ``_k, _id, _nxt`` (``_nxt`` NULL at a chain end); ``starts``:
    ``_k, _id``.  Chains must not merge.  Builds jump tables
    ``J_k = nxt^(2^k)`` by self-joins until one is empty, then widens the
    start set level by level, top down.  Work is O(nodes * log(chain
    length)); every level is checkpointed to cut lineage.
    """
    jumps = [links.select("_k", "_id", F.col("_nxt").alias("_j"))
             .filter(F.col("_j").isNotNull()).checkpoint()]
    while not jumps[-1].isEmpty():
        j = jumps[-1]
        nxt = (j.alias("x").join(j.alias("y"),
                                 (F.col("x._k") == F.col("y._k")) & (F.col("x._j") == F.col("y._id")))
               .select(F.col("x._k").alias("_k"), F.col("x._id").alias("_id"),
                       F.col("y._j").alias("_j")))
        jumps.append(nxt.checkpoint())
    reached = starts.select("_k", "_id").checkpoint()
    for j in reversed(jumps[:-1]):
        step = reached.join(j, ["_k", "_id"]).select("_k", F.col("_j").alias("_id"))
        reached = reached.unionByName(step).checkpoint()
    return reached


def failure_bursts(df: DataFrame, key: str, ts: str, seq: str, is_fail: Column,
                   min_fails: int = 2, span: str | int = "5 seconds",
                   bucket: str | int | None = "auto") -> DataFrame:
    """Bursts of failures per key.

    The first failure starts a burst and sets a timer at ``start + span``;
    failures up to the timer (inclusive) join it; any other event before the
    timer clears it; when the timer fires a burst with at least
    ``min_fails`` failures is reported.  The next failure after that starts
    a new burst.  Output: key, start_ts, end_ts (last failure), fails.
    """
    span_us = duration_us(span)
    cand = _burst_candidates(df, key, ts, seq, is_fail, span_us, bucket).checkpoint()
    starts = cand.filter(F.col("_forced")).select("_k", "_id")
    links = cand.select("_k", "_id", "_nxt")
    anchors = chain_closure(starts, links)
    bursts = cand.join(anchors, ["_k", "_id"]).filter(
        ~F.col("_cancelled") & (F.col("_fails") >= min_fails))
    return bursts.select(F.col("_k").alias(key), F.col("_start").alias("start_ts"),
                         F.col("_last").alias("end_ts"),
                         F.col("_fails").cast("bigint").alias("fails"))
