"""Two-stream reconciliation (J-a, J-b, J-c, P8, S6 tagging).

``reconcile`` pairs payments and receipts on the transaction id and reports
both unmatched sides, the batch meaning of the reference's co-process with
two value states and timers:

* ``tolerance=None`` (J-a): unbounded full outer equi-join.  With the
  reference's receipt stream carrying no watermark, its timers only fire at
  end of input, so this is what the reference actually computes.
* ``tolerance="5 seconds"`` (J-b): a pair only matches when the receipt is
  within +-tolerance of the payment (an outer interval join); otherwise both
  rows are reported unmatched.

Plan without a tolerance: one sort-merge (or AQE-chosen) full outer join on
the id.  With one, the join is on (id, stretch of time), so that an id with
very many events is spread over its stretches: a payment lies in one stretch of
``STRETCH`` tolerances, a receipt is copied into the next one where a payment
there could be in reach.  Each pair is thus met once.  Copies that stay alone
are counted by (id, time): a receipt is unmatched if it is in all its stretches.
Ids are taken as unique per side, as the reference's single value state
assumes; ``dedupe=True`` first keeps the latest event per id and side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import duration_us, epoch_micros, floor_div, from_micros, is_ntz

MATCHED = "matched"
UNMATCHED_LEFT = "unmatched_pay"
UNMATCHED_RIGHT = "unmatched_receipt"

# Length of a stretch of time in tolerances: a receipt has 1 + 2 / STRETCH copies on average.
STRETCH = 8


def nonempty_key(df: DataFrame, key: str) -> Column:
    """The reference drops events whose transaction id is ``""``; a NULL
    id (how Spark's CSV reader reads an empty cell) is dropped too."""
    c = F.col(key)
    if isinstance(df.schema[key].dataType, T.StringType):
        return F.coalesce(c, F.lit("")) != ""
    return c.isNotNull()


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per id, the latest by ``ts`` (the reference's value state keeps
    the last unmatched event of a side).  A partial aggregate before the
    shuffle, so an id repeated a billion times costs one row per task."""
    return df.groupBy(key).agg(F.max(ts).alias(ts))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_ts: str,
              right_ts: str, tolerance: str | int | None = None,
              dedupe: bool = False) -> DataFrame:
    """Full outer reconciliation; output: key, left_ts, right_ts, status.

    With ``dedupe=True`` each side is first reduced to its latest event per
    id; use it when ids may repeat on a side.  Receipts without an id all stay.
    """
    lf = left.filter(nonempty_key(left, key)).select(
        F.col(key).alias("_lk"), F.col(left_ts).alias(left_ts))
    # receipts without an id match nothing, but they are reported
    rt = right.select(F.col(key).alias("_rk"), F.col(right_ts).alias(right_ts))
    if dedupe:
        lf = latest_per_key(lf, "_lk", left_ts)
        named = nonempty_key(rt, "_rk")
        rt = latest_per_key(rt.filter(named), "_rk", right_ts).unionByName(rt.filter(~named))
    if tolerance is not None:
        return _band_join(lf, rt, key, left_ts, right_ts, duration_us(tolerance))
    lf, rt = lf.withColumn("_l", F.lit(True)), rt.withColumn("_r", F.lit(True))
    j = lf.join(rt, F.col("_lk") == F.col("_rk"), "full_outer")
    return j.select(F.coalesce("_lk", "_rk").alias(key), left_ts, right_ts, _status().alias("status"))


def _status() -> Column:
    return (F.when(F.col("_l") & F.col("_r"), F.lit(MATCHED))
            .when(F.col("_r").isNull(), F.lit(UNMATCHED_LEFT))
            .otherwise(F.lit(UNMATCHED_RIGHT)))


def _band_join(lf, rt, key, left_ts, right_ts, tol):
    """Full outer join on the id and ``|left - right| <= tol``, by (id, stretch of time).

    A row without a time, or a receipt without an id, meets nothing and is unmatched.
    """
    width = STRETCH * max(tol, 1)
    lf = (lf.withColumn("_lus", epoch_micros(lf, left_ts)).withColumn("_l", F.lit(True))
          .withColumn("_lb", floor_div(F.col("_lus"), width)))
    rt = rt.withColumn("_rus", epoch_micros(rt, right_ts)).withColumn("_r", F.lit(True))
    able = F.col("_rk").isNotNull() & F.col("_rus").isNotNull()
    lo, hi = (floor_div(F.col("_rus") + d, width) for d in (-tol, tol))
    copies = (rt.filter(able).withColumn("_lo", lo).withColumn("_hi", hi)
              .withColumn("_rb", F.explode(F.sequence("_lo", "_hi"))))
    cond = ((F.col("_lk") == F.col("_rk")) & (F.col("_lb") == F.col("_rb"))
            & F.col("_rus").between(F.col("_lus") - tol, F.col("_lus") + tol))
    # the copies' stretch, and whether there are two of them, are told apart only where a copy stayed alone
    j = lf.join(copies, cond, "full_outer").select(
        F.coalesce("_lk", "_rk").alias(key), left_ts, right_ts, "_l", "_r", "_lo", "_hi", "_rb")
    sure = F.col("_l").isNotNull() | (F.col("_lo") == F.col("_hi"))
    done = j.filter(sure).select(key, left_ts, right_ts, _status().alias("status"))
    first = F.col("_rb") == F.col("_lo")
    alone = (j.filter(F.col("_l").isNull() & (F.col("_lo") != F.col("_hi"))).groupBy(key, right_ts)
             .agg(F.count_if(first).alias("_n"), F.count_if(~first).alias("_m"))
             .filter((F.col("_n") > 0) & (F.col("_m") > 0)))
    blank = F.lit(None).cast(lf.schema[left_ts].dataType).alias(left_ts)
    lonely = F.lit(UNMATCHED_RIGHT).alias("status")
    alone = (alone.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
             .select(key, blank, right_ts, lonely))
    unable = rt.filter(~able).select(F.col("_rk").cast(done.schema[key].dataType).alias(key), blank, right_ts, lonely)
    return done.unionByName(alone).unionByName(unable)


def split_outputs(tagged: DataFrame, tag: str = "status") -> dict[str, DataFrame]:
    """S6 in batch: one DataFrame per side output tag."""
    return {t: tagged.filter(F.col(tag) == t)
            for t in (MATCHED, UNMATCHED_LEFT, UNMATCHED_RIGHT)}


def window_join(left: DataFrame, right: DataFrame, key: str, left_ts: str,
                right_ts: str, size: str | int) -> DataFrame:
    """J-c: inner join of the two streams on ``(key, tumbling window)``.

    Both events must fall into the same epoch-aligned window of ``size``.
    Output: key, window_start, window_end, left_ts, right_ts.
    """
    size_us = duration_us(size)
    ntz = is_ntz(left, left_ts)
    lf = left.filter(nonempty_key(left, key)).select(
        F.col(key).alias(key), left_ts,
        floor_div(epoch_micros(left, left_ts), size_us).alias("_w"))
    rt = right.select(
        F.col(key).alias(key), right_ts,
        floor_div(epoch_micros(right, right_ts), size_us).alias("_w"))
    j = lf.join(rt, [key, "_w"], "inner")
    start = F.col("_w") * F.lit(size_us)
    return j.select(key, from_micros(start, ntz).alias("window_start"),
                    from_micros(start + F.lit(size_us), ntz).alias("window_end"),
                    left_ts, right_ts)


SUPERSEDED_LEFT = "superseded_pay"
SUPERSEDED_RIGHT = "superseded_receipt"


def reconcile_one_to_one(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                         left_seq: str | None = None, right_seq: str | None = None,
                         timeout: str | int | None = None) -> DataFrame:
    """J-a with one partner each: every match uses up both events.

    Per id the events of both sides are taken in the order of (time, side,
    seq).  An event meets the other side's pending event, if there is one;
    else it becomes its side's pending event and supersedes an earlier one.
    With a ``timeout`` a pending event waits that long (inclusive) and is
    unmatched after it.  The reference forgets a superseded event; here it
    gets a row of its own, so every event with an id is in exactly one row.

    Window passes instead of a fold: the pending event is always the one
    before, or none.  So an event meets its predecessor exactly if its place
    in a stretch of changing sides, each within the timeout, is odd.

    Output: key, left_ts, right_ts, status.  One id's events are one ordered
    history and meet in one task; ids are spread over all tasks.  Receipts
    without an id match nothing; they go round the window passes.
    """
    def side(df, ts, seq, no):
        us = F.col(ts) if timeout is None else epoch_micros(df, ts)     # any ordered type without a timeout
        return df.select(F.col(key).alias("_k"), F.col(ts).alias("_ts"), us.alias("_us"),
                         F.lit(no).alias("_side"), (F.col(seq).cast("long") if seq else F.lit(0).cast("long")).alias("_seq"))

    events = side(left.filter(nonempty_key(left, key)), left_ts, left_seq, 0).unionByName(
        side(right.filter(nonempty_key(right, key)), right_ts, right_seq, 1))
    order = Window.partitionBy("_k").orderBy("_us", "_side", "_seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    last_us = F.lag("_us").over(order)
    near = (F.lag("_no").over(order).isNotNull() if timeout is None
            else F.coalesce(F.col("_us") - last_us <= duration_us(timeout), F.lit(False)))
    rows = (events.withColumn("_no", F.row_number().over(order)).withColumn("_near", near)
            .withColumn("_turn", F.col("_near") & (F.lag("_side").over(order) != F.col("_side")))
            .withColumn("_from", F.max(F.when(~F.col("_turn"), F.col("_no"))).over(so_far))
            .withColumn("_met", (F.col("_no") - F.col("_from")) % 2 == 1)
            .withColumn("_takes", F.coalesce(F.lead("_met").over(order), F.lit(False)))
            .withColumn("_followed", F.coalesce(F.lead("_near").over(order), F.lit(False)))
            .withColumn("_next_ts", F.lead("_ts").over(order)).filter(~F.col("_met")))
    is_left, both = F.col("_side") == 0, F.col("_takes")
    status = (F.when(both, F.lit(MATCHED))
              .when(F.col("_followed"), F.when(is_left, SUPERSEDED_LEFT).otherwise(SUPERSEDED_RIGHT))
              .otherwise(F.when(is_left, UNMATCHED_LEFT).otherwise(UNMATCHED_RIGHT)))
    rows = rows.select(
        F.col("_k").alias(key),
        F.when(is_left, F.col("_ts")).when(both, F.col("_next_ts")).alias(left_ts),
        F.when(~is_left, F.col("_ts")).when(both, F.col("_next_ts")).alias(right_ts), status.alias("status"))
    alone = right.filter(~nonempty_key(right, key)).select(
        F.col(key).cast(rows.schema[key].dataType).alias(key),
        F.lit(None).cast(rows.schema[left_ts].dataType).alias(left_ts),
        F.col(right_ts).cast(rows.schema[right_ts].dataType).alias(right_ts), F.lit(UNMATCHED_RIGHT).alias("status"))
    return rows.unionByName(alone)
