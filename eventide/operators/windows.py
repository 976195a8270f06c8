"""Event-time window counts.

``window_count`` gives, for every non-empty window, the number of rows (or
the sum of a column) per key.  Windows are epoch aligned and half open,
``[start, start + size)``, like Spark's ``window`` function.

Two plans are available:

* ``method="direct"``: ``groupBy(keys, window(ts, size, slide))``.  Spark
  expands every row into ``size / slide`` copies before aggregating, which is
  fine for tumbling windows and small ratios.
* ``method="panes"`` (default for sliding windows): aggregate rows into
  slide-wide panes first (map-side partial aggregate, shuffle on
  ``(keys, pane)`` so a hot key is spread over its panes), then cut the line
  of windows into blocks.  A pane counts in the windows ``pane - n + 1 ..
  pane``, which touch two blocks at most; in each it becomes two change
  points, ``+c`` where its windows begin in the block and ``-c`` where they
  end, clipped at the block's borders.  So a prefix sum per key *and block*
  is exact on its own: no task holds more of a key than one block, the keyless
  count is spread over its blocks, and no offset has to travel between them.
  Each constant stretch of the sum is a run of windows with one count and is
  expanded where it is: all windows of a block (and of a key-hash bucket) end
  in one task, which lets a following top-N prune before its shuffle.

Sums of integers and decimals run over the same change points, with the number
of non-null values beside them.  Sums of floating-point values add up the panes
of every window instead, as taking a value off again is not exact (and a NaN
could not be taken off).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import (duration_us, epoch_micros, floor_div,
                                     from_micros, is_ntz)


# Windows per block, and buckets of the keys' hash that share a block's task.
BLOCK, SPREAD = 4096, 16


def _as_list(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def window_count(df: DataFrame, keys, ts: str, size: str | int,
                 slide: str | int | None = None, *, value: str | None = None,
                 name: str = "count", method: str = "auto") -> DataFrame:
    """Count (or sum ``value``) per key and event-time window.

    Output columns: ``keys..., window_start, window_end, <name>``; the window
    bounds have the type of ``ts`` (timestamp or timestamp_ntz).
    """
    keys = _as_list(keys)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us <= 0 or slide_us <= 0:
        raise ValueError("window size and slide must be positive")
    if method == "auto":
        method = "direct" if slide_us == size_us else "panes"
    if method == "panes" and size_us % slide_us != 0:
        method = "direct"           # panes need size to be a multiple of slide
    if method == "direct":
        return _direct(df, keys, ts, size_us, slide_us, value, name)
    if method != "panes":
        raise ValueError(f"unknown method {method!r}")
    return _panes(df, keys, ts, size_us, slide_us, value, name)


def _direct(df, keys, ts, size_us, slide_us, value, name):
    w = F.window(F.col(ts), f"{size_us} microseconds", f"{slide_us} microseconds")
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    out = df.groupBy(*[F.col(k) for k in keys], w.alias("w")).agg(agg.alias(name))
    return out.select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), name)


def _panes(df, keys, ts, size_us, slide_us, value, name):
    n = size_us // slide_us
    ntz = is_ntz(df, ts)
    slide_pane = floor_div(epoch_micros(df, ts), slide_us).alias("_pane")
    aggs = [F.count(F.lit(1)).alias("_c")]
    if value is not None:
        aggs += [F.sum(value).alias("_v"), F.count(value).alias("_m")]
    panes = df.groupBy(*[F.col(k) for k in keys], slide_pane).agg(*aggs)
    first = F.col("_pane") - (n - 1)
    if value is not None and isinstance(panes.schema["_v"].dataType, (T.DoubleType, T.FloatType)):
        wins = (panes.select(*keys, F.explode(F.sequence(first, F.col("_pane"))).alias("_ws"), "_v")
                .groupBy(*keys, "_ws").agg(F.sum("_v").alias(name)))
    else:
        wins = _block_sums(panes, keys, n, first, value is not None, name)
    start_us = F.col("_ws") * F.lit(slide_us)
    return wins.select(
        *keys,
        from_micros(start_us, ntz).alias("window_start"),
        from_micros(start_us + F.lit(size_us), ntz).alias("window_end"),
        name)


def _block_sums(panes, keys, n, first, summed, name):
    """Window starts ``_ws`` with their count or sum, by prefix sums inside blocks of windows."""
    block = max(BLOCK, n)
    blocks = F.sequence(floor_div(first, block), floor_div(F.col("_pane"), block))
    parts = ["_c"] + (["_v", "_m"] if summed else [])
    at = panes.select(*keys, "_pane", *parts, F.explode(blocks).alias("_b"),
                      F.pmod(F.xxhash64(*keys) if keys else F.lit(0), F.lit(SPREAD)).alias("_salt"))
    enter = F.struct(F.greatest(first, F.col("_b") * block).alias("_s"), *parts)
    leave = F.struct(F.least(F.col("_pane") + 1, (F.col("_b") + 1) * block).alias("_s"),
                     *[(-F.col(p)).alias(p) for p in parts])
    group = [*keys, "_b", "_salt"]
    # one exchange on (block, bucket of keys) serves the merge of change points and the prefix sums
    changes = (at.select(*group, F.explode(F.array(enter, leave)).alias("_e")).select(*group, "_e.*")
               .repartition("_b", "_salt").groupBy(*group, "_s").agg(*[F.sum(p).alias(p) for p in parts]))
    w = Window.partitionBy(*group).orderBy("_s")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = F.sum("_c").over(upto)
    if summed:
        kind = panes.schema["_v"].dataType
        result = F.when(F.sum("_m").over(upto) > 0, F.coalesce(F.sum("_v").over(upto), F.lit(0)).cast(kind))
    runs = (changes.withColumn("_n", F.sum("_c").over(upto)).withColumn("_result", result)
            .withColumn("_next", F.lead("_s").over(w)).filter(F.col("_n") > 0))
    return runs.select(*keys, F.explode(F.sequence(F.col("_s"), F.col("_next") - 1)).alias("_ws"),
                       F.col("_result").alias(name))


def tumbling_count(df: DataFrame, keys, ts: str, size: str | int, *,
                   value: str | None = None, name: str = "count") -> DataFrame:
    """W1/W2 + A1/A3: count per key and tumbling window."""
    return window_count(df, keys, ts, size, None, value=value, name=name,
                        method="direct")


def window_bounds(df: DataFrame, ts: str, size: str | int,
                  slide: str | int | None = None) -> Column:
    """P11 helper: the Spark ``window`` struct for ``ts``."""
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    return F.window(F.col(ts), f"{size_us} microseconds", f"{slide_us} microseconds")
