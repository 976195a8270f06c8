"""Distinct visitors per window.

``window_distinct(df, id, ts, size, method)``:

* ``exact``   - ``count(DISTINCT id)``; Spark plans it as two aggregates
  (``(window, id)`` then ``window``), both with map-side partial combine, so
  a hot window is spread over its ids.
* ``bitmap``  - exact, mergeable bitmaps for integer ids of either sign (A7):
  ``bitmap_construct_agg`` per (window, 32768-id bucket), ``bitmap_count``
  summed over buckets.  Bounded memory per bucket (4 KiB).
* ``onehash`` - the reference's one-hash bitmap (A5): distinct offsets
  ``poly_hash(id)``; colliding ids count once, exactly as the external
  bitmap would count them.
* ``hll``     - HyperLogLog sketch (A6), bounded memory, approximate.

``sliding_distinct`` counts over sliding windows from mergeable parts: one
sketch (or bitmap) per slide-wide pane, merged over the panes of each window.
A row is used once, whatever the ratio of size and slide; only the panes'
parts are copied to their windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.hashing import DEFAULT_SEED, poly_hash
from eventide.functions.time import duration_us, epoch_micros, floor_div, from_micros, is_ntz
from eventide.operators.windows import _as_list, window_bounds


def window_distinct(df: DataFrame, id_col: str, ts: str, size: str, *,
                    keys=None, method: str = "exact", name: str = "uv",
                    seed: int = DEFAULT_SEED, capacity: int = 1 << 29,
                    lg_k: int = 12) -> DataFrame:
    keys = _as_list(keys)
    w = window_bounds(df, ts, size).alias("w")
    group = [F.col(k) for k in keys] + [w]
    if method == "exact":
        out = df.groupBy(*group).agg(F.count_distinct(id_col).alias(name))
    elif method == "onehash":
        out = df.groupBy(*group).agg(
            F.count_distinct(poly_hash(id_col, seed, capacity)).alias(name))
    elif method == "hll":
        out = df.groupBy(*group).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg(id_col, lg_k)).alias(name))
    elif method == "bitmap":
        per_bucket = (df.groupBy(*group, F.bitmap_bucket_number(id_col).alias("bucket"))
                      .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bm")))
        out = per_bucket.groupBy(*[F.col(k) for k in keys], "w").agg(
            F.sum(F.bitmap_count("bm")).alias(name))
    else:
        raise ValueError(f"unknown method {method!r}")
    return out.select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), name)


def sliding_distinct(df: DataFrame, id_col: str, ts: str, size: str | int, slide: str | int, *,
                     keys=None, method: str = "hll", name: str = "uv", lg_k: int = 12) -> DataFrame:
    """Distinct ids per key and sliding window; ``size`` is a multiple of ``slide``.

    ``hll``: a sketch per pane, merged by ``hll_union_agg``; relative standard
    error about ``1.04 / sqrt(2 ** lg_k)``, at most a few KiB a pane.
    ``bitmap``: exact for integer ids of either sign, a 4 KiB bitmap per pane
    and 32768 ids, merged by ``bitmap_or_agg``.

    Null ids are not counted.  ``hll`` gives a row with 0 to a window whose ids
    are all null; ``bitmap`` gives it none.
    Output: ``keys..., window_start, window_end, <name>``.
    """
    keys = _as_list(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us <= 0 or slide_us <= 0 or size_us % slide_us:
        raise ValueError("size must be a positive multiple of slide")
    if method not in ("hll", "bitmap"):
        raise ValueError(f"unknown method {method!r}")
    ntz = is_ntz(df, ts)
    timed = df.withColumn("_pane", floor_div(epoch_micros(df, ts), slide_us)).filter(F.col("_pane").isNotNull())
    group = [F.col(k) for k in keys]
    if method == "hll":
        parts = []
        part, merged = F.hll_sketch_agg(id_col, lg_k), F.hll_union_agg("_part")
    else:
        timed = (timed.filter(F.col(id_col).isNotNull())
                 .withColumn("_bucket", F.bitmap_bucket_number(id_col)))
        parts = [F.col("_bucket")]
        part, merged = F.bitmap_construct_agg(F.bitmap_bit_position(id_col)), F.bitmap_or_agg("_part")
    panes = timed.groupBy(*group, "_pane", *parts).agg(part.alias("_part"))
    starts = F.explode(F.sequence(F.col("_pane") - (size_us // slide_us - 1), F.col("_pane"))).alias("_ws")
    wins = panes.select(*group, *parts, starts, "_part").groupBy(*group, "_ws", *parts).agg(merged.alias("_part"))
    if method == "hll":
        wins = wins.withColumn(name, F.hll_sketch_estimate("_part"))
    else:
        wins = wins.groupBy(*group, "_ws").agg(F.sum(F.bitmap_count("_part")).alias(name))
    start = F.col("_ws") * F.lit(slide_us)
    return wins.select(*keys, from_micros(start, ntz).alias("window_start"),
                       from_micros(start + F.lit(size_us), ntz).alias("window_end"), name)
