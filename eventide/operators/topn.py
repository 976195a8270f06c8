"""Top-N per window.

The reference regroups the per-key window counts by window end and sorts
every window's list.  Here the regrouping is a window function partitioned by
``window_end`` with ``row_number() <= n``: Catalyst turns that filter into a
partial ``WindowGroupLimit`` below the exchange, so each map task forwards at
most ``n`` rows per window end and no window's full key list is ever shuffled
or sorted in one place.

Ties: the reference orders by count only, so its tie order is arrival order.
Here the key ascending breaks ties, which makes the result deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.windows import _as_list


def top_n(counts: DataFrame, key, n: int, *, count_col: str = "count",
          group: str | list[str] = "window_end", rank_col: str = "rank") -> DataFrame:
    """Keep the ``n`` largest ``count_col`` rows per ``group``.

    Adds ``rank_col`` (1..n, INT).  ``key`` columns break ties ascending.
    """
    keys = _as_list(key)
    groups = _as_list(group)
    if n <= 0:
        raise ValueError("n must be positive")
    order = [F.col(count_col).desc()] + [F.col(k).asc() for k in keys]
    w = Window.partitionBy(*groups).orderBy(*order)
    return (counts.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= n))


# The streaming form (W7 + K1 with chained, salted aggregates) is
# eventide.streaming.jobs.top_n_stream.
