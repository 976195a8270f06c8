"""Per-key daily click cap with blacklist.

Per ``(keys, day)`` the first ``cap`` events in ``(ts, seq)`` order pass, the
next one raises one blacklist row, the rest are dropped until the day ends.
The reference resets at processing-time midnight; the batch form resets at
the event-time day (UTC), which makes a replay reproducible.

Plan: ``row_number() OVER (PARTITION BY keys, day ORDER BY ts, seq) <= cap+1``
is recognised by Catalyst as a group limit, so a partial ``WindowGroupLimit``
runs before the shuffle and each map task forwards at most ``cap + 1`` rows
per key and day.  A key holding a third of all rows therefore costs
``cap + 1`` rows per map task in the exchange, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import utc_day
from eventide.operators.windows import _as_list

# Status codes of the two outputs (the reference prints a warning text).
BLACKLIST_MSG = "blacklisted: too many clicks"


def rate_limit(df: DataFrame, keys, ts: str, seq: str, cap: int = 100
               ) -> tuple[DataFrame, DataFrame]:
    """Return ``(passed, blacklist)``.

    ``passed``: the input rows that pass the cap (input columns).
    ``blacklist``: one row per ``(keys, day)`` whose count exceeded ``cap``:
    ``keys..., day, ts (of the first refused event), msg``.
    """
    keys = _as_list(keys)
    if cap < 0:
        raise ValueError("cap must be >= 0")
    cols = df.columns
    day = utc_day(df, ts)
    w = Window.partitionBy(*keys, day).orderBy(F.col(ts), F.col(seq))
    ranked = (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= cap + 1))
    passed = ranked.filter(F.col("_rn") <= cap).select(*cols)
    blacklist = ranked.filter(F.col("_rn") == cap + 1).select(
        *keys, day.alias("day"), F.col(ts).alias("ts"),
        F.lit(BLACKLIST_MSG).alias("msg"))
    return passed, blacklist
