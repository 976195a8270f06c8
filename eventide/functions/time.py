"""Time helpers (M5-M8) and duration handling.

Epoch arithmetic is done in microseconds with ``timestampdiff`` /
``timestampadd`` against a ``TIMESTAMP_NTZ`` epoch, which is exact and
independent of the session time zone for ``timestamp_ntz`` columns.  For
``timestamp`` (local time zone) columns ``unix_micros`` is used, which is an
absolute instant and therefore also zone independent.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}

_DURATION = re.compile(r"(-?\d+)\s*([a-z]+?)s?\b")



def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def duration_us(d: str | int) -> int:
    """'1 hour', '5 minutes', '10 seconds 500 milliseconds' -> microseconds.

    An int is taken as microseconds already.  The same strings are valid
    Spark interval / window duration strings.
    """
    if isinstance(d, int):
        return d
    total = 0
    found = False
    for num, unit in _DURATION.findall(d.strip().lower()):
        unit = unit.rstrip("s") if unit not in _UNITS_US else unit
        if unit not in _UNITS_US:
            raise ValueError(f"unknown duration unit in {d!r}")
        total += int(num) * _UNITS_US[unit]
        found = True
    if not found:
        raise ValueError(f"cannot read duration {d!r}")
    return total


def is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch for a timestamp or timestamp_ntz column."""
    if is_ntz(df, col):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), F.col(col))
    return F.unix_micros(F.col(col))


def from_micros(us: Column, ntz: bool = True) -> Column:
    """Inverse of :func:`epoch_micros`; ``ntz`` picks the result type."""
    if ntz:
        return F.timestamp_add("MICROSECOND", us, _epoch_ntz())
    return F.timestamp_micros(us)


def floor_div(x: Column, d: int) -> Column:
    """Exact floor division of a BIGINT column by a positive constant."""
    return F.call_function("div", x - F.pmod(x, F.lit(d)), F.lit(d))


def seconds_to_ts(col: Column) -> Column:
    """M6: epoch seconds (the reference multiplies by 1000) -> timestamp."""
    return F.timestamp_seconds(col)


def millis_to_text(col: Column) -> Column:
    """M7: epoch ms -> text the way ``java.sql.Timestamp.toString`` prints
    whole-second values ('yyyy-MM-dd HH:mm:ss.0')."""
    return F.date_format(F.timestamp_millis(col), "yyyy-MM-dd HH:mm:ss.S")


def ts_text(col: Column) -> Column:
    """Timestamp -> 'yyyy-MM-dd HH:mm:ss.S' (M7 for timestamp columns)."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.S")


_DAY_US = 86_400_000_000


def utc_day(df: DataFrame, col: str) -> Column:
    """Start of the UTC day of a timestamp column (same type), whatever the session's zone."""
    return from_micros(floor_div(epoch_micros(df, col), _DAY_US) * F.lit(_DAY_US), is_ntz(df, col))


def next_midnight(df: DataFrame, col: str) -> Column:
    """M8: the next UTC midnight after ``col``."""
    return from_micros((floor_div(epoch_micros(df, col), _DAY_US) + 1) * F.lit(_DAY_US), is_ntz(df, col))


def parse_log_time(col: Column, fmt: str = "dd/MM/yyyy:HH:mm:ss") -> Column:
    """M5: parse web-log time text; unparseable text gives NULL."""
    return F.try_to_timestamp(col, F.lit(fmt))
