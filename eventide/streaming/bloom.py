"""First-seen test in bounded memory on a stream (A5, A6): a Bloom filter per window, in buckets of ids.

Every (window, bucket of the id's hash) holds one bit array and one count.  An
id is new if one of its ``k`` bits is not set yet; its bits are then set and it
is counted.  The state of a window is ``buckets`` arrays of fixed size, however
many rows it gets.

The count is never too high.  With ``capacity`` ids in a window an id that is
new is taken for a known one with probability ``fpp`` at most (to the evenness
of the buckets), so the count is low by ``fpp * capacity`` ids at most on
average; beyond ``capacity`` that share grows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from eventide.functions.time import duration_us, epoch_micros, floor_div, from_micros

# Executors need only numpy, pandas and pyspark.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def bloom_size(ids: float, fpp: float) -> tuple[int, int]:
    """(bits, hashes) of a Bloom filter that holds ``ids`` ids with false-positive probability ``fpp``."""
    if not (0 < fpp < 1) or ids <= 0:
        raise ValueError("0 < fpp < 1 and ids > 0 are needed")
    bits = math.ceil(-ids * math.log(fpp) / math.log(2) ** 2 / 8) * 8
    return bits, max(1, round(bits / ids * math.log(2)))


class FirstSeenProcessor(StatefulProcessor):
    """Keyed by (``win``, ``bucket``); rows carry two hashes ``h1`` and ``h2`` of an id.

    Emits the number of ids once the watermark has passed the window's end.
    """

    def __init__(self, size_us: int, bits: int, hashes: int):
        self.size_us, self.bits, self.hashes = size_us, bits, hashes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "bits binary, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues):
        if self.state.exists():
            raw, n = self.state.get()
            bits = np.frombuffer(raw, np.uint8).copy()
        else:
            bits, n = np.zeros(self.bits // 8, np.uint8), 0
            self.handle.registerTimer(-(-(int(key[0]) + self.size_us) // 1000))
        for frame in rows:
            ids = frame[["h1", "h2"]].drop_duplicates().to_numpy(np.int64).astype(np.uint64)
            # place i of an id is h1 + i * h2, with an odd step
            at = (ids[:, :1] + np.arange(self.hashes, dtype=np.uint64) * (ids[:, 1:] | np.uint64(1))) % np.uint64(self.bits)
            byte, bit = (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
            new = ((bits[byte] & bit) == 0).any(axis=1)
            np.bitwise_or.at(bits, byte[new].ravel(), bit[new].ravel())
            n += int(new.sum())
        self.state.update((bits.tobytes(), n))
        yield from ()

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        if self.state.exists():
            start, end = int(key[0]), int(key[0]) + self.size_us
            yield pd.DataFrame({"window_start": pd.to_datetime([start * 1000]), "window_end": pd.to_datetime([end * 1000]),
                                "n": [self.state.get()[1]],
                                "event_time": pd.to_datetime([(end - 1) * 1000]).tz_localize("UTC")})
            self.state.clear()

    def close(self) -> None:
        pass


FIRST_SEEN_OUT = T.StructType([T.StructField("window_start", T.TimestampNTZType()),
                               T.StructField("window_end", T.TimestampNTZType()),
                               T.StructField("n", T.LongType()), T.StructField("event_time", T.TimestampType())])


def distinct_bloom_stream(timed: DataFrame, id_col: str, size: str = "1 hour", capacity: int = 1_000_000,
                          fpp: float = 1e-4, buckets: int = 16, name: str = "uv") -> DataFrame:
    """Ids seen first per tumbling window.  ``timed`` carries the watermarked ``event_time``.

    Null ids are not counted; a window without an id gives no row.
    Output: window_start, window_end (timestamp_ntz), ``name``.
    """
    size_us = duration_us(size)
    bits, hashes = bloom_size(capacity / buckets, fpp)
    rows = timed.filter(F.col(id_col).isNotNull()).select(
        (floor_div(epoch_micros(timed, "event_time"), size_us) * size_us).alias("win"),
        F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(buckets)).cast("int").alias("bucket"),
        F.xxhash64(id_col).alias("h1"), F.xxhash64(id_col, F.lit(2)).alias("h2"), "event_time")
    seen = rows.groupBy("win", "bucket").transformWithStateInPandas(
        FirstSeenProcessor(size_us, bits, hashes), FIRST_SEEN_OUT, "Append", "EventTime",
        eventTimeColumnName="event_time")
    per = seen.groupBy(F.window("event_time", size).alias("w")).agg(F.sum("n").alias(name))
    return per.select(from_micros(F.unix_micros(F.col("w.start"))).alias("window_start"),
                      from_micros(F.unix_micros(F.col("w.end"))).alias("window_end"), name)
