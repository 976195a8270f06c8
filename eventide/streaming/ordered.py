"""Processors that put rows back in order before they act (T2, T5, T6, J-a).

A row waits in state until the watermark has passed it: nothing earlier can
come then, so the outcome is that of the batch form for every arrival order
inside the watermark's delay.  The rows that became final are folded at once,
with numpy over all keys of a bucket; no row is looked at alone.

Input is grouped by a ``bucket`` of the key's hash, not by the key, so one
call serves many keys and one key still meets in one place.  A bucket's state
holds its waiting rows and what the fold needs of earlier ones, as one binary
value of numpy columns (lists would be boxed value by value on both sides of
the state store); it is written again when rows or a timer reach the bucket.
More rows want more buckets.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

# Executors need only numpy, pandas and pyspark.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_US = 86_400_000_000


def _times(us) -> pd.DatetimeIndex:
    return pd.to_datetime(np.asarray(us, np.int64) * 1000)


class OrderedProcessor(StatefulProcessor):
    """Base: ``held`` is a frame of rows (``ev_us`` among the columns) kept between calls.

    ``columns`` maps the held columns to SQL types.  A subclass gives
    ``fold(rows, now_us) -> (output frame or None, rows to hold, time of the
    next change or None)``; rows with ``ev_us <= now_us`` are final.
    """

    def __init__(self, columns: dict[str, str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("held", "columns binary, timer long")

    def _load(self):
        if not self.state.exists():
            return None, None
        columns, timer = self.state.get()
        return pd.DataFrame(pickle.loads(columns)), timer

    def _run(self, rows: pd.DataFrame, timer, now_ms: int):
        out, held, due = self.fold(rows, now_ms * 1000)
        if timer is not None:
            self.handle.deleteTimer(timer)
        if len(held):
            waiting = held["ev_us"].to_numpy(np.int64)
            waiting = waiting[waiting > now_ms * 1000]
            changes = ([int(waiting.min())] if len(waiting) else []) + ([int(due)] if due is not None else [])
            timer = max(-(-min(changes) // 1000), now_ms + 1)
            self.handle.registerTimer(timer)
            whole = ("long", "bigint", "int")       # a frame without rows may have lost its types
            self.state.update((pickle.dumps({c: (held[c].astype(np.int64) if t in whole else held[c]).to_numpy()
                                             for c, t in self.columns.items()}, protocol=5), timer))
        else:
            self.state.clear()
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues):
        held, timer = self._load()
        frames = [f[list(self.columns)] for f in self.ready(rows)]
        out = self._run(pd.concat(([held] if held is not None else []) + frames, ignore_index=True), timer,
                        timerValues.getCurrentWatermarkInMs())
        if out is not None and len(out):
            yield out

    def ready(self, frames):
        """Input frames with all held columns."""
        return frames

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo: ExpiredTimerInfo):
        held, _ = self._load()
        if held is None:
            return
        out = self._run(held, None, timerValues.getCurrentWatermarkInMs())
        if out is not None and len(out):
            yield out

    def close(self) -> None:
        pass


class CapProcessor(OrderedProcessor):
    """T5: per key and event day the first ``cap`` rows pass, the next is tagged ``blacklist``.

    Held: waiting rows, and per key and open day one row with the number of
    rows seen (``seen`` > 0, at most cap + 1).  A day goes once it is past.
    """

    def __init__(self, cap: int, keys: dict[str, str], keep_event_time: bool = False):
        super().__init__({**keys, "ev_us": "long", "ev_seq": "long", "seen": "long"})
        self.cap, self.keys, self.keep_event_time = cap, list(keys), keep_event_time

    def ready(self, frames):
        return (f.assign(seen=0) for f in frames)

    def fold(self, rows, now_us):
        final = (rows["ev_us"] <= now_us) | (rows["seen"] > 0)
        wait, rows = rows[~final], rows[final]
        rows = rows.assign(day=rows["ev_us"] // DAY_US).sort_values(["ev_us", "ev_seq"], kind="stable")
        group = [*self.keys, "day"]
        # the row of a day's count stands for that many earlier rows
        counted = rows["seen"] > 0
        new = rows[~counted].copy()
        before = rows[counted].groupby(group, dropna=False)["seen"].sum().rename("before").reset_index()
        new = new.merge(before, "left", on=group)
        new["place"] = new.groupby(group, dropna=False).cumcount() + new["before"].fillna(0).astype(np.int64)
        new = new[new["place"] <= self.cap]
        out = None
        if len(new):
            out = pd.DataFrame({"seq": new["ev_seq"], "ts": _times(new["ev_us"])})
            for k in self.keys:
                out[k] = new[k].to_numpy()
            out["tag"] = np.where(new["place"] < self.cap, "pass", "blacklist")
            if self.keep_event_time:
                out["event_time"] = _times(new["ev_us"]).tz_localize("UTC")
        rows.loc[~counted, "seen"] = 1
        seen = rows.groupby(group, dropna=False)["seen"].sum().clip(upper=self.cap + 1).reset_index()
        seen = seen[(seen["day"] + 1) * DAY_US > now_us]
        # a count is placed at its day's last microsecond, so that it waits for the day's end
        seen = seen.assign(ev_us=(seen["day"] + 1) * DAY_US - 1, ev_seq=0)
        return out, pd.concat([wait, seen[list(self.columns)]], ignore_index=True)[list(self.columns)], None


class BurstProcessor(OrderedProcessor):
    """The first failure opens a burst; failures up to ``span`` later join it; another event inside
    the span wipes it; it is reported (``min_fails`` or more) once something later or the watermark closes it.

    Held: waiting rows, and an open burst as its first and last failure with
    the number of failures they stand for (``n``).
    """

    def __init__(self, span_us: int, min_fails: int, key: str, key_type: str):
        super().__init__({key: key_type, "ev_us": "long", "ev_seq": "long", "is_fail": "boolean", "n": "long"})
        self.span, self.min_fails, self.key = span_us, min_fails, key

    def ready(self, frames):
        return (f.assign(n=1) for f in frames)

    def fold(self, rows, now_us):
        rows = rows.assign(k=pd.factorize(rows[self.key], use_na_sentinel=False)[0])
        rows = rows.sort_values(["k", "ev_us", "ev_seq"], kind="stable", ignore_index=True)
        final = (rows["ev_us"] <= now_us).to_numpy()
        wait, rows = rows[~final], rows[final].reset_index(drop=True)
        k, us = rows["k"].to_numpy(), rows["ev_us"].to_numpy(np.int64)
        fail, total = rows["is_fail"].to_numpy(bool), np.concatenate([[0], np.cumsum(rows["n"].to_numpy(np.int64))])
        # stretches of failures of one key, and where in each a span that starts at a row ends
        edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (fail[1:] != fail[:-1])])) if len(k) else []
        ends = np.append(edge[1:], len(k)) if len(k) else []
        step = 1 + (int(us.max() - us.min()) + self.span if len(us) else 0)
        stretch = np.zeros(len(k), np.int64)
        stretch[edge[1:] if len(k) else []] = 1
        line = (us - us.min() if len(us) else us) + np.cumsum(stretch) * step
        after = np.searchsorted(line, line + self.span, side="right").tolist()
        found, held, due = [], [], None
        for lo, hi in zip(edge, ends):
            if not fail[lo]:
                continue
            closed_by = us[hi] if hi < len(k) and k[hi] == k[lo] else None
            i = int(lo)
            while i < hi:
                j, limit = min(after[i], int(hi)), us[i] + self.span
                if j < hi or (closed_by is not None and closed_by > limit) or (closed_by is None and limit <= now_us):
                    if total[j] - total[i] >= self.min_fails:
                        found.append((i, j - 1, total[j] - total[i]))
                elif closed_by is None:
                    due = limit if due is None else min(due, limit)
                    held.append((i, total[j] - total[i] - (j - 1 > i)))
                    if j - 1 > i:
                        held.append((j - 1, 1))
                i = j
        out = None
        if found:
            first, last, n = (np.asarray(x) for x in zip(*found))
            out = pd.DataFrame({self.key: rows[self.key].to_numpy()[first], "start_ts": _times(us[first]),
                                "end_ts": _times(us[last]), "fails": n})
        open_rows = rows.iloc[[i for i, _ in held]].assign(n=[n for _, n in held])
        return out, pd.concat([open_rows, wait], ignore_index=True)[list(self.columns)], due


class OneToOneProcessor(OrderedProcessor):
    """J-a: two inputs in one stream (``side`` 0 and 1), one partner each.

    Per key, in the order of (time, side, seq): an event meets the pending
    event if that is of the other side and not older than ``timeout``; else it
    becomes the pending event.  The pending event is always the one before, or
    none.  So an event meets its predecessor exactly if its place in a stretch
    of changing sides, each within the timeout of the last, is odd.

    Held: waiting rows and pending events, an id's one at most.
    """

    def __init__(self, timeout_us: int, key: str, key_type: str, left_ts: str, right_ts: str, labels: dict[str, str]):
        super().__init__({key: key_type, "ev_us": "long", "ev_seq": "long", "side": "int"})
        self.timeout, self.key, self.left_ts, self.right_ts, self.labels = timeout_us, key, left_ts, right_ts, labels

    def fold(self, rows, now_us):
        rows = rows.assign(k=pd.factorize(rows[self.key], use_na_sentinel=False)[0])
        rows = rows.sort_values(["k", "ev_us", "side", "ev_seq"], kind="stable", ignore_index=True)
        final = (rows["ev_us"] <= now_us).to_numpy()
        wait, rows = rows[~final], rows[final].reset_index(drop=True)
        k, us, side = (rows[c].to_numpy() for c in ("k", "ev_us", "side"))
        at = np.arange(len(k))
        near = np.zeros(len(k), bool)           # follows an event of its key within the timeout
        near[1:] = (k[1:] == k[:-1]) & (us[1:] - us[:-1] <= self.timeout)
        turn = near.copy()
        turn[1:] &= side[1:] != side[:-1]
        met = (at - np.maximum.accumulate(np.where(turn, 0, at))) % 2 == 1
        alone = ~met
        takes = np.append(met[1:], False) & alone
        replaced = np.append(near[1:], False) & alone & ~takes
        last = np.append(k[1:] != k[:-1], True) if len(k) else np.zeros(0, bool)
        is_open = alone & ~takes & ~replaced & last & (us + self.timeout > now_us)
        done = alone & ~is_open
        i = np.flatnonzero(done)
        partner = np.minimum(i + 1, len(k) - 1)
        name = np.where(takes[i], self.labels["matched"], np.where(
            replaced[i], np.where(side[i] == 0, self.labels["superseded_left"], self.labels["superseded_right"]),
            np.where(side[i] == 0, self.labels["unmatched_left"], self.labels["unmatched_right"])))
        times = {s: pd.Series(_times(np.where(side[i] == s, us[i], us[partner]))).where((side[i] == s) | takes[i])
                 for s in (0, 1)} if len(i) else None
        out = pd.DataFrame({self.key: rows[self.key].to_numpy()[i], self.left_ts: times[0], self.right_ts: times[1],
                            "status": name}) if len(i) else None
        due = int(us[is_open].min() + self.timeout) if is_open.any() else None
        return out, pd.concat([rows[is_open], wait], ignore_index=True)[list(self.columns)], due
