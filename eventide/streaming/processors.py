"""Keyed stateful processors for Structured Streaming.

Used with ``groupBy(key).transformWithStateInPandas(...)``.  Each call gets
one key's rows of one micro-batch; rows are put in ``(ts, seq)`` order and
folded into the key's state, which lives in Spark's state store (RocksDB),
so it survives executor loss through the query checkpoint.  Event-time
timers (milliseconds) close what the data itself does not close, and state
is cleared once it can no longer change.

Input columns the processors expect: ``ev_us`` (event time, epoch us),
``ev_seq`` and their own flag columns (no leading underscores: such names
do not survive the row-to-pandas conversion); all emit pandas frames.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

# Ship these processors by value: Python workers on the executors then need
# only pandas and pyspark, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ts(us: int) -> pd.Timestamp:
    return pd.Timestamp(int(us) * 1000)


def _ceil_ms(us: int) -> int:
    return -(-int(us) // 1000)


class RepeatProcessor(StatefulProcessor):
    """Strictly consecutive repeats, as the batch ``repeat_match``.

    Rows wait until the watermark says that no earlier one can come: a row's
    matches are reported once it is ``within`` behind the watermark.  The
    state is the key's rows of that stretch, as arrays."""

    def __init__(self, within_us: int, times: tuple[int, int], key_name: str):
        self.within_us, self.times, self.key_name = within_us, times, key_name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", "us array<long>, seq array<long>, hit array<boolean>, timer long")

    def _load(self):
        import numpy as np
        if self.state.exists():
            us, seq, hit, timer = self.state.get()
            return np.asarray(us, np.int64), np.asarray(seq, np.int64), np.asarray(hit, bool), timer
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), None

    def _report(self, key, us, seq, hit, timer, watermark_ms):
        import numpy as np
        out, ready = None, int(np.searchsorted(us, watermark_ms * 1000 - self.within_us, side="right"))
        if ready:
            at = np.flatnonzero(hit)
            later = np.searchsorted(us[at], us[at] + self.within_us, side="left") - np.arange(len(at)) - 1
            follows = np.append(hit[1:], False)[at]
            rows = [(us[i], us[at[j + 1]], k) for j, i in enumerate(at) if i < ready and follows[j]
                    for k in range(self.times[0], min(self.times[1], later[j]) + 1)]
            if rows:
                out = pd.DataFrame({self.key_name: [key[0]] * len(rows), "begin_ts": [_ts(r[0]) for r in rows],
                                    "next_ts": [_ts(r[1]) for r in rows], "k": [r[2] for r in rows]})
            us, seq, hit = us[ready:], seq[ready:], hit[ready:]
        if timer is not None:
            self.handle.deleteTimer(timer)
        if len(us):
            timer = _ceil_ms(us[0] + self.within_us)
            self.handle.registerTimer(timer)
            self.state.update((us.tolist(), seq.tolist(), hit.tolist(), timer))
        else:
            self.state.clear()
        return out

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        import numpy as np
        us, seq, hit, timer = self._load()
        parts = [(us, seq, hit)] + [(f["ev_us"].to_numpy(np.int64), f["ev_seq"].to_numpy(np.int64),
                                     f["hit"].to_numpy(bool)) for f in rows]
        us, seq, hit = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((seq, us))
        out = self._report(key, us[order], seq[order], hit[order], timer, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo: ExpiredTimerInfo):
        us, seq, hit, _ = self._load()
        out = self._report(key, us, seq, hit, None, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def close(self) -> None:
        pass


class FollowedByProcessor(StatefulProcessor):
    """Every ``first`` row waits for the first ``then`` row after it;
    success if that comes less than ``within`` later, else timeout.

    A row's match is reported once the watermark rules out an earlier
    partner: when it has passed the partner, or ``first + within``.  So rows
    out of order inside the watermark's delay match as in the batch form.
    The state holds open ``first`` rows and the ``then`` rows behind them or
    past the watermark as arrays; each call is one pass over them and sets one
    timer."""

    def __init__(self, within_us: int, key_name: str):
        self.within_us = within_us
        self.key_name = key_name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "rows", "us array<long>, seq array<long>, first array<boolean>, then array<boolean>, timer long")

    def _load(self):
        import numpy as np
        if not self.state.exists():
            return [np.zeros(0, t) for t in (np.int64, np.int64, bool, bool)], None
        *cols, timer = self.state.get()
        return [np.asarray(c, t) for c, t in zip(cols, (np.int64, np.int64, bool, bool))], timer

    def _report(self, key, cols, timer, watermark_ms):
        import numpy as np
        us, seq, first, then = cols
        at, after = np.flatnonzero(first), np.flatnonzero(then)
        k = np.searchsorted(after, at, side="right")           # a row can be both; it is not its own partner
        found = k < len(after)
        partner = np.where(found, us[after[np.minimum(k, len(after) - 1)]] if len(after) else 0, 0)
        ends = us[at] + self.within_us
        due = np.where(found, np.minimum(partner, ends), ends)  # when the answer is final
        done = due <= watermark_ms * 1000
        out = None
        if done.any():
            i, ok = at[done], found[done] & (partner[done] < ends[done])
            out = pd.DataFrame({
                self.key_name: [key[0]] * len(i), "begin_ts": pd.to_datetime(us[i] * 1000), "begin_seq": seq[i],
                "follow_ts": pd.Series(pd.to_datetime(partner[done] * 1000)).where(ok),
                "status": np.where(ok, "success", "timeout")})
        if timer is not None:
            self.handle.deleteTimer(timer)
        # partners of rows that are still to come out of order, and of open ones
        keep = then & (us > watermark_ms * 1000)
        if not done.all():
            keep |= then & (us >= us[at[~done][0]])
            keep[at[~done]] = True
        still_first = np.zeros(len(us), bool)
        still_first[at[~done]] = True
        if keep.any():
            timer = _ceil_ms(int(due[~done].min() if not done.all() else us[keep].max()))
            self.handle.registerTimer(timer)
            self.state.update((us[keep].tolist(), seq[keep].tolist(), still_first[keep].tolist(),
                               then[keep].tolist(), timer))
        else:
            self.state.clear()
        return out

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        import numpy as np
        cols, timer = self._load()
        parts = [cols] + [[f["ev_us"].to_numpy(np.int64), f["ev_seq"].to_numpy(np.int64),
                           f["is_first"].to_numpy(bool), f["is_then"].to_numpy(bool)] for f in rows]
        cols = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((cols[1], cols[0]))
        out = self._report(key, [c[order] for c in cols], timer, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo: ExpiredTimerInfo):
        cols, _ = self._load()
        out = self._report(key, cols, None, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def close(self) -> None:
        pass


class SlidingCountProcessor(StatefulProcessor):
    """W3-W6 on a stream, pane form: per key the state holds counts per
    slide-wide pane (one entry per pane, not per open window) and the index
    of the last window already emitted.  When the watermark passes window
    ends, the closed non-empty windows are computed from prefix sums over the
    panes (numpy) and emitted once; panes no open window needs are dropped.
    A timer at the next window end makes keys without new rows emit too.
    Rows for windows already emitted are late and ignored.
    """

    def __init__(self, size_us: int, slide_us: int, key_names: list[str],
                 event_time_out: bool = False):
        if size_us % slide_us:
            raise ValueError("size must be a multiple of slide")
        self.slide_us = slide_us
        self.n = size_us // slide_us
        self.key_names = key_names
        self.event_time_out = event_time_out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "panes", "pane array<long>, cnt array<long>, done long, timer long")

    def _load(self):
        import numpy as np
        if self.state.exists():
            p, c, done, timer = self.state.get()
            return np.asarray(p, dtype=np.int64), np.asarray(c, dtype=np.int64), done, timer
        return np.zeros(0, np.int64), np.zeros(0, np.int64), None, None

    def _close(self, key, panes, cnt, done, timer, wm_ms):
        import numpy as np
        out = None
        n = self.n
        if len(panes):
            # window s covers panes s .. s+n-1 and closes when (s+n)*slide <= wm
            last_closed = (wm_ms * 1000) // self.slide_us - n if wm_ms > 0 else None
            lo = panes[0] - n + 1 if done is None else max(done + 1, panes[0] - n + 1)
            if last_closed is not None and last_closed >= lo:
                hi = min(last_closed, panes[-1])
                if hi >= lo:
                    starts = np.arange(lo, hi + 1, dtype=np.int64)
                    csum = np.concatenate([[0], np.cumsum(cnt)])
                    upto = np.searchsorted(panes, starts + n - 1, side="right")
                    before = np.searchsorted(panes, starts - 1, side="right")
                    counts = csum[upto] - csum[before]
                    keep = counts > 0
                    starts, counts = starts[keep], counts[keep]
                    if len(starts):
                        out = self._frame(key, starts, counts)
                done = last_closed if done is None else max(done, last_closed)
                live = panes > done          # panes of windows still open
                panes, cnt = panes[live], cnt[live]
        if timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        if len(panes):
            first_open = panes[0] - n + 1 if done is None else max(done + 1, panes[0] - n + 1)
            timer = -(-((first_open + n) * self.slide_us) // 1000)
            self.handle.registerTimer(timer)
            self.state.update((panes.tolist(), cnt.tolist(), done, timer))
        else:
            self.state.clear()
        return out

    def _frame(self, key, starts, counts):
        start_ns = starts * self.slide_us * 1000
        end_ns = start_ns + self.n * self.slide_us * 1000
        data = {k: [key[i]] * len(starts) for i, k in enumerate(self.key_names)}
        data["window_start"] = pd.to_datetime(start_ns)
        data["window_end"] = pd.to_datetime(end_ns)
        data["count"] = counts
        if self.event_time_out:
            data["event_time"] = pd.to_datetime(end_ns - 1000, utc=True)
        return pd.DataFrame(data)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        import numpy as np
        panes, cnt, done, timer = self._load()
        frames = list(rows)
        us = np.concatenate([f["ev_us"].to_numpy(np.int64) for f in frames])
        w = np.concatenate([f["cnt"].to_numpy(np.int64) if "cnt" in f.columns
                            else np.ones(len(f), np.int64) for f in frames])
        new = us // self.slide_us
        if done is not None:
            live = new > done                      # panes of emitted windows: late
            new, w = new[live], w[live]
        if len(new):
            allp = np.concatenate([panes, new])
            allc = np.concatenate([cnt, w])
            panes, inv = np.unique(allp, return_inverse=True)
            cnt = np.zeros(len(panes), np.int64)
            np.add.at(cnt, inv, allc)              # bincount's weights are floats
        out = self._close(key, panes, cnt, done, timer, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo: ExpiredTimerInfo):
        panes, cnt, done, _ = self._load()
        out = self._close(key, panes, cnt, done, None, timerValues.getCurrentWatermarkInMs())
        if out is not None:
            yield out

    def close(self) -> None:
        pass


class SlidingTopProcessor(StatefulProcessor):
    """W3-W6 + K1 on a stream: the ``n`` largest counts of each closed window among a bucket's string keys
    (equal counts by key, null first).

    Grouped by (``chunk``, bucket): a group has the windows that start in
    panes ``chunk * chunk_panes`` to ``(chunk + 1) * chunk_panes - 1``.  Its
    state is the pane counts that its open windows need, as numpy columns in
    one binary value, and the last window that was closed.
    """

    CELLS = 1 << 20        # counts of keys and windows at once

    def __init__(self, size_us: int, slide_us: int, key_name: str, top: int, name: str, chunk_panes: int):
        if size_us % slide_us:
            raise ValueError("size must be a multiple of slide")
        self.slide_us, self.n = slide_us, size_us // slide_us
        self.key_name, self.top, self.name, self.chunk_panes = key_name, top, name, chunk_panes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", "columns binary, done long, timer long")

    def _load(self):
        import pickle
        if not self.state.exists():
            return pd.DataFrame({"key": pd.Series(dtype=object), "pane": pd.Series(dtype="int64"),
                                 "cnt": pd.Series(dtype="int64")}), None, None
        columns, done, timer = self.state.get()
        return pd.DataFrame(pickle.loads(columns)), done, timer

    def _ranked(self, panes: pd.DataFrame, lo: int, hi: int):
        """The largest counts of windows lo .. hi, a stretch of windows at a time."""
        import numpy as np
        names = sorted({k for k in panes["key"] if isinstance(k, str)})
        code = {k: i + 1 for i, k in enumerate(names)}
        names = np.array([None, *names], dtype=object)
        keys = np.fromiter((code.get(k, 0) for k in panes["key"]), np.int64, len(panes))
        pane, cnt = panes["pane"].to_numpy(np.int64), panes["cnt"].to_numpy(np.int64)
        order = np.argsort(pane, kind="stable")
        keys, pane, cnt = keys[order], pane[order], cnt[order]
        a = lo
        while a <= hi:
            first = np.searchsorted(pane, a)
            if first == len(pane):
                return
            a = max(a, int(pane[first]) - self.n + 1)      # windows before that are empty
            step = hi - a + 1
            if step < 1:
                return
            while step > 1 and ((np.searchsorted(pane, a + step + self.n - 1) - first) * min(step, self.n)
                                > self.CELLS):
                step //= 2
            last = np.searchsorted(pane, a + step + self.n - 1)
            # pane p is in windows p - n + 1 .. p
            begin = np.maximum(pane[first:last] - self.n + 1, a)
            per = np.minimum(pane[first:last], a + step - 1) - begin + 1
            row = np.repeat(np.arange(last - first), per)
            win = begin[row] + np.arange(len(row)) - (np.cumsum(per) - per)[row]
            cell, at = np.unique((win - a) * len(names) + keys[first:last][row], return_inverse=True)
            count = np.zeros(len(cell), np.int64)
            np.add.at(count, at, cnt[first:last][row])
            win, key = cell // len(names), cell % len(names)
            order = np.lexsort((key, -count, win))
            win, key, count = win[order], key[order], count[order]
            place = np.arange(len(win)) - np.searchsorted(win, win)
            keep = place < self.top
            start = (win[keep] + a) * self.slide_us * 1000
            end = start + self.n * self.slide_us * 1000
            yield pd.DataFrame({self.key_name: names[key[keep]], "window_start": pd.to_datetime(start),
                                "window_end": pd.to_datetime(end), self.name: count[keep],
                                "event_time": pd.to_datetime(end - 1000, utc=True)})
            a += step

    def _close(self, chunk: int, panes: pd.DataFrame, done, timer, wm_ms: int):
        import pickle
        low, high = chunk * self.chunk_panes, (chunk + 1) * self.chunk_panes - 1       # the group's windows
        last_closed = (wm_ms * 1000) // self.slide_us - self.n if wm_ms > 0 else None
        if len(panes) and last_closed is not None:
            lo = max(low, int(panes["pane"].min()) - self.n + 1)
            lo = lo if done is None else max(done + 1, lo)
            yield from self._ranked(panes, lo, min(last_closed, high, int(panes["pane"].max())))
            done = last_closed if done is None else max(done, last_closed)
            panes = panes[panes["pane"] > done] if done < high else panes[:0]            # panes of windows still open
        if timer is not None:
            self.handle.deleteTimer(timer)
        if len(panes):
            first_open = max(low, int(panes["pane"].min()) - self.n + 1)
            first_open = first_open if done is None else max(done + 1, first_open)
            timer = -(-((first_open + self.n) * self.slide_us) // 1000)
            self.handle.registerTimer(timer)
            self.state.update((pickle.dumps({c: panes[c].to_numpy() for c in panes}, protocol=5), done, timer))
        else:
            self.state.clear()

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        panes, done, timer = self._load()
        new = [pd.DataFrame({"key": f[self.key_name].astype(object), "pane": f["ev_us"].astype("int64") // self.slide_us,
                             "cnt": f["cnt"].astype("int64")}) for f in rows]
        panes = pd.concat([panes, *new], ignore_index=True)
        if done is not None:
            panes = panes[panes["pane"] > done]            # panes of emitted windows: late
        yield from self._close(int(key[0]), panes, done, timer, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo: ExpiredTimerInfo):
        panes, done, _ = self._load()
        yield from self._close(int(key[0]), panes, done, None, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class ProcessingTimeCapProcessor(StatefulProcessor):
    """T5 with the reference's clock (T8): the count starts with the first
    row of a key and is cleared by a processing-time timer at the next UTC
    midnight of the wall clock, whatever the rows' event times.  Not
    reproducible across a replay over midnight; the event-day form
    (``CapProcessor``) is the default."""

    DAY_MS = 86_400_000

    def __init__(self, cap: int, key_names: list[str]):
        self.cap = cap
        self.key_names = key_names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cap", "cnt long, flagged boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        cnt, flagged = self.state.get() if self.state.exists() else (0, False)
        if not self.state.exists():
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer((now // self.DAY_MS + 1) * self.DAY_MS)
        left = self.cap + 1 - cnt - flagged                       # rows that can still come through
        first = None
        for frame in rows:
            first = frame if first is None else pd.concat([first, frame], ignore_index=True)
            first = first.nsmallest(max(left, 0), ["ev_us", "ev_seq"])
        place = cnt + pd.Series(range(len(first)), index=first.index, dtype="int64")
        out = first.assign(tag=(place < self.cap).map({True: "pass", False: "blacklist"}))
        passed = int((out["tag"] == "pass").sum())
        self.state.update((cnt + passed, flagged or passed < len(out)))
        if len(out):
            yield out[["ev_seq", "ev_ts", *self.key_names, "tag"]].rename(
                columns={"ev_seq": "seq", "ev_ts": "ts"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo: ExpiredTimerInfo):
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass
