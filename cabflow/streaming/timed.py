"""Keyed processors on timers: a key that falls silent still gets its results.

Event time: ``job_clock`` gives the stream one watermark, the largest event time of
*all* keys less a delay, which Spark moves on between micro-batches.  Each key has
a timer at its next due time, so the watermark reaches it without a row of its own.
The watermarked column is dropped before the processors, so Spark drops no late
row: a row that arrives behind the watermark comes out with ``kind`` 'late'.  The
batch form of the same rule is ``events.with_watermark(..., emit_every=...)``, one
micro-batch being one period.

* ``JobSorter``      – rows in event-time order (SRT1, LATE2)
* ``JobSegmenter``   – segments between stops from mergeable statistics (WIN11)
* ``JobWindows``     – tumbling counts, re-fired for allowed late rows, late rows out (LATE1, LATE3)
* ``JobSessions``    – sessions of a user aggregate; sessions that join are merged (STA5)
* ``JobPairing``     – first-come pairs; elements that expire or are replaced come out (JOI1)
* ``JobTop``         – the n best of every window in a bounded heap (AGG4)

Processing time:

* ``PaneCounts``     – sliding counts: one sum per pane, panes added as windows close (WIN2)
* ``WallWindows``    – event-time windows closed by the wall clock less a delay (WMK3)
* ``GroupBuffer``    – groups of exactly n records with a running number (SNK3)

What a stopped stream still holds is read from its checkpoint as a table
(``held_rows``); ``rest_sorted``, ``rest_segments`` and ``rest_windows`` finish it in batch.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cabflow.functions.labels import STYLE_BAND, STYLE_LABELS

SORT_ROW = "car string, id string, ts_ms long, event string, seq string"
SORTED = "car string, id string, ts_ms long, kind string, event string"
SEGMENT_ROW = "ts_ms long, seq string, speed float, throttle float, stop boolean"
SEGMENT_OPEN = "n long, start long, top float, nx long, mean double, m2 double"
SEGMENTS = "key string, startTime long, length int, maxSpeed float, erraticness float, label string, late_ts_ms long, kind string"
WINDOWS = "key string, window_start_ms long, firing int, n long, late_ts_ms long, kind string"
PAIRS = "key long, kind string, left_rec string, right_rec string"
TOP = "window_start_ms long, rank int, id long, value double"
PANES = "key string, window_start_ms long, n long"
WALL = "key string, window_start_ms long, n long, late_ts_ms long, kind string"
GROUPS = "shard int, group_no long, pos int, whole boolean, record string"


def job_clock(df: DataFrame, ts_ms: str, delay_ms: int) -> DataFrame:
    """The stream with one watermark over all its rows; no column of ``df`` is
    watermarked, so nothing that follows drops a row for being late."""
    return df.withColumn("_clock", F.timestamp_millis(ts_ms)).withWatermark("_clock", f"{delay_ms} milliseconds").drop("_clock")


def _frame(rows, order: str = "seq") -> pd.DataFrame:
    frames = [p for p in rows if len(p)]
    return pd.concat(frames, ignore_index=True).sort_values(order, kind="stable").reset_index(drop=True) if frames else pd.DataFrame()


def _rows(pdf: pd.DataFrame, columns: list[str]) -> list[tuple]:
    return list(pdf[columns].itertuples(index=False, name=None))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Timed(StatefulProcessor):
    """One timer per key, at the earliest time something is due."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "t long")

    def wake(self, at: int) -> None:
        set_for = self.due.get()[0] if self.due.exists() else None
        if set_for is None or at < set_for:
            if set_for is not None:
                self.handle.deleteTimer(set_for)
            self.handle.registerTimer(int(at))
            self.due.update((int(at),))

    def sleep(self, at: int | None) -> None:
        """After a timer has gone off: the next one, if anything is left."""
        self.due.clear()
        if at is not None:
            self.wake(at)

    def close(self) -> None:
        pass


def _is_late(ts, watermark: int):
    """No watermark yet is 0."""
    return (ts <= watermark) if watermark > 0 else np.zeros(len(ts), bool)


class JobSorter(Timed):
    """Rows wait in a list and leave in (ts_ms, seq) order when the watermark
    passes them.  Input: key, car, id, ts_ms, event, seq."""

    def init(self, handle):
        super().init(handle)
        self.rows = handle.getListState("rows", SORT_ROW)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        late = _is_late(pdf["ts_ms"].to_numpy(), timerValues.getCurrentWatermarkInMs())
        fresh = pdf[~late]
        if len(fresh):
            self.rows.appendList(_rows(fresh, _names(SORT_ROW)))
            self.wake(int(fresh["ts_ms"].min()))
        if late.any():
            yield pdf[late].assign(kind="late")[_names(SORTED)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = pd.DataFrame([tuple(r) for r in self.rows.get()], columns=_names(SORT_ROW)).sort_values(["ts_ms", "seq"], kind="stable")
        ready = held["ts_ms"] <= timerValues.getCurrentWatermarkInMs()
        rest = held[~ready]
        if len(rest):
            self.rows.put(_rows(rest, _names(SORT_ROW)))
        else:
            self.rows.clear()
        self.sleep(int(rest["ts_ms"].min()) if len(rest) else None)
        if ready.any():
            yield held[ready].assign(kind="sorted")[_names(SORTED)]


def _label(x: float) -> str:
    band = int(x / STYLE_BAND) if x == x else -1
    return STYLE_LABELS[min(band, 2)] if band >= 0 else STYLE_LABELS[2]


EMPTY_SEGMENT = (0, None, None, 0, 0.0, 0.0)


def add_rows(acc: tuple, ts, speed, throttle) -> tuple:
    """Count, first time, top speed, and count, mean and sum of squares of the
    throttle, with more rows (nulls are left out as SQL aggregates do)."""
    n, start, top, nx, mean, m2 = acc
    if not len(ts):
        return acc
    speed, x = speed[~np.isnan(speed)], throttle[~np.isnan(throttle)]
    tops = ([top] if top is not None else []) + ([float(speed.max())] if len(speed) else [])
    if len(x):
        other, more = float(x.mean()), len(x)
        m2 += float(((x - other) ** 2).sum()) + (other - mean) ** 2 * nx * more / (nx + more)
        mean += (other - mean) * more / (nx + more)
        nx += more
    first = int(ts.min())
    return n + len(ts), first if start is None else min(start, first), max(tops) if tops else None, nx, mean, m2


def fold_segments(acc: tuple, pdf: pd.DataFrame) -> tuple[list[tuple], tuple]:
    """Rows in order (ts_ms, speed, throttle, stop) on top of the open segment:
    the segments they close, as output rows without the key, and what stays open."""
    ts, speed, x = (pdf[c].to_numpy(dtype=t) for c, t in (("ts_ms", np.int64), ("speed", np.float64), ("throttle", np.float64)))
    stop = pdf["stop"].to_numpy(dtype=bool)
    out, at = [], 0
    for s in np.flatnonzero(stop).tolist():
        n, start, top, nx, _, m2 = add_rows(acc, ts[at:s], speed[at:s], x[at:s])
        if n:
            spread = float(np.sqrt(m2 / nx)) if nx else float("nan")
            out.append((start, n, top, spread if nx else None, _label(spread) if nx else None))
        acc, at = EMPTY_SEGMENT, s + 1
    return out, add_rows(acc, ts[at:], speed[at:], x[at:])


class JobSegmenter(Timed):
    """Stop segments: rows wait until the watermark passes them, then go into the
    statistics of the open segment; a stop gives them off.  So a car that never
    stops holds five numbers and the rows of the delay, however long it drives.
    Input: key, ts_ms, seq, speed, throttle, stop (boolean)."""

    def init(self, handle):
        super().init(handle)
        self.rows = handle.getListState("rows", SEGMENT_ROW)
        self.open = handle.getValueState("open", SEGMENT_OPEN)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        late = _is_late(pdf["ts_ms"].to_numpy(), timerValues.getCurrentWatermarkInMs())
        fresh = pdf[~late]
        if len(fresh):
            clean = fresh[_names(SEGMENT_ROW)].astype(object)
            self.rows.appendList(_rows(clean.where(clean.notna(), None), _names(SEGMENT_ROW)))
            self.wake(int(fresh["ts_ms"].min()))
        if late.any():
            yield self._out(key[0], [], pdf.loc[late, "ts_ms"].tolist())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = pd.DataFrame([tuple(r) for r in self.rows.get()], columns=_names(SEGMENT_ROW)).sort_values(["ts_ms", "seq"], kind="stable")
        ready = held["ts_ms"] <= timerValues.getCurrentWatermarkInMs()
        done, acc = fold_segments(tuple(self.open.get()) if self.open.exists() else EMPTY_SEGMENT, held[ready])
        if acc[0]:
            self.open.update(acc)
        else:
            self.open.clear()
        rest = held[~ready].astype(object)
        if len(rest):
            self.rows.put(_rows(rest.where(rest.notna(), None), _names(SEGMENT_ROW)))
        else:
            self.rows.clear()
        self.sleep(int(rest["ts_ms"].min()) if len(rest) else None)
        if done:
            yield self._out(key[0], done, [])

    @staticmethod
    def _out(key, segments, late):
        rows = [(key, *s, None, "segment") for s in segments] + [(key, None, None, None, None, None, t, "late") for t in late]
        pdf = pd.DataFrame(rows, columns=_names(SEGMENTS))
        return pdf.astype({"startTime": "Int64", "length": "Int32", "maxSpeed": "float32", "erraticness": "float32", "late_ts_ms": "Int64"})


class JobWindows(Timed):
    """Tumbling window counts.  A window fires when the watermark reaches its end
    (less ``edge_ms``) and, for ``allowed_ms`` more, again for every row that still
    arrives, each firing with its number and the count so far; later rows come out
    as late.  State is kept to the end plus the allowance.  Input: key, ts_ms, seq."""

    def __init__(self, size_ms: int, allowed_ms: int = 0, edge_ms: int = 0):
        self.size, self.allowed, self.edge = size_ms, allowed_ms, edge_ms

    def init(self, handle):
        super().init(handle)
        self.windows = handle.getMapState("windows", "start long", "n long, fired int")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        wm, out = timerValues.getCurrentWatermarkInMs(), []
        touched: dict[int, list[int]] = {}
        for ts in pdf["ts_ms"].tolist():
            start = ts - ts % self.size
            close = start + self.size - self.edge
            if wm > 0 and close + self.allowed <= wm:
                out.append((key[0], None, None, None, ts, "late"))
                continue
            if start not in touched:
                held = self.windows.getValue((start,)) if self.windows.containsKey((start,)) else (0, 0)
                touched[start] = [int(held[0]), int(held[1])]
            w = touched[start]
            if wm > 0 and close <= wm:
                if w[0] and not w[1]:  # due in this very batch: its rows so far fire first
                    w[1] = 1
                    out.append((key[0], start, 1, w[0], None, "window"))
                w[0], w[1] = w[0] + 1, w[1] + 1
                out.append((key[0], start, w[1], w[0], None, "window"))
            else:
                w[0] += 1
        for start, (n, fired) in touched.items():
            self.windows.updateValue((start,), (n, fired))
        if touched:
            self.wake(self._next(touched.items()))
        if out:
            yield self._out(out)

    def _next(self, windows) -> int:
        return min(s + self.size - self.edge + (self.allowed if fired else 0) for s, (_, fired) in windows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm, out, left = timerValues.getCurrentWatermarkInMs(), [], []
        for k, v in sorted((tuple(k), tuple(v)) for k, v in self.windows.iterator()):
            start, (n, fired) = int(k[0]), (int(v[0]), int(v[1]))
            close = start + self.size - self.edge
            if close <= wm and not fired:
                fired = 1
                out.append((key[0], start, 1, n, None, "window"))
                self.windows.updateValue((start,), (n, 1))
            if close + self.allowed <= wm:
                self.windows.removeKey((start,))
            else:
                left.append((start, (n, fired)))
        self.sleep(self._next(left) if left else None)
        if out:
            yield self._out(out)

    @staticmethod
    def _out(rows):
        return pd.DataFrame(rows, columns=_names(WINDOWS)).astype({"window_start_ms": "Int64", "firing": "Int32", "n": "Int64", "late_ts_ms": "Int64"})


class JobSessions(Timed):
    """Sessions of ``gap_ms`` with a user aggregate ``init() -> acc``,
    ``add(acc, value)``, ``merge(earlier, later)`` and ``result(acc)`` on tuples.  A row
    opens [ts, ts + gap]; sessions that touch are merged in order of time.  A session
    comes out when the watermark passes its end; a row whose own session would have
    been over is late unless it touches one that is still open.  Input: key, ts_ms,
    value, seq; output: key, session_start_ms, session_end_ms, result, late_ts_ms, kind."""

    def __init__(self, gap_ms: int, init, add, merge, result, acc_schema: str, columns: list[str]):
        self.gap, self.first, self.add, self.merge, self.result = gap_ms, init, add, merge, result
        self.acc_schema, self.columns = acc_schema, columns

    def init(self, handle):
        super().init(handle)
        self.sessions = handle.getMapState("sessions", "start long", f"until long, {self.acc_schema}")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        wm, out = timerValues.getCurrentWatermarkInMs(), []
        open_ = {int(k[0]): tuple(v) for k, v in self.sessions.iterator()}
        before = set(open_)
        for ts, value in zip(pdf["ts_ms"].tolist(), pdf["value"].tolist()):
            start, until, acc = ts, ts + self.gap, self.add(self.first(), value)
            touch = sorted(s for s, v in open_.items() if s <= until and v[0] >= start)
            if not touch and wm > 0 and until <= wm:
                out.append((key[0], None, None, *[None] * len(self.columns), ts, "late"))
                continue
            parts = sorted([(s, open_[s][0], open_[s][1:]) for s in touch] + [(start, until, acc)], key=lambda p: (p[0], p[1]))
            for s in touch:
                del open_[s]
            acc = parts[0][2]
            for _, _, other in parts[1:]:
                acc = self.merge(acc, other)
            open_[parts[0][0]] = (max(p[1] for p in parts), *acc)
        for s in before - set(open_):
            self.sessions.removeKey((s,))
        for s, v in open_.items():
            self.sessions.updateValue((s,), v)
        if open_:
            self.wake(min(v[0] for v in open_.values()))
        if out:
            yield self._out(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm, out, left = timerValues.getCurrentWatermarkInMs(), [], []
        for k, v in sorted((tuple(k), tuple(v)) for k, v in self.sessions.iterator()):
            if v[0] <= wm:
                out.append((key[0], int(k[0]), int(v[0]), *self.result(v[1:]), None, "session"))
                self.sessions.removeKey(k)
            else:
                left.append(int(v[0]))
        self.sleep(min(left) if left else None)
        if out:
            yield self._out(out)

    def _out(self, rows):
        names = ["key", "session_start_ms", "session_end_ms", *self.columns, "late_ts_ms", "kind"]
        return pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("session_start_ms", "session_end_ms", "late_ts_ms")})


class JobPairing(Timed):
    """First-come pairing (one waiting element per key) that accounts for every
    element: a pair, or 'replaced' by a later one of its side, or 'expired' when the
    watermark passes its time plus ``ttl_ms``.  Input: key, side (0 left, 1 right),
    ts_ms, rec, seq."""

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle):
        super().init(handle)
        self.waiting = handle.getValueState("waiting", "side int, ts_ms long, rec string")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        cols = ["side", "ts_ms", "rec"]
        ev = pdf[cols]
        if self.waiting.exists():
            ev = pd.concat([pd.DataFrame([tuple(self.waiting.get())], columns=cols), ev], ignore_index=True)
        side, rec = ev["side"].to_numpy(dtype=np.int64), ev["rec"].to_numpy(dtype=object)
        pos = np.arange(len(ev))
        island = np.maximum.accumulate(np.where(np.concatenate([[True], side[1:] == side[:-1]]), pos, 0))
        j = np.flatnonzero((pos - island) % 2 == 1)
        alone = np.ones(len(ev), bool)
        alone[j] = alone[j - 1] = False
        if alone[-1]:
            alone[-1] = False
            last = ev.iloc[-1]
            self.waiting.update((int(last["side"]), int(last["ts_ms"]), last["rec"]))
        else:
            self.waiting.clear()
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
        self.sleep(int(ev["ts_ms"].iloc[-1]) + self.ttl if self.waiting.exists() else None)
        left = np.where(side[j - 1] == 0, rec[j - 1], rec[j])
        right = np.where(side[j - 1] == 0, rec[j], rec[j - 1])
        out = [(key[0], "pair", a, b) for a, b in zip(left, right)]
        out += [(key[0], "replaced", rec[i] if side[i] == 0 else None, rec[i] if side[i] == 1 else None) for i in np.flatnonzero(alone)]
        if out:
            yield pd.DataFrame(out, columns=_names(PAIRS))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.due.clear()
        if self.waiting.exists():
            side, _, rec = self.waiting.get()
            self.waiting.clear()
            yield pd.DataFrame([(key[0], "expired", rec if side == 0 else None, rec if side == 1 else None)], columns=_names(PAIRS))


def merge_top(a: list[tuple], b: list[tuple], n: int) -> list[tuple]:
    """The n best of two heaps of (value, -id): largest value, then smallest id."""
    return heapq.nlargest(n, [*a, *b])


class JobTop(Timed):
    """The ``n`` largest values of every window, ties to the smallest id.  Rows go
    into a heap of n; heaps merge, so the order of arrival does not matter.  Input:
    end_ms (key: the window's end), id, value; comes out when the watermark passes."""

    def __init__(self, n: int, size_ms: int):
        self.n, self.size = n, size_ms

    def init(self, handle):
        super().init(handle)
        self.best = handle.getListState("best", "value double, neg long")

    def handleInputRows(self, key, rows, timerValues):
        best = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        for pdf in rows:
            some = pdf.dropna(subset=["value", "id"])
            best = merge_top(best, [(float(v), -int(i)) for v, i in zip(some["value"], some["id"])], self.n)
        if best:
            self.best.put(best)
            self.wake(int(key[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.due.clear()
        best = sorted((tuple(r) for r in self.best.get()), reverse=True) if self.best.exists() else []
        self.best.clear()
        if best:
            yield pd.DataFrame([(int(key[0]) - self.size, k + 1, -i, v) for k, (v, i) in enumerate(best)], columns=_names(TOP))


class PaneCounts(Timed):
    """Sliding counts in processing time: a row is counted once, in the pane of
    its arrival; when a slide ends, the panes of the window are added up.  Input: key."""

    def __init__(self, size_ms: int, slide_ms: int):
        if size_ms % slide_ms:
            raise ValueError("the size must be a multiple of the slide")
        self.slide, self.panes = slide_ms, size_ms // slide_ms

    def init(self, handle):
        super().init(handle)
        self.counts = handle.getMapState("counts", "pane long", "n long")

    def handleInputRows(self, key, rows, timerValues):
        n = sum(len(p) for p in rows)
        pane = timerValues.getCurrentProcessingTimeInMs() // self.slide
        held = self.counts.getValue((pane,))[0] if self.counts.containsKey((pane,)) else 0
        self.counts.updateValue((pane,), (int(held) + n,))
        self.wake((pane + 1) * self.slide)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, due = timerValues.getCurrentProcessingTimeInMs(), self.due.get()[0]
        panes = {int(k[0]): int(v[0]) for k, v in self.counts.iterator()}
        end, out = due // self.slide, []
        while end * self.slide <= now and panes:
            n = sum(c for p, c in panes.items() if end - self.panes <= p < end)
            if n:
                out.append((key[0], (end - self.panes) * self.slide, n))
            end += 1
            for p in [p for p in panes if p < end - self.panes]:  # in no window to come
                del panes[p]
                self.counts.removeKey((p,))
        self.sleep(end * self.slide if panes else None)
        if out:
            yield pd.DataFrame(out, columns=_names(PANES))


class WallWindows(Timed):
    """Event-time windows under a wall-clock watermark (now less ``delay_ms``): a
    timer in processing time closes them, rows or not.  ``clock``: the time to go by
    instead of the batch's, for tests.  Input: key, ts_ms, seq."""

    def __init__(self, size_ms: int, slide_ms: int, delay_ms: int, clock=None):
        self.size, self.slide, self.delay, self.clock = size_ms, slide_ms, delay_ms, clock

    def init(self, handle):
        super().init(handle)
        self.counts = handle.getMapState("counts", "start long", "n long")

    def _watermark(self, timerValues) -> int:
        return (self.clock() if self.clock else timerValues.getCurrentProcessingTimeInMs()) - self.delay

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        wm = self._watermark(timerValues)
        ts = pdf["ts_ms"].to_numpy(dtype=np.int64)
        last = ts - np.mod(ts, self.slide)
        starts = last[:, None] - self.slide * np.arange(-(-self.size // self.slide))
        good = (starts + self.size > wm) & (starts + self.size > ts[:, None])
        found, n = np.unique(starts[good], return_counts=True)
        for s, m in zip(found.tolist(), n.tolist()):
            held = self.counts.getValue((s,))[0] if self.counts.containsKey((s,)) else 0
            self.counts.updateValue((s,), (int(held) + m,))
        if len(found):
            self.wake(int(found[0]) + self.size + self.delay)
        late = ts[~good.any(1)]
        if len(late):
            yield self._out([(key[0], None, None, int(t), "late") for t in late])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm, out, left = self._watermark(timerValues), [], []
        for k, v in sorted((tuple(k), tuple(v)) for k, v in self.counts.iterator()):
            if k[0] + self.size <= wm:
                out.append((key[0], int(k[0]), int(v[0]), None, "window"))
                self.counts.removeKey(k)
            else:
                left.append(int(k[0]) + self.size + self.delay)
        # never at the time of the timer that went off: Spark removes that one afterwards
        self.sleep(max(min(left), timerValues.getCurrentProcessingTimeInMs() + 1) if left else None)
        if out:
            yield self._out(out)

    @staticmethod
    def _out(rows):
        return pd.DataFrame(rows, columns=_names(WALL)).astype({"window_start_ms": "Int64", "n": "Int64", "late_ts_ms": "Int64"})


class GroupBuffer(Timed):
    """Records wait in a list until there are ``threshold``; then they leave as a
    group with the shard's next number.  ``flush_ms`` of processing time after the
    first that waits, what there is leaves as a group that is not whole.  State and
    numbers come back after a failure with the micro-batch they belong to.
    Input: shard, record, seq."""

    def __init__(self, threshold: int, flush_ms: int | None = None):
        self.threshold, self.flush = threshold, flush_ms

    def init(self, handle):
        super().init(handle)
        self.records = handle.getListState("records", "record string")
        self.number = handle.getValueState("number", "n long")

    def _give(self, shard, groups):
        n = self.number.get()[0] if self.number.exists() else 0
        self.number.update((n + len(groups),))
        rows = [(int(shard), n + g, i, len(group) == self.threshold, r) for g, group in enumerate(groups) for i, r in enumerate(group)]
        return pd.DataFrame(rows, columns=_names(GROUPS))

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows)
        if pdf.empty:
            return
        held = [r[0] for r in self.records.get()] if self.records.exists() else []
        waiting = bool(held)
        held += pdf["record"].tolist()
        cut = len(held) - len(held) % self.threshold
        groups, rest = [held[i:i + self.threshold] for i in range(0, cut, self.threshold)], held[cut:]
        if rest:
            self.records.put([(r,) for r in rest])
        else:
            self.records.clear()
        if self.flush is not None and (groups or not waiting):  # another record is now the first that waits
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            self.sleep(timerValues.getCurrentProcessingTimeInMs() + self.flush if rest else None)
        if groups:
            yield self._give(key[0], groups)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.due.clear()
        held = [r[0] for r in self.records.get()] if self.records.exists() else []
        self.records.clear()
        if held:
            yield self._give(key[0], [held])


# ------------------------------------------------- what a stopped stream holds

def held_rows(spark: SparkSession, checkpoint: str, state: str, operator: int = 0) -> DataFrame:
    """A state variable of a stopped query as a table (Spark's state reader)."""
    return spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", state).load()


def rest_sorted(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows a stopped ``JobSorter`` holds, with their place among them: car, id, ts_ms, event, pos."""
    from cabflow.operators.scan import Agg, keyed_scan
    rows = held_rows(spark, checkpoint, "rows").select("list_element.*")
    return keyed_scan(rows, ["car"], ["ts_ms", "seq"], [Agg("pos", "count")]).drop("seq")


def rest_segments(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Segments that the rows of a stopped ``JobSegmenter`` still close."""
    rows = held_rows(spark, checkpoint, "rows").select(F.col("key.key").alias("key"), "list_element.*")
    open_ = held_rows(spark, checkpoint, "open").select(F.col("key.key").alias("key"), F.col("value").alias("acc"))

    def finish(pdf):
        pdf = pdf.sort_values(["ts_ms", "seq"], kind="stable")
        acc = pdf["acc"].iloc[0]
        acc = EMPTY_SEGMENT if acc is None else tuple(acc[c] for c in _names(SEGMENT_OPEN))
        done, _ = fold_segments(acc, pdf)
        return JobSegmenter._out(pdf["key"].iloc[0], done, [])

    return rows.join(open_, "key", "left").groupBy("key").applyInPandas(finish, SEGMENTS).drop("late_ts_ms", "kind")


def rest_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """First firings of the windows a stopped ``JobWindows`` has not closed."""
    w = held_rows(spark, checkpoint, "windows").select(F.col("key.key").alias("key"), F.col("user_map_key.start").alias("window_start_ms"), "user_map_value.*")
    return w.where("fired = 0").select("key", "window_start_ms", F.lit(1).alias("firing"), "n")
