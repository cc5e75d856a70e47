"""Keyed stateful processors for Structured Streaming (``transformWithStateInPandas``).

They are the streaming twins of the batch operators: per key, Spark routes
rows to one state-store partition (hash of the key), keeps state in RocksDB
on the checkpoint location, and replays it after a failure.

* ``EventSorter``       – buffer + release in event-time order, late rows out (SRT1, LATE2)
* ``StopSegmenter``     – segments between stop events (WIN11)
* ``FirstComePairing``  – consume-on-match pairing of two tagged inputs (JOI1)
* ``CountAverage``      – average of every n values (value / list / map state, AGG5)
* ``RunningSum``        – reducing state (AGG6);  ``RunningConcat`` – aggregating state (AGG7)
* ``IdleCounter``       – count until a processing-time timeout (STA6)
* ``KeyedReduce``       – generic accumulator from init / add / emit functions (STA4, STA5)
* ``WindowCountWithLate`` – window counts with a late-data side output (LATE1)

Rows of one micro-batch for a key arrive together; processors that depend
on arrival order sort them by a sequence column first (``seq``).  The
sorter and the segmenter keep their own per-key watermark instead of a
Spark watermark upstream, because Spark drops rows older than the previous
batch's watermark before a processor could route them to a side output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cabflow.functions.labels import STYLE_BAND, STYLE_LABELS
from cabflow.operators.keyed import CONTAINS_PREFIX, CONTAINS_SEP

SORTED_SCHEMA = "car string, id string, ts_ms long, kind string, event string"
SEGMENT_SCHEMA = ("key string, startTime long, length int, maxSpeed float, erraticness float, "
                  "label string")
PAIR_SCHEMA = "key long, left_id long, right_id long, left_ms long, right_ms long, left_rec string, right_rec string"
AVERAGE_SCHEMA = "key long, average double"
SUM_SCHEMA = "key long, running_sum long"
CONCAT_SCHEMA = "key long, contains string"
IDLE_SCHEMA = "key string, n long"


def _key(key):
    return key[0] if isinstance(key, tuple) else key


def _rows(rows, order: list[str]) -> pd.DataFrame:
    frames = [pdf for pdf in rows if len(pdf)]
    if not frames:
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True)
    return pdf.sort_values(order, kind="stable").reset_index(drop=True)


class EventSorter(StatefulProcessor):
    """Per key: a row is late iff ``ts <= max(ts seen before) - delay``; on-time
    rows wait in a list and are released in (ts, seq) order once the
    watermark passes them.  Input columns: key, car, id, ts_ms, event, seq
    (ids and the event itself are text and come back as they were)."""

    def __init__(self, delay_ms: int):
        self.delay = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.max_ts = handle.getValueState("max_ts", "v long")
        self.buf = handle.getListState("buffer", "car string, id string, ts_ms long, event string, seq string")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        cols = ["car", "id", "ts_ms", "event", "seq"]
        pdf = pdf[cols]
        ts = pdf["ts_ms"].to_numpy(dtype=np.int64)
        prior = self.max_ts.get()[0] if self.max_ts.exists() else None
        # watermark each row sees: max event time of earlier rows - delay
        seen = np.maximum.accumulate(ts)
        before = np.concatenate([[np.iinfo(np.int64).min if prior is None else prior], seen[:-1]])
        if prior is not None:
            before = np.maximum(before, prior)
        late = (before != np.iinfo(np.int64).min) & (ts <= before - self.delay)
        mx = int(seen[-1]) if prior is None else max(prior, int(seen[-1]))
        old = [tuple(r) for r in self.buf.get()] if self.buf.exists() else []
        buf = pd.concat([pd.DataFrame(old, columns=cols), pdf[~late]] if old else [pdf[~late]], ignore_index=True)
        buf = buf.sort_values(["ts_ms", "seq"], kind="stable")
        ready = buf[buf["ts_ms"] <= mx - self.delay]
        keep = buf[buf["ts_ms"] > mx - self.delay]
        self.max_ts.update((mx,))
        if len(keep):
            self.buf.put(list(keep.itertuples(index=False, name=None)))
        else:
            self.buf.clear()
        out = pd.concat([ready.assign(kind="sorted"), pdf[late].assign(kind="late")], ignore_index=True)
        if len(out):
            yield out[["car", "id", "ts_ms", "kind", "event"]]

    def close(self) -> None:
        pass


def _style(x: float) -> str:
    band = int(x / STYLE_BAND)
    return STYLE_LABELS[min(band, 2)] if band >= 0 else STYLE_LABELS[2]


class StopSegmenter(StatefulProcessor):
    """Buffer a car's events; when the watermark (max ts - delay) reaches a
    stop (speed == 0), emit the stats of the moving events before that stop
    and evict everything up to it.  Input: key, ts_ms, speed, throttle, seq."""

    def __init__(self, delay_ms: int):
        self.delay = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.max_ts = handle.getValueState("max_ts", "v long")
        self.buf = handle.getListState("events", "seq string, ts_ms long, speed float, throttle float")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        k = _key(key)
        cols = ["seq", "ts_ms", "speed", "throttle"]
        prior = self.max_ts.get()[0] if self.max_ts.exists() else None
        old = pd.DataFrame([tuple(r) for r in self.buf.get()] if self.buf.exists() else [], columns=cols)
        buf = pd.concat([old, pdf[cols]], ignore_index=True).astype(
            {"seq": str, "ts_ms": np.int64, "speed": np.float64, "throttle": np.float64})
        buf = buf.sort_values(["ts_ms", "seq"], kind="stable").reset_index(drop=True)
        mx = int(pdf["ts_ms"].max()) if prior is None else max(prior, int(pdf["ts_ms"].max()))
        wm = mx - self.delay
        stop = (buf["speed"] == 0.0).to_numpy()
        fire = np.flatnonzero(stop & (buf["ts_ms"].to_numpy() <= wm))
        self.max_ts.update((mx,))
        if len(fire) == 0:
            self.buf.put(list(buf.itertuples(index=False, name=None)))
            return
        cut = int(fire[-1])                     # everything up to the last ready stop is evicted
        done, rest = buf.iloc[:cut + 1], buf.iloc[cut + 1:]
        seg = np.cumsum(stop[:cut + 1]) - stop[:cut + 1]   # stops strictly before each row
        moving = done[~stop[:cut + 1]].assign(seg=seg[~stop[:cut + 1]])
        if len(rest):
            self.buf.put(list(rest.itertuples(index=False, name=None)))
        else:
            self.buf.clear()
        if len(moving):
            g = moving.groupby("seg")
            stats = pd.DataFrame({"startTime": g["ts_ms"].min(), "length": g.size().astype(np.int32),
                                  "maxSpeed": g["speed"].max(), "erraticness": g["throttle"].std(ddof=0)})
            stats["label"] = [_style(x) for x in stats["erraticness"]]
            yield stats.reset_index(drop=True).assign(key=k)[
                ["key", "startTime", "length", "maxSpeed", "erraticness", "label"]]

    def close(self) -> None:
        pass


class FirstComePairing(StatefulProcessor):
    """Tagged union input: key, side (0 = ride/left, 1 = fare/right), id, ts_ms,
    seq and, if it is there, rec: the record as text, given back with the pair.
    One waiting element per key (both sides can never wait at once)."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getValueState("waiting", "side int, id long, ts_ms long, rec string", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        k = _key(key)
        cols = ["side", "id", "ts_ms", "rec"]
        ev = pdf.assign(rec=pdf["rec"] if "rec" in pdf else "")[cols]
        if self.waiting.exists():
            ev = pd.concat([pd.DataFrame([tuple(self.waiting.get())], columns=cols), ev], ignore_index=True)
        ev = ev.astype({"side": np.int64, "id": np.int64, "ts_ms": np.int64})
        side = ev["side"].to_numpy()
        pos = np.arange(len(ev))
        # island rule: a row with the same side as its predecessor starts over
        starts = np.concatenate([[True], side[1:] == side[:-1]])
        island = np.maximum.accumulate(np.where(starts, pos, 0))
        closer = (pos - island) % 2 == 1
        j = np.flatnonzero(closer)
        if (len(ev) - 1 - island[-1]) % 2 == 0:          # last row is unpaired: it waits
            last = ev.iloc[-1]
            self.waiting.update((int(last["side"]), int(last["id"]), int(last["ts_ms"]), last["rec"]))
        else:
            self.waiting.clear()
        if len(j):
            a, b = ev.iloc[j - 1].reset_index(drop=True), ev.iloc[j].reset_index(drop=True)
            left = a.where(a["side"] == 0, b)
            right = b.where(b["side"] == 1, a)
            yield pd.DataFrame({"key": k, "left_id": left["id"], "right_id": right["id"],
                                "left_ms": left["ts_ms"], "right_ms": right["ts_ms"],
                                "left_rec": left["rec"], "right_rec": right["rec"]})

    def close(self) -> None:
        pass


class CountAverage(StatefulProcessor):
    """Average of every ``n`` values per key, then reset.  ``layout`` picks the
    state type the reference demonstrates: value (count, sum), list of values,
    or map uuid -> value.  Input: key, value, seq."""

    def __init__(self, n: int = 3, layout: str = "value"):
        self.n, self.layout = n, layout

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.layout == "value":
            self.st = handle.getValueState("count_sum", "cnt long, total long")
        elif self.layout == "list":
            self.st = handle.getListState("values", "v long")
        else:
            self.st = handle.getMapState("values", "slot long", "v long")

    def _load(self) -> list[int]:
        if self.layout == "list":
            return [int(r[0]) for r in self.st.get()] if self.st.exists() else []
        return [int(v[0]) for v in self.st.values()] if self.st.exists() else []

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        new = pdf["value"].to_numpy(dtype=np.int64)
        if self.layout == "value":
            cnt, total = (tuple(self.st.get()) if self.st.exists() else (0, 0))
            # The kept sum stands for the first cnt values of the open group.
            values = np.concatenate([[total], np.zeros(cnt - 1, np.int64), new]) if cnt else new
        else:
            values = np.concatenate([np.array(self._load(), np.int64), new])
        groups = len(values) // self.n
        sums, rest = values[:groups * self.n].reshape(groups, self.n).sum(1), values[groups * self.n:].tolist()
        if self.layout == "value":
            if rest:
                self.st.update((len(rest), sum(rest)))
            else:
                self.st.clear()
        else:
            self.st.clear()
            if self.layout == "list" and rest:
                self.st.put([(v,) for v in rest])
            elif rest:
                for slot, v in enumerate(rest):
                    self.st.updateValue((slot,), (v,))
        if groups:
            yield pd.DataFrame({"key": _key(key), "average": sums / self.n})

    def close(self) -> None:
        pass


class RunningSum(StatefulProcessor):
    """Reducing state: emit the running sum per input row.  Input: key, value, seq."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("sum", "v long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        start = self.total.get()[0] if self.total.exists() else 0
        sums = pdf["value"].astype("int64").cumsum() + start
        self.total.update((int(sums.iloc[-1]),))
        yield pd.DataFrame({"key": _key(key), "running_sum": sums})

    def close(self) -> None:
        pass


class RunningConcat(StatefulProcessor):
    """Aggregating state: ``contains:a and b and ...`` per input row."""

    PREFIX, SEP = CONTAINS_PREFIX, CONTAINS_SEP

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "v string")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        acc = self.acc.get()[0] if self.acc.exists() else self.PREFIX
        out = []
        for v in pdf["value"].tolist():
            acc = acc + str(int(v)) if acc == self.PREFIX else acc + self.SEP + str(int(v))
            out.append(acc)
        self.acc.update((acc,))
        yield pd.DataFrame({"key": _key(key), "contains": out})

    def close(self) -> None:
        pass


class IdleCounter(StatefulProcessor):
    """Count rows per key; emit (key, count) once the key has been silent for
    ``gap_ms`` of processing time, then clear (timeMode='processingTime')."""

    def __init__(self, gap_ms: int):
        self.gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues):
        n = sum(len(pdf) for pdf in rows)
        total = (self.count.get()[0] if self.count.exists() else 0) + n
        self.count.update((total,))
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.gap)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.count.exists():
            n = self.count.get()[0]
            self.count.clear()
            yield pd.DataFrame({"key": [str(_key(key))], "n": [n]})

    def close(self) -> None:
        pass


class KeyedReduce(StatefulProcessor):
    """Generic keyed accumulator (the reducing / aggregating state pattern).

    ``init() -> acc``, ``add(acc, value) -> acc`` and ``emit(key, acc, value)
    -> tuple | None`` are plain functions on tuples; ``acc_schema`` is the DDL
    of the accumulator stored in a ValueState.  Rows of a micro-batch are
    folded in ``seq`` order.  Input: key, value, seq.
    """

    def __init__(self, init, add, emit, acc_schema: str, out_columns: list[str]):
        self.init_fn, self.add, self.emit = init, add, emit
        self.acc_schema, self.out_columns = acc_schema, out_columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.acc_schema)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        k = _key(key)
        acc = tuple(self.acc.get()) if self.acc.exists() else self.init_fn()
        out = []
        for v in pdf["value"].tolist():
            acc = self.add(acc, v)
            row = self.emit(k, acc, v)
            if row is not None:
                out.append(row)
        self.acc.update(tuple(acc))
        if out:
            yield pd.DataFrame(out, columns=self.out_columns)

    def close(self) -> None:
        pass


WINDOW_LATE_SCHEMA = "key string, window_start_ms long, n long, late_ts_ms long, kind string"


class WindowCountWithLate(StatefulProcessor):
    """Tumbling event-time window counts per key with a late-data side output.

    Watermark per key = max event time seen before the row - ``delay_ms``.  A
    row whose window has already ended (end <= watermark) is emitted as
    ``kind='late'``; others add to their window's count (MapState).  A window
    is emitted once (``kind='window'``) when the watermark passes its end.
    Input: key, ts_ms, seq.
    """

    def __init__(self, size_ms: int, delay_ms: int):
        self.size, self.delay = size_ms, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.max_ts = handle.getValueState("max_ts", "v long")
        self.counts = handle.getMapState("counts", "start long", "n long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _rows(rows, ["seq"])
        if pdf.empty:
            return
        k = _key(key)
        ts = pdf["ts_ms"].to_numpy(dtype=np.int64)
        prior = self.max_ts.get()[0] if self.max_ts.exists() else None
        lowest = np.iinfo(np.int64).min
        before = np.concatenate([[lowest if prior is None else prior], np.maximum.accumulate(ts)[:-1]])
        if prior is not None:
            before = np.maximum(before, prior)
        starts = ts - np.mod(ts, self.size)
        late = (before != lowest) & (starts + self.size <= before - self.delay)
        for start, n in pd.Series(starts[~late]).value_counts().items():
            key_t = (int(start),)
            old = self.counts.getValue(key_t)[0] if self.counts.containsKey(key_t) else 0
            self.counts.updateValue(key_t, (old + int(n),))
        mx = int(ts.max()) if prior is None else max(prior, int(ts.max()))
        self.max_ts.update((mx,))
        wm = mx - self.delay
        ready = [(int(kt[0]), int(v[0])) for kt, v in self.counts.iterator() if kt[0] + self.size <= wm]
        for start, _ in ready:
            self.counts.removeKey((start,))
        out = [(k, s, n, None, "window") for s, n in sorted(ready)]
        out += [(k, None, None, int(t), "late") for t in ts[late]]
        if out:
            yield pd.DataFrame(out, columns=["key", "window_start_ms", "n", "late_ts_ms", "kind"])

    def close(self) -> None:
        pass
