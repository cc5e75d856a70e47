"""Streaming job wiring: the reference's jobs as ``readStream`` pipelines.

Every job takes a streaming DataFrame (file, socket or Kafka lines, see
``cabflow.sources.lines``) and returns a streaming DataFrame; starting it
needs a sink and a checkpoint location on durable shared storage (offsets +
RocksDB state), which replaces the reference's checkpoint/state-backend
settings.  ``start`` sets a 10-second processing-time trigger by default,
matching the reference's checkpoint interval.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.functions.labels import segment_line
from cabflow.functions.text import text_lines, tokenize
from cabflow.operators import rides as ride_ops
from cabflow.operators.ingest import parse_car_events, parse_fares, parse_rides
from cabflow.session import prepare
from cabflow.streaming import processors, timed
from cabflow.streaming.sinks import batched, write_groups
from cabflow.streaming.processors import (AVERAGE_SCHEMA, CONCAT_SCHEMA, IDLE_SCHEMA, PAIR_SCHEMA, SEGMENT_SCHEMA,
                                          SORTED_SCHEMA, SUM_SCHEMA, CountAverage, EventSorter, FirstComePairing,
                                          IdleCounter, RunningConcat, RunningSum, StopSegmenter,
                                          WINDOW_LATE_SCHEMA, KeyedReduce, WindowCountWithLate)

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}


def start(df: DataFrame, sink: str, checkpoint: str, mode: str = "append", trigger: dict | None = None,
          **options):
    """Start a streaming query on ``sink`` with its checkpoint location (offsets
    and state on shared storage) and a 10-second trigger unless given."""
    w = df.writeStream.format(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()


# ------------------------------------------------------------ stateless jobs

def cleanse(lines: DataFrame) -> DataFrame:
    """Ride cleansing stream: parse (quarantine bad lines) -> NYC -> grid cells."""
    enriched, _ = ride_ops.cleanse(lines)
    return enriched


def word_counts(lines: DataFrame) -> DataFrame:
    """Running word count (outputMode 'update': one row per changed word per batch)."""
    words = lines.select(F.explode(text_lines("line")).alias("l")).select(F.explode(tokenize("l")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------- event-time windows

def hourly_tips(fares: DataFrame, delay: str = "10 seconds") -> tuple[DataFrame, DataFrame]:
    """Per-driver hourly tip sums and the top driver per hour (chained windows,
    append mode; the second window groups by ``window_time`` of the first)."""
    f = fares.withWatermark("startTime", delay)
    per = (f.groupBy(F.window("startTime", "1 hour").alias("w"), "driverId")
            .agg(F.sum("tip").alias("tips")))
    top = (per.select(F.window_time("w").alias("t"), "driverId", "tips")
              .groupBy(F.window("t", "1 hour").alias("w"))
              .agg(F.max_by(F.struct("driverId", "tips"), F.struct(F.col("tips"), -F.col("driverId"))).alias("top")))
    return per, top.select(F.col("w.start").alias("window_start"), "top.driverId", "top.tips")


def ride_counts(ride_lines: DataFrame) -> DataFrame:
    """Rides per driver so far (outputMode 'update')."""
    good, _ = parse_rides(ride_lines)
    return ride_ops.ride_counts(ride_ops.filter_nyc(good))


def cell_driver_duration(ride_lines: DataFrame) -> DataFrame:
    """Longest ride per start cell so far, with its driver (outputMode 'update';
    a stream has one aggregation, so ties are broken inside it)."""
    enriched, _ = ride_ops.cleanse(ride_lines)
    best = F.max(F.struct(F.col("minutes"), (-F.col("driverId")).alias("d"))).alias("best")
    longest = ride_ops.durations(enriched).groupBy("startCell").agg(best)
    return longest.select("startCell", F.col("best.minutes").alias("max_minutes"), (-F.col("best.d")).alias("driverId"))


def windowed_counts(events: DataFrame, ts: str, key: str, size: str, slide: str | None = None,
                    delay: str = "10 seconds", offset: str | None = None) -> DataFrame:
    """Tumbling / sliding (optionally offset) event-time window counts per key, append mode."""
    return (events.withWatermark(ts, delay)
            .groupBy(F.window(ts, size, slide or size, offset or "0 seconds").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n"))


def window_contents(events: DataFrame, ts: str, key: str, item, size: str,
                    delay: str = "10 seconds", sep: str = ", ") -> DataFrame:
    """Each closed window's items as one text, sorted by event time (append mode)."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(ts).alias("o"), item.alias("v"))))
    return (events.withWatermark(ts, delay)
            .groupBy(F.window(ts, size).alias("w"), key)
            .agg(F.array_join(F.transform(pairs, lambda x: x["v"]), sep).alias("items"))
            .select(F.col("w.start").alias("window_start"), key, "items"))


def gap_sessions(events: DataFrame, ts: str, key: str, gap: str, delay: str = "30 seconds") -> DataFrame:
    """Event-time sessions per car (native ``session_window``, append mode)."""
    return (events.withWatermark(ts, delay)
            .groupBy(F.session_window(ts, gap).alias("s"), key)
            .agg(F.count(F.lit(1)).cast("int").alias("length"), F.min(F.unix_millis(ts)).alias("startTime"),
                 F.max("speed").alias("maxSpeed"), F.stddev_pop("throttle").cast("float").alias("erraticness"))
            .select(key, F.col("s.start").alias("session_start"), "length", "startTime", "maxSpeed", "erraticness"))


def session_counts(events: DataFrame, ts: str, key: str, gap, delay: str = "10 seconds") -> DataFrame:
    """Rows per session window per key; ``gap`` is a duration string or a
    per-row Column (dynamic gap).  Append mode."""
    return (events.withWatermark(ts, delay)
            .groupBy(F.session_window(ts, gap).alias("s"), key).agg(F.count(F.lit(1)).alias("n"))
            .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n"))


# ----------------------------------------------------------- keyed state

# Spark builds a processor in a process of its own, which has neither this
# driver's path nor files shipped to executors: send the code itself.
cloudpickle.register_pickle_by_value(processors)
cloudpickle.register_pickle_by_value(timed)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _seq(df: DataFrame) -> DataFrame:
    """The input, which must have ``seq``, its arrival order (the line sources
    supply it): without it the result would depend on how Spark deals rows."""
    if "seq" not in df.columns:
        raise ValueError("keyed state works in arrival order: the input needs a column 'seq' (see cabflow.sources.lines)")
    prepare(df.sparkSession)
    return df


def _seq_text(df: DataFrame):
    """``seq`` as text that sorts like it (whole numbers are padded)."""
    c = F.col("seq").cast("string")
    return (c if dict(df.dtypes)["seq"] == "string" else F.lpad(c, 19, "0")).alias("seq")


def _json(*columns: str):
    return F.to_json(F.struct(*columns))


def _record(column: str, df: DataFrame, names: list[str]):
    return F.from_json(column, T.StructType([T.StructField(f.name, f.dataType) for f in df.select(*names).schema.fields]))


def sort_events(cars: DataFrame, delay_ms: int = 30_000, per_key: bool = True) -> DataFrame:
    """Per-car event-time sort (timeMode none: lossless): key, id, ts_ms, kind
    ('sorted' or 'late') and the whole event.  ``per_key`` False: one watermark
    over the whole stream instead of one per car, as in the batch form; one
    state group then sees every row, which is what a global order costs."""
    src, names = _seq(cars), [c for c in cars.columns if c != "seq"]
    rows = src.select((F.col("carId") if per_key else F.lit("")).cast("string").alias("key"), F.col("carId").cast("string").alias("car"),
                      F.col("id").cast("string").alias("id"), F.col("timestamp").alias("ts_ms"), _json(*names).alias("event"),
                      _seq_text(src))
    out = rows.groupBy("key").transformWithStateInPandas(EventSorter(delay_ms), SORTED_SCHEMA, "append", "None")
    return out.select(F.col("car").alias("key"), "id", "ts_ms", "kind", _record("event", src, names).alias("event"))


def stop_segments(cars: DataFrame, delay_ms: int = 30_000) -> DataFrame:
    src = _seq(cars).select(F.col("carId").cast("string").alias("key"), F.col("timestamp").alias("ts_ms"), "speed", "throttle", _seq_text(cars))
    return src.groupBy("key").transformWithStateInPandas(StopSegmenter(delay_ms), SEGMENT_SCHEMA, "append", "None")


def pair_rides_fares(rides: DataFrame, fares: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Reference-faithful pairing: tagged union keyed by rideId, one waiting
    element.  Emits key and the records as structs ``ride`` and ``fare``; a
    waiting element older than ``ttl_ms`` (processing time) is forgotten."""
    sides = [(_seq(d), [c for c in d.columns if c != "seq"]) for d in (rides, fares)]
    r, f = (d.select(F.col("rideId").alias("key"), F.lit(side).alias("side"), F.col("rideId").alias("id"), F.unix_millis("startTime").alias("ts_ms"),
                     _json(*names).alias("rec"), _seq_text(d))
            for side, (d, names) in enumerate(sides))
    pairs = r.unionByName(f).groupBy("key").transformWithStateInPandas(FirstComePairing(ttl_ms), PAIR_SCHEMA, "append", "ProcessingTime" if ttl_ms else "None")
    return pairs.select("key", _record("left_rec", rides, sides[0][1]).alias("ride"), _record("right_rec", fares, sides[1][1]).alias("fare"))


def rides_join_fares(rides: DataFrame, fares: DataFrame, bound: str = "2 hours",
                     delay: str = "1 hour") -> DataFrame:
    """Deterministic form: START rides inner-joined to fares on rideId, with
    watermarks on both sides and a time bound so join state is purged."""
    r = rides.where("isStart").withWatermark("startTime", delay).alias("r")
    f = fares.withWatermark("startTime", delay).alias("f")
    cond = ((F.col("r.rideId") == F.col("f.rideId"))
            & (F.col("f.startTime") >= F.col("r.startTime") - F.expr(f"INTERVAL {bound}"))
            & (F.col("f.startTime") <= F.col("r.startTime") + F.expr(f"INTERVAL {bound}")))
    return r.join(f, cond, "inner").select(F.struct("r.*").alias("ride"), F.struct("f.*").alias("fare"))


def rides_with_fares_to_files(ride_lines: DataFrame, fare_lines: DataFrame, path: str, checkpoint: str,
                              threshold: int | None = None, ttl_ms: int | None = None, trigger: dict | None = None):
    """End-to-end durable job: ride and fare line streams -> typed records ->
    consume-on-match pairing (state in RocksDB under ``checkpoint``) -> files
    (idempotent per batch id; ``threshold`` caps the records of a file).
    Returns the started query."""
    rides, _ = parse_rides(ride_lines, keep=["seq"])
    fares, _ = parse_fares(fare_lines, keep=["seq"])
    pairs = pair_rides_fares(rides, fares, ttl_ms)
    return batched(pairs, path, checkpoint, threshold=threshold, trigger=trigger or DEFAULT_TRIGGER)


def driving_segments_text(car_lines: DataFrame, delay_ms: int = 30_000) -> DataFrame:
    """Car event lines -> typed events -> stop segments -> segment text lines."""
    cars, _ = parse_car_events(car_lines, keep=["seq"])
    segs = stop_segments(cars, delay_ms)
    return segs.select("key", "startTime",
                       segment_line("key", "startTime", "length", "maxSpeed", "label").alias("line"))


def keyed_state(df: DataFrame, kind: str, n: int = 3, layout: str = "value") -> DataFrame:
    """The keyed-state demos over (key, value, seq) rows: 'average', 'sum', 'concat'."""
    src = _seq(df)
    g = src.groupBy("key")
    if kind == "average":
        return g.transformWithStateInPandas(CountAverage(n, layout), AVERAGE_SCHEMA, "append", "None")
    if kind == "sum":
        return g.transformWithStateInPandas(RunningSum(), SUM_SCHEMA, "append", "None")
    if kind == "concat":
        return g.transformWithStateInPandas(RunningConcat(), CONCAT_SCHEMA, "append", "None")
    raise ValueError(kind)


def window_counts_with_late(events: DataFrame, size_ms: int, delay_ms: int) -> DataFrame:
    """Tumbling window counts per key plus late rows as a side output
    (``kind`` = 'window' | 'late').  Input columns: key, ts_ms, seq."""
    src = _seq(events)
    return src.groupBy("key").transformWithStateInPandas(
        WindowCountWithLate(size_ms, delay_ms), WINDOW_LATE_SCHEMA, "append", "None")


def _count_add(n: int, accumulate: bool):
    def add(acc, v):
        cnt, total = acc
        if not accumulate and cnt == n:       # the previous window fired: purge
            cnt, total = 0, 0
        return (cnt + 1, total + int(v))
    return add


def count_windows(df: DataFrame, n: int = 3, accumulate: bool = False) -> DataFrame:
    """Count windows of ``n`` rows per key over (key, value, seq) rows:
    tumbling (fire and purge every n rows) or accumulating (fire at n, 2n, ...
    with the running total).  Output: key, n_rows, total."""
    proc = KeyedReduce(init=lambda: (0, 0), add=_count_add(n, accumulate),
                       emit=lambda k, acc, v: (k, acc[0], acc[1]) if acc[0] % n == 0 else None,
                       acc_schema="cnt long, total long", out_columns=["key", "n_rows", "total"])
    return _seq(df).groupBy("key").transformWithStateInPandas(
        proc, "key string, n_rows long, total long", "append", "None")


def idle_counts(words: DataFrame, gap_ms: int = 5_000) -> DataFrame:
    prepare(words.sparkSession)
    return (words.select(F.col("word").alias("key")).groupBy("key")
            .transformWithStateInPandas(IdleCounter(gap_ms), IDLE_SCHEMA, "update", "ProcessingTime"))


# ------------------------------------------------- timers: silent keys included

def sort_events_by_clock(cars: DataFrame, delay_ms: int = 30_000) -> DataFrame:
    """Per-car event-time sort under the watermark of the whole stream: a car that
    falls silent gets its rows when the others' time has passed.  Same columns as
    ``sort_events``; late rows come out with kind 'late'."""
    src, names = _seq(cars), [c for c in cars.columns if c != "seq"]
    rows = src.select(F.col("carId").cast("string").alias("key"), F.col("carId").cast("string").alias("car"), F.col("id").cast("string").alias("id"),
                      F.col("timestamp").alias("ts_ms"), _json(*names).alias("event"), _seq_text(src))
    out = timed.job_clock(rows, "ts_ms", delay_ms).groupBy("key").transformWithStateInPandas(timed.JobSorter(), timed.SORTED, "append", "EventTime")
    return out.select(F.col("car").alias("key"), "id", "ts_ms", "kind", _record("event", src, names).alias("event"))


def stop_segments_by_clock(cars: DataFrame, delay_ms: int = 30_000, is_stop: Column | None = None) -> DataFrame:
    """Stop segments under the watermark of the whole stream.  ``is_stop``: the stop
    predicate over the input's columns (speed 0 if not given)."""
    src = _seq(cars)
    stop = F.coalesce(is_stop if is_stop is not None else F.col("speed") == 0, F.lit(False)).alias("stop")
    rows = src.select(F.col("carId").cast("string").alias("key"), F.col("timestamp").alias("ts_ms"), _seq_text(src),
                      F.col("speed").cast("float").alias("speed"), F.col("throttle").cast("float").alias("throttle"), stop)
    return timed.job_clock(rows, "ts_ms", delay_ms).groupBy("key").transformWithStateInPandas(timed.JobSegmenter(), timed.SEGMENTS, "append", "EventTime")


def window_firings(events: DataFrame, size_ms: int, delay_ms: int, allowed_ms: int = 0, edge_ms: int = 0) -> DataFrame:
    """Tumbling counts per key: one row per firing with its number, late rows as a
    side output.  Input: key, ts_ms, seq."""
    src = _seq(events).select(F.col("key").cast("string").alias("key"), "ts_ms", _seq_text(events))
    return timed.job_clock(src, "ts_ms", delay_ms).groupBy("key").transformWithStateInPandas(
        timed.JobWindows(size_ms, allowed_ms, edge_ms), timed.WINDOWS, "append", "EventTime")


def session_aggregate(events: DataFrame, gap_ms: int, delay_ms: int, agg) -> DataFrame:
    """A ``useragg.UserAggregate`` per session; sessions that join are merged.
    Input: key, ts_ms, value, seq."""
    src = _seq(events).select(F.col("key").cast("string").alias("key"), "ts_ms", "value", _seq_text(events))
    out = T.StructType.fromDDL(agg.result_schema)
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("session_start_ms", T.LongType()), T.StructField("session_end_ms", T.LongType()),
                           *out.fields, T.StructField("late_ts_ms", T.LongType()), T.StructField("kind", T.StringType())])
    proc = timed.JobSessions(gap_ms, agg.init, agg.add, agg.merge, agg.result, agg.acc_schema, out.names)
    return timed.job_clock(src, "ts_ms", delay_ms).groupBy("key").transformWithStateInPandas(proc, schema, "append", "EventTime")


def pairs_and_unmatched(rides: DataFrame, fares: DataFrame, ttl_ms: int, delay_ms: int = 0) -> DataFrame:
    """Every ride and fare comes out once: in a pair, or alone as 'replaced' or
    'expired' (``ttl_ms`` of event time without a partner).  Columns: key, kind and
    the records as structs ``ride`` and ``fare``."""
    sides = [(_seq(d), [c for c in d.columns if c != "seq"]) for d in (rides, fares)]
    r, f = (d.select(F.col("rideId").cast("long").alias("key"), F.lit(side).alias("side"), F.unix_millis("startTime").alias("ts_ms"), _json(*names).alias("rec"), _seq_text(d))
            for side, (d, names) in enumerate(sides))
    out = timed.job_clock(r.unionByName(f), "ts_ms", delay_ms).groupBy("key").transformWithStateInPandas(timed.JobPairing(ttl_ms), timed.PAIRS, "append", "EventTime")
    return out.select("key", "kind", _record("left_rec", rides, sides[0][1]).alias("ride"), _record("right_rec", fares, sides[1][1]).alias("fare"))


def hourly_top(fares: DataFrame, n: int = 3, delay: str = "10 seconds") -> DataFrame:
    """The ``n`` drivers with the largest tip sum of every hour, ranked: sums by
    Spark's own windowed aggregate, then one bounded heap per window."""
    prepare(fares.sparkSession)
    per, _ = hourly_tips(fares, delay)
    rows = per.select(F.unix_millis(F.col("w.end")).alias("end_ms"), F.col("driverId").cast("long").alias("id"), F.col("tips").cast("double").alias("value"))
    top = rows.groupBy("end_ms").transformWithStateInPandas(timed.JobTop(n, 3_600_000), timed.TOP, "append", "EventTime")
    return top.select(F.timestamp_millis("window_start_ms").alias("window_start"), "rank", F.col("id").alias("driverId"), F.col("value").alias("tips"))


def sliding_word_counts(words: DataFrame, size_ms: int = 10_000, slide_ms: int = 5_000) -> DataFrame:
    """Words per processing-time sliding window, from panes.  Input: word."""
    prepare(words.sparkSession)
    return (words.select(F.col("word").alias("key")).groupBy("key")
            .transformWithStateInPandas(timed.PaneCounts(size_ms, slide_ms), timed.PANES, "update", "ProcessingTime"))


def wallclock_counts(events: DataFrame, size_ms: int = 10_000, slide_ms: int = 5_000, delay_ms: int = 5_000, clock=None) -> DataFrame:
    """Event-time sliding counts closed by the wall clock less ``delay_ms``, late
    rows (of no window still open) as a side output.  Input: key, ts_ms, seq."""
    src = _seq(events).select(F.col("key").cast("string").alias("key"), "ts_ms", _seq_text(events))
    return src.groupBy("key").transformWithStateInPandas(timed.WallWindows(size_ms, slide_ms, delay_ms, clock), timed.WALL, "update", "ProcessingTime")


def record_groups(df: DataFrame, record: Column, threshold: int = 20, shards: int = 1, flush_ms: int | None = None) -> DataFrame:
    """Records in groups of exactly ``threshold``, buffered across micro-batches: shard,
    group_no, pos, whole, record.  One shard keeps one buffer, as the reference's
    single sink does; more shards are as many buffers side by side."""
    src = _seq(df)
    rows = src.select(F.pmod(F.xxhash64(_seq_text(src)), F.lit(shards)).cast("int").alias("shard"), record.cast("string").alias("record"), _seq_text(src))
    mode = "None" if flush_ms is None else "ProcessingTime"
    return rows.groupBy("shard").transformWithStateInPandas(timed.GroupBuffer(threshold, flush_ms), timed.GROUPS, "append" if flush_ms is None else "update", mode)


def grouped_to_files(df: DataFrame, record: Column, path: str, checkpoint: str, threshold: int = 20, shards: int = 1,
                     flush_ms: int | None = None, trigger: dict | None = None):
    """``record_groups`` written by ``sinks.write_groups``; returns the started query."""
    groups = record_groups(df, record, threshold, shards, flush_ms)
    w = groups.writeStream.foreachBatch(lambda b, i: write_groups(b, path)).option("checkpointLocation", checkpoint)
    return w.outputMode("append" if flush_ms is None else "update").trigger(**(trigger or DEFAULT_TRIGGER)).start()


__all__ = ["start", "cleanse", "word_counts", "hourly_tips", "windowed_counts", "gap_sessions", "sort_events",
           "stop_segments", "pair_rides_fares", "rides_join_fares", "keyed_state", "idle_counts",
           "window_counts_with_late", "window_contents", "count_windows", "session_counts",
           "rides_with_fares_to_files", "driving_segments_text", "ride_counts", "cell_driver_duration",
           "sort_events_by_clock", "stop_segments_by_clock", "window_firings", "session_aggregate", "pairs_and_unmatched",
           "hourly_top", "sliding_word_counts", "wallclock_counts", "record_groups", "grouped_to_files"]
