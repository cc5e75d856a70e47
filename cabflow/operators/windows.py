"""Time windows (tumbling, sliding, with offset, keyed or over all rows),
count windows, sessions with static or per-row gaps, and window contents.

Time windows are ``groupBy(F.window(...))`` aggregates: partial aggregation
per input partition, one shuffle of (window, key) partials.  A non-keyed
window is the same aggregate without a key, so unlike the reference it is
never a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.timecols import micros
from cabflow.operators.scan import Agg, keyed_scan, session_scan


def time_window(df: DataFrame, ts: str, size: str, keys: list[str], aggs: dict[str, Column],
                slide: str | None = None, offset: str | None = None) -> DataFrame:
    """Aggregate per (window, keys).  ``slide`` None -> tumbling.  Output has
    ``window_start`` / ``window_end`` columns (same timestamp type as ``ts``)."""
    w = F.window(ts, size, slide or size, offset or "0 seconds")
    return (df.groupBy(w.alias("w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, *aggs.keys()))


def pane_windows(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str],
                 aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Sliding windows by panes: a row is aggregated once, into the pane of its
    slide, and panes are combined into the windows that hold them.

    ``F.window`` copies every row ``size / slide`` times before it aggregates; here
    only panes (at most one per key and slide) are copied.  ``aggs``: name -> (op,
    column) with op count, sum, min or max.  ``size_us`` is a multiple of
    ``slide_us``; rows without a time belong to no window."""
    if size_us % slide_us or slide_us <= 0:
        raise ValueError("the size must be a multiple of the slide")
    unknown = {op for op, _ in aggs.values()} - {"count", "sum", "min", "max"}
    if unknown:
        raise ValueError(f"panes cannot be combined for: {', '.join(sorted(unknown))}")
    made = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    joined = made | {"count": F.sum}
    pane = F.floor(micros(ts) / F.lit(slide_us)).cast("long").alias("_pane")
    panes = df.where(F.col(ts).isNotNull()).groupBy(*keys, pane).agg(*[made[op](c).alias(n) for n, (op, c) in aggs.items()])
    first = F.col("_pane") - F.lit(size_us // slide_us - 1)
    windows = panes.select(*keys, *aggs, F.explode(F.sequence(first, F.col("_pane"))).alias("_window"))
    out = windows.groupBy(*keys, "_window").agg(*[joined[op](n).alias(n) for n, (op, _) in aggs.items()])
    start = F.col("_window") * F.lit(slide_us)
    return out.select(F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + F.lit(size_us)).alias("window_end"), *keys, *aggs)


def count_tumbling(df: DataFrame, keys: list[str], order: list[str], n: int,
                   aggs: list[Column]) -> DataFrame:
    """Tumbling count window of ``n`` rows per key (countWindow(n)).

    The row number per key comes from ``keyed_scan``; bucket = (rn - 1) div n.  Only full buckets are emitted (a partial group never
    fires), so the output is exactly floor(count / n) rows per key.
    """
    numbered = keyed_scan(df, keys, order, [Agg("_rn", "count")])
    bucket = F.floor((F.col("_rn") - 1) / F.lit(n)).cast("long")
    return (numbered.withColumn("bucket", bucket)
            .groupBy(*keys, "bucket")
            .agg(F.count(F.lit(1)).alias("_cnt"), *aggs)
            .where(F.col("_cnt") == n).drop("_cnt"))


def count_accumulating(df: DataFrame, keys: list[str], order: list[str], n: int,
                       value: str, out: str = "total") -> DataFrame:
    """Global window + count trigger ``n`` without purge: at every n-th row of
    a key emit the running total over all rows so far."""
    scanned = keyed_scan(df, keys, order, [Agg("n_rows", "count"), Agg(out, "sum", value)])
    return scanned.where(F.col("n_rows") % n == 0).select(*keys, "n_rows", out)


def sessionize(df: DataFrame, keys: list[str], ts: str, tie: str, gap_us: Column | int,
               out: str = "session_start") -> DataFrame:
    """Assign every row the start of its session (same semantics as Spark's
    ``session_window``): a row opens a new session when its time is beyond
    ``max(previous time + previous gap)`` of its key; touching sessions merge.

    ``gap_us`` is a literal number of microseconds or a per-row Column.
    Rows keep their columns plus ``out`` and ``_end_us``.
    """
    gap = F.lit(gap_us) if isinstance(gap_us, int) else gap_us
    base = df.withColumns({"_t_us": micros(ts), "_end_us": micros(ts) + gap.cast("long")})
    s = session_scan(base, keys, "_t_us", "_end_us", tie, out="_sess_us")
    return s.withColumn(out, F.timestamp_micros(F.col("_sess_us"))).drop("_sess_us", "_t_us")


def sessions(df: DataFrame, keys: list[str], ts: str, tie: str, gap_us: Column | int,
             aggs: list[Column]) -> DataFrame:
    """Session windows per key: ``session_start``, ``session_end`` (= max row
    end) and the given aggregates."""
    s = sessionize(df, keys, ts, tie, gap_us)
    return (s.groupBy(*keys, "session_start")
             .agg(F.timestamp_micros(F.max("_end_us")).alias("session_end"), *aggs))


def sessions_builtin(df: DataFrame, keys: list[str], ts: str, gap: str | Column,
                     aggs: list[Column]) -> DataFrame:
    """Same result via Spark's ``session_window`` (one task per key; used as
    a cross-check and for streaming, where it is the native operator)."""
    return (df.groupBy(F.session_window(ts, gap).alias("s"), *keys).agg(*aggs)
              .withColumn("session_start", F.col("s.start"))
              .withColumn("session_end", F.col("s.end")).drop("s"))


def window_contents(df: DataFrame, ts: str, size: str, keys: list[str], item: Column,
                    order: list[str], out: str = "item") -> DataFrame:
    """The elements of every window as rows (window_start, keys, pos, item),
    ``pos`` from 1 in the given order: a window of any size stays rows, and no
    task holds its list: a hot window is cut by its rows, as every scan is."""
    d = df.withColumns({"window_start": F.window(ts, size)["start"], out: item})
    return keyed_scan(d, ["window_start", *keys], order, [Agg("pos", "count")]).select("window_start", *keys, "pos", out)


def collect_window(df: DataFrame, ts: str, size: str, keys: list[str], item: Column,
                   order: list[str], sep: str = ", ", out: str = "items") -> DataFrame:
    """``window_contents`` printed: one text per window.  For windows that are
    known to be small; a text is one value and must fit a task."""
    rows = window_contents(df, ts, size, keys, item, order, "_item")
    parts = F.sort_array(F.collect_list(F.struct("pos", "_item")))
    return rows.groupBy("window_start", *keys).agg(F.array_join(F.transform(parts, lambda x: x["_item"]), sep).alias(out))
