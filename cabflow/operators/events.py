"""Event-time operators over an arrival order: watermarks, late rows, sorting.

Batch replays a stream: every row has an arrival position (``arrival`` time
plus a unique tie-breaker).  The watermark a row sees on arrival is

    wm(row) = max(event time of all rows that arrived before it) - delay

(punctuated, never regressing).  A row is late iff ``ts <= wm(row)``.  The
prefix maximum over the whole arrival order is a scan over slots: a maximum
inside every slot of arrival, then one over the slots' maxima, so only one
row per slot ever meets in a single task.

Variants: the watermark advanced only by marker rows, and a wall-clock
watermark (``arrival - delay``) that needs no scan at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.timecols import micros
from cabflow.operators.scan import Agg, keyed_scan


def with_watermark(df: DataFrame, ts: str, arrival: str | None, tie: str, delay_us: int,
                   advance_when: Column | None = None, out: str = "wm_us",
                   keys: list[str] | None = None, emit_every: str | None = None) -> DataFrame:
    """Add the watermark (epoch micros) each row sees when it arrives.

    ``keys`` empty (default): one watermark over the whole stream; with keys,
    one per key (what the streaming sorter keeps in its state).  ``arrival``
    None: ``tie`` alone is the arrival order (such as ``seq`` of a line source).
    ``emit_every``: a column that numbers the periods of arrival; the watermark
    is then periodic, given out at the end of each, so that the rows of a period see
    what earlier periods held (a stream's micro-batches, or a watermark interval).
    """
    t = micros(ts)
    src = F.when(advance_when, t) if advance_when is not None else t
    if emit_every is not None:
        by = [*(keys or []), emit_every]
        periods = df.groupBy(*by).agg(F.max(src).alias("_wm_src"))
        seen = keyed_scan(periods, list(keys or []), [emit_every], [Agg("_prev_max", "max", "_wm_src", inclusive=False)])
        seen = seen.select(*[F.col(c).alias(f"_wm_by_{i}") for i, c in enumerate(by)], (F.col("_prev_max") - F.lit(delay_us)).alias(out))
        on = [F.col(c).eqNullSafe(F.col(f"_wm_by_{i}")) for i, c in enumerate(by)]
        return df.join(seen, on).select(*df.columns, out)
    base = df.withColumn("_wm_src", src)
    order = [tie]
    if arrival is not None:
        base, order = base.withColumn("_arr_us", micros(arrival)), ["_arr_us", tie]
    s = keyed_scan(base, list(keys or []), order, [Agg("_prev_max", "max", "_wm_src", inclusive=False)])
    return (s.withColumn(out, F.col("_prev_max") - F.lit(delay_us))
             .drop("_wm_src", "_arr_us", "_prev_max"))


def late_split(df: DataFrame, ts: str, arrival: str | None, tie: str, delay_us: int,
               advance_when: Column | None = None,
               keys: list[str] | None = None, emit_every: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(on_time, late).  Together they are exactly the input rows."""
    w = with_watermark(df, ts, arrival, tie, delay_us, advance_when, keys=keys, emit_every=emit_every)
    is_late = F.coalesce(micros(ts) <= F.col("wm_us"), F.lit(False))
    flagged = w.withColumn("is_late", is_late)
    return flagged.where(~F.col("is_late")), flagged.where(F.col("is_late"))


def late_wallclock(ts: str | Column, arrival: str, delay_us: int) -> Column:
    """Late flag of a time (an event's, or the end of its window) against a
    wall-clock watermark ``arrival - delay``."""
    return micros(ts) <= micros(arrival) - F.lit(delay_us)


def sort_by_event_time(on_time: DataFrame, keys: list[str], ts: str, tie: str,
                       out: str = "pos") -> DataFrame:
    """Per-key event-time order: the release position of every on-time row.

    The reference buffers rows in a priority queue until the watermark
    passes; with all rows at hand the released sequence is the rows sorted by
    (ts, tie) per key.  ``pos`` (1-based) makes that order part of the data.
    """
    base = on_time.withColumn("_t_us", micros(ts))
    s = keyed_scan(base, keys, ["_t_us", tie], [Agg(out, "count")])
    return s.drop("_t_us")


def window_late_split(df: DataFrame, ts: str, arrival: str, tie: str, size: str,
                      delay_us: int, allowed_lateness_us: int = 0,
                      edge_us: int = 0, emit_every: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a tumbling window whose end (+ allowed lateness) is already
    behind the watermark at arrival go to the side output
    (sideOutputLateData); others are kept with their ``window_start`` /
    ``window_end``.  With allowed lateness a window re-fires for rows that
    arrive after its end but within the allowance; the final counts are the
    same as counting every accepted row once.  A row is late at ``end <=
    watermark``; ``edge_us`` moves that edge (1000: ``end - 1 ms``, a window's
    last millisecond, as the source API counts)."""
    w = with_watermark(df, ts, arrival, tie, delay_us, emit_every=emit_every)
    win = F.window(ts, size)
    flagged = (w.withColumn("_w", win)
                .withColumn("window_start", F.col("_w.start"))
                .withColumn("window_end", F.col("_w.end")).drop("_w")
                .withColumn("is_late", F.coalesce(micros("window_end") + F.lit(allowed_lateness_us - edge_us)
                                                  <= F.col("wm_us"), F.lit(False))))
    return flagged.where(~F.col("is_late")), flagged.where(F.col("is_late"))


def window_firings(df: DataFrame, ts: str, arrival: str, tie: str, size: str, delay_us: int, allowed_lateness_us: int,
                   keys: list[str], edge_us: int = 0, emit_every: str | None = None) -> DataFrame:
    """Every firing of tumbling windows with allowed lateness: ``window_start``,
    keys, ``firing`` (from 1) and ``n``, the rows counted so far.

    A window fires when the watermark reaches its end, with the rows that came
    before (at the latest when the input ends), and again for each row that
    arrives within the allowance: firing numbers follow the arrival order.
    """
    kept, _ = window_late_split(df, ts, arrival, tie, size, delay_us, allowed_lateness_us, edge_us, emit_every)
    by = ["window_start", *keys]
    again = F.coalesce(micros("window_end") - F.lit(edge_us) <= F.col("wm_us"), F.lit(False))
    rows = kept.select(*by, micros(arrival).alias("_arr_us"), F.col(tie).alias("_tie"), again.alias("_again"))
    first = rows.groupBy(*by).agg(F.count_if(~F.col("_again")).alias("_first")).where("_first > 0")
    later = keyed_scan(rows.where("_again"), by, ["_arr_us", "_tie"], [Agg("_nth", "count")])
    named = first.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(by)], F.col("_first"))
    on = [F.col(c).eqNullSafe(F.col(f"_w{i}")) for i, c in enumerate(by)]
    refired = later.join(named, on, "left").select(*by, (F.col("_nth") + F.col("_first").isNotNull().cast("int")).cast("int").alias("firing"),
                                                   (F.coalesce("_first", F.lit(0)) + F.col("_nth")).alias("n"))
    return first.select(*by, F.lit(1).alias("firing"), F.col("_first").alias("n")).unionByName(refired)
