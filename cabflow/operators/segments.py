"""Driving segments of connected cars.

* gap segments: event-time sessions per car (gap 15 s in the reference);
* stop segments: the moving events between two stops of a car; a segment is
  emitted once the stop that closes it is seen, the open tail never is.

Statistics per segment: number of events, first timestamp, max speed and the
population standard deviation of throttle ("erraticness") with its label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.labels import segment_line, style_label
from cabflow.functions.timecols import micros
from cabflow.operators.scan import Agg, keyed_scan
from cabflow.operators.windows import sessionize


def stats_exprs(ts_ms: Column, speed: Column, throttle: Column, cond: Column | None = None) -> list[Column]:
    """length, startTime (epoch ms), maxSpeed, erraticness over rows matching ``cond``."""
    pick = (lambda c: F.when(cond, c)) if cond is not None else (lambda c: c)
    return [
        F.count(pick(F.lit(1))).cast("int").alias("length"),
        F.min(pick(ts_ms)).alias("startTime"),
        F.max(pick(speed)).cast("float").alias("maxSpeed"),
        F.stddev_pop(pick(throttle.cast("double"))).cast("float").alias("erraticness"),
    ]


def gap_segments(df: DataFrame, key: str, ts: str, tie: str, gap_us: int,
                 speed: str = "speed", throttle: str = "throttle") -> DataFrame:
    """Sessions per car (gap inclusive: a gap exactly ``gap_us`` merges)."""
    s = sessionize(df, [key], ts, tie, gap_us)
    return (s.groupBy(key, "session_start")
             .agg(*stats_exprs(F.unix_millis(F.col(ts).cast("timestamp")), F.col(speed), F.col(throttle)))
             .withColumn("label", style_label("erraticness")))


def stop_segments(df: DataFrame, key: str, ts: str, tie: str, is_stop: Column,
                  speed: str = "speed", throttle: str = "throttle") -> DataFrame:
    """Segments delimited by stop events (disjoint; see SURVEY D3).

    seg = number of stops strictly before the row (``keyed_scan``).  A
    segment's group holds its moving rows and the one stop closing it; keep
    groups that have that stop and at least one moving row.
    """
    base = df.withColumns({"_stop": F.coalesce(is_stop, F.lit(False)).cast("int"),
                           "_t_us": micros(ts)})
    s = keyed_scan(base, [key], ["_t_us", tie], [Agg("_seg", "sum", "_stop", inclusive=False)])
    moving = F.col("_stop") == 0
    return (s.groupBy(key, "_seg")
             .agg(F.max("_stop").alias("_closed"),
                  *stats_exprs(F.unix_millis(F.col(ts).cast("timestamp")), F.col(speed), F.col(throttle), moving))
             .where((F.col("_closed") == 1) & (F.col("length") > 0))
             .withColumn("label", style_label("erraticness"))
             .drop("_closed").withColumnRenamed("_seg", "segment"))


def segment_text(segs: DataFrame, key: str) -> DataFrame:
    """Formatted segment line: ``carId,startTime,<n> events,<max> kph,<label>``."""
    return segs.select(key, "startTime",
                       segment_line(key, "startTime", "length", "maxSpeed", "label").alias("line"))
