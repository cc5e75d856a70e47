"""The reference's jobs as batch pipelines over line files.

Each function takes a session and input path(s) of text lines (plain or
gzip) and returns the job's result DataFrame; ``python -m cabflow.plans.jobs
<job> <paths...>`` prints it.  Streaming variants live in
``cabflow.streaming.jobs``.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.text import tokenize
from cabflow.operators import aggregates, events, joins, keyed, rides, segments, windows
from cabflow.operators.ingest import parse_car_events, parse_fares, parse_key_ts, parse_rides
from cabflow.session import spread
from cabflow.sources.lines import read_lines

# Parameters of the reference jobs (fixed values).
CAR_DELAY_MS = 30_000            # out-of-order bound of car events
SESSION_GAP_US = 15_000_000      # driving sessions
COUNT_WINDOW = 3


def _lines(spark, path):
    """Lines of ``path``; spread over the cores only when there are fewer
    input splits than cores (e.g. a few unsplittable gzip files)."""
    return spread(read_lines(spark, path))


def ride_cleansing(spark: SparkSession, rides_path: str) -> DataFrame:
    """Parse -> NYC filter -> grid cells (bad lines quarantined)."""
    enriched, _ = rides.cleanse(_lines(spark, rides_path))
    return enriched


def ride_count(spark: SparkSession, rides_path: str) -> DataFrame:
    """Running ride count per driver, one row per ride (order: rideId, start first)."""
    good, _ = parse_rides(_lines(spark, rides_path))
    r = rides.filter_nyc(good).withColumn("_end", (~F.col("isStart")).cast("int"))
    return aggregates.running_count(r, ["driverId"], ["rideId", "_end"], out="rides").drop("_end")


def cell_driver_duration(spark: SparkSession, rides_path: str) -> DataFrame:
    """Longest ride (whole minutes) per start cell, with its driver."""
    enriched, _ = rides.cleanse(_lines(spark, rides_path))
    return rides.longest_per_cell(rides.durations(enriched))


def hourly_tips(spark: SparkSession, fares_path: str) -> tuple[DataFrame, DataFrame]:
    """(tips per driver per hour, top driver per hour)."""
    fares, _ = parse_fares(_lines(spark, fares_path))
    per = windows.time_window(fares, "startTime", "1 hour", ["driverId"], {"tips": F.sum("tip")})
    top = aggregates.max_by_key(per, ["window_start", "window_end"], "tips", "driverId", "best")
    return per, top.select("window_start", "window_end", "driverId", F.col("best").alias("tips"))


def _cars(spark, path):
    """Car events with ``seq``, the line order of the input, spread for parsing."""
    good, _ = parse_car_events(_lines(spark, path), keep=["seq"])
    return good


def car_event_sort(spark: SparkSession, cars_path: str) -> tuple[DataFrame, DataFrame]:
    """(events sorted per car with ``pos``, late event ids).  Arrival order is
    the line order of the input (``seq``)."""
    on_time, late = events.late_split(_cars(spark, cars_path), "ts", None, "seq", CAR_DELAY_MS * 1000)
    return (events.sort_by_event_time(on_time.drop("wm_us", "is_late"), ["carId"], "ts", "seq"),
            late.select("id"))


def driving_segments(spark: SparkSession, cars_path: str) -> DataFrame:
    s = segments.stop_segments(_cars(spark, cars_path), "carId", "ts", "seq", F.col("speed") == 0)
    return segments.segment_text(s, "carId")


def driving_sessions(spark: SparkSession, cars_path: str) -> DataFrame:
    return segments.gap_segments(_cars(spark, cars_path), "carId", "ts", "seq", SESSION_GAP_US)


def rides_with_fares(spark: SparkSession, rides_path: str, fares_path: str) -> DataFrame:
    """START ride events joined to their fare (deterministic pairing)."""
    r, _ = parse_rides(_lines(spark, rides_path))
    f, _ = parse_fares(_lines(spark, fares_path))
    return joins.equi_pairs(r.where("isStart"), f.drop("taxiId", "driverId").withColumnRenamed(
        "startTime", "fareTime"), "rideId")


def word_count(spark: SparkSession, text_path: str) -> DataFrame:
    lines = spark.read.text(text_path, wholetext=False)
    words = lines.select(F.explode(tokenize("value")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_window_word_count(spark: SparkSession, text_path: str) -> DataFrame:
    """countWindow(3).sum per word, in line order."""
    words = read_lines(spark, text_path).select("seq", F.posexplode(tokenize("line")).alias("pos", "word"))
    return windows.count_tumbling(words, ["word"], ["seq", "pos"], COUNT_WINDOW,
                                  [F.count(F.lit(1)).alias("n")])


def value_count(spark: SparkSession, path: str) -> DataFrame:
    """``key,epochMillis`` lines -> 10 s / 5 s sliding counts per key."""
    kv, _ = parse_key_ts(_lines(spark, path))
    return windows.time_window(kv, "ts", "10 seconds", ["key"], {"n": F.count(F.lit(1))}, "5 seconds")


def stateful_demo(spark: SparkSession, df: DataFrame) -> dict[str, DataFrame]:
    """The keyed-state demos over (key, value, seq) rows."""
    return {"average": keyed.count_average(df, "key", ["seq"], "value"),
            "sum": keyed.running_sum(df, "key", ["seq"], "value"),
            "contains": keyed.running_concat(df, "key", ["seq"], "value")}


JOBS = {"ride_cleansing": ride_cleansing, "ride_count": ride_count, "cell_driver_duration": cell_driver_duration,
        "hourly_tips": hourly_tips, "car_event_sort": car_event_sort, "driving_segments": driving_segments,
        "driving_sessions": driving_sessions, "rides_with_fares": rides_with_fares, "word_count": word_count,
        "count_window_word_count": count_window_word_count, "value_count": value_count}


def main(argv: list[str]) -> None:
    from cabflow.session import get_session
    spark = get_session()
    out = JOBS[argv[1]](spark, *argv[2:])
    for df in (out if isinstance(out, tuple) else (out,)):
        df.show(50, truncate=False)


if __name__ == "__main__":
    main(sys.argv)


__all__ = [*JOBS, "stateful_demo"]
