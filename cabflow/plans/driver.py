"""Registered queries: every operator of the inventory applied to the driver
tables with the role map of ``cabflow.sources.tables``.

Each query is ``(spark, sf_dir) -> DataFrame`` over whole tables.  Output
timestamps are TIMESTAMP_NTZ (like the tables); money-like sums are summed
as integer cents so two engines agree bit for bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.geo import grid_cell, in_bbox
from cabflow.functions.labels import style_label
from cabflow.functions.text import text_lines, tokenize
from cabflow.functions.timecols import as_ntz, micros, whole_minutes
from cabflow.operators import aggregates, events as ev, joins, keyed, rides, segments, useragg, windows
from cabflow.operators.ingest import parse_car_events, parse_fares, parse_key_ts, parse_rides
from cabflow.session import spread
from cabflow.streaming import sinks
from cabflow.sources.tables import (END_LAT_MOD, END_LON_MOD, LAT_BASE, LAT_MOD, LON_BASE, LON_MOD,
                                    arrival, coord, table)

HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000
# Parameters of the driver-table role map (shared with the oracle SQL).
LATE_DELAY_US = HOUR_US            # out-of-order tolerance for the sorter
WINDOW_LATE_DELAY_US = 10 * MINUTE_US
WALLCLOCK_DELAY_US = 30 * MINUTE_US
ALLOWED_LATENESS_US = 20 * MINUTE_US
WATERMARK_PERIOD_US = 30 * MINUTE_US  # of arrival, for the periodic watermark
SESSION_GAP_US = 12 * HOUR_US
IDLE_GAP_US = 6 * HOUR_US
MARKER_TYPE = "signup"
COUNT_WINDOW = 3
ORDER = ["ts", "event_id"]


def _events(spark, d, *cols):
    return table(spark, d, "events").select(*cols)


def _cents(c="value"):
    return F.round(F.col(c) * 100).cast("long")


def _dyn_gap_us():
    return (F.when(F.col("event_type") == "click", F.lit(10 * HOUR_US))
             .when(F.col("event_type") == "view", F.lit(20 * HOUR_US))
             .otherwise(F.lit(5 * HOUR_US)))


# ---------------------------------------------------------------- aggregates

def q_hourly_tips(spark, d):
    e = _events(spark, d, "ts", "user_id", "value").withColumn("cents", _cents())
    h = windows.time_window(e, "ts", "1 hour", ["user_id"], {"cents": F.sum("cents")})
    return h.select(as_ntz("window_start").alias("window_start"), "user_id",
                    (F.col("cents") / 100.0).alias("tips"))


def q_hourly_top(spark, d):
    e = _events(spark, d, "ts", "user_id", "value").withColumn("cents", _cents())
    h = windows.time_window(e, "ts", "1 hour", ["user_id"], {"cents": F.sum("cents")})
    top = aggregates.max_by_key(h, ["window_start"], "cents", "user_id", "best")
    return top.select(as_ntz("window_start").alias("window_start"), "user_id", (F.col("best") / 100.0).alias("tips"))


def q_hourly_top3(spark, d):
    """Top 3 users by tips in every hour (ties: smaller user id first)."""
    e = _events(spark, d, "ts", "user_id", "value").withColumn("cents", _cents())
    h = windows.time_window(e, "ts", "1 hour", ["user_id"], {"cents": F.sum("cents")})
    t = aggregates.top_n(h, ["window_start"], [F.col("cents").desc(), F.col("user_id")], 3, salt_col="user_id")
    return t.select(as_ntz("window_start").alias("window_start"), "user_id", (F.col("cents") / 100.0).alias("tips"),
                    F.col("rank").cast("long").alias("rank"))


def q_keyed_count(spark, d):
    return aggregates.keyed_count(_events(spark, d, "user_id"), ["user_id"])


def q_running_count(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts")
    return aggregates.running_count(e, ["user_id"], ORDER).select("user_id", "event_id", "n")


def q_running_max(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "value")
    return aggregates.running_max(e, ["user_id"], ORDER, "value").select("user_id", "event_id", "max_value")


def q_running_max_by(spark, d):
    """The event that holds the largest value of its user so far."""
    e = _events(spark, d, "user_id", "event_id", "ts", "value")
    b = aggregates.running_max_by(e, ["user_id"], ORDER, "value")
    return b.select("user_id", "event_id", F.col("best.event_id").alias("best_event"), F.col("best.value").alias("best_value"))


def q_running_sum(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts")
    return keyed.running_sum(e, "user_id", ORDER, "event_id").select("user_id", "event_id", "running_sum")


def q_running_concat(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts")
    return keyed.running_increments(e, "user_id", ORDER, "event_id").select("user_id", "event_id", "pos", "item")


def q_concat_text(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts")
    return useragg.aggregate_by(e, ["user_id"], ORDER, "event_id", useragg.contains_digest())


def q_count_window_avg(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts")
    return keyed.count_average(e, "user_id", ORDER, "event_id", COUNT_WINDOW)


def q_count_window_sum(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "value").withColumn("cents", _cents())
    return windows.count_tumbling(e, ["user_id"], ORDER, COUNT_WINDOW, [F.sum("cents").alias("total_cents")])


def q_count_accumulating(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "value").withColumn("cents", _cents())
    return windows.count_accumulating(e, ["user_id"], ORDER, COUNT_WINDOW, "cents", out="total_cents")


def q_longest_per_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    j = (joins.equi_pairs(o, li, "o_orderkey", "l_orderkey")
         .where(F.col("l_shipdate") >= F.col("o_orderdate"))
         .select("o_custkey", whole_minutes("o_orderdate", "l_shipdate").alias("minutes")))
    return j.groupBy("o_custkey").agg(F.max("minutes").alias("max_minutes"))


# ------------------------------------------------------------------- windows

def _type_counts(spark, d, size, slide=None, offset=None):
    e = _events(spark, d, "ts", "event_type")
    w = windows.time_window(e, "ts", size, ["event_type"], {"n": F.count(F.lit(1))}, slide, offset)
    return w.select(as_ntz("window_start").alias("window_start"), as_ntz("window_end").alias("window_end"),
                    "event_type", "n")


def q_sliding_count(spark, d):
    return _type_counts(spark, d, "10 minutes", "5 minutes")


def q_sliding_panes(spark, d):
    e = _events(spark, d, "ts", "value").withColumn("cents", _cents())
    w = windows.pane_windows(e, "ts", 24 * HOUR_US, MINUTE_US, [], {"n": ("count", F.lit(1)), "cents": ("sum", F.col("cents")), "most": ("max", F.col("cents"))})
    return w.select(as_ntz("window_start").alias("window_start"), "n", "cents", "most")


def q_tumbling_offset(spark, d):
    return _type_counts(spark, d, "1 hour", None, "15 minutes")


def q_sliding_offset(spark, d):
    return _type_counts(spark, d, "1 hour", "30 minutes", "15 minutes")


def q_window_all(spark, d):
    e = _events(spark, d, "ts", "value").withColumn("cents", _cents())
    w = windows.time_window(e, "ts", "1 hour", [], {"n": F.count(F.lit(1)), "cents": F.sum("cents")})
    return w.select(as_ntz("window_start").alias("window_start"), "n", (F.col("cents") / 100.0).alias("tips"))


def q_session_stats(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "value")
    s = windows.sessionize(e, ["user_id"], "ts", "event_id", SESSION_GAP_US)
    g = (s.groupBy("user_id", "session_start")
          .agg(F.count(F.lit(1)).cast("int").alias("length"),
               F.min(F.unix_millis(F.col("ts").cast("timestamp"))).alias("startTime"),
               F.max("value").alias("maxSpeed"),
               F.stddev_pop("value").alias("_stddev"),
               F.max("_end_us").alias("_end")))
    return g.select("user_id", as_ntz("session_start").alias("session_start"),
                    as_ntz(F.timestamp_micros("_end")).alias("session_end"), "length", "startTime",
                    "maxSpeed", F.round("_stddev", 4).alias("erraticness"), style_label("_stddev").alias("label"))


def q_gap_segments(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "value")
    s = segments.gap_segments(e, "user_id", "ts", "event_id", SESSION_GAP_US, speed="value", throttle="value")
    return s.select("user_id", as_ntz("session_start").alias("session_start"), "length", "startTime",
                    F.col("maxSpeed").cast("double").alias("maxSpeed"),
                    F.round(F.col("erraticness").cast("double"), 3).alias("erraticness"), "label")


def q_session_dynamic(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "event_type")
    s = windows.sessions(e, ["user_id"], "ts", "event_id", _dyn_gap_us(), [F.count(F.lit(1)).alias("n")])
    return s.select("user_id", as_ntz("session_start").alias("session_start"),
                    as_ntz("session_end").alias("session_end"), "n")


def _stop_segments(spark, d):
    e = _events(spark, d, "user_id", "event_id", "ts", "value", "event_type")
    return segments.stop_segments(e, "user_id", "ts", "event_id", F.col("event_type") == "error",
                                  speed="value", throttle="value")


def q_stop_segments(spark, d):
    s = _stop_segments(spark, d)
    return s.select("user_id", "segment", "length", "startTime", F.col("maxSpeed").cast("double").alias("maxSpeed"),
                    F.round(F.col("erraticness").cast("double"), 3).alias("erraticness"), "label")


def q_segment_text(spark, d):
    return segments.segment_text(_stop_segments(spark, d), "user_id")


def q_collect_window(spark, d):
    e = _events(spark, d, "ts", "event_id", "event_type")
    item = F.concat(F.col("event_id").cast("string"), F.lit("|"), F.date_format("ts", "HH:mm:ss"))
    w = windows.window_contents(e, "ts", "1 hour", ["event_type"], item, ["ts", "event_id"])
    return w.select(as_ntz("window_start").alias("window_start"), "event_type", "pos", "item")


# ------------------------------------------------------ event time / lateness

def _arrivals(spark, d, *extra):
    return _events(spark, d, "event_id", "user_id", "ts", *extra).withColumn("arr", arrival())


def q_late_events(spark, d):
    _, late = ev.late_split(_arrivals(spark, d), "ts", "arr", "event_id", LATE_DELAY_US)
    return late.select("event_id", "user_id", "ts", "arr")


def q_event_sort(spark, d):
    on_time, _ = ev.late_split(_arrivals(spark, d), "ts", "arr", "event_id", LATE_DELAY_US)
    s = ev.sort_by_event_time(on_time.select("event_id", "user_id", "ts"), ["user_id"], "ts", "event_id")
    return s.select("user_id", "event_id", "ts", "pos")


def q_late_marker(spark, d):
    a = _arrivals(spark, d, "event_type")
    _, late = ev.late_split(a, "ts", "arr", "event_id", LATE_DELAY_US,
                            advance_when=F.col("event_type") == MARKER_TYPE)
    return late.select("event_id", "user_id", "ts", "arr")


def q_late_window(spark, d):
    on_time, _ = ev.window_late_split(_arrivals(spark, d, "event_type"), "ts", "arr", "event_id",
                                      "1 hour", WINDOW_LATE_DELAY_US)
    return (on_time.groupBy("window_start", "event_type").agg(F.count(F.lit(1)).alias("n"))
                   .select(as_ntz("window_start").alias("window_start"), "event_type", "n"))


def q_late_window_allowed(spark, d):
    on_time, _ = ev.window_late_split(_arrivals(spark, d, "event_type"), "ts", "arr", "event_id",
                                      "1 hour", WINDOW_LATE_DELAY_US, ALLOWED_LATENESS_US)
    return (on_time.groupBy("window_start", "event_type").agg(F.count(F.lit(1)).alias("n"))
                   .select(as_ntz("window_start").alias("window_start"), "event_type", "n"))


def q_late_window_firings(spark, d):
    f = ev.window_firings(_arrivals(spark, d, "event_type"), "ts", "arr", "event_id", "1 hour", WINDOW_LATE_DELAY_US,
                          ALLOWED_LATENESS_US, ["event_type"])
    return f.select(as_ntz("window_start").alias("window_start"), "event_type", "firing", "n")


def q_late_periodic(spark, d):
    a = _arrivals(spark, d).withColumn("period", F.floor(micros("arr") / F.lit(WATERMARK_PERIOD_US)))
    _, late = ev.late_split(a, "ts", "arr", "event_id", LATE_DELAY_US, emit_every="period")
    return late.select("event_id", "user_id", "ts", "arr")


def q_late_window_side(spark, d):
    _, late = ev.window_late_split(_arrivals(spark, d, "event_type"), "ts", "arr", "event_id",
                                   "1 hour", WINDOW_LATE_DELAY_US)
    return late.select("event_id", "event_type", as_ntz("window_start").alias("window_start"))


def q_late_wallclock(spark, d):
    a = _arrivals(spark, d, "event_type")
    w = F.window("ts", "10 minutes", "5 minutes")
    kept = (a.select("event_type", "arr", w.alias("w"))
              .where(~ev.late_wallclock(F.col("w.end"), "arr", WALLCLOCK_DELAY_US)))
    return (kept.groupBy("w", "event_type").agg(F.count(F.lit(1)).alias("n"))
                .select(as_ntz("w.start").alias("window_start"), as_ntz("w.end").alias("window_end"),
                        "event_type", "n"))


def q_idle_count(spark, d):
    a = _arrivals(spark, d)
    s = keyed.idle_count(a, "user_id", "arr", "event_id", IDLE_GAP_US)
    return s.select("user_id", as_ntz("session_start").alias("first_arrival"),
                    as_ntz("emit_at").alias("emit_at"), "n")


# --------------------------------------------------------------------- joins

def _orders_items(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    return o, li


def q_pair_join(spark, d):
    o, li = _orders_items(spark, d)
    return joins.equi_pairs(o, li, "o_orderkey", "l_orderkey").select(
        "o_orderkey", "l_linenumber", "o_totalprice", "l_extendedprice")


def q_pair_first_come(spark, d):
    o, li = _orders_items(spark, d)
    left = o.select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("t"), F.struct(F.lit(0).cast("long").alias("n"), F.col("o_totalprice").alias("price")).alias("i"), "o_totalprice")
    right = li.select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("t"),
                      F.struct(F.col("l_linenumber").cast("long").alias("n"), F.col("l_extendedprice").alias("price")).alias("i"), "l_extendedprice")
    p = joins.pair_first_come(left, right, "k", "t", "i")
    return p.select(F.col("k").alias("orderkey"), F.col("right_id.n").alias("l_linenumber"),
                    as_ntz("left_time").alias("order_time"), as_ntz("right_time").alias("item_time"),
                    F.col("left.o_totalprice").alias("o_totalprice"), F.col("right.l_extendedprice").alias("l_extendedprice"))


def q_pair_unmatched(spark, d):
    o, li = _orders_items(spark, d)
    return joins.unmatched(o, li, "o_orderkey", "l_orderkey").withColumnRenamed("o_orderkey", "orderkey")


# ---------------------------------------------------------------- text / geo

def q_word_count(spark, d):
    docs = spread(table(spark, d, "documents").select("text"))
    lines = docs.select(F.explode(text_lines("text")).alias("line"))
    words = lines.select(F.explode(tokenize("line")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def q_word_running_count(spark, d):
    """Running count per word, one row per token, in (document, line, position)
    order - the streaming word count's output as a table."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    lines = docs.select("doc_id", F.posexplode(text_lines("text")).alias("line_no", "line"))
    words = lines.select("doc_id", (F.col("line_no") + 1).alias("line_no"),
                         F.posexplode(tokenize("line")).alias("pos", "word"))
    words = words.withColumn("pos", F.col("pos") + 1)
    return (aggregates.running_count(words, ["word"], ["doc_id", "line_no", "pos"])
            .select("doc_id", "line_no", "pos", "word", "n"))


def _coords(spark, d):
    return _events(spark, d, "event_id").select(
        "event_id", coord("event_id", LON_BASE, LON_MOD).alias("lon"),
        coord("event_id", LAT_BASE, LAT_MOD).alias("lat"))


def q_bbox_filter(spark, d):
    return _coords(spark, d).where(in_bbox("lon", "lat"))


def q_grid_cell(spark, d):
    c = _coords(spark, d).where(in_bbox("lon", "lat"))
    return c.select("event_id", grid_cell("lon", "lat").alias("cell"))


# ----------------------------------------------------------------- ingestion

def _ride_lines(spark, d):
    """Ride text lines derived from events: purchase/click = END, view/signup =
    START, error = an invalid flag; signup rows have an empty start latitude."""
    e = spread(_events(spark, d, "event_id", "user_id", "ts", "event_type")).withColumn("arr", arrival())
    fmt = "yyyy-MM-dd HH:mm:ss"
    is_end = F.col("event_type").isin("purchase", "click")
    flag = F.when(is_end, "END").when(F.col("event_type") == "error", "STOP").otherwise("START")
    t_a = F.when(is_end, F.date_format("arr", fmt)).otherwise(F.date_format("ts", fmt))
    t_b = F.when(is_end, F.date_format("ts", fmt)).otherwise(F.lit("1970-01-01 00:00:00"))
    s = lambda c: c.cast("string")
    start_lat = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(
        s(coord("event_id", LAT_BASE, LAT_MOD)))
    line = F.concat_ws(",", s(F.col("event_id")), flag, t_a, t_b,
                       s(coord("event_id", LON_BASE, LON_MOD)), start_lat,
                       s(coord("event_id", LON_BASE, END_LON_MOD)), s(coord("event_id", LAT_BASE, END_LAT_MOD)),
                       s(F.col("event_id") % 6 + 1), s(F.col("user_id")), s(F.col("user_id")))
    return e.select(line.alias("line"))


def q_parse_rides(spark, d):
    good, _ = parse_rides(_ride_lines(spark, d))
    return good.withColumns({"startTime": as_ntz("startTime"), "endTime": as_ntz("endTime")})


def q_parse_rides_bad(spark, d):
    _, bad = parse_rides(_ride_lines(spark, d))
    return bad.select(F.split("line", ",").getItem(0).cast("long").alias("rideId"), "reason")


def q_ride_count(spark, d):
    """Rides per driver after parsing and the NYC filter (final running count)."""
    good, _ = parse_rides(_ride_lines(spark, d))
    return rides.ride_counts(rides.filter_nyc(good))


def q_enrich_rides(spark, d):
    """Cleansed rides with both grid cells."""
    enriched, _ = rides.cleanse(_ride_lines(spark, d))
    return enriched.select("rideId", "startCell", "endCell")


def q_ride_text(spark, d):
    """Cleansed rides printed with both cells."""
    enriched, _ = rides.cleanse(_ride_lines(spark, d))
    return enriched.select("rideId", sinks.enriched_ride_text().alias("line"))


def q_fare_text(spark, d):
    good, _ = parse_fares(_fare_lines(spark, d))
    # Whole units: engines do not print every other float alike.
    good = good.withColumn("totalFare", F.floor("totalFare").cast("float"))
    return good.select("rideId", sinks.fare_text().alias("line"))


def q_car_text(spark, d):
    good, _ = parse_car_events(_car_lines(spark, d))
    return good.select("id", sinks.car_event_text().alias("line"))


def q_cell_longest(spark, d):
    """Flagship (a): lines -> parse -> NYC filter -> grid -> END durations -> longest per cell."""
    enriched, _ = rides.cleanse(_ride_lines(spark, d))
    return rides.longest_per_cell(rides.durations(enriched))


def _fare_lines(spark, d):
    o = spread(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                                "o_totalprice"))
    tip = F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(
        (F.col("o_orderkey") % 20).cast("string"))
    total = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_totalprice").cast("string"))
    pay = F.when(F.col("o_orderkey") % 2 == 0, "CRD").otherwise("CSH")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
                       pay, tip, F.lit("0"), total)
    return o.select(line.alias("line"))


def q_fare_hourly_top(spark, d):
    """The hourly-tips job end to end: fare lines -> typed fares -> tip sum per
    driver per hour -> top driver of every hour (ties: smallest driver id)."""
    fares, _ = parse_fares(_fare_lines(spark, d))
    # Whole cents: ties do not depend on the order of adding.
    cents = {"cents": F.sum(F.round(F.col("tip").cast("double") * 100).cast("long"))}
    per = windows.time_window(fares, "startTime", "1 hour", ["driverId"], cents)
    top = aggregates.max_by_key(per, ["window_start"], "cents", "driverId", "best")
    return top.select(as_ntz("window_start").alias("window_start"), "driverId", (F.col("best") / 100.0).alias("tips"))


def q_parse_fares(spark, d):
    good, _ = parse_fares(_fare_lines(spark, d))
    return good.withColumn("startTime", as_ntz("startTime"))


def _car_lines(spark, d):
    e = spread(_events(spark, d, "event_id", "user_id", "ts", "value", "event_type"))
    v = F.col("value").cast("string")
    speed = F.when(F.col("event_type") == "error", F.lit("0")).otherwise(v)   # errors are stops
    z = F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("+0000"))
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), z)
    toks = [F.concat(F.lit("car"), F.col("user_id").cast("string")), F.col("event_id").cast("string")]
    toks += [F.lit("x")] * 5 + [v, F.lit("x"), speed, F.lit(""), F.lit("x"), v] + [F.lit("x")] * 6
    toks += [F.lit("1.5"), coord("event_id", LON_BASE, LON_MOD).cast("string"),
             coord("event_id", LAT_BASE, LAT_MOD).cast("string"), stamp]
    # Mixed separators: "," and "; " as in the reference's regex (,|;)\s*
    body = F.concat_ws(",", *toks[:12])
    tail = F.concat_ws("; ", *toks[12:])
    return e.select(F.concat(body, F.lit(";"), tail).alias("line"))


def q_parse_cars(spark, d):
    good, _ = parse_car_events(_car_lines(spark, d))
    return good.withColumn("ts", as_ntz("ts"))


def q_parse_key_ts(spark, d):
    e = _events(spark, d, "user_id", "ts")
    lines = e.select(F.concat_ws(",", F.col("user_id").cast("string"),
                                 F.unix_millis(F.col("ts").cast("timestamp")).cast("string")).alias("line"))
    good, _ = parse_key_ts(lines)
    return good.withColumn("ts", as_ntz("ts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cell_longest": q_cell_longest,
    "enrich_rides": q_enrich_rides,
    "ride_text": q_ride_text,
    "fare_text": q_fare_text,
    "car_text": q_car_text,
    "gap_segments": q_gap_segments,
    "running_max_by": q_running_max_by,
    "ride_count": q_ride_count,
    "hourly_tips": q_hourly_tips,
    "hourly_top": q_hourly_top,
    "hourly_top3": q_hourly_top3,
    "keyed_count": q_keyed_count,
    "running_count": q_running_count,
    "running_max": q_running_max,
    "running_sum": q_running_sum,
    "running_concat": q_running_concat,
    "concat_text": q_concat_text,
    "count_window_avg": q_count_window_avg,
    "count_window_sum": q_count_window_sum,
    "count_accumulating": q_count_accumulating,
    "longest_per_key": q_longest_per_key,
    "sliding_count": q_sliding_count,
    "sliding_panes": q_sliding_panes,
    "tumbling_offset": q_tumbling_offset,
    "sliding_offset": q_sliding_offset,
    "window_all": q_window_all,
    "session_stats": q_session_stats,
    "session_dynamic": q_session_dynamic,
    "stop_segments": q_stop_segments,
    "segment_text": q_segment_text,
    "collect_window": q_collect_window,
    "late_events": q_late_events,
    "event_sort": q_event_sort,
    "late_marker": q_late_marker,
    "late_window": q_late_window,
    "late_window_side": q_late_window_side,
    "late_window_allowed": q_late_window_allowed,
    "late_window_firings": q_late_window_firings,
    "late_periodic": q_late_periodic,
    "late_wallclock": q_late_wallclock,
    "idle_count": q_idle_count,
    "pair_join": q_pair_join,
    "pair_first_come": q_pair_first_come,
    "pair_unmatched": q_pair_unmatched,
    "word_count": q_word_count,
    "word_running_count": q_word_running_count,
    "bbox_filter": q_bbox_filter,
    "grid_cell": q_grid_cell,
    "parse_rides": q_parse_rides,
    "parse_rides_bad": q_parse_rides_bad,
    "parse_fares": q_parse_fares,
    "fare_hourly_top": q_fare_hourly_top,
    "parse_cars": q_parse_cars,
    "parse_key_ts": q_parse_key_ts,
}
