"""Typed ingestion of text lines: rides, fares, connected-car events, key/time.

Each parser takes a DataFrame with a string ``line`` column and returns
``(good, bad)``; columns named in ``keep`` (e.g. an arrival sequence) are
carried through to both.  ``bad`` keeps the raw line and a ``reason``; with
``mode="fail"`` the good frame raises on the first invalid line instead (the
reference kills the job).  All work is column expressions, so the same code
serves ``read`` and ``readStream`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.text import java_split

# Fixed formats that must equal the reference.
RIDE_FIELDS = 11
FARE_FIELDS = 8
CAR_FIELDS = 23
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CAR_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"
CAR_SPLIT = "(,|;)\\s*"
CAR_SPLIT_TAIL = ",; \t\n\x0b\f\r"   # characters a CAR_SPLIT match can end with

_INT_RE = "^[+-]?[0-9]+$"


def _long(tok: Column) -> Column:
    """Java ``Long.parseLong``: no surrounding blanks, range-checked."""
    return F.when(tok.rlike(_INT_RE), tok.try_cast("bigint"))


def _short(tok: Column) -> Column:
    return F.when(tok.rlike(_INT_RE), tok.try_cast("smallint"))


def _float0(tok: Column) -> Column:
    """Empty token -> 0.0, else ``Float.parseFloat``."""
    return F.when(tok == "", F.lit(0.0).cast("float")).otherwise(tok.try_cast("float"))


def _ts(tok: Column, fmt: str = TIME_FORMAT) -> Column:
    return F.try_to_timestamp(tok, F.lit(fmt))


def _tokens(lines: DataFrame, line_col: str, split, keep=()) -> DataFrame:
    """(line, _t) with the token array computed once per line.

    The one-element ``explode`` is a plan barrier: without it the optimizer
    inlines the split into every token reference (and into the pushed-down
    validity filter), re-splitting each line once per field.
    """
    return lines.select(F.col(line_col).alias("line"), *keep,
                        F.explode(F.array(split(F.col(line_col)))).alias("_t"))


def _finish(parsed: DataFrame, cols: list[str], mode: str, keep=()) -> tuple[DataFrame, DataFrame]:
    cols = [*cols, *keep]
    bad = parsed.where(F.col("reason").isNotNull()).select("line", "reason", *keep)
    if mode == "fail":
        good = parsed.where(F.when(F.col("reason").isNull(), F.lit(True))
                            .otherwise(F.raise_error(F.concat(F.lit("Invalid record: "), F.col("line")))))
    elif mode == "quarantine":
        good = parsed.where(F.col("reason").isNull())
    else:
        raise ValueError("mode must be 'fail' or 'quarantine'")
    return good.select(*cols), bad


def _first_reason(checks: list[tuple[str, Column]]) -> Column:
    e = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        e = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(e)
    return e


def parse_rides(lines: DataFrame, mode: str = "quarantine", line_col: str = "line", keep=()):
    """11-field ride CSV.  START: field 2 = start, 3 = end; END: swapped."""
    df = _tokens(lines, line_col, lambda c: java_split(c, ","), keep)
    t = F.col("_t")
    tok = lambda i: F.try_element_at(t, F.lit(i + 1))
    flag = tok(1)
    is_start = flag == "START"
    a, b = _ts(tok(2)), _ts(tok(3))
    parsed = df.select(
        "line", *keep,
        F.size(t).alias("_n"),
        _long(tok(0)).alias("rideId"),
        is_start.alias("isStart"),
        flag.isin("START", "END").alias("_flag_ok"),
        F.when(is_start, a).otherwise(b).alias("startTime"),
        F.when(is_start, b).otherwise(a).alias("endTime"),
        _float0(tok(4)).alias("startLon"), _float0(tok(5)).alias("startLat"),
        _float0(tok(6)).alias("endLon"), _float0(tok(7)).alias("endLat"),
        _short(tok(8)).alias("passengerCnt"),
        _long(tok(9)).alias("taxiId"), _long(tok(10)).alias("driverId"),
    )
    nums = ["rideId", "startLon", "startLat", "endLon", "endLat", "passengerCnt", "taxiId", "driverId"]
    parsed = parsed.withColumn("reason", _first_reason([
        ("field_count", F.col("_n") == RIDE_FIELDS),
        ("flag", F.col("_flag_ok")),
        ("time", F.col("startTime").isNotNull() & F.col("endTime").isNotNull()),
        ("number", F.least(*[F.col(c).isNotNull() for c in nums])),
    ]))
    cols = ["rideId", "isStart", "startTime", "endTime", "startLon", "startLat", "endLon",
            "endLat", "passengerCnt", "taxiId", "driverId"]
    return _finish(parsed, cols, mode, keep)


def parse_fares(lines: DataFrame, mode: str = "quarantine", line_col: str = "line", keep=()):
    """8-field fare CSV: rideId, taxiId, driverId, startTime, paymentType, tip, tolls, totalFare."""
    df = _tokens(lines, line_col, lambda c: java_split(c, ","), keep)
    tok = lambda i: F.try_element_at(F.col("_t"), F.lit(i + 1))
    parsed = df.select(
        "line", *keep, F.size("_t").alias("_n"),
        _long(tok(0)).alias("rideId"), _long(tok(1)).alias("taxiId"), _long(tok(2)).alias("driverId"),
        _ts(tok(3)).alias("startTime"), tok(4).alias("paymentType"),
        _float0(tok(5)).alias("tip"), _float0(tok(6)).alias("tolls"), _float0(tok(7)).alias("totalFare"),
    )
    nums = ["rideId", "taxiId", "driverId", "tip", "tolls", "totalFare"]
    parsed = parsed.withColumn("reason", _first_reason([
        ("field_count", F.col("_n") == FARE_FIELDS),
        ("time", F.col("startTime").isNotNull()),
        ("number", F.least(*[F.col(c).isNotNull() for c in nums])),
    ]))
    cols = ["rideId", "taxiId", "driverId", "startTime", "paymentType", "tip", "tolls", "totalFare"]
    return _finish(parsed, cols, mode, keep)


def parse_car_events(lines: DataFrame, mode: str = "quarantine", line_col: str = "line", keep=()):
    """23 tokens split by ``(,|;)\\s*``; keeps carId, id, timestamp and six measures."""
    df = _tokens(lines, line_col, lambda c: java_split(c, CAR_SPLIT, CAR_SPLIT_TAIL), keep)
    tok = lambda i: F.try_element_at(F.col("_t"), F.lit(i + 1))
    ts = _ts(tok(22), CAR_TIME_FORMAT)
    parsed = df.select(
        "line", *keep, F.size("_t").alias("_n"),
        tok(1).alias("id"), tok(0).alias("carId"),
        ts.alias("ts"), F.unix_millis(ts).alias("timestamp"),
        _float0(tok(20)).alias("longitude"), _float0(tok(21)).alias("latitude"),
        _float0(tok(7)).alias("consumption"), _float0(tok(9)).alias("speed"),
        _float0(tok(12)).alias("throttle"), _float0(tok(19)).alias("engineload"),
    )
    nums = ["longitude", "latitude", "consumption", "speed", "throttle", "engineload"]
    parsed = parsed.withColumn("reason", _first_reason([
        ("field_count", F.col("_n") == CAR_FIELDS),
        ("time", F.col("ts").isNotNull()),
        ("number", F.least(*[F.col(c).isNotNull() for c in nums])),
    ]))
    cols = ["id", "carId", "ts", "timestamp", "longitude", "latitude", "consumption", "speed",
            "throttle", "engineload"]
    return _finish(parsed, cols, mode, keep)


def parse_key_ts(lines: DataFrame, mode: str = "quarantine", line_col: str = "line", keep=()):
    """``key,epochMillis`` -> (key string, ts timestamp, ts_ms long)."""
    df = _tokens(lines, line_col, lambda c: F.split(c, ",", -1), keep)
    ms = _long(F.try_element_at(F.col("_t"), F.lit(2)))
    parsed = df.select("line", *keep, F.size("_t").alias("_n"),
                       F.try_element_at(F.col("_t"), F.lit(1)).alias("key"), ms.alias("ts_ms"))
    parsed = (parsed.withColumn("ts", F.timestamp_millis(F.col("ts_ms")))
                    .withColumn("reason", _first_reason([("field_count", F.col("_n") >= 2),
                                                         ("number", F.col("ts_ms").isNotNull())])))
    return _finish(parsed, ["key", "ts", "ts_ms"], mode, keep)
