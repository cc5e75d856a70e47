"""Column helpers and parsers against the FIXTURES golden vectors."""
import datetime as dt

from pyspark.sql import functions as F

from cabflow.functions.geo import grid_cell, in_bbox
from cabflow.functions.labels import segment_line, style_label
from cabflow.functions.text import java_split, text_lines, tokenize
from cabflow.operators.ingest import parse_car_events, parse_fares, parse_key_ts, parse_rides
from cabflow.sources.lines import from_rows


def test_tokenize_java_rules(spark):
    df = spark.createDataFrame([("A b  ",), (" a  b",), ("",), ("   ",)], "line string")
    got = [r[0] for r in df.select(tokenize("line")).collect()]
    assert got == [["a", "b"], ["", "a", "", "b"], [""], []]


def test_java_split_regex_and_trailing(spark):
    df = spark.createDataFrame([("a, b;c; ",), ("x,,y,,",)], "s string")
    got = [r[0] for r in df.select(java_split("s", "(,|;)\\s*")).collect()]
    assert got == [["a", "b", "c"], ["x", "", "y"]]


def test_text_lines(spark):
    df = spark.createDataFrame([("a\nb\n",), ("a\r\nb",), ("a\n\n",)], "t string")
    assert [r[0] for r in df.select(text_lines("t")).collect()] == [["a", "b"], ["a", "b"], ["a", ""]]


def test_grid_and_bbox(spark):
    pts = [(-73.99, 40.75), (-74.049, 40.99), (-73.7, 41.0), (-74.05, 40.5)]
    df = spark.createDataFrame(pts, "lon float, lat float")
    got = df.select(in_bbox("lon", "lat").alias("i"), grid_cell("lon", "lat").alias("c")).collect()
    assert [(r.i, r.c) for r in got[:2]] == [(True, 50042), (True, 1750)]
    assert [r.i for r in got[2:]] == [False, False]


def test_style_label(spark):
    df = spark.createDataFrame([(2.49,), (2.5,), (4.99,), (5.0,)], "x float")
    assert [r[0] for r in df.select(style_label("x")).collect()] == ["calm", "busy", "busy", "crazy"]


def test_segment_line(spark):
    df = spark.createDataFrame([("car1", 1000, 2, 20.0, "calm")], "c string, t long, n int, m float, l string")
    assert df.select(segment_line("c", "t", "n", "m", "l")).first()[0] == "car1,1000,2 events,20.0 kph,calm"


def test_parse_rides_start_end_and_bad(spark):
    lines = from_rows(spark, [
        "6,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,2013000006,2013000006",
        "6,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,2013000006,2013000006",
        "7,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.866135,,-73.961334,40.764912,6,1,1",
        "8,STOP,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.8,40.7,-73.9,40.7,6,1,1",
        "x9,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.8,40.7,-73.9,40.7,6,1,1",
        "10,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.8,40.7,-73.9,40.7,6,1",
    ])
    good, bad = parse_rides(lines)
    g = {(r.rideId, r.isStart): r for r in good.collect()}
    s, e = g[(6, True)], g[(6, False)]
    assert s.startTime == dt.datetime(2013, 1, 1) and s.endTime == dt.datetime(1970, 1, 1)
    assert e.startTime == dt.datetime(2013, 1, 1) and e.endTime == dt.datetime(2013, 1, 1, 0, 12, 59)
    assert g[(7, False)].startLat == 0.0
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["field_count", "flag", "number"]


def test_parse_rides_fail_mode(spark):
    import pytest
    good, _ = parse_rides(from_rows(spark, ["1,STOP,a,b,c,d,e,f,g,h,i"]), mode="fail")
    with pytest.raises(Exception):
        good.collect()


def test_parse_fares_trailing_empty(spark):
    lines = from_rows(spark, ["6,2013000006,2013000006,2013-01-01 00:00:00,CRD,1.5,0,12.5",
                              "6,1,1,2013-01-01 00:00:00,CSH,,0,12.5",
                              "6,1,1,2013-01-01 00:00:00,CSH,0,0,"])
    good, bad = parse_fares(lines)
    rows = good.collect()
    assert [(r.tip, r.tolls, r.totalFare) for r in rows] == [(1.5, 0.0, 12.5), (0.0, 0.0, 12.5)]
    assert [r.reason for r in bad.collect()] == ["field_count"]


def test_parse_car_events_offsets(spark):
    toks = ["car1", "e1"] + ["x"] * 5 + ["3.5", "x", "42.0", "x", "x", "7.5"] + ["x"] * 6 + ["1.0", "-73.9", "40.7"]
    z = ",".join(toks[:12]) + "; " + "; ".join(toks[12:]) + "; 2017-01-01T00:00:10Z"
    p = ",".join(toks) + ",2017-01-01T01:00:10+0100"
    good, bad = parse_car_events(from_rows(spark, [z, p, "car1,e1,short"]))
    rows = good.orderBy("timestamp").collect()
    assert [r.timestamp for r in rows] == [1483228810000, 1483228810000]
    assert rows[0].speed == 42.0 and rows[0].throttle == 7.5 and rows[0].consumption == 3.5
    assert bad.count() == 1


def test_parse_key_ts(spark):
    good, _ = parse_key_ts(from_rows(spark, ["a,1700000000000"]))
    r = good.first()
    assert r.key == "a" and r.ts_ms == 1700000000000
    assert good.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).first()[0] == "2023-11-14 22:13:20"


def test_java_split_fast_paths_agree(spark):
    from cabflow.operators.ingest import CAR_SPLIT, CAR_SPLIT_TAIL
    rows = [("a, b;c; ",), ("x,,y,,",), ("a ",), ("",), (",;  ",), ("a;b\t",), ("p,q",)]
    df = spark.createDataFrame(rows, "s string")
    slow = [r[0] for r in df.select(java_split("s", CAR_SPLIT)).collect()]
    fast = [r[0] for r in df.select(java_split("s", CAR_SPLIT, CAR_SPLIT_TAIL)).collect()]
    assert slow == fast
    comma = [r[0] for r in df.select(java_split("s", ",")).collect()]
    assert comma[1] == ["x", "", "y"] and comma[3] == [""] and comma[6] == ["p", "q"]
