"""The reference jobs over line files derived from the driver tables."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabflow.plans import driver as D
from cabflow.plans import jobs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _write(df, compression="gzip"):
    d = tempfile.mkdtemp(prefix="cabflow-lines-")
    df.coalesce(2).write.mode("overwrite").option("compression", compression).text(d + "/x")
    return d + "/x"


def test_ride_jobs(spark):
    path = _write(D._ride_lines(spark, SF))
    got = {(r.startCell, r.max_minutes, r.driverId) for r in jobs.cell_driver_duration(spark, path).collect()}
    want = {(r.startCell, r.max_minutes, r.driverId) for r in D.q_cell_longest(spark, SF).collect()}
    assert got == want and got
    counts = jobs.ride_count(spark, path)
    final = counts.groupBy("driverId").agg(F.max("rides").alias("rides"))
    assert {tuple(r) for r in final.collect()} == {tuple(r) for r in D.q_ride_count(spark, SF).collect()}
    parsed = D.q_parse_rides(spark, SF)
    inside = parsed.where(F.col("startLat") > 0)      # empty start latitudes parse to 0.0 -> outside
    assert jobs.ride_cleansing(spark, path).count() <= inside.count()


def test_fare_jobs(spark):
    path = _write(D._fare_lines(spark, SF), compression="none")
    per, top = jobs.hourly_tips(spark, path)
    assert per.count() > 0
    assert top.groupBy("window_start").count().where("count > 1").count() == 0
    rides = _write(D._ride_lines(spark, SF))
    pairs = jobs.rides_with_fares(spark, rides, path)
    assert pairs.where("rideId is null").count() == 0


def test_car_jobs(spark):
    path = _write(D._car_lines(spark, SF))
    segs = jobs.driving_segments(spark, path).collect()
    want = D.q_segment_text(spark, SF).collect()
    assert len(segs) == len(want) > 0
    # lines carry whole seconds, the table microseconds: compare all but the start time
    strip = lambda line: line.split(",", 2)[2]
    assert sorted(strip(r.line) for r in segs) == sorted(strip(r.line) for r in want)
    sessions = jobs.driving_sessions(spark, path)
    assert sessions.agg(F.sum("length")).first()[0] == 1000
    sorted_df, late = jobs.car_event_sort(spark, path)
    assert sorted_df.count() + late.count() == 1000


def test_text_jobs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("l"))
    path = _write(docs, compression="none")
    wc = jobs.word_count(spark, path)
    assert wc.agg(F.sum("n")).first()[0] > 0
    cw = jobs.count_window_word_count(spark, path)
    assert cw.where("n != 3").count() == 0
    kv = spark.read.parquet(f"{SF}/events.parquet").select(
        F.concat_ws(",", F.col("user_id").cast("string"),
                    F.unix_millis(F.col("ts").cast("timestamp")).cast("string")).alias("l"))
    vc = jobs.value_count(spark, _write(kv, compression="none"))
    assert vc.agg(F.sum("n")).first()[0] == 2000   # every event in two sliding windows


def test_line_order_over_files_of_different_size(spark):
    """A small a.txt comes before a large b.txt, however Spark packs splits."""
    from cabflow.sources.lines import read_lines
    d = tempfile.mkdtemp(prefix="cabflow-files-")
    with open(d + "/a.txt", "w") as f:
        f.write("w1\n")
    with open(d + "/b.txt", "w") as f:
        f.write("".join(f"w{i}\n" for i in range(2, 2000)))
    lines = read_lines(spark, d).orderBy("seq").collect()
    assert [r.line for r in lines] == [f"w{i}" for i in range(1, 2000)]
    with open(d + "/c.txt", "w") as f:
        f.write("w1 w1 w1\n")
    assert [tuple(r) for r in jobs.count_window_word_count(spark, d).where("word = 'w1'").select("bucket", "n").collect()] == [(0, 3)]
