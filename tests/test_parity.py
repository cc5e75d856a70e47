"""Batch/stream parity on the driver tables: the same operator over a
readStream replay (several files + a far-future sentinel to flush the
watermark) equals the batch result."""
import datetime as dt
import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabflow.operators import windows
from cabflow.operators.ingest import parse_rides
from cabflow.sources.lines import read_lines
from cabflow.streaming import jobs, sinks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_hourly_counts_stream_equals_batch(spark):
    ev = (spark.read.parquet(f"{SF}/events.parquet")
          .select(F.col("ts").cast("timestamp").alias("ts"), "event_type"))
    src = tempfile.mkdtemp(prefix="cabflow-par-")
    ev.orderBy("ts").repartition(3).write.mode("overwrite").parquet(src + "/a")
    sentinel = spark.createDataFrame([(dt.datetime(2100, 1, 1), "sentinel")], "ts timestamp, event_type string")
    sentinel.write.mode("overwrite").parquet(src + "/b")
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(src + "/*")
    q = sinks.to_memory(jobs.windowed_counts(stream, "ts", "event_type", "1 hour", delay="0 seconds"),
                        "par_hourly", tempfile.mkdtemp(prefix="cabflow-ck-"))
    q.processAllAvailable()
    q.stop()
    got = {(r.window_start, r.event_type, r.n) for r in spark.table("par_hourly").collect()}
    batch = windows.time_window(ev, "ts", "1 hour", ["event_type"], {"n": F.count(F.lit(1))})
    want = {(r.window_start, r.event_type, r.n) for r in batch.collect()}
    assert got == want


def test_gzip_lines_batch_and_stream(spark):
    d = tempfile.mkdtemp(prefix="cabflow-gz-")
    lines = [
        "6,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,1,1",
        "6,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,1,1",
        "bad line",
    ]
    with gzip.open(os.path.join(d, "rides.gz"), "wt") as fh:
        fh.write("\n".join(lines) + "\n")
    good, bad = parse_rides(read_lines(spark, d, repartition=4))
    assert good.count() == 2 and bad.count() == 1
    stream = read_lines(spark, d, streaming=True, max_files_per_trigger=1)
    q = sinks.to_memory(jobs.cleanse(stream), "gz_rides", tempfile.mkdtemp(prefix="cabflow-ck-"))
    q.processAllAvailable()
    q.stop()
    rows = spark.table("gz_rides").collect()
    assert sorted(r.isStart for r in rows) == [False, True]
    from cabflow.operators import rides
    assert {r.startCell for r in rows} == {r.startCell for r in rides.enrich(rides.filter_nyc(good)).collect()}


def test_stop_segments_stream_equals_batch(spark):
    from cabflow.operators import segments
    ev = (spark.read.parquet(f"{SF}/events.parquet")
          .select(F.col("user_id").cast("string").alias("carId"), F.col("event_id").alias("id"),
                  F.col("ts").cast("timestamp").alias("ts"),
                  F.when(F.col("event_type") == "error", F.lit(0.0)).otherwise(F.col("value")).cast("float")
                  .alias("speed"),
                  F.col("value").cast("float").alias("throttle")))
    batch = segments.stop_segments(ev, "carId", "ts", "id", F.col("speed") == 0)
    want = {(r.carId, r.startTime, r.length, round(r.erraticness, 3)) for r in batch.collect()}
    src = tempfile.mkdtemp(prefix="cabflow-stop-")
    rows = ev.withColumn("timestamp", F.unix_millis("ts")).withColumn("seq", F.col("id"))
    rows.drop("ts").repartition(3).write.mode("overwrite").parquet(src + "/a")
    sentinel = (ev.select("carId").distinct()
                .select("carId", F.lit(10 ** 9).cast("long").alias("id"), F.lit(1.0).cast("float").alias("speed"),
                        F.lit(1.0).cast("float").alias("throttle"), F.lit(4_102_444_800_000).alias("timestamp"),
                        F.lit(10 ** 9).cast("long").alias("seq")))
    sentinel.write.mode("overwrite").parquet(src + "/b")
    schema = "carId string, id long, speed float, throttle float, timestamp long, seq long"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src + "/*")
    q = sinks.to_memory(jobs.stop_segments(stream, delay_ms=10 * 365 * 86_400_000), "par_stop", tempfile.mkdtemp(prefix="cabflow-ck-"))
    q.processAllAvailable()
    q.stop()
    got = {(r.key, r.startTime, r.length, round(r.erraticness, 3)) for r in spark.table("par_stop").collect()}
    assert got == want and len(want) > 50


def test_event_sorter_stream_equals_batch_per_key(spark):
    from pyspark.sql import Window
    from cabflow.operators import events as ev
    from cabflow.sources.tables import arrival
    base = (spark.read.parquet(f"{SF}/events.parquet")
            .select(F.col("user_id").cast("string").alias("carId"), F.col("event_id").alias("id"),
                    F.col("ts").cast("timestamp").alias("ts"))
            .withColumn("arr", arrival(event_id="id").cast("timestamp")))
    # batch: per-key watermark in arrival order, delay 1 hour
    on_time, late = ev.late_split(base, "ts", "arr", "id", 3_600_000_000, keys=["carId"])
    want_late = {r.id for r in late.collect()}
    assert want_late
    # stream: one file in arrival order (seq = arrival rank of this small fixture)
    rows = (base.withColumn("timestamp", F.unix_millis("ts"))
                .withColumn("seq", F.row_number().over(Window.orderBy("arr", "id")).cast("long"))
                .select("carId", "id", "timestamp", "seq"))
    src = tempfile.mkdtemp(prefix="cabflow-sort-")
    rows.coalesce(1).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema("carId string, id long, timestamp long, seq long").parquet(src)
    q = sinks.to_memory(jobs.sort_events(stream, delay_ms=3_600_000), "par_sort",
                        tempfile.mkdtemp(prefix="cabflow-ck-"))
    q.processAllAvailable()
    q.stop()
    out = spark.table("par_sort")
    assert {int(r.id) for r in out.where("kind = 'late'").collect()} == want_late
    # every on-time row is either released in order or still buffered
    released = {int(r.id) for r in out.where("kind = 'sorted'").collect()}
    assert released <= {r.id for r in on_time.collect()}


def test_rides_with_fares_end_to_end(spark):
    from cabflow.plans import driver as D
    from cabflow.sources.lines import read_lines
    rides_dir, fares_dir = tempfile.mkdtemp(prefix="cabflow-r-"), tempfile.mkdtemp(prefix="cabflow-f-")
    D._ride_lines(spark, SF).coalesce(2).write.mode("overwrite").text(rides_dir + "/x")
    D._fare_lines(spark, SF).coalesce(2).write.mode("overwrite").text(fares_dir + "/x")
    out = tempfile.mkdtemp(prefix="cabflow-pairs-")
    q = jobs.rides_with_fares_to_files(read_lines(spark, rides_dir + "/x", streaming=True),
                                       read_lines(spark, fares_dir + "/x", streaming=True),
                                       out, tempfile.mkdtemp(prefix="cabflow-ck-"), threshold=20,
                                       trigger={"availableNow": True})
    q.awaitTermination(300)
    pairs = spark.read.parquet(out)
    n = pairs.count()
    assert n > 0 and pairs.select("key").distinct().count() == n      # at most one pair per ride id
    ride_ids = {r.rideId for r in D.q_parse_rides(spark, SF).select("rideId").collect()}
    fare_ids = {r.rideId for r in D.q_parse_fares(spark, SF).select("rideId").collect()}
    assert {r.key for r in pairs.select("key").collect()} == ride_ids & fare_ids


def test_driving_segments_stream_subset_of_batch(spark):
    from cabflow.plans import driver as D
    from cabflow.plans import jobs as batch_jobs
    from cabflow.sources.lines import read_lines
    d = tempfile.mkdtemp(prefix="cabflow-cars-")
    D._car_lines(spark, SF).coalesce(1).write.mode("overwrite").text(d + "/x")
    q = sinks.to_memory(jobs.driving_segments_text(read_lines(spark, d + "/x", streaming=True)), "seg_text",
                        tempfile.mkdtemp(prefix="cabflow-ck-"))
    q.processAllAvailable()
    q.stop()
    got = {r.line for r in spark.table("seg_text").collect()}
    want = {r.line for r in batch_jobs.driving_segments(spark, d + "/x").collect()}
    assert got and got <= want


def test_rides_with_fares_restart_from_checkpoint(spark):
    from cabflow.plans import driver as D
    from cabflow.sources.lines import read_lines
    rides = D._ride_lines(spark, SF).withColumn("h", F.abs(F.hash("line")) % 2)
    fares = D._fare_lines(spark, SF).withColumn("h", F.abs(F.hash("line")) % 2)
    r_dir, f_dir = tempfile.mkdtemp(prefix="cabflow-r-"), tempfile.mkdtemp(prefix="cabflow-f-")
    out, ck = tempfile.mkdtemp(prefix="cabflow-out-"), tempfile.mkdtemp(prefix="cabflow-ck-")

    def run():
        q = jobs.rides_with_fares_to_files(read_lines(spark, r_dir, streaming=True),
                                           read_lines(spark, f_dir, streaming=True),
                                           out, ck, trigger={"availableNow": True})
        q.awaitTermination(300)

    # first half of both inputs, stop, then the rest: state and offsets resume
    rides.where("h = 0").select("line").coalesce(1).write.mode("append").text(r_dir)
    fares.where("h = 0").select("line").coalesce(1).write.mode("append").text(f_dir)
    run()
    rides.where("h = 1").select("line").coalesce(1).write.mode("append").text(r_dir)
    fares.where("h = 1").select("line").coalesce(1).write.mode("append").text(f_dir)
    run()
    got = spark.read.parquet(out)
    keys = [r.key for r in got.select("key").collect()]
    assert len(keys) == len(set(keys))                         # no pair twice
    ride_ids = {r.rideId for r in D.q_parse_rides(spark, SF).select("rideId").collect()}
    fare_ids = {r.rideId for r in D.q_parse_fares(spark, SF).select("rideId").collect()}
    assert set(keys) == ride_ids & fare_ids                    # waiting halves were kept in state
