"""Streaming twins: stateful processors fed from files through readStream."""
import datetime as dt
import os
import tempfile

import pandas as pd

from cabflow.streaming import jobs, sinks


def _stream(spark, pdf: pd.DataFrame, schema: str, chunks: int = 1):
    d = tempfile.mkdtemp(prefix="cabflow-src-")
    n = len(pdf)
    for c in range(chunks):
        part = pdf.iloc[c * n // chunks:(c + 1) * n // chunks]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(d)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)


def _run(spark, df, name, mode="append"):
    ck = tempfile.mkdtemp(prefix="cabflow-ck-")
    q = sinks.to_memory(df, name, ck, mode=mode)
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_keyed_state_golden(spark):
    kv = pd.DataFrame({"key": [1, 1, 1, 2, 2, 2], "value": [3, 5, 7, 4, 2, 5], "seq": range(6)})
    schema = "key long, value long, seq long"
    for layout in ("value", "list", "map"):
        out = _run(spark, jobs.keyed_state(_stream(spark, kv, schema, chunks=3), "average", layout=layout),
                   f"avg_{layout}")
        assert sorted((r.key, r.average) for r in out.collect()) == [(1, 5.0), (2, 3.6666666666666665)]
    out = _run(spark, jobs.keyed_state(_stream(spark, kv, schema, chunks=2), "sum"), "rsum")
    assert sorted((r.key, r.running_sum) for r in out.collect()) == [(1, 3), (1, 8), (1, 15), (2, 4), (2, 6), (2, 11)]
    out = _run(spark, jobs.keyed_state(_stream(spark, kv, schema, chunks=2), "concat"), "rcat")
    assert "contains:4 and 2 and 5" in {r.contains for r in out.collect()}


def test_event_sorter_lossless(spark):
    arrivals = [(1, 10), (2, 5), (3, 100), (4, 20), (5, 90), (6, 180), (7, 30), (8, 165), (9, 140), (10, 3600)]
    pdf = pd.DataFrame({"carId": "c", "id": [a for a, _ in arrivals],
                        "timestamp": [s * 1000 for _, s in arrivals], "seq": range(len(arrivals))})
    out = _run(spark, jobs.sort_events(_stream(spark, pdf, "carId string, id long, timestamp long, seq long", 5),
                                       delay_ms=30_000), "sorted")
    rows = out.collect()
    assert sorted(int(r.id) for r in rows if r.kind == "late") == [4, 7, 9]
    assert all(r.event.id == int(r.id) and r.event.timestamp == r.ts_ms for r in rows)
    sorted_ids = [int(r.id) for r in sorted((r for r in rows if r.kind == "sorted"), key=lambda r: r.ts_ms)]
    assert sorted_ids == [2, 1, 5, 3, 8, 6]          # id 10 still waits for the watermark


def test_stop_segmenter(spark):
    spec = [(0, 10, 10), (5, 20, 20), (10, 0, 0), (15, 30, 10), (20, 40, 14), (25, 0, 0), (30, 50, 5), (100, 1, 1)]
    pdf = pd.DataFrame({"carId": "c", "id": range(len(spec)), "timestamp": [s * 1000 for s, _, _ in spec],
                        "speed": [float(v) for _, v, _ in spec], "throttle": [float(t) for _, _, t in spec],
                        "seq": range(len(spec))})
    schema = "carId string, id long, timestamp long, speed float, throttle float, seq long"
    out = _run(spark, jobs.stop_segments(_stream(spark, pdf, schema, 3), delay_ms=30_000), "segs")
    got = sorted((r.startTime, r.length, r.maxSpeed, round(r.erraticness, 4), r.label) for r in out.collect())
    assert got == [(0, 2, 20.0, 5.0, "crazy"), (15000, 2, 40.0, 2.0, "calm")]


def test_first_come_pairing(spark):
    t = dt.datetime(2024, 1, 1)
    rides = pd.DataFrame({"rideId": [1, 2, 2, 3, 3], "startTime": [t] * 5, "seq": [0, 2, 3, 5, 6]})
    fares = pd.DataFrame({"rideId": [1, 2, 3], "startTime": [t] * 3, "seq": [1, 4, 7]})
    r = _stream(spark, rides, "rideId long, startTime timestamp, seq long")
    f = _stream(spark, fares, "rideId long, startTime timestamp, seq long")
    from pyspark.sql import functions as F
    r2 = r.select(F.col("rideId").alias("key"), F.lit(0).alias("side"), F.col("rideId").alias("id"),
                  F.unix_millis("startTime").alias("ts_ms"), "seq")
    f2 = f.select(F.col("rideId").alias("key"), F.lit(1).alias("side"), F.col("rideId").alias("id"),
                  F.unix_millis("startTime").alias("ts_ms"), "seq")
    from cabflow.streaming.processors import PAIR_SCHEMA, FirstComePairing
    df = r2.unionByName(f2).groupBy("key").transformWithStateInPandas(FirstComePairing(), PAIR_SCHEMA, "append", "None")
    out = _run(spark, df, "pairs")
    assert sorted(r.key for r in out.collect()) == [1, 2, 3]


def test_word_count_stream_and_batched_sink(spark):
    from pyspark.sql import functions as F
    d = tempfile.mkdtemp(prefix="cabflow-txt-")
    with open(os.path.join(d, "a.txt"), "w") as fh:
        fh.write("A b  \n a  b\n")
    lines = spark.readStream.format("text").load(d).withColumnRenamed("value", "line")
    out = _run(spark, jobs.word_counts(lines), "wc", mode="complete")
    assert {r.word: r.n for r in out.collect()} == {"a": 2, "b": 2, "": 2}
    target = tempfile.mkdtemp(prefix="cabflow-sink-")
    src = _stream(spark, pd.DataFrame({"x": range(45)}), "x long", chunks=2)
    q = sinks.batched(src, target, tempfile.mkdtemp(prefix="cabflow-ck-"), threshold=20)
    q.processAllAvailable()
    q.stop()
    back = spark.read.parquet(target)
    assert back.count() == 45 and back.agg(F.sum("x")).first()[0] == sum(range(45))


def test_hourly_tips_chained_windows(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, 5.0), (1, t + dt.timedelta(minutes=10), 2.0), (2, t + dt.timedelta(minutes=20), 6.0),
            (3, t + dt.timedelta(hours=1, minutes=5), 1.0), (9, dt.datetime(2030, 1, 1), 0.0)]
    pdf = pd.DataFrame(rows, columns=["driverId", "startTime", "tip"])
    src = _stream(spark, pdf, "driverId long, startTime timestamp, tip double", chunks=2)
    per, top = jobs.hourly_tips(src, delay="0 seconds")
    out = _run(spark, top, "top_hourly")
    got = sorted((r.window_start, r.driverId, r.tips) for r in out.collect())
    assert got[:2] == [(t, 1, 7.0), (t + dt.timedelta(hours=1), 3, 1.0)]


def test_gap_sessions_stream(spark):
    t = dt.datetime(2024, 1, 1)
    secs = [0, 15, 40, 54, 10_000]
    pdf = pd.DataFrame({"carId": "c", "ts": [t + dt.timedelta(seconds=s) for s in secs],
                        "speed": 1.0, "throttle": 1.0})
    src = _stream(spark, pdf, "carId string, ts timestamp, speed double, throttle double", chunks=2)
    out = _run(spark, jobs.gap_sessions(src, "ts", "carId", "15 seconds", delay="0 seconds"), "gaps")
    assert sorted(r.length for r in out.collect()) == [2, 2]


def test_rides_join_fares_stream(spark):
    t = dt.datetime(2024, 1, 1)
    rides = pd.DataFrame({"rideId": [1, 1, 2], "isStart": [True, False, True],
                          "startTime": [t, t, t + dt.timedelta(minutes=5)]})
    fares = pd.DataFrame({"rideId": [1, 2, 3], "startTime": [t, t + dt.timedelta(minutes=5), t],
                          "tip": [1.0, 2.0, 3.0]})
    r = _stream(spark, rides, "rideId long, isStart boolean, startTime timestamp")
    f = _stream(spark, fares, "rideId long, startTime timestamp, tip double")
    out = _run(spark, jobs.rides_join_fares(r, f), "ride_fare")
    assert sorted((x.ride.rideId, x.fare.tip) for x in out.collect()) == [(1, 1.0), (2, 2.0)]


def test_idle_counter_processing_time(spark):
    import time
    d = tempfile.mkdtemp(prefix="cabflow-idle-")
    spark.createDataFrame([("w",), ("w",), ("w",), ("v",)], "word string").write.mode("append").parquet(d)
    src = spark.readStream.schema("word string").parquet(d)
    q = sinks.to_memory(jobs.idle_counts(src, gap_ms=1000), "idle", tempfile.mkdtemp(prefix="cabflow-ck-"),
                        mode="update", trigger={"processingTime": "500 milliseconds"})
    deadline = time.time() + 60
    got = {}
    while time.time() < deadline and len(got) < 2:
        time.sleep(1)
        got = {r.key: r.n for r in spark.table("idle").collect()}
    for _ in range(50):                      # stop between micro-batches
        if not q.status["isTriggerActive"]:
            break
        time.sleep(0.1)
    q.stop()
    assert got == {"w": 3, "v": 1}


def test_first_come_pairing_random_matches_state_machine(spark):
    import random
    from cabflow.streaming.processors import PAIR_SCHEMA, FirstComePairing
    random.seed(9)
    ev = [(random.randint(1, 6), random.randint(0, 1), n) for n in range(300)]
    pdf = pd.DataFrame(ev, columns=["key", "side", "id"]).assign(ts_ms=lambda d: d["id"] * 1000, seq=lambda d: d["id"])
    src = _stream(spark, pdf, "key long, side int, id long, ts_ms long, seq long", chunks=4)
    out = _run(spark, src.groupBy("key").transformWithStateInPandas(FirstComePairing(), PAIR_SCHEMA, "append", "None"),
               "pairs_random")
    waiting, want = {}, []
    for k, s, i in ev:
        w = waiting.get(k)
        if w is not None and w[0] != s:
            want.append((k, w[1], i) if w[0] == 0 else (k, i, w[1]))
            del waiting[k]
        else:
            waiting[k] = (s, i)
    assert sorted((r.key, r.left_id, r.right_id) for r in out.collect()) == sorted(want)


def test_keyed_reduce_generic(spark):
    from cabflow.streaming.processors import KeyedReduce
    kv = pd.DataFrame({"key": [1, 1, 1, 2, 2, 2], "value": [3, 5, 7, 4, 2, 5], "seq": range(6)})
    src = _stream(spark, kv, "key long, value long, seq long", chunks=3)
    proc = KeyedReduce(init=lambda: (0, 0), add=lambda acc, v: (acc[0] + 1, max(acc[1], v)),
                       emit=lambda k, acc, v: (k, acc[0], acc[1]), acc_schema="n long, mx long",
                       out_columns=["key", "n", "running_max"])
    df = src.groupBy("key").transformWithStateInPandas(proc, "key long, n long, running_max long", "append", "None")
    out = _run(spark, df, "kreduce")
    assert sorted((r.key, r.n, r.running_max) for r in out.collect()) == [
        (1, 1, 3), (1, 2, 5), (1, 3, 7), (2, 1, 4), (2, 2, 4), (2, 3, 5)]


def test_pair_rides_fares_job(spark):
    t = dt.datetime(2024, 1, 1)
    # ride START then END, fare in between -> (START, fare); END waits
    rides = pd.DataFrame({"rideId": [1, 1, 2], "isStart": [True, False, True],
                          "startTime": [t, t, t], "seq": [0, 2, 3]})
    fares = pd.DataFrame({"rideId": [1, 2], "startTime": [t, t], "seq": [1, 4]})
    r = _stream(spark, rides, "rideId long, isStart boolean, startTime timestamp, seq long", chunks=2)
    f = _stream(spark, fares, "rideId long, startTime timestamp, seq long")
    out = _run(spark, jobs.pair_rides_fares(r.drop("isStart"), f), "pair_job")
    assert sorted(r.key for r in out.collect()) == [1, 2]


def test_window_counts_with_late_matches_batch(spark):
    from pyspark.sql import functions as F
    from cabflow.operators import events as ev
    secs = [1, 2, 7, 1, 4, 20]              # the second 1 arrives after 7: its window [0,3) is closed
    pdf = pd.DataFrame({"key": "a", "ts_ms": [s * 1000 for s in secs], "seq": range(len(secs))})
    src = _stream(spark, pdf, "key string, ts_ms long, seq long", chunks=3)
    out = _run(spark, jobs.window_counts_with_late(src, size_ms=3000, delay_ms=2000), "wlate")
    rows = out.collect()
    windows = sorted((r.window_start_ms, r.n) for r in rows if r.kind == "window")
    late = sorted(r.late_ts_ms for r in rows if r.kind == "late")
    assert windows == [(0, 2), (3000, 1), (6000, 1)] and late == [1000]
    # same rows through the batch operator (one key: per-key = global watermark)
    t0 = dt.datetime(1970, 1, 1)
    bdf = spark.createDataFrame([(i, t0 + dt.timedelta(seconds=s), t0 + dt.timedelta(hours=1, seconds=i))
                                 for i, s in enumerate(secs)], "id long, ts timestamp, arr timestamp")
    on_time, blate = ev.window_late_split(bdf, "ts", "arr", "id", "3 seconds", 2_000_000)
    assert [r.id for r in blate.collect()] == [3]
    counts = sorted((r.window_start.second, r["count"]) for r in on_time.groupBy("window_start").count().collect())
    assert counts[:3] == [(0, 2), (3, 1), (6, 1)]


def test_window_contents_and_offset_windows_stream(spark):
    from pyspark.sql import functions as F
    t = dt.datetime(2024, 1, 1)
    secs = [1, 2, 4, 3, 10_000]             # the last row moves the watermark past every window
    pdf = pd.DataFrame({"key": "k", "ts": [t + dt.timedelta(seconds=s) for s in secs], "id": range(len(secs))})
    src = _stream(spark, pdf, "key string, ts timestamp, id long", chunks=2)
    item = F.concat(F.col("id").cast("string"), F.lit("|"), F.date_format("ts", "HH:mm:ss"))
    out = _run(spark, jobs.window_contents(src, "ts", "key", item, "3 seconds", delay="0 seconds"), "wcontents")
    got = sorted((r.window_start.second, r["items"]) for r in out.collect())
    assert got[:2] == [(0, "0|00:00:01, 1|00:00:02"), (3, "3|00:00:03, 2|00:00:04")]
    src2 = _stream(spark, pdf, "key string, ts timestamp, id long", chunks=2)
    out2 = _run(spark, jobs.windowed_counts(src2, "ts", "key", "3 seconds", delay="0 seconds",
                                            offset="1 second"), "woffset")
    got2 = sorted((r.window_start.second, r.n) for r in out2.collect())
    assert got2[:1] == [(1, 3)]             # [1s, 4s) holds 1, 2, 3


def test_count_windows_stream(spark):
    pdf = pd.DataFrame({"key": "w", "value": [1] * 7, "seq": range(7)})
    tumbling = _run(spark, jobs.count_windows(_stream(spark, pdf, "key string, value long, seq long", chunks=3), 3),
                    "cw_tumble")
    assert sorted(r.total for r in tumbling.collect()) == [3, 3]
    acc = _run(spark, jobs.count_windows(_stream(spark, pdf, "key string, value long, seq long", chunks=3), 3,
                                         accumulate=True), "cw_acc")
    assert sorted(r.total for r in acc.collect()) == [3, 6]


def test_dynamic_gap_sessions_stream(spark):
    from pyspark.sql import functions as F
    t = dt.datetime(2024, 1, 1)
    rows = [("this", 0), ("this", 9), ("is", 0), ("is", 19), ("a", 0), ("a", 6), ("zz", 100_000)]
    pdf = pd.DataFrame({"word": [w for w, _ in rows], "ts": [t + dt.timedelta(seconds=s) for _, s in rows]})
    src = _stream(spark, pdf, "word string, ts timestamp", chunks=2)
    gap = (F.when(F.col("word") == "this", F.lit("10 seconds")).when(F.col("word") == "is", F.lit("20 seconds"))
           .otherwise(F.lit("5 seconds")))
    out = _run(spark, jobs.session_counts(src, "ts", "word", gap, delay="0 seconds"), "dyn_sessions")
    got = sorted((r.word, r.n) for r in out.collect() if r.word != "zz")
    assert got == [("a", 1), ("a", 1), ("is", 2), ("this", 2)]


def test_arrival_order_comes_from_the_source(spark):
    """Lines 9,1,8,2,7,3 of one key: averages of three in line order, not by value."""
    import pytest
    from pyspark.sql import functions as F
    from cabflow.sources.lines import read_lines
    d = tempfile.mkdtemp(prefix="cabflow-order-")
    with open(d + "/a.txt", "w") as f:
        f.write("\n".join(f"1,{v}" for v in (9, 1, 8, 2, 7, 3)) + "\n")
    parts = F.split("line", ",")
    kv = read_lines(spark, d, streaming=True).select(parts[0].cast("long").alias("key"), parts[1].cast("long").alias("value"), "seq")
    out = _run(spark, jobs.keyed_state(kv, "average"), "avg_lines")
    assert sorted(r.average for r in out.collect()) == [4.0, 6.0]
    with pytest.raises(ValueError, match="seq"):
        jobs.keyed_state(kv.drop("seq"), "average")


def test_late_rows_inside_one_batch_and_text_ids(spark):
    rows = [("trip-1", 100), ("trip-2", 10), ("trip-3", 101)]
    pdf = pd.DataFrame({"carId": "c", "id": [i for i, _ in rows], "timestamp": [s * 1000 for _, s in rows], "seq": range(3)})
    out = _run(spark, jobs.sort_events(_stream(spark, pdf, "carId string, id string, timestamp long, seq long"), delay_ms=30_000), "late_one")
    assert [r.id for r in out.where("kind = 'late'").collect()] == ["trip-2"]


def test_pairs_hold_both_records_and_ttl_runs(spark):
    from cabflow.sources.lines import from_rows
    from cabflow.operators.ingest import parse_fares, parse_rides
    d = tempfile.mkdtemp(prefix="cabflow-pair-")
    from_rows(spark, ["1,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.9,40.75,-73.95,40.76,1,7,8"]).select("line").write.text(d + "/r")
    from_rows(spark, ["1,7,8,2013-01-01 00:00:00,CSH,2.5,0,10.5"]).select("line").write.text(d + "/f")
    from cabflow.sources.lines import read_lines
    rides, _ = parse_rides(read_lines(spark, d + "/r", streaming=True), keep=["seq"])
    fares, _ = parse_fares(read_lines(spark, d + "/f", streaming=True), keep=["seq"])
    pairs = jobs.pair_rides_fares(rides, fares, ttl_ms=3_600_000).select(sinks.pair_text().alias("line"))
    # Processing-time state starts a batch whenever it can, so the query is never idle: wait for the row.
    import time
    q = sinks.to_memory(pairs, "pairs_ttl", d + "/ck")
    for _ in range(120):
        if spark.table("pairs_ttl").count() or not q.isActive:
            break
        time.sleep(1)
    q.stop()
    assert [r.line for r in spark.table("pairs_ttl").collect()] == [
        "(1,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.9,40.75,-73.95,40.76,1,7,8,1,7,8,2013-01-01 00:00:00,CSH,2.5,0.0,10.5)"]


def test_processors_run_from_another_folder():
    """The keyed-state job started by a process whose folder is not the repository."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    d = tempfile.mkdtemp(prefix="cabflow-elsewhere-")
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from cabflow.session import get_session
from cabflow.streaming import jobs, sinks
spark = get_session(master="local[2]", shuffle_partitions=2)
spark.createDataFrame([(1, 3, 0), (1, 5, 1), (1, 7, 2)], "key long, value long, seq long").coalesce(1).write.parquet({d!r} + "/src")
s = spark.readStream.schema("key long, value long, seq long").parquet({d!r} + "/src")
q = sinks.to_memory(jobs.keyed_state(s, "average"), "t", {d!r} + "/ck"); q.processAllAvailable(); q.stop()
print("GOT", [r.average for r in spark.table("t").collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=d, env=env, capture_output=True, text=True, timeout=240)
    assert "GOT [5.0]" in run.stdout, run.stderr[-2000:]


def test_streaming_counts_and_longest(spark):
    from cabflow.plans import driver as D
    from cabflow.sources.lines import read_lines
    d = tempfile.mkdtemp(prefix="cabflow-rides-")
    D._ride_lines(spark, "/root/testdata/sf0.001").write.text(d + "/x")
    got = _run(spark, jobs.cell_driver_duration(read_lines(spark, d + "/x", streaming=True)), "s_cells", mode="complete")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in D.q_cell_longest(spark, "/root/testdata/sf0.001").collect()}
    got = _run(spark, jobs.ride_counts(read_lines(spark, d + "/x", streaming=True)), "s_counts", mode="complete")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in D.q_ride_count(spark, "/root/testdata/sf0.001").collect()}
