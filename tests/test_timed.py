"""Processors on timers against their batch forms: silent keys, late rows, restarts; no sentinel rows."""
import datetime as dt
import os
import random
import tempfile
import time

import pandas as pd
from pyspark.sql import functions as F

from cabflow.operators import aggregates, events as ev, joins, segments, useragg, windows
from cabflow.streaming import jobs, sinks, timed


class Replay:
    """A stream of files, one micro-batch each, and the same rows with their batch number."""

    def __init__(self, spark, pdf, schema, batches, number="batch_no"):
        self.spark, self.schema, self.dir = spark, schema, tempfile.mkdtemp(prefix="cabflow-src-")
        cut = [len(pdf) * i // batches for i in range(batches + 1)]
        for i, (a, b) in enumerate(zip(cut, cut[1:])):
            spark.createDataFrame(pdf.iloc[a:b], schema).coalesce(1).write.mode("append").parquet(self.dir)
        self.table = spark.createDataFrame(pdf.assign(**{number: [sum(c <= i for c in cut[1:]) for i in range(len(pdf))]}), f"{schema}, {number} long")
        self.stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.dir)

    def run(self, df, name, mode="append"):
        self.checkpoint = tempfile.mkdtemp(prefix="cabflow-ck-")
        q = sinks.to_memory(df, name, self.checkpoint, mode=mode)
        q.processAllAvailable()
        q.stop()
        return self.spark.table(name)


CAR = "carId string, id long, timestamp long, speed float, throttle float, seq long"


def cars(n=400, seed=1):
    """Cars in jumbled order; car 'gone' and car 'c1' fall silent early."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        t = 1_000_000 + i * 1_000 + rng.randint(-40_000, 0)
        car = rng.choice(["c1", "c2", "c3", "gone"] if i < n // 4 else ["c2", "c3"])
        speed = 0.0 if rng.random() < 0.15 else None if rng.random() < 0.03 else float(rng.randint(1, 90))
        rows.append((car, i, t, speed, float(rng.randint(0, 30)), i))
    return pd.DataFrame(rows, columns=["carId", "id", "timestamp", "speed", "throttle", "seq"])


def batch_view(r, delay_ms):
    """On-time and late rows when each micro-batch is a period of the watermark."""
    t = r.table.withColumn("ts", F.timestamp_millis("timestamp"))
    return ev.late_split(t, "ts", None, "seq", delay_ms * 1000, emit_every="batch_no")


def test_sorter_reaches_silent_keys(spark):
    r = Replay(spark, cars(), CAR, 8)
    out = r.run(jobs.sort_events_by_clock(r.stream, delay_ms=20_000), "clock_sort").collect()
    on_time, late = batch_view(r, 20_000)
    want_late = {x.id for x in late.collect()}
    assert {int(x.id) for x in out if x.kind == "late"} == want_late and want_late
    want = {(x.carId, x.id): x.pos for x in ev.sort_by_event_time(on_time, ["carId"], "ts", "seq").collect()}
    got = {}
    for x in out:
        if x.kind == "sorted":
            got.setdefault(x.key, []).append(int(x.id))
    assert {x.event.speed for x in out if x.kind == "sorted"} >= {0.0, None}
    # the silent cars are complete without another row of theirs
    for car in ("gone", "c1"):
        assert [(car, i) for i in got[car]] == sorted((k for k in want if k[0] == car), key=want.get)
    # the rest of the others is in the checkpoint, in order
    rest = timed.rest_sorted(spark, r.checkpoint).orderBy("car", "pos").collect()
    for x in rest:
        got[x.car].append(int(x.id))
    assert {(c, i): k + 1 for c, ids in got.items() for k, i in enumerate(ids)} == want
    assert {x.car for x in rest} <= {"c2", "c3"}


def test_segmenter_reaches_silent_keys(spark):
    r = Replay(spark, cars(seed=2), CAR, 7)
    out = r.run(jobs.stop_segments_by_clock(r.stream, delay_ms=20_000), "clock_seg")
    on_time, late = batch_view(r, 20_000)
    key = lambda x: (x[0], x.startTime, x.length, x.maxSpeed, round(x.erraticness, 3), x.label)
    want = {key(x) for x in segments.stop_segments(on_time, "carId", "ts", "seq", F.col("speed") == 0).select("carId", "startTime", "length", "maxSpeed", "erraticness", "label").collect()}
    got = {key(x) for x in out.where("kind = 'segment'").collect()} | {key(x) for x in timed.rest_segments(spark, r.checkpoint).collect()}
    assert got == want and len(want) > 30
    assert sorted(x.late_ts_ms for x in out.where("kind = 'late'").collect()) == sorted(x.timestamp for x in late.collect())
    silent = {x for x in want if x[0] in ("gone", "c1")}
    assert silent and silent <= {key(x) for x in out.where("kind = 'segment'").collect()}


def test_segmenter_state_is_bounded_by_the_delay(spark):
    """A car that never stops, and a stop predicate of one's own."""
    pdf = pd.DataFrame([("a", i, 1_000_000 + i * 1_000, 50.0, float(i % 7), i) for i in range(600)], columns=["carId", "id", "timestamp", "speed", "throttle", "seq"])
    r = Replay(spark, pdf, CAR, 6)
    out = r.run(jobs.stop_segments_by_clock(r.stream, delay_ms=10_000, is_stop=F.col("throttle") < 0), "clock_nostop")
    assert out.count() == 0
    assert timed.held_rows(spark, r.checkpoint, "rows").count() <= 11
    acc = timed.held_rows(spark, r.checkpoint, "open").select("value.*").first()
    x = pdf["throttle"][:acc.n]
    assert acc.n >= 589 and acc.start == 1_000_000 and acc.top == 50.0 and abs(acc.m2 / acc.n - x.var(ddof=0)) < 1e-9


def test_segment_statistics_merge():
    rng = random.Random(4)
    ts, speed, x = ([rng.randint(0, 99) for _ in range(50)], [rng.choice([None, 1.0, 70.0]) for _ in range(50)], [rng.choice([None, 3.0, 9.5]) for _ in range(50)])
    pdf = pd.DataFrame({"ts_ms": ts, "speed": speed, "throttle": x, "stop": False})
    whole = timed.fold_segments(timed.EMPTY_SEGMENT, pdf)[1]
    acc = timed.EMPTY_SEGMENT
    for a, b in ((0, 0), (0, 1), (1, 20), (20, 50)):
        acc = timed.fold_segments(acc, pdf.iloc[a:b])[1]
    assert acc[:4] == whole[:4] and all(abs(a - b) < 1e-9 for a, b in zip(acc[4:], whole[4:]))
    assert whole[0] == 50 and abs((whole[5] / whole[3]) - pdf["throttle"].astype(float).var(ddof=0)) < 1e-9


def keyed_times(n=300, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "quiet"] if i < n // 3 else ["a", "b"]), 500_000 + i * 500 + rng.randint(-30_000, 0), rng.randint(1, 9), i) for i in range(n)]
    return pd.DataFrame(rows, columns=["key", "ts_ms", "value", "seq"])


TIMES = "key string, ts_ms long, value long, seq long"


def test_window_firings_stream_equals_batch(spark):
    for allowed, edge in ((0, 0), (8_000, 0), (25_000, 1)):
        r = Replay(spark, keyed_times(), TIMES, 9)
        name = f"clock_fire_{allowed}_{edge}"
        out = r.run(jobs.window_firings(r.stream, 10_000, 5_000, allowed, edge), name)
        t = r.table.withColumn("ts", F.timestamp_millis("ts_ms")).withColumn("arr", F.timestamp_seconds("seq"))
        args = ("ts", "arr", "seq", "10 seconds", 5_000_000, allowed * 1000)
        want = ev.window_firings(t, *args, ["key"], edge * 1000, emit_every="batch_no")
        want = {(x.key, int(x.window_start.timestamp() * 1000), x.firing, x.n) for x in want.collect()}
        got = {(x.key, x.window_start_ms, x.firing, x.n) for x in out.where("kind = 'window'").collect()}
        first = {x for x in got if x[0] == "quiet" and x[2] == 1}
        got |= {(x.key, x.window_start_ms, x.firing, x.n) for x in timed.rest_windows(spark, r.checkpoint).collect()}
        assert got == want and first
        assert any(x[2] > 1 for x in want) == (allowed > 0)
        _, late = ev.window_late_split(t, *args, edge * 1000, emit_every="batch_no")
        assert sorted(x.late_ts_ms for x in out.where("kind = 'late'").collect()) == sorted(x.ts_ms for x in late.collect())
        # state is kept to the end plus the allowance
        left = timed.held_rows(spark, r.checkpoint, "windows").select(F.min("user_map_key.start")).first()[0]
        wm = max(r.table.agg(F.max("ts_ms")).first()[0] - 5_000, 0)
        assert left + 10_000 - edge + allowed > wm


def test_window_firings_by_hand(spark):
    """In batch, row by row: on time, then two re-fires, then too late."""
    t0 = dt.datetime(2024, 1, 1)
    s = lambda x: t0 + dt.timedelta(seconds=x)
    rows = [("k", s(1), 0), ("k", s(2), 1), ("k", s(14), 2), ("k", s(3), 3), ("k", s(4), 4), ("k", s(30), 5), ("k", s(5), 6), ("z", s(11), 7)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, seq long").withColumn("arr", F.timestamp_seconds("seq"))
    got = {(x.key, x.window_start, x.firing, x.n) for x in ev.window_firings(df, "ts", "arr", "seq", "10 seconds", 2_000_000, 10_000_000, ["key"]).collect()}
    # watermark: 12 s after row 2, 28 s after row 5; row 6 (window to 10, allowed to 20) is too late, row 7 (window to 20, allowed to 30) fires at once
    assert got == {("k", t0, 1, 2), ("k", t0, 2, 3), ("k", t0, 3, 4), ("k", s(10), 1, 1), ("k", s(30), 1, 1), ("z", s(10), 1, 1)}


def test_sessions_that_join_are_merged(spark):
    r = Replay(spark, keyed_times(120, seed=8), TIMES, 5)
    agg = useragg.contains_text()
    out = r.run(jobs.session_aggregate(r.stream, 900, 40_000, agg), "clock_sess").where("kind = 'session'").collect()
    assert out and not spark.table("clock_sess").where("kind = 'late'").count()
    t = r.table.withColumn("ts", F.timestamp_millis("ts_ms"))
    s = windows.sessions(t, ["key"], "ts", "seq", 900_000, [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")])
    s = s.select("key", F.unix_millis("session_start").alias("a"), F.unix_millis("session_end").alias("b"), "n", "total")
    want = {(x.key, x.a, x.b): (x.n, x.total) for x in s.collect()}
    for x in out:
        items = x.contains.removeprefix("contains:").split(" and ")
        assert want[x.key, x.session_start_ms, x.session_end_ms] == (len(items), sum(map(int, items)))
    assert {x.key for x in out} == {"a", "b", "quiet"}
    # a row between two sessions joins them, the earlier one's values first
    pdf = pd.DataFrame([("k", 10_000, 1, 0), ("k", 13_000, 3, 1), ("k", 11_500, 2, 2), ("k", 99_000, 9, 3), ("z", 200_000, 1, 4)], columns=["key", "ts_ms", "value", "seq"])
    r = Replay(spark, pdf, TIMES, 5)
    rows = r.run(jobs.session_aggregate(r.stream, 2_000, 5_000, agg), "clock_join").collect()
    assert sorted((x.session_start_ms, x.session_end_ms, x.contains) for x in rows) == [(10_000, 15_000, "contains:1 and 2 and 3"), (99_000, 101_000, "contains:9")]


def test_pairs_account_for_every_element(spark):
    rng, t0 = random.Random(6), 1_700_000_000
    rides, fares = [], []
    for i in range(300):
        side = rides if rng.random() < 0.5 else fares
        side.append((rng.randint(0, 120), dt.datetime.fromtimestamp(t0 + i, dt.timezone.utc).replace(tzinfo=None), i, i))
    for k in (900, 901):
        rides.append((k, dt.datetime.fromtimestamp(t0, dt.timezone.utc).replace(tzinfo=None), 1000 + k, 1000 + k))
    schema = "rideId long, startTime timestamp, tag long, seq long"
    rr, ff = (Replay(spark, pd.DataFrame(x, columns=["rideId", "startTime", "tag", "seq"]).sort_values("seq"), schema, 1) for x in (rides, fares))
    out = rr.run(jobs.pairs_and_unmatched(rr.stream, ff.stream, ttl_ms=50_000), "clock_pairs").collect()
    seen = [x.ride.tag for x in out if x.ride] + [x.fare.tag for x in out if x.fare]
    waiting = timed.held_rows(spark, rr.checkpoint, "waiting").select("value.*").collect()
    assert len(seen) == len(set(seen)) and len(seen) + len(waiting) == 302
    assert all(x.ride and x.fare for x in out if x.kind == "pair") and all(bool(x.ride) != bool(x.fare) for x in out if x.kind != "pair")
    pairs = joins.pair_first_come(rr.table, ff.table, "rideId", "startTime", "tag").collect()
    assert {(x.ride.tag, x.fare.tag) for x in out if x.kind == "pair"} == {(p.left_id, p.right_id) for p in pairs}
    # keys of one side only, as in the batch report, are all among the unmatched
    lone = {x.rideId for x in joins.unmatched(rr.table, ff.table, "rideId").collect()}
    paired = {x.key for x in out if x.kind == "pair"}
    assert lone and not lone & paired
    # elements whose time plus ttl the stream has passed have expired, the others wait
    end = (t0 + 299) * 1000
    assert all(w.ts_ms + 50_000 > end for w in waiting) and {900, 901} <= {x.key for x in out if x.kind == "expired"}
    assert {x.kind for x in out} == {"pair", "replaced", "expired"}


def test_hourly_top_stream_equals_batch(spark):
    rng, t0 = random.Random(9), dt.datetime(2024, 1, 1)
    rows = [(rng.randint(1, 12), t0 + dt.timedelta(minutes=i * 2), float(rng.randint(0, 4))) for i in range(240)] + [(1, t0 + dt.timedelta(days=2), 1.0)]
    r = Replay(spark, pd.DataFrame(rows, columns=["driverId", "startTime", "tip"]), "driverId long, startTime timestamp, tip double", 4)
    got = {(x.window_start, x["rank"], x.driverId, x.tips) for x in r.run(jobs.hourly_top(r.stream, 3, "0 seconds"), "clock_top").collect()}
    sums = windows.time_window(r.table, "startTime", "1 hour", ["driverId"], {"tips": F.sum("tip")})
    want = aggregates.top_n(sums, ["window_start"], [F.col("tips").desc(), F.col("driverId")], 3).where(F.col("window_start") < t0 + dt.timedelta(days=1))
    assert got == {(x.window_start, x["rank"], x.driverId, x.tips) for x in want.collect()} and len(got) == 24
    heap = [(4.0, -2), (4.0, -1), (9.0, -7), (1.0, -3)]
    assert timed.merge_top(timed.merge_top([], heap[:2], 3), heap[2:], 3) == timed.merge_top(heap, [], 3) == [(9.0, -7), (4.0, -1), (4.0, -2)]


def test_pane_windows_match_sliding_windows(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 9000)), rng.randint(0, 50)) for _ in range(400)] + [("a", None, 1)], "k string, ts timestamp, v long")
    got = windows.pane_windows(df, "ts", 1_800_000_000, 300_000_000, ["k"], {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))})
    want = windows.time_window(df, "ts", "30 minutes", ["k"], {"n": F.count(F.lit(1)), "s": F.sum("v"), "lo": F.min("v"), "hi": F.max("v")}, slide="5 minutes")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def _live(spark, df, name, done, mode="update"):
    q = sinks.to_memory(df, name, tempfile.mkdtemp(prefix="cabflow-ck-"), mode=mode, trigger={"processingTime": "300 milliseconds"})
    end = time.time() + 60
    while time.time() < end and not done(spark.table(name)):
        time.sleep(0.3)
    q.stop()
    return spark.table(name).collect()


def test_processing_time_panes(spark):
    """A word falls silent; timers close all its windows, each row in size / slide of them."""
    r = Replay(spark, pd.DataFrame({"word": ["w"] * 5 + ["v"]}), "word string", 1)
    rows = _live(spark, jobs.sliding_word_counts(r.stream, 2_000, 500), "panes", lambda t: t.agg(F.sum("n")).first()[0] == 24)
    assert sum(x.n for x in rows if x.key == "w") == 20 and sum(x.n for x in rows if x.key == "v") == 4
    assert sorted(x.window_start_ms for x in rows if x.key == "v") == [rows[0].window_start_ms + 500 * i for i in range(4)]


def test_wallclock_windows_with_a_fixed_clock(spark):
    now = 1_000_000
    pdf = pd.DataFrame([("a", 996_000, 1, 0), ("a", 991_000, 1, 1), ("a", 988_000, 1, 2), ("a", 970_000, 1, 3)], columns=["key", "ts_ms", "value", "seq"])
    r = Replay(spark, pdf, TIMES, 1)
    # the clock stands at 1,000,000: the watermark is 995,000, so windows that end up to there are closed
    rows = _live(spark, jobs.wallclock_counts(r.stream, 10_000, 5_000, 5_000, clock=lambda: now), "wall", lambda t: t.count() >= 2)
    assert sorted((x.late_ts_ms, x.kind) for x in rows) == [(970_000, "late"), (988_000, "late")]
    flag = os.path.join(tempfile.mkdtemp(prefix="cabflow-clock-"), "later")

    def seen(t):
        if t.count() >= 2:
            open(flag, "w").close()
        return t.where("kind = 'window'").count() >= 2
    later = _live(spark, jobs.wallclock_counts(r.stream, 10_000, 5_000, 5_000, clock=lambda: now + 60_000 * os.path.exists(flag)), "wall2", seen)
    got = {(x.window_start_ms, x.n) for x in later if x.kind == "window"}
    assert got == {(990_000, 2), (995_000, 1)}


def test_groups_survive_a_restart(spark):
    """Stopped in the middle of a group; a batch whose commit is lost runs again."""
    src, out, ck = (tempfile.mkdtemp(prefix=f"cabflow-{x}-") for x in ("gs", "go", "gc"))
    schema = "x long, seq long"

    def feed(a, b):
        spark.createDataFrame([(i, i) for i in range(a, b)], schema).coalesce(1).write.mode("append").parquet(src)

    def go():
        q = jobs.grouped_to_files(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), F.col("x"), out, ck, threshold=20, trigger={"availableNow": True})
        q.awaitTermination()
        return spark.read.parquet(out).orderBy("group_no", "pos").collect()

    feed(0, 33)
    assert [int(r.record) for r in go()] == list(range(20))
    feed(33, 50)
    feed(50, 75)
    rows = go()
    assert [int(r.record) for r in rows] == list(range(60)) and [r.group_no for r in rows] == [i // 20 for i in range(60)] and all(r.whole for r in rows)
    # the last batch is run again: its commit is gone, as after a failure of the driver
    last = max(int(n) for n in os.listdir(f"{ck}/commits") if n.isdigit())
    for n in (f"{ck}/commits/{last}", f"{ck}/commits/.{last}.crc"):
        if os.path.exists(n):
            os.remove(n)
    feed(75, 81)
    rows = go()
    assert [int(r.record) for r in rows] == list(range(80)) and [(r.group_no, r.pos) for r in rows] == [(i // 20, i % 20) for i in range(80)]


def test_groups_are_flushed_by_a_timer(spark):
    r = Replay(spark, pd.DataFrame({"x": range(25), "seq": range(25)}), "x long, seq long", 1)
    rows = _live(spark, jobs.record_groups(r.stream, F.col("x"), 10, flush_ms=800), "flush", lambda t: t.count() == 25)
    assert sorted((x.group_no, x.pos, int(x.record)) for x in rows) == [(i // 10, i % 10, i) for i in range(25)]
    assert {x.whole for x in rows if x.group_no == 2} == {False}


def test_user_aggregate_merges_in_order(spark):
    """A hot key in many slots, a null key, no keys; the text and its digest."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), i, rng.randint(0, 99)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(6)
    spark.conf.set("cabflow.scan.slotRows", "40")
    try:
        texts = {x.k: x.contains for x in useragg.aggregate_by(df, ["k"], ["i"], "v", useragg.contains_text()).collect()}
        digests = {x.k: (x.n_items, x.n_bytes, x.digest) for x in useragg.aggregate_by(df, ["k"], ["i"], "v", useragg.contains_digest(), width=50).collect()}
        whole = useragg.aggregate_by(df, [], ["i"], "v", useragg.contains_text()).collect()
    finally:
        spark.conf.unset("cabflow.scan.slotRows")
    want = {k: "contains:" + " and ".join(str(v) for x, _, v in rows if x == k) for k in {r[0] for r in rows}}
    assert texts == want and [x.contains for x in whole] == ["contains:" + " and ".join(str(v) for _, _, v in rows)]
    assert digests == {k: (t.count(" and ") + 1, len(t), useragg.text_hash(t)[1]) for k, t in want.items()}
