"""Batch operators against the FIXTURES golden vectors and brute force."""
import datetime as dt
import random

from pyspark.sql import functions as F

from cabflow.operators import aggregates, events as ev, joins, keyed, segments, windows
from cabflow.operators.scan import Agg, keyed_scan, running_window

T0 = dt.datetime(2024, 1, 1)
KV = [(1, 3), (1, 5), (1, 7), (2, 4), (2, 2), (2, 5)]


def _kv(spark):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(KV)], "key long, value long, seq long")


def test_count_average_golden(spark):
    got = sorted((r.key, r.average) for r in keyed.count_average(_kv(spark), "key", ["seq"], "value").collect())
    assert got == [(1, 5.0), (2, 3.6666666666666665)]


def test_running_sum_golden(spark):
    got = keyed.running_sum(_kv(spark), "key", ["seq"], "value").orderBy("seq").collect()
    assert [(r.key, r.running_sum) for r in got] == [(1, 3), (1, 8), (1, 15), (2, 4), (2, 6), (2, 11)]


def test_running_concat_golden(spark):
    got = [r.contains for r in keyed.running_concat(_kv(spark), "key", ["seq"], "value").orderBy("seq").collect()]
    assert got == ["contains:3", "contains:3 and 5", "contains:3 and 5 and 7",
                   "contains:4", "contains:4 and 2", "contains:4 and 2 and 5"]


def test_count_windows(spark):
    df = spark.createDataFrame([("w", i) for i in range(7)], "word string, seq long").withColumn("one", F.lit(1))
    tumb = windows.count_tumbling(df, ["word"], ["seq"], 3, [F.sum("one").alias("n")])
    assert sorted(r.n for r in tumb.collect()) == [3, 3]
    acc = windows.count_accumulating(df, ["word"], ["seq"], 3, "one", out="n")
    assert sorted(r.n for r in acc.collect()) == [3, 6]


def test_sliding_out_of_order_scenario(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [("a", t + dt.timedelta(seconds=13)), ("a", t + dt.timedelta(seconds=13)), ("a", t + dt.timedelta(seconds=16))]
    df = spark.createDataFrame(rows, "key string, ts timestamp")
    w = windows.time_window(df, "ts", "10 seconds", ["key"], {"n": F.count(F.lit(1))}, "5 seconds")
    got = sorted((r.window_start.second, r.n) for r in w.collect())
    assert got == [(5, 2), (10, 3), (15, 1)]


def _car_rows(spark, spec):
    rows = [("c1", i, T0 + dt.timedelta(seconds=s), float(v), float(th)) for i, (s, v, th) in enumerate(spec)]
    return spark.createDataFrame(rows, "car string, id long, ts timestamp, speed float, throttle float")


def test_stop_segments_golden(spark):
    df = _car_rows(spark, [(0, 10, 10), (5, 20, 20), (10, 0, 0), (15, 30, 10), (20, 40, 14), (25, 0, 0), (30, 50, 5)])
    segs = segments.stop_segments(df, "car", "ts", "id", F.col("speed") == 0).orderBy("startTime").collect()
    ms0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert [(r.startTime - ms0, r.length, r.maxSpeed, round(r.erraticness, 4), r.label) for r in segs] == [
        (0, 2, 20.0, 5.0, "crazy"), (15000, 2, 40.0, 2.0, "calm")]


def test_gap_segments_golden(spark):
    df = _car_rows(spark, [(0, 1, 1), (15, 1, 1), (40, 0, 1), (54, 1, 1)])
    segs = segments.gap_segments(df, "car", "ts", "id", 15_000_000).orderBy("startTime").collect()
    assert [r.length for r in segs] == [2, 2]


def test_late_and_sort_golden(spark):
    arrivals = [(1, 10), (2, 5), (3, 100), (4, 20), (5, 90), (6, 180), (7, 30), (8, 165), (9, 140), (10, 3600)]
    rows = [(i, "c", T0 + dt.timedelta(seconds=s), T0 + dt.timedelta(hours=1, seconds=pos))
            for pos, (i, s) in enumerate(arrivals)]
    df = spark.createDataFrame(rows, "id long, car string, ts timestamp, arr timestamp")
    on_time, late = ev.late_split(df, "ts", "arr", "id", 30_000_000)
    assert sorted(r.id for r in late.collect()) == [4, 7, 9]
    s = ev.sort_by_event_time(on_time, ["car"], "ts", "id").orderBy("pos").collect()
    assert [r.id for r in s] == [2, 1, 5, 3, 8, 6, 10]


def test_dynamic_session_and_idle_golden(spark):
    rows = [("this", 0), ("this", 9), ("is", 0), ("is", 19), ("a", 0), ("a", 6)]
    df = spark.createDataFrame([(w, i, T0 + dt.timedelta(seconds=s)) for i, (w, s) in enumerate(rows)],
                               "word string, seq long, ts timestamp")
    gap = (F.when(F.col("word") == "this", F.lit(10_000_000)).when(F.col("word") == "is", F.lit(20_000_000))
           .otherwise(F.lit(5_000_000)))
    s = windows.sessions(df, ["word"], "ts", "seq", gap, [F.count(F.lit(1)).alias("n")])
    got = sorted((r.word, r.n) for r in s.collect())
    assert got == [("a", 1), ("a", 1), ("is", 2), ("this", 2)]
    idle = spark.createDataFrame([("w", i, T0 + dt.timedelta(seconds=s)) for i, s in enumerate([0, 3, 4, 12])],
                                 "key string, seq long, arr timestamp")
    got = keyed.idle_count(idle, "key", "arr", "seq", 5_000_000).orderBy("session_start").collect()
    assert [r.n for r in got] == [3, 1]


def _state_machine(events):
    """Reference pairing: one waiting element per key, consume on match."""
    waiting, out = {}, []
    for k, side, i in events:
        w = waiting.get(k)
        if w is not None and w[0] != side:
            out.append((k, w[1], i) if w[0] == 0 else (k, i, w[1]))
            del waiting[k]
        else:
            waiting[k] = (side, i)
    return sorted(out)


def test_pair_first_come_golden_and_random(spark):
    random.seed(7)
    events = []
    for n in range(400):
        k = 1 if random.random() < 0.3 else random.randint(2, 40)
        events.append((k, random.randint(0, 1), n))
    for seq in ([(90, 0, 1000), (90, 1, 1001)], [(91, 1, 1002), (91, 0, 1003), (91, 0, 1004)],
                [(92, 0, 1005), (92, 0, 1006), (92, 1, 1007)]):
        events.extend(seq)
    df = spark.createDataFrame([(k, s, i, T0 + dt.timedelta(seconds=i)) for k, s, i in events],
                               "k long, side int, i long, t timestamp")
    left, right = df.where("side = 0"), df.where("side = 1")
    p = joins.pair_first_come(left, right, "k", "t", "i")
    got = sorted((r.k, r.left_id, r.right_id) for r in p.collect())
    assert got == _state_machine(events)
    assert (92, 1006, 1007) in got and (91, 1003, 1002) in got


def test_unmatched(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(2,), (3,), (3,), (None,)], "k long")
    got = sorted((r.k if r.k is not None else -1, r.side) for r in joins.unmatched(left, right, "k").collect())
    assert got == [(-1, "left"), (-1, "right"), (1, "left"), (3, "right")]


def test_hourly_top_tie_smallest_driver(spark):
    rows = [(1, T0, 5.0), (1, T0, 2.0), (2, T0, 6.0), (3, T0 + dt.timedelta(hours=1), 1.0),
            (4, T0 + dt.timedelta(hours=1), 1.0)]
    df = spark.createDataFrame(rows, "driver long, ts timestamp, tip double")
    h = windows.time_window(df, "ts", "1 hour", ["driver"], {"tips": F.sum("tip")})
    top = h.groupBy("window_start").agg(F.max_by(F.struct("driver", "tips"),
                                                 F.struct(F.col("tips"), -F.col("driver"))).alias("t"))
    got = sorted((r.t.driver, r.t.tips) for r in top.collect())
    assert got == [(1, 7.0), (3, 1.0)]


def test_running_max_and_count(spark):
    df = _kv(spark)
    got = aggregates.running_max(df, ["key"], ["seq"], "value").orderBy("seq").collect()
    assert [r.max_value for r in got] == [3, 5, 7, 4, 4, 5]
    got = aggregates.running_count(df, ["key"], ["seq"]).orderBy("seq").collect()
    assert [r.n for r in got] == [1, 2, 3, 1, 2, 3]


def test_keyed_scan_matches_window_with_hot_key(spark):
    random.seed(3)
    rows = []
    for i in range(3000):
        k = 0 if random.random() < 0.34 else random.randint(1, 30)
        rows.append((i, k, random.randint(0, 500), random.choice([None, 1.0, -2.5, 4.0]), random.choice(["L", "R"])))
    df = spark.createDataFrame(rows, "id long, k long, t long, v double, side string")
    aggs = [Agg("n", "count"), Agg("s", "sum", "v"), Agg("sx", "sum", "id", inclusive=False),
            Agg("m", "max", "t"), Agg("mx", "min", "t", inclusive=False), Agg("prev", "last", "side")]
    for keys in (["k"], []):
        a = keyed_scan(df, keys, ["t", "id"], aggs, 13).select("id", *[x.out for x in aggs])
        b = running_window(df, keys, ["t", "id"], aggs).select("id", *[x.out for x in aggs])
        assert a.count() == 3000
        assert a.subtract(b).count() == 0 and b.subtract(a).count() == 0


def test_keyed_scan_large_longs_exact(spark):
    big = 2 ** 60
    rows = [(i, i % 3, big + i) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k long, v long")
    aggs = [Agg("m", "max", "v"), Agg("p", "last", "v"), Agg("mx", "max", "v", inclusive=False)]
    a = keyed_scan(df, ["k"], ["id"], aggs, 5).select("id", "m", "p", "mx")
    b = running_window(df, ["k"], ["id"], aggs).select("id", "m", "p", "mx")
    assert a.subtract(b).count() == 0 and b.subtract(a).count() == 0


def test_session_scan_matches_brute_force(spark):
    from pyspark.sql import Window
    from cabflow.operators.scan import session_scan
    random.seed(11)
    rows = []
    for i in range(4000):
        k = 0 if random.random() < 0.4 else random.randint(1, 25)
        t = random.randint(0, 200_000)
        rows.append((i, k, t, t + random.choice([50, 400, 3000])))
    df = spark.createDataFrame(rows, "id long, k long, t long, e long")
    got = session_scan(df, ["k"], "t", "e", "id", out="s", width=1000).select("id", "s")
    w = Window.partitionBy("k").orderBy("t", "id")
    pe = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    b = df.withColumn("st", F.when(pe.isNull() | (F.col("t") > pe), F.col("t")))
    want = b.select("id", F.max("st").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert got.count() == 4000
    assert got.subtract(want).count() == 0 and want.subtract(got).count() == 0


def test_pair_scan_many_partitions(spark):
    random.seed(21)
    events = []
    for n in range(3000):
        k = 5 if random.random() < 0.35 else random.randint(6, 60)
        events.append((k, random.randint(0, 1), n))
    df = spark.createDataFrame([(k, s, i, T0 + dt.timedelta(seconds=i // 3)) for k, s, i in events],
                               "k long, side int, i long, t timestamp")
    ordered = sorted(events, key=lambda e: (e[2] // 3, e[1], e[2]))   # arrival order (t, side, i)
    p = joins.pair_first_come(df.where("side = 0"), df.where("side = 1"), "k", "t", "i")
    rows = p.collect()
    assert sorted((r.k, r.left_id, r.right_id) for r in rows) == _state_machine(ordered)
    assert all(r.left.i == r.left_id and r.right.i == r.right_id and r.left.side == 0 and r.right.side == 1 for r in rows)


def test_running_max_by_carries_the_row(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 7), (3, "a", 7), (4, "a", 5), (5, "b", None), (6, "b", 1)], "seq long, k string, v long")
    got = {r.seq: r.best and r.best.seq for r in aggregates.running_max_by(df, ["k"], ["seq"], "v").collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2, 5: None, 6: 6}


def test_max_by_key_ties_and_strings(spark):
    df = spark.createDataFrame([("x", 5, "b"), ("x", 5, "a"), ("x", 4, "0"), ("y", None, "c"), ("z", 1, "q")], "k string, v long, who string")
    got = sorted(map(tuple, aggregates.max_by_key(df, ["k"], "v", "who").collect()))
    assert got == [("x", 5, "a"), ("z", 1, "q")]


def test_window_contents_and_text(spark):
    rows = [(i, T0 + dt.timedelta(seconds=s)) for i, s in enumerate([1, 2, 4, 3])]
    df = spark.createDataFrame(rows, "id long, ts timestamp")
    got = sorted((r.window_start.second, r.pos, r.item) for r in windows.window_contents(df, "ts", "3 seconds", [], F.col("id"), ["ts", "id"]).collect())
    assert got == [(0, 1, 0), (0, 2, 1), (3, 1, 3), (3, 2, 2)]
    text = windows.collect_window(df, "ts", "3 seconds", [], F.col("id").cast("string"), ["ts", "id"]).collect()
    assert sorted(r["items"] for r in text) == ["0, 1", "3, 2"]


def test_top_n_salted_matches_brute_force(spark):
    from pyspark.sql import Window
    random.seed(5)
    rows = [(("hot" if random.random() < 0.6 else f"g{random.randint(0, 9)}"), i, random.randint(0, 50))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id long, v long")
    order = [F.col("v").desc(), F.col("id")]
    want = (df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
              .where("rank <= 4"))
    got = aggregates.top_n(df, ["g"], order, 4, salt_col="id", buckets=16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")   # force the salted phase
    try:
        got = aggregates.top_n(df, ["g"], order, 4, salt_col="id", buckets=16)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_durations_quarantine_negative(spark):
    from cabflow.operators import rides
    from cabflow.sources.lines import from_rows
    lines = from_rows(spark, [
        "1,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.9,40.75,-73.95,40.76,1,1,1",
        "2,END,2013-01-01 00:00:00,2013-01-01 00:12:59,-73.9,40.75,-73.95,40.76,1,1,1"])
    enriched, _ = rides.cleanse(lines)
    assert [(r.rideId, r.minutes) for r in rides.durations(enriched).collect()] == [(1, 12)]
    assert [r.rideId for r in rides.invalid_durations(enriched).collect()] == [2]


def test_bucketed_tables_join_without_shuffle(spark, tmpdir_path):
    import contextlib
    import io
    from cabflow.sources.tables import save_bucketed, table
    o = table(spark, "/root/testdata/sf0.001", "orders").select("o_orderkey", "o_totalprice")
    li = table(spark, "/root/testdata/sf0.001", "lineitem").select("l_orderkey", "l_extendedprice")
    bo = save_bucketed(o, "b_orders", "o_orderkey", 8, tmpdir_path + "/o")
    bl = save_bucketed(li, "b_items", "l_orderkey", 8, tmpdir_path + "/l")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = joins.equi_pairs(bo, bl, "o_orderkey", "l_orderkey")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "Exchange" not in buf.getvalue() and "SortMergeJoin" in buf.getvalue()
        assert j.count() == li.join(o, li.l_orderkey == o.o_orderkey).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_session_scan_tolerates_null_times(spark):
    from cabflow.operators.scan import session_scan
    rows = [(1, 1, 10, 20), (2, 1, None, None), (3, 1, 15, 25), (4, 1, 40, 50)]
    df = spark.createDataFrame(rows, "id long, k long, t long, e long")
    got = {r.id: r.s for r in session_scan(df, ["k"], "t", "e", "id", out="s", width=5).collect()}
    assert got == {1: 10, 2: None, 3: 10, 4: 40}
