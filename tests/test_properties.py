"""Property tests: invariants over random inputs, few examples
each because every example runs Spark jobs."""
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabflow.operators import events as ev, segments, windows

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 600), st.integers(0, 300),
                             st.sampled_from([0.0, 0.0, 5.0, 12.5, 30.0])),
                   min_size=1, max_size=120)


@pytest.fixture(params=["262144", "4"])
def strategy(request, spark):
    spark.conf.set("cabflow.scan.slotRows", request.param)
    yield request.param
    spark.conf.unset("cabflow.scan.slotRows")


def _df(spark, rows):
    data = [(i, k, T0 + dt.timedelta(seconds=t), T0 + dt.timedelta(seconds=t + lag), v)
            for i, (k, t, lag, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k long, ts timestamp, arr timestamp, v double")


@SETTINGS
@given(rows=rows_st)
def test_late_plus_on_time_is_input(spark, strategy, rows):
    df = _df(spark, rows)
    on_time, late = ev.late_split(df, "ts", "arr", "id", 60_000_000)
    ids = sorted(r.id for r in on_time.select("id").union(late.select("id")).collect())
    assert ids == list(range(len(rows)))


@SETTINGS
@given(rows=rows_st)
def test_stop_segments_cover_moving_events_once(spark, strategy, rows):
    df = _df(spark, rows)
    segs = segments.stop_segments(df, "k", "ts", "id", F.col("v") == 0, speed="v", throttle="v")
    covered = segs.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    # moving rows that precede the last stop of their key, in (ts, id) order
    by_key = {}
    for i, (k, t, _, v) in enumerate(rows):
        by_key.setdefault(k, []).append((t, i, v))
    expect = 0
    for evs in by_key.values():
        evs.sort()
        stops = [j for j, e in enumerate(evs) if e[2] == 0.0]
        if stops:
            expect += sum(1 for e in evs[:stops[-1]] if e[2] != 0.0)
    assert covered == expect


@SETTINGS
@given(rows=rows_st)
def test_count_windows_emit_floor_n_over_3(spark, strategy, rows):
    df = _df(spark, rows)
    out = windows.count_tumbling(df, ["k"], ["ts", "id"], 3, [F.count(F.lit(1)).alias("n")])
    got = {r.k: r.c for r in out.groupBy("k").agg(F.count(F.lit(1)).alias("c")).collect()}
    counts = {}
    for k, *_ in rows:
        counts[k] = counts.get(k, 0) + 1
    assert got == {k: c // 3 for k, c in counts.items() if c // 3}


@SETTINGS
@given(rows=rows_st, seed=st.integers(0, 10))
def test_sessions_invariant_under_shuffle(spark, strategy, rows, seed):
    df = _df(spark, rows)
    agg = [F.count(F.lit(1)).alias("n")]
    a = windows.sessions(df, ["k"], "ts", "id", 30_000_000, agg)
    b = windows.sessions(df.orderBy(F.rand(seed)).repartition(5), ["k"], "ts", "id", 30_000_000, agg)
    builtin = windows.sessions_builtin(df, ["k"], "ts", "30 seconds", agg)
    key = lambda r: (r.k, r.session_start, r.session_end, r.n)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect())) == sorted(map(key, builtin.collect()))
