"""The slots of the ordered scan change the layout, never the result."""
import contextlib
import datetime as dt
import decimal
import io
import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from cabflow.operators.scan import Agg, keyed_scan, running_window

SF = "/root/testdata/sf0.001"
ORDERED = ["running_count", "running_max", "running_sum", "count_window_avg", "session_stats", "stop_segments", "late_events",
           "event_sort", "late_marker", "late_window_side", "idle_count", "pair_first_come", "word_running_count"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ORDERED)
def test_slots_do_not_matter(spark, name):
    def run(rows=None):
        with slots(spark, rows):
            return sorted(map(tuple, ent.queries()[name](spark, SF).collect()), key=repr)
    assert run(3) == run(40) == run()


@contextlib.contextmanager
def slots(spark, rows=None):
    if rows:
        spark.conf.set("cabflow.scan.slotRows", str(rows))
    try:
        yield
    finally:
        spark.conf.unset("cabflow.scan.slotRows")


def plan_of(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_carried_columns_keep_their_values(spark):
    """Nullable longs above 2**53, NaN, decimals, strings, dates and far timestamps."""
    rows = [(i, i % 3, None if i % 5 == 0 else 2 ** 53 + i, float("nan") if i % 7 == 0 else i * 0.5, decimal.Decimal(i) / 100, f"s{i % 11:02d}",
             dt.date(2020, 1, 1) + dt.timedelta(days=i), dt.datetime(9999, 12, 31) if i % 4 == 0 else dt.datetime(2024, 1, 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, k long, big long, x double, d decimal(12,2), s string, day date, far timestamp")
    aggs = [Agg("n", "count"), *[Agg(f"max_{c}", "max", c) for c in ("big", "x", "d", "s", "day", "far")],
            *[Agg(f"prev_{c}", "last", c) for c in ("big", "x", "s")], Agg("min_d", "min", "d", inclusive=False), Agg("sum_id", "sum", "id")]
    for keys in (["k"], []):
        for order, width in ((["id"], 7), (["far", "id"], None), (["day", "id"], None), (["s", "id"], None)):
            a, b = keyed_scan(df, keys, order, aggs, width), running_window(df, keys, order, aggs)
            key = lambda r: repr(tuple(r))
            assert sorted(a.select(b.columns).collect(), key=key) == sorted(b.collect(), key=key) or \
                sorted(map(repr, a.select(b.columns).collect())) == sorted(map(repr, b.collect()))


def test_building_a_scan_starts_no_job(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("k"), "id")
    spark.sparkContext.setJobGroup("build", "build")
    keyed_scan(df, ["k"], ["id"], [Agg("n", "count")])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("", "")


def test_global_order_is_single_only_over_slots(spark):
    plan = plan_of(keyed_scan(spark.range(1000), [], ["id"], [Agg("m", "max", "id")], 10))
    below = [x.split("\n")[1] for x in plan.split("SinglePartition")[1:]]
    assert below and all("Aggregate" in x for x in below)  # one row for every slot, and the sample


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows of one key in one hour, most of them at one instant."""
    rng, rows = random.Random(5), []
    for i in range(6000):
        k = "hot" if i % 3 == 0 else f"k{rng.randint(0, 40)}"
        t = (7_200_000_000 if rng.random() < 0.7 else 7_200_000_000 + rng.randint(0, 3_000_000)) if k == "hot" else rng.randint(0, 10 ** 11)
        rows.append((i, k, t, rng.choice([0, 1]), t + rng.choice([1, 500_000, 10 ** 9]), "p" * 20))
    return spark.createDataFrame(rows, "id long, k string, t long, side int, e long, payload string").cache()


def test_a_hot_hour_is_cut_by_its_rows(spark, hot):
    from cabflow.operators.scan import slotted
    with slots(spark, 200):
        s = slotted(hot, ["k"], ["t", "id"])
        sizes = [r["count"] for r in s.rows.where("k = 'hot'").groupBy(*s.by).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) >= 7 and max(sizes) < 600
    # slots are ranges of (t, id); keys of few rows are one
    ends = s.rows.where("k = 'hot'").groupBy("_slot").agg(F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b")).orderBy("_slot").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:]))
    assert s.cut.count() == 2000 and s.rows.where("k <> 'hot' and _slot <> 0").count() == 0


def test_scans_over_cut_slots(spark, hot):
    from pyspark.sql import Window
    from cabflow.operators.joins import pair_first_come
    from cabflow.operators.scan import session_scan
    aggs = [Agg("n", "count"), Agg("m", "max", "e"), Agg("p", "last", "id"), Agg("s", "sum", "side", inclusive=False)]
    w = Window.partitionBy("k").orderBy("t", "id")
    until = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = hot.withColumn("o", F.when(until.isNull() | (F.col("t") > until), F.col("t")))
    want = opened.select("id", F.max("o").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))

    def pairs():
        d = hot.withColumn("ts", F.timestamp_micros("t"))
        return sorted((r.k, r.left_id, r.right_id) for r in pair_first_come(d.where("side = 0"), d.where("side = 1"), "k", "ts", "id").collect())
    whole = pairs()
    with slots(spark, 64):
        for keys in (["k"], []):
            a, b = keyed_scan(hot, keys, ["t", "id"], aggs), running_window(hot, keys, ["t", "id"], aggs)
            assert a.count() == 6000 and a.select(b.columns).subtract(b).count() == 0
        got = session_scan(hot, ["k"], "t", "e", "id", out="s").select("id", "s")
        assert got.subtract(want).count() == 0 and got.count() == 6000
        assert pairs() == whole and len(whole) > 500


def test_rows_are_shuffled_once(spark, hot):
    """One exchange holds the payload, whatever else a scan sums up."""
    from cabflow.operators.scan import pair_scan, session_scan
    hot = spark.createDataFrame(hot.limit(10).collect(), hot.schema)
    two = keyed_scan(hot, ["k"], ["t", "id"], [Agg("n", "count"), Agg("m", "max", "e"), Agg("p", "last", "id")])
    three = session_scan(hot, ["k"], "t", "e", "id")
    rows = hot.select("k", F.col("t").alias("t_us"), F.col("id").alias("i"), "side", "payload")
    four = pair_scan(rows, ["k"], "payload")
    for df in (two, three, four):
        moved = [x for x in plan_of(df, "formatted").split("\n\n") if ") Exchange" in x and "payload" in x.split("Arguments")[0] and "_slot" in x.split("Arguments")[1]]
        assert len(moved) == 1, moved
