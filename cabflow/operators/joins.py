"""Ride–fare pairing on a shared id.

Three forms (SURVEY JOI1):

1. ``equi_pairs`` – deterministic inner equi-join.  No hint: AQE picks a
   broadcast only when the runtime size of one side is under the broadcast
   threshold, else a sort-merge join whose skewed partitions it splits.
2. ``pair_first_come`` – the reference's consume-on-match state machine per
   key, in arrival order: whichever side arrives first waits; an arrival of
   the other side pairs with it and clears it; an arrival of the same side
   overwrites it.  Closed form: a new *island* starts whenever a row has the
   same side as the previous row of its key; inside an island sides
   alternate and rows (1,2), (3,4), ... are the pairs.  ``pair_scan`` is a
   two-level scan, so a hot key never lands in one task.
3. ``unmatched`` – keys without a partner on the other side (one grouped union).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.scan import pair_scan


def equi_pairs(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    rk = right_key or key
    if rk == key:
        return left.join(right, key, "inner")
    return left.join(right, left[key] == right[rk], "inner")


def pair_first_come(left: DataFrame, right: DataFrame, key: str, time: str, ident: str,
                    left_time: str | None = None, right_time: str | None = None,
                    left_id: str | None = None, right_id: str | None = None) -> DataFrame:
    """Pairs in arrival order: key, left_id, right_id, left_time, right_time
    and the records themselves as structs ``left`` and ``right``.

    ``time`` then side ('L' before 'R') then ``ident`` break ties, so the
    arrival order is total.
    """
    lt, rt = left_time or time, right_time or time
    li, ri = left_id or ident, right_id or ident

    def tagged(d, t, i, side, other):
        none = F.lit(None).cast(T.StructType([T.StructField(f.name, f.dataType, True) for f in other.schema.fields]))
        own = F.struct(*d.columns)
        return d.select(F.col(key).alias("k"), F.unix_micros(F.col(t).cast("timestamp")).alias("t_us"), F.col(i).alias("i"), F.lit(side).alias("side"),
                        F.struct(F.col(i).alias("i"), F.col(t).cast("timestamp").alias("t"),
                                 (own if side == 0 else none).alias("left"), (own if side == 1 else none).alias("right")).alias("rec"))

    rows = tagged(left, lt, li, 0, right).unionByName(tagged(right, rt, ri, 1, left))
    pairs = pair_scan(rows, ["k"], "rec").where(F.col("closer"))
    first = lambda f: F.when(F.col("side") == 0, F.col(f"rec.{f}")).otherwise(F.col(f"prev.{f}"))
    second = lambda f: F.when(F.col("side") == 1, F.col(f"rec.{f}")).otherwise(F.col(f"prev.{f}"))
    return pairs.select(F.col("k").alias(key), first("i").alias("left_id"), second("i").alias("right_id"),
                        first("t").alias("left_time"), second("t").alias("right_time"),
                        first("left").alias("left"), second("right").alias("right"))


def unmatched(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Keys present on one side only, tagged with the side that has them.

    One tagged union grouped by key: a single shuffle, with map-side partial
    aggregation collapsing repeated keys (instead of two distincts and two
    anti joins).
    """
    rk = right_key or key
    tagged = (left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r"))
              .unionByName(right.select(F.col(rk).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))))
    # A null key never matches the other side: keep the two sides' nulls apart.
    null_side = F.when(F.col("k").isNull(), F.col("l"))
    sides = tagged.groupBy("k", null_side.alias("_ns")).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return (sides.where(F.col("l") != F.col("r"))
                 .select(F.col("k").alias(key), F.when(F.col("l") == 1, "left").otherwise("right").alias("side")))
