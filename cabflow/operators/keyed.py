"""Batch forms of the reference's keyed-state demos (value, list, map,
reducing and aggregating state).  The streaming twins are processors in
``cabflow.streaming.processors``.

* ``count_average``  – average of every ``n`` values per key, then reset;
* ``running_sum``    – reducing state: running sum per key;
* ``running_concat`` – aggregating state: ``contains:a and b and ...``;
* ``idle_count``     – count per key until ``gap`` of silence (timer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.operators.aggregates import running_sum as _running_sum
from cabflow.operators.scan import Agg, keyed_scan
from cabflow.operators.windows import count_tumbling, sessions

# Fixed text of the aggregating-state demo.
CONTAINS_PREFIX = "contains:"
CONTAINS_SEP = " and "


def count_average(df: DataFrame, key: str, order: list[str], value: str, n: int = 3) -> DataFrame:
    """(key, bucket, average) for every complete group of ``n`` values."""
    return count_tumbling(df, [key], order, n, [F.avg(value).alias("average")])


def running_sum(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    return _running_sum(df, [key], order, value, out="running_sum")


def running_increments(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The running concatenation as increments: each row's position in its key
    and the item it adds.  Linear in the input; ``concat_text`` prints it."""
    return keyed_scan(df.withColumn("item", F.col(value).cast("string")), [key], order, [Agg("pos", "count")])


def concat_text(increments: DataFrame, key: str) -> DataFrame:
    """Per row ``contains:`` + all items of the key so far joined by `` and ``.

    The text of row i has i items, so this is quadratic in a key's length by
    nature; use it where keys are known to be short."""
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return increments.withColumn("contains", F.concat(F.lit(CONTAINS_PREFIX), F.array_join(F.collect_list("item").over(w), CONTAINS_SEP)))


def running_concat(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """``running_increments`` printed by ``concat_text``."""
    return concat_text(running_increments(df, key, order, value), key).drop("item", "pos")


def idle_count(df: DataFrame, key: str, arrival: str, tie: str, gap_us: int) -> DataFrame:
    """Count of rows per key until the key has been silent for ``gap``; the
    count is emitted at ``last arrival + gap`` (processing-time timer)."""
    return (sessions(df, [key], arrival, tie, gap_us, [F.count(F.lit(1)).alias("n")])
            .withColumnRenamed("session_end", "emit_at"))
