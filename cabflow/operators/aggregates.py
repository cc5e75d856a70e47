"""Keyed aggregates: running (one updated row per input) and final forms.

Running forms go through ``keyed_scan``, so a hot key is spread over many
tasks; final forms are plain hash aggregates with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.operators.scan import Agg, keyed_scan


def keyed_count(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def running_count(df: DataFrame, keys: list[str], order: list[str], out: str = "n") -> DataFrame:
    """Per input row, the number of rows of its key so far (keyBy().sum(1))."""
    return keyed_scan(df, keys, order, [Agg(out, "count")])


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "total") -> DataFrame:
    return keyed_scan(df, keys, order, [Agg(out, "sum", value)])


def running_max(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "max_value") -> DataFrame:
    """Per input row, the maximum of ``value`` of its key so far (keyBy().maxBy())."""
    return keyed_scan(df, keys, order, [Agg(out, "max", value)])


def running_max_by(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "best") -> DataFrame:
    """Per input row, the whole row that holds the maximum of its key so far
    (the earliest of equal ones), as a struct of the input's columns."""
    rows = keyed_scan(df, keys, order, [Agg("_max_before", "max", value, inclusive=False), Agg("_max_n", "count")])
    new = F.col("_max_before").isNull() & F.col(value).isNotNull() | (F.col(value) > F.col("_max_before"))
    rows = rows.withColumn("_max_rec", F.when(new, F.struct(F.col("_max_n").alias("n"), F.struct(*df.columns).alias("r"))))
    # Positions grow, so the largest record is the newest maximum.
    rows = keyed_scan(rows, keys, order, [Agg("_max_now", "max", "_max_rec")])
    return rows.select(*df.columns, F.col("_max_now.r").alias(out))


def max_by_key(df: DataFrame, keys: list[str], value: str, ident: str, out: str = "max_value", out_id: str | None = None) -> DataFrame:
    """Final maximum per key and the smallest ``ident`` that holds it.

    Two hash aggregates: the smallest id of every (key, value), then the id of
    the largest value.  A single ``max_by`` over a struct would sort the input.
    """
    least = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(ident).alias("_id"))
    return least.groupBy(*keys).agg(F.max(value).alias(out), F.max_by("_id", value).alias(out_id or ident))


def top_n(df: DataFrame, groups: list[str], order: list, n: int, salt_col: str | None = None,
          buckets: int = 64, out: str = "rank") -> DataFrame:
    """Top ``n`` rows per group by ``order`` (Columns, first = most important),
    with a 1-based ``rank``.

    A group with very many rows is never ranked whole in one task: for ``n``
    up to ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark limits every
    group to ``n`` rows per input partition before the shuffle
    (``WindowGroupLimit``).  Beyond it, rank first inside (group,
    hash(salt) % buckets) sub-groups, keep each one's top n, then rank the at
    most ``buckets * n`` survivors.  Exact either way.
    """
    from pyspark.sql import Window

    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if salt_col and n > limit:
        salt = F.pmod(F.hash(F.col(salt_col)), F.lit(buckets))
        df = (df.withColumn("_salt", salt)
                .withColumn("_r1", F.row_number().over(Window.partitionBy(*groups, "_salt").orderBy(*order)))
                .where(F.col("_r1") <= n).drop("_r1", "_salt"))
    return (df.withColumn(out, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
              .where(F.col(out) <= n))
