"""Driver tables (parquet) and the role map that turns them into the
reference's record streams.

The reference reads taxi rides/fares and car telemetry that are not shipped;
the driver supplies TPC-H-like tables instead.  Roles on ``events``:

* key ``user_id`` = car / driver / word key, ``ts`` = event time,
  ``value`` = tip / speed / throttle, ``event_type = 'error'`` = a stop;
* arrival time ``arr = ts + ((event_id * 37) % 90) minutes`` (out-of-order
  arrival derived deterministically from the table);
* a start coordinate derived from ``event_id`` (float, like the reference).

Only the columns a query needs are selected, so the parquet scan prunes the
rest (``ReadSchema`` in the plan) and filters are pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the role map (shared with the DuckDB oracle).
ARRIVAL_MULT = 37
ARRIVAL_MOD_MINUTES = 90
LON_BASE, LON_MOD, LAT_BASE, LAT_MOD, COORD_STEP = -74.1, 4500, 40.45, 6100, 0.0001
END_LON_MOD, END_LAT_MOD = 3700, 5300


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrival(event_id="event_id", ts="ts"):
    """``ts + ((event_id * 37) % 90) minutes`` (TIMESTAMP_NTZ in, NTZ out)."""
    k = (F.col(event_id) * F.lit(ARRIVAL_MULT)) % F.lit(ARRIVAL_MOD_MINUTES)
    return F.col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), k.cast("int"))


def coord(event_id, base: float, mod: int):
    """float(base + (event_id % mod) * step), computed in double then narrowed."""
    return (F.lit(base) + (F.col(event_id) % F.lit(mod)).cast("double") * F.lit(COORD_STEP)).cast("float")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted by ``key`` and
    return it.  Two tables bucketed the same way on the join key (e.g. rides
    and fares on rideId) join without a shuffle, which pays off when the same
    join runs every day over large tables."""
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
