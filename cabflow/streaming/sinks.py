"""Streaming sinks and record text formats.

* ``to_console`` / ``to_memory`` – print / in-memory table (tests);
* ``to_kafka``   – ``(word,count)`` text values to a topic (connector jar needed);
* ``write_groups`` – the reference's buffering sink: groups of exactly n records,
  buffered across micro-batches and committed by their number;
* ``batched``    – one folder per micro-batch: rows are written in files
  of at most ``threshold`` records.  ``foreachBatch`` gets the micro-batch id,
  and each batch overwrites its own folder, so a replayed batch after a
  failure rewrites the same files (idempotent) and no remainder is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_console(df: DataFrame, checkpoint: str, mode: str = "append", trigger: dict | None = None):
    w = df.writeStream.format("console").outputMode(mode).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append", trigger: dict | None = None):
    w = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()


def kafka_value(word: str = "word", count: str = "n") -> F.Column:
    """Tuple text ``(word,count)`` as the reference's string sink writes it."""
    return F.concat(F.lit("("), F.col(word), F.lit(","), F.col(count).cast("string"), F.lit(")"))


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, value: F.Column | None = None,
             mode: str = "update"):
    out = df.select((value if value is not None else kafka_value()).alias("value"))
    return (out.writeStream.format("kafka").outputMode(mode)
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def write_batched(batch: DataFrame, batch_id: int, path: str, threshold: int | None = None) -> None:
    """Write one micro-batch; ``threshold``, if given, caps the rows of a file."""
    w = batch.write.mode("overwrite")
    w = w.option("maxRecordsPerFile", threshold) if threshold else w
    w.parquet(f"{path.rstrip('/')}/batch={batch_id}")


def batched(df: DataFrame, path: str, checkpoint: str, threshold: int | None = None, trigger: dict | None = None):
    w = (df.writeStream.foreachBatch(lambda b, i: write_batched(b, i, path, threshold))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()


def write_groups(batch: DataFrame, path: str) -> None:
    """Write the groups of a micro-batch (``jobs.record_groups``) under the number
    of the first group each shard gives off in it.  A batch that is run again
    after a failure gives off the same numbers and replaces its own folders: no
    group is lost and none is there twice."""
    first = batch.groupBy(F.col("shard").alias("_s")).agg(F.min("group_no").alias("first_group"))
    rows = batch.join(first, F.col("shard") == F.col("_s")).drop("_s")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard", "first_group").parquet(path.rstrip("/"))


# ------------------------------------------------------------ record formats
# Field order, separators and names of the printed records.
TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def _fields(record: str | None):
    return (lambda name: F.col(name)) if record is None else (lambda name: F.col(record)[name])


def ride_text(record: str | None = None) -> F.Column:
    """Ride CSV as the reference prints it: always start then end time.
    ``record``: a struct column that holds the ride."""
    c = _fields(record)
    return F.concat_ws(",", c("rideId").cast("string"), F.when(c("isStart"), "START").otherwise("END"),
                       F.date_format(c("startTime"), TIME_FMT), F.date_format(c("endTime"), TIME_FMT),
                       *[c(x).cast("string") for x in ("startLon", "startLat", "endLon", "endLat",
                                                        "passengerCnt", "taxiId", "driverId")])


def fare_text(record: str | None = None) -> F.Column:
    c = _fields(record)
    return F.concat_ws(",", c("rideId").cast("string"), c("taxiId").cast("string"), c("driverId").cast("string"),
                       F.date_format(c("startTime"), TIME_FMT), c("paymentType"),
                       *[c(x).cast("string") for x in ("tip", "tolls", "totalFare")])


def enriched_ride_text() -> F.Column:
    return F.concat_ws(",", ride_text(), F.col("startCell").cast("string"), F.col("endCell").cast("string"))


def car_event_text() -> F.Column:
    """``ConnectedCarEvent{id='..', carId='..', timestamp=.., longitude=.., ...}``."""
    c = F.col
    parts = [F.lit("ConnectedCarEvent{id='"), c("id"), F.lit("', carId='"), c("carId"),
             F.lit("', timestamp="), c("timestamp").cast("string")]
    for name in ("longitude", "latitude", "consumption", "speed", "throttle", "engineload"):
        parts += [F.lit(f", {name}="), c(name).cast("string")]
    return F.concat(*parts, F.lit("}"))


def pair_text(ride: str = "ride", fare: str = "fare") -> F.Column:
    """``(<ride csv>,<fare csv>)`` for a struct<ride, fare> pair row."""
    return F.concat(F.lit("("), ride_text(ride), F.lit(","), fare_text(fare), F.lit(")"))
