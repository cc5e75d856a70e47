"""Line sources.  Every source yields a string column ``line`` and ``seq``, the
arrival order that keyed state, lateness and count windows work in: text that
sorts by file, place of the split in the file and row for files, by partition and
offset for Kafka, by receive time and row for a socket.

* files (plain or ``.gz``): ``spark.read.text`` / ``readStream.text``.  Gzip is
  not splittable, so one file is one task; ``repartition`` spreads the lines
  before the (CPU-bound) parsing.  Many input files parallelise naturally.
* socket / kafka: ``readStream`` with the same ``line`` contract.  The Kafka
  connector jar is not bundled here; the call builds the reader and Spark
  reports the missing package when the query starts.
* in-memory rows: ``createDataFrame`` (tests and fixtures).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None,
               repartition: int | None = None) -> DataFrame:
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path)
    else:
        df = spark.read.text(path)
    df = df.select(F.col("value").alias("line"), _place().alias("place"))
    df = _numbered(df) if streaming else df.select("line", F.concat_ws("/", "place", _digits(F.monotonically_increasing_id())).alias("seq"))
    return df.repartition(repartition) if repartition else df


def _numbered(df: DataFrame) -> DataFrame:
    """``seq`` = ``place`` and the row's number in its task: a stream may not
    use monotonically_increasing_id, so Arrow batches are counted."""

    def run(batches):
        import pyarrow as pa
        n = 0
        for b in batches:
            numbers = [f"{place}/{n + i:019d}" for i, place in enumerate(b.column(1).to_pylist())]
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(numbers, pa.string())], names=["line", "seq"])

    return df.select("line", "place").mapInArrow(run, "line string, seq string")


def _digits(c) -> Column:
    return F.lpad(c.cast("string"), 19, "0")


def _place() -> Column:
    """File and start of the split a row comes from.  With the row's number in
    its task this is the order of the lines: Spark packs splits into tasks by
    size, so the number alone is not."""
    return F.concat_ws("/", F.col("_metadata.file_path"), _digits(F.col("_metadata.file_block_start")))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    rows = spark.readStream.format("socket").option("host", host).option("port", port).option("includeTimestamp", "true").load()
    return _numbered(rows.select(F.col("value").alias("line"), _digits(F.unix_micros("timestamp")).alias("place")))


def kafka_lines(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("subscribe", topic))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("line"),
                           F.col("timestamp").alias("arrival_ts"),
                           F.concat_ws("/", F.col("topic"), _digits(F.col("partition")), _digits(F.col("offset"))).alias("seq"))


def from_rows(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(s, f"{i:019d}") for i, s in enumerate(lines)], "line string, seq string")
