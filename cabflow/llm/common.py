"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import prepare
from cabflow.sources.tables import table

__all__ = ["prepare", "table", "stored", "discard", "shared_folder", "require", "small_batches", "blocked", "dealt", "frugal"]


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``."""
    return f"{prepare(spark).rstrip('/')}/cabflow-llm/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    recomputing ``df``, and is not recomputed when read more than once.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read again (what was made
    from them is written itself)."""
    for df in tables:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/cabflow-llm/" in name:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def require(df: DataFrame, **columns: str) -> None:
    """Raise ValueError if a column the caller named is missing."""
    missing = [c for c in columns.values() if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")


def small_batches(texts, most_chars: int = 4_000_000):
    """Slices of a list of texts with about ``most_chars`` characters each
    (a longer text makes a slice of its own), so that array work on a slice
    stays small whatever Arrow's batch size."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size + n > most_chars and i > start:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def blocked(df: DataFrame, keys: list[str], row: str, rows_per_block: int) -> DataFrame:
    """Deal the rows of every group over cells of bounded size.

    A group of n rows is cut into b = ceil(n / rows_per_block) blocks by a
    hash of ``row``; each unordered pair of blocks (i <= j) is one cell, and a
    row goes to the b cells that hold its block.  Two rows of a group meet in
    exactly one cell, no cell holds more than about two blocks, and a hot
    group is spread over b * (b + 1) / 2 tasks.  Groups of one row are left
    out.  Adds ``block``, ``cell_i`` and ``cell_j``.
    """
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    blocks = F.ceil(F.col("__n") / F.lit(rows_per_block)).cast("int")
    d = df.join(counts, keys).withColumn("__b", blocks)
    d = d.withColumn("block", F.pmod(F.xxhash64(F.col(row)), F.col("__b")).cast("int"))
    d = d.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__b") - 1)))
    return (d.withColumn("cell_i", F.least("block", "__o")).withColumn("cell_j", F.greatest("block", "__o"))
             .drop("__n", "__b", "__o"))


def frugal(run):
    """A ``mapInArrow`` function whose task gives its free memory back when it
    ends: Spark keeps Python workers for later stages, and what the allocators hold
    of an earlier one would count against them."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def release() -> None:
    """Return unused memory of this Python worker to the system, where it can be."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def dealt(df: DataFrame, keys: list[str], row: str, rows_per_block: int) -> DataFrame:
    """``blocked`` for narrow rows of groups that all have several: only groups
    above ``rows_per_block`` are looked up, so that no row moves by its group's key
    before a hot group is cut (their table is written first: where it is small,
    Spark broadcasts it)."""
    hot = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_block))
    sides = F.coalesce(F.ceil(F.col("__n") / F.lit(rows_per_block)), F.lit(1)).cast("int")
    d = df.join(hot, keys, "left").withColumn("__b", sides)
    d = d.withColumn("block", F.pmod(F.xxhash64(F.col(row)), F.col("__b")).cast("int"))
    d = d.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__b") - 1)))
    return (d.withColumn("cell_i", F.least("block", "__o")).withColumn("cell_j", F.greatest("block", "__o"))
             .drop("__n", "__b", "__o"))


def map_groups(df: DataFrame, keys: list[str], fn, schema: str, then: list[str] | None = None) -> DataFrame:
    """Call ``fn(table)`` with the rows of each group as one pyarrow table
    (sorted by ``then``) and return the record batches it yields.

    For very many small groups: rows are hashed and sorted by ``keys`` and
    streamed, so a group costs one slice instead of a Python call with its own
    pandas frame.  Groups must be bounded by the caller (see ``blocked``).
    """
    spark = df.sparkSession
    prepare(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns

    def run(batches):
        import numpy as np
        import pyarrow as pa
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            if not t.num_rows:
                continue
            change = np.zeros(t.num_rows, bool)
            for k in keys:
                c = t.column(k).combine_chunks().to_numpy(zero_copy_only=False)
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.nonzero(change)[0].tolist()]
            for a, b in zip(starts, starts[1:]):
                yield from fn(t.slice(a, b - a))
            rest = t.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield from fn(rest)

    return df.repartition(n, *keys).sortWithinPartitions(*keys, *(then or [])).select(*names).mapInArrow(run, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: id and ``component`` (smallest id).

    Each round a node takes the least label among its neighbours, hands it to
    the node its own label names, and then takes the label of its label, so
    even a long path settles in a number of rounds near its logarithm.  Every
    round is written to the shared folder; one number per round reaches the
    driver.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    e = stored(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = stored(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("component")))
    for _ in range(most_rounds):
        near = (e.join(labels.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near")))
        seen = stored(labels.join(near, "id"))
        discard(labels)
        given = seen.groupBy(F.col("component").alias("id")).agg(F.min("near").alias("given"))
        step = stored(seen.join(given, "id", "left").select("id", F.col("component").alias("old"), F.least("component", "near", "given").alias("component")))
        up = step.select(F.col("id").alias("component"), F.col("component").alias("above"))
        new = stored(step.join(up, "component").select("id", "old", F.least("component", "above").alias("component")))
        discard(seen, step)
        changed = new.where("component < old").limit(1).count()
        labels = new.drop("old")
        if not changed:
            discard(e)
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
