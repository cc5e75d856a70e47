"""Session construction and cluster-level settings.

The library never hard-codes a cluster layout.  ``get_session`` only fills
in settings that are *unset*, so a cluster submit (``spark-submit --conf``)
always wins.  Event time is UTC everywhere, matching the reference's
UTC-only parsers.
"""

from __future__ import annotations

import os
import re
import shlex
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins/aggregates at runtime
# (coalescing small shuffle partitions, splitting skewed join partitions);
# the auto-broadcast threshold stays at Spark's default size guard.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Scan checkpoints are intermediate: delete them once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Most bytes of an Arrow batch that goes to a Python worker.
ARROW_BYTES = "4m"


def submitted() -> dict[str, str]:
    """Settings the user gave before the session exists: those of the submit
    command and of spark-defaults.conf."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit: its JVM is there and knows
        SparkContext._ensure_initialized()
        return dict(SparkConf().getAll())
    out = {}
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(home, "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults) as f:
            out |= dict(m.groups() for m in re.finditer(r"^[ \t]*(spark\S*?)(?:[ \t]*=[ \t]*|[ \t]+)(\S.*?)[ \t]*$", f.read(), re.M))
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    return out | dict(v.split("=", 1) for k, v in zip(args, args[1:]) if k in ("--conf", "-c") and "=" in v)


def get_session(master: str | None = None, app: str = "cabflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    wanted = DEFAULTS | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {})
    given = submitted()
    conf = {k: v for k, v in wanted.items() if k not in given} | (extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # no SparkContext handle (e.g. a remote session)
        pass
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; a local run without one gets
    a fresh scratch folder.  On a cluster there is no fallback: executors would
    each write to a disk of their own."""
    d = checkpoint_dir(spark)
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cabflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # remote sessions read spark.checkpoint.dir themselves
        pass
    return d


def is_local(spark: SparkSession) -> bool:
    """Do driver and executors share one machine and process?"""
    master = spark.conf.get("spark.master", "")
    return master.startswith("local") and not master.startswith("local-cluster")


def local_test_session(cores: int = 8) -> SparkSession:
    """Session used by tests and bench: local mode, few shuffle partitions."""
    return get_session(
        master=f"local[{cores}]",
        shuffle_partitions=cores,
        extra={"spark.driver.memory": os.environ.get("CABFLOW_DRIVER_MEM", "8g"),
               "spark.sql.adaptive.coalescePartitions.enabled": "true"},
    )


def spread(df, factor: int = 2):
    """Round-robin a DataFrame over the cluster's cores when it arrives in
    fewer partitions than there are cores (a few large files or row groups
    before CPU-heavy per-row work).  At scale the input already has far more
    splits than cores, so this adds no shuffle there."""
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= cores:
            return df
    except Exception:  # no RDD view (remote session): leave the layout to Spark
        return df
    return df.repartition(cores * factor)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cabflow`` importable by Python workers (what ``--py-files``
    does): zip the package once per application and ``addPyFile`` it.
    Operators that run pandas code on executors call this, so the library
    works wherever the driver imported it from."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # remote session: the package must be installed on the cluster
        return
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="cabflow-pkg-"), "cabflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python workers about ``ARROW_BYTES`` at once, unless the session
    says otherwise: by number alone (10,000) long texts fill workers and JVM."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, ARROW_BYTES)


def prepare(spark: SparkSession) -> str:
    """Checkpoint folder, size of Arrow batches and package shipped to executors; returns the folder."""
    ship_package(spark)
    bound_batches(spark)
    return ensure_checkpoint_dir(spark)
