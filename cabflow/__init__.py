"""cabflow: taxi-ride, taxi-fare and connected-car stream analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, window functions and aggregates, so one definition serves a
batch table and (where Spark allows it) a streaming DataFrame.  Per-key
state that SQL cannot express lives in ``cabflow.streaming`` as
``transformWithState`` processors.

Sub-packages:

* ``sources``   – line sources (text/gzip/socket/kafka/memory) and driver tables
* ``functions`` – column-level helpers (parsing, geo grid, tokenizer, labels)
* ``operators`` – DataFrame operators (ingest, rides, windows, segments, ...)
* ``streaming`` – stateful processors, sinks and job wiring for readStream
* ``plans``     – the registered queries over the driver tables + DuckDB oracle
"""

from cabflow.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
