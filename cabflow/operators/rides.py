"""Ride cleansing, enrichment and per-cell durations (parse -> filter -> map).

The reference fuses parse+filter+enrich into one flatMap by hand; here the
three steps are separate column expressions and whole-stage codegen fuses
them into one pipeline without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.geo import grid_cell, in_nyc
from cabflow.functions.timecols import whole_minutes
from cabflow.operators.aggregates import max_by_key
from cabflow.operators.ingest import parse_rides


def filter_nyc(rides: DataFrame) -> DataFrame:
    """Keep rides whose start *and* end lie in the NYC box."""
    return rides.where(in_nyc("startLon", "startLat", "endLon", "endLat"))


def enrich(rides: DataFrame) -> DataFrame:
    """Add ``startCell`` / ``endCell`` grid ids (real startLat kept, see SURVEY D1)."""
    return rides.withColumns({"startCell": grid_cell("startLon", "startLat"),
                              "endCell": grid_cell("endLon", "endLat")})


def cleanse(lines: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Parse ride lines, keep NYC rides, add grid cells.  Returns (enriched, bad lines)."""
    good, bad = parse_rides(lines, mode=mode)
    return enrich(filter_nyc(good)), bad


def durations(enriched: DataFrame) -> DataFrame:
    """END events only: (startCell, whole minutes end - start, driverId, rideId).

    A ride that ends before it starts is invalid (the interval cannot be
    built) and is left out here; ``invalid_durations`` returns those rows.
    """
    return (enriched.where(~F.col("isStart") & (F.col("endTime") >= F.col("startTime")))
            .select("startCell", whole_minutes("startTime", "endTime").alias("minutes"),
                    "driverId", "rideId"))


def invalid_durations(enriched: DataFrame) -> DataFrame:
    """END events whose end time precedes their start time (quarantine)."""
    return enriched.where(~F.col("isStart") & (F.col("endTime") < F.col("startTime")))


def longest_per_cell(durs: DataFrame, key: str = "startCell") -> DataFrame:
    """Longest ride per cell and the driver of it (smallest driver id on ties):
    two hash aggregates, each combined per input partition before its shuffle."""
    return max_by_key(durs, [key], "minutes", "driverId", "max_minutes")


def ride_counts(rides: DataFrame) -> DataFrame:
    """Rides per driver (final value of the reference's running count)."""
    return rides.groupBy("driverId").agg(F.count(F.lit(1)).alias("rides"))
