"""Bronze to silver: types, required keys, first occurrence, derived units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.events import event_time
from tripmill.functions.numeric import km, usd

RIDE_EVENT_KEY = ("ride_id", "event_type")
RIDE_EVENT_TIME_KEY = ("ride_id", "event_type", "event_timestamp")


def type_events(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed events that have their keys. Values that cannot be read become NULL."""
    source = F.col("timestamp")
    is_text = dict(bronze.dtypes)["timestamp"] == "string"
    return bronze.filter(F.col("event_id").isNotNull() & F.col("ride_id").isNotNull()).select(
        "event_id",
        "ride_id",
        F.lower("event_type").alias("event_type"),
        (event_time(source) if is_text else source.cast("timestamp")).alias("event_timestamp"),
        "rider_id",
        "driver_id",
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("fare_cents").try_cast("bigint").alias("fare_cents"),
        F.col("distance_meters").try_cast("double").alias("distance_meters"),
        *keep,
    )


def first_occurrence(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order, which must be total.

    The rank filter is applied on each partition before the shuffle, so a key that holds much of
    the table sends at most one row per partition.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_occurrence_by_min(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same rows from an aggregate: the smallest struct that starts with the order columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys]
    first = F.min(F.struct(*ordered, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def derive_units(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"distance_km": km(F.col("distance_meters")), "fare_usd": usd(F.col("fare_cents"))}
    )


def to_silver(
    bronze: DataFrame, key: Sequence[str] = RIDE_EVENT_KEY, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed events without redeliveries: the earliest per key, ties broken by event id."""
    typed = type_events(bronze, keep)
    return derive_units(first_occurrence(typed, key, ["event_timestamp", "event_id"]))


def stamp_loaded(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp())
