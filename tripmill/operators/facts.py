"""Trip, driver-day and platform-day facts, each from one aggregate per ride over silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.keys import surrogate_key
from tripmill.functions.numeric import half_up, km_hundredths, from_hundredths, mean
from tripmill.schemas import CANCELLED, COMPLETED, REQUESTED, STARTED

SLA_SECONDS = 1800


def _of(kind: str, column: str):
    return F.max(F.when(F.col("event_type") == kind, F.col(column)))


def fact_trip(silver: DataFrame) -> DataFrame:
    """One row per completed ride. Without a start event the start and duration are NULL."""
    rides = (
        silver.filter(F.col("event_type").isin(STARTED, COMPLETED))
        .groupBy("ride_id")
        .agg(
            _of(COMPLETED, "rider_id").alias("rider_id"),
            _of(COMPLETED, "driver_id").alias("driver_id"),
            _of(STARTED, "event_timestamp").alias("started_at"),
            _of(COMPLETED, "event_timestamp").alias("completed_at"),
            _of(COMPLETED, "distance_meters").alias("distance_meters"),
            _of(COMPLETED, "fare_cents").alias("fare_cents"),
        )
        .filter(F.col("completed_at").isNotNull())
    )
    seconds = F.unix_seconds("completed_at") - F.unix_seconds("started_at")
    return rides.select(
        surrogate_key(F.col("ride_id")).alias("trip_key"),
        F.col("ride_id").alias("trip_id"),
        "rider_id",
        "driver_id",
        "started_at",
        "completed_at",
        seconds.cast("int").alias("duration_seconds"),
        "distance_meters",
        "fare_cents",
        F.to_date("started_at").alias("trip_date"),
    )


def ride_outcomes(silver: DataFrame) -> DataFrame:
    """One row per ride: who took part, when it was asked for, started and over, and its amounts."""
    driver_side = F.when(F.col("driver_id").isNotNull(), F.col("event_timestamp"))
    return silver.groupBy("ride_id").agg(
        F.max("rider_id").alias("rider_id"),
        F.max("driver_id").alias("driver_id"),
        _of(REQUESTED, "event_timestamp").alias("requested_at"),
        _of(STARTED, "event_timestamp").alias("started_at"),
        _of(COMPLETED, "event_timestamp").alias("completed_at"),
        _of(CANCELLED, "event_timestamp").alias("cancelled_at"),
        _of(COMPLETED, "distance_meters").alias("distance_meters"),
        _of(COMPLETED, "fare_cents").alias("fare_cents"),
        F.min(driver_side).alias("driver_from"),
        F.max(driver_side).alias("driver_to"),
    )


def fact_driver_daily(silver: DataFrame) -> DataFrame:
    """Per driver and day of the ride's end.

    Online hours are the span from the driver's first to last event among the rides of that day.
    """
    ended = F.coalesce("completed_at", "cancelled_at")
    seconds = F.unix_seconds("completed_at") - F.unix_seconds("started_at")
    online = F.unix_seconds(F.max("driver_to")) - F.unix_seconds(F.min("driver_from"))
    daily = (
        ride_outcomes(silver)
        .filter(F.col("driver_id").isNotNull() & ended.isNotNull())
        .groupBy("driver_id", F.to_date(ended).alias("activity_date"))
        .agg(
            F.count("completed_at").alias("trips_completed"),
            F.count(F.when(F.col("completed_at").isNull(), 1)).alias("trips_cancelled"),
            F.coalesce(F.sum("fare_cents"), F.lit(0)).alias("total_earnings_cents"),
            F.coalesce(F.sum("distance_meters"), F.lit(0.0)).alias("total_distance_meters"),
            mean(F.sum(seconds) * 100, F.count(seconds), 2).alias("avg_trip_duration_seconds"),
            from_hundredths(half_up(online.cast("double") / F.lit(36.0))).alias("online_hours"),
        )
    )
    return daily.select(surrogate_key(F.col("driver_id")).alias("driver_key"), *daily.columns)


def platform_daily(silver: DataFrame, sla_seconds: int = SLA_SECONDS) -> DataFrame:
    """Per day of the request: rides, distance, averages, active people, share within the SLA."""
    seconds = F.unix_seconds("completed_at") - F.unix_seconds("started_at")
    km100 = km_hundredths(F.col("distance_meters"))
    rides = ride_outcomes(silver).filter(F.col("requested_at").isNotNull())
    return rides.groupBy(F.to_date("requested_at").alias("date")).agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count("completed_at").alias("completed_rides"),
        F.coalesce(from_hundredths(F.sum(km100)), F.lit(0.0)).alias("total_distance_km"),
        mean(F.sum("fare_cents"), F.count("fare_cents")).alias("avg_fare_cents"),
        mean(F.sum(seconds) * 100, F.count(seconds) * 60, 2).alias("avg_duration_minutes"),
        F.countDistinct("rider_id").alias("active_riders"),
        F.countDistinct("driver_id").alias("active_drivers"),
        mean(F.sum(F.when(seconds <= sla_seconds, 10000).otherwise(0)), F.count(seconds), 2).alias(
            "on_time_pct"
        ),
    )
