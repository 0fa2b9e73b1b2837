"""Rollups of completed rides. Money and distance are summed as whole numbers and rounded once.

`unique_rides` says that the input has one row per ride, as silver has after deduplication by ride
and type; a plain count then replaces the distinct count and saves a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numeric import (
    from_hundredths,
    hundredths,
    mean,
    round_to,
    usd,
)
from tripmill.schemas import COMPLETED


def completed(silver: DataFrame, *needed: str) -> DataFrame:
    """Completed rides whose needed columns are filled."""
    rows = silver.filter(F.col("event_type") == COMPLETED)
    for name in needed:
        rows = rows.filter(F.col(name).isNotNull())
    return rows.withColumn("km100", hundredths(F.col("distance_km")))


def _ride_count(unique_rides: bool) -> Column:
    return F.count(F.lit(1)) if unique_rides else F.countDistinct("ride_id")


def _mean_fare_usd() -> Column:
    return mean(F.sum("fare_cents"), F.count("fare_cents"), 2)


def _mean_km() -> Column:
    return mean(F.sum("km100"), F.count("km100"), 2)


def hourly_metrics(silver: DataFrame) -> DataFrame:
    """Completed rides per hour; the window columns are the first and last event of the hour."""
    return (
        completed(silver, "fare_cents")
        .groupBy(F.date_trunc("hour", "event_timestamp").alias("metric_hour"))
        .agg(
            F.count(F.lit(1)).alias("rides_completed_count"),
            mean(F.sum("fare_cents"), F.count("fare_cents")).alias("avg_fare_cents"),
            _mean_km().alias("avg_distance_km"),
            usd(F.sum("fare_cents")).alias("total_revenue_usd"),
            F.min("event_timestamp").alias("window_start"),
            F.max("event_timestamp").alias("window_end"),
        )
    )


def driver_metrics(silver: DataFrame, *, unique_rides: bool = False) -> DataFrame:
    return (
        completed(silver, "driver_id")
        .groupBy("driver_id")
        .agg(
            _ride_count(unique_rides).alias("rides_completed"),
            usd(F.sum("fare_cents")).alias("total_earnings_usd"),
            _mean_fare_usd().alias("avg_fare_usd"),
            from_hundredths(F.sum("km100")).alias("total_distance_km"),
            _mean_km().alias("avg_distance_km"),
            F.min("event_timestamp").alias("first_ride_at"),
            F.max("event_timestamp").alias("last_ride_at"),
        )
    )


_PASSENGER_COLUMNS = (
    "passenger_id", "rides_taken", "total_spent_usd", "avg_fare_usd", "avg_distance_km",
    "active_days", "is_repeat_rider", "rides_per_active_day", "first_ride_at", "last_ride_at",
)


def _repeat_columns(stats: DataFrame) -> dict[str, Column]:
    rides, days = F.col("rides_taken"), F.nullif(F.col("active_days"), F.lit(0))
    return {
        "is_repeat_rider": F.when(rides > 1, True).otherwise(False),
        "rides_per_active_day": round_to(rides.cast("double") / days.cast("double"), 2),
    }


def _passenger_stats(silver: DataFrame, unique_rides: bool) -> DataFrame:
    rides = (
        completed(silver, "rider_id")
        .withColumnRenamed("rider_id", "passenger_id")
        .withColumn("ride_date", F.to_date("event_timestamp"))
    )
    if unique_rides:
        # Two levels, passenger and day first, need no distinct aggregate at all.
        days = rides.groupBy("passenger_id", "ride_date").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("fare_cents").alias("fare"),
            F.count("fare_cents").alias("n_fare"),
            F.sum("km100").alias("km100"),
            F.count("km100").alias("n_km"),
            F.min("event_timestamp").alias("first_at"),
            F.max("event_timestamp").alias("last_at"),
        )
        return days.groupBy("passenger_id").agg(
            F.sum("n").alias("rides_taken"),
            usd(F.sum("fare")).alias("total_spent_usd"),
            mean(F.sum("fare"), F.sum("n_fare"), 2).alias("avg_fare_usd"),
            mean(F.sum("km100"), F.sum("n_km"), 2).alias("avg_distance_km"),
            F.count("ride_date").alias("active_days"),
            F.min("first_at").alias("first_ride_at"),
            F.max("last_at").alias("last_ride_at"),
        )
    return rides.groupBy("passenger_id").agg(
        F.countDistinct("ride_id").alias("rides_taken"),
        usd(F.sum("fare_cents")).alias("total_spent_usd"),
        _mean_fare_usd().alias("avg_fare_usd"),
        _mean_km().alias("avg_distance_km"),
        F.countDistinct("ride_date").alias("active_days"),
        F.min("event_timestamp").alias("first_ride_at"),
        F.max("event_timestamp").alias("last_ride_at"),
    )


def passenger_metrics(silver: DataFrame, *, unique_rides: bool = False) -> DataFrame:
    stats = _passenger_stats(silver, unique_rides)
    return stats.withColumns(_repeat_columns(stats)).select(*_PASSENGER_COLUMNS)


def passenger_metrics_joined(silver: DataFrame, *, unique_rides: bool = False) -> DataFrame:
    """The same table as a join of statistics with repeat flags, one row per passenger on each side."""
    stats = _passenger_stats(silver, unique_rides)
    flags = stats.select("passenger_id", *[c.alias(n) for n, c in _repeat_columns(stats).items()])
    return stats.join(flags, "passenger_id").select(*_PASSENGER_COLUMNS)


def rides_summary(silver: DataFrame, *, unique_rides: bool = False) -> DataFrame:
    """Completed rides per day, driver and passenger; a missing id forms a group of its own."""
    return (
        completed(silver)
        .groupBy(
            F.to_date("event_timestamp").alias("ride_date"),
            "driver_id",
            F.col("rider_id").alias("passenger_id"),
        )
        .agg(
            _ride_count(unique_rides).alias("rides_completed"),
            mean(F.sum("fare_cents"), F.count("fare_cents")).alias("avg_fare_cents"),
            _mean_fare_usd().alias("avg_fare_usd"),
            from_hundredths(F.sum("km100")).alias("total_distance_km"),
            _mean_km().alias("avg_distance_km"),
            F.sum("fare_cents").alias("total_revenue_cents"),
        )
    )


def recent_days(df: DataFrame, date: str, as_of: Column | str, days: int) -> DataFrame:
    day = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return df.filter(F.col(date) >= F.date_sub(day, days))


def recent_summary(summary: DataFrame, as_of: Column | str, days: int, limit: int = 50) -> DataFrame:
    """The latest rows of the daily summary, in a total order."""
    order = [F.col("ride_date").desc(), F.col("driver_id").asc_nulls_last(),
             F.col("passenger_id").asc_nulls_last()]
    return recent_days(summary, "ride_date", as_of, days).orderBy(*order).limit(limit)


def counts_by_type(events: DataFrame, amount: str = "fare_cents") -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(amount).alias("total_cents")
    )


def revenue_totals(silver: DataFrame) -> DataFrame:
    return completed(silver).agg(
        F.countDistinct("ride_id").alias("rides"), F.sum("fare_cents").alias("total_cents")
    )


def batch_metrics(rows: DataFrame) -> DataFrame:
    """One row over all given completed events: missing amounts count as 0, missing surge as 1."""
    n = F.count(F.lit(1))
    fare = F.coalesce(F.col("fare_cents").cast("double"), F.lit(0.0))
    km_ = F.coalesce(F.col("distance_km").cast("double"), F.lit(0.0))
    surge = F.coalesce(F.col("surge_multiplier").cast("double"), F.lit(1.0))
    zero = F.lit(0.0)
    return rows.agg(
        n.alias("rides_completed_count"),
        F.coalesce(F.avg(fare), zero).alias("avg_fare_cents"),
        F.coalesce(F.avg(km_), zero).alias("avg_distance_km"),
        F.coalesce(F.max(surge), zero).alias("max_surge_multiplier"),
    )


def _daily_totals(rides: DataFrame, who: str) -> DataFrame:
    surge100 = hundredths(F.col("surge_multiplier"))
    return (
        rides.filter((F.col("event_type") == COMPLETED) & F.col(who).isNotNull())
        .groupBy(who, F.to_date("event_timestamp").alias("metric_date"))
        .agg(
            F.count(F.lit(1)).alias("total_rides"),
            F.sum("distance_meters").cast("bigint").alias("total_distance_meters"),
            F.sum("fare_cents").alias("total_fare_cents"),
            mean(F.sum(surge100), F.count(surge100), 2).alias("avg_surge_multiplier"),
        )
    )


def driver_daily_totals(rides: DataFrame) -> DataFrame:
    return _daily_totals(rides, "driver_id")


def passenger_daily_totals(rides: DataFrame) -> DataFrame:
    return _daily_totals(rides, "rider_id")


def leaderboard(daily: DataFrame, who: str) -> DataFrame:
    """Daily totals by fare, highest first."""
    return daily.orderBy(F.col("total_fare_cents").desc(), "metric_date", who)


def pipeline_summary(rides: DataFrame) -> DataFrame:
    surge100 = hundredths(F.col("surge_multiplier"))
    return rides.filter(F.col("event_type") == COMPLETED).agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.sum("fare_cents").alias("total_revenue_cents"),
        usd(F.sum("fare_cents")).alias("total_revenue_dollars"),
        F.sum("distance_meters").cast("bigint").alias("total_distance_meters"),
        (F.sum("distance_meters") / F.lit(1000.0)).alias("total_distance_km"),
        mean(F.sum(surge100), F.count(surge100), 2).alias("avg_surge"),
        F.countDistinct("driver_id").alias("unique_drivers"),
    )


def trips_daily(silver: DataFrame) -> DataFrame:
    return (
        completed(silver)
        .groupBy(F.to_date("event_timestamp").alias("trip_date"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("fare_cents").alias("total_fare_cents"),
            _mean_km().alias("avg_distance_km"),
        )
    )


def money_by_currency(rows: DataFrame, amount: str, *keys: str) -> DataFrame:
    """Totals that never add up different currencies: a mixed group has no total and is flagged."""
    per_currency = rows.groupBy(
        *keys, F.coalesce("currency", F.lit("USD")).alias("currency")
    ).agg(F.sum(amount).alias("cents"))
    return per_currency.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("currencies"),
        F.when(F.count(F.lit(1)) == 1, F.max("currency")).alias("currency"),
        F.when(F.count(F.lit(1)) == 1, F.max("cents")).alias("total_cents"),
        (F.count(F.lit(1)) > 1).alias("mixed"),
    )
