"""Audits of fares, distances and event ids, and surge from demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.events import event_id, iso_text
from tripmill.functions.fares import (
    estimated_fare,
    minimum_fare,
    service_fare,
    surge_for_demand,
    surge_in_range,
)
from tripmill.functions.geo import grid_cell, haversine_km
from tripmill.functions.numeric import from_hundredths, hundredths, km
from tripmill.schemas import REQUESTED

TOLERANCE = 0.05
RULES = {"service": service_fare, "minimum": minimum_fare}


def straight_km() -> Column:
    return haversine_km(
        F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"), F.col("dropoff_lon")
    )


def audit_fares(trips: DataFrame, rule: str = "service") -> DataFrame:
    """Charged against recomputed fare per trip. A surge out of range has no service fare."""
    expected = RULES[rule](km(F.col("distance_meters")), F.col("surge_multiplier"))
    verdict = (
        F.when(F.col("expected_cents").isNull() & ~surge_in_range(F.col("surge_multiplier")), "invalid_surge")
        .when(F.col("expected_cents").isNull(), "not_priced")
        .when(F.col("fare_cents") < F.col("expected_cents"), "under")
        .when(F.col("fare_cents") > F.col("expected_cents"), "over")
        .otherwise("match")
    )
    return (
        trips.withColumn("expected_cents", expected)
        .withColumn("difference_cents", F.col("fare_cents") - F.col("expected_cents"))
        .withColumn("verdict", verdict)
    )


def fare_audit_by_driver_day(audited: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return audited.groupBy("driver_id", F.to_date(ts).alias("ride_date")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare_cents").alias("charged_cents"),
        F.sum("expected_cents").alias("expected_cents"),
        F.sum("difference_cents").alias("difference_cents"),
        *[
            F.count_if(F.col("verdict") == v).alias(f"n_{v}")
            for v in ("match", "over", "under", "invalid_surge")
        ],
    )


def estimate_error(trips: DataFrame) -> DataFrame:
    """Quoted fare from the straight-line distance against the fare charged."""
    return trips.withColumn("estimated_cents", estimated_fare(straight_km())).withColumn(
        "error_cents", F.col("fare_cents") - F.col("estimated_cents")
    )


def audit_distances(trips: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Recorded against straight-line distance; flagged when they differ by more than the tolerance."""
    straight = hundredths(straight_km())
    recorded = hundredths(km(F.col("distance_meters")))
    percent = F.lit(round(tolerance * 100))
    off = F.abs(F.col("_rec") - F.col("_line")) * 100 > F.col("_line") * percent
    return (
        trips.withColumns({"_line": straight, "_rec": recorded})
        .withColumns(
            {
                "straight_km": from_hundredths(F.col("_line")),
                "recorded_km": from_hundredths(F.col("_rec")),
                "off_tolerance": off,
            }
        )
        .drop("_line", "_rec")
    )


def distance_by_driver(trips: DataFrame) -> DataFrame:
    """Straight-line kilometres per driver, each trip rounded to two digits first."""
    line = hundredths(straight_km())
    return trips.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("trips"),
        from_hundredths(F.sum(line)).alias("straight_km"),
        from_hundredths(F.max(line)).alias("longest_km"),
    )


def demand_surge(
    events: DataFrame, cells_per_degree: int = 100, window: str = "5 minutes"
) -> DataFrame:
    """Requests per grid cell and time window, and the surge that demand calls for."""
    demand = (
        events.filter(
            (F.col("event_type") == REQUESTED)
            & F.col("latitude").isNotNull()
            & F.col("longitude").isNotNull()
        )
        .groupBy(
            grid_cell(F.col("latitude"), F.col("longitude"), cells_per_degree).alias("cell"),
            F.window("event_timestamp", window).alias("w"),
        )
        .agg(F.count(F.lit(1)).alias("demand"))
    )
    return demand.select(
        "cell",
        F.col("w.start").alias("window_start"),
        "demand",
        surge_for_demand(F.col("demand")).alias("surge_multiplier"),
    )


def check_event_ids(events: DataFrame) -> DataFrame:
    """Events whose id is not the one their content gives."""
    expected = event_id(F.col("ride_id"), F.col("event_type"), iso_text(F.col("event_timestamp")))
    return events.withColumn("expected_id", expected).filter(
        ~F.col("event_id").eqNullSafe(F.col("expected_id"))
    )


