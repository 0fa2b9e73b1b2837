"""Fare and surge rules as column expressions. All amounts are in cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the fare rules.
BASE_CENTS = 250
PER_KM_CENTS = 150
MIN_FARE_CENTS = 500
SURGE_RANGE = (1.0, 5.0)
SURGE_TIERS = ((5, 1.0), (10, 1.25), (15, 1.5), (20, 2.0))
SURGE_TOP = 3.0


def surge_in_range(surge: Column) -> Column:
    return surge.between(*SURGE_RANGE)


def service_fare(
    km: Column, surge: Column, base: int = BASE_CENTS, per_km: int = PER_KM_CENTS
) -> Column:
    """Base plus the distance charge rounded up; NULL when the surge is out of range."""
    charge = F.ceil(km * F.lit(float(per_km)) * surge)
    return F.when(surge_in_range(surge), F.lit(base) + charge)


def minimum_fare(
    km: Column,
    surge: Column,
    base: int = BASE_CENTS,
    per_km: int = PER_KM_CENTS,
    minimum: int = MIN_FARE_CENTS,
) -> Column:
    """The same sum without surge bounds, but never below the minimum fare."""
    charge = F.ceil(km * F.lit(float(per_km)) * surge)
    return F.when(charge.isNotNull(), F.greatest(F.lit(base) + charge, F.lit(minimum).cast("bigint")))


def estimated_fare(km: Column, base: int = BASE_CENTS, per_km: int = PER_KM_CENTS) -> Column:
    """Quote before the trip: straight-line distance and no surge."""
    return F.lit(base) + F.ceil(km * F.lit(float(per_km)))


def surge_for_demand(demand: Column) -> Column:
    tiers = iter(SURGE_TIERS)
    below, surge = next(tiers)
    expr = F.when(demand < below, F.lit(surge))
    for below, surge in tiers:
        expr = expr.when(demand < below, F.lit(surge))
    return expr.otherwise(F.lit(SURGE_TOP))
