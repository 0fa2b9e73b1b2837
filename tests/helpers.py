"""Builders of small event tables."""

from __future__ import annotations

from tripmill.functions.events import event_time
from tripmill.schemas import BRONZE

EVENT_DDL = (
    "event_id string, ride_id string, event_type string, ts string, rider_id string, "
    "driver_id string, fare_cents bigint, distance_meters double, pickup_lat double, "
    "pickup_lon double, dropoff_lat double, dropoff_lon double, cancel_reason string"
)


def bronze_rows(spark, *rows: dict):
    names = BRONZE.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], BRONZE)


def events(spark, *rows: tuple):
    """Typed events from (ride, type, minute[, extra fields]); ids number the rows."""
    data = []
    for i, (ride, kind, minute, *more) in enumerate(rows):
        extra = more[0] if more else {}
        base = {
            "event_id": f"e{i:04d}", "ride_id": ride, "event_type": kind,
            "ts": f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00",
            "rider_id": "p1" if kind == "ride_requested" else None,
            "driver_id": "d1" if kind == "ride_accepted" else None,
            "pickup_lat": 1.0, "pickup_lon": 1.0, "dropoff_lat": 2.0, "dropoff_lon": 2.0,
        } | extra
        names = [f.split()[0] for f in EVENT_DDL.split(", ")]
        data.append(tuple(base.get(n) for n in names))
    df = spark.createDataFrame(data, EVENT_DDL)
    return df.withColumn("event_timestamp", event_time(df.ts)).drop("ts")
