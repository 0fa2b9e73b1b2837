"""Declared schemas and fixed vocabularies of the ride event log."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types, statuses and lifecycle steps of a ride.
REQUESTED = "ride_requested"
ACCEPTED = "ride_accepted"
STARTED = "ride_started"
COMPLETED = "ride_completed"
CANCELLED = "ride_cancelled"
GPS = "gps_update"

EVENT_TYPES = (REQUESTED, ACCEPTED, STARTED, COMPLETED, CANCELLED, GPS)

STATUS_OF_EVENT = {
    REQUESTED: "requested",
    ACCEPTED: "accepted",
    STARTED: "in_progress",
    COMPLETED: "completed",
    CANCELLED: "cancelled",
}
ACTIVE_STATUSES = ("requested", "accepted", "in_progress")
TERMINAL_STATUSES = ("completed", "cancelled")

ALLOWED_STEPS = (
    ("requested", "accepted"),
    ("requested", "cancelled"),
    ("accepted", "in_progress"),
    ("accepted", "cancelled"),
    ("in_progress", "completed"),
    ("in_progress", "cancelled"),
)

# Order in which events of one ride that carry the same timestamp are read.
EVENT_RANK = {REQUESTED: 0, ACCEPTED: 1, STARTED: 2, GPS: 3, COMPLETED: 4, CANCELLED: 5}

# Fields every payload must carry; the rest of a payload is event data.
ENVELOPE = ("event_id", "ride_id", "event_type", "timestamp")

CORRUPT = "_corrupt_record"

# Bronze: the flat event as it is published. The timestamp stays text.
BRONZE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("ride_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("rider_id", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("fare_cents", T.LongType()),
        T.StructField("distance_meters", T.LongType()),
        T.StructField("surge_multiplier", T.DoubleType()),
    ]
)

# Fields that appear in the payload of one event or another, by the type they are read as.
DATA_TEXT = ("passenger_id", "rider_id", "driver_id", "reason", "currency")
DATA_NUMBERS = (
    "latitude", "longitude", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
    "fare_cents", "distance_km", "distance_meters", "surge_multiplier", "duration_seconds",
)

# Numbers are read as text first, so one bad number does not void the whole message.
EVENT_DATA = T.StructType(
    [T.StructField(name, T.StringType()) for name in DATA_TEXT + DATA_NUMBERS]
)

# A message as it arrives: flat fields, a nested data text, or both.
MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ENVELOPE + ("data",)]
    + list(EVENT_DATA.fields)
    + [T.StructField(CORRUPT, T.StringType())]
)

# Driver status and location events: declared and checked, no consumer.
DRIVER_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

SILVER_COLUMNS = (
    "event_id", "ride_id", "event_type", "event_timestamp", "rider_id", "driver_id",
    "latitude", "longitude", "fare_cents", "distance_meters", "distance_km", "fare_usd",
)
