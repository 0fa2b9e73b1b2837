"""The event history of rides, read from the event store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.events import order_key
from tripmill.operators.ingest import nest
from tripmill.operators.state import find, find_many



def event_history(events: DataFrame, *, ride_id: str | None = None, rides: DataFrame | None = None) -> DataFrame:
    """Events of one ride, of the rides in a table, or of all, with the payload nested again.

    Sorted by ride, time, lifecycle rank and id, not by arrival.
    """
    if ride_id is not None:
        events = find(events, "ride_id", ride_id)
    if rides is not None:
        events = find_many(events, "ride_id", rides)
    when = F.col("timestamp").try_cast("timestamp")
    return nest(events.drop("_error", "_dlq_timestamp")).orderBy(
        "ride_id", order_key(when, F.col("event_type")), "event_id"
    )
