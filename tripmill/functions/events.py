"""Event identity, time and type expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.schemas import ALLOWED_STEPS, EVENT_RANK, STATUS_OF_EVENT


def present(x: Column) -> Column:
    """Text that is not NULL and not blank."""
    return F.coalesce(F.trim(x) != "", F.lit(False))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def event_time(text: Column) -> Column:
    """ISO or space-separated text to an instant; without an offset it is UTC. Bad text is NULL."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    """ISO-8601 in UTC. The fraction is written only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.unix_micros(ts) % F.lit(1_000_000)
    return F.when(micros == 0, F.concat(whole, F.lit("+00:00"))).otherwise(
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    )


def event_id(ride_id: Column, event_type: Column, iso: Column) -> Column:
    """Deterministic id: the same event always gets the same 32 hex digits."""
    text = F.concat(ride_id, F.lit(":"), event_type, F.lit(":"), iso)
    return F.substring(F.sha2(text, 256), 1, 32)


def lookup(x: Column, table: dict[str, object]) -> Column:
    """A small fixed mapping as a CASE; NULL where there is no entry."""
    pairs = iter(table.items())
    key, value = next(pairs)
    expr = F.when(x == key, F.lit(value))
    for key, value in pairs:
        expr = expr.when(x == key, F.lit(value))
    return expr


def status_of(event_type: Column) -> Column:
    """The status an event moves a ride to; NULL for location updates."""
    return lookup(event_type, STATUS_OF_EVENT)


def order_key(ts: Column, event_type: Column) -> Column:
    """One number that sorts the events of a ride by time and then by lifecycle rank."""
    rank = F.coalesce(lookup(event_type, EVENT_RANK), F.lit(7))
    return F.unix_micros(ts) * F.lit(8) + rank


def ordered_time(order: Column) -> Column:
    """The time that an `order_key` was made of; ranks are 0 to 7."""
    return F.timestamp_micros(F.shiftright(order, 3))


def step_allowed(previous: Column, target: Column) -> Column:
    return F.concat(previous, F.lit(">"), target).isin(*[f"{a}>{b}" for a, b in ALLOWED_STEPS])
