"""From messages to the flat event, and the split into valid rows and rejects."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.events import blank_to_null, event_time, iso_text, lookup, present
from tripmill.functions.geo import in_latitude, in_longitude
from tripmill.schemas import (
    CORRUPT,
    DATA_NUMBERS,
    DATA_TEXT,
    ENVELOPE,
    EVENT_TYPES,
    MESSAGE,
)

REASONS = "reasons"
TRIP_COLUMNS = ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")


def once(parsed: Column) -> Column:
    """A generator of one row, which filters are not pushed through.

    Without it the optimizer copies the parse into every later condition on a parsed field, and each
    row is parsed dozens of times.
    """
    return F.explode(F.array(parsed))


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to message fields. Text that is not JSON keeps its content in the corrupt column."""
    parsed = F.from_json(
        F.col(value).cast("string"),
        MESSAGE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return raw.withColumn("_m", once(parsed)).select(
        *[c for c in raw.columns if c not in MESSAGE.names], "_m.*"
    )


def flatten(events: DataFrame, *, trip_columns: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages to the flat bronze columns; flat fields win over fields nested in `data`.

    Missing amounts become 0 and a missing or zero surge becomes 1. A location falls back to the
    pickup and then to the dropoff, but not where the payload names it with an empty value.
    Numbers that cannot be read are listed in `bad_numbers`, and `bad_data` marks a payload that is no
    JSON object.
    """
    nested = "data" in events.columns
    # One parse to the texts of all fields; NULL where the text is no JSON object.
    step = events
    if nested:
        step = events.withColumn("_d", once(F.from_json("data", "map<string,string>")))

    def text(name: str) -> Column:
        options = [F.col(name)] if name in events.columns else []
        options += [F.col("_d").getField(name)] if nested else []
        return F.coalesce(*options).cast("string") if options else F.lit(None).cast("string")

    step = step.withColumns({f"_t_{name}": text(name) for name in DATA_TEXT + DATA_NUMBERS})
    step = step.withColumns({f"_n_{n}": F.col(f"_t_{n}").try_cast("double") for n in DATA_NUMBERS})

    def number(name: str) -> Column:
        return F.col(f"_n_{name}")

    def place(own: str, pickup: str, dropoff: str) -> Column:
        fallback = F.coalesce(number(pickup), number(dropoff))
        if not nested:
            return F.coalesce(number(own), fallback)
        named = F.coalesce(F.map_contains_key("_d", own), F.lit(False))
        return F.coalesce(number(own), F.when(~named, fallback))

    metres = F.when(
        number("distance_km").isNotNull(), (number("distance_km") * 1000).cast("bigint")
    ).otherwise(number("distance_meters").cast("bigint"))
    surge = number("surge_multiplier")
    bad = [
        F.when(F.col(f"_t_{n}").isNotNull() & F.col(f"_n_{n}").isNull(), F.lit(n))
        for n in DATA_NUMBERS
    ]
    columns = {name: F.col(name) for name in ENVELOPE} | {
        "rider_id": F.coalesce(blank_to_null(F.col("_t_passenger_id")), F.col("_t_rider_id")),
        "driver_id": F.col("_t_driver_id"),
        "latitude": place("latitude", "pickup_lat", "dropoff_lat"),
        "longitude": place("longitude", "pickup_lon", "dropoff_lon"),
        "fare_cents": F.coalesce(number("fare_cents").cast("bigint"), F.lit(0).cast("bigint")),
        "distance_meters": F.coalesce(metres, F.lit(0).cast("bigint")),
        "surge_multiplier": F.when(F.coalesce(surge, F.lit(0.0)) == 0, 1.0).otherwise(surge),
    }
    if trip_columns:
        columns |= {name: number(name) for name in TRIP_COLUMNS}
        columns |= {"cancel_reason": F.col("_t_reason"), "currency": F.col("_t_currency")}
    columns["bad_numbers"] = F.array_compact(F.array(*bad))
    unreadable = present(F.col("data")) & F.col("_d").isNull() if nested else F.lit(False)
    columns["bad_data"] = F.coalesce(unreadable, F.lit(False))
    return step.select(*keep, *[c.alias(name) for name, c in columns.items()])


# How the types of a parsed payload are told apart in a report.
KINDS = {"STRING": "text", "BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "BOOLEAN": "boolean",
         "OBJECT": "object", "ARRAY": "array", "VOID": "null"}


def payload_fields(messages: DataFrame, *keep: str, payload: str = "data") -> DataFrame:
    """A row per field of each payload, with its name and kind. Each payload is parsed once, to a VARIANT.

    Text that is no JSON object has one row with the field NULL and the kind `unreadable`, or `missing` where it is NULL.
    """
    parsed = messages.select(*keep, once(F.try_parse_json(payload)).alias("_v"), F.col(payload).isNull().alias("_none"))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), F.lit(False))
    objects = F.when(is_object, F.col("_v"))
    rows = parsed.lateralJoin(messages.sparkSession.tvf.variant_explode_outer(objects.outer()))
    found = lookup(F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0), KINDS)
    kind = F.when(F.col("_none"), "missing").when(~is_object, "unreadable").otherwise(F.coalesce(found, F.lit("other")))
    return rows.filter(~is_object | F.col("key").isNotNull()).select(*keep, F.col("key").alias("field"), kind.alias("kind"))


def payload_drift(messages: DataFrame, period: str, by: str, *more: str, payload: str = "data") -> DataFrame:
    """Which fields of which kind payloads carry, since which period and until when, and what was new by then.

    A field is `new` if it, or its kind, first came after the first period of its group; `gone` if the last period lacks it.
    """
    by = (by, *more)
    fields = payload_fields(messages, period, *by, payload=payload)
    seen = fields.groupBy(*by, "field", "kind").agg(
        F.count(F.lit(1)).alias("rows"), F.min(period).alias("first_seen"), F.max(period).alias("last_seen")
    )
    # A row per field and kind: the report is small, whatever the log.
    group = Window.partitionBy(*by)
    return seen.select(
        *by, "field", "kind", "rows", "first_seen", "last_seen",
        (F.col("first_seen") > F.min("first_seen").over(group)).alias("is_new"),
        (F.col("last_seen") < F.max("last_seen").over(group)).alias("is_gone"),
    )


def nest(events: DataFrame, keep: tuple[str, ...] = ENVELOPE) -> DataFrame:
    """Fold every column outside the envelope into a JSON `data` text; NULLs are left out."""
    rest = [c for c in events.columns if c not in keep]
    return events.select(*keep, F.to_json(F.struct(*rest)).alias("data"))


def keyed_messages(events: DataFrame, key: str = "ride_id") -> DataFrame:
    """Rows as key and JSON value, so that all events of a ride stay in one topic partition."""
    return events.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def _with_reasons(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add the names of the failed checks; a row that was rejected before keeps its reasons.

    The list is put together only for rows that fail one: no code is generated for that, unlike for the checks.
    """
    fails = {name: F.coalesce(bad, F.lit(True)) for name, bad in checks.items()}
    names = F.array_compact(F.array(*[F.when(fail, F.lit(name)) for name, fail in fails.items()]))
    found = F.when(reduce(or_, fails.values()), names).otherwise(F.array().cast("array<string>"))
    if REASONS in df.columns:
        found = F.when(F.size(REASONS) > 0, F.col(REASONS)).otherwise(found)
    return df.withColumn(REASONS, found)


def check_payload(df: DataFrame) -> DataFrame:
    """Reasons for rejecting a message: not JSON, a required field missing, an unknown type."""
    if CORRUPT in df.columns:
        df = _with_reasons(df, {"malformed": F.col(CORRUPT).isNotNull()})
    checks = {f"missing_{name}": F.col(name).isNull() for name in ENVELOPE}
    unknown = F.col("event_type").isNotNull() & ~F.col("event_type").isin(*EVENT_TYPES)
    return _with_reasons(df, checks | {"unknown_event_type": unknown})


def check_event(df: DataFrame) -> DataFrame:
    """Reasons for rejecting a typed event: blank ids, unknown type, unreadable time or number."""
    checks = {
        "blank_event_id": ~present(F.col("event_id")),
        "blank_ride_id": ~present(F.col("ride_id")),
        "unknown_event_type": ~F.col("event_type").isin(*EVENT_TYPES),
        "bad_timestamp": event_time(F.col("timestamp").cast("string")).isNull(),
    }
    if "bad_numbers" in df.columns:
        checks["bad_number"] = F.size("bad_numbers") > 0
    if "bad_data" in df.columns:
        checks["bad_data"] = F.col("bad_data")
    return _with_reasons(df, checks)


def check_ride(df: DataFrame, *, distinct_ends: bool = True) -> DataFrame:
    """Reasons for rejecting a ride row: passenger, coordinates, distance, fare, equal ends."""
    checks = {"blank_rider": ~present(F.col("rider_id"))}
    for end in ("pickup", "dropoff"):
        checks[f"{end}_latitude"] = ~in_latitude(F.col(f"{end}_lat"))
        checks[f"{end}_longitude"] = ~in_longitude(F.col(f"{end}_lon"))
    checks["negative_distance"] = F.coalesce(F.col("distance_meters") < 0, F.lit(False))
    checks["negative_fare"] = F.coalesce(F.col("fare_cents") < 0, F.lit(False))
    if distinct_ends:
        checks["same_ends"] = F.coalesce(
            (F.col("pickup_lat") == F.col("dropoff_lat"))
            & (F.col("pickup_lon") == F.col("dropoff_lon")),
            F.lit(False),
        )
    return _with_reasons(df, checks)


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(REASONS) > 0)


def dead_letters(checked: DataFrame, at: Column | None = None) -> DataFrame:
    """Rejects as quarantine rows: the payload, why it was rejected, and when (epoch seconds).

    Text that is not JSON is kept in `raw_text`.
    """
    when = F.current_timestamp() if at is None else at
    payload = [
        F.col(c).alias("raw_text") if c == CORRUPT else F.col(c)
        for c in checked.columns
        if c != REASONS
    ]
    return rejected_rows(checked).select(
        *payload,
        F.array_join(REASONS, ";").alias("_error"),
        (F.unix_micros(when) / F.lit(1e6)).alias("_dlq_timestamp"),
    )


def with_date_parts(df: DataFrame, ts: Column, *, hour: bool = True) -> DataFrame:
    """Partition columns of the event time."""
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    return df.withColumns(parts | ({"hour": F.hour(ts)} if hour else {}))


def with_lineage(files: DataFrame) -> DataFrame:
    """The file a row was read from and the time it was loaded; file sources only."""
    return files.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_loaded_at": F.current_timestamp()}
    )


def iso_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Instants to the ISO text that is published and hashed."""
    return df.withColumn(column, iso_text(F.col(column).cast("timestamp")))
