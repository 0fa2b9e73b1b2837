import itertools
import json
import re

from pyspark.sql import functions as F

from tripmill.operators import history, ingest
from tripmill.schemas import BRONZE, COMPLETED, REQUESTED


def message(spark, *payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "value string")


def envelope(kind=REQUESTED, **data):
    return {"event_id": "e", "ride_id": "r", "event_type": kind,
            "timestamp": "2024-01-01T00:00:00+00:00", "data": json.dumps(data)}


def flat(spark, rows, *payloads, **options):
    return rows(ingest.flatten(ingest.parse_messages(message(spark, *payloads)), **options))


def test_requested_event_is_flattened(spark, rows):
    (row,) = flat(spark, rows, envelope(passenger_id="p1", pickup_lat=40.7, pickup_lon=-74.0))
    assert row["rider_id"] == "p1" and row["driver_id"] is None and "data" not in row
    assert (row["latitude"], row["longitude"]) == (40.7, -74.0)
    assert (row["fare_cents"], row["distance_meters"], row["surge_multiplier"]) == (0, 0, 1.0)


def test_completed_event_is_flattened(spark, rows):
    (row,) = flat(spark, rows, envelope(COMPLETED, distance_km=5.5, fare_cents=1500, driver_id="d1"))
    assert (row["distance_meters"], row["fare_cents"], row["driver_id"]) == (5500, 1500, "d1")


def test_fallbacks_of_a_payload(spark, rows):
    a, b, c, d = flat(
        spark, rows,
        envelope(passenger_id="", rider_id="r2", dropoff_lat=1.0, dropoff_lon=2.0, surge_multiplier=0),
        envelope(latitude=None, longitude=3.0, pickup_lat=9.0, pickup_lon=9.0),
        envelope(distance_meters=1234.9, fare_cents="77"),
        envelope(fare_cents="dear"),
    )
    assert (a["rider_id"], a["latitude"], a["longitude"], a["surge_multiplier"]) == ("r2", 1.0, 2.0, 1.0)
    assert (b["latitude"], b["longitude"]) == (None, 3.0)
    assert (c["distance_meters"], c["fare_cents"], c["bad_numbers"]) == (1234, 77, [])
    assert d["bad_numbers"] == ["fare_cents"]


def test_flat_fields_win_over_nested_ones(spark, rows):
    (row,) = flat(spark, rows, envelope(fare_cents=1) | {"fare_cents": 2, "rider_id": "x"})
    assert (row["fare_cents"], row["rider_id"]) == (2, "x")


def test_payload_reasons(spark, rows):
    good = envelope()
    cases = {
        "missing_event_id": {k: v for k, v in good.items() if k != "event_id"},
        "missing_ride_id": {k: v for k, v in good.items() if k != "ride_id"},
        "unknown_event_type": good | {"event_type": "ride_teleported"},
        "malformed": '{"event_id": "e',
        "missing_event_id;missing_ride_id;missing_event_type;missing_timestamp": {},
        "": good,
    }
    checked = ingest.check_payload(ingest.parse_messages(message(spark, *cases.values())))
    got = [";".join(r["reasons"]) for r in rows(checked)]
    assert got == list(cases)
    assert ingest.valid_rows(checked).count() + ingest.rejected_rows(checked).count() == len(cases)


def test_dead_letters_carry_reason_time_and_text(spark, rows):
    checked = ingest.check_payload(ingest.parse_messages(message(spark, "{broken", envelope())))
    (letter,) = rows(ingest.dead_letters(checked, F.timestamp_seconds(F.lit(12))))
    assert (letter["_error"], letter["_dlq_timestamp"]) == ("malformed", 12.0)
    assert letter["raw_text"] == "{broken"


def test_typed_event_reasons(spark, rows):
    df = spark.createDataFrame(
        [("", "r", REQUESTED, "2024-01-01"), ("e", " ", "x", "soon"), ("e", "r", REQUESTED, "2024-01-01")],
        "event_id string, ride_id string, event_type string, timestamp string",
    )
    got = [r["reasons"] for r in rows(ingest.check_event(df))]
    assert got == [["blank_event_id"], ["blank_ride_id", "unknown_event_type", "bad_timestamp"], []]


def test_ride_reasons(spark, rows):
    names = "rider_id string, pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, distance_meters double, fare_cents bigint"
    df = spark.createDataFrame(
        [("p", 1.0, 1.0, 2.0, 2.0, 5.0, 5), (None, 91.0, 181.0, -91.0, -181.0, -1.0, -1),
         ("p", 1.0, 1.0, 1.0, 1.0, None, None)],
        names,
    )
    fine, bad, same = [r["reasons"] for r in rows(ingest.check_ride(df))]
    assert fine == [] and same == ["same_ends"]
    assert bad == ["blank_rider", "pickup_latitude", "pickup_longitude", "dropoff_latitude",
                   "dropoff_longitude", "negative_distance", "negative_fare"]


def test_nested_form_flattens_back(spark, rows):
    flat_rows = spark.createDataFrame(
        [("e", "r", COMPLETED, "2024-01-01T00:00:00+00:00", "p", "d", 1.5, 2.5, 100, 2000, 1.5)], BRONZE
    )
    nested = ingest.nest(flat_rows)
    data = json.loads(nested.first().data)
    assert data["fare_cents"] == 100 and set(data) == set(BRONZE.names[4:])
    assert rows(ingest.flatten(nested).select(*BRONZE.names)) == rows(flat_rows)


def test_history_is_in_time_order_whatever_the_arrival(spark, rows):
    df = spark.createDataFrame(
        [("b", "r1", COMPLETED, "2024-01-01T02:00:00+00:00", None),
         ("a", "r1", REQUESTED, "2024-01-01T01:00:00+00:00", "p"),
         ("c", "r2", REQUESTED, "2024-01-01T00:00:00+00:00", "p")],
        "event_id string, ride_id string, event_type string, timestamp string, rider_id string",
    )
    got = rows(history.event_history(df, ride_id="r1"))
    assert [r["event_id"] for r in got] == ["a", "b"]
    assert [r["data"] for r in got] == ['{"rider_id":"p"}', "{}"]


def test_messages_are_keyed_by_ride(spark, rows):
    (row,) = rows(ingest.keyed_messages(spark.createDataFrame([("e", "r")], "event_id string, ride_id string")))
    assert row == {"key": "r", "value": '{"event_id":"e","ride_id":"r"}'}


def test_reasons_are_put_together_only_for_rows_that_fail_a_check(spark):
    values = itertools.product((None, "", " ", "e"), (None, "r"), (None, "ride_completed", "flown"), (None, "soon", "2024-01-01T00:00:00"))
    df = spark.createDataFrame([*values], "event_id string, ride_id string, event_type string, timestamp string")
    checked = ingest.check_event(ingest.check_payload(df))
    # Spark has no generated code for the filter of a list, so it may not run for every row.
    text = checked._jdf.queryExecution().optimizedPlan().toString()
    lists = text.count("filter(array(")
    assert lists and len(re.findall(r"THEN (?:knownnotcontainsnull\()?filter\(array\(", text)) == lists and "ELSE [] END" in text
    for row in checked.collect():
        missing = [f"missing_{c}" for c in df.columns if row[c] is None] + ["unknown_event_type"] * (row.event_type == "flown")
        late = ["blank_event_id"] * (not (row.event_id or "").strip()) + ["bad_timestamp"] * (row.timestamp == "soon")
        assert row.reasons == (missing or late), row
