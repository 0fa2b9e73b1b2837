import datetime as dt

import pytest
from helpers import bronze_rows
from pyspark.sql import functions as F

from tripmill.operators import gold, silver
from tripmill.schemas import COMPLETED, REQUESTED


def ride(n, at, fare, metres, driver, rider="rider-a", kind=COMPLETED, **more):
    return {"event_id": f"e{n}", "ride_id": f"r{n}", "event_type": kind, "timestamp": at,
            "rider_id": rider, "driver_id": driver, "fare_cents": fare, "distance_meters": metres} | more


@pytest.fixture
def two_rides(spark):
    return bronze_rows(
        spark,
        ride(1, "2026-04-11 12:00:00", 1500, 5000, "driver-a"),
        ride(2, "2026-04-11 13:00:00", 2000, 8000, "driver-b"),
    )


def test_two_rides_to_gold(spark, rows, two_rides):
    stg = silver.to_silver(two_rides)
    assert stg.count() == 2
    summary = rows(gold.rides_summary(stg))
    assert len(summary) == 2 and sum(r["total_revenue_cents"] for r in summary) == 3500
    drivers = {r["driver_id"]: r for r in rows(gold.driver_metrics(stg))}
    assert drivers["driver-b"]["total_earnings_usd"] == 20.0
    (passenger,) = rows(gold.passenger_metrics(stg))
    assert (passenger["rides_taken"], passenger["active_days"]) == (2, 1)
    assert (passenger["is_repeat_rider"], passenger["rides_per_active_day"]) == (True, 2.0)
    assert passenger["total_spent_usd"] == 35.0 and passenger["avg_distance_km"] == 6.5
    hours = rows(gold.hourly_metrics(stg).orderBy("metric_hour"))
    assert [h["metric_hour"].hour for h in hours] == [12, 13]
    assert hours[0]["window_start"] == hours[0]["window_end"] == dt.datetime(2026, 4, 11, 12)


def test_first_delivery_is_kept_and_dedup_is_idempotent(spark, rows):
    bronze = bronze_rows(
        spark,
        ride(1, "2026-04-11T12:05:00+00:00", 1, 1, "d") | {"ride_id": "r"},
        ride(2, "2026-04-11T12:00:00+00:00", 2, 2, "d") | {"ride_id": "r"},
        ride(3, "2026-04-11T12:00:00+00:00", 3, 3, "d") | {"ride_id": "r"},
        ride(4, "2026-04-11T11:00:00+00:00", 0, 0, "d", kind=REQUESTED) | {"ride_id": "r"},
        ride(5, "2026-04-11T12:00:00+00:00", 9, 9, "d") | {"ride_id": None},
        ride(6, "2026-04-11T12:00:00+00:00", 9, 9, "d") | {"event_id": None},
    )
    once = silver.to_silver(bronze)
    assert {(r["event_id"], r["event_type"]) for r in rows(once)} == {("e2", COMPLETED), ("e4", REQUESTED)}
    again = silver.first_occurrence(once, silver.RIDE_EVENT_KEY, ["event_timestamp", "event_id"])
    assert sorted(rows(again), key=str) == sorted(rows(once), key=str)
    assert silver.to_silver(bronze, silver.RIDE_EVENT_TIME_KEY).count() == 3


def test_unreadable_values_become_null(spark, rows):
    bronze = spark.createDataFrame(
        [("e", "r", "RIDE_COMPLETED", "yesterday", "p", "d", "north", "1.5", "12x", "7")],
        "event_id string, ride_id string, event_type string, timestamp string, rider_id string, driver_id string, "
        "latitude string, longitude string, fare_cents string, distance_meters string",
    )
    (row,) = rows(silver.to_silver(bronze))
    assert row["event_type"] == COMPLETED and row["longitude"] == 1.5 and row["distance_meters"] == 7.0
    assert row["event_timestamp"] is row["latitude"] is row["fare_cents"] is None


def test_counts_without_distinct_agree_on_silver(spark, rows, sf_dir):
    from tripmill.plans import bindings

    stg = bindings.silver(spark, sf_dir).persist()
    for model in (gold.driver_metrics, gold.passenger_metrics, gold.rides_summary):
        plain, fast = model(stg), model(stg, unique_rides=True)
        assert plain.exceptAll(fast).count() == fast.exceptAll(plain).count() == 0
    joined = gold.passenger_metrics_joined(stg)
    assert joined.exceptAll(gold.passenger_metrics(stg)).count() == 0
    revenue = stg.filter(F.col("event_type") == COMPLETED).agg(F.sum("fare_cents")).first()[0]
    assert gold.rides_summary(stg).agg(F.sum("total_revenue_cents")).first()[0] == revenue
    stg.unpersist()


def test_counts_by_type(spark, rows):
    df = spark.createDataFrame([(COMPLETED, 1000), (COMPLETED, 1500), (REQUESTED, 0)], "event_type string, fare_cents bigint")
    got = {r["event_type"]: (r["events"], r["total_cents"]) for r in rows(gold.counts_by_type(df))}
    assert got == {COMPLETED: (2, 2500), REQUESTED: (1, 0)}


BATCH = "fare_cents double, distance_km double, surge_multiplier double"


@pytest.mark.parametrize(
    "data, expected",
    [([(1000.0, 4.0, 1.0), (2000.0, 8.0, 1.5), (3000.0, 12.0, 2.0)], (3, 2000.0, 8.0, 2.0)),
     ([(i * 100.0, i * 0.5, 1.0) for i in range(1, 101)], (100, 5050.0, 25.25, 1.0)),
     ([], (0, 0.0, 0.0, 0.0)), ([(None, None, None)], (1, 0.0, 0.0, 1.0))],
)
def test_batch_metrics(spark, data, expected):
    assert tuple(gold.batch_metrics(spark.createDataFrame(data, BATCH)).first()) == expected


def test_daily_totals_of_ten_rides(spark, rows):
    bronze = bronze_rows(
        spark,
        *[
            ride(i, "2026-04-13T12:42:58.504608+00:00", 1500 + 50 * i, 2500 + 100 * i, f"driver-{i:03d}",
                 f"rider-{i:03d}", kind="RIDE_COMPLETED", surge_multiplier=1.0 + i / 10)
            for i in range(10)
        ],
    )
    stg = silver.to_silver(bronze, keep=("surge_multiplier",))
    (summary,) = rows(gold.pipeline_summary(stg))
    assert summary == {
        "total_rides": 10, "total_revenue_cents": 17250, "total_revenue_dollars": 172.5,
        "total_distance_meters": 29500, "total_distance_km": 29.5, "avg_surge": 1.45, "unique_drivers": 10,
    }
    board = rows(gold.leaderboard(gold.driver_daily_totals(stg), "driver_id"))
    assert len(board) == 10 and board[0]["total_fare_cents"] == 1950
    assert [r["total_fare_cents"] for r in board] == sorted((r["total_fare_cents"] for r in board), reverse=True)
    assert board[0]["avg_surge_multiplier"] == 1.9 and board[0]["metric_date"] == dt.date(2026, 4, 13)
    assert gold.passenger_daily_totals(stg).count() == 10


def test_currencies_are_never_added_up(spark, rows):
    df = spark.createDataFrame(
        [("a", "USD", 5), ("a", None, 7), ("b", "USD", 1), ("b", "EUR", 1)], "k string, currency string, cents bigint"
    )
    got = {r["k"]: (r["total_cents"], r["mixed"]) for r in rows(gold.money_by_currency(df, "cents", "k"))}
    assert got == {"a": (12, False), "b": (None, True)}


def test_recent_rows_are_limited_in_a_total_order(spark, rows):
    data = [(dt.date(2024, 1, 1 + i % 20), f"d{i}", None) for i in range(200)]
    df = spark.createDataFrame(data, "ride_date date, driver_id string, passenger_id string")
    got = rows(gold.recent_summary(df, "2024-01-20", 7))
    assert len(got) == 50 and min(r["ride_date"] for r in got) >= dt.date(2024, 1, 13)
    assert got == sorted(got, key=lambda r: (-r["ride_date"].toordinal(), r["driver_id"]))


